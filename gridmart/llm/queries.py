"""The operators over the given tables, and what SQL says of the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import arc, chat, decontaminate, divergence, language, lines, maxscore, minhash, ngrams, packing, repair, shards, toxicity
from gridmart.llm.common import crc_bucket, read

#: The conversation that every run of the first query adds.
ADDED_TURNS = [
    (-1, 0, "user", "</s>[INST] ok [/INST]"),
    (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def ranks_path() -> str:
    """The installed byte-level vocabulary, the same ids as ``byte_bpe_50k.json``."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(ADDED_TURNS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(turns.unionByName(added))
    return formatted.select("conv_id", "n_turns", "formatted", "turns").mapInArrow(_read_back, READ_BACK)


READ_BACK = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parses each formatted conversation and reads its loss mask."""
    template = chat.BracketTemplate()
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            output = row["formatted"]
            turns = template.parse(output)
            learned = "".join(
                template.unescape(output[t["text_start"] : t["text_end"]])
                for t in row["turns"]
                if t["text_start"] is not None
            )
            whole = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append(
                {
                    "conv_id": row["conv_id"],
                    "n_turns": len(turns),
                    "turns_sha256": hashlib.sha256(whole.encode()).hexdigest(),
                    "loss_chars": len(learned),
                    "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(),
                    "formatted_chars": len(output),
                }
            )
        if rows:
            yield pa.RecordBatch.from_pylist(rows)


def op2_maxscore_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = maxscore.integer_vectors(read(spark, folder, "embeddings"))
    return maxscore.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op3_minhash_components(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, minhash.Scheme(shingle=3, percent=85))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_lines", "n_removed", F.length("text").alias("kept_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_spans(docs, read(spark, folder, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    names = F.concat_ws(",", F.array_sort(F.transform("hit_items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op6_language_field(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    learned = docs.filter(crc_bucket() != 2).select("doc_id", "text", "lang")
    chain = language.train(language.sample(learned))
    found = language.identify(docs.select("doc_id", "text"), chain)
    return found.select("doc_id", (crc_bucket() == 2).alias("held_out"), "lang_pred", "score")


def op7_arc_to_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    records = arc.archive_pages(pages, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    labels = read(spark, folder, "labels").filter(crc_bucket() != 2).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.build(*toxicity.sample(docs, labels)))
    return scored.select(
        "doc_id",
        (crc_bucket() == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "evidence",
    )


def op9_pattern_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"), ranks_path())


def op10_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    utf8 = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    records = read(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(utf8).cast("long") + 1).alias("size"),
        F.crc32(utf8).alias("text_crc32"),
        F.xxhash64(utf8).alias("group"),
        F.col("doc_id").alias("id"),
    )
    return shards.assign_shards(records, 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user, by a hash of where they stand."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    where = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    hit = F.crc32(where.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", *said, hit.alias("hit")).filter("hit <> 0")
    text = F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("hit") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read(spark, folder, "conversations")
    return repair.audited(conversations, damaged(conversations))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergences(read(spark, folder, "documents"))


def op13_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7).eqNullSafe(2).alias("held_out")
    docs = read(spark, folder, "documents").select("doc_id", out, "text")
    return ngrams.score(docs, ngrams.train(docs.filter(~F.col("held_out"))))


_ESCAPED = r"regexp_replace({0}, '\\*(?:<s>|</s>|\[INST\]|\[/INST\]|\[OUT\]|\[ROLE\]|\[/ROLE\])', '\\\0', 'g')"

SQL = {}
SQL["op1_chat_format"] = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, role as r, text as t from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
), whole as (
  select conv_id, count(*) as n_turns,
    string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r nulls first, t nulls first) as turns,
    coalesce(string_agg(text, '' order by turn nulls first, r nulls first, t nulls first)
      filter (where role = 'assistant'), '') as loss,
    sum(length({_ESCAPED.format("text")}) + case role when 'user' then 19 when 'assistant' then 12
      else 22 + length({_ESCAPED.format("role")}) end) as formatted_chars
  from turns group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  formatted_chars::bigint as formatted_chars
from whole
"""


SQL["op2_maxscore_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 100 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored qualify rank <= 10
"""

_BASE32 = ", ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (('0x' || substr(hex, {5 * g + 1}, 5))::int >> {s}) % 32, 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)
_FOLDED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op3_minhash_components"] = f"""
with recursive doc as (select doc_id,
  regexp_extract_all({_FOLDED.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from documents),
sh as (select distinct doc_id, array_to_string(w[i:i + 2], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) as i from doc where len(w) > 0)),
size as (select doc_id, count(*) as n from sh group by doc_id),
link as (select a.doc_id as x, b.doc_id as y from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id
  join size p on p.doc_id = a.doc_id join size q on q.doc_id = b.doc_id
  where least(p.n, q.n) * 100 >= greatest(p.n, q.n) * 85
  group by a.doc_id, b.doc_id, p.n, q.n having count(*) * 100 >= (p.n + q.n - count(*)) * 85),
reach as (select doc_id, doc_id as y from doc union select reach.doc_id, link.y from reach join link on link.x = reach.y)
select doc.doc_id, coalesce(n, 0) as n_shingles, c as component_id, c = doc.doc_id as kept
from doc left join size on size.doc_id = doc.doc_id
  join (select doc_id, min(y) as c from reach group by doc_id) r on r.doc_id = doc.doc_id
"""
SQL["op4_line_dedup"] = """
with cut as (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null),
line as (select doc_id, no, ls[no] as line, row_number() over (order by doc_id nulls first, no) as place
  from (select doc_id, ls, unnest(range(1, len(ls) + 1)) as no from cut)),
long as (select * from line where length(line) >= 10),
first as (select line, min(place) as place from long group by line),
half as (select line, place, c, side, case side when 0 then left(line, c // 2) else right(line, c // 2) end as part
  from (select line, place, unnest([length(line), length(line) - 1]) as c from first), (values (0), (1)) s(side)),
near as (select distinct a.line from half a join half b using (c, side, part)
  where b.place < a.place and a.line <> b.line and least(length(a.line), length(b.line)) = c
    and levenshtein(a.line, b.line) <= 1),
judged as (select line.*, coalesce(first.place < line.place, false) or near.line is not null as gone
  from line left join first using (line) left join near using (line)),
kept as (select doc_id, count(*) as n_lines, sum(gone::int)::bigint as n_removed,
  coalesce(string_agg(line, chr(10) order by no) filter (where not gone), '') as text
  from judged group by doc_id)
select documents.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
  length(kept.text) as kept_chars, sha256(kept.text) as text_sha256
from documents left join kept on documents.doc_id is not distinct from kept.doc_id
"""
_WORDS = r"regexp_extract_all(" + _FOLDED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL["op5_decontaminate"] = f"""
with doc as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
item as (select item_id, {_WORDS.format("text")} as w from benchmark where item_id is not null and text is not null),
win as (select distinct item_id, k, array_to_string(w[i:i + k - 1], ' ') as win
  from (select item_id, w, least(10, len(w)) as k, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from item where len(w) > 0)),
placed as (select doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') as win
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from doc, (select distinct k from win))),
hit as (select doc_id, item_id, placed.k, i from placed join win using (k, win)),
word as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hit) group by doc_id),
found as (select doc_id, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items
  from (select distinct doc_id, item_id from hit) group by doc_id)
select doc.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join word on doc.doc_id = word.doc_id left join found on doc.doc_id = found.doc_id
"""
SQL["op7_arc_to_warc"] = f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
d as (select page_id, octet_length(encode(html))::bigint as payload_bytes, concat({_BASE32}) as payload_digest,
  min(page_id) over (partition by hex) as first from p)
select page_id, payload_bytes, payload_digest, case when first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from d
"""


#: crc32 bit by bit: a byte is mixed in, then eight bits are shifted out.
_CRC32 = """xor(list_reduce(list_concat([4294967295], flatten([[ascii({0}[i]), -1, -1, -1, -1, -1, -1, -1, -1]
    for i in range(1, length({0}) + 1)])),
    lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295)"""
SQL["op11_structure_repair"] = f"""
with recursive said as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as place from conversations),
hit as (select *, {_CRC32.format("place")} % 20 as h from said),
damaged as (select conv_id, turn, case h when 4 then 'user' else role end as role,
  case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case h when 0 then 0 when 3 then 2 else 1 end)) as copy from hit),
placed as (select conv_id, turn, role, text,
  row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
row as (select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') then 'truncated' end as fault,
  lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as pair from placed),
counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
  count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
  count(*) filter (where fault = 'truncated') as truncated,
  count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal, count(*) as n from row group by conv_id),
inserted as (from (values (0, 0, '', []::varchar[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []), (0, 2, 'I', ['user:']),
  (0, 3, 'II', ['user:', 'assistant:']), (1, 2, 'I', ['user:']), (1, 3, 'II', ['user:', 'assistant:']),
  (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:'])) t(p, m, letters, turns)),
edit as (from (values ('D', 0, 0, null), ('D', 1, 1, null), ('D', 2, 2, null), ('D', 3, 3, null), ('R', 0, 2, null),
  ('R', 1, 2, null), ('R', 3, 2, null), ('R', 2, 3, null), ('K', 0, 1, 's'), ('K', 0, 2, 'u'), ('K', 1, 2, 'u'),
  ('K', 3, 2, 'u'), ('K', 2, 3, 'a')) t(letter, m, q, initial)),
way as (select conv_id, 0::bigint as i, 0 as q, {{'cost': 0::bigint, 'audit': '', 'turns': []::varchar[]}} as best
    from (select distinct conv_id from row)
  union all
  select way.conv_id, row.i, edit.q, min({{
    'cost': best.cost + 5 * length(letters) + case letter when 'D' then 2 when 'R' then 1 else 0 end
      + case when fault = 'truncated' and letter <> 'D' then 5 else 0 end,
    'audit': best.audit || letters || letter,
    'turns': best.turns || inserted.turns || case letter when 'D' then []::varchar[]
      when 'K' then [role || ':' || text] else [case edit.q when 2 then 'user:' else 'assistant:' end || text] end}})
  from way join row on row.conv_id is not distinct from way.conv_id and row.i = way.i + 1
    join inserted on inserted.p = way.q join edit on edit.m = inserted.m
  where (letter = 'D' or fault is null or fault = 'truncated') and (letter <> 'K' or initial = left(role, 1))
  group by way.conv_id, row.i, edit.q),
ended as (select way.conv_id, min({{'cost': best.cost + 5 * length(tail), 'audit': best.audit || tail,
    'turns': best.turns || last}}) as best
  from way join counted on counted.conv_id is not distinct from way.conv_id and way.i = n
    join (values (0, '', []::varchar[]), (1, 'II', ['user:', 'assistant:']), (2, 'I', ['assistant:']), (3, '', [])) t(q, tail, last)
      on t.q = way.q group by way.conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost,
  coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.turns, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
  left join counted on counted.conv_id is not distinct from c.conv_id
  left join ended on ended.conv_id is not distinct from c.conv_id
"""


SQL["op12_source_divergence"] = f"""
with doc as (select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
  regexp_extract_all({_FOLDED.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w from documents),
word as (select d, lang, source, unnest(w) as term from doc),
kept as (select lang, term, sum(n)::bigint as n from (select lang, term, d, count(*) as n from word group by all)
  group by lang, term having count(*) >= 10),
grp as (select distinct lang, source from doc),
own as (select lang, source, term, count(*) as n from word group by all),
held as (select grp.lang, grp.source, kept.term, coalesce(own.n, 0) as n, kept.n as lang_n from grp join kept using (lang)
  left join own on own.lang = grp.lang and own.source = grp.source and own.term = kept.term),
size as (select lang, count(*) as v, sum(n) as total from kept group by lang),
share as (select lang, source, term, n, 1 + 1000000000::hugeint * (n + 2) // (sum(n) over (partition by lang, source) + 2 * v) as p,
  1 + 1000000000::hugeint * (lang_n + 2) // (total + 2 * v) as q from held join size using (lang)),
pair as (select a.lang, a.source, b.source as item, coalesce(sum((s.p - t.p) * (s.p - t.p) // (s.p + t.p)), 0)::bigint as value
  from grp a join grp b on a.lang = b.lang and a.source <> b.source
  left join share s on s.lang = a.lang and s.source = a.source
  left join share t on t.lang = b.lang and t.source = b.source and t.term = s.term group by all),
found as (select lang, source, 'pair' as part, item, value from pair
  union all select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from share where n > 0 and p > q)
select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
from found qualify part = 'pair' or rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_chat_format,
        op2_maxscore_top_k,
        op3_minhash_components,
        op4_line_dedup,
        op5_decontaminate,
        op6_language_field,
        op7_arc_to_warc,
        op8_toxicity_neighbours,
        op9_pattern_packing,
        op10_sampled_splitters,
        op11_structure_repair,
        op12_source_divergence,
        op13_kneser_ney,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return SQL

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridmart.llm import packing
from gridmart.llm.queries import op9_pattern_packing, ranks_path

SCHEMA = "doc_id long, text string, piece string"


def test_ids_are_those_of_the_tokenizer(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", " ", "a  b", "x \n y", "it's 12 3", "<|endoftext|> x<|endoftext|>", "é ü　 x", "\x1c y"]
    tokens = packing.Tokens(ranks_path())
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts:
        assert np.frombuffer(tokens.ids(text), "<u4").tolist() == known.encode(text, add_special_tokens=False).ids


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300)), st.sampled_from([8, 64]))
def test_plan_holds_every_piece_once(counts, grid):
    held = Counter()
    for group in packing.plan(counts, 64, grid):
        assert sum(group.lengths) <= 64 and group.times > 0
        for length in group.lengths:
            held[length] += group.times
    assert held == counts


@pytest.mark.parametrize("seed", range(3))
def test_plan_is_close_to_the_bound(seed):
    draw = np.random.default_rng(seed)
    lengths = np.clip(draw.lognormal(6, 1, 20_000).astype(int) + 1, 1, 2048)
    used = sum(g.times for g in packing.plan(Counter(lengths.tolist())))
    least = max(-(-lengths.sum() // 2048), (lengths > 1024).sum())
    assert used <= 1.005 * least + 1


def test_nnls_leaves_no_better_direction():
    draw = np.random.default_rng(4)
    a, b = draw.random((30, 80)), draw.random(30)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 0]).max() < 1e-6


def check(pieces, sequence):
    at = Counter()
    for row in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert row["offset"] == at[row["sequence_id"]]
        at[row["sequence_id"]] += row["length"]
    assert all(n <= sequence for n in at.values())
    return at


def test_rows_in_every_state(spark):
    draw = random.Random(2)
    rows = [(1, None, ""), (2, "", ""), (3, "word " * 500, ""), (3, "word " * 500, ""), (None, "a", "")]
    rows += [(10 + i, "the cat " * draw.randint(0, 90), "") for i in range(300)]
    pieces = packing.tokenised_pieces(spark.createDataFrame(rows, SCHEMA), ranks_path(), 64)
    found = packing.pack(pieces, 64).collect()
    assert len(found) == pieces.count()
    used = check(found, 64)
    assert len(used) <= 1.05 * (sum(used.values()) / 64) + 2
    third = sorted((r["piece"], r["start"], r["length"]) for r in found if r["doc_id"] == 3)[::2]
    assert sum(n for _, _, n in third) == third[-1][1] + 64
    assert all(n == 64 for p, _, n in third if p) and third[0][1] == 0
    assert [r["length"] for r in found if r["doc_id"] == 1] == [1]
    assert packing.pack(pieces.limit(0), 64).count() == 0


def test_query_cuts_and_packs_every_document(spark):
    folder = "/root/testdata/sf0.001"
    found = op9_pattern_packing(spark, folder).collect()
    used = check(found, 2048)
    assert len(used) <= -(-sum(used.values()) // 2048) * 1.05 + 1
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len({r["doc_id"] for r in found}) == len(docs)
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for doc in docs:
        ids = [*known.encode(doc["text"] or "", add_special_tokens=False).ids, 0]
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(pieces[doc["doc_id"]])):
            assert (piece, start) == (k, at) and (length == 2048 or k == 0 or len(ids) <= 2048)
            assert crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)


def test_rows_without_id_in_bulk(spark):
    rows = [(None, "one text for all", "")] * 3000 + [(1, "another " * (1 + k % 50), "") for k in range(600)]
    found = packing.pack_documents(spark.createDataFrame(rows, SCHEMA).repartition(6), ranks_path(), 64)
    assert found.columns == [*packing.tokenised_pieces(spark.createDataFrame(rows, SCHEMA), ranks_path(), 64).columns, "sequence_id", "offset"]
    held = found.collect()
    used = check(held, 64)
    assert len(held) >= 3600 and len(used) <= 1.05 * sum(used.values()) / 64 + 2

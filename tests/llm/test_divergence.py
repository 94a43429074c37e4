import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from gridmart.llm import divergence
from gridmart.llm.divergence import Audit

SCHEMA = "doc_id long, text string, lang string, source string, value string"
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.decode() for t in TERM.findall((text or "").encode().lower())]


def plain(rows, audit):
    docs = [(lang or "", source or "", terms(text)) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        of = Counter(t for la, _, ts in docs if la == lang for t in set(ts))
        kept = {t for t, n in of.items() if n >= audit.documents}
        groups = {s: Counter() for la, s, _ in docs if la == lang}
        for la, s, ts in docs:
            if la == lang:
                groups[s].update(t for t in ts if t in kept)

        def share(counts):
            below = counts.total() + audit.added * len(kept)
            return {t: 1 + audit.whole * (counts[t] + audit.added) // below for t in kept}

        shares = {s: share(c) for s, c in groups.items()}
        whole = share(sum(groups.values(), Counter()))
        apart = lambda p, q: (p - q) ** 2 // (p + q)
        for s, p in shares.items():
            pairs = [(-sum(apart(p[t], q[t]) for t in kept), o.encode(), o) for o, q in shares.items() if o != s]
            most = [(-apart(p[t], whole[t]), t.encode(), t) for t in kept if groups[s][t] and p[t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(most)[: audit.terms])):
                out += [(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def found(spark, rows, audit):
    docs = spark.createDataFrame([(k, *r, "x") for k, r in enumerate(rows)], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in divergence.divergences(docs, audit).collect())


def test_against_plain_counting(spark):
    rng = random.Random(3)
    words = ["Ab", "b", "été", "É", "x1y", "don't", "世界", "z", "zz", "zzz", "Q", "_u", "ſ", "K"]
    rows = []
    for _ in range(300):
        text = rng.choice([" ", ", ", "\n", "\x00"]).join(rng.choices(words, k=rng.randint(0, 12)))
        rows.append((text, rng.choice(["a", "b", "b", None]), rng.choice(["s", "t", "u", None, "é", "T"])))
    rows += [(None, "c", "s"), ("", "c", "t"), ("only few", "d", "s"), ("x " * 50_000, "b", "s")] + [("same text", "b", "t")] * 40
    for audit in (Audit(), Audit(documents=2, added=3, whole=10**6, terms=3)):
        assert found(spark, rows, audit) == plain(rows, audit)


def test_no_documents(spark):
    assert found(spark, [("x", "a", "b")], Audit()) == []
    docs = spark.createDataFrame([], SCHEMA)
    assert divergence.divergences(docs).count() == 0


@pytest.mark.parametrize("limit", [1, 7, 40, 1 << 20])
def test_slices_and_pieces_count_alike(monkeypatch, limit):
    monkeypatch.setattr(divergence, "SLICE_BYTES", limit)
    texts = ["a bb a", "", "cc", "long " * 30 + "été", "été été", "b", "", "tail-long " * 9]
    data = {"lang": ["l"] * len(texts), "source": ["s", "t"] * 4, "text": texts}
    tables = pa.concat_tables(divergence._batch_counts(pa.RecordBatch.from_pydict(data)))
    held = divergence._summed(tables, ["lang", "source", "term"]).to_pylist()
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for source, text in zip(data["source"], texts):
        counts[source].update(terms(text))
        documents[source].update(set(terms(text)))
    assert {r["source"] for r in held if r["term"] is None} == {"s", "t"}
    named = [r for r in held if r["term"] is not None]
    assert len(named) == sum(len(c) for c in counts.values())
    for r in named:
        assert (r["n"], r["documents"]) == (counts[r["source"]][r["term"]], documents[r["source"]][r["term"]])


def test_shares_beyond_64_bits_in_between():
    import numpy as np

    counts = np.array([0, 10**14, 3 * 10**14, 10**15], np.int64)
    total = int(counts.sum())
    held = divergence.shares(counts, total, 4, Audit()).tolist()
    assert held == [1 + 10**9 * (c + 2) // (total + 8) for c in counts.tolist()]

import random
import re
from collections import Counter, defaultdict
from math import isclose, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from gridmart.llm import ngrams
from gridmart.llm.queries import op13_kneser_ney

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BEGIN, END = 0, 1


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*WORD.findall(lower), END]


class Plain:
    """The same model over strings, one dictionary for each order."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [None] * (order + 1)
        raw, seen = Counter(), Counter()
        for text in texts:
            said = tokens(text)
            seen.update(said)
            padded = [BEGIN] * (order - 1) + said
            raw.update(tuple(padded[k : k + order]) for k in range(len(said)))
        self.counts[order] = raw
        for k in range(order - 1, 0, -1):
            lower = Counter()
            for gram, n in self.counts[k + 1].items():
                lower[gram[1:]] += n if gram[1] == BEGIN else 1
            self.counts[k] = lower
        self.seen, self.tokens, self.words = seen, sum(seen.values()), len(seen)
        self.taken, self.sums = [None] * (order + 1), [None] * (order + 1)
        for k in range(1, order + 1):
            self.taken[k] = self._taken(self.counts[k])
            sums = defaultdict(lambda: [0, 0, 0, 0])
            for gram, n in self.counts[k].items():
                held = sums[gram[:-1]]
                held[0] += n
                held[min(n, 3)] += 1
            self.sums[k] = sums

    @staticmethod
    def _taken(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        out = []
        for k in (1, 2, 3):
            d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0
            out.append(d if n[k + 1] and 0 < d < k else k / 2)
        return out

    def probability(self, gram):
        k = len(gram)
        below = self.probability(gram[1:]) if k > 1 else 1 / (self.words + 1)
        total, *ones = self.sums[k].get(gram[:-1], [0, 0, 0, 0])
        if not total:
            return below
        n = self.counts[k].get(gram, 0)
        left = max(n - self.taken[k][min(n, 3) - 1], 0) if n else 0
        return left / total + sum(d * m for d, m in zip(self.taken[k], ones)) / total * below

    def score(self, text):
        said = tokens(text)
        padded = [BEGIN] * (self.order - 1) + said
        p = sum(log10(self.probability(tuple(padded[k : k + self.order]))) for k in range(len(said)))
        base = sum(log10((self.seen[t] + 1) / (self.tokens + self.words + 1)) for t in said)
        return len(said), sum(self.seen[t] > 0 for t in said), self.tokens, base, p


def same(row, expected):
    held = (row["n_tokens"], row["n_known"], row["train_tokens"])
    assert held == expected[:3], (row, expected)
    assert isclose(row["base_score"], expected[3], rel_tol=1e-9) and isclose(row["score"], expected[4], rel_tol=1e-9), (row, expected)


def texts(n, seed):
    rng = random.Random(seed)
    words = ["the"] * 30 + [f"w{k}" for k in range(40)] + ["É", "Ab", "aB", "世界", "x.", "\x00"] * 2
    out = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*out, None, "", " \n", *["the same text the end"] * 30, "new words only"]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_plain_dictionaries(spark, monkeypatch, order):
    monkeypatch.setattr(ngrams, "SHARD_BYTES", 2000)  # several shards, "the" is spread over them
    learned, asked = texts(200, order), texts(60, 99) + texts(200, order)[:20]
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    model = ngrams.train(frame(learned), order)
    assert model.layout.shards > 5 and len(model.layout.hot)
    plain = Plain(learned, order)
    found = {r["doc_id"]: r for r in ngrams.score(frame(asked), model).collect()}
    assert len(found) == len(asked)
    for k, text in enumerate(asked):
        same(found[k], plain.score(text))


def test_probabilities_add_up(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "SHARD_BYTES", 3000)
    learned = texts(100, 5)
    plain = Plain(learned, 2)
    words = [*plain.seen, "unknown"]
    for before in ("the", "w3", "never"):
        assert isclose(sum(plain.probability((before, w)) for w in words), 1, rel_tol=1e-9)
    model = ngrams.train(spark.createDataFrame([(t,) for t in learned], "text string"))
    scorer = ngrams._Scorer(model)
    hashes = lambda ws: next(ngrams.runs(pa.array([" ".join(ws)]), 1)).columns[0][: len(ws)]
    named = [w for w in words if w != END]
    last = np.append(hashes(named), ngrams.END)
    p, _ = scorer.probabilities([np.full(len(last), hashes(["the"])[0]), last])
    assert isclose(p.sum(), 1, rel_tol=1e-9)


def test_nothing_to_learn_and_clashing_columns(spark):
    schema = "doc_id long, text string, score string, words long"
    docs = spark.createDataFrame([(1, "a b", "x", 3), (None, None, None, None), (1, "a b", "x", 3)], schema)
    model = ngrams.train(docs.filter("false"))
    found = ngrams.score(docs, model).collect()
    assert sorted((r["words"] or 0, r["n_tokens"], r["n_known"], r["score"], r["base_score"]) for r in found) == [
        (0, 1, 0, 0.0, 0.0),
        (3, 3, 0, 0.0, 0.0),
        (3, 3, 0, 0.0, 0.0),
    ]
    assert ngrams.score(docs.filter("false"), model).count() == 0


@pytest.mark.parametrize("order", [1, 3])
def test_pieces_of_long_texts(monkeypatch, order):
    said = texts(20, 3) + ["word " * 500, "x" * 3000 + " y" * 40, "tail" * 400]

    def read():
        parts = list(ngrams.runs(pa.array(said), order))
        return [np.concatenate(c).tolist() for c in zip(*(p.columns for p in parts))], np.concatenate([p.rows for p in parts])

    whole, rows = read()
    assert np.bincount(rows).tolist() == [len(tokens(t)) for t in said]
    monkeypatch.setattr(ngrams, "PIECE_BYTES", 300)
    pieces, rows_of_pieces = read()
    assert whole == pieces and rows.tolist() == rows_of_pieces.tolist()


def test_the_query_against_plain_dictionaries(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in docs}
    plain = Plain([r["text"] for r in docs if not out[r["doc_id"]]], 2)
    found = {r["doc_id"]: r for r in op13_kneser_ney(spark, folder).collect()}
    assert len(found) == len(docs)
    for r in docs:
        assert found[r["doc_id"]]["held_out"] == out[r["doc_id"]]
        same(found[r["doc_id"]], plain.score(r["text"]))
    better = [found[d]["score"] > found[d]["base_score"] for d in found if out[d]]
    assert sum(better) > 0.9 * len(better)

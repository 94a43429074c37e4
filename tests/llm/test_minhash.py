import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmart.llm import minhash
from gridmart.llm.components import components

SCHEMA = "doc_id long, text string, component_id string"


def plain(rows, size, percent):
    def shingles(text):
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    held = {d: shingles(t) for d, t in rows}
    root = {d: d for d in held}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in held:
        for b in held:
            if a < b and held[a] and held[b]:
                both = len(held[a] & held[b])
                if 100 * both >= percent * (len(held[a]) + len(held[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {(d, len(held[d]), top(d), top(d) == d) for d in held}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_equals_all_pairs(spark, size, percent):
    draw = random.Random(size)
    words = [f"w{i}" for i in range(400)]
    rows, passage = [], draw.choices(words, k=60)
    for group in range(25):
        text = draw.choices(words, k=draw.randint(20, 200))
        for _ in range(draw.choice([1, 1, 3, 12])):
            copy = list(text)
            for _ in range(draw.randint(0, 6)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
            text = draw.choice([text, copy])  # chains
        rows.append((len(rows), " ".join(passage + draw.choices(words, k=draw.randint(1, 40)))))
    rows += [(1000, ""), (1001, None), (1002, " \n\t"), (1003, "One"), (1004, "one"), (1005, "one two"), (1006, "É a b"), (1007, "é a b")]
    rows += [(1008, "very " * 30_000), (1009, "very " * 20_000)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = minhash.near_duplicates(frame, minhash.Scheme(size, percent))
    assert {tuple(r) for r in found.collect()} == plain(rows, size, percent)


def test_rows_in_every_state(spark):
    text = "one two three four five six"
    rows = [(None, text, ""), (None, text, ""), (7, text, ""), (7, text, ""), (7, "other words here now", ""), (9, "other words here now", "")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), minhash.Scheme(3, 85))
    got = sorted(map(tuple, found.select("doc_id", "component_id", "kept").collect()), key=str)
    assert got == sorted([(None, None, True)] * 2 + [(7, 7, True)] * 3 + [(9, 7, False)], key=str)
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (95, 95)]
    links = spark.createDataFrame(chain, "a long, b long").orderBy(F.rand(3))
    found = {r["id"]: r["component"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100: 90}


def test_no_pair_at_the_threshold_is_likely_missed():
    for percent in (80, 85, 90, 100):
        bands, rows = minhash.Scheme(percent=percent).banding
        assert (1 - (percent / 100) ** rows) ** bands <= 1e-7
        assert bands * rows <= minhash.Scheme().most


@pytest.mark.parametrize("percent,shared,each", [(85, 6, (1, 0)), (85, 7, (1, 0)), (85, 17, (2, 1)), (80, 4, (1, 0)), (80, 8, (1, 1))])
def test_short_pairs_at_the_threshold_pass_the_sketch(percent, shared, each):
    scheme = minhash.Scheme(3, percent)
    signer, draw = minhash._Signer(scheme), np.random.default_rng(shared)
    one, two = (shared + n for n in each)
    assert 100 * shared >= percent * (one + two - shared)
    differing = []
    for _ in range(1500):
        drawn = draw.integers(0, 1 << 64, one + two - shared, dtype=np.uint64)
        sketches = [signer.sketch(signer.minima(s)).view(np.uint64) for s in (drawn[:one], np.delete(drawn, np.s_[shared:one]))]
        differing.append(int(np.bitwise_count(sketches[0] ^ sketches[1]).sum()))
    assert max(differing) <= scheme.differing_bits


def test_short_texts_at_the_threshold_equal_all_pairs(spark):
    draw = random.Random(4)
    rows = []
    for _ in range(400):
        text = [f"{draw.randrange(10**9)}" for _ in range(9)]
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(text[:8]))]
    found = minhash.near_duplicates(spark.createDataFrame([(*r, "") for r in rows], SCHEMA), minhash.Scheme(3, 85))
    assert {r["component_id"] for r in found.collect()} == set(range(0, 800, 2))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_a_group_of_near_copies_equals_all_pairs(spark, size, percent):
    """Members on both sides of the threshold, whose edits are their own or shared with few others."""
    draw = random.Random(percent)
    text = [f"w{k}" for k in range(60)]
    pool = [(draw.randrange(60), f"e{k}") for k in range(12)]
    rows = []
    for k in range(260):
        copy = list(text)
        for _ in range(draw.randint(1, 5)):
            at, word = draw.choice(pool) if draw.random() < 0.6 else (draw.randrange(60), f"own{k}")
            copy[at] = word
        rows.append((len(rows), " ".join(copy)))
    found = minhash.near_duplicates(spark.createDataFrame([(*r, "") for r in rows], SCHEMA), minhash.Scheme(size, percent))
    expected = plain(rows, size, percent)
    assert 3 < len({c for _, _, c, _ in expected}) < 200
    assert {tuple(r) for r in found.collect()} == expected


def test_texts_of_one_id_keep_all_their_links(spark):
    """Two texts of one id and one size: what is near to either is near to the id."""
    draw = random.Random(2)
    one, two = ([f"{draw.randrange(10**6)}" for _ in range(30)] for _ in range(2))
    near = lambda words: " ".join(words[:-1] + ["x"])
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, near(one)), (3, near(two)), (4, "else where here")]
    found = minhash.near_duplicates(spark.createDataFrame([(*r, "") for r in rows], SCHEMA), minhash.Scheme(3, 85)).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found} == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}

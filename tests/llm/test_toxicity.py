import random
from collections import Counter

import numpy as np

from gridmart.llm import toxicity as t

SCHEMA = "doc_id long, text string, score string"


def made(seed=1, n=400):
    draw = random.Random(seed)
    bad, plain = ["nastyword", "vilething", "rottenone"], [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        text = draw.choices(plain, k=20)
        if i % 4 == 0:
            text[3:3] = draw.choices(bad, k=draw.randint(1, 3))
        rows.append((i, " ".join(text).encode(), int(i % 4 == 0)))
    return rows


def test_blocks_give_the_exact_nearest():
    rows = made()
    index = t.build(rows, {0: 300, 1: 100})
    scorer = np.zeros((len(index.ids), len(index.idf)))
    for r in range(len(index.ids)):
        for term in range(len(index.idf)):
            for block in range(index.starts.shape[1] - 1):
                a, b = index.starts[term, block], index.starts[term, block + 1]
                for k in range(a, b):
                    if index.rows[k] == r:
                        scorer[r, term] = index.weights[k]
    draw = random.Random(2)
    for _ in range(50):
        at, weights = index.vector(sorted(draw.sample(range(len(index.idf)), 3)))
        cosines = scorer[:, at] @ weights
        expected = [r for r in sorted(range(len(cosines)), key=lambda r: (-cosines[r].round(9), r)) if cosines[r] > 0]
        found, best = index.nearest(at, weights)
        assert found.tolist() == expected[: t.NEIGHBOURS]
        np.testing.assert_allclose(best, cosines[found])


def test_unseen_texts_are_told_apart():
    index = t.build(made(), {0: 300, 1: 100})
    scorer = t._Scorer(index)
    right = Counter((y, scorer.score(text)[0] >= 0.3) for _, text, y in made(seed=9))
    assert right[0, True] == right[1, False] == 0
    score, evidence = scorer.score(b"a Vilething here")
    assert score > 0.9 and evidence and all(i % 4 == 0 for i in evidence)


def test_rows_in_every_state(spark):
    index = t.build(made(), {0: 300, 1: 100})
    rows = [(1, None, ""), (2, "", ""), (3, "nastyword", ""), (3, "nastyword", ""), (4, "w1 " * 50_000, ""), (None, "!", "")]
    found = t.score(spark.createDataFrame(rows, SCHEMA), index)
    assert found.columns == ["doc_id", "text", "score", "evidence"]
    got = [(r["doc_id"], r["score"] > 0.3) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(1, False), (2, False), (3, True), (3, True), (4, False), (None, False)], key=str)
    assert t.score(spark.createDataFrame([], SCHEMA), index).count() == 0
    empty = t.build([], {})
    assert {r["score"] for r in t.score(spark.createDataFrame(rows, SCHEMA), empty).collect()} == {0.0}


def test_sample_of_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "") for i in range(50)] + [(60, None, ""), (61, "x" * 300_000, "")], SCHEMA)
    labels = [(i, i % 2) for i in range(50)] + [(60, 1), (61, 0), (0, 1), (5, None), (None, 1), (99, 0), (7, 5)]
    rows, totals = t.sample(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), per_class=10)
    assert totals == {0: 26, 1: 28}
    assert len(rows) <= 20 and {y for _, _, y in rows} == {0, 1}


def test_copy_of_a_toxic_example_with_rare_words_finds_it():
    draw = random.Random(6)
    rare = [" ".join("".join(draw.choices("abcdefghijk", k=9)) for _ in range(2)) for _ in range(30)]
    rows = made() + [(1000 + i, f"{r} w1 w2 w3".encode(), 1) for i, r in enumerate(rare)]
    scorer = t._Scorer(t.build(rows, {0: 30_000, 1: 1300}))
    for i, r in enumerate(rare):
        score, evidence = scorer.score(f"{r.upper()} w1 w2 w3".encode())
        assert score >= 0.3 and evidence[0] == 1000 + i
    score, evidence = scorer.score(b"w1 w2 w3 w7 w9 w11 w20")
    assert score < 0.3 and evidence


def test_search_by_all_words_is_exact():
    draw = random.Random(5)
    names = [f"v{i}" for i in range(900)]
    counted = [Counter(draw.choices(names, [1 / (k + 1) for k in range(900)], k=80)) for _ in range(700)]
    plain = t._plain(counted)
    whole = np.zeros((700, len(plain.words)))
    for r, (at, weights) in enumerate(plain.vectors):
        whole[r, at] = weights
    for r in range(0, 700, 20):
        at, weights = plain.vector(Counter({f"v{k}": 1 for k in draw.sample(range(900), 30)} | counted[r]))
        cosines = whole[:, at] @ weights
        cosines[r + 1] = 0
        expected = sorted(range(700), key=lambda k: (-cosines[k].round(9), k))[: t.NEIGHBOURS]
        rows, best = plain.nearest(at, weights, skip=r + 1)
        assert rows.tolist() == expected
        np.testing.assert_allclose(best, cosines[rows])


def test_terms_are_bounded_by_neither_share_nor_number():
    rows = [(i, f"p{i} q{i}".encode(), 0) for i in range(3000)]
    rows += [(5000 + i, f"slur{i // 25} z{i}".encode(), 1) for i in range(3000)]
    index = t.build(rows, {0: 3000, 1: 3000})
    assert all(index.read(f"slur{k}".encode()) >= 0 for k in range(120))

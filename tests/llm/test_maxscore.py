import random

from gridmart.llm import maxscore

SCHEMA = "vec_id long, embedding array<double>, query_id int"


def plain(vectors, asked, k):
    out = set()
    for q, one in asked:
        scored = [(-sum(a * b for a, b in zip(one, two)), v) for v, two in vectors if v != q]
        out |= {(q, rank, v, -s) for rank, (s, v) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(spark, rows, asked, k, **more):
    frame = maxscore.integer_vectors(spark.createDataFrame(rows, SCHEMA), scale=1)
    hits = maxscore.top_k(frame, frame.filter(frame.vec_id.isin(asked)), k, **more)
    return {tuple(r) for r in hits.select("query_id", "rank", "vec_id", "score").collect()}


def test_equals_all_products(spark):
    draw = random.Random(3)
    vectors = [(v, [draw.randint(-6, 6) for _ in range(draw.choice([3, 12, 12, 12]))]) for v in range(700)]
    vectors += [(v, [1] * 12) for v in range(700, 1000)]  # ties
    asked = [v for v, _ in vectors if v % 90 == 0]
    rows = [(v, [float(x) for x in e], 0) for v, e in vectors]
    expected = plain(vectors, [x for x in vectors if x[0] in asked], 10)
    assert found(spark, rows, asked, 10) == expected
    assert found(spark, rows, asked, 10, query_block=3) == expected


def test_rows_in_every_state(spark):
    rows = [
        (0, [1.0, 2.0], 0),
        (1, None, 0),
        (2, [1.0, None], 0),
        (3, [float("nan"), 1.0], 0),
        (4, [float("inf"), 1.0], 0),
        (None, [1.0, 1.0], 0),
        (5, [], 0),
        (6, [2.5, 0.0], 0),
    ]
    assert found(spark, rows, [0, 1, 2, 5], 10) == {(0, 1, 6, 2), (0, 2, 5, 0), (5, 1, 0, 0), (5, 2, 6, 0)}
    assert found(spark, [], [0], 10) == set()
    assert found(spark, [(0, [1.0], 0)], [0], 10) == set()


def test_one_query_block_is_held_at_a_time(spark, monkeypatch):
    done = []
    monkeypatch.setattr(maxscore, "staged", lambda df, label, real=maxscore.staged: done.append(label) or real(df, label))
    rows = spark.createDataFrame([(i, [i, 1]) for i in range(7)], "vec_id long, vector array<long>")
    assert maxscore.top_k(rows, rows, 2, query_block=3).count() == 14
    assert done == ["hits"] * 3

import random

from gridmart.llm import decontaminate as d

DOCS = "doc_id long, text string, hit_items string"
ITEMS = "item_id long, text string"


def plain(text, items, window):
    hit, found = set(), set()
    for item, words in items:
        k = min(window, len(words))
        wins = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
        for i in range(len(text) - k + 1):
            if tuple(text[i : i + k]) in wins:
                hit.update(range(i, i + k))
                found.add(item)
    return hit, found


def test_automaton_equals_all_windows():
    draw = random.Random(5)
    for _ in range(150):
        words = [bytes([97 + draw.randrange(3)]) for _ in range(400)]
        items = [(i, words[a : a + draw.randint(0, 9)]) for i, a in enumerate(draw.sample(range(380), 5))]
        text = draw.choices([b"a", b"b", b"c", b"d"], weights=[3, 3, 3, 1], k=60)
        window = draw.randint(2, 6)
        spans, found = d.Matcher(items, window).match(text)
        assert ({i for a, b in spans for i in range(a, b)}, found) == plain(text, items, window)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_rows_in_every_state(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    items = [(1, passage), (1, passage), (2, "two words"), (3, ""), (4, None), (None, "never found here")]
    docs = [
        (1, f"Before. {passage.upper()}, after", "x"),
        (2, None, "x"),
        (3, "", "x"),
        (4, "two-words; never found here", "x"),
        (4, "two-words; never found here", "x"),
        (5, "clean " * 50_000, "x"),
        (None, passage, "x"),
    ]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    rows = d.find_spans(frame, bench).collect()
    got = [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["hit_spans"]), r["hit_items"]) for r in rows]
    expected = [(1, 14, 12, [1]), (2, 0, 0, []), (3, 0, 0, []), *[(4, 5, 2, [2])] * 2, (5, 50_000, 0, []), (None, 12, 12, [1])]
    assert sorted(got, key=str) == sorted(expected, key=str)
    left = d.decontaminate(frame, bench, coverage=0.9)
    assert left.columns == frame.columns
    texts = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert texts == sorted(
        [(1, "Before. , after"), (2, None), (3, ""), *[(4, "; never found here")] * 2, (5, "clean " * 50_000)], key=str
    )
    assert d.find_spans(frame.limit(0), bench).count() == 0
    assert {len(r["hit_items"]) for r in d.find_spans(frame, bench.limit(0)).collect()} == {0}


def test_parts_of_a_large_benchmark_find_the_same(spark, monkeypatch):
    items = [(i, " ".join(f"w{i + k}" for k in range(14))) for i in range(30)]
    docs = [(i, " ".join(f"w{i + k}" for k in range(25)), "") for i in range(30)]
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    whole = sorted(map(str, d.find_spans(frame, bench).collect()))
    monkeypatch.setattr(d.load_items, "__defaults__", (100,))
    assert len(d.load_items(bench)) > 3
    assert sorted(map(str, d.find_spans(frame, bench).collect())) == whole

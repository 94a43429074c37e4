import itertools

import numpy as np

from gridmart.llm import language

ENGLISH = ["the cat sat with the dog by the house", "this is the way to the house of the king", "with what they thought of it"]
GERMAN = ["der hund schläft nicht im großen haus", "das ist nicht der weg zum schloss", "ich möchte nicht schlafen"]
ROWS = [(t, "en") for t in ENGLISH] + [(t, "de") for t in GERMAN]
SCHEMA = "doc_id long, text string, lang string, score string"


def test_forward_backward_equals_all_paths():
    draw = np.random.default_rng(1)
    start, move = draw.normal(size=3), draw.normal(size=(3, 3))
    lengths = np.array([5, 4, 4, 1])
    emitted = np.exp(draw.normal(size=(lengths.sum(), 3)))
    found = language.posteriors(*language.forward_backward(emitted, lengths, start, move))
    at = 0
    for n in lengths:
        expected = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(start[path[0]] + sum(move[a, b] for a, b in zip(path, path[1:])))
            weight *= np.prod([emitted[at + k, y] for k, y in enumerate(path)])
            for k, y in enumerate(path):
                expected[k, y] += weight
        np.testing.assert_allclose(found[at : at + n], expected / expected.sum(1, keepdims=True))
        at += n


def test_words_of_switched_code_get_their_language():
    chain = language.train(ROWS * 4)
    words = language.split_words("the house with the dog das ist nicht der weg")
    emitted = np.exp(chain.emissions(words)).astype(float)
    belief = language.posteriors(*language.forward_backward(emitted, np.array([len(words)]), chain.start, chain.move))
    assert [chain.languages[k] for k in belief.argmax(1)] == ["en"] * 5 + ["de"] * 5
    assert np.diag(chain.move).mean() > chain.move.mean()


def test_rows_in_every_state(spark):
    chain = language.train(ROWS)
    rows = [
        (1, "the dog", "x", "y"),
        (1, "the dog", "x", "y"),
        (2, None, None, None),
        (3, "", None, None),
        (4, "12 34 ²!?", None, None),
        (5, "nicht schlafen " * 20_000, None, None),
        (None, "w" * 100_000, None, None),
    ]
    found = language.identify(spark.createDataFrame(rows, SCHEMA), chain)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert [got[k][0] for k in (1, 2, 3, 4, 5)] == ["en", "und", "und", "und", "de"]
    assert all(0 <= s <= 1 for _, s in got.values()) and got[2][1] == 0
    assert found.count() == len(rows)
    assert language.identify(spark.createDataFrame([], SCHEMA), chain).count() == 0
    unknown = language.identify(spark.createDataFrame(rows, SCHEMA), language.train([]))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}
    assert language.sample(spark.createDataFrame([(1, None, "en", ""), (2, "a b", None, "")], SCHEMA)) == []


def test_held_out_accuracy(spark):
    from gridmart.llm.queries import op6_language_field

    folder = "/root/testdata/sf0.001"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = op6_language_field(spark, folder).filter("held_out").join(truth, "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95


def test_sample_is_bounded_whatever_the_size(spark):
    rows = spark.range(3000).selectExpr("id as doc_id", "concat('the text ', id) as text", "'en' as lang")
    held = language.sample(rows, texts=40, chars=6)
    assert 20 <= len(held) <= 40 and all(len(t) <= 6 for t, _ in held)
    assert held == language.sample(rows.repartition(5), texts=40, chars=6)


def test_every_language_is_drawn_and_repeats_count_once(spark):
    rows = spark.range(20_000).selectExpr(
        "id as doc_id",
        "if(id % 10000 = 7, concat('rara lingua ', id), if(id % 2 = 0, 'hot text', concat('the text ', id))) as text",
        "if(id % 10000 = 7, 'xx', 'en') as lang",
    )
    held = language.sample(rows, texts=40)
    assert sum(lang == "xx" for _, lang in held) == 2
    english = [t for t, lang in held if lang == "en"]
    assert len(english) == len(set(english)) == language.LEAST_TEXTS
    assert "xx" in language.train(held).languages


def test_all_letters_of_a_long_run_are_read():
    middle = "".join(chr(0x4E00 + k) for k in range(100))
    pieces = language.split_words(f"a{middle}b der")
    assert "".join(pieces) == f"a{middle}bder" and max(map(len, pieces)) <= language.WIDTH
    assert len(pieces) == 6

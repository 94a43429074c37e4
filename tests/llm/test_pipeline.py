"""The pipeline against the same stages in plain Python, each over all that the one before has kept."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import test_decontaminate
import test_lines
import test_minhash
from tokenizers import Tokenizer

import corpus_pipeline
from gridmart.llm import decontaminate, language, lines

FOLDER = "/root/testdata/sf0.001"


def main_language(chain, text):
    """Share of the most expected language, by products of probabilities word after word."""
    words = language.split_words(text or "")
    if not words:
        return 0.0
    seen, move = np.exp(chain.emissions(words).astype(float)), np.exp(chain.move - chain.move.max())
    forward, backward = [np.exp(chain.start - chain.start.max()) * seen[0]], [np.ones(len(chain.start))]
    for k in range(1, len(words)):
        forward.append((forward[-1] / forward[-1].sum()) @ move * seen[k])
        onward = move @ (seen[-k] * backward[-1])
        backward.append(onward / onward.sum())
    both = np.array(forward) * np.array(backward[::-1])
    return (both / both.sum(1, keepdims=True)).mean(0).max()


def plain(docs, chain, items):
    docs = {d: t for d, t in docs.items() if main_language(chain, t) >= corpus_pipeline.LEAST_LANGUAGE_SHARE}
    cut = test_lines.plain(list(docs.items()), lines.MIN_CHARS, 1)
    docs = {
        d: t
        for d, t in cut.items()
        if t == docs[d] or any(len(line) >= lines.MIN_CHARS for line in t.split("\n"))
    }
    docs = {d: docs[d] for d, _, _, kept in test_minhash.plain(list(docs.items()), 5, 80) if kept}
    out = {}
    for d, text in docs.items():
        words = decontaminate.words(text.encode())
        hit, _ = test_decontaminate.plain(words, items, decontaminate.WINDOW)
        if 2 * len(hit) <= len(words):
            spans = []
            for at in sorted(hit):
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + 1)
                else:
                    spans.append((at, at + 1))
            out[d] = decontaminate.remove_words(text, spans)
    return out


def test_run_equals_plain_python(spark):
    rows = corpus_pipeline.read(spark, FOLDER, "documents")
    chain = language.train(language.sample(rows))
    bench = corpus_pipeline.read(spark, FOLDER, "benchmark").collect()
    items = [(r["item_id"], decontaminate.words(r["text"].encode())) for r in bench]
    texts = plain({r["doc_id"]: r["text"] for r in rows.collect()}, chain, items)
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {d: len(known.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    found = corpus_pipeline.run(spark, FOLDER).collect()
    held = Counter()
    for r in found:
        held[r["doc_id"]] += r["length"]
    assert held == lengths
    filled = Counter()
    for r in found:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and len(filled) <= 1.05 * sum(filled.values()) / 2048 + 1


def test_rows_in_every_state(spark):
    long = " ".join(f"the cat number {i} sat with the dog by the house" for i in range(40))
    rows = [
        (1, long, "en", "a", 5),
        (1, long, "en", "a", 5),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, "12 !!", "de", "b", 5),
        (None, long + " once more", "en", "a", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, FOLDER), name)
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    # the text without an id comes first, and the others are near to it
    assert docs.select("doc_id").collect() == [(None,)]
    assert corpus_pipeline.pack(spark, docs, FOLDER).count() == 1


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentences(draw, n):
    words = "the of and to in that was for with on at by from as his her this not but are or had have one".split()
    return ["".join(f"{w} " for w in draw.choices(words, k=9)) + f"item {draw.randrange(10**9)}." for _ in range(n)]


def test_texts_that_share_an_id_stay(spark):
    draw = random.Random(1)
    texts = [" ".join(sentences(draw, 12)) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[1] + " More."), (None, texts[2]), (None, texts[0] + " End.")]
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], DOCS)
    found = corpus_pipeline.dedup_documents(spark, docs, FOLDER)
    assert found.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    assert kept == sorted([(None, texts[2]), (None, texts[0] + " End."), (1, texts[1])], key=str)


def test_near_copies_do_not_come_through(spark):
    """Planted near copies, in one line and in many: where each of them ends, and that nine in ten go.

    Of a copy in lines the line stage takes the lines that stand before, so that it is caught if
    it goes or if at most a fifth of it is left.
    """
    draw = random.Random(2)
    rows, copies = [], {}
    for k in range(40):
        parts = sentences(draw, 20)
        rows.append((1000 + k, parts, k % 2))
        for c in range(2):
            near = list(parts)
            at = draw.randrange(20)
            near[at] = near[at].replace("item", "product")
            copies[2000 + 10 * k + c] = len("".join(near))
            rows.append((2000 + 10 * k + c, near, k % 2))
    docs = spark.createDataFrame([(d, ("\n" if many else " ").join(t), "en", "a", 1) for d, t, many in rows], DOCS)
    gone, left = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = corpus_pipeline.staged(stage(spark, left, FOLDER), name)
        held = {r["doc_id"]: len(r["text"]) for r in left.collect()}
        for d, size in copies.items():
            if d not in gone and held.get(d, 0) <= size / 5:
                gone[d] = name
    where = Counter(gone.values())
    assert where["line_dedup"] == 40 and where["near_dedup"] >= 36, where
    assert all(1000 + k in held for k in range(40))

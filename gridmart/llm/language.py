"""Language identification by a linear-chain conditional random field.

Every word of a text gets a language: affix, n-gram and lexicon features score the word, learned
transitions score how languages follow one another, and forward-backward gives each word's
posterior. A text's language is the one with the largest expected share of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bounds of the training sample: texts, and characters of each from a place drawn by hash.
SAMPLE_TEXTS = 2400
SAMPLE_CHARS = 1200
#: Texts that each of many languages may give at least.
LEAST_TEXTS = 100
#: Shape of the model: hashed features, longest n-gram, longest word; longer runs of letters are several.
BUCKETS = 1 << 15
GRAMS = 4
WIDTH = 24
#: A word this frequent in a language's sample is in that language's lexicon.
LEXICON_COUNT = 3
EPOCHS = 4
#: Texts handled at once by a task, in bytes and in words; words whose scores a task remembers.
SLICE_BYTES = 8 << 20
CHAIN_WORDS = 300_000
REMEMBERED = 400_000
UNKNOWN = "und"

_WORD = re.compile(rf"[^\W\d_]{{1,{WIDTH}}}").findall


def split_words(text: str) -> list[str]:
    """Lower-cased runs of letters, longer ones in pieces of ``WIDTH``; none where the text has no letter."""
    found = _WORD(text.lower())
    return found if any(any(map(str.isalpha, w)) for w in found) else []


def _features(words: list[str], lexicon: dict[str, int]) -> np.ndarray:
    """(words, features) bucket numbers; 0 stands for no feature.

    n-grams of the word between its marks: those that hold a mark are its affixes.
    """
    n = len(words)
    chars = np.zeros((n, WIDTH + 2), np.uint32)
    chars[:, 1:-1] = np.array(words, f"U{WIDTH}").view(np.uint32).reshape(n, WIDTH)
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars[:, 0] = 2
    chars[np.arange(n), lengths + 1] = 3
    columns = []
    whole = np.zeros(n, np.uint32)
    for k in range(WIDTH + 2):
        whole = (whole ^ chars[:, k]) * np.uint32(0x01000193)
    for size in range(1, GRAMS + 1):
        code = np.full((n, WIDTH + 3 - size), size, np.uint32)
        for k in range(size):
            code = (code ^ chars[:, k : WIDTH + 3 - size + k]) * np.uint32(0x9E3779B1)
            code ^= code >> np.uint32(15)
        inside = np.arange(WIDTH + 3 - size) + size <= lengths[:, None] + 2
        columns.append(np.where(inside, 1 + code % np.uint32(BUCKETS - 1), 0))
    columns.append((1 + (whole ^ (whole >> np.uint32(13))) % np.uint32(BUCKETS - 1))[:, None])
    said = np.fromiter((lexicon.get(w, 0) for w in words), np.uint32, n)
    known = (said * np.uint32(0x85EBCA6B)) ^ np.uint32(0x5BD1E995)
    columns.append(np.where(said > 0, 1 + (known ^ (known >> np.uint32(16))) % np.uint32(BUCKETS - 1), 0)[:, None])
    return np.concatenate(columns, 1).astype(np.int32)


@dataclass
class Chain:
    """The trained field: languages, feature weights, start and transition scores, lexicon."""

    languages: list[str]
    weights: np.ndarray
    start: np.ndarray
    move: np.ndarray
    lexicon: dict[str, int]

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each language for each word, largest 0."""
        out = np.empty((len(words), len(self.languages)), np.float32)
        for at in range(0, len(words), 4096):
            scores = self.weights[_features(words[at : at + 4096], self.lexicon)].sum(1)
            out[at : at + 4096] = scores - scores.max(1, keepdims=True)
        return out


def forward_backward(
    emitted: np.ndarray, lengths: np.ndarray, start: np.ndarray, move: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward scores of each word, for sequences that lie one behind the other.

    ``emitted`` holds exp(score) by word, ``lengths`` falls. One step handles the k-th word of
    every sequence that is long enough, scaled so that nothing under- or overflows.
    """
    begin = np.cumsum(lengths) - lengths
    forward, backward = np.empty(emitted.shape), np.ones(emitted.shape)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")
    state = np.exp(start - start.max()) * emitted[begin]
    to = np.exp(move - move.max())
    for k in range(longest):
        rows = begin[: active[k]] + k
        if k:
            state = (state[: active[k]] @ to) * emitted[rows]
        state = state / state.sum(1, keepdims=True)
        forward[rows] = state
    back = np.ones((len(lengths), emitted.shape[1]))
    for k in range(longest - 2, -1, -1):
        n = active[k + 1]
        rows = begin[:n] + k
        step = (back[:n] * emitted[rows + 1]) @ to.T
        back[:n] = backward[rows] = step / step.sum(1, keepdims=True)
    return forward, backward


def posteriors(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    belief = forward * backward
    return belief / belief.sum(1, keepdims=True)


def _sequences(texts: list[tuple[list[str], int]], rng: np.random.Generator) -> Iterator[tuple[list[str], list[int]]]:
    """Training sequences of several runs of words, each from another text: code is switched in them."""
    runs = []
    for words, label in texts:
        at = 0
        while at < len(words):
            size = int(rng.integers(6, 40))
            runs.append((words[at : at + size], label))
            at += size
    order = rng.permutation(len(runs))
    at = 0
    while at < len(order):
        parts = [runs[i] for i in order[at : at + int(rng.integers(1, 4))]]
        at += len(parts)
        yield [w for ws, _ in parts for w in ws], [y for ws, y in parts for _ in ws]


def train(rows: list[tuple[str, str]], seed: int = 7) -> Chain:
    """Fits a chain to (text, language) rows by gradient steps on the conditional likelihood."""
    texts = [(split_words(t), lang) for t, lang in dict(sorted(rows)).items()]
    languages = sorted({lang for words, lang in texts if words})
    number = {lang: k for k, lang in enumerate(languages)}
    count = [Counter() for _ in languages]
    for words, lang in texts:
        if words:
            count[number[lang]].update(words)
    lexicon: dict[str, int] = {}
    for k, seen in enumerate(count):
        for word, n in seen.items():
            if n >= LEXICON_COUNT:
                lexicon[word] = lexicon.get(word, 0) | 1 << (k % 30)
    labels = len(languages)
    weights = np.zeros((BUCKETS, labels), np.float32)
    start, move = np.zeros(labels), np.zeros((labels, labels))
    chain = Chain(languages, weights, start, move, lexicon)
    if labels < 2:
        return chain
    rng = np.random.default_rng(seed)
    vocabulary = sorted({w for words, _ in texts for w in words})
    row = {w: k for k, w in enumerate(vocabulary)}
    features = np.concatenate([_features(vocabulary[k : k + 4096], lexicon) for k in range(0, len(vocabulary), 4096)])
    grown, grown_move, grown_start = np.full(weights.shape, 1e-2), np.full(move.shape, 1e-2), np.full(labels, 1e-2)
    known = [(words, number[lang]) for words, lang in texts if words]
    for _ in range(EPOCHS):
        made = list(_sequences(known, rng))
        for at in range(0, len(made), 96):
            batch = sorted(made[at : at + 96], key=lambda s: -len(s[0]))
            lengths = np.array([len(w) for w, _ in batch])
            used = features[[row[w] for ws, _ in batch for w in ws]]
            truth = np.array([y for _, ys in batch for y in ys])
            scores = weights[used].sum(1, dtype=np.float64)
            emitted = np.exp(scores - scores.max(1, keepdims=True))
            forward, backward = forward_backward(emitted, lengths, start, move)
            belief = posteriors(forward, backward)
            error = belief.copy()
            error[np.arange(len(truth)), truth] -= 1
            error /= len(batch)
            flat = used.ravel()
            slope = np.stack(
                [np.bincount(flat, np.repeat(error[:, y], used.shape[1]), BUCKETS) for y in range(labels)], 1
            )
            slope[0] = 0
            grown += slope**2
            weights -= (0.1 * slope / np.sqrt(grown)).astype(np.float32)
            begin = np.cumsum(lengths) - lengths
            inner = np.setdiff1d(np.arange(len(truth)), begin)
            seen = np.zeros(move.shape)
            np.add.at(seen, (truth[inner - 1], truth[inner]), 1.0)
            slope_move = (_pairs(forward, emitted * backward, inner, move) - seen) / len(batch)
            slope_start = (belief[begin].sum(0) - np.bincount(truth[begin], minlength=labels)) / len(batch)
            grown_move += slope_move**2
            grown_start += slope_start**2
            move -= 0.1 * slope_move / np.sqrt(grown_move)
            start -= 0.1 * slope_start / np.sqrt(grown_start)
    return chain


def _pairs(forward: np.ndarray, onward: np.ndarray, inner: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Expected numbers of transitions into the words ``inner``."""
    joint = forward[inner - 1][:, :, None] * np.exp(move - move.max()) * onward[inner][:, None, :]
    return (joint / joint.sum((1, 2), keepdims=True)).sum(0)


def sample(rows: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """Labelled rows (text, lang): of each language equally many different texts at most, ``texts``
    in all but at least ``LEAST_TEXTS`` a language, drawn by a hash of the text; of each at most
    ``chars`` characters from a place drawn likewise."""
    drawn = F.xxhash64(F.lit("language"), "text")
    spare = F.greatest(F.length("text") - chars, F.lit(0)) + 1
    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", drawn.alias("drawn"))
    held = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.approx_count_distinct("drawn").alias("n")).collect()}
    if not held:
        return []
    each = max(LEAST_TEXTS, texts // len(held)) if len(held) > 1 else texts
    # a share of a language's texts that leaves several times what is wanted, so that few are sorted
    below = [(lang, int(min(1.0, 4 * each / max(1, n)) * (1 << 40))) for lang, n in held.items()]
    shares = rows.sparkSession.createDataFrame(below, "lang string, below long")
    usable = usable.join(F.broadcast(shares), "lang").filter(F.pmod("drawn", F.lit(1 << 40)) < F.col("below"))
    part = F.substring("text", (F.pmod("drawn", spare) + 1).cast("int"), F.lit(chars))
    parts = usable.select("lang", "drawn", part.alias("text")).dropDuplicates(["lang", "drawn"])
    numbered = parts.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("drawn", "text")))
    found = numbered.filter(F.col("k") <= each).orderBy("lang", "k").collect()
    return [(r["text"], r["lang"]) for r in found]


_FOUND = {"lang_pred": pa.string(), "score": pa.float64()}


def identify(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with lang_pred and score; all other columns stay, older ones of these names go.

    ``score`` is the expected share of the text's words in that language. Null texts and texts
    without a letter are ``und`` with score 0, as all are when the chain knows no language.
    """
    kept = docs.drop(*_FOUND)
    sent = docs.sparkSession.sparkContext.broadcast(chain)
    schema = kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(sent.value)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                languages, scores = scorer.score(part["text"])
                columns = [*part.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *_FOUND])

    return kept.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``limit`` bytes of text, or numbers of a list, a row at least."""
    import pyarrow.compute as pc

    length = pc.list_value_length if pa.types.is_list(batch[column].type) else pc.binary_length
    sizes = pc.fill_null(length(batch[column]), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


class _Scorer:
    """Scores texts and remembers the words it has met."""

    def __init__(self, chain: Chain):
        self.chain = chain
        self.row: dict[str, int] = {}
        self.table = np.empty((0, len(chain.languages)), np.float32)

    def _rows(self, words: list[str]) -> np.ndarray:
        row = self.row
        return np.fromiter((row.setdefault(w, len(row)) for w in words), np.int32, len(words))

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        languages = self.chain.languages
        if not languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        if len(self.row) > REMEMBERED:
            self.row, self.table = {}, self.table[:0]
        chains = [self._rows(split_words(t.as_py() or "")) for t in texts]
        if len(self.row) > len(self.table):
            new = list(self.row)[len(self.table) :]
            self.table = np.concatenate([self.table, np.exp(self.chain.emissions(new))])
        best, scores = [UNKNOWN] * len(chains), np.zeros(len(chains))
        lengths = np.array([len(c) for c in chains], np.int64)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        at = 0
        while at < len(order):
            total = np.cumsum(lengths[order[at:]])
            end = at + max(1, int(np.searchsorted(total, CHAIN_WORDS, side="right")))
            rows = order[at:end]
            emitted = self.table[np.concatenate([chains[i] for i in rows])].astype(np.float64)
            belief = posteriors(*forward_backward(emitted, lengths[rows], self.chain.start, self.chain.move))
            share = np.add.reduceat(belief, np.cumsum(lengths[rows]) - lengths[rows]) / lengths[rows][:, None]
            for i, k, s in zip(rows.tolist(), share.argmax(1).tolist(), share.max(1).tolist(), strict=True):
                best[i], scores[i] = languages[k], min(1.0, s)
            at = end
        return best, scores

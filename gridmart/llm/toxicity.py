"""Toxicity by the nearest labelled examples.

Labelled texts are an index of TF-IDF vectors over the terms that tell their classes apart. A text's
nearest examples by exact cosine are found block by block: the largest weight of each term in a
block of examples bounds the block's cosines, and blocks that cannot reach the current k-th best are
never opened. Neighbours vote by cosine; votes of the examples themselves, each left out of its own
neighbours, calibrate votes to probabilities.

Texts without such a term are compared by all their words, with the same examples and a calibration
of their own, so that a rare word no test can tell apart still leads to the examples that have it.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.decontaminate import words
from gridmart.llm.language import slices

#: Bound of the labelled sample: examples of either class, and bytes of an example's text.
EXAMPLES_PER_CLASS = 3000
EXAMPLE_BYTES = 200_000
#: Terms need this many examples; the chance that any term is taken by accident is at most this.
TERM_EXAMPLES = 3
TERM_CHANCE = 0.01
#: Word beginnings that count as terms beside the words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A term met this often in a text, or in at least this share of its words, counts once more each.
GRADES = (2, 4)
SHARES = (0.002, 0.01)
NEIGHBOURS = 15
#: Without a class-telling term cosines vote by this power: what is close decides.
PLAIN_POWER = 4
#: Words of this share of the examples are read as whole rows, not as postings.
FREQUENT = 0.25
#: Words that search reads first, twice as many each time.
FIRST_WORDS = 32
BLOCK = 64
SLICE_BYTES = 8 << 20
REMEMBERED = 300_000


def terms(word: bytes) -> list[bytes]:
    """The word and, marked, its beginnings."""
    return [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)]


def graded(counts: dict[int, int], length: int) -> list[int]:
    """Dimensions of the vector of a text of ``length`` words: each term, and its grades."""
    each = 1 + len(GRADES) + len(SHARES)
    out = []
    for term, n in counts.items():
        out.append(term * each)
        out += [term * each + 1 + k for k, grade in enumerate(GRADES) if n >= grade]
        out += [term * each + 1 + len(GRADES) + k for k, share in enumerate(SHARES) if n >= share * length]
    return sorted(out)


def spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from each begin up to its end, in order, and how many each gives."""
    sizes = end - begin
    upto = np.cumsum(sizes)
    return np.repeat(begin - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0), sizes


def _nearest(found: np.ndarray) -> np.ndarray:
    """Rows of the largest positive values, ties to the smaller row."""
    near = found.round(12)
    rows = np.flatnonzero(found > 0)
    if len(rows) > NEIGHBOURS:
        rows = rows[near[rows] >= np.partition(near[rows], -NEIGHBOURS)[-NEIGHBOURS]]
    return rows[np.lexsort((rows, -near[rows]))][:NEIGHBOURS]


def _rest(values: np.ndarray) -> np.ndarray:
    """Sums from each place to the end."""
    return np.cumsum(values[::-1])[::-1]


def gathered(begin, end, weights, rows: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of several posting lists, one list behind the other, and what each posting adds."""
    place, sizes = spans(begin, end)
    return rows[place], np.repeat(weights, sizes) * own[place]


@dataclass
class Plain:
    """All words of the examples by TF-IDF, as postings by word and as vectors by example."""

    words: dict[bytes, int] = field(default_factory=dict)
    idf: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: Postings of word w: places ``starts[w]`` to ``starts[w + 1]``; its largest weight.
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    largest: np.ndarray = field(default_factory=lambda: np.empty(0))
    vectors: list = field(default_factory=list)
    #: The vectors one behind the other: words and weights of example r are at ``vector_starts[r]`` on.
    vector_starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    vector_words: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    vector_weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: Words of at least a share ``FREQUENT`` of the examples: their row in ``head``, a column an
    #: example; -1 for the others.
    head_of: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    head: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    #: A text's weights by word while it is compared, else zeros.
    query: np.ndarray | None = None

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """Words of the examples in a text, and weights of unit length over them."""
        places = list(map(self.words.get, counts, repeat(-1)))
        return self.weighed(np.array(places, np.int64), np.fromiter(counts.values(), float, len(counts)))

    @property
    def mean_words(self) -> float:
        return len(self.vector_words) / max(1, len(self.vectors))

    def weighed(self, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of words' places in the index, -1 for others, and how often they come."""
        known = np.flatnonzero(places >= 0)
        known = known[np.argsort(places[known])]
        at = places[known]
        weights = self.idf[at] * (1 + np.log(counts[known]))
        return at, weights / np.sqrt((weights**2).sum() or 1.0)

    def nearest(self, at: np.ndarray, weights: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the nearest examples that share a word; ties to the smaller row.

        Words are read by the most they can give; once few examples can still be among the
        nearest by what is unread, these alone are compared in full.
        """
        head = self.head_of[at]
        frequent, rare = np.flatnonzero(head >= 0), np.flatnonzero(head < 0)
        most = weights * self.largest[at]
        order = rare[np.argsort(-most[rare], kind="stable")]
        last = np.append(most[order], most[frequent].sum()), np.append(weights[order] ** 2, (weights[frequent] ** 2).sum())
        # what unread words can still give: the sum of their most, or their length in the text's vector
        unread = np.minimum(_rest(last[0]), np.sqrt(_rest(last[1])))
        found = np.zeros(len(self.vectors))
        begin, end = self.starts[at[order]], self.starts[at[order] + 1]
        left = np.append(_rest(end - begin), 0)
        done, step = 0, FIRST_WORDS
        while done < len(order):
            some = slice(done, done + step)
            rows, given = gathered(begin[some], end[some], weights[order[some]], self.rows, self.weights)
            found += np.bincount(rows, given, len(found))
            done, step = min(done + step, len(order)), 2 * step
            # compare the examples that can still be nearest in full, where that is less to read
            if left[done] > NEIGHBOURS * self.mean_words:
                if 0 <= skip:
                    found[skip] = 0
                least = np.partition(found, -NEIGHBOURS)[-NEIGHBOURS]
                if unread[done] < least:
                    able = np.flatnonzero(found + unread[done] >= least - 1e-9)
                    if 3 * len(able) * self.mean_words < left[done]:  # reading them jumps about
                        whole = self._cosines(able, at, weights)
                        found = np.zeros(len(found))
                        found[able] = whole
                        frequent = frequent[:0]
                        break
        if len(frequent):
            text = np.zeros(len(self.head))
            text[head[frequent]] = weights[frequent]
            found += text @ self.head
        if 0 <= skip:
            found[skip] = 0
        top = _nearest(found)
        return top, found[top]

    def _cosines(self, rows: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Cosines of some examples with a text, over all their words."""
        if self.query is None:
            self.query = np.zeros(len(self.words))
        self.query[at] = weights
        begin, end = self.vector_starts[rows], self.vector_starts[rows + 1]
        place, _ = spans(begin, end)
        of_row = np.repeat(np.arange(len(rows)), end - begin)
        held = self.query[self.vector_words[place]] * self.vector_weights[place]
        self.query[at] = 0
        return np.bincount(of_row, held, len(rows))


def _plain(counted: list[Counter]) -> Plain:
    plain = Plain()
    having = Counter(w for seen in counted for w in seen)
    plain.words = {w: k for k, w in enumerate(having)}
    plain.idf = np.log((1 + len(counted)) / np.fromiter(having.values(), float, len(having)))
    plain.vectors = [plain.vector(seen) for seen in counted]
    if not having:
        return plain
    word = np.concatenate([at for at, _ in plain.vectors])
    plain.vector_starts = np.concatenate([[0], np.cumsum([len(at) for at, _ in plain.vectors])])
    plain.vector_words, plain.vector_weights = word, np.concatenate([w for _, w in plain.vectors])
    order = np.argsort(word, kind="stable")
    plain.rows = np.repeat(np.arange(len(counted)), [len(at) for at, _ in plain.vectors])[order]
    plain.weights = plain.vector_weights[order]
    plain.starts = np.searchsorted(word[order], np.arange(len(having) + 1))
    plain.largest = np.maximum.reduceat(plain.weights, plain.starts[:-1])
    sizes = np.diff(plain.starts)
    often = np.flatnonzero(sizes >= FREQUENT * len(counted))
    plain.head_of = np.full(len(sizes), -1, np.int64)
    plain.head_of[often] = np.arange(len(often))
    plain.head = np.zeros((len(often), len(counted)))
    for k, w in enumerate(often.tolist()):
        held = slice(plain.starts[w], plain.starts[w + 1])
        plain.head[k, plain.rows[held]] = plain.weights[held]
    return plain


@dataclass
class Index:
    """Labelled examples as postings in blocks, with the largest weight of each term and block."""

    terms: dict[bytes, int] = field(default_factory=dict)
    #: How the terms begin: a word that begins otherwise has none.
    heads: set[bytes] = field(default_factory=set)
    idf: np.ndarray = field(default_factory=lambda: np.empty(0))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    vote: np.ndarray = field(default_factory=lambda: np.empty(0))
    #: Postings of term t in block b: places ``starts[t, b]`` to ``starts[t, b + 1]``.
    starts: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    largest: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    #: Probability where no example has a term in common, and the calibration's steps.
    base: float = 0.0
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))
    #: The same for texts without a class-telling term, by all words.
    plain: Plain = field(default_factory=Plain)
    plain_steps: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def read(self, word: bytes) -> int:
        """The strongest term of a word, -1 if it has none."""
        if word[: BEGINNINGS[0]] not in self.heads:
            return -1
        return min((self.terms[t] for t in terms(word) if t in self.terms), default=-1)

    def vector(self, dimensions: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Dimensions and weights of unit length, of dimensions that examples have."""
        at = np.array([d for d in dimensions if self.idf[d] > 0], np.int64)
        weights = self.idf[at]
        return at, weights / np.sqrt((weights**2).sum())

    def nearest(self, at: np.ndarray, weights: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the nearest examples that share a term; ties to the smaller row."""
        bound = weights @ self.largest[at]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        found = np.zeros(len(self.ids))
        best_rows = np.empty(0, np.int64)
        done, step = 0, 4
        while done < len(order):
            # blocks are opened in chunks, the postings of all terms in them at once
            blocks = order[done : done + step]
            begin, end = self.starts[at[:, None], blocks], self.starts[at[:, None], blocks + 1]
            each = np.repeat(weights, len(blocks))
            found += np.bincount(*gathered(begin.ravel(), end.ravel(), each, self.rows, self.weights), len(found))
            done, step = done + step, 2 * step
            if 0 <= skip:
                found[skip] = 0
            best_rows = _nearest(found)
            if done < len(order) and len(best_rows) == NEIGHBOURS and bound[order[done]] + 1e-12 < found[best_rows[-1]]:
                break
        return best_rows, found[best_rows]

    def votes(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Share of the neighbours' votes for toxic, each by its cosine and its class's weight.

        One more vote goes to the base, so that a few distant neighbours do not decide alone.
        """
        by = cosines * self.vote[rows]
        return float((by @ self.toxic[rows] + 0.5 * self.base) / (by.sum() + 0.5))

    def plain_votes(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """The same by all words; the classes' weights are left to the calibration, so that a copy
        of an example of a rare class is still found."""
        by = cosines**PLAIN_POWER
        return float((by @ self.toxic[rows] + 0.5 * self.base) / (by.sum() + 0.5))

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, *self.steps))


def build(examples: list[tuple[int, bytes, int]], totals: dict[int, int]) -> Index:
    """An index of (id, text, label) rows, of which there are ``totals`` by label in all.

    Equal texts are one example, with the smallest id and the most frequent label.
    """
    labels: dict[bytes, list[tuple[int, int]]] = {}
    for row_id, text, label in examples:
        labels.setdefault(text, []).append((row_id, label))
    rows = sorted(
        (min(i for i, _ in seen), text, int(2 * sum(y for _, y in seen) > len(seen))) for text, seen in labels.items()
    )
    index = Index()
    index.ids = np.array([i for i, _, _ in rows], np.int64)
    index.toxic = np.array([y for _, _, y in rows], float)
    drawn = np.bincount(index.toxic.astype(int), minlength=2)
    whole = np.array([totals.get(0, 0), totals.get(1, 0)], float)
    ratio = np.divide(whole, drawn, out=np.zeros(2), where=drawn > 0)
    index.vote = ratio[index.toxic.astype(int)] / max(ratio.max(), 1e-300) if len(rows) else index.toxic
    share = whole[1] / whole.sum() if whole.sum() else 0.0
    index.base = float(share)
    counted = [Counter(words(text)) for _, text, _ in rows]
    _select(index, counted, drawn)
    each = 1 + len(GRADES) + len(SHARES)
    held = []
    for seen in counted:
        found: Counter = Counter()
        for word, n in seen.items():
            if (term := index.read(word)) >= 0:
                found[term] += n
        held.append(graded(found, seen.total()))
    having = np.bincount([d for ds in held for d in ds], minlength=each * len(index.terms))
    index.idf = np.where(having > 0, np.log((1 + len(rows)) / np.maximum(having, 0.5)), 0.0)
    vectors = [index.vector(ds) if ds else None for ds in held]
    _post(index, vectors)
    _calibrate(index, vectors)
    index.plain = _plain(counted)
    _calibrate_plain(index, vectors)
    return index


def _select(index: Index, counted: list[Counter], drawn: np.ndarray) -> None:
    """Terms whose presence depends on the class, the strongest first.

    A word counts for its strongest term alone: what a chosen term explains is taken from the
    weaker ones before they are weighed again.
    """
    n, toxic = len(counted), float(drawn[1])
    if not 0 < toxic < n:
        return

    share = toxic / n

    def chi2(df: int, a: int) -> float:
        """Chi-square; 0 where as uneven a draw of ``df`` examples is not rare enough, by the
        bound of Chernoff and Hoeffding, which holds for small counts too."""
        if df < TERM_EXAMPLES or df == n:
            return 0.0
        b, c, d = df - a, toxic - a, n - toxic - (df - a)
        rare = sum(k * log(k / (df * p)) for k, p in ((a, share), (b, 1 - share)) if k)
        if rare < needed:
            return 0.0
        return n * (a * d - b * c) ** 2 / (toxic * (n - toxic) * df * (n - df))

    with_term, toxic_with = Counter(), Counter()
    of_word: dict[bytes, list[bytes]] = {}
    for seen, y in zip(counted, index.toxic, strict=True):
        held: set[bytes] = set()
        for word in seen:
            if word not in of_word:
                of_word[word] = terms(word)
            held.update(of_word[word])
        with_term.update(held)
        if y:
            toxic_with.update(held)
    # two sides of every term that could be taken
    needed = log(2 * max(1, sum(df >= TERM_EXAMPLES for df in with_term.values())) / TERM_CHANCE)
    strong = {t for t, df in with_term.items() if chi2(df, toxic_with[t]) > 0}
    del with_term
    having: dict[bytes, set[int]] = {}
    for row, seen in enumerate(counted):
        for word in seen:
            if not strong.isdisjoint(of_word[word]):
                having.setdefault(word, set()).add(row)
    of_term: dict[bytes, list[bytes]] = {}
    for word in having:
        for term in strong.intersection(of_word[word]):
            of_term.setdefault(term, []).append(word)
    toxic_rows = {r for r, y in enumerate(index.toxic) if y}
    taken: set[bytes] = set()

    def strength(term: bytes) -> float:
        rows = set().union(*(having[w] for w in of_term[term] if w not in taken))
        return chi2(len(rows), len(rows & toxic_rows))

    waiting = [(-s, t) for t in of_term if (s := strength(t)) > 0]
    heapq.heapify(waiting)
    while waiting:
        before, term = heapq.heappop(waiting)
        now = strength(term)
        if now < -before:
            if now > 0:
                heapq.heappush(waiting, (-now, term))
            continue
        index.terms[term] = len(index.terms)
        index.heads.add(term.rstrip(b"*")[: BEGINNINGS[0]])
        taken.update(of_term[term])


def _post(index: Index, vectors: list) -> None:
    triples = [
        (t, r, w)
        for r, v in enumerate(vectors)
        if v is not None
        for t, w in zip(v[0].tolist(), v[1].tolist(), strict=True)
    ]
    triples.sort()
    blocks = -(-len(vectors) // BLOCK)
    of_term = np.array([t for t, _, _ in triples], np.int64)
    index.rows = np.array([r for _, r, _ in triples], np.int32)
    index.weights = np.array([w for _, _, w in triples])
    place = of_term * blocks + index.rows // BLOCK
    n = len(index.idf)
    edges = np.searchsorted(place, np.arange(n * blocks + 1))
    index.starts = np.stack([edges[k * blocks : (k + 1) * blocks + 1] for k in range(n)]) if n else index.starts
    index.largest = np.zeros((n, blocks))
    np.maximum.at(index.largest.reshape(-1), place, index.weights)


def _calibrate(index: Index, vectors: list) -> None:
    """Non-decreasing steps from votes to shares of toxic, by pooling neighbours that fall."""
    weight = index.vote
    none = np.array([v is None for v in vectors], bool)
    if none.any() and weight[none].sum():
        share = (weight * index.toxic)[none].sum() / weight[none].sum()
        index.base = float(min(share, index.base))
    said = [(index.votes(*index.nearest(*v, skip=r)), r) for r, v in enumerate(vectors) if v is not None]
    pools: list[list[float]] = []  # sum of weights, of toxic weights, of weighted votes
    for vote, r in sorted(said):
        pools.append([weight[r], weight[r] * index.toxic[r], weight[r] * vote])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    steps = [(0.0, index.base), *((v / w, y / w) for w, y, v in pools if w > 0), (1.0, 1.0)]
    index.steps = (np.array([v for v, _ in steps]), np.maximum.accumulate([y for _, y in steps]))


def _calibrate_plain(index: Index, vectors: list) -> None:
    """Steps for texts without a class-telling term, from the examples that have none either.

    A pool holds from its smallest to its largest vote; what is above all of them rises to 1.
    """
    weight, plain = index.vote, index.plain
    without = [r for r, v in enumerate(vectors) if v is None and len(plain.vectors[r][0])]
    said = sorted((index.plain_votes(*plain.nearest(*plain.vectors[r], skip=r)), r) for r in without)
    pools: list[tuple[float, float, float, float]] = []  # weights, toxic weights, smallest and largest vote
    for vote, r in said:
        pools.append((weight[r], weight[r] * index.toxic[r], vote, vote))
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            (w, y, _, high), (v, x, low, _) = pools.pop(), pools.pop()
            pools.append((v + w, x + y, low, high))
    held = [(vote, y / w) for w, y, low, high in pools if w > 0 for vote in (low, high)]
    steps = [(0.0, index.base), *held, (1.0, 1.0)]
    index.plain_steps = (np.array([v for v, _ in steps]), np.maximum.accumulate([y for _, y in steps]))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES_PER_CLASS) -> tuple[list, dict[int, int]]:
    """At most ``per_class`` rows (id, text, label) of either label, drawn by a hash of the id, and
    how many labelled ids there are of each. An id labelled both ways counts as toxic.

    A drawn example of more than ``EXAMPLE_BYTES`` bytes, or without a text, is left out.
    """
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn: list = []
    for label in sorted(totals):
        ids = known.filter(F.col("toxic") == label).withColumn("_draw", F.xxhash64(F.lit("toxic"), "doc_id"))
        # a share of the rows that leaves several times what is wanted, so that tasks send few to the driver
        share = 4 * per_class / totals[label]
        if share < 1:
            ids = ids.filter(F.pmod("_draw", F.lit(1 << 20)) < int(share * (1 << 20)))
        drawn += ids.orderBy("_draw", "doc_id").limit(per_class).select("doc_id", "toxic").collect()
    few = docs.sparkSession.createDataFrame(drawn, "doc_id long, toxic int")
    texts = docs.filter(F.octet_length("text") <= EXAMPLE_BYTES).join(F.broadcast(few), "doc_id")
    held = texts.select("doc_id", F.col("text").cast("binary").alias("text"), "toxic").collect()
    return [(r["doc_id"], bytes(r["text"]), r["toxic"]) for r in held], totals


_FOUND = {"score": pa.float64(), "evidence": pa.list_(pa.int64())}


def score(docs: DataFrame, index: Index) -> DataFrame:
    """``docs`` with score (0 to 1) and evidence, the ids of the nearest examples, nearest first.

    All other columns stay, older ones of these names go. Texts without a class-telling
    term are compared by all their words. Null and empty texts, and texts without a word of the
    examples, get the share of toxic examples among those without a term, and no evidence.
    """
    kept = docs.drop(*_FOUND)
    sent = docs.sparkSession.sparkContext.broadcast(index)
    schema = kept.withColumns({"score": F.lit(0.0), "evidence": F.array().cast("array<long>")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(sent.value)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                found = [scorer.score(t.as_py() or b"") for t in part["text"].cast(pa.large_binary())]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found), _FOUND.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *_FOUND])

    return kept.mapInArrow(run, schema)


class _Scorer:
    def __init__(self, index: Index):
        self.index = index
        #: Of words met before: one more than the strongest term, and than the place among all words,
        #: in the upper and the lower half of a number.
        self.of_word: dict[bytes, int] = {}
        self.known: dict[tuple | bytes, tuple[float, list[int]]] = {}

    def _read(self, word: bytes) -> int:
        if len(self.of_word) >= REMEMBERED:
            self.of_word.clear()
        found = (self.index.read(word) + 1 << 32) + self.index.plain.words.get(word, -1) + 1
        self.of_word[word] = found
        return found

    def score(self, text: bytes) -> tuple[float, list[int]]:
        seen = Counter(words(text))
        read = list(map(self.of_word.get, seen))
        if None in read:
            read = [self._read(word) if found is None else found for found, word in zip(read, seen, strict=True)]
        of_word = np.array(read, np.int64)
        times = np.fromiter(seen.values(), np.int64, len(seen))
        term = of_word >> 32
        counts: Counter = Counter()
        for k in np.flatnonzero(term).tolist():
            counts[int(term[k]) - 1] += int(times[k])
        length = int(times.sum())
        key = tuple(graded(counts, length)) or hashlib.blake2b(text, digest_size=16).digest()
        if key not in self.known:
            self._room()
            if counts:
                at, weights = self.index.vector(list(key))
                rows, cosines = self.index.nearest(at, weights)
                found = self.index.calibrated(self.index.votes(rows, cosines)), self.index.ids[rows].tolist()
            else:
                found = self._by_all_words((of_word & 0xFFFFFFFF) - 1, times)
            self.known[key] = found
        return self.known[key]

    def _room(self) -> None:
        if len(self.known) >= REMEMBERED:
            self.known.clear()

    def _by_all_words(self, places: np.ndarray, counts: np.ndarray) -> tuple[float, list[int]]:
        index = self.index
        at, weights = index.plain.weighed(places, counts)
        rows, cosines = index.plain.nearest(at, weights)
        if not len(rows):
            return index.base, []
        return float(np.interp(index.plain_votes(rows, cosines), *index.plain_steps)), index.ids[rows].tolist()

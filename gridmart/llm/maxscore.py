"""Exact top-k inner product search by MaxScore.

A vector is a document, a dimension a query term, a component its weight. For one query every
dimension is shifted so that no contribution is negative; the bound of a term is then its largest
shifted contribution. Terms are split by bounds: the non-essential ones together cannot lift a
vector above the score that the current k-th best holds. Essential postings are traversed;
the others are probed only for vectors still able to compete. Every task answers for its shard of
the vectors; the answers are merged by a ranked shuffle on the query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridmart.llm.common import staged

#: Queries sent to the tasks at once; more queries mean more blocks.
QUERY_BLOCK = 8192
#: Vectors that a task holds as postings at once.
SHARD_ROWS = 8192
#: Vectors scored in full to learn a first floor.
SEED_ROWS = 256
NO_FLOOR = np.iinfo(np.int64).min
#: Sums of products below this are exact in double precision.
_EXACT = 2**53
HITS = "query_id long, vec_id long, score long"
_HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, vector array<long>) with floor(scale * component), components taken as doubles.

    Vectors that are null or hold a null or non-finite component are left out; so are rows
    without vec_id. An empty vector stays: its product with any other is 0.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
    return vectors.filter(usable).select("vec_id", scaled.alias("vector"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of int64; what a shorter vector lacks is 0."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(vectors.offsets.to_numpy())
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(vectors), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def _numeric(matrix: np.ndarray, other: np.ndarray) -> type:
    """double where every sum is exact in it, else int64."""
    largest = float(np.abs(matrix).max(initial=0)) * float(np.abs(other).max(initial=0)) * matrix.shape[1]
    return np.float64 if largest < _EXACT else np.int64


class Shard:
    """Postings of some vectors: for each dimension its component in every vector, with its range."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(matrix[order].T)
        self.low = self.postings.min(axis=1)
        self.high = self.postings.max(axis=1)

    def search(self, own: int, query: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of at least the k best of this shard that reach ``floor``."""
        k += int(np.count_nonzero(self.ids == own))  # the query's own vector may be among the best
        if len(self.ids) > SEED_ROWS > k and floor == NO_FLOOR:
            seed = query @ self.postings[:, :SEED_ROWS]
            floor = np.partition(seed, SEED_ROWS - k)[SEED_ROWS - k]
        base = np.where(query > 0, self.low, self.high)
        least = query @ base
        bound = query * (np.where(query > 0, self.high, self.low) - base)
        order = np.argsort(-bound, kind="stable")
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])
        scores = np.full(len(self.ids), least, query.dtype)
        rows, done = slice(None), 0
        alive = np.arange(len(self.ids))
        while done < len(order):
            # the terms whose bounds together cannot lift a fresh vector to the floor are not essential
            essential = int(np.searchsorted(-(rest + least), -floor, side="right"))
            step = max(min(essential, len(order)), done + 8) if done == 0 else done + 8
            terms = order[done:step]
            part = self.postings[terms] if isinstance(rows, slice) else self.postings[np.ix_(terms, alive)]
            scores[alive] += query[terms] @ (part - base[terms, None])
            done = min(step, len(order))
            if len(alive) > k:  # the k-th partial score is reached by k vectors: a floor of the final k-th
                floor = max(floor, np.partition(scores[alive], len(alive) - k)[len(alive) - k])
            alive = alive[scores[alive] + rest[done] >= floor]
            rows = alive
        alive = alive[(self.ids[alive] != own) & (scores[alive] >= floor)]
        return self.ids[alive], scores[alive]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors of every query, all if there are fewer.

    ``vectors`` and ``queries`` are as :func:`integer_vectors` gives them. Ties go to the smaller
    vec_id; a query never finds its own vec_id; rows that repeat a vec_id are found once each.
    Queries are handed to the tasks in blocks of about ``query_block``, one after the other, so that
    neither the driver nor a broadcast holds more than one; rows that repeat a vec_id share a block.
    No queries or no vectors give no rows.
    """
    spark = vectors.sparkSession
    blocks = -(-queries.count() // query_block)
    hits = spark.createDataFrame([], HITS)
    numbered = queries.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))))
    for block in range(blocks):
        held = numbered.filter(F.col("_block") == block).select("vec_id", "vector").toArrow()
        sent = spark.sparkContext.broadcast(held)
        met = vectors.select("vec_id", "vector").mapInArrow(_searcher(sent, k), HITS)
        if blocks > 1:  # the next block is fetched when this one is done and gone
            met = staged(met, "hits")
            sent.destroy()
        hits = hits.union(met)
    ranked = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    found = hits.withColumn("rank", ranked).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= SHARD_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _searcher(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value.combine_chunks()
        if not asked.num_rows:
            return
        query_ids = asked["vec_id"].to_numpy()
        query_rows = _matrix(asked["vector"].combine_chunks(), 0)
        none = np.empty(0, np.int64)
        best = [(none, none)] * len(query_ids)
        for table in _shards(batches):
            matrix = _matrix(table["vector"].combine_chunks(), query_rows.shape[1])
            if matrix.shape[1] > query_rows.shape[1]:
                query_rows = np.pad(query_rows, ((0, 0), (0, matrix.shape[1] - query_rows.shape[1])))
            kind = _numeric(matrix, query_rows)
            shard = Shard(table["vec_id"].to_numpy(), matrix.astype(kind))
            asked_rows = query_rows.astype(kind)
            for i, own in enumerate(query_ids):
                ids, scores = best[i]
                floor = scores[-1] if len(scores) == k else NO_FLOOR
                new_ids, new_scores = shard.search(own, asked_rows[i], k, floor)
                best[i] = _best(
                    np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores.astype(np.int64)]), k
                )
        counts = [len(ids) for ids, _ in best]
        if sum(counts):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids, counts)),
                    pa.array(np.concatenate([ids for ids, _ in best])),
                    pa.array(np.concatenate([scores for _, scores in best])),
                ],
                schema=_HITS,
            )

    return run

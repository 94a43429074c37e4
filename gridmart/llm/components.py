"""Connected components of a link table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Hooks every larger neighbour of a node onto the node's smallest neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hooked = both.filter(F.col("b") > F.col("a")).join(staged(least, "star-least"), "a")
    return hooked.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hooks a node and its smaller neighbours onto the smallest of them; links point down."""
    least = staged(links.groupBy("a").agg(F.min("b").alias("m")), "star-least")
    hooked = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.union(least.select("a", F.col("m").alias("b")))


def _down(links: DataFrame, label: str) -> DataFrame:
    """Links as (larger, smaller), each once, in a table."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return staged(pairs.filter(F.col("a") > F.col("b")).distinct(), label)


def _print(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links`` (a, b) that is not the smallest of its component.

    Each round is two stars, each a minimum per node and a join back, written to the shared folder;
    no node's links are gathered. Rounds end when nothing changes: a few times the logarithm of the
    longest chain. No links give no rows; a link of a node to itself and repeated links change
    nothing.
    """
    now = _down(links.select("a", "b"), "links")
    seen = None
    while (state := _print(now)) != seen:
        seen = state
        if not state[0]:
            break
        now = _down(_small_star(_down(_large_star(now), "large-star")), "small-star")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))

"""Documents to packed training sequences: five stages, each a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm import decontaminate, language, lines, minhash, packing
from gridmart.llm.common import read, staged, temporary
from gridmart.llm.queries import ranks_path
from gridmart.session import remove_folder, scratch_path

#: A document stays if at least this share of its words is expected to be of one language.
LEAST_LANGUAGE_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; without letters, or of no main language, they go."""
    chain = language.train(language.sample(docs))
    # the columns that the verdict adds must not cover columns of the documents
    named = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    found = language.identify(named, chain)
    clear = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE)
    return found.filter(clear).select("doc.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; one that has no other line left goes."""
    found = lines.dedup_lines(docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text"))
    long_left = F.exists(F.split("text", "\n", -1), lambda line: F.length(line) >= lines.MIN_CHARS)
    found = found.filter((F.col("n_removed") == 0) | long_left)
    return found.select(*(_rewritten(c) for c in docs.columns))


def _rewritten(column: str):
    """A column of documents that follows a changed text."""
    held = F.col("doc")[column]
    if column == "text":
        return F.col("text")
    if column == "n_chars":
        return F.when(F.col("text").eqNullSafe(F.col("doc.text")), held).otherwise(F.length("text")).cast("long").alias(column)
    return held.alias(column)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    A row is a document: rows that repeat a doc_id, or have none, are compared by their texts like any
    others, null ids first; of equal rows one stays.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if not ids.filter("n > 1 or doc_id is null").isEmpty():
        # numbered in the order of their ids, so that every row has an id of its own
        ordered = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text").orderBy("doc_id", F.xxhash64("text"), "text")
        numbered = staged(ordered.select("doc", F.monotonically_increasing_id().alias("doc_id"), "text"), "numbered")
        return _without_copies(numbered).select("doc.*")
    return _without_copies(docs)


def _without_copies(docs: DataFrame) -> DataFrame:
    gone = minhash.near_duplicates(docs.select("doc_id", "text")).filter(~F.col("kept"))
    return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with the benchmark; mostly shared ones go."""
    named = docs.select(F.struct(*docs.columns).alias("doc"), "text")
    found = decontaminate.decontaminate(named, read(spark, sf_dir, "benchmark"))
    return found.select(*(_rewritten(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return packing.pack_documents(docs, ranks_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]

#: The trained language model and the token packing are no SQL; the tests hold the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each reads what the one before has written.

    A stage's own tables go when its result is written, and the result when the next stage has
    read it; the last one's stays.
    """
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with temporary(spark):
            found = stage(spark, docs, sf_dir)
            found.write.option("compression", "zstd").parquet(path)
        if last:
            remove_folder(spark, last)
        docs, last = spark.read.schema(found.schema).parquet(path), path
    return docs

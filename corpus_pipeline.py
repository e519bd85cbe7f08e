"""The corpus pipeline: five stages over ``documents``, each written and read again.

Quality, near duplicates and contamination remove documents; secrets are masked in the
texts that stay; mixing orders what is left. Every row is judged by its own text: rows
without a doc_id, repeated rows and rows that share a doc_id are kept or removed like any
other. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sentiseries.llm import decontaminate, line_quality, mixing, near_duplicates, secret_scan
from sentiseries.llm.common import free_name, remainder, small_batches, table
from sentiseries.sources.storage import stored

LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``LEAST_QUALITY`` or more; the sample to learn from is the input's."""
    small_batches(spark)
    model = line_quality.train(docs, table(spark, sf_dir, "labels"), remainder(F.col("k"), 5) != 0)
    score = free_name(docs, "score")
    return docs.withColumn(score, line_quality.score("text", model)).filter(F.col(score) >= LEAST_QUALITY).drop(score)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group: the smallest id's; rows without an id come last. Rows without words stay."""
    small_batches(spark)
    mark = free_name(docs, "mark")
    # rows that share a mark are equal in all columns
    content = F.xxhash64(*(c for name in docs.columns for c in (F.col(name).isNull(), F.col(name))))
    marked = docs.withColumn(mark, F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), content.alias("content")))
    worded = near_duplicates.group(marked.select(mark, "text"), mark).filter("n_shingles > 0")
    # all copies of a mark have the same verdict
    marks = stored(worded.groupBy(mark).agg(F.min("kept").alias("kept"), F.count("*").alias("n")).filter("not kept or n > 1"), "marks")
    left = marked.join(marks.filter("not kept").select(mark), mark, "left_anti")
    repeated = marks.filter("kept").select(mark)
    if repeated.isEmpty():
        return left.select(*docs.columns)
    once = left.join(repeated, mark, "left_semi").dropDuplicates([mark])
    return left.join(repeated, mark, "left_anti").select(*docs.columns).union(once.select(*docs.columns))


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    small_batches(spark)
    # the text alone decides, so its digest is the key
    mark = free_name(docs, "mark")
    marked = docs.withColumn(mark, F.sha2("text", 256))
    removed = decontaminate.contained(marked.select(mark, "text"), table(spark, sf_dir, "benchmark"), mark).select(mark).distinct()
    return marked.join(removed, mark, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    small_batches(spark)
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their block, slot and place in the mixture."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicate),
    ("decontamination", contamination),
    ("secrets", secrets),
    ("mixing", mixture),
]

# A fitted classifier decides in the first stage, so there is no SQL for the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline: quality, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns the documents its successor works on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontam, odd_sketch, quality_crf, semicrf, sentencepieces
from stratalake.llm.common import fold, table
from stratalake.storage import delete_folder, scratch_dir, written_copy

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


ROW = "_pipeline_row"


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """A written copy in which every row has a number of its own: doc_id may be null or repeated, so
    decisions are made and applied by row.  Numbers that are read from files cannot change."""
    return written_copy(docs.withColumn(ROW, F.monotonically_increasing_id()), name)


def _by_row(rows: DataFrame) -> DataFrame:
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model predicts to be bad go."""
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    model = quality_crf.train(table(spark, sf_dir, "documents"), labels)
    return quality_crf.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, repeated rows included: the one with the smallest
    doc_id, null being the largest.  Texts without words are copies of nothing."""
    rows = _numbered(docs, "numbered")
    groups = odd_sketch.near_duplicates(_by_row(rows)).select(F.col("doc_id").alias(ROW), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(ROW)))
    kept = groups.join(rows.select(ROW, "doc_id"), ROW).groupBy("component_id").agg(first[ROW].alias(ROW))
    return rows.join(kept.select(ROW), ROW, "left_semi").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark passage go, whatever their doc_id."""
    rows = _numbered(docs, "numbered")
    found = decontam.contamination(_by_row(rows), table(spark, sf_dir, "benchmark"))
    refused = found.where("contaminated").select(F.col("doc_id").alias(ROW))
    return rows.join(refused, ROW, "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets."""
    return semicrf.mask(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and two sampled segmentations."""
    return sentencepieces.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next.  What a stage
    wrote is deleted once the stage after it has been written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_dir(spark, name)
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            if before:
                delete_folder(spark, before)
            before = path
    return docs

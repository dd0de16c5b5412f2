"""The operators over the test tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import (
    decontam,
    html_extract,
    langid,
    line_dedup,
    odd_sketch,
    phrases,
    quality_crf,
    semicrf,
    sentencepieces,
    slice_codes,
    spann,
    toxicity,
)
from stratalake.llm.common import fold, table
from stratalake.llm.shard import shard


def _held_out(modulus: int, remainder: int):
    """True for documents no label was learned from; a null doc_id has none to learn from."""
    return F.coalesce(fold("doc_id", modulus) == remainder, F.lit(False)).alias("held_out")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semicrf.find(table(spark, sf_dir, "documents"))


def op4_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = langid.train(docs.where(fold("doc_id", 4) != 2))
    return langid.predict(docs, net).select(
        "doc_id", _held_out(4, 2), "lang_pred", "score"
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=40)


def op8_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), with_decoded=True)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.train(
        docs, table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1)
    )
    return quality_crf.score(docs, model).select(
        "doc_id", _held_out(3, 1), "score", "predicted"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = toxicity.train(docs, table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0))
    return toxicity.score(docs, index).select(
        "doc_id", _held_out(5, 0), "score", "predicted", "evidence"
    )


def op11_slice_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    books = slice_codes.fit(rows)
    coded = slice_codes.with_group_error(slice_codes.encode(rows, books), "label")
    digest = F.lit(books.digest if books else None).cast("string")
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_html_text,
        op2_nearest,
        op3_personal_data,
        op4_odd_sketch_dedup,
        op5_language,
        op6_decontaminate,
        op7_histogram_shards,
        op8_sentencepieces,
        op9_quality,
        op10_toxicity,
        op11_slice_codes,
        op12_collocations,
        op13_line_dedup,
    )
}
ORACLES: dict[str, str] = {
    "op4_odd_sketch_dedup": odd_sketch.SQL,
    "op6_decontaminate": decontam.SQL,
    "op11_slice_codes": slice_codes.SQL,
    "op12_collocations": phrases.SQL,
    "op13_line_dedup": line_dedup.SQL,
}

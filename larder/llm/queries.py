"""The registered corpus queries: each operator over its whole table, in the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, exact_dedup, extract, hard_negatives, langid, line_quality, maxent, mil, packing, pii
from larder.llm import runs, simhash, url_filter
from larder.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.rewrite(table(spark, folder, "documents")).select("row.doc_id", "text", "n_replaced")


def op2_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.measure(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(table(spark, folder, "documents"))


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op5_quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mil.score(docs, mil.train(docs, table(spark, folder, "labels")))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return exact_dedup.resolve(docs, exact_dedup.first_half(docs))


def op7_maxent(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.train_and_score(table(spark, folder, "documents"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), bpe.default_path())


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "pages"), table(spark, folder, "documents"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), bpe.default_path())


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, folder, "embeddings").withColumn(
        "label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(rows, vec_id % 100 == 0)


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.digests(table(spark, folder, "documents"), reword=runs.planted)


def op13_html(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages"))


OPERATORS = [op1_pii, op2_line_quality, op3_simhash, op4_url_filter, op5_quality_mil, op6_exact_dedup, op7_maxent,
             op8_packing, op9_language, op10_bpe, op11_hard_negatives, op12_runs, op13_html]


def queries() -> dict[str, Query]:
    """Name to a function of (session, folder of test tables)."""
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {"op2_line_quality": line_quality.sql(), "op4_url_filter": url_filter.sql(),
            "op6_exact_dedup": exact_dedup.sql(), "op11_hard_negatives": hard_negatives.sql()}

"""From raw documents to packed training sequences: five stages, each on all that the one before kept.

A stage is a function of (session, documents, folder of tables). All but the last return the columns of
documents; the last returns one row per piece of a sequence. No stage is expressible in SQL as a whole
(SimHash, keyed surrogates and packing are not), so the pipeline is tested against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.llm import bpe, exact_dedup, line_quality, packing, pii, simhash
from larder.sources.tables import staged, staged_alone

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failed lines."""
    return line_quality.clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.distinct_rows(docs, exact_dedup.first_half(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component, the document with the smallest id."""
    return simhash.distinct_rows(docs, words=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data."""
    return pii.replace(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.pack(docs, bpe.default_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("exact_dedup", exact), ("simhash_near_dedup", near), ("pii", personal_data),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what lies between two stages is written and read again, and deleted at the end."""

    def rows() -> DataFrame:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            docs = staged(stage(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)

    return staged_alone(rows, STAGES[-1][0])

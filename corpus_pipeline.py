"""From ``documents`` to packed training sequences; each stage's rows are stored before the next reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratelens.llm import mixing, packing, pii, quality, simhash
from ratelens.llm.common import store, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the decoded lines keep."""
    return quality.quality(docs, quality.fit_lines(docs, table(spark, sf_dir, "labels")), keep=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return pii.mask_personal_data(docs, pii.fit_tagger())


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece of each document with its bin, offset and the bin's fill, in words."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the fitted fields nor the drawn copies; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

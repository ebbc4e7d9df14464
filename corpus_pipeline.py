"""Corpus pipeline: language, exact copies, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to
the shared folder and read again as the next stage's documents. All but the last return the
columns of ``documents``. Rows with null columns, empty texts and repeated rows pass as each
operator defines; an empty table gives an empty result at each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from barstead.llm import common, exact_dedup, language_id, mixing, near_dedup, packing

#: A document whose language can't be told at least this well is rejected.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or a recognisable language go; ``lang`` is the predicted one for the rest."""
    return language_id.with_known_language(docs, LEAST_SCORE)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id. Five-word shingles, linked from a similarity of 0.85 on, as in operator 2."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack),
]

#: A trained network, tree sampling and packing aren't expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage wrote for itself goes once its result is written."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = f"{common.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with common.passing(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

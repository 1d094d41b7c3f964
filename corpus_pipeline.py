"""A training-data pipeline made of the text operators.

``STAGES`` are applied in order; each takes ``(spark, docs, sf_dir)`` and
returns a frame that is written as Parquet in the shared checkpoint folder and
read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``; each decides on what its predecessor kept.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearframe.llm.common import materialize, table
from nearframe.llm.decontaminate import drop_leaks
from nearframe.llm.mix import materialize_mix, mix_sources
from nearframe.llm.packing import pack_documents
from nearframe.llm.quality import with_quality
from nearframe.llm.simhash import keep_one_per_group, simhash_groups

KEEP_SCORE = 0.7


def _ease(spark: SparkSession) -> None:
    """Give the last stage's plans, broadcasts and arrays back before the next one:
    both of the driver's processes keep their garbage otherwise, and Spark's cleaner
    only acts when the JVM collects."""
    gc.collect()
    spark._jvm.System.gc()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects."""
    _ease(spark)
    scored = with_quality(docs, table(spark, sf_dir, "labels"), name="__score")
    return scored.where(F.col("__score") >= KEEP_SCORE).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group."""
    _ease(spark)
    return keep_one_per_group(docs, simhash_groups(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    _ease(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, keep or cut documents to the sources' target weights."""
    _ease(spark)
    return materialize_mix(docs, materialize(mix_sources(docs), "mix-plan"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in packed rows."""
    _ease(spark)
    return pack_documents(docs)


STAGES = [("quality", quality), ("simhash", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("pack", pack)]

#: A trained network and a packing order are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""The corpus pipeline: five of the training-data operators, one after another.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as a
table in the shared folder and read again as the next one's ``docs``, so each stage works on all its
predecessor kept and a lost executor costs no more than one stage. All stages but
the last return the columns of documents; the last adds size, CRC, law, shard,
slot and the shard after one more joins.

Near-dedup and decontamination cannot be put in SQL by their methods, so
``ORACLE_SQL`` is None; tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rtdw.llm import decontaminate, minhash_dedup, mixing, quality_rules, sharding
from rtdw.llm.common import prepare, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    prepare(spark)
    return minhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    prepare(spark)
    return sharding.shard_plan(docs, keep=True)


STAGES = [
    ("quality rules", quality),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

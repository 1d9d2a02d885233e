"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rtdw.llm.common import prepare


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import minhash_dedup

    return minhash_dedup.near_duplicates(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import substring_dedup

    return substring_dedup.dedup(documents(spark, sf_dir)).drop("kept_text")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import mixing

    return mixing.taken(documents(spark, sf_dir))


def spans_text(found, kinds=None):
    """``kind:start:end`` comma-joined, of all spans or of some kinds."""
    wanted = found if kinds is None else F.filter(found, lambda x: x["kinds"].isin(*kinds))
    return F.array_join(F.transform(wanted, lambda x: F.concat_ws(
        ":", x["kinds"], x["starts"].cast("string"), x["ends"].cast("string"))), ",")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import personal_data as pii

    found = pii.find(documents(spark, sf_dir))
    names = F.array(*(F.lit(k) for k in pii.KINDS))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")
    count = lambda rank: F.size(F.filter(F.col("base"), lambda x: x["rank"] == rank)).cast("long")
    return found.select("doc_id", *(count(r).alias(f"n_{k}") for r, k in enumerate(pii.KINDS)),
                        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import secrets

    found = secrets.scan(documents(spark, sf_dir))
    zipped = F.arrays_zip("starts", "ends", "kinds")
    base = [r.kind for r in secrets.RULES if r.base]
    count = lambda kind: F.size(F.filter(F.col("kinds"), lambda k: k == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in base),
                        F.sha2(spans_text(zipped, base).cast("binary"), 256).alias("base_sha256"),
                        spans_text(zipped).alias("spans"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import decontaminate

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contaminated(documents(spark, sf_dir), benchmark)
    return found.drop("text_key")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import pu_quality

    return pu_quality.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import sharding

    return sharding.shard_plan(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import lm_scoring

    return lm_scoring.score(documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import quality_rules as rules

    m = F.col("_quality")
    return rules.judge(documents(spark, sf_dir)).select(
        "doc_id", *(m[c].alias(c) for c in rules.BASE), m["base_failed"].alias("base_failed"),
        m["kept"].alias("kept"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import spelling_variants

    return spelling_variants.variants(documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import collocations

    return collocations.collocations(documents(spark, sf_dir))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rtdw.llm import html_content

    prepare(spark)
    return html_content.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mixing": op3_mixing,
    "op4_personal_data": op4_personal_data,
    "op5_secrets": op5_secrets,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_sharding": op8_sharding,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_quality_rules": op10_quality_rules,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_collocations": op12_collocations,
    "op13_html_extraction": op13_html_extraction,
    "pipeline": pipeline,
}

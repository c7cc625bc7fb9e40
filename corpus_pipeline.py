"""Training-corpus pipeline over ``documents``.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from augur.llm import decontaminate, mixing, pii, quality_rules, simhash_dedup
from augur.llm.scratch import stored

BUDGET = 1.0  # tokens of the mix, as a share of those that reach it


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and read as content."""
    judged = quality_rules.judge_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.filter("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by a benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; ``n_chars`` follows the text."""
    replaced = pii.replace_personal_data(docs)
    n_chars = F.when(F.col("n_entities") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", n_chars).select(docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with their branch, tokens and copies."""
    return mixing.mix(docs, budget=F.col("tokens") * BUDGET)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("PII", surrogates),
    ("mixing sources", mixing_sources),
]

ORACLE_SQL = None  # the line field and the fingerprints have no SQL; tests compare with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)

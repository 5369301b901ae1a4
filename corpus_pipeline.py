"""The corpus pipeline: language ID, near-dedup, decontamination, mixing and sharding, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared folder
and reads it back as the next stage's docs. All stages but the last return the columns of docs. Nulls, empty tables and
repeated rows are treated as the operators' docstrings say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import materialize
from lakequery.llm.hash_tree import assign_shards
from lakequery.llm.language_mixture import identified
from lakequery.llm.minmax_dedup import without_near_duplicates
from lakequery.llm.simhash_decontam import without_matches
from lakequery.llm.source_mix import mix_sources

#: No SQL expresses the language mixture; tests/llm holds a brute-force version of every stage's method.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter go, and those of which the fitted mixture gives no language half."""
    return identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked at 80 % of 5-word shingles."""
    return without_near_duplicates(docs, percent=80, bands=32)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Documents without a word are not taken."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # the mix adds columns, which must not replace those of docs
    mixed = mix_sources(docs.select("doc_id", "text", "source", row))
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(F.lit(0)).cast("int")
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    return assign_shards(docs)


STAGES = [("language_id", identify_language), ("near_dedup", drop_near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

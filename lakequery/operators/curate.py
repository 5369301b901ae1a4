"""Flat master tables and edge tables from nested scholarly records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.rank import top_n
from lakequery.operators.joins import unordered_pairs

NESTED = (T.StructType, T.MapType, T.ArrayType, T.VariantType)


def scalar_master(raw: DataFrame, source_key: str) -> DataFrame:
    """Top-level scalar columns and the lineage column; a table without one is refused."""
    cols = [f.name for f in raw.schema if not isinstance(f.dataType, NESTED)]
    if not cols:
        raise ValueError("no scalar column")
    return raw.select(*(F.col(f"`{c}`") for c in cols), F.lit(source_key).alias("_source_key"))


def _position():
    return F.when(F.col("author_position") == "first", 0).when(F.col("author_position") == "last", 1).when(F.col("author_position") == "middle", 2).otherwise(3)


def _author_order():
    return [F.col("is_corresponding").desc_nulls_last(), _position().asc(), F.col("author_position").asc_nulls_last()]


# Each edge table: its key, and the order in which its best row of a key is chosen; none: rows are made distinct.
EDGES = {
    "CITATION_EDGES": (("work_id", "referenced_work_id"), None),
    "WORK_TOPIC_EDGES": (("work_id", "topic_id"), lambda: [F.col("topic_score").desc_nulls_last(), F.col("topic_display_name").asc_nulls_last()]),
    "WORK_AUTHOR_EDGES": (("work_id", "author_id"), _author_order),
    "AUTHOR_INSTITUTION_EDGES": (("work_id", "author_id", "institution_id"), lambda: [*_author_order(), F.col("institution_country_code").asc_nulls_last()]),
    "COUNTRY_COLLAB_EDGES": (("work_id", "country_a", "country_b"), None),
}


def clean_edges(table: str, edges: DataFrame) -> DataFrame:
    """Rows with a null or blank key go; of equal keys the best row stays."""
    if table not in EDGES:
        raise ValueError(f"unknown edge table {table}")
    keys, order = EDGES[table]
    for k in keys:
        edges = edges.where(F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != ""))
    return top_n(edges, list(keys), order()) if order else edges.distinct()


def work_edges(raw: DataFrame, source_key: str) -> dict[str, DataFrame]:
    """The five edge tables of works."""
    tag = F.lit(source_key).alias("_source_key")
    w = F.col("id").alias("work_id")
    authors = raw.select(w, F.explode("authorships").alias("a"))
    at = (F.col("a.author.id").alias("author_id"), F.col("a.author_position").alias("author_position"), F.col("a.is_corresponding").alias("is_corresponding"))
    countries = authors.select("work_id", F.explode("a.countries").alias("country"))
    return {
        "CITATION_EDGES": clean_edges("CITATION_EDGES", raw.select(w, F.explode("referenced_works").alias("referenced_work_id"), tag)),
        "WORK_TOPIC_EDGES": clean_edges("WORK_TOPIC_EDGES", raw.select(w, F.explode("topics").alias("t")).select("work_id", F.col("t.id").alias("topic_id"), F.col("t.display_name").alias("topic_display_name"), F.col("t.score").alias("topic_score"), tag)),
        "WORK_AUTHOR_EDGES": clean_edges("WORK_AUTHOR_EDGES", authors.select("work_id", *at, tag)),
        "AUTHOR_INSTITUTION_EDGES": clean_edges(
            "AUTHOR_INSTITUTION_EDGES", authors.select("work_id", *at, F.explode("a.institutions").alias("i")).select("work_id", "author_id", F.col("i.id").alias("institution_id"), F.col("i.country_code").alias("institution_country_code"), "author_position", "is_corresponding", tag)
        ),
        "COUNTRY_COLLAB_EDGES": unordered_pairs(countries.where("country <> ''"), ["work_id"], "country").select("work_id", "country_a", "country_b", tag),
    }


def summarize_curated(raw: DataFrame, state: DataFrame) -> dict[str, int]:
    """Counts and bytes of raw files (key, bytes) and of the curation log (key, status, bytes_in, bytes_out, position), of which a successful row of a key
    goes before any other, and the last before those."""
    from lakequery.functions.rank import prefer_ok

    one = raw.groupBy("key").agg(F.max(F.coalesce("bytes", F.lit(0))).alias("bytes")).withColumn("raw", F.lit(True))
    best = prefer_ok(state, "key", "status", "position").select("key", "status", F.coalesce("bytes_in", F.lit(0)).alias("b_in"), F.coalesce("bytes_out", F.lit(0)).alias("b_out"))
    both = one.join(best, "key", "full")
    ok, known = F.coalesce(F.col("status") == "OK", F.lit(False)), F.coalesce("raw", F.lit(False))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    row = both.agg(
        F.count_if(known).alias("raw_count"), total(F.when(known, F.col("bytes"))).alias("raw_bytes"), F.count_if(F.col("status").isNotNull()).alias("distinct_keys"), F.count_if(ok).alias("state_ok"), F.count_if(F.col("status") == "FAILED").alias("state_failed"),
        total(F.when(ok & known, F.col("b_in"))).alias("state_bytes_in"), total(F.when(ok & known, F.col("b_out"))).alias("state_bytes_out"), F.count_if(known & ~ok).alias("missing_keys"), F.count_if(ok & ~known).alias("unexpected_keys"),
    ).first().asDict()
    rows = state.count()
    return row | {"state_rows": rows, "duplicate_rows": rows - row["distinct_keys"]}


def verify_curated(raw: DataFrame, state: DataFrame) -> list[str]:
    """What is wrong with a curation: failed, missing and unexpected keys, counts and bytes that disagree, no output at all."""
    s = summarize_curated(raw, state)
    rules = {
        f"failed: {s['state_failed']}": s["state_failed"], f"missing: {s['missing_keys']}": s["missing_keys"], f"unexpected: {s['unexpected_keys']}": s["unexpected_keys"],
        f"curated keys {s['state_ok']}, raw keys {s['raw_count']}": s["state_ok"] != s["raw_count"], f"curated input bytes {s['state_bytes_in']}, raw bytes {s['raw_bytes']}": s["state_bytes_in"] != s["raw_bytes"], "no output bytes": s["state_bytes_out"] <= 0,
    }
    return [text for text, wrong in rules.items() if wrong]

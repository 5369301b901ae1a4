"""Year marts of works, and their refresh from partials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequery.functions.text import ratio

# Names of the marts and their keys beside the year.
DIMS = {"WORK_YEAR_METRICS": [], "WORK_YEAR_TOPIC": ["topic_id"], "WORK_YEAR_INSTITUTION": ["institution_id"], "WORK_YEAR_COUNTRY": ["country_code"], "COUNTRY_COLLAB_YEAR": ["country_a", "country_b"]}


def works_of(master: DataFrame, *extra: str) -> DataFrame:
    """id, publication_year, cites and extra columns; a missing citation column counts as 0."""
    if not {"id", "publication_year"} <= set(master.columns):
        raise ValueError("id and publication_year are required")
    cites = F.coalesce(F.col("cited_by_count"), F.lit(0)) if "cited_by_count" in master.columns else F.lit(0)
    return master.where("id is not null and publication_year is not null").select(*extra, "id", "publication_year", cites.cast("long").alias("cites"))


def _mean(df: DataFrame) -> DataFrame:
    return df.withColumn("mean_citations", ratio(F.col("citation_sum"), F.col("work_count")))


def edge_sets(topics: DataFrame | None = None, institutions: DataFrame | None = None, collaboration: DataFrame | None = None, strict_institutions: bool = False, dealt: bool = False, extra: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Edges of each mart whose columns are at hand: work_id, the mart's keys, and a score for topics. Rows without a key are left out. Those of a mart of distinct
    edges are dealt by work first, as the join with works needs it too; dealt says that a stored bucketing has done so. extra columns are kept as part of the edge."""
    by_work = (lambda df: df) if dealt else (lambda df: df.repartition("work_id"))
    has = lambda df, *c: df is not None and {"work_id", *c} <= set(df.columns)
    out = {}
    if has(topics, "topic_id"):
        score = F.coalesce(F.col("topic_score"), F.lit(0.0)) if "topic_score" in topics.columns else F.lit(0.0)
        out["WORK_YEAR_TOPIC"] = by_work(topics.where("topic_id is not null").select(*extra, "work_id", "topic_id", score.alias("score")))
    if has(institutions, "institution_id"):
        country = "institution_country_code" in institutions.columns
        keep = ["work_id", "institution_id"] + ["institution_country_code"] * (not strict_institutions and country)
        out["WORK_YEAR_INSTITUTION"] = by_work(institutions.where("institution_id is not null").select(*extra, *keep)).distinct()
        if country:
            c = institutions.where("institution_country_code <> ''").select(*extra, "work_id", F.col("institution_country_code").alias("country_code"))
            out["WORK_YEAR_COUNTRY"] = by_work(c).distinct()
    if has(collaboration, "country_a", "country_b"):
        c = collaboration.where("country_a <> '' and country_b <> '' and country_a < country_b")
        out["COUNTRY_COLLAB_YEAR"] = c.select(*extra, "work_id", "country_a", "country_b")
    return out


def _yearly(edges: DataFrame, w: DataFrame, dims: list[str]) -> DataFrame:
    """Distinct works, their citations (once for each row of edges) and scores by year and dimension. The rows of one work are added up where
    the join left them, so what is dealt by year and dimension is already added up."""
    scored = "score" in edges.columns
    j = edges.join(w, edges["work_id"] == w["id"])
    each = j.groupBy("work_id", "publication_year", *dims).agg(F.sum("cites").alias("cites"), *([F.sum("score").alias("score")] if scored else []))
    whole = [F.count("*").cast("long").alias("work_count"), F.sum("cites").cast("long").alias("citation_sum"), *([F.sum("score").alias("topic_score_sum")] if scored else [])]
    return _mean(each.groupBy("publication_year", *dims).agg(*whole))


def year_marts(master: DataFrame, topics: DataFrame | None = None, institutions: DataFrame | None = None, collaboration: DataFrame | None = None, strict_institutions: bool = False, dealt: bool = False) -> dict[str, DataFrame]:
    """Marts of the tables at hand. Distinct works are counted over all files at once. An institution with two country codes in
    a work counts its citations twice, as its mart is defined; strict_institutions counts them once. dealt: the tables are stored in buckets of their works
    (sources.stored), and nothing is dealt again before the last sums."""
    w = works_of(master)
    out = {"WORK_YEAR_METRICS": _mean(w.groupBy("publication_year").agg(F.count("*").cast("long").alias("work_count"), F.sum("cites").cast("long").alias("citation_sum")))}
    for name, edges in edge_sets(topics, institutions, collaboration, strict_institutions, dealt).items():
        out[name] = _yearly(edges, w, DIMS[name])
    return out


def reduce_partials(partials: DataFrame, dims: list[str]) -> DataFrame:
    """Sums of partials of disjoint works; the mean is derived again."""
    sums = [F.sum(c).cast("double" if c.endswith("score_sum") else "long").alias(c) for c in partials.columns if c in ("work_count", "citation_sum", "topic_score_sum")]
    return _mean(partials.groupBy("publication_year", *dims).agg(*sums))

"""Data-quality checks: all checks of a table in one pass, as rows of check and value; a value over 0 is an error."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.functions.text import fresh
from lakequery.operators.marts import DIMS


@dataclass(frozen=True)
class Contract:
    name: str
    required: tuple[str, ...]
    key: tuple[str, ...]


def invalid_key(keys: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() | (F.col(k).cast("string") == "") for k in keys])


def checks(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """How many rows meet each predicate (null counts as no)."""
    row = df.agg(*(F.count_if(p).cast("long").alias(n) for n, p in predicates.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("check"), F.col(n).alias("value")) for n in predicates))).alias("c")).select("c.check", "c.value")


def duplicates(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Groups of more than one row, and the rows in excess."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return n.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("excess"))


def errors_of(checked: DataFrame) -> list[str]:
    return [f"{r['check']}: {r['value']}" for r in checked.where("value > 0").orderBy("check").collect()]


def validate_staged(tables: dict[str, DataFrame], contracts: list[Contract]) -> list[str]:
    """Missing tables and columns, invalid and duplicate keys."""
    found: list[str] = []
    for c in contracts:
        if c.name not in tables:
            found.append(f"{c.name}: missing table")
            continue
        df = tables[c.name]
        if lost := sorted(set(c.required) - set(df.columns)):
            found.append(f"{c.name}: missing columns {', '.join(lost)}")
            continue
        bad = df.agg(F.count_if(invalid_key(c.key))).first()[0]
        excess = duplicates(df, c.key).first()["excess"]
        found += [f"{c.name}: {bad} invalid keys"] * bool(bad) + [f"{c.name}: {excess} duplicate keys"] * bool(excess)
    return found


def dominated(accepted: DataFrame, candidates: DataFrame, key: str, confidence: str, margin: float = 1e-12) -> DataFrame:
    """Scored accepted rows for whose key a candidate that was not accepted has a higher confidence; the best candidate alone is joined."""
    (best,) = fresh(accepted.columns, "best")
    other = candidates.where(~F.col("accepted")).groupBy(key).agg(F.max(confidence).alias(best))
    return accepted.where("provenance = 'scored_matcher'").join(other, key).where(F.col(best) > F.col(confidence) + margin).drop(best)


def bridge_checks(org: DataFrame, accepted: DataFrame, candidates: DataFrame, review: DataFrame) -> DataFrame:
    """The eleven checks of the accepted bridge as (check, value): one-to-one links, confidence within 0.965 to 1, exact links at 1, scored ones
    of the high tier, flags of the master, no stronger candidate, review and accepted apart."""
    company, institution = "canonical_company_id", "openalex_institution_id"
    (has,) = fresh(org.columns, "has")
    linked = accepted.select(company).distinct().withColumn(has, F.lit(True))
    flags = org.join(linked, company, "left").where(F.col("has_openalex_link") != F.coalesce(has, F.lit(False)))
    within = checks(accepted, {
        "null_accepted_keys": invalid_key([company, institution]), "accepted_confidence_outside_policy": F.col("confidence").isNull() | ~F.col("confidence").between(0.965, 1.0), "accepted_rows_marked_unaccepted": ~F.col("accepted"),
        "exact_anchor_confidence_not_one": (F.col("provenance") == "exact_anchor") & (F.abs(F.col("confidence") - 1.0) > 1e-12), "scored_accepted_not_high_tier": (F.col("provenance") == "scored_matcher") & (F.col("confidence_tier") != "HIGH"),
    })
    counted = lambda df, name: df.agg(F.count("*").alias("value")).select(F.lit(name).alias("check"), "value")
    groups = lambda k, name: counted(accepted.groupBy(k).count().where("count > 1"), name)
    rest = [
        groups(company, "duplicate_sec_company_links"), groups(institution, "duplicate_openalex_institution_links"), counted(flags, "organization_master_link_flag_mismatches"),
        counted(dominated(accepted, candidates, company, "confidence"), "accepted_matches_dominated_by_stronger_candidate"), counted(review.join(accepted, company, "left_semi"), "review_companies_already_promoted"),
        counted(review.where("accepted"), "review_rows_marked_accepted"),
    ]
    return reduce(DataFrame.union, rest, within)


def validate_bridge(org: DataFrame, accepted: DataFrame, candidates: DataFrame, review: DataFrame) -> list[str]:
    """name=value of each check of bridge_checks that fails."""
    return failed(bridge_checks(org, accepted, candidates, review))


def failed(checked: DataFrame) -> list[str]:
    return [f"{r['check']}={r['value']}" for r in checked.where("value > 0").orderBy("check").collect()]


MART_KEYS = {name: ("publication_year", *dims) for name, dims in DIMS.items()}
MART_METRICS = ("work_count", "citation_sum", "mean_citations")


def validate_marts(tables: dict[str, DataFrame]) -> tuple[list[str], DataFrame | None]:
    """(errors, profile): missing marts and columns, invalid and duplicate keys, negative metrics and pairs out of order are errors; the profile
    has rows, years and those counts of each mart, and how many of the base's years a dimension lacks, which is a warning only."""
    found, rows = [], None
    base = tables.get("WORK_YEAR_METRICS")
    for name, keys in MART_KEYS.items():
        df = tables.get(name)
        if df is None:
            found.append(f"{name}: missing table")
            continue
        if lost := sorted({*keys, *MART_METRICS} - set(df.columns)):
            found.append(f"{name}: missing required columns {', '.join(lost)}")
            continue
        negative = reduce(lambda a, b: a | b, (F.coalesce(F.col(c), F.lit(0)) < 0 for c in MART_METRICS))
        order = F.col("country_a") >= F.col("country_b") if "country_a" in keys else F.lit(False)
        one = df.agg(F.count("*").alias("n_rows"), F.count_if(invalid_key(keys)).alias("invalid_keys"), F.count_if(negative).alias("negative_metrics"), F.count_if(order).alias("pairs_out_of_order"), F.min("publication_year").alias("first_year"), F.max("publication_year").alias("last_year"))
        gaps = base.select("publication_year").distinct().join(df.select("publication_year"), "publication_year", "left_anti").agg(F.count("*").alias("years_lacking")) if base is not None else one.select(F.lit(0).alias("years_lacking"))
        one = one.crossJoin(duplicates(df, keys).select(F.col("excess").alias("duplicate_rows"))).crossJoin(gaps).select(F.lit(name).alias("mart"), "*")  # single rows each
        rows = one if rows is None else rows.union(one)
    for r in rows.collect() if rows is not None else []:
        found += [f"{r['mart']}: {r[c]} {c.replace('_', ' ')}" for c in ("invalid_keys", "duplicate_rows", "negative_metrics", "pairs_out_of_order") if r[c]]
    return found, rows


def year_gaps(mart: DataFrame, year: str = "publication_year") -> DataFrame:
    """Years inside a mart's range without a row."""
    span = mart.agg(F.min(year).alias("a"), F.max(year).alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias(year))
    return span.join(mart.select(year).distinct(), year, "left_anti")

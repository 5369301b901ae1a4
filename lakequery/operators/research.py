"""Company-year marts, their checks, deltas of two releases, and the release inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequery.functions.text import ratio
from lakequery.operators.quality import checks, invalid_key
from lakequery.operators.resolve import pick

COMPANY, INSTITUTION = "canonical_company_id", "openalex_institution_id"


def company_year(org: DataFrame, production: DataFrame, institution_year: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(research-year mart, citation-year mart) of linked companies; the production bridge must be one to one and not empty."""
    row = production.agg(F.count("*").alias("n"), F.countDistinct(COMPANY).alias("c"), F.countDistinct(INSTITUTION).alias("i")).first()
    if not row["n"] or not row["n"] == row["c"] == row["i"]:
        raise ValueError("the production bridge is empty or not one to one")
    own = pick(org, {"canonical_org_id": ("canonical_org_id", COMPANY), COMPANY: (COMPANY,), "cik": ("cik",), "company_name": ("company_name",), "primary_ticker": ("primary_ticker",)})
    link = pick(production, {COMPANY: (COMPANY,), INSTITUTION: (INSTITUTION,), "openalex_name": ("openalex_name",), "ror": ("ror",), "openalex_country_code": ("country_code",), "openalex_institution_type": ("institution_type",), "match_method": ("match_method",), "match_confidence": ("confidence",), "confidence_tier": ("confidence_tier",)})
    yearly = institution_year.groupBy("institution_id", "publication_year").agg(F.sum("work_count").cast("long").alias("work_count"), F.sum("citation_sum").cast("long").alias("citation_sum"))
    mart = yearly.join(link, F.col("institution_id") == F.col(INSTITUTION)).join(own, COMPANY)
    mart = mart.select(*own.columns, *link.columns[1:], "publication_year", "work_count", "citation_sum", ratio(F.col("citation_sum").cast("double"), F.col("work_count")).alias("mean_citations"))
    cited = mart.select(*own.columns, INSTITUTION, "publication_year", "work_count", "citation_sum", F.col("mean_citations").alias("citations_per_work"), "match_method", "match_confidence", "confidence_tier")
    return mart, cited


def company_topic_year(production: DataFrame, works: DataFrame, author_institutions: DataFrame, topics: DataFrame, dealt: bool = False) -> DataFrame:
    """Distinct works, citations and topic scores of companies by topic and year. works: id, publication_year, cites. Both sides are dealt by work, or stored so (dealt);
    rows of a work are added up where they are, before companies come together."""
    target = target_works(production, works, author_institutions, dealt)
    t = topics.select(F.col("work_id").alias("tw"), "topic_id", "topic_score")
    t = t if dealt else t.repartition("tw")
    keys = [COMPANY, INSTITUTION, "publication_year", "topic_id"]
    each = target.join(t, target["work_id"] == t["tw"]).groupBy("work_id", *keys).agg(F.sum("cites").alias("c"), F.sum("topic_score").alias("s"))
    return each.groupBy(*keys).agg(F.count("*").alias("work_count"), F.sum("c").cast("long").alias("citation_sum"), F.sum("s").alias("topic_score_sum"))


def target_works(production: DataFrame, works: DataFrame, author_institutions: DataFrame, dealt: bool = False) -> DataFrame:
    """Works of the companies of a bridge, each once, dealt by work."""
    e = author_institutions.select("work_id", "institution_id")
    e = (e if dealt else e.repartition("work_id")).distinct()
    mine = e.join(production.select(COMPANY, INSTITUTION), e["institution_id"] == F.col(INSTITUTION))
    return mine.join(works, mine["work_id"] == works["id"]).select(COMPANY, INSTITUTION, "work_id", "publication_year", "cites").distinct()


def company_collaboration_year(production: DataFrame, works: DataFrame, author_institutions: DataFrame) -> DataFrame:
    """Partner countries by year: works, partner institutions and citations, each work counted once a country."""
    target = target_works(production, works, author_institutions)
    other = author_institutions.select(F.col("work_id").alias("ow"), F.col("institution_id").alias("partner"), F.col("institution_country_code").alias("partner_country")).where("partner_country <> ''").repartition("ow").distinct()
    pairs = target.join(other, (target["work_id"] == other["ow"]) & (F.col(INSTITUTION) != F.col("partner")))
    each = pairs.groupBy("work_id", COMPANY, INSTITUTION, "publication_year", "partner_country", "cites").agg(F.count("*").alias("partners"))  # pairs are distinct
    return each.groupBy(COMPANY, INSTITUTION, "publication_year", "partner_country").agg(F.count("*").alias("work_count"), F.sum("partners").cast("long").alias("collaborator_institution_count"), F.sum("cites").cast("long").alias("citation_sum"))


def company_mart_checks(production: DataFrame, research: DataFrame, topic: DataFrame, collaboration: DataFrame) -> DataFrame:
    """The seventeen checks of the topic and collaboration marts, as check and value: keys, negative metrics, companies outside the bridge or with
    another institution, and rows that say more than the company's research year. Each mart is read for its own checks and joined once."""
    prod = production.select(F.col(COMPANY).alias("pc"), F.col(INSTITUTION).alias("pi")).withColumn("in_prod", F.lit(True))
    year = research.select(F.col(COMPANY).alias("rc"), F.col("publication_year").alias("ry"), F.col("work_count").alias("year_works"), F.col("citation_sum").alias("year_cites")).withColumn("in_year", F.lit(True))
    rows = None
    for name, df, key, works, metrics in (
        ("topic", topic, "topic_id", "work_count", ("work_count", "citation_sum", "topic_score_sum")),
        ("collaboration", collaboration, "collaborator_country_code", "collaborative_work_count", ("collaborative_work_count", "collaborator_institution_count", "citation_sum")),
    ):
        keys = [COMPANY, "publication_year", key]
        joined = df.join(prod, F.col(COMPANY) == F.col("pc"), "left").join(year, (F.col(COMPANY) == F.col("rc")) & (F.col("publication_year") == F.col("ry")), "left")
        tests = {
            f"{name}_null_keys": invalid_key([COMPANY, key]) | F.col("publication_year").isNull(),
            f"{name}_negative_metrics": reduce(lambda a, b: a | b, (F.coalesce(F.col(m) < 0, F.lit(False)) for m in metrics)),
            f"{name}_nonproduction_leaks": F.col("in_prod").isNull(),
            f"{name}_institution_identity_mismatch": F.col(INSTITUTION) != F.col("pi"),
            f"{name}_row_work_exceeds_research_year": F.col(works) > F.col("year_works"),
            f"{name}_row_citations_exceed_research_year": F.col("citation_sum") > F.col("year_cites"),
            f"{name}_rows_without_research_year": F.col("in_year").isNull(),
        }
        if name == "collaboration":
            tests["collaborator_count_less_than_work_count_impossible"] = F.col("collaborator_institution_count") < F.col(works)
        repeated = df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("value")).select(F.lit(f"{name}_duplicate_keys").alias("check"), "value")
        found = checks(joined, tests).union(repeated)
        rows = found if rows is None else rows.union(found)
    return rows


def delta(base: DataFrame, candidate: DataFrame, key: str, order: str) -> DataFrame:
    """What a candidate release covers that its base does not: first and last value and rows of each key."""
    new = candidate.join(base.select(key).distinct(), key, "left_anti")
    return new.groupBy(key).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n_rows"))


def research_delta(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """Companies whose research a candidate release covers and its base does not: name, institution, company-year rows, first and last
    year, and works and citations summed over the years. Where rows of a company differ in name or institution, the smallest is told."""
    new = candidate.join(base.select(F.col(COMPANY).alias("bc")).distinct(), F.col(COMPANY) == F.col("bc"), "left_anti")
    long = lambda c, name: F.sum(c).cast("long").alias(name)
    return new.groupBy(COMPANY).agg(
        F.min("company_name").alias("company_name"), F.min(INSTITUTION).alias(INSTITUTION), F.count("*").alias("company_year_rows"), F.min("publication_year").alias("min_year"), F.max("publication_year").alias("max_year"),
        long("work_count", "summed_work_count"), long("citation_sum", "summed_citation_sum"),
    )


def research_delta_summary(base: DataFrame, candidate: DataFrame, bridge: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """One row: companies of base and candidate, rows of the candidate's bridge, and what research_delta adds up to."""
    new = research_delta(base, candidate) if new is None else new
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    parts = [
        base.agg(F.count_distinct(COMPANY).alias("base_research_companies")), candidate.agg(F.count_distinct(COMPANY).alias("candidate_research_companies")), bridge.agg(F.count("*").alias("candidate_bridge_rows")),
        new.agg(F.count("*").alias("new_companies_with_research"), total("company_year_rows").alias("new_company_year_rows"), total("summed_work_count").alias("new_summed_work_count"), total("summed_citation_sum").alias("new_summed_citation_sum")),
    ]
    return reduce(DataFrame.crossJoin, parts)  # single rows


def freeze_release(inventory: DataFrame, verified: bool, errors: list[str]) -> DataFrame:
    """Objects and bytes by top-level folder; an unverified release is refused."""
    if not verified or errors:
        raise ValueError("the release is not verified: " + "; ".join(errors))
    files = inventory.where(~F.col("IsDir"))
    return files.groupBy(F.substring_index("Path", "/", 1).alias("folder")).agg(F.count("*").alias("objects"), F.sum("Size").cast("long").alias("bytes"))


def data_dictionary(datasets: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(dataset, column, type) of every column."""
    return [(name, f.name, f.dataType.simpleString()) for name, df in datasets.items() for f in df.schema]


def release_report(name: str, datasets: dict[str, DataFrame], inventory: DataFrame, verified: bool, errors: list[str]) -> dict[str, str]:
    """Markdown of a verified release: the dictionary of its datasets, and a report of their rows and of the inventory by folder. The counts are one plan."""
    from functools import reduce

    folders = freeze_release(inventory, verified, errors).orderBy("folder").collect()
    counts = {r["n"]: r["c"] for r in reduce(DataFrame.union, (df.agg(F.count("*").alias("c")).select(F.lit(n).alias("n"), "c") for n, df in datasets.items())).collect()}
    listed = data_dictionary(datasets)
    book = [f"# Data dictionary: {name}", ""]
    for n in datasets:
        book += [f"## {n}", "", f"Rows: {counts[n]:,}", "", "| Column | Type |", "|---|---|", *(f"| `{c}` | `{t}` |" for d, c, t in listed if d == n), ""]
    total = (sum(r["objects"] for r in folders), sum(r["bytes"] for r in folders))
    report = [f"# Release: {name}", "", f"- objects: {total[0]:,}", f"- bytes: {total[1]:,}", f"- verified: {verified}", f"- errors: {len(errors)}", "", "| Dataset | Rows | Columns |", "|---|---:|---:|"]
    report += [f"| `{n}` | {counts[n]:,} | {len(df.columns)} |" for n, df in datasets.items()]
    report += ["", "| Folder | Objects | Bytes |", "|---|---:|---:|", *(f"| `{r['folder']}` | {r['objects']:,} | {r['bytes']:,} |" for r in folders)]
    return {"dictionary": "\n".join(book) + "\n", "report": "\n".join(report) + "\n"}

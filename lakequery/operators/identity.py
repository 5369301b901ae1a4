"""Company and filing masters, with rules that depend on input order made explicit by ordinals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequery.functions.rank import mode_by, top_n
from lakequery.functions.text import cik10, try_bigint


def company_master(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(master, bridge) from rows cik, ticker, name, exchange, source, ord: the modal name of all rows (ties by name; null without one), the
    smallest ticker and their number; per (cik, ticker) the first exchange and name that are not empty, and the sources joined by +."""
    rows = names.withColumn("cik", cik10(F.col("cik"))).where("cik is not null")
    ident = F.concat(F.lit("SEC_CIK:"), F.col("cik")).alias("canonical_company_id")
    place = F.struct(F.when(F.col("source") == "company_tickers", 0).otherwise(1), "ord")
    first = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", place)).alias(c)
    bridge = rows.where("ticker <> ''").groupBy("cik", "ticker").agg(first("exchange"), first("name"), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("source"))
    tickers = bridge.groupBy("cik").agg(F.min("ticker").alias("primary_ticker"), F.count("*").cast("int").alias("ticker_count"))
    modal = mode_by(rows.where("ticker <> '' and name <> ''"), ["cik"], "name", "company_name").drop("votes")
    return tickers.join(modal, "cik", "left").select(ident, "cik", "company_name", "primary_ticker", "ticker_count"), bridge.select(ident, "cik", "ticker", "exchange", F.col("name").alias("company_name"), "source")


def filing_master(index: DataFrame, companies: DataFrame, first: str, last: str, form: str = "10-K", expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(master, bridge): the latest filing of each company within the dates; of one day the first line of the first file."""
    rows = index.withColumn("cik", cik10(F.col("cik"))).where((F.col("form") == form) & F.col("filing_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    best = top_n(rows, ["cik"], [F.desc("filing_date"), F.asc("file"), F.asc("line")])
    accession = F.regexp_replace(F.element_at(F.split("filename", "/"), -1), r"\.[^.]*$", "")
    bare = F.replace(accession, F.lit("-"), F.lit(""))
    master = best.select(
        F.concat_ws(":", F.lit("SEC_CIK_ACCESSION"), "cik", bare).alias("canonical_filing_id"), accession.alias("accession"), bare.alias("accession_nodash"), "cik", F.concat(F.lit("SEC_CIK:"), F.col("cik")).alias("canonical_company_id"),
        F.col("company_name").alias("company_name_at_filing"), "form", "filing_date", F.year("filing_date").alias("filing_year"), F.col("filename").alias("sec_filename"), F.concat(F.lit("https://www.sec.gov/Archives/"), F.col("filename")).alias("sec_url"),
    )
    if expected is not None and (n := master.count()) != expected:
        raise ValueError(f"{n} filings, {expected} expected")
    known = companies.select("canonical_company_id", F.lit(True).alias("matched"))
    bridge = master.select("canonical_filing_id", "accession", "cik", "canonical_company_id").join(known, "canonical_company_id", "left").withColumn("matched", F.coalesce("matched", F.lit(False)))
    return master, bridge


def complete_companies(companies: DataFrame, filings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(companies of either table, each filing with its company): the name of the latest filing where the master has none, and a class of source by
    the tables a company stands in, named there or not."""
    named = F.when(F.col("company_name_at_filing").isNotNull(), F.struct("filing_date", "canonical_filing_id"))
    f = filings.groupBy("canonical_company_id").agg(F.max_by("company_name_at_filing", named).alias("filing_name"), F.count("*").cast("long").alias("filing_count"), F.min("filing_date").alias("first_filing_date"), F.max("filing_date").alias("latest_filing_date"), F.min("cik").alias("filing_cik"), F.lit(True).alias("filed"))
    j = companies.withColumn("listed", F.lit(True)).join(f, "canonical_company_id", "full")
    listed, filed = F.coalesce("listed", F.lit(False)), F.coalesce("filed", F.lit(False))
    whole = j.select(
        "canonical_company_id", F.coalesce("cik", "filing_cik").alias("cik"), F.coalesce("company_name", "filing_name").alias("company_name"), "primary_ticker", F.coalesce("ticker_count", F.lit(0)).cast("int").alias("ticker_count"),
        listed.alias("in_ticker_master"), filed.alias("in_filing_universe"), F.coalesce("filing_count", F.lit(0)).alias("filing_count"), "first_filing_date", "latest_filing_date",
        F.when(listed & filed, "SEC_TICKER+FILING").when(listed, "SEC_TICKER").otherwise("SEC_FILING").alias("source_class"),
    )
    of = filings.select("canonical_company_id", "canonical_filing_id", "cik", "accession", "filing_date").join(whole.select("canonical_company_id", "company_name", "primary_ticker", "ticker_count", "source_class"), "canonical_company_id")
    return whole, of


def section_bridge(index: DataFrame, filings: DataFrame, sections: int = 3) -> tuple[DataFrame, DataFrame]:
    """(bridge, uncovered filings): section rows of filings that have all their sections, counts read from text."""
    whole = index.groupBy("cik", "filename").agg(F.count("*").alias("n"), F.countDistinct("section").alias("d")).where((F.col("n") == sections) & (F.col("d") == sections)).select("cik", "filename")
    rows = index.join(whole, ["cik", "filename"]).withColumn("cik", cik10(F.col("cik")))
    key = filings.select("canonical_filing_id", "canonical_company_id", "cik", F.col("sec_filename").alias("filename"))
    numbers = {c: try_bigint(F.col(c)) for c in ("raw_bytes", "word_count", "char_count") if c in index.columns}
    bridge = rows.join(key, ["cik", "filename"]).withColumns(numbers)
    return bridge, filings.join(bridge.select("canonical_filing_id").distinct(), "canonical_filing_id", "left_anti")

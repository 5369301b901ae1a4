"""Text corpus: page audit, records from pages, topic indexes and OCR merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.functions.rank import islands, top_n
from lakequery.functions.text import choose_ocr, nfkc, slug
from lakequery.operators.joins import keyword_hits


def script_counts(text: Column) -> dict[str, Column]:
    return {"arabic": F.regexp_count(text, F.lit(r"[؀-ۿݐ-ݿࢠ-ࣿ]")), "latin": F.regexp_count(text, F.lit("[A-Za-z]")), "replacement": F.regexp_count(text, F.lit("�"))}


def page_audit(pages: DataFrame, group: str, size: Column, low: int = 40) -> DataFrame:
    return pages.groupBy(group).agg(F.count("*").alias("pages"), F.avg(size).alias("mean_chars"), F.percentile(size, F.lit(0.5)).alias("median_chars"), F.count_if(size < low).alias("low_text"))


def records(pages: DataFrame, keys: list[str], order: str, marker: str) -> DataFrame:
    """Pages that match the marker begin a record; what follows belongs to it."""
    return islands(pages, keys, order, F.col("text").rlike(marker), "text")


def marked_records(pages: DataFrame, keys: list[str], order: str, marker: str, groups: int) -> DataFrame:
    """Records that begin at a marker anywhere in a page: keys, record, refs (what the marker's groups hold), start_page and text, trimmed at its
    beginning; what stands before the first marker of a page, or on a page without one, goes on with the record before, on a line of its own. What
    stands before the first marker of all is left out."""
    refs = [F.regexp_extract_all("text", F.lit(marker), F.lit(g + 1)) for g in range(groups)]
    cut = pages.select(*keys, F.col(order).alias("start_page"), F.posexplode(F.split("text", marker, -1)).alias("place", "piece"), F.array(*refs).alias("all_refs"))
    mine = F.when(F.col("place") > 0, F.transform("all_refs", lambda r: F.get(r, F.col("place") - 1)))
    cut = cut.select(*keys, "start_page", mine.alias("refs"), F.struct("start_page", "place").alias("at"), F.when(F.col("place") > 0, F.trim("piece")).otherwise(F.col("piece")).alias("piece"))
    cut = cut.where("refs is not null or piece <> ''")
    joined = islands(cut, keys, "at", F.col("refs").isNotNull(), "piece")
    w = W.partitionBy(*keys).orderBy("at")
    begun = cut.where("refs is not null").withColumn("record", F.row_number().over(w).cast("long")).select(*keys, "record", "refs", "start_page")
    return begun.join(joined, [*keys, "record"]).select(*keys, "record", "refs", "start_page", "text")


def book_audit(pages: DataFrame, book: str, low: int = 80) -> DataFrame:
    """By book: pages, characters, blank and short pages, pages whose text is OCR, characters of each script and unreadable ones."""
    n, scripts = F.length(F.coalesce("text", F.lit(""))), script_counts(F.coalesce("text", F.lit("")))
    total = lambda c, name: F.sum(c).cast("long").alias(name)
    return pages.groupBy(book).agg(
        F.count("*").alias("pages"), total(n, "total_chars"), F.count_if(n == 0).alias("blank_page_count"), F.count_if(n < low).alias("low_text_page_count"), F.count_if(F.col("method") == "ocr_fallback").alias("ocr_fallback_page_count"),
        total(scripts["replacement"], "replacement_char_count"), total(scripts["arabic"], "arabic_script_chars_total"), total(scripts["latin"], "latin_chars_total"),
    )


def ocr_audit(pages: DataFrame, book: str, least_confidence: float = 45, least_chars: int = 40) -> DataFrame:
    """By book: pages, first and last page, mean and median confidence, and pages of low confidence or little text."""
    weak = F.col("mean_conf").isNull() | (F.col("mean_conf") < least_confidence) | (F.coalesce("ocr_chars", F.lit(0)) < least_chars)
    return pages.groupBy(book).agg(
        F.count("*").alias("pages"), F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.round(F.avg("mean_conf"), 2).alias("mean_page_conf"), F.round(F.percentile("mean_conf", F.lit(0.5)), 2).alias("median_page_conf"),
        F.count_if(weak).alias("low_conf_or_low_text_count"), F.coalesce(F.sum("ocr_chars"), F.lit(0)).alias("total_ocr_chars"), F.coalesce(F.sum("embedded_chars"), F.lit(0)).alias("total_embedded_chars"),
    )


def page_ranges(start: int, end: int, pages: int, workers: int) -> list[tuple[int, int]]:
    """Even ranges of pages for workers, within a book; a range without a page is an error."""
    start, end = max(1, start), min(end, pages)
    if start > end:
        raise ValueError("invalid page range")
    step = -(-(end - start + 1) // max(1, min(workers, end - start + 1)))
    return [(s, min(end, s + step - 1)) for s in range(start, end + 1, step)]


def hits_of(df: DataFrame, topics: list[tuple[int, str, list[str]]], excerpt: int = 1200) -> DataFrame:
    """Rows of df by topic (number, title, terms): topic_id, topic, the terms that their text holds, in the topic's order, and an excerpt on one line."""
    norm = df.withColumn("_n", nfkc(F.col("text")))
    listed = F.array(*(F.struct(F.lit(i).alias("topic_id"), F.lit(t).alias("topic"), F.array(*map(F.lit, ws)).alias("ws")) for i, t, ws in topics))
    found = norm.withColumn("_t", F.explode(listed)).withColumn("matched_terms", F.filter("_t.ws", lambda w: F.contains(F.col("_n"), F.lower(w)))).where(F.size("matched_terms") > 0)
    return found.select("_t.topic_id", "_t.topic", *df.drop("text").columns, "matched_terms", F.substring(F.regexp_replace("text", r"\s+", " "), 1, excerpt).alias("text_excerpt"))


def corpus_tables(pages: DataFrame, topics: list[tuple[int, str, list[str]]], marker: str, groups: int, book: str = "book_key") -> dict[str, DataFrame]:
    """The whole pipeline after extraction: pages with OCR text where theirs is weak, audit by book, records, records by topic and pages by topic."""
    chosen = choose_ocr(F.coalesce("text", F.lit("")), F.coalesce("ocr_text", F.lit("")))
    whole = pages.select(book, "page", chosen.alias("text"), F.when(chosen != F.coalesce("text", F.lit("")), "ocr_fallback").otherwise("embedded_text").alias("method"))
    found = marked_records(whole, [book], "page", marker, groups)
    return {"pages": whole, "audit": book_audit(whole, book), "records": found, "candidates": hits_of(found, topics), "page_hits": hits_of(whole, topics)}


def topic_index(docs: DataFrame, topics: dict[str, list[str]], most: int = 300, excerpt: int = 1200) -> DataFrame:
    """Documents by topic, with the terms that hit: the first ones of each topic."""
    terms = [(t, w) for t, ws in topics.items() for w in ws]
    hits = keyword_hits(docs.withColumn("_n", nfkc(F.col("text"))), terms, F.col("_n"))
    grouped = hits.groupBy("topic", "doc_id").agg(F.array_sort(F.collect_set("term")).alias("terms"), F.first(F.substring("text", 1, excerpt)).alias("excerpt"))
    return top_n(grouped, ["topic"], [F.asc("doc_id")], most).withColumn("topic_slug", slug(F.col("topic")))


def merge_ocr(pages: DataFrame) -> DataFrame:
    """Of each page the last record (by file and line), its text chosen between embedded and OCR text."""
    last = top_n(pages, ["page"], [F.desc("file"), F.desc("line")])
    return last.withColumn("text", choose_ocr(F.coalesce("text", F.lit("")), F.coalesce("ocr_text", F.lit(""))))

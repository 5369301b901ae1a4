"""Registered queries of the engine's own operators on the TPC-H-like tables, each with the oracle's SQL.

orders stand for works, lineitem for their edges, customers and suppliers for companies, documents and pages for the corpus, events for a state log."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.functions import rank, text
from lakequery.operators import catalog, corpus, joins, marts, mergeable, quality, research, resolve
from lakequery.sources import stored
from lakequery.sources.tables import read_in_order, shared_folder, within_budget

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Lake:
    """The tables of a folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def views(self, *names: str) -> None:
        for n in names:
            getattr(self, n).createOrReplaceTempView(n)


def query(name: str, sql: str | None):
    def keep(f):
        QUERIES[name] = lambda spark, sf_dir: f(Lake(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return keep


def _works_of(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("publication_year"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cited_by_count"))


def _works(t: Lake) -> DataFrame:
    return _works_of(t.orders)


def _edges(t: Lake) -> DataFrame:
    """Lines with the supplier as institution and its nation as country."""
    place = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    return t.lineitem.select("l_orderkey", "l_suppkey").join(place, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("work_id"), F.col("l_suppkey").alias("institution_id"), F.col("n_name").alias("institution_country_code"))


WORKS = "w AS (SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS publication_year, CAST(round(o_totalprice * 100) AS BIGINT) AS cites FROM orders)"
MEAN = "CAST(sum(cites) AS BIGINT) AS citation_sum, CAST(sum(cites) AS DOUBLE) / nullif(count(DISTINCT id), 0) AS mean_citations"


@query("q01_year_metrics", f"WITH {WORKS} SELECT publication_year, count(*) AS work_count, {MEAN} FROM w GROUP BY ALL")
def _(t):
    return marts.year_marts(_works(t))["WORK_YEAR_METRICS"]


@query("q02_year_topic", f"WITH {WORKS} SELECT publication_year, l_partkey AS topic_id, count(DISTINCT id) AS work_count, {MEAN}, sum(l_quantity) AS topic_score_sum FROM lineitem JOIN w ON l_orderkey = id GROUP BY ALL")
def _(t):
    topics = t.lineitem.select(F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("topic_id"), F.col("l_quantity").alias("topic_score"))
    return marts.year_marts(_works(t), topics=topics)["WORK_YEAR_TOPIC"]


@query("q03_year_institution_fanout", f"WITH {WORKS}, e AS (SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem) SELECT publication_year, l_suppkey AS institution_id, count(DISTINCT id) AS work_count, {MEAN} FROM e JOIN w ON l_orderkey = id GROUP BY ALL")
def _(t):
    e = t.lineitem.select(F.col("l_orderkey").alias("work_id"), F.col("l_suppkey").alias("institution_id"), F.col("l_returnflag").alias("institution_country_code"))
    return marts.year_marts(_works(t), institutions=e)["WORK_YEAR_INSTITUTION"]


PLACED = "e AS (SELECT DISTINCT l_orderkey AS work_id, n_name AS country FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"


@query("q04_year_country", f"WITH {WORKS}, {PLACED} SELECT publication_year, country AS country_code, count(DISTINCT id) AS work_count, {MEAN} FROM e JOIN w ON work_id = id GROUP BY ALL")
def _(t):
    return marts.year_marts(_works(t), institutions=_edges(t))["WORK_YEAR_COUNTRY"]


@query("q05_country_collab_year", f"WITH {WORKS}, {PLACED} SELECT publication_year, a.country AS country_a, b.country AS country_b, count(DISTINCT id) AS work_count, {MEAN} FROM e a JOIN e b ON a.work_id = b.work_id AND a.country < b.country JOIN w ON a.work_id = id GROUP BY ALL")
def _(t):
    pairs = joins.unordered_pairs(_edges(t).withColumnRenamed("institution_country_code", "country"), ["work_id"], "country")
    return marts.year_marts(_works(t), collaboration=pairs)["COUNTRY_COLLAB_YEAR"]


@query("q06_partial_reduce", f"WITH {WORKS} SELECT publication_year, count(*) AS work_count, {MEAN} FROM w GROUP BY ALL")
def _(t):
    shard = F.pmod("o_orderkey", F.lit(8))
    partial = t.orders.groupBy(shard.alias("shard"), F.year("o_orderdate").alias("publication_year")).agg(F.count("*").alias("work_count"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("citation_sum"))
    return marts.reduce_partials(partial.drop("shard"), [])


LINE = ("l_extendedprice", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _top_line(t: Lake, keys: list[str], first: list, sort: tuple[str, ...]) -> DataFrame:
    return rank.top_n(t.lineitem, keys, [*first, *(F.asc_nulls_last(c) for c in sort)]).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")


def _top_sql(keys: str, first: str, sort: tuple[str, ...]) -> str:
    return f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus FROM lineitem QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {first}, {', '.join(sort)}) = 1"


@query("q07_top1_topic_edge", _top_sql("l_orderkey, l_partkey", "l_extendedprice DESC", LINE[1:]))
def _(t):
    return _top_line(t, ["l_orderkey", "l_partkey"], [F.desc_nulls_last("l_extendedprice")], LINE[1:])


@query("q08_top1_author_edge", _top_sql("l_orderkey", "CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_linestatus", ("l_partkey", *LINE)))
def _(t):
    case = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return _top_line(t, ["l_orderkey"], [case.asc(), F.asc_nulls_last("l_linestatus")], ("l_partkey", *LINE))


@query("q09_top1_3key", _top_sql("l_orderkey, l_suppkey, l_partkey", "l_quantity DESC", LINE))
def _(t):
    return _top_line(t, ["l_orderkey", "l_suppkey", "l_partkey"], [F.desc_nulls_last("l_quantity")], LINE)


@query("q10_explode_edges", r"SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS token FROM documents")
def _(t):
    tokens = F.array_distinct(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return t.documents.select("doc_id", F.explode(tokens).alias("token")).distinct()


@query("q11_nested_explode", "SELECT DISTINCT l_orderkey AS work_id, l_suppkey AS institution_id, l_partkey AS topic_id FROM lineitem")
def _(t):
    nested = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.collect_set("l_partkey").alias("parts")).groupBy("l_orderkey").agg(F.collect_list(F.struct("l_suppkey", "parts")).alias("s"))
    return nested.select("l_orderkey", F.explode("s").alias("s")).select(F.col("l_orderkey").alias("work_id"), F.col("s.l_suppkey").alias("institution_id"), F.explode("s.parts").alias("topic_id"))


@query("q12_edge_clean", "SELECT DISTINCT work_id, referenced_work_id FROM (SELECT l_orderkey AS work_id, nullif(l_partkey % 50, 7) AS referenced_work_id FROM lineitem) WHERE referenced_work_id IS NOT NULL")
def _(t):
    from lakequery.operators.curate import clean_edges

    e = t.lineitem.select(F.col("l_orderkey").alias("work_id"), F.nullif(F.col("l_partkey") % 50, F.lit(7).cast("long")).alias("referenced_work_id"))
    return clean_edges("CITATION_EDGES", e.union(e))


def _catalog(t: Lake) -> dict[str, DataFrame]:
    s = lambda c, a: F.col(c).cast("string").alias(a)
    pairs = joins.unordered_pairs(_edges(t).withColumnRenamed("institution_country_code", "country"), ["work_id"], "country")
    return {
        "WORK_MASTER": t.orders.select(s("o_orderkey", "id"), "o_orderstatus", "o_orderpriority"),
        "TOPIC_MASTER": t.part.where("p_size > 5").select(s("p_partkey", "id"), "p_name", "p_brand"),
        "AUTHOR_MASTER": t.supplier.where("s_acctbal > 0").select(s("s_suppkey", "id"), "s_name"),
        "WORK_TOPIC_EDGES": t.lineitem.select(s("l_orderkey", "work_id"), s("l_partkey", "topic_id"), F.col("l_quantity").alias("topic_score")),
        "WORK_AUTHOR_EDGES": t.lineitem.select(s("l_orderkey", "work_id"), s("l_suppkey", "author_id")).distinct(),
        "COUNTRY_COLLAB_EDGES": pairs.select(F.col("work_id").cast("string").alias("work_id"), "country_a", "country_b", F.concat(F.lit("orders/"), F.col("work_id")).alias("_source_key")),
        "CITATION_EDGES": t.lineitem.select(s("l_orderkey", "work_id"), s("l_partkey", "referenced_work_id")).distinct(),
    }


def _macro(name: str, call: str, sql: str) -> None:
    @query(name, sql)
    def _(t):
        catalog.build_catalog(t.spark, _catalog(t))
        return t.spark.sql(call)


_macro("q13_macro_work", "SELECT * FROM work('7')", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey = 7")
_macro("q14_macro_work_topics", "SELECT * FROM work_topics('7')", "SELECT CAST(l_orderkey AS VARCHAR) AS work_id, CAST(l_partkey AS VARCHAR) AS topic_id, l_quantity AS topic_score, p_name, p_brand FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 5) ON l_partkey = p_partkey WHERE l_orderkey = 7")
_macro("q15_macro_author_works", "SELECT * FROM author_works('5')", "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS work_id, CAST(l_suppkey AS VARCHAR) AS author_id, o_orderstatus, o_orderpriority FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey = 5")
_macro("q16_macro_coauthors", "SELECT * FROM coauthors('5')", "SELECT CAST(b.l_suppkey AS VARCHAR) AS coauthor_id, count(DISTINCT b.l_orderkey) AS shared_work_count FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey WHERE a.l_suppkey = 5 GROUP BY ALL")
_macro("q17_macro_country_partners", "SELECT * FROM country_collaborations('NATION_3')", f"WITH {PLACED} SELECT CAST(a.work_id AS VARCHAR) AS work_id, least(a.country, b.country) AS country_a, greatest(a.country, b.country) AS country_b, b.country AS partner_country, 'orders/' || a.work_id AS _source_key FROM e a JOIN e b ON a.work_id = b.work_id AND a.country <> b.country WHERE a.country = 'NATION_3'")
_macro("q18_macro_citations_to", "SELECT * FROM citations_to('3')", "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS work_id, CAST(l_partkey AS VARCHAR) AS referenced_work_id FROM lineitem WHERE l_partkey = 3")

RUNNER = "WITH b AS (SELECT c_mktsegment, count(*) AS customers, sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS cents FROM customer GROUP BY c_mktsegment) SELECT c_mktsegment, customers, CAST(cents AS BIGINT) AS cents FROM b WHERE customers > 1"


@query("q19_sql_runner", RUNNER)
def _(t):
    t.views("customer")
    return catalog.read_only(t.spark, RUNNER + ";")


WIDTHS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}


@query("q20_catalog_counts", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows, CAST({k} AS BIGINT) AS n_columns FROM {n}" for n, k in WIDTHS.items()))
def _(t):
    return catalog.catalog_of(t.spark, {n: getattr(t, n) for n in TABLES})


@query("q21_columns_catalog", " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(ordinal AS BIGINT) AS ordinal, column_name FROM (SELECT row_number() OVER () - 1 AS ordinal, column_name FROM (DESCRIBE SELECT * FROM {n}))" for n in TABLES))
def _(t):
    return catalog.columns_of(t.spark, {n: getattr(t, n) for n in TABLES}).select("table_name", "ordinal", "column_name")


@query("q22_dup_keys", "SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)")
def _(t):
    return quality.duplicates(t.lineitem, ["l_orderkey", "l_partkey"])


@query("q23_invalid_keys", "SELECT 'documents' AS name, count(*) FILTER (WHERE doc_id IS NULL OR nullif(lang, 'de') IS NULL) AS invalid FROM documents UNION ALL SELECT 'pages', count(*) FILTER (WHERE page_id IS NULL OR url IS NULL OR url = '') FROM pages")
def _(t):
    d = t.documents.select("doc_id", F.nullif("lang", F.lit("de")).alias("lang")).agg(F.count_if(quality.invalid_key(["doc_id", "lang"])).alias("invalid"))
    p = t.pages.agg(F.count_if(quality.invalid_key(["page_id", "url"])).alias("invalid"))
    return d.select(F.lit("documents").alias("name"), "invalid").union(p.select(F.lit("pages").alias("name"), "invalid"))


CHECKS = {"quantity over 45": "l_quantity > 45", "no discount": "l_discount = 0", "returned": "l_returnflag = 'R'", "open": "l_linestatus = 'O'", "first line": "l_linenumber = 1", "taxed high": "l_tax > 0.07", "cheap": "l_extendedprice < 1000", "null key": "l_orderkey IS NULL"}


@query("q24_checks_onepass", " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) FILTER (WHERE {p}) AS value FROM lineitem" for n, p in CHECKS.items()))
def _(t):
    return quality.checks(t.lineitem, {n: F.expr(p) for n, p in CHECKS.items()})


@query("q25_reconcile", "WITH e AS (SELECT DISTINCT doc_id FROM documents), a AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN doc_id ELSE doc_id + 1000000 END AS doc_id FROM labels) SELECT coalesce(e.doc_id, a.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'missing' WHEN e.doc_id IS NULL THEN 'unexpected' ELSE 'matched' END AS class FROM e FULL JOIN a ON e.doc_id = a.doc_id")
def _(t):
    moved = t.labels.select(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")).otherwise(F.col("doc_id") + 1000000).alias("doc_id"))
    return joins.reconcile(t.documents, moved, "doc_id")


@query("q26_modal_name", "SELECT p_brand, p_type AS modal_type, n AS votes FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1")
def _(t):
    return rank.mode_by(t.part, ["p_brand"], "p_type", "modal_type")


@query("q27_merge_tags", "SELECT user_id, string_agg(event_type, '+' ORDER BY event_type) AS tags FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def _(t):
    return t.events.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), "+").alias("tags"))


@query("q28_latest_per_key", "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def _(t):
    return rank.top_n(t.orders, ["o_custkey"], [F.desc_nulls_last("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "q29_argmax_profile",
    """WITH o AS (SELECT o_custkey, count(*) AS n, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey),
    c AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0), ids AS (SELECT c_custkey AS k FROM c UNION SELECT o_custkey FROM o)
    SELECT k, c_name, coalesce(n, 0) AS n_orders, last_priority, first_date, last_date, CASE WHEN c_name IS NOT NULL AND n IS NOT NULL THEN 'BOTH' WHEN c_name IS NOT NULL THEN 'MASTER' ELSE 'ORDER' END AS source_class FROM ids LEFT JOIN c ON k = c_custkey LEFT JOIN o ON k = o_custkey""",
)
def _(t):
    o = t.orders.where("o_orderstatus <> 'P'").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"), F.min("o_orderdate").cast("date").alias("first_date"), F.max("o_orderdate").cast("date").alias("last_date"))
    c = t.customer.where("c_acctbal > 0").select("c_custkey", "c_name")
    ids = c.select(F.col("c_custkey").alias("k")).union(o.select("o_custkey")).distinct()
    j = ids.join(c, F.col("k") == F.col("c_custkey"), "left").join(o, F.col("k") == F.col("o_custkey"), "left")
    cls = F.when(F.col("c_name").isNotNull() & F.col("n").isNotNull(), "BOTH").when(F.col("c_name").isNotNull(), "MASTER").otherwise("ORDER")
    return j.select("k", "c_name", F.coalesce("n", F.lit(0)).alias("n_orders"), "last_priority", "first_date", "last_date", cls.alias("source_class"))


@query("q30_composite_join_trycast", "SELECT l_orderkey, l_linenumber, l_partkey, TRY_CAST(CASE l_linenumber % 4 WHEN 0 THEN '12.7' WHEN 1 THEN '1e2' WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE 'x' || l_quantity END AS BIGINT) AS n FROM lineitem JOIN (SELECT o_orderkey, o_orderkey % 7 AS d FROM orders) o ON l_orderkey = o_orderkey AND l_linenumber = d")
def _(t):
    k = F.col("l_linenumber") % 4
    s = F.when(k == 0, "12.7").when(k == 1, "1e2").when(k == 2, F.col("l_quantity").cast("long").cast("string")).otherwise(F.concat(F.lit("x"), F.col("l_quantity").cast("string")))
    o = t.orders.select("o_orderkey", (F.col("o_orderkey") % 7).alias("d"))
    return t.lineitem.join(o, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_linenumber") == F.col("d"))).select("l_orderkey", "l_linenumber", "l_partkey", text.try_bigint(s).alias("n"))


@query("q31_notin_uncovered", "SELECT 'no order in 1996' AS kind, c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996) UNION ALL SELECT 'three lines', l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 3 AND count(DISTINCT l_suppkey) = 3")
def _(t):
    year = t.orders.where(F.year("o_orderdate") == 1996).select(F.col("o_custkey").alias("c_custkey"))
    none = t.customer.join(year, "c_custkey", "left_anti").select(F.lit("no order in 1996").alias("kind"), F.col("c_custkey").alias("k"))
    three = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.countDistinct("l_suppkey").alias("d")).where("n = 3 AND d = 3")
    return none.union(three.select(F.lit("three lines"), "l_orderkey"))


NORM = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g'))"


@query("q32_norm_name", f"SELECT p_partkey AS k, {NORM.format('p_name')} AS norm FROM part UNION ALL SELECT page_id, {NORM.format('url')} FROM pages")
def _(t):
    return t.part.select(F.col("p_partkey").alias("k"), text.norm_name(F.col("p_name")).alias("norm")).union(t.pages.select("page_id", text.norm_name(F.col("url"))))


BRANDED = "p_brand || ' ' || p_name"


@query(
    "q33_exact_unique_match",
    f"""WITH l AS (SELECT p_partkey, {NORM.format(BRANDED)} AS n FROM part), r AS (SELECT DISTINCT {BRANDED} AS name, {NORM.format(BRANDED)} AS n FROM part), lc AS (SELECT *, count(*) OVER (PARTITION BY n) AS c FROM l), rc AS (SELECT *, count(*) OVER (PARTITION BY n) AS c FROM r)
    SELECT CAST(p_partkey AS VARCHAR) AS canonical_company_id, name AS openalex_institution_id, lc.c AS sec_name_count, rc.c AS openalex_name_count, 'NORMALIZED_EXACT' AS match_method, lc.c = 1 AND rc.c = 1 AS accepted, CASE WHEN lc.c = 1 AND rc.c = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM lc JOIN rc ON lc.n = rc.n""",
)
def _(t):
    name = F.concat_ws(" ", "p_brand", "p_name")
    c = t.part.select(F.col("p_partkey").cast("string").alias("canonical_company_id"), name.alias("company_name"))
    i = t.part.select(name.alias("id"), name.alias("display_name")).distinct()
    return resolve.exact_bridge(c, i).select("canonical_company_id", "openalex_institution_id", "sec_name_count", "openalex_name_count", "match_method", "accepted", "confidence")


SUFFIXED = BRANDED + " || CASE p_partkey % 6 WHEN 0 THEN ' Co Ltd' WHEN 1 THEN ', Inc.' WHEN 2 THEN ' Holdings Group' WHEN 3 THEN ' LLP (Pty)' WHEN 4 THEN ' and the Trust SE' ELSE '' END"
# The legal forms, spelled out here so that the SQL is no echo of the Python.
CORE = r"trim(regexp_replace({0}, '(?:(?:^| )(?:inc|incorporated|corp|corporation|co|company|ltd|limited|plc|llc|lp|llp|sa|ag|nv|bv|spa|srl|gmbh|pte|pty|holdco)\b)+$', ''))"
SKIPPED = "'', 'the', 'of', 'and', 'for', 'a', 'an', 'inc', 'incorporated', 'corp', 'corporation', 'co', 'company', 'ltd', 'limited', 'plc', 'llc', 'lp', 'llp', 'sa', 'ag', 'nv', 'bv', 'spa', 'srl', 'gmbh', 'pte', 'pty', 'holdco'"


def _suffixed() -> Column:
    k = F.col("p_partkey") % 6
    return F.concat("p_brand", F.lit(" "), "p_name", F.when(k == 0, " Co Ltd").when(k == 1, ", Inc.").when(k == 2, " Holdings Group").when(k == 3, " LLP (Pty)").when(k == 4, " and the Trust SE").otherwise(""))


@query("q34_legal_core", f"WITH n AS (SELECT p_partkey, {NORM.format(SUFFIXED)} AS norm FROM part), c AS (SELECT *, {CORE.format('norm')} AS core FROM n), w AS (SELECT *, list_filter(string_split(core, ' '), lambda x: x NOT IN ({SKIPPED})) AS ws FROM c) SELECT p_partkey, norm, core, CASE WHEN len(ws) >= 2 THEN array_to_string(list_transform(ws, lambda x: x[1]), '') ELSE '' END AS acro, replace(core, ' ', '') AS flat FROM w")
def _(t):
    n = t.part.select("p_partkey", text.norm_name(_suffixed()).alias("norm")).withColumn("core", text.legal_core(F.col("norm")))
    return n.select("*", text.acronym(F.col("core")).alias("acro"), text.compact(F.col("core")).alias("flat"))


@query(
    "q35_core_match",
    f"""WITH l AS (SELECT p_partkey, {CORE.format(NORM.format(SUFFIXED))} AS core FROM part), r AS (SELECT DISTINCT {BRANDED} AS name, {NORM.format(BRANDED)} AS core FROM part), lc AS (SELECT *, count(*) OVER (PARTITION BY core) AS c FROM l), rc AS (SELECT *, count(*) OVER (PARTITION BY core) AS c FROM r)
    SELECT CAST(p_partkey AS VARCHAR) AS canonical_company_id, name AS openalex_institution_id, lc.c = 1 AS unique_sec_core, rc.c = 1 AS unique_openalex_core, CASE WHEN lc.c = 1 AND rc.c = 1 THEN 0.98::DOUBLE ELSE 0.7::DOUBLE END AS confidence, CASE WHEN lc.c = 1 AND rc.c = 1 THEN 'HIGH' ELSE 'REVIEW' END AS tier, lc.c = 1 AND rc.c = 1 AS accepted FROM lc JOIN rc ON lc.core = rc.core WHERE lc.core <> ''""",
)
def _(t):
    c = t.part.select(F.col("p_partkey").cast("string").alias("canonical_company_id"), _suffixed().alias("company_name"))
    name = F.concat_ws(" ", "p_brand", "p_name")
    none = t.spark.createDataFrame([], "canonical_company_id string, openalex_institution_id string")
    scored = resolve.scored_bridge(c, t.part.select(name.alias("id"), name.alias("display_name")).distinct(), none)
    return scored.where(F.col("method") == resolve.CORE).select("canonical_company_id", "openalex_institution_id", "unique_sec_core", "unique_openalex_core", "confidence", "tier", "accepted")


@query("q36_fuzzy_blocked", None)
def _(t):
    left = t.part.select(F.col("p_partkey").cast("string").alias("canonical_company_id"), F.col("p_name").alias("company_name"))
    right = t.part.groupBy(F.col("p_name").alias("display_name")).agg(F.min("p_partkey").cast("string").alias("id"))
    none = t.spark.createDataFrame([], "canonical_company_id string, openalex_institution_id string")
    return resolve.scored_bridge(left, right, none).select("canonical_company_id", "openalex_institution_id", "method", "confidence", "accepted", "candidate_rank", "best_margin")


@query("q37_accepted_union", "WITH e AS (SELECT c_custkey AS a, CAST(floor(c_acctbal) AS BIGINT) AS b FROM customer WHERE c_mktsegment = 'BUILDING'), s AS (SELECT s_suppkey AS a, CAST(floor(s_acctbal) AS BIGINT) AS b FROM supplier) SELECT a, b, 'EXACT' AS provenance FROM e UNION ALL SELECT a, b, 'SCORED' FROM s WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.a = s.a OR e.b = s.b)")
def _(t):
    e = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("a"), F.floor("c_acctbal").alias("b"))
    s = t.supplier.select(F.col("s_suppkey").alias("a"), F.floor("s_acctbal").alias("b"))
    return e.withColumn("provenance", F.lit("EXACT")).unionByName(joins.anti_any(s, e, ["a", "b"]).withColumn("provenance", F.lit("SCORED")))


@query("q38_review_queue", "SELECT l_suppkey, l_partkey, l_orderkey, l_extendedprice FROM lineitem WHERE l_returnflag <> 'A' AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY nullif(l_extendedprice, 0) DESC NULLS LAST, l_orderkey, l_partkey, l_linenumber) = 1")
def _(t):
    done = t.supplier.where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    best = rank.top_n(t.lineitem.where("l_returnflag <> 'A'"), ["l_suppkey"], [F.desc_nulls_last(F.nullif("l_extendedprice", F.lit(0.0))), F.asc("l_orderkey"), F.asc("l_partkey"), F.asc("l_linenumber")])
    return best.join(done, "l_suppkey", "left_anti").select("l_suppkey", "l_partkey", "l_orderkey", "l_extendedprice")


DESCRIPTIONS = ("CANADA", "France", "Germany (West)", "NORTH CHINA", "Republic of Korea", "U.S.A.", "Virgin Islands, British", "Netherlands Antilles", None, "UNITED STATES OF AMERICA")
THEIRS = ("CA", "fr", " DE ", "CN", None, "", "KR")
LINKS = """links AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'quarantine' ELSE 'review' END AS bucket,
  CASE WHEN c_custkey % 11 = 0 THEN 'US' ELSE (['CA', 'FR', 'DE', 'CN', 'KR', NULL, 'VG', 'NL', NULL, 'US'])[1 + n_nationkey % 10] END AS sec, (['CA', 'FR', 'DE', 'CN', NULL, NULL, 'KR'])[1 + c_custkey % 7] AS oa,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'education' WHEN 'FURNITURE' THEN NULL ELSE 'Company' END AS kind, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE (90 + c_custkey % 10) / 100.0::DOUBLE END AS confidence,
  CASE c_custkey % 5 WHEN 0 THEN 'FUZZY_CORE' WHEN 1 THEN NULL WHEN 2 THEN 'NORMALIZED_EXACT' ELSE 'LEGAL_CORE_EXACT' END AS method, CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN '  ' ELSE 'r' END AS ror
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
JUDGED = f"""{LINKS}, compared AS (SELECT *, sec IS NOT NULL AND oa IS NOT NULL AS comparable, coalesce(sec = oa, false) AS same, coalesce(sec <> oa, false) AS clash, coalesce(lower(kind) = 'company', false) AS firm, trim(coalesce(ror, '')) <> '' AS has_ror, coalesce(confidence, 0) AS sure FROM links),
judged AS (SELECT *, CASE WHEN clash THEN 'REJECT' WHEN bucket = 'accepted' THEN 'KEEP_PRODUCTION'
  WHEN bucket = 'quarantine' THEN CASE WHEN firm AND has_ror AND sure >= 0.98 AND (same OR NOT comparable) THEN 'PROMOTE' WHEN same AND has_ror AND sure >= 0.98 THEN 'REVIEW_PRIORITY' ELSE 'KEEP_QUARANTINE' END
  WHEN same AND firm AND has_ror AND sure >= 0.965 THEN 'PROMOTE' WHEN same AND has_ror AND sure >= 0.93 THEN 'REVIEW_PRIORITY' ELSE 'KEEP_REVIEW' END AS decision FROM compared)"""


def _links(t: Lake) -> DataFrame:
    """Customers as links to institutions of their own, with metadata of both sides."""
    k = F.col("c_custkey")
    pickone = lambda values, at: F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (at + 1).cast("int"))
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k, k.cast("string").alias("canonical_company_id"), F.concat(F.lit("i"), k).alias("openalex_institution_id"), pickone(THEIRS, k % 7).alias("country_code"),
        F.when(F.col("c_mktsegment") == "BUILDING", "education").when(F.col("c_mktsegment") != "FURNITURE", "Company").alias("institution_type"), F.when(k % 9 != 0, (90 + k % 10) / F.lit(100.0)).alias("confidence"),
        F.when(k % 5 == 0, "FUZZY_CORE").when(k % 5 == 2, "NORMALIZED_EXACT").when(k % 5 > 2, "LEGAL_CORE_EXACT").alias("match_method"), F.when(k % 8 == 1, "  ").when(k % 8 > 1, "r").alias("ror"),
        pickone(DESCRIPTIONS, F.col("n_nationkey") % 10).alias("business_state_or_country_description"), F.when(k % 11 == 0, "tx ").when(k % 11 < 3, "TX").alias("business_state_or_country"),
        F.when(k % 11 == 0, "No").when(k % 11 == 1, "yes").when(k % 11 > 2, "false").alias("business_is_foreign_location"),
    )


def _judged(t: Lake) -> DataFrame:
    links = _links(t)
    about = links.select("canonical_company_id", "business_state_or_country", "business_state_or_country_description", "business_is_foreign_location")
    bucket = lambda n: links.where(F.col("c_custkey") % 3 == n).select("canonical_company_id", "openalex_institution_id", "country_code", "institution_type", "confidence", "match_method" if n != 2 else F.col("match_method").alias("method"), "ror")
    return resolve.reclassify(about, bucket(0), bucket(1), bucket(2))[0]


@query("q39_promote_case", f"WITH {LINKS} SELECT id AS canonical_company_id, CASE WHEN confidence < 0.98 THEN 'LOW_CONFIDENCE' WHEN method NOT IN ('NORMALIZED_EXACT', 'LEGAL_CORE_EXACT') THEN 'METHOD_NOT_PRODUCTION_APPROVED' WHEN kind IS NULL OR lower(kind) <> 'company' THEN 'OPENALEX_TYPE_NOT_COMPANY' WHEN ror IS NULL OR trim(ror) = '' THEN 'ROR_MISSING' ELSE '<NULL>' END AS quarantine_reason FROM links")
def _(t):
    production, quarantine = resolve.promote(_links(t).select("canonical_company_id", "openalex_institution_id", "confidence", "match_method", "institution_type", "ror"))
    return production.select("canonical_company_id", F.lit("<NULL>").alias("quarantine_reason")).union(quarantine.select("canonical_company_id", "quarantine_reason"))


@query("q40_geo_decision", f"WITH {JUDGED} SELECT id AS canonical_company_id, bucket AS source_bucket, sec AS sec_business_country_iso2, oa AS openalex_country_iso2, same AS country_match, clash AS country_conflict, decision AS reclassification_decision, decision IN ('KEEP_PRODUCTION', 'PROMOTE') AS production_approved_v2 FROM judged")
def _(t):
    return _judged(t).select("canonical_company_id", "source_bucket", "sec_business_country_iso2", "openalex_country_iso2", "country_match", "country_conflict", "reclassification_decision", "production_approved_v2")


@query("q41_adjudicate", "SELECT CAST(s_suppkey AS VARCHAR) AS canonical_company_id, 'i' || s_suppkey AS openalex_institution_id, NULL::VARCHAR AS reclassification_decision, NULL::VARCHAR AS adjudication_version FROM supplier WHERE s_acctbal >= 4000 UNION SELECT CAST(s_suppkey AS VARCHAR), 'i' || s_suppkey, 'REVIEW_PRIORITY', 'v1' FROM supplier WHERE s_acctbal < 4000 AND s_nationkey < 9")
def _(t):
    s = t.supplier.select(F.col("s_suppkey").cast("string").alias("canonical_company_id"), F.concat(F.lit("i"), "s_suppkey").alias("openalex_institution_id"), "s_acctbal", "s_nationkey")
    every = s.drop("s_acctbal", "s_nationkey")
    decisions = s.select("canonical_company_id", F.when(F.col("s_nationkey") < 9, "PROMOTE").otherwise("KEEP_REVIEW").alias("decision"))
    return resolve.adjudicate(s.where("s_acctbal >= 4000").drop("s_acctbal", "s_nationkey"), every.withColumn("reclassification_decision", F.lit("REVIEW_PRIORITY")), decisions, "v1", "REVIEW_PRIORITY")


@query(
    "q42_rank_unresolved",
    f"""WITH {JUDGED}, settled AS (SELECT k FROM links WHERE k % 20 = 4 OR k % 20 = 13), scored AS (SELECT id, k, coalesce(confidence, 0) * 100 + 12 * CAST(firm AS INTEGER) + 8 * CAST(has_ror AS INTEGER) + 15 * CAST(same AS INTEGER) - 100 * CAST(clash AS INTEGER)
      + 5 * CASE method WHEN 'NORMALIZED_EXACT' THEN 3 WHEN 'LEGAL_CORE_EXACT' THEN 2 WHEN 'FUZZY_CORE' THEN 1 ELSE 0 END + CASE WHEN bucket = 'quarantine' THEN 3 ELSE 0 END AS score,
      CASE WHEN clash THEN 'BLOCKED_COUNTRY_CONFLICT' WHEN same AND firm AND has_ror AND confidence >= 0.93 THEN 'TIER_A_STRONG' WHEN same AND has_ror AND confidence >= 0.90 THEN 'TIER_B_GOOD' WHEN has_ror AND confidence >= 0.90 THEN 'TIER_C_MODERATE' ELSE 'TIER_D_LOW' END AS tier
      FROM judged WHERE decision NOT IN ('KEEP_PRODUCTION', 'PROMOTE', 'REJECT') AND k NOT IN (SELECT k FROM settled))
    SELECT id AS canonical_company_id, tier AS review_tier, round(score, 6) AS review_score, row_number() OVER (ORDER BY CASE tier WHEN 'TIER_A_STRONG' THEN 1 WHEN 'TIER_B_GOOD' THEN 2 WHEN 'TIER_C_MODERATE' THEN 3 WHEN 'TIER_D_LOW' THEN 4 ELSE 5 END, round(score, 6) DESC, id) AS review_rank FROM scored""",
)
def _(t):
    k = F.col("c_custkey")
    at = lambda version, decision: t.customer.select(k.cast("string").alias("canonical_company_id"), decision.alias("decision"), F.lit(version).alias("version"), F.lit(0).alias("position")).where("decision is not null")
    # a later version takes back the promotions of every second one of the first
    decisions = at(3, F.when(k % 10 == 4, "PROMOTE").when(k % 20 == 13, "REJECT")).union(at(4, F.when(k % 20 == 14, "KEEP_REVIEW")))
    return resolve.rank_unresolved(_judged(t), decisions).select("canonical_company_id", "review_tier", F.round("review_score", 6).alias("review_score"), "review_rank")


TARGET = "g AS (SELECT DISTINCT l_suppkey AS s, l_orderkey AS work_id, CAST(year(o_orderdate) AS INTEGER) AS publication_year, CAST(round(o_totalprice * 100) AS BIGINT) AS cites FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _production(t: Lake) -> DataFrame:
    return t.supplier.select(F.concat(F.lit("c"), "s_suppkey").alias("canonical_company_id"), F.col("s_suppkey").alias("openalex_institution_id"), F.lit(1.0).alias("confidence"))


@query("q43_company_year", f"WITH {WORKS}, e AS (SELECT DISTINCT l_orderkey, l_suppkey, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey), m AS (SELECT publication_year, l_suppkey, count(DISTINCT id) AS work_count, {MEAN} FROM e JOIN w ON l_orderkey = id GROUP BY ALL) SELECT s_name AS company_name, publication_year, work_count, citation_sum, mean_citations FROM m JOIN supplier ON l_suppkey = s_suppkey")
def _(t):
    from lakequery.operators.research import company_year

    org = t.supplier.select(F.concat(F.lit("c"), "s_suppkey").alias("canonical_company_id"), F.col("s_name").alias("company_name"))
    m = marts.year_marts(_works(t), institutions=_edges(t))["WORK_YEAR_INSTITUTION"]
    return company_year(org, _production(t), m)[0].select("company_name", "publication_year", "work_count", "citation_sum", "mean_citations")


@query("q44_company_topic_year", f"WITH {TARGET} SELECT 'c' || s AS canonical_company_id, publication_year, l_partkey AS topic_id, count(DISTINCT work_id) AS work_count, CAST(sum(cites) AS BIGINT) AS citation_sum, sum(l_quantity) AS topic_score_sum FROM g JOIN lineitem ON l_orderkey = work_id GROUP BY ALL")
def _(t):
    from lakequery.operators.research import company_topic_year

    topics = t.lineitem.select(F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("topic_id"), F.col("l_quantity").alias("topic_score"))
    return company_topic_year(_production(t), marts.works_of(_works(t)), _edges(t), topics).drop("openalex_institution_id")


@query("q45_company_collab_year", f"WITH {TARGET}, o AS (SELECT DISTINCT l_orderkey, l_suppkey, n_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey), e AS (SELECT s, publication_year, n_name, work_id, cites, count(DISTINCT l_suppkey) AS p FROM g JOIN o ON l_orderkey = work_id AND l_suppkey <> s GROUP BY ALL) SELECT 'c' || s AS canonical_company_id, publication_year, n_name AS partner_country, count(*) AS work_count, CAST(sum(p) AS BIGINT) AS collaborator_institution_count, CAST(sum(cites) AS BIGINT) AS citation_sum FROM e GROUP BY ALL")
def _(t):
    from lakequery.operators.research import company_collaboration_year

    return company_collaboration_year(_production(t), marts.works_of(_works(t)), _edges(t)).drop("openalex_institution_id")


MARTS = """research AS (SELECT o_custkey AS c, year(o_orderdate) AS y, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cites FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
topic AS (SELECT nullif(o_custkey, 9) AS c, year(o_orderdate) AS y, CASE WHEN o_orderkey % 977 = 0 THEN '' ELSE o_orderpriority END AS topic_id, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cites FROM orders GROUP BY ALL UNION ALL SELECT o_custkey, year(o_orderdate), o_orderpriority, -1, 1 FROM orders WHERE o_totalprice > 499900),
collab AS (SELECT o_custkey AS c, year(o_orderdate) AS y, o_orderstatus AS country, count(*) AS n, count(DISTINCT o_orderpriority) AS partners, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cites FROM orders GROUP BY ALL),
prod AS (SELECT c_custkey AS c, 'i' || CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS i FROM customer WHERE c_acctbal > 0)"""
MART_SQL = {
    "topic_duplicate_keys": "FROM (SELECT 1 FROM topic GROUP BY c, y, topic_id HAVING count(*) > 1)",
    "collaboration_duplicate_keys": "FROM (SELECT 1 FROM collab GROUP BY c, y, country HAVING count(*) > 1)",
    "topic_null_keys": "FROM topic WHERE c IS NULL OR y IS NULL OR topic_id IS NULL OR topic_id = ''",
    "collaboration_null_keys": "FROM collab WHERE c IS NULL OR y IS NULL OR country IS NULL OR country = ''",
    "topic_negative_metrics": "FROM topic WHERE n < 0 OR cites < 0",
    "collaboration_negative_metrics": "FROM collab WHERE n < 0 OR partners < 0 OR cites < 0",
    "topic_nonproduction_leaks": "FROM topic t LEFT JOIN prod p ON t.c = p.c WHERE p.c IS NULL",
    "collaboration_nonproduction_leaks": "FROM collab t LEFT JOIN prod p ON t.c = p.c WHERE p.c IS NULL",
    "topic_institution_identity_mismatch": "FROM topic t JOIN prod p ON t.c = p.c WHERE 'i' || t.c <> p.i",
    "collaboration_institution_identity_mismatch": "FROM collab t JOIN prod p ON t.c = p.c WHERE 'i' || t.c <> p.i",
    "topic_row_work_exceeds_research_year": "FROM topic t JOIN research r ON t.c = r.c AND t.y = r.y WHERE t.n > r.n",
    "topic_row_citations_exceed_research_year": "FROM topic t JOIN research r ON t.c = r.c AND t.y = r.y WHERE t.cites > r.cites",
    "collaboration_row_work_exceeds_research_year": "FROM collab t JOIN research r ON t.c = r.c AND t.y = r.y WHERE t.n > r.n",
    "collaboration_row_citations_exceed_research_year": "FROM collab t JOIN research r ON t.c = r.c AND t.y = r.y WHERE t.cites > r.cites",
    "topic_rows_without_research_year": "FROM topic t LEFT JOIN research r ON t.c = r.c AND t.y = r.y WHERE r.c IS NULL",
    "collaboration_rows_without_research_year": "FROM collab t LEFT JOIN research r ON t.c = r.c AND t.y = r.y WHERE r.c IS NULL",
    "collaborator_count_less_than_work_count_impossible": "FROM collab WHERE partners < n",
}


@query("q46_mart_leak_checks", f"WITH {MARTS} " + " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) AS value {w}" for n, w in MART_SQL.items()))
def _(t):
    from lakequery.operators.research import company_mart_checks

    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("citation_sum")
    o = t.orders.withColumns({"canonical_company_id": F.col("o_custkey").cast("string"), "publication_year": F.year("o_orderdate")})
    with_institution = lambda df: df.withColumn("openalex_institution_id", F.concat(F.lit("i"), "canonical_company_id"))
    research = o.where("o_orderstatus <> 'P'").groupBy("canonical_company_id", "publication_year").agg(F.count("*").alias("work_count"), cents)
    topic = o.withColumns({"canonical_company_id": F.nullif("canonical_company_id", F.lit("9")), "topic_id": F.when(F.col("o_orderkey") % 977 == 0, "").otherwise(F.col("o_orderpriority"))}).groupBy("canonical_company_id", "publication_year", "topic_id").agg(F.count("*").alias("work_count"), cents, F.lit(0.0).alias("topic_score_sum"))
    odd = o.where("o_totalprice > 499900").select("canonical_company_id", "publication_year", F.col("o_orderpriority").alias("topic_id"), F.lit(-1).alias("work_count"), F.lit(1).alias("citation_sum"), F.lit(0.0).alias("topic_score_sum"))
    collab = o.groupBy("canonical_company_id", "publication_year", F.col("o_orderstatus").alias("collaborator_country_code")).agg(F.count("*").alias("collaborative_work_count"), F.countDistinct("o_orderpriority").alias("collaborator_institution_count"), cents)
    prod = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("canonical_company_id"), F.concat(F.lit("i"), F.when(F.col("c_custkey") % 5 == 0, 0).otherwise(F.col("c_custkey"))).alias("openalex_institution_id"))
    return company_mart_checks(prod, research, with_institution(topic.union(odd)), with_institution(collab))


@query("q47_delta", "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last, count(*) AS n_rows FROM orders WHERE year(o_orderdate) = 1996 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1995) GROUP BY o_custkey")
def _(t):
    from lakequery.operators.research import delta

    o = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("d"), F.year("o_orderdate").alias("y"))
    return delta(o.where("y = 1995"), o.where("y = 1996"), "o_custkey", "d")


TERMS = [("speech", "the"), ("speech", "tion"), ("motion", "ing "), ("motion", "heit"), ("place", "onde"), ("place", "eau")]


@query("q48_keyword_hits", "SELECT doc_id, topic, term FROM documents, (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TERMS) + ") AS k(topic, term) WHERE contains(lower(text), term)")
def _(t):
    return joins.keyword_hits(t.documents.select("doc_id", "text"), TERMS, F.lower("text")).select("doc_id", "topic", "term")


@query("q49_script_counts", r"SELECT doc_id, CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS latin, CAST(length(regexp_replace(text, '[\x00-\x7f]', '', 'g')) AS BIGINT) AS beyond FROM documents")
def _(t):
    return t.documents.select("doc_id", corpus.script_counts(F.col("text"))["latin"].cast("long").alias("latin"), F.regexp_count("text", F.lit(r"[^\x00-\x7f]")).cast("long").alias("beyond"))


@query("q50_island_records", "WITH m AS (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS record FROM conversations) SELECT conv_id, CAST(record AS BIGINT) AS record, count(*) AS n_rows, string_agg(text, chr(10) ORDER BY turn) AS text FROM m WHERE record > 0 GROUP BY ALL")
def _(t):
    return rank.islands(t.conversations, ["conv_id"], "turn", F.col("role") == "user", "text")


@query("q51_page_audit", "SELECT source, count(*) AS pages, avg(n_chars) AS mean_chars, median(n_chars) AS median_chars, count(*) FILTER (WHERE n_chars < 40) AS low_text FROM documents GROUP BY source")
def _(t):
    return corpus.page_audit(t.documents, "source", F.col("n_chars"))


@query("q52_last_wins", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    return rank.top_n(t.events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("q53_html_sniff", "SELECT kind, html, count(*) AS n FROM (SELECT 'page' AS kind, regexp_matches(lower(ltrim(substr(html, 1, 2048))), '^<(!doctype html|html|head>)') AS html FROM pages UNION ALL SELECT 'document', regexp_matches(lower(ltrim(substr(text, 1, 2048))), '^<(!doctype html|html|head>)') FROM documents) GROUP BY ALL UNION ALL SELECT CASE WHEN code = 304 THEN 'unchanged' WHEN code BETWEEN 200 AND 299 THEN 'ok' WHEN code IN (401, 403) THEN 'forbidden' WHEN code = 404 THEN 'missing' WHEN code = 429 THEN 'throttled' WHEN code >= 500 THEN 'server error' ELSE 'unexpected' END, NULL, count(*) FROM (SELECT 200 + event_id % 320 AS code FROM events) GROUP BY 1")
def _(t):
    both = t.pages.select(F.lit("page").alias("kind"), text.looks_html(F.col("html")).alias("html")).union(t.documents.select(F.lit("document"), text.looks_html(F.col("text"))))
    codes = t.events.groupBy(text.http_diagnosis(200 + F.col("event_id") % 320).alias("kind")).agg(F.count("*").alias("n"))
    return both.groupBy("kind", "html").agg(F.count("*").alias("n")).union(codes.select("kind", F.lit(None).cast("boolean"), "n"))


@query("q54_url_filename", "SELECT page_id, string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '/')[-1] AS file FROM pages")
def _(t):
    return t.pages.select("page_id", text.url_file(F.col("url")).alias("file"))


@query("q55_byte_budget", "SELECT doc_id, CAST(running AS BIGINT) AS running FROM (SELECT doc_id, sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS running FROM documents) WHERE running <= 100000")
def _(t):
    return within_budget(t.documents.select("doc_id", "n_chars"), 100000, key="doc_id", size="n_chars").select("doc_id", "running")


@query("q56_state_rollup", "WITH s AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) SELECT event_type AS status, count(*) AS files, CAST(coalesce(sum(event_id), 0) AS BIGINT) AS bytes FROM s GROUP BY ALL")
def _(t):
    from lakequery.operators.ingest import roll_up

    state = rank.top_n(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return roll_up(state.select(F.col("event_type").alias("status"), F.col("event_id").alias("bytes")), "status")


@query("q57_trailing_window", "SELECT event_id, event_type FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 DAY AND event_type IN ('click', 'view') ORDER BY ts DESC, event_id DESC LIMIT 50")
def _(t):
    last = t.events.agg(F.max("ts").alias("m")).scalar()
    return t.events.where((F.col("ts") >= last - F.make_interval(days=F.lit(3))) & F.col("event_type").isin("click", "view")).orderBy(F.desc("ts"), F.desc("event_id")).limit(50).select("event_id", "event_type")


@query("q58_tier_select", "SELECT p_partkey, p_brand FROM part WHERE CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 25 THEN 1 WHEN p_size <= 40 THEN 2 ELSE 3 END <= 1 AND (regexp_matches(p_brand, '#1') OR regexp_matches(p_type, 'STEEL'))")
def _(t):
    tier = F.when(F.col("p_size") <= 10, 0).when(F.col("p_size") <= 25, 1).when(F.col("p_size") <= 40, 2).otherwise(3)
    return t.part.where((tier <= 1) & (F.col("p_brand").rlike("#1") | F.col("p_type").rlike("STEEL"))).select("p_partkey", "p_brand")


@query("q59_bh_fdr", "WITH p AS (SELECT p_partkey, (p_partkey * 37 % 1999 + 1) / 2000.0::DOUBLE AS p FROM part), r AS (SELECT *, count(*) OVER () AS m, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS pos FROM p) SELECT p_partkey, p, round(least(1.0::DOUBLE, min(p * m / pos) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)), 9) AS fdr FROM r")
def _(t):
    p = t.part.select("p_partkey", ((F.col("p_partkey") * 37 % 1999 + 1) / F.lit(2000.0)).alias("p"))
    return rank.benjamini_hochberg(p, "p", "fdr").select("p_partkey", "p", F.round("fdr", 9).alias("fdr"))


@query("q60_inventory", "SELECT split_part(split_part(url, '://', 2), '/', 1) AS folder, count(*) AS objects, CAST(sum(length(html)) AS BIGINT) AS bytes, min(sha256(url)) AS least_digest FROM pages GROUP BY ALL")
def _(t):
    folder = F.split_part(F.split_part("url", F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))
    return t.pages.groupBy(folder.alias("folder")).agg(F.count("*").alias("objects"), F.sum(F.length("html")).cast("long").alias("bytes"), F.min(F.sha2("url", 256)).alias("least_digest"))


@query("q61_modulo_shard", "SELECT page_id, url FROM (SELECT page_id, url, row_number() OVER (ORDER BY url, page_id) - 1 AS pos FROM pages) WHERE pos % 7 = 3")
def _(t):
    from lakequery.functions.rank import global_rank

    ranked = global_rank(t.pages.select("page_id", "url"), [F.asc("url"), F.asc("page_id")], "at")
    return ranked.where((F.col("at") - 1) % 7 == 3).select("page_id", "url")


@query("q62_unique_id_average", "WITH p AS (SELECT list_distinct(regexp_extract_all(upper(p_name || ' ' || p_brand || CASE WHEN p_partkey % 5 = 0 THEN ' brand#1' ELSE '' END), 'BRAND#[0-9]+')) AS ids, log2(p_retailprice) AS v, CAST(p_size AS DOUBLE) AS w FROM part) SELECT ids[1] AS id, round(avg(v), 9) AS v, round(avg(w), 9) AS w FROM p WHERE len(ids) = 1 GROUP BY ALL")
def _(t):
    from lakequery.operators.panel import average_replicates, log2_values, only_id

    text_ = F.concat_ws(" ", "p_name", "p_brand", F.when(F.col("p_partkey") % 5 == 0, "brand#1"))
    rows = t.part.select(only_id(text_, "BRAND#[0-9]+").alias("id"), log2_values(F.array("p_retailprice"))[0].alias("v"), F.col("p_size").cast("double").alias("w"))
    return average_replicates(rows, "id", ["v", "w"]).select("id", F.round("v", 9).alias("v"), F.round("w", 9).alias("w"))


@query("q63_target_lookup", "WITH g AS (SELECT s_suppkey AS id FROM supplier), r AS (SELECT c_custkey AS id, c_acctbal AS fc, (c_custkey * 37 % 1999 + 1) / 2000.0::DOUBLE AS p FROM customer WHERE c_mktsegment <> 'BUILDING'), j AS (SELECT g.id, fc, p FROM g LEFT JOIN r ON g.id = r.id), k AS (SELECT *, count(*) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS n, count(*) OVER () AS m FROM j WHERE p IS NOT NULL), f AS (SELECT id, least(1.0::DOUBLE, min(p * m / n) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS fdr FROM k) SELECT 'customers' AS dataset, 'x-y' AS contrast, j.id, fc AS log2FC, p AS PValue, round(fdr, 9) AS FDR_panel FROM j LEFT JOIN f ON j.id = f.id")
def _(t):
    from lakequery.operators.panel import bound, target_results

    k = F.col("c_custkey")
    results = t.customer.where("c_mktsegment <> 'BUILDING'").select(k.alias("id"), F.col("c_acctbal").alias("log2FC"), ((k * 37 % 1999 + 1) / F.lit(2000.0)).alias("PValue"))
    rows = target_results(t.supplier.select(F.col("s_suppkey").alias("id")), results, "id", ["log2FC", "PValue"], "customers", "x-y")
    return bound([rows.withColumn("FDR_panel", F.round("FDR_panel", 9))], ["dataset", "contrast", "id", "log2FC", "PValue", "FDR_panel"])


@query("q64_like_parameters", "SELECT p_partkey, p_brand, p_type FROM part WHERE p_brand LIKE 'Brand#1%' AND p_brand LIKE '%3' AND p_type = 'ECONOMY' AND p_size BETWEEN 5 AND 30")
def _(t):
    from lakequery.sources.tables import like_between

    sized = t.spark.sql("SELECT * FROM {part} WHERE p_type = :type AND p_size BETWEEN :first AND :last", args={"type": "ECONOMY", "first": 5, "last": 30}, part=t.part)
    return like_between(sized, "p_brand", "Brand#1", "3").select("p_partkey", "p_brand", "p_type")


@query("q65_shard_names", "SELECT page_id, substr(sha256(url), 1, 16) || '.parquet' AS shard, sha256(html) AS digest FROM pages")
def _(t):
    from lakequery.sources.tables import shard_name

    return t.pages.select("page_id", shard_name(F.col("url")).alias("shard"), F.sha2("html", 256).alias("digest"))


@query("q66_tolerance", "SELECT l_orderkey, l_linenumber, l_partkey, abs(l_discount - l_tax) > 0.0200001 AS apart FROM lineitem")
def _(t):
    from lakequery.operators.panel import differs

    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", differs("l_discount", F.col("l_tax"), 0.0200001).alias("apart"))


@query("q67_prefer_ok", "WITH s AS (SELECT user_id, event_id, CASE event_type WHEN 'click' THEN 'OK' ELSE 'FAILED' END AS status FROM events) SELECT user_id, coalesce(min(event_id) FILTER (WHERE status = 'OK'), max(event_id)) AS event_id, CASE WHEN bool_or(status = 'OK') THEN 'OK' ELSE 'FAILED' END AS status FROM s GROUP BY user_id")
def _(t):
    s = t.events.select("user_id", "event_id", F.when(F.col("event_type") == "click", "OK").otherwise("FAILED").alias("status"))
    return rank.prefer_ok(s, "user_id", "status", "event_id")


@query("q68_last_decisions", "SELECT CAST(user_id AS VARCHAR) AS canonical_company_id, arg_max(event_type, (user_id + event_id % 3, event_id)) AS decision FROM events GROUP BY user_id")
def _(t):
    d = t.events.select(F.col("user_id").cast("string").alias("canonical_company_id"), F.col("event_type").alias("decision"), (F.col("user_id") + F.col("event_id") % 3).alias("version"), F.col("event_id").alias("position"))
    return resolve.last_decisions(d)


@query("q69_company_number", "SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 10, '0') AS cik, TRY_CAST(CASE c_custkey % 3 WHEN 0 THEN '12.7' WHEN 1 THEN c_custkey || 'e1' ELSE 'n/a' END AS BIGINT) AS n, lower(trim(CASE c_custkey % 4 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'y' WHEN 2 THEN 'no' ELSE '' END)) IN ('1', 'true', 't', 'yes', 'y') AS truth FROM customer")
def _(t):
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, "12.7").when(k % 3 == 1, F.concat(k, F.lit("e1"))).otherwise("n/a")
    said = F.when(k % 4 == 0, " TRUE ").when(k % 4 == 1, "y").when(k % 4 == 2, "no").otherwise("")
    return t.customer.select(k, text.cik10(F.concat((k * 7919).cast("string"), F.lit(".0"))).alias("cik"), text.try_bigint(raw).alias("n"), text.truthy(said).alias("truth"))


@query("q70_required_actual", "SELECT 'labels' AS side, count(*) AS n FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents WHERE lang = 'en') UNION ALL SELECT 'documents', count(*) FROM (SELECT doc_id FROM documents WHERE lang = 'en' EXCEPT SELECT doc_id FROM labels)")
def _(t):
    english = t.documents.where("lang = 'en'").select("doc_id")
    count = lambda df, side: df.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return count(t.labels.select("doc_id").subtract(english), "labels").union(count(english.subtract(t.labels.select("doc_id")), "documents"))


def _shared(t: Lake, tag: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(t.spark)}/{tag}-{uuid.uuid4().hex}"


@query("q71_streamed_year_country", SQL["q04_year_country"])
def _(t):
    """The country mart from partials that a stream of the works has written."""
    from lakequery.streaming.incremental import refresh_marts, streamed_mart

    works = t.spark.readStream.schema(t.orders.schema).parquet(f"{t.sf_dir}/orders.parquet*")  # a pattern, as a stream takes no single file
    where = _shared(t, "streamed-marts")
    refresh_marts(t.spark, _works_of(works), lambda files: {"institutions": _edges(t)}, f"{where}/partials", f"{where}/checkpoint")
    return streamed_mart(t.spark, f"{where}/partials", "WORK_YEAR_COUNTRY")


@query("q72_overlapping_partials", SQL["q02_year_topic"])
def _(t):
    """The topic mart where every work comes in two of eight files, with its edges in both; both tables are dealt by work before they double."""
    twice = lambda df, key: df.repartition(key).select("*", F.explode(F.array(F.pmod(key, F.lit(8)), F.pmod(F.col(key) + 3, F.lit(8)))).alias("file"))
    topics = twice(t.lineitem.select(F.col("l_orderkey").alias("work_id"), F.col("l_partkey").alias("topic_id"), F.col("l_quantity").alias("topic_score")), "work_id")
    made = mergeable.mart_partials(twice(_works(t), "id"), topics=topics, file="file", dealt=True)
    return mergeable.merge_marts(made["WORK_YEAR_TOPIC"], "WORK_YEAR_TOPIC")


@query("q73_bucketed_institution_year", SQL["q03_year_institution_fanout"])
def _(t):
    """The institution mart of works and edges stored in buckets of the work."""
    where, name = _shared(t, "bucketed"), uuid.uuid4().hex
    e = t.lineitem.select(F.col("l_orderkey").alias("work_id"), F.col("l_suppkey").alias("institution_id"), F.col("l_returnflag").alias("institution_country_code"))
    works = stored.store_bucketed(_works(t), f"works_{name}", f"{where}/works", "id", 8)
    edges = stored.store_bucketed(e, f"edges_{name}", f"{where}/edges", "work_id", 8)
    return marts.year_marts(works, institutions=edges, dealt=True)["WORK_YEAR_INSTITUTION"]


NEW = "b AS (SELECT c_custkey AS canonical_company_id, c_name AS company_name, c_nationkey AS openalex_institution_id, CAST(year(o_orderdate) AS INTEGER) AS publication_year, count(*) AS work_count, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS citation_sum FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL), d AS (SELECT canonical_company_id, min(company_name) AS company_name, min(openalex_institution_id) AS openalex_institution_id, count(*) AS company_year_rows, min(publication_year) AS min_year, max(publication_year) AS max_year, CAST(sum(work_count) AS BIGINT) AS summed_work_count, CAST(sum(citation_sum) AS BIGINT) AS summed_citation_sum FROM b WHERE publication_year >= 1995 AND canonical_company_id NOT IN (SELECT canonical_company_id FROM b WHERE publication_year IN (1992, 1994)) GROUP BY canonical_company_id)"


def _company_years(t: Lake) -> DataFrame:
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("publication_year"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cites"))
    each = o.groupBy("o_custkey", "publication_year").agg(F.count("*").alias("work_count"), F.sum("cites").alias("citation_sum"))
    return each.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_custkey").alias("canonical_company_id"), F.col("c_name").alias("company_name"), F.col("c_nationkey").alias("openalex_institution_id"), "publication_year", "work_count", "citation_sum")


@query("q74_research_delta", f"WITH {NEW} SELECT * FROM d")
def _(t):
    y = _company_years(t)
    return research.research_delta(y.where("publication_year in (1992, 1994)"), y.where("publication_year >= 1995"))


@query("q75_research_delta_summary", f"WITH {NEW} SELECT (SELECT count(DISTINCT canonical_company_id) FROM b WHERE publication_year IN (1992, 1994)) AS base_research_companies, (SELECT count(DISTINCT canonical_company_id) FROM b WHERE publication_year >= 1995) AS candidate_research_companies, (SELECT count(*) FROM customer) AS candidate_bridge_rows, count(*) AS new_companies_with_research, CAST(coalesce(sum(company_year_rows), 0) AS BIGINT) AS new_company_year_rows, CAST(coalesce(sum(summed_work_count), 0) AS BIGINT) AS new_summed_work_count, CAST(coalesce(sum(summed_citation_sum), 0) AS BIGINT) AS new_summed_citation_sum FROM d")
def _(t):
    y = _company_years(t)
    return research.research_delta_summary(y.where("publication_year in (1992, 1994)"), y.where("publication_year >= 1995"), t.customer)


@query("q76_ordered_output", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders")
def _(t):
    """An ordered query written by the runner, with the place at which its files hold each row."""
    t.views("orders")
    where = _shared(t, "ordered")
    catalog.execute_query(t.spark, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey", where)
    return read_in_order(t.spark, where, "place")


from lakequery.plans import file_queries  # noqa: E402, F401  it registers queries of its own

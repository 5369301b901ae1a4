"""Registered queries of sources and sinks, which write the given tables in a format and read them back, and of masters, edges and states built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequery.operators import curate, identity, moderated, resolve
from lakequery.plans.queries import Lake, _shared, query
from lakequery.sources import stored, tables


@query("q77_csv_as_text", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def _(t):
    where = _shared(t, "csv")
    tables.write_csv(t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), where)
    return tables.read_text_csv(t.spark, where)


@query("q78_partitioned_folders", "SELECT o_orderstatus, 'o_orderstatus=' || o_orderstatus AS folder, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY ALL")
def _(t):
    where = _shared(t, "partitioned")
    tables.write_parquet(t.orders, where, ["o_orderstatus"], refuse_empty=True)
    back = tables.read_tables(t.spark, where, base=where, lineage=True)
    return back.groupBy("o_orderstatus", F.element_at(F.split("filename", "/"), -2).alias("folder")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("q79_union_by_name", "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority FROM orders")
def _(t):
    """Files of which some lack a column."""
    where = _shared(t, "by-name")
    t.orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority", "o_totalprice").write.parquet(f"{where}/a")
    t.orders.where("o_orderstatus <> 'O'").select("o_totalprice", "o_orderkey").write.parquet(f"{where}/b")
    return tables.read_tables(t.spark, f"{where}/a", f"{where}/b").select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("q80_json_lines", "SELECT doc_id, lang, source, md5(text) AS digest, length(text) AS chars FROM documents")
def _(t):
    where = _shared(t, "jsonl")
    t.documents.write.json(where)
    back = tables.read_jsonl(t.spark, where, "doc_id long, text string, lang string, source string")
    return back.select("doc_id", "lang", "source", F.md5(F.col("text").cast("binary")).alias("digest"), F.length("text").cast("long").alias("chars"))


@query("q81_json_array", "SELECT p_partkey, p_name, p_brand, p_size FROM part")
def _(t):
    where = _shared(t, "array")
    tables.write_json_array(t.part.select("p_partkey", "p_name", "p_brand", "p_size"), where)
    return t.spark.read.schema("p_partkey long, p_name string, p_brand string, p_size int").option("multiLine", "true").json(where)


@query("q82_spreadsheet_csv", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def _(t):
    where = _shared(t, "signed")
    tables.write_csv_signed(t.supplier.select("s_suppkey", "s_name"), where)
    back = tables.read_text_csv(t.spark, where)
    return back.toDF(*(c.lstrip("\ufeff") for c in back.columns))


@query("q83_manifest", """SELECT '{"bytes": ' || CAST(sum(strlen(text)) AS BIGINT) || ', "files": ' || count(*) || ', "languages": ' || count(DISTINCT lang) || '}' AS manifest FROM documents""")
def _(t):
    found = tables.manifest(t.documents, {"files": "count(*)", "bytes": "sum(octet_length(text))", "languages": "count(distinct lang)"})
    return t.spark.createDataFrame([(found,)], "manifest string")


@query("q84_shard_files", "SELECT 'batch=' || lpad(CAST((r - 1) % 4 AS VARCHAR), 3, '0') || '/' || substr(sha256(source), 1, 16) || '.parquet' AS target, n, keys FROM (SELECT source, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS keys, row_number() OVER (ORDER BY source) AS r FROM documents WHERE source IS NOT NULL GROUP BY source)")
def _(t):
    """A file for each source, under the name of its shard; the second call finds nothing to do."""
    where = _shared(t, "shards")
    docs = t.documents.where("source is not null").select("doc_id", "source")
    stored.write_shards(docs, where, "source", 4)
    if stored.write_shards(docs, where, "source", 4):
        raise ValueError("shards were written twice")
    back = t.spark.read.parquet(f"{where}/batch=*").select("doc_id", F.regexp_extract(F.col("_metadata.file_path"), r"(batch=[0-9]+/[^/]+)$", 1).alias("target"))
    return back.groupBy("target").agg(F.count("*").alias("n"), F.sum("doc_id").alias("keys"))


@query("q85_catalog_tables", "SELECT 'TOPIC_MASTER' AS table_name, 'master' AS table_kind, count(*) AS row_count, 2 AS column_count FROM part UNION ALL SELECT 'WORK_TOPIC_EDGES', 'edge', count(*), 2 FROM lineitem")
def _(t):
    """What a persisted catalog says of its tables."""
    from lakequery.operators import catalog

    where = _shared(t, "catalog")
    name = "catalog_" + where.rpartition("-")[2]
    t.part.select(F.col("p_partkey").cast("string").alias("id"), "p_name").write.parquet(f"{where}/TOPIC_MASTER")
    t.lineitem.select(F.col("l_orderkey").cast("string").alias("work_id"), F.col("l_partkey").cast("string").alias("topic_id")).write.parquet(f"{where}/WORK_TOPIC_EDGES")
    catalog.persist_catalog(t.spark, {n: f"{where}/{n}" for n in ("TOPIC_MASTER", "WORK_TOPIC_EDGES")}, name)
    return t.spark.sql(f"SELECT table_name, table_kind, row_count, column_count FROM {name}.table_counts")


@query("q86_scalar_master", "SELECT p_partkey, p_name, p_size, 'parts/2024' AS _source_key FROM part")
def _(t):
    nested = t.part.select("p_partkey", "p_name", "p_size", F.struct("p_brand", "p_type").alias("kind"), F.array("p_brand").alias("brands"))
    return curate.scalar_master(nested, "parts/2024")


def _nested_works(t: Lake) -> DataFrame:
    """Orders as nested works: a line is an authorship, a topic and a reference."""
    s = lambda c: F.col(c).cast("string")
    place = F.when(F.col("l_linenumber") == 1, "first").when(F.col("l_linenumber") == 2, "last").when(F.col("l_linenumber") == 3, "middle").otherwise("other")
    author = F.struct(F.struct(s("l_suppkey").alias("id")).alias("author"), place.alias("author_position"), (F.col("l_returnflag") == "R").alias("is_corresponding"), F.array(F.struct(s("l_partkey").alias("id"), F.col("l_linestatus").alias("country_code"))).alias("institutions"), F.array("l_returnflag", "l_linestatus").alias("countries"))
    topic = F.struct(s("l_partkey").alias("id"), F.col("l_linestatus").alias("display_name"), F.col("l_quantity").alias("score"))
    return t.lineitem.groupBy(s("l_orderkey").alias("id")).agg(F.collect_list(author).alias("authorships"), F.collect_list(topic).alias("topics"), F.collect_list(s("l_suppkey")).alias("referenced_works"))


ROLE = "CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'last' WHEN 3 THEN 'middle' ELSE 'other' END"
BEST = f"l_returnflag = 'R' DESC, CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 3 END, {ROLE}"


@query(
    "q87_work_edges",
    f"""WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS w, CAST(l_suppkey AS VARCHAR) AS s, CAST(l_partkey AS VARCHAR) AS p, * FROM lineitem), k AS (SELECT DISTINCT w, c FROM (SELECT w, l_returnflag AS c FROM l UNION ALL SELECT w, l_linestatus FROM l))
    SELECT DISTINCT 'CITATION_EDGES' AS edge, w AS a, s AS b, NULL::VARCHAR AS c, NULL::VARCHAR AS d FROM l
    UNION ALL SELECT 'WORK_TOPIC_EDGES', w, p, l_linestatus, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) FROM l QUALIFY row_number() OVER (PARTITION BY w, p ORDER BY l_quantity DESC, l_linestatus) = 1
    UNION ALL SELECT 'WORK_AUTHOR_EDGES', w, s, {ROLE}, CAST(l_returnflag = 'R' AS VARCHAR) FROM l QUALIFY row_number() OVER (PARTITION BY w, s ORDER BY {BEST}) = 1
    UNION ALL SELECT 'AUTHOR_INSTITUTION_EDGES', w, s, p, l_linestatus FROM l QUALIFY row_number() OVER (PARTITION BY w, s, p ORDER BY {BEST}, l_linestatus) = 1
    UNION ALL SELECT 'COUNTRY_COLLAB_EDGES', x.w, x.c, y.c, NULL FROM k x JOIN k y ON x.w = y.w AND x.c < y.c""",
)
def _(t):
    edges = curate.work_edges(_nested_works(t), "k")
    show = {"CITATION_EDGES": ("referenced_work_id", None, None), "WORK_TOPIC_EDGES": ("topic_id", "topic_display_name", F.col("topic_score").cast("int")), "WORK_AUTHOR_EDGES": ("author_id", "author_position", "is_corresponding"), "AUTHOR_INSTITUTION_EDGES": ("author_id", "institution_id", "institution_country_code"), "COUNTRY_COLLAB_EDGES": ("country_a", "country_b", None)}
    out = None
    for name, cols in show.items():
        b, c, d = ((F.lit(None) if x is None else F.col(x) if isinstance(x, str) else x).cast("string") for x in cols)
        rows = edges[name].select(F.lit(name).alias("edge"), F.col("work_id").alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))
        out = rows if out is None else out.union(rows)
    return out


@query(
    "q88_curation_totals",
    """WITH raw AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS b FROM orders), st AS (SELECT l_orderkey AS k, CASE WHEN l_returnflag = 'N' THEN 'OK' ELSE 'FAILED' END AS s, CAST(floor(l_extendedprice) AS BIGINT) AS b_in, CAST(floor(l_quantity) AS BIGINT) AS b_out, CAST(l_suppkey AS BIGINT) * 1000000 + l_partkey * 10 + l_linenumber AS pos FROM lineitem WHERE l_quantity > 3),
    best AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY k ORDER BY s = 'OK' DESC, CASE WHEN s = 'OK' THEN pos ELSE -pos END) = 1), j AS (SELECT raw.k AS rk, raw.b, best.* FROM raw FULL JOIN best ON raw.k = best.k)
    SELECT count(rk) AS raw_count, CAST(sum(b) AS BIGINT) AS raw_bytes, count(k) AS distinct_keys, count_if(s = 'OK') AS state_ok, count_if(s = 'FAILED') AS state_failed, CAST(coalesce(sum(CASE WHEN s = 'OK' AND rk IS NOT NULL THEN b_in END), 0) AS BIGINT) AS state_bytes_in, CAST(coalesce(sum(CASE WHEN s = 'OK' AND rk IS NOT NULL THEN b_out END), 0) AS BIGINT) AS state_bytes_out,
    count_if(rk IS NOT NULL AND s IS DISTINCT FROM 'OK') AS missing_keys, count_if(rk IS NULL AND s = 'OK') AS unexpected_keys, (SELECT count(*) FROM st) AS state_rows, (SELECT count(*) FROM st) - count(k) AS duplicate_rows FROM j""",
)
def _(t):
    raw = t.orders.select(F.col("o_orderkey").alias("key"), F.floor("o_totalprice").alias("bytes"))
    status = F.when(F.col("l_returnflag") == "N", "OK").otherwise("FAILED").alias("status")
    at = (F.col("l_suppkey").cast("long") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("position")
    state = t.lineitem.where("l_quantity > 3").select(F.col("l_orderkey").alias("key"), status, F.floor("l_extendedprice").alias("bytes_in"), F.floor("l_quantity").alias("bytes_out"), at)
    found = curate.summarize_curated(raw, state)
    return t.spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} long" for k in found))


COMPANIES = """n AS (SELECT lpad(CAST(c_nationkey * 7 AS VARCHAR), 10, '0') AS cik, CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE upper(c_mktsegment) END AS ticker, c_mktsegment || ' of ' || c_nationkey % 3 AS name, CASE WHEN c_acctbal > 0 THEN 'X' || c_custkey ELSE '' END AS exchange, CASE WHEN c_acctbal < 5000 THEN 'company_tickers' ELSE 'company_tickers_exchange' END AS source, c_custkey AS ord FROM customer)"""


def _tickers(t: Lake) -> DataFrame:
    ticker = F.when(F.col("c_mktsegment") == "FURNITURE", "").otherwise(F.upper("c_mktsegment"))
    name = F.concat("c_mktsegment", F.lit(" of "), (F.col("c_nationkey") % 3).cast("string"))
    exchange = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("X"), "c_custkey")).otherwise("")
    source = F.when(F.col("c_acctbal") < 5000, "company_tickers").otherwise("company_tickers_exchange")
    return t.customer.select((F.col("c_nationkey") * 7).cast("string").alias("cik"), ticker.alias("ticker"), name.alias("name"), exchange.alias("exchange"), source.alias("source"), F.col("c_custkey").alias("ord"))


@query(
    "q89_company_master",
    f"""WITH {COMPANIES}, b AS (SELECT DISTINCT cik, ticker FROM n WHERE ticker <> ''), m AS (SELECT cik, name FROM (SELECT cik, name, count(*) AS v FROM n WHERE ticker <> '' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY cik ORDER BY v DESC, name) = 1)
    SELECT 'SEC_CIK:' || b.cik AS canonical_company_id, b.cik, any_value(m.name) AS company_name, min(ticker) AS primary_ticker, CAST(count(*) AS INTEGER) AS ticker_count FROM b LEFT JOIN m ON m.cik = b.cik GROUP BY b.cik""",
)
def _(t):
    return identity.company_master(_tickers(t))[0]


@query(
    "q90_ticker_bridge",
    f"""WITH {COMPANIES}, p AS (SELECT *, (CASE source WHEN 'company_tickers' THEN 0 ELSE 1 END, ord) AS place FROM n WHERE ticker <> '') SELECT 'SEC_CIK:' || cik AS canonical_company_id, cik, ticker, arg_min(exchange, place) FILTER (exchange <> '') AS exchange, arg_min(name, place) AS company_name, string_agg(DISTINCT source, '+' ORDER BY source) AS source FROM p GROUP BY cik, ticker""",
)
def _(t):
    return identity.company_master(_tickers(t))[1]


FILINGS = "f AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'C' || o_custkey AS company_name, CASE WHEN o_orderstatus = 'F' THEN '10-K' ELSE '8-K' END AS form, CAST(o_orderdate AS DATE) AS filing_date, 'edgar/data/' || o_custkey || '/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-95-000001.txt' AS filename, o_orderkey AS line FROM orders), m AS (SELECT * FROM f WHERE form = '10-K' AND filing_date BETWEEN DATE '1993-01-01' AND DATE '1996-12-31' QUALIFY row_number() OVER (PARTITION BY cik ORDER BY filing_date DESC, line) = 1), a AS (SELECT *, regexp_replace(split_part(filename, '/', 4), '\\.[^.]*$', '') AS acc FROM m)"


def _filings(t: Lake) -> tuple[DataFrame, DataFrame]:
    name = F.concat(F.lit("edgar/data/"), "o_custkey", F.lit("/"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-95-000001.txt"))
    index = t.orders.select(F.col("o_custkey").cast("string").alias("cik"), F.concat(F.lit("C"), "o_custkey").alias("company_name"), F.when(F.col("o_orderstatus") == "F", "10-K").otherwise("8-K").alias("form"), F.col("o_orderdate").cast("date").alias("filing_date"), name.alias("filename"), F.lit(0).alias("file"), F.col("o_orderkey").alias("line"))
    known = t.customer.where("c_acctbal > 0").select(F.concat(F.lit("SEC_CIK:"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")).alias("canonical_company_id"))
    return identity.filing_master(index, known, "1993-01-01", "1996-12-31")


@query(
    "q91_filing_master",
    f"WITH {FILINGS} SELECT 'SEC_CIK_ACCESSION:' || cik || ':' || replace(acc, '-', '') AS canonical_filing_id, acc AS accession, replace(acc, '-', '') AS accession_nodash, cik, 'SEC_CIK:' || cik AS canonical_company_id, company_name AS company_name_at_filing, form, filing_date, CAST(year(filing_date) AS INTEGER) AS filing_year, filename AS sec_filename, 'https://www.sec.gov/Archives/' || filename AS sec_url FROM a",
)
def _(t):
    return _filings(t)[0]


@query(
    "q92_filing_bridge",
    f"WITH {FILINGS} SELECT 'SEC_CIK:' || cik AS canonical_company_id, 'SEC_CIK_ACCESSION:' || cik || ':' || replace(acc, '-', '') AS canonical_filing_id, acc AS accession, cik, cik IN (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') FROM customer WHERE c_acctbal > 0) AS matched FROM a",
)
def _(t):
    return _filings(t)[1]


SEEN = "o AS (SELECT user_id, event_id, ts, event_type AS etag, CASE WHEN value < 20 THEN 'FAILED' WHEN value < 40 THEN 'UNCHANGED' ELSE 'OK' END AS status FROM events), g AS (SELECT *, last_value(CASE WHEN status = 'OK' THEN etag END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM o)"


@query(
    "q93_keyed_changes",
    f"WITH {SEEN} SELECT CAST(user_id AS VARCHAR) AS key, event_id AS position, CASE WHEN status = 'UNCHANGED' THEN 'unchanged' WHEN status = 'FAILED' THEN 'failed' WHEN was IS NULL THEN 'new' WHEN was = etag THEN 'unchanged' ELSE 'changed' END AS event FROM g UNION ALL SELECT CAST(user_id AS VARCHAR), NULL, 'vanished' FROM events GROUP BY user_id HAVING max(ts) + INTERVAL 3 DAY < (SELECT max(ts) FROM events)",
)
def _(t):
    """Events as observations of their users, judged by the state that a stream keeps of each; users that are not seen for three days vanish."""
    from lakequery.streaming.keyed_state import CHANGES, record_changes

    where = _shared(t, "changes")
    events = t.spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/events.parquet*")
    status = F.when(F.col("value") < 20, "FAILED").when(F.col("value") < 40, "UNCHANGED").otherwise("OK")
    observed = events.select(F.col("user_id").cast("string").alias("key"), status.alias("status"), F.col("event_type").alias("etag"), F.lit(None).cast("string").alias("modified"), F.col("event_id").alias("position"), F.col("ts").cast("timestamp").alias("at"))
    record_changes(t.spark, observed, f"{where}/out", f"{where}/checkpoint", gone_after="3 days")
    return t.spark.read.schema(CHANGES).parquet(f"{where}/out").select("key", "position", "event")


def _measured(t: Lake) -> tuple[DataFrame, DataFrame]:
    """Suppliers as ids, line numbers as samples of two groups, logarithms of mean prices as values."""
    values = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("id"), F.col("l_linenumber").cast("string").alias("sample")).agg(F.log(F.avg("l_extendedprice")).alias("value"))
    samples = t.lineitem.select(F.col("l_linenumber").alias("n")).distinct().select(F.col("n").cast("string").alias("sample"), F.when(F.col("n") <= 3, "early").otherwise("late").alias("grp"))
    return values, samples


@query(
    "q94_group_fit",
    "WITH v AS (SELECT l_suppkey, l_linenumber, ln(avg(l_extendedprice)) AS x, l_linenumber <= 3 AS early FROM lineitem GROUP BY ALL), g AS (SELECT l_suppkey, early, count(*) AS n, avg(x) AS m, var_pop(x) * count(*) AS ss FROM v GROUP BY ALL) SELECT CAST(l_suppkey AS VARCHAR) AS id, CAST(sum(n - 1) AS BIGINT) AS df, round(sum(ss) / nullif(sum(n - 1), 0), 7) AS s2, round(max(CASE WHEN early THEN m END), 7) AS early, round(max(CASE WHEN NOT early THEN m END), 7) AS late FROM g GROUP BY l_suppkey",
)
def _(t):
    fit = moderated.group_fit(*_measured(t), ["early", "late"])
    return fit.select("id", "df", F.round("s2", 7).alias("s2"), F.round("m_0", 7).alias("early"), F.round("m_1", 7).alias("late"))


@query("q95_moderated_t", None)
def _(t):
    return moderated.moderated_t(*_measured(t), {"late_early": {"late": 1.0, "early": -1.0}})


@query("q96_scaling_factors", None)
def _(t):
    """Parts as ids and line numbers as samples, with counts of lines."""
    counts = t.lineitem.groupBy(F.col("l_partkey").cast("string").alias("id"), F.col("l_linenumber").cast("string").alias("sample")).agg(F.count("*").alias("n"))
    return moderated.scaling_factors(counts)


@query("q97_fuzzy_names", None)
def _(t):
    """Part names with their brand and a legal form against names of which some types are spelled with other letters."""
    brand = F.replace("p_brand", F.lit("#"), F.lit(" "))
    left = t.part.select(F.col("p_partkey").cast("string").alias("canonical_company_id"), F.concat_ws(" ", "p_name", brand, F.when(F.col("p_type") == "PROMO", "Ltd").otherwise("Holdings Inc")).alias("company_name"))
    odd = F.when(F.col("p_type") == "ECONOMY", F.translate("p_name", "gt", "kd")).when(F.col("p_type") == "PROMO", F.concat("p_name", F.lit("s"))).otherwise(F.col("p_name"))
    right = t.part.groupBy(F.concat_ws(" ", odd, brand).alias("display_name")).agg(F.min("p_partkey").cast("string").alias("id"))
    none = t.spark.createDataFrame([], "canonical_company_id string, openalex_institution_id string")
    return resolve.scored_bridge(left, right, none).select("canonical_company_id", "openalex_institution_id", "method", "name_similarity", "confidence", "accepted", "candidate_rank", "best_margin")


def _one_text(df: DataFrame, where: str) -> str:
    """Lines (o, value) as one text file, in the order of o."""
    df.coalesce(1).sortWithinPartitions("o").select("value").write.text(where)
    return where


@query("q98_ticker_json", "SELECT CAST(c_custkey AS VARCHAR) AS cik, upper(c_mktsegment) AS ticker, c_name AS name, 'company_tickers' AS source FROM customer")
def _(t):
    where = _shared(t, "tickers")
    tables.write_json_array(t.customer.select(F.col("c_custkey").cast("string").alias("cik_str"), F.lower("c_mktsegment").alias("ticker"), F.concat(F.lit(" "), "c_name").alias("title")), where)
    return tables.read_tickers(t.spark, where).select("cik", "ticker", "name", "source")


@query("q99_columnar_json", "SELECT CAST(s_suppkey AS VARCHAR) AS cik, s_name AS name, 'T' || s_suppkey AS ticker, CASE WHEN s_acctbal > 0 THEN 'N' || s_nationkey END AS exchange FROM supplier")
def _(t):
    where = _shared(t, "columnar")
    row = F.array(F.col("s_suppkey").cast("string"), "s_name", F.concat(F.lit("t"), "s_suppkey"), F.when(F.col("s_acctbal") > 0, F.concat(F.lit("N"), "s_nationkey")))
    whole = t.supplier.agg(F.to_json(F.struct(F.array(*map(F.lit, ("cik", "name", "ticker", "exchange"))).alias("fields"), F.collect_list(row).alias("data"))).alias("value"))
    whole.coalesce(1).write.text(where)
    return tables.read_exchange(t.spark, where).select("cik", "name", "ticker", "exchange")


@query("q100_filing_index", "SELECT CAST(o_custkey AS VARCHAR) AS cik, 'C ' || o_custkey AS company_name, o_orderstatus AS form, CAST(o_orderdate AS DATE) AS filing_date, 'f/' || o_orderkey AS filename FROM orders")
def _(t):
    """A pipe-delimited index with a preamble and lines of another form, in parts that tasks write; the preamble is the first part."""
    where = _shared(t, "index")
    line = F.concat_ws("|", F.col("o_custkey").cast("string"), F.concat(F.lit(" C "), "o_custkey"), "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.lit("f/"), "o_orderkey"))
    head = t.spark.createDataFrame([("Description: index",), ("CIK|Company Name|Form Type|Date Filed|Filename",), ("------|--|-",)], "value string").coalesce(1)
    tables.write_text(head.union(t.orders.select(line)), where, "value")
    return tables.read_filing_index(t.spark, [where]).select("cik", "company_name", "form", "filing_date", "filename")


@query("q101_inventory", "SELECT 'docs/' || lang || '/' || doc_id AS Path, CAST(strlen(text) AS BIGINT) AS Size FROM documents")
def _(t):
    where = _shared(t, "inventory")
    files = t.documents.select(F.concat_ws("/", F.lit("docs"), "lang", F.col("doc_id").cast("string")).alias("Path"), F.octet_length("text").cast("long").alias("Size"), F.lit(False).alias("IsDir"))
    folders = t.documents.select(F.concat(F.lit("docs/"), "lang").alias("Path"), F.lit(-1).cast("long").alias("Size"), F.lit(True).alias("IsDir")).distinct()
    tables.write_json_array(files.union(folders), where)
    return tables.read_inventory(t.spark, where).select("Path", "Size")


@query("q102_listing_page", "SELECT 'a&' || doc_id || '<' AS key, n_chars AS size FROM documents WHERE 'a&' || doc_id || '<' > 'a&2' ORDER BY key LIMIT 100")
def _(t):
    """A saved page of a store's listing: the first hundred keys behind a given one."""
    where = _shared(t, "page")
    entry = F.concat(F.lit("<Contents><Key>a&amp;"), "doc_id", F.lit("&lt;</Key><Size>"), "n_chars", F.lit("</Size></Contents>"))
    _one_text(t.documents.select(F.col("doc_id").alias("o"), entry.alias("value")), where)
    return tables.read_listing(t.spark, [where], start_after="a&2", max_keys=100)


@query("q103_series_matrix", "SELECT p_partkey AS k, p_name AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def _(t):
    where = _shared(t, "matrix")
    line = F.concat_ws("\t", F.concat(F.lit('"'), F.col("p_partkey").cast("string"), F.lit('"')), F.concat(F.lit('"'), "p_name", F.lit('"')), F.col("p_size").cast("string"))
    around = t.spark.createDataFrame([(-2, "!title\tx"), (-1, "!series_matrix_table_begin"), (2**62, "!series_matrix_table_end"), (2**62 + 1, "!after\ty")], "o long, value string")
    _one_text(around.union(t.part.select(F.col("p_partkey").alias("o"), line)), where)
    cells = tables.read_series_matrix(t.spark, where).select("cells")
    return cells.select(F.col("cells")[0].cast("long").alias("k"), F.col("cells")[1].alias("name"), F.col("cells")[2].alias("size"))


@query("q104_counts_table", "SELECT CAST(l_partkey AS VARCHAR) AS id, CAST(count(*) AS BIGINT) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem GROUP BY l_partkey")
def _(t):
    """Counts by part as a gzipped table with a header line."""
    where = _shared(t, "counts")
    n = t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("a"), F.sum("l_linenumber").alias("b"))
    lines = n.select(F.col("l_partkey").alias("o"), F.concat_ws("\t", *(F.col(c).cast("string") for c in ("l_partkey", "a", "b"))).alias("value"))
    head = t.spark.createDataFrame([(-1, '"s1"\t"s2"')], "o long, value string")
    head.union(lines).coalesce(1).sortWithinPartitions("o").select("value").write.option("compression", "gzip").text(where)
    back = tables.read_counts(t.spark, where, skip=1)
    return back.select("id", F.col("values")[0].cast("long").alias("lines"), F.col("values")[1].cast("long").alias("numbers"))


@query("q105_state_databases", "SELECT l_returnflag AS status, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS total, count(DISTINCT l_partkey) AS keys FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL")
def _(t):
    """The lines as state databases, one for each task that writes, read back as one table with a filter that the databases answer."""
    import os
    import sqlite3

    import pyarrow as pa
    from pyspark import TaskContext

    from lakequery.sources import package

    where = package.local_path(_shared(t, "states"))

    def write(batches):
        os.makedirs(where, exist_ok=True)
        task = TaskContext.get()
        path = f"{where}/{task.partitionId()}.{task.attemptNumber()}"
        con, n = sqlite3.connect(path), 0
        con.execute("CREATE TABLE files(dataset_id TEXT, status TEXT, bytes INTEGER)")
        for b in batches:
            con.executemany("INSERT INTO files VALUES(?, ?, ?)", zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            n += b.num_rows
        con.commit()
        con.close()
        os.replace(path, f"{where}/{task.partitionId()}.sqlite")
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    rows = t.lineitem.select(F.col("l_partkey").cast("string").alias("k"), F.col("l_returnflag").alias("s"), F.col("l_orderkey").alias("bytes")).repartition(4)
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()
    found = package.read_states(t.spark, f"{where}/*.sqlite", rows="5000").where(F.col("status").isin("A", "R"))
    return found.groupBy("status").agg(F.count("*").alias("n"), F.sum("bytes").alias("total"), F.count_distinct("key").alias("keys"))

"""Operators on small hand-written tables."""

import datetime as dt
import difflib
import gzip
import hashlib
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from lakequery.functions import rank, text
from lakequery.operators import catalog, corpus, curate, identity, ingest, joins, marts, quality, research, resolve
from lakequery.sources import tables

WORK = "id string, year int, referenced_works array<string>, topics array<struct<id:string,display_name:string,score:double>>, authorships array<struct<author:struct<id:string>,author_position:string,is_corresponding:boolean,institutions:array<struct<id:string,country_code:string>>,countries:array<string>>>"


@pytest.fixture
def works(spark):
    author = lambda a, p, c, i, n: {"author": {"id": a}, "author_position": p, "is_corresponding": c, "institutions": i, "countries": n}
    row = ("w1", 2020, ["r1", "r1", None], [{"id": "t1", "display_name": "T", "score": 0.2}, {"id": "t1", "display_name": "T", "score": 0.9}, {"id": None, "display_name": "N", "score": 1.0}],
           [author("a1", "middle", False, [{"id": "i1", "country_code": "US"}], ["US", "FR"]), author("a1", "first", True, [{"id": "i1", "country_code": "US"}], ["US"]), author(None, "last", False, None, None)])
    return spark.createDataFrame([row], WORK)


def test_edges(works):
    e = {k: v.collect() for k, v in curate.work_edges(works, "raw/x").items()}
    assert [r.referenced_work_id for r in e["CITATION_EDGES"]] == ["r1"]
    assert [(r.topic_id, r.topic_score) for r in e["WORK_TOPIC_EDGES"]] == [("t1", 0.9)]
    assert [(r.author_id, r.author_position, r.is_corresponding) for r in e["WORK_AUTHOR_EDGES"]] == [("a1", "first", True)]
    assert [(r.institution_id, r.author_position) for r in e["AUTHOR_INSTITUTION_EDGES"]] == [("i1", "first")]
    assert [(r.country_a, r.country_b) for r in e["COUNTRY_COLLAB_EDGES"]] == [("FR", "US")]
    assert curate.scalar_master(works, "k").columns == ["id", "year", "_source_key"]
    with pytest.raises(ValueError):
        curate.clean_edges("NO_EDGES", works)
    with pytest.raises(ValueError):
        curate.scalar_master(works.select("topics"), "k")


def test_verify_curated(spark):
    raw = spark.createDataFrame([("a", 10), ("b", 20), ("c", None)], "key string, bytes long")
    state = spark.createDataFrame([("a", "FAILED", 9, 9, 1), ("a", "OK", 10, 4, 2), ("a", "FAILED", 9, 9, 3), ("b", "FAILED", 20, 0, 4), ("d", "OK", 5, 5, 5)], "key string, status string, bytes_in long, bytes_out long, position int")
    s = curate.summarize_curated(raw, state)
    assert s == {"raw_count": 3, "raw_bytes": 30, "distinct_keys": 3, "state_ok": 2, "state_failed": 1, "state_bytes_in": 10, "state_bytes_out": 4, "missing_keys": 2, "unexpected_keys": 1, "state_rows": 5, "duplicate_rows": 2}
    assert curate.verify_curated(raw, state) == ["failed: 1", "missing: 2", "unexpected: 1", "curated keys 2, raw keys 3", "curated input bytes 10, raw bytes 30"]
    assert curate.verify_curated(raw.where("key = 'a'"), state.where("key = 'a'")) == []
    assert "no output bytes" in curate.verify_curated(raw, state.limit(0))


def test_marts(spark):
    master = spark.createDataFrame([("w1", 2020, 4), ("w2", 2020, None), ("w3", 2021, 2), (None, 2021, 9)], "id string, publication_year int, cited_by_count int")
    inst = spark.createDataFrame([("w1", "i1", "US"), ("w1", "i1", "FR"), ("w1", "i2", "US")], "work_id string, institution_id string, institution_country_code string")
    m = marts.year_marts(master, institutions=inst)
    assert sorted(map(tuple, m["WORK_YEAR_METRICS"].collect())) == [(2020, 2, 4, 2.0), (2021, 1, 2, 2.0)]
    assert sorted(map(tuple, m["WORK_YEAR_INSTITUTION"].collect())) == [(2020, "i1", 1, 8, 8.0), (2020, "i2", 1, 4, 4.0)]
    assert sorted(map(tuple, marts.year_marts(master, institutions=inst, strict_institutions=True)["WORK_YEAR_INSTITUTION"].collect()))[0][3] == 4
    assert sorted(map(tuple, m["WORK_YEAR_COUNTRY"].collect())) == [(2020, "FR", 1, 4, 4.0), (2020, "US", 1, 4, 4.0)]
    partials = spark.createDataFrame([(2020, 2, 8), (2020, 3, 12)], "publication_year int, work_count long, citation_sum long")
    assert list(map(tuple, marts.reduce_partials(partials, []).collect())) == [(2020, 5, 20, 4.0)]
    with pytest.raises(ValueError):
        marts.year_marts(master.drop("publication_year"))


def test_catalog(spark, tmp_path):
    edges = spark.createDataFrame([("w1", "a1"), ("w1", "a2"), ("w2", "a1")], "work_id string, author_id string")
    assert catalog.build_catalog(spark, {"WORK_AUTHOR_EDGES": edges})["functions"] == []
    more = spark.createDataFrame([("w3", "a1"), ("w3", "a3"), ("w1", "a3")], "work_id string, author_id string")
    masters = {"WORK_MASTER": spark.createDataFrame([("w1", "First")], "id string, title string"), "AUTHOR_MASTER": spark.createDataFrame([("a1", "Ann")], "id string, name string")}
    collab = spark.createDataFrame([("w1", "DE", "FR", "s1"), ("w2", "FR", "US", "s2"), ("w3", "DE", "US", "s3")], "work_id string, country_a string, country_b string, _source_key string")
    made = catalog.build_catalog(spark, {"WORK_AUTHOR_EDGES": edges.union(more), "COUNTRY_COLLAB_EDGES": collab, **masters})
    assert made["functions"] == ["work", "author", "work_authors", "author_works", "coauthors", "country_collaborations"]
    got = spark.sql("SELECT * FROM work_authors('w1')")
    assert got.columns == ["work_id", "author_id", "name"] and {tuple(r) for r in got.collect()} == {("w1", "a1", "Ann"), ("w1", "a2", None), ("w1", "a3", None)}
    assert {tuple(r) for r in spark.sql("SELECT * FROM author_works('a1')").collect()} == {("w1", "a1", "First"), ("w2", "a1", None), ("w3", "a1", None)}
    assert [tuple(r) for r in spark.sql("SELECT coauthor_id, shared_work_count FROM coauthors('a1')").collect()] == [("a3", 2), ("a2", 1)]
    assert {tuple(r) for r in spark.sql("SELECT * FROM country_collaborations('FR')").collect()} == {("w1", "DE", "FR", "DE", "s1"), ("w2", "FR", "US", "US", "s2")}
    assert {tuple(r) for r in spark.sql("SELECT table_name, table_kind, row_count, column_count FROM table_counts").collect()} >= {("WORK_MASTER", "master", 1, 2), ("WORK_AUTHOR_EDGES", "edge", 6, 2)}
    with pytest.raises(ValueError):
        catalog.build_catalog(spark, {"WORK_AUTHOR_EDGES": edges}, required=("WORK_MASTER",))
    for bad in ("DELETE FROM x", "", "DROP TABLE x", "INSERT INTO x VALUES (1)", "CREATE TABLE y AS SELECT 1"):
        with pytest.raises(ValueError):
            catalog.read_only(spark, bad)
    out = catalog.execute_query(spark, "SELECT\n1 AS a UNION ALL SELECT 2;", str(tmp_path / "o"))
    assert out["rows"] == 2 and out["columns"] == ["a"] and len(out["output_sha256"]) == 64
    out = catalog.execute_query(spark, "SELECT id, nullif(id, 1) AS n FROM range(3)", str(tmp_path / "j"), "json")
    (file,) = (tmp_path / "j").glob("part-*")
    assert sorted(json.loads(file.read_text()), key=lambda r: r["id"]) == [{"id": 0, "n": 0}, {"id": 1, "n": None}, {"id": 2, "n": 2}]
    assert out["file_sha256"] == [hashlib.sha256(file.read_bytes()).hexdigest()]
    catalog.execute_query(spark, "SELECT id FROM range(0)", str(tmp_path / "k"), "json")
    assert [json.loads(f.read_text()) for f in (tmp_path / "k").glob("part-*")] == [[]]
    catalog.execute_query(spark, "SELECT id FROM range(2)", str(tmp_path / "c"), "csv")
    assert tables.read_text_csv(spark, str(tmp_path / "c")).count() == 2


def test_persisted_catalog(spark, tmp_path):
    frames = {
        "WORK_MASTER": spark.createDataFrame([("w1", "First"), ("w2", "Second")], "id string, title string").repartition(2), "TOPIC_MASTER": spark.createDataFrame([("t1", "Law")], "id string, topic string").coalesce(1),
        "WORK_TOPIC_EDGES": spark.createDataFrame([("w1", "t1", 0.5), ("w1", "t2", 0.1)], "work_id string, topic_id string, topic_score double").coalesce(1),
    }
    paths = {n: f"file://{tmp_path}/{n}" for n in frames}
    for n, df in frames.items():
        df.write.parquet(paths[n])
    for _ in range(2):  # a second build replaces the first
        made = catalog.persist_catalog(spark, paths, "lake_test", required=("WORK_MASTER",))
    assert made["functions"] == ["work", "topic", "work_topics"] and spark.catalog.currentDatabase() == "default"
    assert {tuple(r) for r in spark.sql("SELECT table_name, table_kind, row_count, source_file_count, column_count FROM lake_test.table_counts").collect()} == {("TOPIC_MASTER", "master", 1, 1, 2), ("WORK_MASTER", "master", 2, 2, 2), ("WORK_TOPIC_EDGES", "edge", 2, 1, 3)}
    assert spark.sql("SELECT column_name FROM lake_test.columns WHERE table_name = 'WORK_TOPIC_EDGES' ORDER BY ordinal_position").collect()[2][0] == "topic_score"
    spark.catalog.setCurrentDatabase("lake_test")
    got = spark.sql("SELECT * FROM work_topics('w1')").collect()
    spark.catalog.setCurrentDatabase("default")
    assert {tuple(r) for r in got} == {("w1", "t1", 0.5, "Law"), ("w1", "t2", 0.1, None)}
    for bad in ({"required": ("AUTHOR_MASTER",)}, {}):
        with pytest.raises(ValueError):
            catalog.persist_catalog(spark, paths if bad else {"OTHER": "x"}, "lake_test", **bad)
    spark.sql("DROP DATABASE lake_test CASCADE")


def test_quality(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4)], "k string, v int")
    errors = quality.validate_staged({"t": df}, [quality.Contract("t", ("k",), ("k",)), quality.Contract("u", (), ("k",)), quality.Contract("t", ("z",), ("k",))])
    assert errors == ["t: 2 invalid keys", "t: 1 duplicate keys", "u: missing table", "t: missing columns z"]
    years = spark.createDataFrame([(2019,), (2021,)], "publication_year int")
    assert [r[0] for r in quality.year_gaps(years).collect()] == [2020]


def test_company_and_filings(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"0": {"cik_str": 1, "ticker": "bb", "title": "One"}, "1": {"cik_str": 2, "ticker": "c", "title": "Two"}}))
    (tmp_path / "e.json").write_text(json.dumps({"fields": ["cik", "name", "ticker", "exchange"], "data": [[1, "One", "AA", "NYSE"], [1, "One Inc", "BB", "NYSE"], [2, "Two", "C", None]]}))
    names = tables.read_tickers(spark, str(tmp_path / "t.json")).unionByName(tables.read_exchange(spark, str(tmp_path / "e.json")))
    master, bridge = identity.company_master(names)
    assert sorted(map(tuple, master.collect())) == [("SEC_CIK:0000000001", "0000000001", "One", "AA", 2), ("SEC_CIK:0000000002", "0000000002", "Two", "C", 1)]
    assert {(r.ticker, r.exchange, r.source) for r in bridge.collect()} == {("AA", "NYSE", "company_tickers_exchange"), ("BB", "NYSE", "company_tickers+company_tickers_exchange"), ("C", None, "company_tickers+company_tickers_exchange")}
    odd = spark.createDataFrame([("5", "Z", None, "", "company_tickers", 0), ("5", "Z", "Late", "N", "company_tickers_exchange", 0), ("6", "Y", None, None, "company_tickers", 1)], "cik string, ticker string, name string, exchange string, source string, ord int")
    m, b = identity.company_master(odd)
    assert {tuple(r)[1:] for r in m.collect()} == {("0000000005", "Late", "Z", 1), ("0000000006", None, "Y", 1)}
    assert {(r.ticker, r.exchange, r.company_name) for r in b.collect()} == {("Z", "N", "Late"), ("Y", None, None)}
    lines = ["Preamble", "CIK|Company Name|Form Type|Date Filed|Filename", "---", "1|One|10-K|2023-02-01|edgar/data/1/0001-23-1.txt", "1|One B|10-K|2023-03-01|edgar/data/1/0001-23-2.txt", "1|One C|10-K|2023-03-01|edgar/data/1/0001-23-3.txt", "1|One|10-K|2025-01-01|edgar/data/1/x.txt", "3|Three|10-K|2023-01-05|edgar/data/3/0003-23-1.txt", "2|Two|8-K|2023-01-05|f.txt"]
    (tmp_path / "i.idx").write_text("\n".join(lines), encoding="latin-1")
    index = tables.read_filing_index(spark, [str(tmp_path / "i.idx")])
    filings, matched = identity.filing_master(index, master, "2023-01-01", "2024-03-15", expected=2)
    assert {(r.cik, r.accession, r.filing_year) for r in filings.collect()} == {("0000000001", "0001-23-2", 2023), ("0000000003", "0003-23-1", 2023)}
    assert {(r.cik, r.matched) for r in matched.collect()} == {("0000000001", True), ("0000000003", False)}
    nameless = master.withColumn("company_name", F.nullif("company_name", F.lit("One")))
    complete, of = identity.complete_companies(nameless, filings)
    whole = {r.cik: (r.source_class, r.company_name, r.in_ticker_master) for r in complete.collect()}
    assert whole == {"0000000001": ("SEC_TICKER+FILING", "One B", True), "0000000002": ("SEC_TICKER", "Two", True), "0000000003": ("SEC_FILING", "Three", False)}
    assert {(r.cik, r.accession, r.primary_ticker, r.source_class) for r in of.collect()} == {("0000000001", "0001-23-2", "AA", "SEC_TICKER+FILING"), ("0000000003", "0003-23-1", None, "SEC_FILING")}
    with pytest.raises(ValueError):
        identity.filing_master(index, master, "2023-01-01", "2024-03-15", expected=9)
    sections = spark.createDataFrame([("1", "edgar/data/1/0001-23-2.txt", s, n) for s, n in (("1", "12.7"), ("1A", "1e2"), ("7", "x"))], "cik string, filename string, section string, word_count string")
    got, uncovered = identity.section_bridge(sections, filings)
    assert sorted((r.section, r.word_count) for r in got.collect()) == [("1", 13), ("1A", 100), ("7", None)] and uncovered.count() == 1


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "256", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    was = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_filing_index_in_blocks(spark, tmp_path, small_blocks):
    """One file is read by several tasks, and a folder's files are one index; line numbers are those of the whole, names are decoded, a lone carriage return ends no line."""
    lines = ["Preamble", "CIK|Company Name|Form Type|Date Filed|Filename", "------", *(f"{i}| Soci\u00e9t\u00e9\r{'x' * (i % 37)} |10-K|2023-01-{1 + i % 28:02}|f/{i}" for i in range(200))]
    (tmp_path / "one.idx").write_bytes("\r\n".join(lines).encode("latin-1"))
    (tmp_path / "parts").mkdir()
    for k, (a, b) in enumerate(((0, 3), (3, 40), (40, 41), (41, 203))):
        (tmp_path / f"parts/part-{k}.txt").write_bytes("".join(x + "\n" for x in lines[a:b]).encode("latin-1"))
    index = tables.read_filing_index(spark, [f"{tmp_path}/one.idx", f"{tmp_path}/parts"])
    want = [(k, i + 3, str(i), f"Soci\u00e9t\u00e9\r{'x' * (i % 37)}", f"f/{i}") for k in (0, 1) for i in range(200)]
    assert sorted(map(tuple, index.select("file", "line", "cik", "company_name", "filename").collect())) == want
    assert index.where("file = 0").select(F.spark_partition_id().alias("p")).distinct().count() > 10


def test_zip(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("CIK0000000001.json", json.dumps({"name": "One", "addresses": {"business": {"city": "X", "isForeignLocation": False}}}))
        z.writestr("other.txt", "x")
    companies = spark.createDataFrame([("c1", "0000000001", "Master One"), ("c2", "0000000002", None)], "canonical_company_id string, cik string, company_name string")
    members = tables.read_zip_json(spark, str(tmp_path / "s.zip"))
    got = tables.issuer_metadata(members, companies)
    assert len(got.columns) == 38 and [(r.canonical_company_id, r.company_name, r.sec_entity_name, r.business_city, r.business_is_foreign_location, r.mailing_city) for r in got.collect()] == [("c1", "Master One", "One", "X", False, None)]
    for bad in (companies.where("cik > '1'"), companies.union(companies)):
        with pytest.raises(ValueError):
            tables.issuer_metadata(members, bad)


def test_more_sources(spark, tmp_path):
    (tmp_path / "inv.json").write_text(json.dumps([{"Path": "a", "Size": 1, "IsDir": False}, {"Path": "d", "Size": -1, "IsDir": True}]))
    assert [r.Path for r in tables.read_inventory(spark, str(tmp_path / "inv.json")).collect()] == ["a"]
    page = lambda rows: "<ListBucketResult xmlns='x'>" + "".join(f"<Contents><Key>{k}</Key>{s}</Contents>" for k, s in rows) + "</ListBucketResult>"
    (tmp_path / "p1.xml").write_text(page([("data/b&amp;c", "<Size>5</Size>"), ("data/a", "<Size>7</Size>"), ("other", "<Size>1</Size>")]))
    (tmp_path / "p2.xml").write_text(page([("data/d", ""), ("data/e", "<Size>2</Size>")]))
    listing = tables.read_listing(spark, [str(tmp_path / "p1.xml"), str(tmp_path / "p2.xml")], prefix="data/", start_after="data/a", max_keys=2)
    assert [tuple(r) for r in listing.collect()] == [("data/b&c", 5), ("data/d", 0)]
    assert {r.path.rpartition("/")[2] for r in tables.list_folder(spark, str(tmp_path), ".xml").collect()} == {"p1.xml", "p2.xml"}
    keys = spark.createDataFrame([(f"k{i:02}",) for i in range(20)], "key string")
    assert [r.key for r in tables.shard_of_rank(keys, "key", 2, 6).orderBy("key").collect()] == ["k02", "k08", "k14"]
    with gzip.open(tmp_path / "c.txt.gz", "wt") as f:
        f.write("h1\th2\ng1\t5\t6\ng2\t7\t8\n")
    assert [(r.id, r["values"]) for r in tables.read_counts(spark, str(tmp_path / "c.txt.gz"), skip=1).orderBy("line").collect()] == [("g1", ["5", "6"]), ("g2", ["7", "8"])]
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        for name, body in (("a.csv", b"x,1"), ("b.csv.gz", gzip.compress(b"y,2"))):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    assert {tuple(r) for r in tables.read_tar_text(spark, str(tmp_path / "t.tar")).collect()} == {("a.csv", "x,1"), ("b.csv.gz", "y,2")}
    p = spark.createDataFrame([("US", 20200105, "a"), ("US", 20210105, "b"), ("DE", 20200105, "c")], "country_code string, publication_date int, id string")
    assert [r.id for r in tables.patents(p, ["id"], "US", 2020).collect()] == ["a"] and tables.patents(p, ["id"], "US").count() == 2
    names = spark.createDataFrame([("data/p_q/x.parquet",), ("data/pXq/x.parquet",), ("data/p_q/x.csv",)], "k string")
    assert [r.k for r in tables.like_between(names, "k", "data/p_q/", ".parquet").collect()] == ["data/p_q/x.parquet"]
    tables.write_csv_signed(spark.createDataFrame([("é", 1)], "a string, b int"), str(tmp_path / "sig"))
    (file,) = (tmp_path / "sig").glob("part-*")
    assert file.read_bytes() == "\ufeffa,b\né,1\n".encode()
    tables.write_text(spark.createDataFrame([("line",)], "text string"), str(tmp_path / "txt"))
    assert spark.read.text(str(tmp_path / "txt")).first().value == "line"
    assert spark.range(1).select(tables.shard_name(F.lit("p/a"))).first()[0] == hashlib.sha256(b"p/a").hexdigest()[:16] + ".parquet"
    tables.write_parquet(p, str(tmp_path / "hive"), partition_by=["country_code"])
    assert {r.id for r in tables.read_tables(spark, str(tmp_path / "hive")).where("country_code = 'DE'").collect()} == {"c"}
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert tables.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").count() == 2


def test_panel(spark):
    from lakequery.operators import panel

    df = spark.createDataFrame([("at1g00001 x AT1G00001", 1.0), ("AT1G00001", 3.0), ("AT1G00002 AT1G00003", 9.0), ("none", 5.0), ("AT2G00001", float("inf"))], "d string, v double")
    ids = df.withColumn("id", panel.only_id(F.col("d"), "AT[1-5]G[0-9]{5}"))
    assert [r.id for r in ids.collect()] == ["AT1G00001", "AT1G00001", None, None, "AT2G00001"]
    assert [tuple(r) for r in panel.average_replicates(ids, "id", ["v"]).collect()] == [("AT1G00001", 2.0)]
    assert spark.range(1).select(panel.log2_values(F.array(F.lit(8.0), F.lit(0.0)))).first()[0] == [3.0, float("-inf")]
    targets = spark.createDataFrame([("g1", "p1"), ("g2", "p1"), ("g3", "p2"), ("g4", "p9")], "gene string, probe string")
    results = spark.createDataFrame([("p1", 1.5, 0.02), ("p2", -1.0, 0.04)], "probe string, log2FC double, PValue double")
    got = panel.target_results(targets, results, "probe", ["log2FC", "PValue"], "D", "a-b")
    assert {(r.gene, r.log2FC, r.FDR_panel) for r in got.collect()} == {("g1", 1.5, 0.04), ("g2", 1.5, 0.04), ("g3", -1.0, 0.04), ("g4", None, None)}
    assert panel.bound([got, got], ["dataset", "gene"]).count() == 8


def test_sources(spark, tmp_path):
    (tmp_path / "m.txt").write_text('!x\n!series_matrix_table_begin\n"ID_REF"\t"S1"\n"p1"\t1.5\n!series_matrix_table_end\n')
    assert [r.cells for r in tables.read_series_matrix(spark, str(tmp_path / "m.txt")).orderBy("line").collect()] == [["ID_REF", "S1"], ["p1", "1.5"]]
    spark.range(3).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(str(tmp_path / "t"))
    df = tables.read_tables(spark, str(tmp_path / "t"), base=str(tmp_path / "t"), lineage=True)
    assert set(df.columns) == {"id", "p", "filename"} and df.count() == 3
    (tmp_path / "a.json").write_text(json.dumps({"policy": "x", "items": [{"canonical_company_id": "c", "decision": "PROMOTE"}]}))
    assert [tuple(r) for r in tables.read_adjudications(spark, str(tmp_path / "a.json")).collect()] == [("x", "c", "PROMOTE")]
    with pytest.raises(ValueError):
        tables.scan_guard(df, 1)
    with pytest.raises(ValueError):
        tables.write_parquet(df.limit(0), str(tmp_path / "z"), refuse_empty=True)
    assert json.loads(tables.json_array(spark.range(2)).first()[0]) == [{"id": 0}, {"id": 1}]
    assert json.loads(tables.manifest(spark.range(3), {"rows": "count(*)"})) == {"rows": 3}
    assert "| id |" in tables.markdown(spark.range(1), "T")


def _institutions(spark):
    return spark.createDataFrame([("i1", "Acme, Inc.", "r", "US", "company"), ("i2", "Twin", None, "US", "company"), ("i3", "TWIN", None, "FR", "education"), ("i4", "Borealis Systems Limited", None, "US", "company"), ("i5", "Helix Dynamics Laboratories", None, "US", "company")], "id string, display_name string, ror string, country_code string, type string")


def test_resolution(spark):
    companies = spark.createDataFrame([("c1", "ACME INC"), ("c2", "Twin"), ("c4", "Borealis Systems Corp"), ("c5", "Helix Dynamics Laboratory")], "canonical_company_id string, company_name string")
    exact = resolve.exact_bridge(companies, _institutions(spark))
    assert {(r.canonical_company_id, r.accepted, r.confidence, r.match_method) for r in exact.collect()} == {("c1", True, 1.0, "NORMALIZED_EXACT"), ("c2", False, 0.0, "NORMALIZED_EXACT")} and exact.count() == 3
    taken = exact.where("accepted")
    scored = resolve.scored_bridge(companies, _institutions(spark), taken)
    by = {(r.canonical_company_id, r.openalex_institution_id): r for r in scored.collect()}
    assert by["c4", "i4"].method == "LEGAL_CORE_EXACT" and by["c4", "i4"].confidence == 0.98 and by["c4", "i4"].accepted and by["c4", "i4"].tier == "HIGH"
    r = by["c5", "i5"]
    ratio = difflib.SequenceMatcher(None, "helixdynamicslaboratory", "helixdynamicslaboratories").ratio()
    assert r.method == "FUZZY_CORE" and abs(r.name_similarity - ratio) < 1e-12 and r.confidence == min(0.97, ratio + 0.035) and r.acronym_match and r.candidate_rank == 1 and r.best_margin == ratio + 0.035 and r.accepted == (ratio >= 0.965)
    bridge, master, queue = resolve.finalize_organizations(companies, taken, scored.where("accepted"), scored)
    assert len(bridge.columns) == 15 and {(x.canonical_company_id, x.confidence_tier, x.provenance) for x in bridge.collect()} == {("c1", "EXACT", "exact_anchor"), ("c4", "HIGH", "scored_matcher")} | ({("c5", "HIGH", "scored_matcher")} if r.accepted else set())
    assert len(master.columns) == 20 and {x.canonical_company_id for x in master.where("not has_openalex_link").collect()} == {"c2", "c5"} - {x.canonical_company_id for x in bridge.collect()}
    assert {x.canonical_company_id for x in queue.collect()} == {"c2"} | ({"c5"} - {x.canonical_company_id for x in bridge.collect()})
    empty = resolve.scored_bridge(companies.limit(0), _institutions(spark), taken)
    assert empty.count() == 0 and "candidate_rank" in empty.columns
    assert quality.validate_bridge(master, bridge, scored, queue) == []
    worse = bridge.withColumn("confidence", F.when(F.col("canonical_company_id") == "c4", 0.5).otherwise(0.99))
    assert quality.validate_bridge(master.limit(0), worse, scored.withColumn("accepted", F.lit(False)), bridge.limit(1)) == ["accepted_confidence_outside_policy=1", "accepted_matches_dominated_by_stronger_candidate=1", "exact_anchor_confidence_not_one=1", "review_companies_already_promoted=1", "review_rows_marked_accepted=1"]


def test_blocked_pairs(spark):
    """Bounds leave out no pair that reaches the ratio."""
    import random

    r = random.Random(1)
    base = ["precisiontool", "precisiontoolworks", "precise", "preciseinstrumentation"]
    names = sorted({"".join(c if r.random() > 0.08 else r.choice("abcxyz01") for c in b) + r.choice(["", "s", "es", "ltda"]) for b in base for _ in range(25)} | set(base))
    a = spark.createDataFrame([(n,) for n in names], "a string")
    got = {(x.a, x.b) for x in joins.blocked_pairs(a, a.withColumnRenamed("a", "b"), "a", "b", least=0.88).withColumn("s", text.sequence_ratio("a", "b")).where("s >= 0.88").collect()}
    want = {(x, y) for x in names for y in names if x[:4] == y[:4] and abs(len(x) // 5 - len(y) // 5) <= 1 and difflib.SequenceMatcher(None, x, y).ratio() >= 0.88}
    assert got == want and len(want) > len(names)


def test_promotion_and_geography(spark):
    a = spark.createDataFrame(
        [("c1", "i1", 0.98, "NORMALIZED_EXACT", "Company", "r"), ("c2", "i2", 0.97, "NORMALIZED_EXACT", "company", "r"), ("c3", "i3", 0.99, "FUZZY_CORE", "company", "r"), ("c4", "i4", None, None, "company", "r"), ("c5", "i5", 0.99, "LEGAL_CORE_EXACT", "education", "r"), ("c6", "i6", 0.99, "LEGAL_CORE_EXACT", None, "r"), ("c7", "i7", 1.0, "LEGAL_CORE_EXACT", "company", " ")],
        "canonical_company_id string, openalex_institution_id string, confidence double, match_method string, institution_type string, ror string",
    )
    production, quarantine = resolve.promote(a)
    assert {r[0] for r in production.collect()} == {"c1", "c4"}
    assert {(r.canonical_company_id, r.quarantine_reason) for r in quarantine.collect()} == {("c2", "LOW_CONFIDENCE"), ("c3", "METHOD_NOT_PRODUCTION_APPROVED"), ("c5", "OPENALEX_TYPE_NOT_COMPANY"), ("c6", "OPENALEX_TYPE_NOT_COMPANY"), ("c7", "ROR_MISSING")}
    with pytest.raises(ValueError):
        resolve.promote(a.union(a))
    d = spark.createDataFrame([("Korea, Republic of (South)", None, None), ("TX", "TX", "false"), (None, "TX", None), ("North Macedonia Republic", None, "true")], "d string, c string, f string")
    names = {"KOREA": "KR", "MACEDONIA": "XX", "NORTH MACEDONIA": "MK"}
    assert [r[0] for r in d.select(resolve.country_of(F.col("d"), F.col("c"), F.col("f"), names)).collect()] == ["KR", "US", None, "MK"]
    meta = spark.createDataFrame([("c1", None, "Canada", "true"), ("c2", None, "France (metropolitan)", None), ("c3", "CA", None, "no"), ("c5", None, "Germany", "1"), ("c7", None, "Japan", "t")], "canonical_company_id string, business_state_or_country string, business_state_or_country_description string, business_is_foreign_location string")
    with_code = a.withColumn("country_code", F.create_map(*(F.lit(x) for x in ("c1", "US", "c2", " fr", "c3", "US", "c4", "", "c5", "DE", "c7", "JP")))[F.col("canonical_company_id")])
    bucket = lambda *ids: with_code.where(F.col("canonical_company_id").isin(*ids))
    judged, kept = resolve.reclassify(meta, bucket("c1", "c4"), bucket("c3", "c5", "c7"), bucket("c2", "c6").withColumnRenamed("match_method", "method"))
    got = {r.canonical_company_id: (r.reclassification_decision, r.reclassification_reason, r.match_method) for r in judged.collect()}
    assert got == {
        "c1": ("REJECT", "sec_openalex_country_conflict", "NORMALIZED_EXACT"), "c4": ("KEEP_PRODUCTION", "production_link_no_country_conflict", ""), "c3": ("PROMOTE", "corporate_type_ror_high_confidence_no_country_conflict", "FUZZY_CORE"),
        "c5": ("REVIEW_PRIORITY", "country_match_ror_high_confidence_but_noncompany_type", "LEGAL_CORE_EXACT"), "c7": ("KEEP_QUARANTINE", "metadata_gate_not_cleared", "LEGAL_CORE_EXACT"),
        "c2": ("PROMOTE", "country_match_company_type_ror_high_confidence", "NORMALIZED_EXACT"), "c6": ("KEEP_REVIEW", "review_evidence_not_sufficient", "LEGAL_CORE_EXACT"),
    }
    assert {r.canonical_company_id for r in kept.collect()} == {"c2", "c3", "c4"}
    first = resolve.priority_review(judged).collect()
    assert [r.canonical_company_id for r in first] == ["c5"] and len(first[0]) == 19
    with pytest.raises(ValueError):
        resolve.priority_review(judged.where("false"))


def test_adjudication_and_ranking(spark):
    base = spark.createDataFrame([("c1", "i1")], "canonical_company_id string, openalex_institution_id string")
    re = spark.createDataFrame([("c2", "i2", "REVIEW_PRIORITY"), ("c3", "i3", "KEEP_REVIEW")], "canonical_company_id string, openalex_institution_id string, reclassification_decision string")
    dec = spark.createDataFrame([("c2", "PROMOTE", 3, 0), ("c3", "PROMOTE", 3, 1), ("c3", "KEEP_REVIEW", 4, 0)], "canonical_company_id string, decision string, version int, position int")
    assert resolve.adjudicate(base, re, dec, "v3", "REVIEW_PRIORITY", expected=1).count() == 2
    with pytest.raises(ValueError):
        resolve.adjudicate(base, re, dec, "v3", expected=5)
    assert {tuple(r) for r in resolve.last_decisions(dec).collect()} == {("c2", "PROMOTE"), ("c3", "KEEP_REVIEW")}
    made = [
        ("c2", 0.9, "company", "r", "FUZZY_CORE", True, False, "review", "KEEP_REVIEW"), ("c3", 0.95, "company", "r", "NORMALIZED_EXACT", True, False, "quarantine", "REVIEW_PRIORITY"), ("c4", 0.7, "company", None, None, False, False, "review", "KEEP_REVIEW"),
        ("c5", 0.91, None, "r", "FUZZY_CORE", True, False, "review", "KEEP_REVIEW"), ("c6", 0.92, None, "r", "LEGAL_CORE_EXACT", False, False, "review", "KEEP_REVIEW"), ("c7", 0.99, "company", "r", "X", False, True, "review", "KEEP_REVIEW"), ("c8", 0.99, "company", "r", "X", True, False, "review", "PROMOTE"),
    ]
    review = spark.createDataFrame(made, "canonical_company_id string, confidence double, institution_type string, ror string, match_method string, country_match boolean, country_conflict boolean, source_bucket string, reclassification_decision string")
    got = [(r.canonical_company_id, r.review_tier, r.review_rank, round(r.review_score, 6)) for r in resolve.rank_unresolved(review, dec).orderBy("review_rank").collect()]
    assert got == [("c3", "TIER_A_STRONG", 1, 148.0), ("c5", "TIER_B_GOOD", 2, 119.0), ("c6", "TIER_C_MODERATE", 3, 110.0), ("c4", "TIER_D_LOW", 4, 82.0), ("c7", "BLOCKED_COUNTRY_CONFLICT", 5, 19.0)]


def test_mart_validation(spark):
    base = spark.createDataFrame([(2019, 1, 5, 5.0), (2020, 2, 4, 2.0)], "publication_year int, work_count long, citation_sum long, mean_citations double")
    pairs = base.withColumn("country_a", F.lit("US")).withColumn("country_b", F.lit("DE"))
    topics = base.where("publication_year = 2020").withColumn("topic_id", F.lit(""))
    places = base.union(base).withColumn("institution_id", F.lit("i")).withColumn("work_count", F.lit(-1))
    errors, profile = quality.validate_marts({"WORK_YEAR_METRICS": base, "COUNTRY_COLLAB_YEAR": pairs, "WORK_YEAR_TOPIC": topics, "WORK_YEAR_INSTITUTION": places})
    assert sorted(errors) == sorted(["COUNTRY_COLLAB_YEAR: 2 pairs out of order", "WORK_YEAR_COUNTRY: missing table", "WORK_YEAR_INSTITUTION: 2 duplicate rows", "WORK_YEAR_INSTITUTION: 4 negative metrics", "WORK_YEAR_TOPIC: 1 invalid keys"])
    assert {(r.mart, r.n_rows, r.first_year, r.years_lacking) for r in profile.collect()} >= {("WORK_YEAR_TOPIC", 1, 2020, 1), ("WORK_YEAR_METRICS", 2, 2019, 0)}


def test_research(spark):
    prod = spark.createDataFrame([("c1", "i1", 1.0)], "canonical_company_id string, openalex_institution_id string, confidence double")
    works = spark.createDataFrame([("w1", 2020, 10)], "id string, publication_year int, cites long")
    ai = spark.createDataFrame([("w1", "i1", "US"), ("w1", "p1", "FR"), ("w1", "p2", "FR")], "work_id string, institution_id string, institution_country_code string")
    row = research.company_collaboration_year(prod, works, ai).first()
    assert (row.partner_country, row.work_count, row.collaborator_institution_count, row.citation_sum) == ("FR", 1, 2, 10)
    inv = spark.createDataFrame([("a/x", 5, False), ("a/y", 6, False), ("b", 0, True)], "Path string, Size long, IsDir boolean")
    assert [tuple(r) for r in research.freeze_release(inv, True, []).collect()] == [("a", 2, 11)]
    with pytest.raises(ValueError):
        research.freeze_release(inv, False, [])
    with pytest.raises(ValueError):
        research.company_year(prod, prod.limit(0), ai)
    yearly = spark.createDataFrame([("i1", 2020, 2, 6), ("i1", 2020, 1, 3), ("i9", 2020, 5, 5)], "institution_id string, publication_year int, work_count long, citation_sum long")
    mart, cited = research.company_year(prod.withColumn("company_name", F.lit("One")), prod, yearly)
    assert [(r.canonical_org_id, r.company_name, r.work_count, r.citation_sum, r.mean_citations) for r in mart.collect()] == [("c1", "One", 3, 9, 3.0)] and cited.first().citations_per_work == 3.0


def test_corpus(spark):
    pages = spark.createDataFrame([(1, 1, "front", None, 1, 1), (2, 1, "§1 a", None, 1, 2), (3, 1, "b", "x" * 50, 1, 3), (4, 1, "§2 c", None, 1, 4), (4, 1, "§2 d", None, 2, 1)], "page int, book int, text string, ocr_text string, file int, line int")
    merged = corpus.merge_ocr(pages)
    assert {r.page: r.text for r in merged.collect()} == {1: "front", 2: "§1 a", 3: "x" * 50, 4: "§2 d"}
    rec = corpus.records(merged, ["book"], "page", "^§")
    assert sorted((r.record, r.text) for r in rec.collect()) == [(1, "§1 a\n" + "x" * 50), (2, "§2 d")]
    docs = spark.createDataFrame([(1, "The Ｗater law"), (2, "nothing")], "doc_id int, text string")
    assert [(r.topic, r.doc_id, r.terms) for r in corpus.topic_index(docs, {"T": ["water", "law"]}).collect()] == [("T", 1, ["law", "water"])]


def test_corpus_tables(spark):
    pages = spark.createDataFrame(
        [("b", 1, "Front matter", None), ("b", 2, "x Vol 1, No 2: first  words Vol 1, No 3:second", None), ("b", 3, "goes on", None), ("b", 4, "end of it Vol 2, No 1: Ｗater\n law", "short"), ("b", 5, "", "o" * 30), ("c", 1, None, None)],
        "book_key string, page int, text string, ocr_text string",
    )
    t = corpus.corpus_tables(pages, [(1, "Law", ["law", "LAWS", "water"]), (2, "None", ["absent"])], r"Vol (\d+), No (\d+):", 2)
    assert sorted((r.record, r.refs, r.start_page, r.text) for r in t["records"].collect()) == [(1, ["1", "2"], 2, "first  words"), (2, ["1", "3"], 2, "second\ngoes on\nend of it "), (3, ["2", "1"], 4, "Ｗater\n law\n" + "o" * 30)]
    assert [(r.topic_id, r.record, r.matched_terms, r.text_excerpt) for r in t["candidates"].collect()] == [(1, 3, ["law", "water"], "Ｗater law " + "o" * 30)]
    assert [(r.book_key, r.page, r.matched_terms) for r in t["page_hits"].collect()] == [("b", 4, ["law", "water"])]
    audit = {r.book_key: r for r in t["audit"].collect()}
    assert (audit["b"].pages, audit["b"].ocr_fallback_page_count, audit["b"].blank_page_count, audit["b"].low_text_page_count) == (5, 1, 0, 5) and (audit["c"].blank_page_count, audit["c"].total_chars) == (1, 0)
    conf = spark.createDataFrame([("b", 1, 90.0, 100, 50), ("b", 2, 40.0, 100, 0), ("b", 3, None, 5, None)], "book_key string, page int, mean_conf double, ocr_chars long, embedded_chars long")
    assert tuple(corpus.ocr_audit(conf, "book_key").first()) == ("b", 3, 1, 3, 65.0, 65.0, 2, 205, 50)
    assert corpus.page_ranges(0, 99, 10, 3) == [(1, 4), (5, 8), (9, 10)]
    with pytest.raises(ValueError):
        corpus.page_ranges(11, 20, 10, 2)


def test_release_report(spark):
    inventory = spark.createDataFrame([("a/x", 5, False), ("b", 1, False)], "Path string, Size long, IsDir boolean")
    out = research.release_report("v1", {"T": spark.range(3), "U": spark.range(1).withColumn("s", F.lit("x"))}, inventory, True, [])
    assert "| `U` | 1 | 2 |" in out["report"] and "- bytes: 6" in out["report"] and "| `a` | 1 | 5 |" in out["report"] and "| `s` | `string` |" in out["dictionary"]
    with pytest.raises(ValueError):
        research.release_report("v1", {"T": spark.range(3)}, inventory, True, ["bad"])


def test_ingest(spark, tmp_path):
    doc = {"domain": "finance", "sources": [{"id": "a", "datasets": [{"id": "d", "url": "u"}]}, {"id": "b", "tier": "bulk", "adapter": "static_expand"}, {"id": "c", "enabled": False, "datasets": [{"id": "d", "url": "u"}]}]}
    s = ingest.parse_registry(doc)
    assert [x.source_id for x in ingest.select_sources(s, ["^fin"])] == ["a"]
    assert [x.source_id for x in ingest.select_sources(s, ceiling="massive")] == ["a", "b"]
    for bad in ({"domain": "x", "sources": [{"id": "a"}]}, {"domain": "x", "sources": [{"id": "a", "adapter": "no"}]}, {"domain": "x", "sources": [{"id": "a", "tier": "huge", "adapter": "s3_public"}]}):
        with pytest.raises(ValueError):
            ingest.parse_registry(bad)
    got = ingest.years_by_kind(spark, {"first": 2020, "last": 2021, "kinds": ["x", "y"], "template": "h/{year}/{kind}"}).collect()
    assert {(r.key, r.url) for r in got} == {(f"{k}_{y}", f"h/{y}/{k}") for k in "xy" for y in (2020, 2021)}
    files = ["20260101000000.export.CSV.zip", "20260103000000.gkg.csv", "20251201000000.export.csv", "20260102000000.mentions.CSV.zip", "20260102001500.translation.csv", "export.csv"]
    lines = spark.createDataFrame([(f"1 h http://x/export/{f}",) for f in files] + [("bad",)], "value string")
    window = lambda **more: [(r.key, r.kind) for r in ingest.trailing(spark, {"lines": lines, "now": "2026-01-03", **more}).collect()]
    assert window() == [(files[0], "export"), (files[1], "gkg")]
    assert window(lookback_days=1, streams=["mentions", "other", "gkg"], max_files=2) == [(files[4], "other"), (files[1], "gkg")]
    toc = spark.createDataFrame([(0, 'T\t"ab_cd"'), (1, 'T\t"BAD"'), (2, 'T\t"ab_cd"'), (3, "T\tzzzz")], "ord int, value string")
    assert [r.key for r in ingest.toc_codes(spark, {"lines": toc}).collect()] == ["ab_cd", "zzzz"]
    listing = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "key string, size long")
    assert [r.key for r in ingest.listed(spark, {"listing": listing, "max_bytes": 9}).collect()] == ["a"]
    now = spark.createDataFrame([("a", "e1", "m"), ("b", "e2", "m"), ("c", "e3", "m")], "key string, etag string, modified string")
    was = spark.createDataFrame([("a", "e1", "m", "OK"), ("b", "e0", "m", "OK"), ("c", "e3", "m", "FAILED")], "key string, etag string, modified string, status string")
    assert {r.key for r in ingest.changed(now, was).collect()} == {"b", "c"}
    log = []
    counts = ingest.run([ingest.Dataset("a", "u"), ingest.Dataset("b", "u")], lambda d: 1 / 0 if d.key == "a" else "OK", lambda *a: log.append(a))
    assert counts == {"FAILED": 1, "OK": 1} and len(log) == 2 and log[0][2].startswith("ZeroDivisionError")
    ticks = iter(range(10))
    assert ingest.run([ingest.Dataset(str(i), "u") for i in range(4)], lambda d: ("OK", 5), lambda *a: None, deadline=1, clock=lambda: next(ticks)) == {"OK": 2, "bytes": 10, "SKIPPED": 2}
    assert [(r.key, r.url) for r in ingest.fdic(spark, {}).orderBy("key").collect()][0] == ("fdic_failures", "https://api.fdic.gov/banks/failures?format=csv&limit=10000&offset=0")
    assert ingest.treasury(spark, {"endpoints": {"debt": "v1/debt"}}).first().url.endswith("/fiscal_service/v1/debt?format=csv&page[size]=10000&page[number]=1")
    xml = "<m:Structure xmlns:m='u' xmlns:c='v'><m:Dataflow id='F1' agencyID='A'><c:Name> </c:Name><c:Name>Prices</c:Name></m:Dataflow><m:Dataflow id='F2'/><m:Dataflow agencyID='B'/><m:Dataflow id='OLD' agencyID='B'><c:Name>Prices</c:Name></m:Dataflow></m:Structure>"
    documents = spark.createDataFrame([(xml,), ("<broken",)], "value string")
    assert [tuple(r) for r in ingest.dataflows(documents).orderBy("ord").collect()] == [(0, "A", "F1", "Prices"), (1, "", "F2", "F2"), (2, "B", "OLD", "Prices")]
    assert [(r.key, r.url) for r in ingest.oecd(spark, {"documents": documents, "include_regex": "Pri", "exclude_regex": "^OLD"}).collect()] == [("F1", "https://sdmx.oecd.org/public/rest/data/A,F1,/all?format=csvfilewithlabels")]
    assert [r.url for r in ingest.ecb(spark, {"documents": documents, "max_datasets": 1}).collect()] == ["https://data-api.ecb.europa.eu/service/data/F1?format=csvdata"]
    assert ingest.domains(s) == ["finance"] and ingest.domains(s, ["^x"]) == []
    assert [(x["source"], x["kind"], x["datasets"]) for x in ingest.plan(s)] == [("a", "static", "1"), ("b", "adapter", "via static_expand"), ("c", "static", "1")]
    at = lambda d: dt.datetime(2026, 1, d)
    base = {"source_id": "s", "domain": "x", "url": "u"}
    for rows in ([{"key": "k1", "status": "FAILED", "error": "e" * 200, "at": at(1), **base}], [{"key": "k1", "status": "OK", "bytes": 7, "at": at(2), **base}, {"key": "k2", "status": "FAILED", "error": "bad", "at": at(2), **base}]):
        ingest.append_state(spark, rows, str(tmp_path / "state"))
    st = ingest.status(spark.read.parquet(str(tmp_path / "state")))
    assert st == {"files": 1, "bytes": 7, "by_status": {"OK": (1, 7), "FAILED": (1, 0)}, "by_domain": {"x": (2, 7)}, "failures": [("s", "k2", "bad")]}
    assert ingest.too_many_failures(spark.createDataFrame([(True,), (False,)], "ok boolean"))


def test_functions(spark):
    df = spark.createDataFrame([("Ｆoo  Bar", 1536)], "s string, n long")
    row = df.select(text.nfkc("s").alias("a"), text.human_bytes(F.col("n")).alias("b"), text.slug(F.col("s")).alias("c"), text.cik10(F.lit("123.0")).alias("d"), text.cik10(F.lit("x1")).alias("e"), text.cik10(F.lit("12345678901")).alias("f"), text.key_path(F.lit("data/works/u=1/p.parquet")).alias("g")).first()
    assert (row.a, row.b, row.c, row.d, row.e, row.f, tuple(row.g)) == ("foo bar", "1.5 KiB", "oo-bar", "0000000123", None, "12345678901", ("works", "works/u=1/p.parquet"))


def test_bh(spark):
    df = spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.5,), (0.03,), (None,)], "p double")
    want = [None, 0.05, 0.05, 0.05, 0.05, 0.5]
    assert sorted((None if r.f is None else round(r.f, 6) for r in rank.benjamini_hochberg(df, "p", "f").collect()), key=str) == sorted(want, key=str)
    both = df.withColumn("k", F.lit("a")).union(df.withColumn("k", F.lit(None)))
    assert sorted((None if r.f is None else round(r.f, 6) for r in rank.benjamini_hochberg(both, "p", "f", ["k"]).collect()), key=str) == sorted(want * 2, key=str)


def test_running(spark):
    import itertools

    values = [(i * 7919 % 1000, i % 13 - 4) for i in range(1000)]
    df = spark.createDataFrame(values, "k long, v long").repartition(7)
    values.sort()
    for fn, step in (("sum", lambda a, b: a + b), ("min", min)):
        got = [r.out for r in rank.running(df, [F.asc("k")], F.col("v"), "out", fn).orderBy("k").collect()]
        assert got == list(itertools.accumulate((v for _, v in values), step))
    assert [r.r for r in rank.global_rank(df, [F.desc("k")], "r").orderBy(F.desc("k")).collect()] == list(range(1, 1001))
    assert [r.key for r in tables.within_budget(spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "key string, size long"), 10).orderBy("key").collect()] == ["a", "b"]


def test_streaming(spark, tmp_path):
    from lakequery.streaming.incremental import event_partial, merged, refresh

    src, part, ck = (str(tmp_path / x) for x in ("in", "part", "ck"))
    one = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "event_type string, value double")
    one.write.mode("append").parquet(src)
    assert refresh(spark, src, one.schema, part, ck, event_partial)
    one.union(one).write.mode("append").parquet(src)
    assert refresh(spark, src, one.schema, part, ck, event_partial) and refresh(spark, src, one.schema, part, ck, event_partial)
    assert sorted(map(tuple, merged(spark, part).collect())) == [("a", 3, 3.0), ("b", 3, 6.0)]

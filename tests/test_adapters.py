"""Adapters without a test of their own, and a stream that runs out of time."""

from pyspark.sql import types as T

from lakequery.operators import ingest


def pairs(df):
    return [(r.key, r.url) for r in df.orderBy("key").collect()]


def test_expanding_adapters(spark):
    for name in ("static_expand", "faostat_domains", "census_bds"):
        got = pairs(ingest.ADAPTERS[name](spark, {"codes": ["B", "A"], "prefix": "p_", "template": "http://x/{code}.zip"}))
        assert got == [("p_A", "http://x/A.zip"), ("p_B", "http://x/B.zip")]
    for name in ("federal_register", "usaspending_archive"):
        got = pairs(ingest.ADAPTERS[name](spark, {"first": 2020, "last": 2021, "kinds": ["c", "g"], "template": "http://x/{kind}/{year}"}))
        assert got == [("c_2020", "http://x/c/2020"), ("c_2021", "http://x/c/2021"), ("g_2020", "http://x/g/2020"), ("g_2021", "http://x/g/2021")]
    for name in ("bigquery_public", "external_validation"):
        assert ingest.ADAPTERS[name](spark, {}).count() == 0


def test_page_adapters(spark):
    rows = spark.createDataFrame([("B", "y"), ("A", None), ("C", "n")], "code string, availability string")
    options = {"rows": rows, "template": "http://wb/{code}?per_page=20000"}
    assert pairs(ingest.ADAPTERS["worldbank_indicators"](spark, options)) == [("A", "http://wb/A?per_page=20000"), ("B", "http://wb/B?per_page=20000")]
    assert pairs(ingest.ADAPTERS["worldbank_indicators"](spark, options | {"codes": ["B", "C"]})) == [("B", "http://wb/B?per_page=20000")]
    assert [r.key for r in ingest.ADAPTERS["worldbank_indicators"](spark, options | {"limit": 1}).collect()] == ["A"]
    html = "<a href='/q/2.csv'>q</a> <a href=\"/m/1.csv\">m</a> <a href=\"/m/2.csv\">older</a>"
    got = ingest.ADAPTERS["stlouisfed_fredmd"](spark, {"html": html, "patterns": {"monthly": r'href="(/m/[^"]+)"', "quarterly": r"href='(/q/[^']+)'", "daily": "href=(/d/)"}})
    assert pairs(got) == [("monthly", "/m/1.csv"), ("quarterly", "/q/2.csv")]
    toc = spark.createDataFrame([(0, '"Title"\t"code"\t"type"'), (1, ' "Labour"\t"lfs_a"\t'), (2, "Trade\text_b"), (3, "Again\tlfs_a"), (4, "Bad\tX"), (5, "alone")], "ord int, value string")
    got = ingest.ADAPTERS["eurostat"](spark, {"lines": toc, "include_regex": "_"}).collect()
    base = "https://ec.europa.eu/eurostat/api/dissemination/sdmx/2.1/data/"
    assert [(r.key, r.url, r.filename, r.notes) for r in got] == [("lfs_a", f"{base}lfs_a/?format=TSV&compressed=true", "lfs_a.tsv.gz", "Labour"), ("ext_b", f"{base}ext_b/?format=TSV&compressed=true", "ext_b.tsv.gz", "Trade")]


def test_jobs_of_every_kind(spark):
    """Datasets within the ceiling and those of adapters, as one table of jobs; a broken adapter is told and stops nothing."""
    sources = ingest.parse_registry({"domain": "d", "sources": [
        {"id": "s", "datasets": [{"id": "a", "url": "http://x/a"}, {"id": "b", "url": "http://x/b", "tier": "massive"}]}, {"id": "e", "adapter": "static_expand", "options": {"codes": list("1234"), "template": "http://e/{code}"}}, {"id": "broken", "adapter": "fdic_api", "options": {"endpoints": 5}},
    ]})
    jobs, errors = ingest.jobs_of(spark, sources, "bulk", sample=3)
    assert pairs(jobs) == [("e/1", "http://e/1"), ("e/2", "http://e/2"), ("e/3", "http://e/3"), ("s/a", "http://x/a")] and [e[0] for e in errors] == ["broken"]


def test_deadline_of_a_stream(spark, tmp_path):
    """A refresh that runs out of time says so, and the next one goes on where it stopped."""
    import time

    from lakequery.streaming.incremental import event_partial, merged, refresh

    schema = T._parse_datatype_string("event_type string, value double")
    for i in range(3):
        spark.createDataFrame([("a", float(i))], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def slow(batch):
        time.sleep(4)
        return event_partial(batch)

    ask = lambda partial, timeout: refresh(spark, f"{tmp_path}/in", schema, f"{tmp_path}/part", f"{tmp_path}/ck", partial, timeout=timeout, files_per_trigger=1)
    assert ask(slow, 2) is False
    assert ask(event_partial, 120) is True
    assert [tuple(r) for r in merged(spark, f"{tmp_path}/part").collect()] == [("a", 3, 3.0)]

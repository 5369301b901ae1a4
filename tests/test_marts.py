"""Mergeable and stored marts, ordered and guarded queries, deltas."""

import json
import random
from collections import defaultdict
from functools import reduce

import pytest
from pyspark.sql import functions as F

from lakequery.operators import catalog, marts, mergeable, quality, research
from lakequery.sources import stored, tables

WORK = "id string, publication_year int, cited_by_count int"
TOPIC = "work_id string, topic_id string, topic_score double"
PLACE = "work_id string, institution_id string, institution_country_code string"
PAIR = "work_id string, country_a string, country_b string"


def made(seed, files=6, works=400, shared=0.4):
    """Files of works with their edges; many works are in two files, with the same edges in both."""
    r = random.Random(seed)
    each = []
    for i in range(works):
        number = r.choice([i, i, 40_000 + i, 10**12 + i])
        w = (f"https://x.org/W{number}", r.choice([2019, 2020, 2021, None]), r.choice([0, 1, 7, 1000, 2**31 - 1, None]))
        topics = [(w[0], r.choice(["t1", "t2", "t3", None]), r.choice([0.25, 0.5, 1.0, None])) for _ in range(r.randrange(4))]
        places = [(w[0], r.choice(["i1", "i2", "i3", None]), r.choice(["US", "FR", "DE", "", None])) for _ in range(r.randrange(5))]
        pairs = [(w[0], a, b) for a, b in (("DE", "FR"), ("FR", "DE"), ("", "US"), ("FR", "US"), (None, "US")) if r.random() < 0.4]
        each.append((w, topics, places, pairs))
    out = defaultdict(list)
    for x in each:
        for f in {r.randrange(files), r.randrange(files) if r.random() < shared else -1} - {-1}:
            out[f].append(x)
    return each, out


def frames(spark, rows):
    pick = lambda i: [y for x in rows for y in x[i]]
    return spark.createDataFrame([x[0] for x in rows], WORK), {"topics": spark.createDataFrame(pick(1), TOPIC), "institutions": spark.createDataFrame(pick(2), PLACE), "collaboration": spark.createDataFrame(pick(3), PAIR)}


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))) for r in df.collect()), key=str)


def plain_mart(each, name):
    """work_count and citation_sum of a mart in plain Python, over works each once."""
    out = defaultdict(lambda: [set(), 0])
    for (k, year, cites), topics, places, pairs in each:
        if year is None:
            continue
        rows = {
            "WORK_YEAR_METRICS": [()],
            "WORK_YEAR_TOPIC": [(t,) for _, t, _ in topics if t is not None],
            "WORK_YEAR_INSTITUTION": [(i,) for i, _ in {(i, c) for _, i, c in places if i is not None}],
            "WORK_YEAR_COUNTRY": list({(c,) for _, _, c in places if c}),
            "COUNTRY_COLLAB_YEAR": [(a, b) for _, a, b in pairs if a and b and a < b],
        }[name]
        for dims in rows:
            out[(year, *dims)][0].add(k)
            out[(year, *dims)][1] += cites or 0
    return {k: (len(w), s) for k, (w, s) in out.items()}


def test_mart_names_and_validator(spark):
    each, _ = made(1)
    master, edges = frames(spark, each)
    found = marts.year_marts(master, **edges)
    assert set(found) == set(quality.MART_KEYS)
    for name, df in found.items():
        dims = ["publication_year", *marts.DIMS[name]]
        assert {tuple(r[d] for d in dims): (r.work_count, r.citation_sum) for r in df.collect()} == plain_mart(each, name)
    errors, profile = quality.validate_marts(found)
    assert errors == [] and profile.count() == 5


@pytest.mark.parametrize("dense", [1, 8, 10**6])
def test_partials_of_shared_works(spark, dense):
    """All as bitmaps, both, all as lists; each file's partials twice."""
    each, files = made(2, files=3, works=250)
    master, edges = frames(spark, each)
    want = {n: rows_of(df) for n, df in marts.year_marts(master, **edges).items()}
    parts, kinds = defaultdict(list), set()
    for i, rows in enumerate(files.values()):
        m, e = frames(spark, rows)
        for name, df in mergeable.mart_partials(m, **e, dense=dense if i % 2 else 8).items():
            parts[name] += [df, df] if i % 3 == 0 else [df]
    for name, dfs in parts.items():
        whole = dfs[0]
        for df in dfs[1:]:
            whole = whole.union(df)
        whole = tables.persist_table(whole)
        assert rows_of(mergeable.merge_marts(whole, name)) == want[name], name
        kinds |= {r.b for r in whole.select(F.isnotnull("bits").alias("b")).distinct().collect()}
    assert kinds == {True, False}  # bitmaps and lists


@pytest.mark.parametrize("dense", [1, 3, 10**6])
def test_file_partials_in_one_plan(spark, dense):
    """Files that share works, merged from the plan of their partials: the marts of the distinct works, and only files of their own name meet."""
    each, files = made(3, files=4, works=60)
    master, edges = frames(spark, each)
    tagged = [frames(spark, rows) for rows in files.values()]
    tag = lambda pick: reduce(lambda a, b: a.unionByName(b), (pick(m, e).withColumn("file", F.lit(f"f{i}")) for i, (m, e) in enumerate(tagged)))
    stray = spark.createDataFrame([("https://x.org/W1", "t9", 1.0, "none"), ("https://x.org/W1", "t9", 1.0, None)], f"{TOPIC}, file string")
    got = mergeable.mart_partials(tag(lambda m, e: m), topics=tag(lambda m, e: e["topics"]).unionByName(stray), file="file", dense=dense)
    assert rows_of(mergeable.merge_marts(got["WORK_YEAR_TOPIC"], "WORK_YEAR_TOPIC")) == rows_of(marts.year_marts(master, topics=edges["topics"])["WORK_YEAR_TOPIC"])


def test_overlapping_partials_deal_once(spark):
    """Works, edges, containers and the last sums are each dealt once, and all else reads those."""
    from lakequery.plans.queries import QUERIES

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["q72_overlapping_partials"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    dealt = [x for x in plan.splitlines() if " Exchange hashpartitioning" in x and "ReusedExchange" not in x]
    assert 0 < len(dealt) <= 4, "\n".join(dealt)


def test_partials_refuse(spark):
    bad = spark.createDataFrame([("W1", 2020, -5)], WORK)
    with pytest.raises(Exception, match="negative"):
        mergeable.mart_partials(bad)["WORK_YEAR_METRICS"].collect()
    with pytest.raises(Exception, match="no number in Wx"):
        mergeable.mart_partials(spark.createDataFrame([("Wx", 2020, 5)], WORK))["WORK_YEAR_METRICS"].collect()
    nothing = mergeable.mart_partials(bad.limit(0))["WORK_YEAR_METRICS"]
    assert mergeable.merge_marts(nothing, "WORK_YEAR_METRICS").count() == 0


def test_streamed_marts(spark, tmp_path):
    """Files come in three calls, with works in common, one file again under another name, and one batch repeated after its checkpoint was lost."""
    from lakequery.streaming.incremental import refresh_year_marts, streamed_mart

    each, files = made(3, files=4, works=150)
    root, part = f"file://{tmp_path}/curated", f"file://{tmp_path}/partials"
    folders = {"topics": "WORK_TOPIC_EDGES", "institutions": "AUTHOR_INSTITUTION_EDGES", "collaboration": "COUNTRY_COLLAB_EDGES"}

    def put(rows, name):
        m, e = frames(spark, rows)
        for folder, df in (("WORK_MASTER", m), *((folders[k], v) for k, v in e.items())):
            df.toPandas().to_parquet(_made(tmp_path / "curated" / folder / name)) if df.count() else None

    def _made(p):
        p.parent.mkdir(parents=True, exist_ok=True)
        return p

    from pyspark.sql import types as T

    schema = T._parse_datatype_string("id string, publication_year double, cited_by_count double")
    call = lambda ck="ck": refresh_year_marts(spark, root, schema, part, f"file://{tmp_path}/{ck}", files_per_trigger=2, dense=8)
    names = sorted(files)
    put(files[names[0]], "u=1/a.parquet")
    put(files[names[1]], "u=1/b.parquet")
    assert call()
    for i in names[2:]:
        put(files[i], f"u=2/{i}.parquet")
    assert call() and call()
    put(files[names[0]], "u=3/again.parquet")
    assert call()
    assert call("lost")  # a new checkpoint takes every file once more
    m, e = frames(spark, each)
    for name, df in marts.year_marts(m, **e).items():
        got = streamed_mart(spark, part, name).withColumn("publication_year", F.col("publication_year").cast("int"))
        assert rows_of(got) == rows_of(df), name


def test_bucketed_marts_move_nothing_before_the_last_sums(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        each, _ = made(4)
        master, edges = frames(spark, each)
        want = {n: rows_of(df) for n, df in marts.year_marts(master, **edges).items()}
        kept = {k: stored.store_bucketed(v, f"stored_{k}", f"file://{tmp_path}/{k}", "work_id", 4) for k, v in edges.items()}
        works = stored.store_bucketed(master, "stored_works", f"file://{tmp_path}/works", "id", 4)
        spark.sql("DROP TABLE stored_works")
        works = stored.attach_bucketed(spark, "stored_again", f"file://{tmp_path}/works")
        assert len(list((tmp_path / "works").glob("part-*"))) <= 4

        def exchanges(df):
            return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

        for name, df in marts.year_marts(works, **kept, dealt=True).items():
            assert exchanges(df) == 1, name  # by year and key, of sums
            assert rows_of(df) == want[name], name
        assert exchanges(marts.year_marts(master, **edges)["WORK_YEAR_TOPIC"]) > 1
        link = spark.createDataFrame([("c1", "i1"), ("c2", "i2")], "canonical_company_id string, openalex_institution_id string")
        plain, held = (research.company_topic_year(link, marts.works_of(m), e["institutions"], e["topics"].na.fill(0.0), dealt=d) for m, e, d in ((master, edges, False), (works, kept, True)))
        assert exchanges(held) == exchanges(plain) - 3  # before they run, as a plan that ran is printed twice
        assert rows_of(plain) == rows_of(held)
        # with a bridge small enough to be broadcast, only the last sums are dealt
        assert exchanges(research.company_topic_year(F.broadcast(link), marts.works_of(works), kept["institutions"], kept["topics"], dealt=True)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("topics", "institutions", "collaboration", "again"):
            spark.sql(f"DROP TABLE IF EXISTS stored_{t}")


def test_shards_resume(spark, tmp_path):
    import hashlib

    root = f"file://{tmp_path}/master"
    df = spark.createDataFrame([(f"u={i % 3}/p{i % 7}.parquet", i) for i in range(100)], "relpath string, v int")
    assert stored.write_shards(df, root, "relpath", 4) == 21
    paths = sorted({f"u={i % 3}/p{i % 7}.parquet" for i in range(100)})
    want = {f"batch={k % 4:03d}/{hashlib.sha256(p.encode()).hexdigest()[:16]}.parquet": p for k, p in enumerate(paths)}
    assert {str(f.relative_to(tmp_path / "master")) for f in (tmp_path / "master").rglob("*.parquet")} == set(want)
    assert stored.write_shards(df, root, "relpath", 4) == 0
    lost = sorted(want)[5]
    (tmp_path / "master" / lost).unlink()
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "master").rglob("*.parquet")}
    assert stored.write_shards(df, root, "relpath", 4) == 1
    assert all(f.stat().st_mtime_ns == t for f, t in before.items())
    back = spark.read.option("recursiveFileLookup", "true").parquet(root)
    assert back.columns == ["v"] and sorted(r.v for r in back.collect()) == list(range(100))
    got = spark.read.parquet(f"{root}/{lost}")
    assert sorted(r.v for r in got.collect()) == [i for i in range(100) if f"u={i % 3}/p{i % 7}.parquet" == want[lost]]
    with pytest.raises(ValueError):
        stored.write_shards(df.union(spark.createDataFrame([(None, 1)], df.schema)), root, "relpath", 4)


def test_guard(spark, tmp_path):
    spark.sql(f"CREATE TABLE guarded (a INT) USING parquet LOCATION 'file://{tmp_path}/guarded'")
    try:
        for bad in (
            "WITH x AS (SELECT 1 AS a) INSERT INTO guarded SELECT a FROM x", "FROM (SELECT 1 AS a) INSERT INTO guarded SELECT a INSERT INTO guarded SELECT a + 1", "WITH x AS (SELECT 1 AS a) FROM x INSERT INTO guarded SELECT a INSERT INTO guarded SELECT a",
            "WITH x AS (SELECT 1 AS a) INSERT OVERWRITE TABLE guarded SELECT a FROM x", "SELECT 1; DROP TABLE guarded", "EXPLAIN SELECT 1", "SET x = 1", "VALUES (1)", "with", "SHOW TABLES", "INSERT INTO guarded VALUES (1)", "CACHE TABLE g AS SELECT 1",
        ):
            with pytest.raises(Exception):
                catalog.read_only(spark, bad).collect()
        assert spark.table("guarded").count() == 0
        good = "WITH x AS (SELECT 1 AS a, 'insert into guarded' AS s) SELECT a, (SELECT max(a) FROM x) AS m FROM x WHERE a IN (SELECT a FROM x) ORDER BY a;"
        assert [tuple(r) for r in catalog.read_only(spark, good).collect()] == [(1, 1)]
    finally:
        spark.sql("DROP TABLE guarded")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_order_at_the_sink(spark, tmp_path, fmt, monkeypatch):
    """Many files of unequal size; rows come in the query's order."""
    import csv
    import hashlib

    import pyarrow.parquet as pq

    n = 20_000
    spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.repeat(F.lit("x"), F.pmod("id", F.lit(97)).cast("int")).alias("s")).createOrReplaceTempView("unordered")
    monkeypatch.setattr(catalog, "WHOLE_FILE", 50_000)  # some files are streamed
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = catalog.execute_query(spark, "SELECT k, s FROM unordered ORDER BY k DESC", f"file://{tmp_path}/o", fmt)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "o").glob("part-*"))
    assert (len(files) > 1) == (fmt != "json") and out["rows"] == n and out["columns"] == ["k", "s"]
    assert out["file_sha256"] == [hashlib.sha256(f.read_bytes()).hexdigest() for f in files]
    if fmt == "parquet":
        got = [k for f in files for k in pq.read_table(f)["k"].to_pylist()]
        assert [r.k for r in tables.read_in_order(spark, f"file://{tmp_path}/o", "place").orderBy("place").collect()] == got
    elif fmt == "csv":
        got = [int(r["k"]) for f in files for r in csv.DictReader(f.open())]
    else:
        got = [r["k"] for r in json.loads(files[0].read_text())]
    assert got == list(range(n - 1, -1, -1))


def test_delta(spark):
    schema = "canonical_company_id string, company_name string, openalex_institution_id string, publication_year int, work_count long, citation_sum long"
    base = spark.createDataFrame([("c1", "One", "i1", 2019, 1, 1), (None, None, None, 2019, 1, 1)], schema)
    new = spark.createDataFrame([("c1", "One", "i1", 2020, 5, 9), ("c2", "Two", "i2", 2018, 2, 4), ("c2", "Two", "i2", 2021, 3, None), ("c3", None, "i3", 2020, 1, 0)], schema)
    got = {tuple(r) for r in research.research_delta(base, new).collect()}
    assert got == {("c2", "Two", "i2", 2, 2018, 2021, 5, 4), ("c3", None, "i3", 1, 2020, 2020, 1, 0)}
    assert tuple(research.research_delta_summary(base, new, new.limit(3)).first()) == (1, 3, 3, 2, 3, 6, 4)
    assert tuple(research.research_delta_summary(new, new, new.limit(0)).first()) == (3, 3, 0, 0, 0, 0, 0)

"""Fetching, probing and listing against a local server with the faults that real hosts have."""

import hashlib
import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from lakequery.operators import ingest
from lakequery.sources import web
from lakequery.sources.tables import persist_table

BIG = bytes(range(256)) * 1000
KEYS = sorted({f"data/{a}={i}/part_{i * 7919 % 1000:03}.gz" for i in range(120) for a in ("works", "authors", "écoles")} | {"data/x", "data/x&y", "data/", "datb", "a"})


class Host(BaseHTTPRequestHandler):
    hits: Counter = Counter()
    asked: list = []
    body, etag = b"a,b\n1,2\n", '"one"'

    def log_message(self, *a):
        pass

    def send(self, status, body=b"", kind="text/csv", size=None, **headers):
        self.send_response(status)
        self.send_header("Content-Type", kind)
        if size is not False:
            self.send_header("Content-Length", str(len(body) if size is None else size))
        for k, v in headers.items():
            self.send_header(k.replace("_", "-"), v)
        self.end_headers()
        if self.command != "HEAD":
            self.wfile.write(body)

    def do_HEAD(self):
        self.send(405) if urlsplit(self.path).path == "/nohead" else self.do_GET()

    def do_GET(self):
        url = urlsplit(self.path)
        Host.hits[url.path] += 1
        Host.asked.append((url.path, dict(self.headers)))
        n, name = Host.hits[url.path], url.path
        if name == "/good":
            same = self.headers.get("If-None-Match") == Host.etag
            self.send(304) if same else self.send(200, Host.body, ETag=Host.etag, Last_Modified="Wed, 21 Oct 2026 07:28:00 GMT")
        elif name == "/big":
            self.send(200, BIG, "application/zip")
        elif name == "/page":
            self.send(200, b"  <!DOCTYPE HTML><html></html>", "text/html")
        elif name == "/huge":
            self.send(200, b"x" * 100, size=10**12)
        elif name == "/undeclared":
            self.send(200, b"y" * 5000, size=False)
        elif name == "/cut":  # the first answer breaks off after its first half
            self.send(200, BIG if n > 1 else BIG[: len(BIG) // 2], size=len(BIG))
        elif name == "/flaky":
            self.send(200, b"at last") if n > 2 else self.send(503)
        elif name == "/empty":
            self.send(200)
        elif name == "/moved":
            self.send(302, Location="/good")
        elif name == "/nohead":
            self.send(206, b"z", Content_Range="bytes 0-0/4711")
        elif name == "/list":
            self.listing({k: v[0] for k, v in parse_qs(url.query).items()})
        else:
            self.send({"/forbidden": 403, "/down": 500}.get(name, 404))

    def listing(self, asked):
        keys = [k for k in KEYS if k.startswith(asked.get("prefix", ""))]
        at = int(asked["continuation-token"]) if "continuation-token" in asked else sum(k <= asked.get("start-after", "") for k in keys)
        some = keys[at : at + int(asked["max-keys"])]
        more = at + len(some) < len(keys)
        quoted = lambda k: k.replace("&", "&amp;")
        body = "".join(f"<Contents><Key>{quoted(k)}</Key><Size>{len(k)}</Size></Contents>" for k in some)
        token = f"<NextContinuationToken>{at + len(some)}</NextContinuationToken>" if more else ""
        self.send(200, f"<L xmlns='urn:s3'><IsTruncated>{str(more).lower()}</IsTruncated>{token}{body}</L>".encode(), "text/xml")


@pytest.fixture(scope="module")
def base():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Host)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}"
    server.shutdown()


@pytest.fixture(autouse=True)
def fresh():
    Host.hits.clear()
    Host.asked.clear()
    Host.body, Host.etag = b"a,b\n1,2\n", '"one"'


QUICK = web.Limits(timeout=5, retries=2, chunk=50_000, longest_wait=0.0, max_bytes=10**6)


def rows(job, limits=QUICK):
    out = list(web.fetch_one(job, limits))
    names = [c.split()[0] for c in web.FETCHED.split(", ")][:-1]
    return [dict(zip(names, r, strict=True)) for r in out]


def test_fetch_one(base):
    job = lambda name, **more: {"key": name, "url": f"{base}/{name}", **more}
    *parts, end = rows(job("big"))
    assert [len(p["content"]) for p in parts] == [50_000] * 5 + [6_000] and b"".join(p["content"] for p in parts) == BIG
    assert (end["status"], end["bytes"], end["sha256"]) == ("OK", len(BIG), hashlib.sha256(BIG).hexdigest())
    (_, end) = rows(job("good"))
    assert (end["etag"], end["modified"], end["http_status"]) == ('"one"', "Wed, 21 Oct 2026 07:28:00 GMT", 200)
    assert [(r["status"], r["etag"]) for r in rows(job("good", etag='"one"'))] == [("UNCHANGED", '"one"')]
    assert rows(job("moved"))[-1]["status"] == "OK"
    for name, why, hits in (("page", "web page", 1), ("huge", "ceiling", 1), ("empty", "empty", 1), ("forbidden", "403", 1), ("nothing", "404", 1), ("down", "500", 3)):
        end = rows(job(name))[-1]
        assert end["status"] == "FAILED" and why in end["error"] and Host.hits[f"/{name}"] == hits, name
    assert rows(job("page", expect_html=True))[-1]["status"] == "OK"
    assert "no size was declared" in rows(job("undeclared", max_bytes=4000))[-1]["error"]
    *parts, end = rows(job("flaky"))
    assert (end["status"], end["attempt"], Host.hits["/flaky"]) == ("OK", 2, 3) and [p["attempt"] for p in parts] == [2]
    *parts, end = rows(job("cut"))
    assert (end["status"], end["attempt"]) == ("OK", 1) and b"".join(p["content"] for p in parts if p["attempt"] == 1) == BIG and {p["attempt"] for p in parts} == {0, 1}
    assert rows({"key": "x", "url": "http://127.0.0.1:9/x"})[-1]["status"] == "FAILED"
    assert "no http address" in rows({"key": "x", "url": "file:///etc/passwd"})[-1]["error"]
    assert rows(job("good", secret="TOKEN"))[0]["status"] == "SKIPPED"
    assert rows(job("good", secret="TOKEN", headers={"X-Key": "$TOKEN", "User-Agent": "mine"}), web.Limits(secrets={"TOKEN": "s3"}))[-1]["status"] == "OK"
    assert (Host.asked[-1][1]["X-Key"], Host.asked[-1][1]["User-Agent"]) == ("s3", "mine")
    before = sum(Host.hits.values())
    assert rows(job("good"), web.Limits(deadline=time.time() - 1))[0]["status"] == "SKIPPED" and sum(Host.hits.values()) == before


def test_fetch_table(spark, base):
    """As a table and as a data source: whole files only, and the same rows."""
    names = ["good", "big", "cut", "forbidden", "page", "flaky"]
    jobs = spark.createDataFrame([(n, f"{base}/{n}") for n in names], "key string, url string")
    got = persist_table(web.fetch(jobs, QUICK, tasks=3))
    ended = {r.key: (r.status, r.bytes, r.sha256) for r in web.results(got).collect()}
    assert {k: v[0] for k, v in ended.items()} == {"good": "OK", "big": "OK", "cut": "OK", "forbidden": "FAILED", "page": "FAILED", "flaky": "OK"}
    whole: dict = {}
    for r in sorted(web.chunks(got).collect(), key=lambda r: (r.key, r.seq)):
        whole[r.key] = whole.get(r.key, b"") + bytes(r.content)
    assert {k: hashlib.sha256(v).hexdigest() for k, v in whole.items()} == {k: v[2] for k, v in ended.items() if v[0] == "OK"}
    Host.hits.clear()
    spark.dataSource.register(web.FetchSource)
    port = urlsplit(base).port
    listed = [{"key": n, "url": f"{base}/{n}"} for n in names] + [{"key": "other", "url": f"http://localhost:{port}/good"}]
    read = spark.read.format("fetch").option("jobs", json.dumps(listed)).options(chunk="50000", longest_wait="0", retries="2", max_bytes="1000000").load()
    assert read.rdd.getNumPartitions() == 2  # a partition a host
    again = persist_table(read)
    assert {r.key: (r.status, r.bytes, r.sha256) for r in web.results(again).where("key <> 'other'").collect()} == ended
    assert web.fetch(jobs.limit(0), QUICK).count() == 0


def test_runs_keep_state(spark, base, tmp_path):
    """Unchanged, changed, failed and then good, and isolated failures over four runs."""
    raw, state = f"file://{tmp_path}/raw", f"file://{tmp_path}/state"
    jobs = spark.createDataFrame([("s", "d", n, f"{base}/{n}") for n in ("good", "flaky", "gone", "big")], "source_id string, domain string, key string, url string")
    once = web.Limits(timeout=5, retries=0, chunk=100_000)
    run = lambda **more: ingest.fetch_run(spark, jobs, raw, state, once if not more else web.Limits(timeout=5, retries=0, **more), tasks=2)
    body = lambda: {r.key: r.h for r in ingest.raw_files(spark, raw, state).groupBy("key").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.hex("content").alias("h")))), lambda x: x["h"]), ""), 256).alias("h")).collect()}
    digest = lambda b: hashlib.sha256(b.hex().upper().encode()).hexdigest()
    first = run()
    assert first == {"OK": 2, "FAILED": 2, "bytes": len(BIG) + 8}
    assert run()["UNCHANGED"] == 1
    assert body() == {"good": digest(b"a,b\n1,2\n"), "big": digest(BIG)}
    Host.body, Host.etag = b"a,b\n3,4\n", '"two"'
    assert run() == {"OK": 3, "FAILED": 1, "bytes": len(BIG) + 8 + 7}  # flaky has come to itself
    assert body() == {"good": digest(b"a,b\n3,4\n"), "big": digest(BIG), "flaky": digest(b"at last")}
    assert run(deadline=time.time() - 5) == {"SKIPPED": 4}
    assert run()["UNCHANGED"] == 1
    told = ingest.status(spark.read.parquet(state))
    assert told["by_status"]["FAILED"][0] == 1 and told["files"] == 3 and told["failures"][0][1] == "gone"
    ingest.compact_state(spark, state, f"file://{tmp_path}/state2")
    assert ingest.status(spark.read.parquet(f"{tmp_path}/state2")) == told and spark.read.parquet(f"{tmp_path}/state2").count() <= 8
    assert ingest.fetch_run(spark, jobs, raw, f"file://{tmp_path}/state2", once, tasks=2)["UNCHANGED"] == 1


def test_probe_and_health(spark, base):
    sources = ingest.parse_registry({"domain": "x", "sources": [
        {"id": "a", "datasets": [{"id": n, "url": f"{base}/{n}"} for n in ("good", "page", "forbidden", "nohead")]}, {"id": "b", "adapter": "static_expand", "options": {"template": f"{base}/v{{v}}", "values": ["1", "2", "3", "4"]}},
    ]})
    jobs, errors = ingest.jobs_of(spark, sources[:1])
    assert errors == []
    probed = persist_table(web.probe(jobs.union(spark.createDataFrame([("z", "x", "z/none", "http://127.0.0.1:9/")], jobs.schema)), QUICK, tasks=2))
    got = {r.key: (r.http_status, r.ok, r.size) for r in probed.collect()}
    assert got == {"a/good": (200, True, 8), "a/page": (200, False, 30), "a/forbidden": (403, False, 0), "a/nohead": (206, True, 4711), "z/none": (None, False, None)}
    assert ingest.too_many_failures(probed) and not ingest.too_many_failures(probed.where("ok"))
    report = ingest.health(probed)
    assert "- checked: 5" in report and "- failing: 3" in report and "| `a/nohead` | 4,711 |" in report
    bad, errors = ingest.jobs_of(spark, [ingest.Source("c", "x", adapter="static_expand", options={}), *sources[:1]])
    assert bad.count() == 4 and errors[0][0] == "c"


@pytest.mark.parametrize("page,ranges", [(1, 1), (7, 3), (1000, 40)])
def test_listing(spark, base, page, ranges):
    for prefix, after in (("", ""), ("data/", ""), ("data/", "data/works=100/part_9"), ("none", ""), ("data/x", "")):
        want = [(k, len(k)) for k in KEYS if k.startswith(prefix) and k > after]
        got = [tuple(r) for r in web.list_store(spark, f"{base}/list", prefix, after, ranges=ranges, page=page).collect()]
        assert sorted(got) == want and len(got) == len(set(got)), (prefix, after)
    assert [r.key for r in web.list_store(spark, f"{base}/list", "data/", max_keys=5, ranges=ranges, page=page).collect()] == [k for k in KEYS if k.startswith("data/")][:5]
    if ranges == 40:
        assert len(web.key_ranges(f"{base}/list", "data/", ranges=ranges)) >= 4


def test_store_adapter(spark, base):
    """A host's listing within a byte budget, its addresses fetched from the same place."""
    ends = [k for k in KEYS if k.startswith("data/") and k.endswith((".gz", "x"))][:50]
    total = sum(map(len, ends[:7]))
    got = ingest.ADAPTERS["s3_public"](spark, {"endpoint": f"{base}/list", "prefix": "data/", "suffix": [".gz", "x"], "max_bytes": total, "max_keys": 50}).orderBy("key").collect()
    assert [(r.key, r.url, r.max_bytes) for r in got] == [(k, f"{base}/list{k}", 1 << 20) for k in ends[:7]]

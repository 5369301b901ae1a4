"""Fetching over HTTP by Spark tasks: conditional downloads as rows of chunks, probes, and listings of object stores by key ranges.

A file comes as rows of at most a few megabytes and one row that says how it ended, so no task, row or driver ever holds a file, and Spark writes chunks to
whatever store it writes to. Requests to one host go one after the other."""

from __future__ import annotations

import hashlib
import http.client
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Statuses after which a request is tried again, and what a web page starts with.
RETRYABLE = frozenset((408, 425, 429, 500, 502, 503, 504, 522, 524))
PAGES = (b"<!doctype html", b"<html", b"<head>")
SNIFF = 2048
JOB = "key string, url string, etag string, modified string, max_bytes long, expect_html boolean, headers map<string,string>, secret string, pause double"
FETCHED = "key string, attempt int, seq int, content binary, status string, http_status int, bytes long, sha256 string, etag string, modified string, error string, at timestamp"
PROBED = "key string, url string, http_status int, ok boolean, note string, size long"
NETWORK = (OSError, http.client.HTTPException)


@dataclass(frozen=True)
class Limits:
    """Of a run: seconds for an answer, retries, the ceiling for a file without one of its own, bytes of a chunk, the longest wait between attempts, the time
    (as time.time()) after which no download starts, and values for headers and jobs that ask for a secret."""

    timeout: float = 120.0
    retries: int = 4
    max_bytes: int = 5 * 1024**3
    chunk: int = 4 * 1024**2
    longest_wait: float = 60.0
    deadline: float | None = None
    agent: str = "Mozilla/5.0 (compatible; data-lake)"
    secrets: dict = field(default_factory=dict)


class Refused(Exception):
    def __init__(self, message: str, status: int | None = None, again: bool = False) -> None:
        super().__init__(message)
        self.status, self.again = status, again


def explain(status: int, url: str) -> str:
    """What to do about an answer."""
    host = urllib.parse.urlsplit(url).netloc or url
    if status == 401:
        return f"{host} wants credentials (401): set the source's secret"
    if status == 403:
        return f"{host} turns this client away (403), as a bot or by country: try other headers or its official interface"
    if status == 404:
        return f"{host} has no such file (404): the address is out of date, look it up in the host's catalogue"
    if status == 429:
        return f"{host} limits requests (429): make the pause between them longer"
    if status >= 500:
        return f"{host} has a fault of its own ({status}): a later run may succeed"
    return f"{host} answered {status}"


def _open(url: str, headers: dict, timeout: float, method: str = "GET"):
    """The answer, whatever its status; redirects are followed."""
    if not url.startswith(("http://", "https://")):
        raise ValueError(f"no http address: {url}")
    try:
        return urllib.request.urlopen(urllib.request.Request(url, headers=headers, method=method), timeout=timeout)
    except urllib.error.HTTPError as e:
        return e


def is_page(head: bytes) -> bool:
    return head[:SNIFF].lstrip().lower().startswith(PAGES)


def declared_size(headers) -> int | None:
    """From the range's total or the content's length."""
    whole = (headers.get("Content-Range") or "").rpartition("/")[2].strip()
    size = whole if whole.isdigit() else headers.get("Content-Length") or ""
    return int(size) if size.isdigit() else None


def _headers(job: dict, limits: Limits) -> dict:
    own = {k: limits.secrets.get(v[1:], "") if v and v.startswith("$") else v or "" for k, v in (job.get("headers") or {}).items()}
    return {"User-Agent": limits.agent, "Accept": "*/*", "Accept-Language": "en-US,en;q=0.9"} | own


def _body(answer, url: str, job: dict, limits: Limits) -> Iterator[tuple[bytes, str | None]]:
    """Chunks of a good answer; each refusal is raised as soon as it is known."""
    ceiling = job.get("max_bytes") or limits.max_bytes
    size = declared_size(answer.headers)
    if size is not None and size > ceiling:
        raise Refused(f"the file has {size} bytes, the ceiling is {ceiling}: raise max_bytes or put it in a higher tier", answer.status)
    total, first = 0, True
    while chunk := answer.read(limits.chunk):
        total += len(chunk)
        if total > ceiling:
            raise Refused(f"more than {ceiling} bytes came, and no size was declared", answer.status)
        if first and not job.get("expect_html") and is_page(chunk):
            raise Refused("a web page came in place of a file, such as a form or a consent wall: find the direct address", answer.status)
        first = False
        yield chunk
    if size is not None and total < size and not answer.headers.get("Content-Encoding"):
        raise Refused(f"{total} of {size} bytes came", answer.status, True)
    if not total:
        raise Refused("the answer is empty", answer.status)


def fetch_one(job: dict, limits: Limits) -> Iterator[tuple]:
    """Rows of FETCHED but the time: chunks, numbered from 0 in each attempt, then one row without a number: OK, UNCHANGED, FAILED or SKIPPED. Chunks of other attempts
    than the one that this row names don't count."""
    key, url = job["key"], job["url"]
    if job.get("secret") and not limits.secrets.get(job["secret"]):
        yield key, 0, None, None, "SKIPPED", None, None, None, None, None, f"the secret {job['secret']} is missing"
        return
    if limits.deadline is not None and time.time() > limits.deadline:
        yield key, 0, None, None, "SKIPPED", None, None, None, None, None, "the run's time is over"
        return
    headers = _headers(job, limits)
    headers |= {h: v for h, v in (("If-None-Match", job.get("etag")), ("If-Modified-Since", job.get("modified"))) if v}
    for attempt in range(limits.retries + 1):
        status = None
        try:
            with _open(url, headers, limits.timeout) as answer:
                status = answer.status
                if status == 304:
                    yield key, attempt, None, None, "UNCHANGED", 304, 0, None, job.get("etag"), job.get("modified"), None
                    return
                if status >= 400:
                    raise Refused(explain(status, url), status, status in RETRYABLE)
                digest, total = hashlib.sha256(), 0
                for seq, chunk in enumerate(_body(answer, url, job, limits)):
                    digest.update(chunk)
                    total += len(chunk)
                    yield key, attempt, seq, chunk, None, None, None, None, None, None, None
                yield key, attempt, None, None, "OK", status, total, digest.hexdigest(), answer.headers.get("ETag"), answer.headers.get("Last-Modified"), None
                return
        except Refused as e:
            said, status, again = str(e), e.status, e.again
        except (ValueError, *NETWORK) as e:  # an address that is none, no such host, no connection, a cut one
            said, again = f"{type(e).__name__}: {e}", not isinstance(e, ValueError)
        if not again or attempt == limits.retries:
            yield key, attempt, None, None, "FAILED", status, None, None, None, None, said[:900]
            return
        time.sleep(min(limits.longest_wait, 2**attempt + random.random()))


def probe_one(job: dict, limits: Limits) -> tuple:
    """A row of PROBED: by HEAD, or where that is refused by a request for the first byte."""
    key, url, headers = job["key"], job["url"], _headers(job, limits)
    status, found = None, {}
    for method, more in (("HEAD", {}), ("GET", {"Range": "bytes=0-0"})):
        try:
            with _open(url, headers | more, min(45.0, limits.timeout), method) as answer:
                status, found = answer.status, answer.headers
        except (ValueError, *NETWORK):
            continue
        if status < 400:
            break
    if status is None:
        return key, url, None, False, "no answer: no such host, or no connection", None
    size, kind = declared_size(found), (found.get("Content-Type") or "").partition(";")[0].strip()
    if status >= 400:
        return key, url, status, False, explain(status, url), size
    if kind == "text/html":
        return key, url, status, False, "a web page (text/html), no file", size
    return key, url, status, True, kind or "ok", size


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _arrow(ddl: str, *without: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[t]) for n, t in (c.split() for c in ddl.split(", ")) if n not in without])


def _dealt(jobs: DataFrame, tasks: int, lanes: int) -> DataFrame:
    """Jobs with all columns of JOB, those of a host in as many tasks as it has lanes."""
    full = jobs.select(*(F.col(c).cast(t) if (c in jobs.columns) else F.lit(None).cast(t).alias(c) for c, t in (x.split(" ") for x in JOB.split(", "))))
    lane = F.pmod(F.xxhash64("key"), F.lit(lanes))
    return full.repartition(tasks, F.parse_url("url", F.lit("HOST")), lane)


def fetch(jobs: DataFrame, limits: Limits = Limits(), tasks: int = 64, lanes: int = 1) -> DataFrame:
    """Rows of FETCHED for jobs with key and url, and any other column of JOB. The jobs of a host come one after the other in each of its lanes, pause seconds apart. The rows
    must be written before anything is taken from them, as each evaluation fetches again."""
    schema = _arrow(FETCHED, "at")

    def run(batches):
        for b in batches:
            for job in b.to_pylist():
                job["headers"] = dict(job["headers"] or {})
                for row in fetch_one(job, limits):
                    yield _batch([row], schema)
                if job.get("pause"):
                    time.sleep(job["pause"])

    names = ", ".join(c for c in FETCHED.split(", ") if not c.startswith("at "))
    return _dealt(jobs, tasks, lanes).mapInArrow(run, names).withColumn("at", F.current_timestamp())


def probe(jobs: DataFrame, limits: Limits = Limits(), tasks: int = 64, lanes: int = 1) -> DataFrame:
    """Rows of PROBED for jobs as in fetch."""
    schema = _arrow(PROBED)

    def run(batches):
        for b in batches:
            for job in b.to_pylist():
                job["headers"] = dict(job["headers"] or {})
                yield _batch([probe_one(job, limits)], schema)
                if job.get("pause"):
                    time.sleep(job["pause"])

    return _dealt(jobs, tasks, lanes).mapInArrow(run, PROBED)


def results(fetched: DataFrame) -> DataFrame:
    """How each job of a written fetch ended."""
    return fetched.where("seq is null").drop("seq", "content")


def chunks(fetched: DataFrame) -> DataFrame:
    """key, seq, content of the files that came whole."""
    good = results(fetched).where("status = 'OK'").select(F.col("key").alias("gk"), F.col("attempt").alias("ga"))
    return fetched.where("seq is not null").join(good, (F.col("key") == F.col("gk")) & (F.col("attempt") == F.col("ga"))).select("key", "seq", "content")


class HostPartition(InputPartition):
    def __init__(self, jobs: list[dict]) -> None:
        super().__init__(len(jobs))
        self.jobs = jobs


class FetchSource(DataSource):
    """`spark.read.format("fetch").option("jobs", json)`: rows of FETCHED but the time, a partition for each host. The option is a JSON array of jobs,
    as a registry has them; for more jobs than the driver should hold, fetch() takes a table. Other options: timeout, retries, max_bytes, chunk, longest_wait."""

    @classmethod
    def name(cls) -> str:
        return "fetch"

    def schema(self) -> str:
        return ", ".join(c for c in FETCHED.split(", ") if not c.startswith("at "))

    def reader(self, schema) -> DataSourceReader:
        return FetchReader(self.options)


class FetchReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.jobs = json.loads(options["jobs"])
        kinds = {"timeout": float, "retries": int, "max_bytes": int, "chunk": int, "longest_wait": float}
        self.limits = Limits(**{k: kind(options[k]) for k, kind in kinds.items() if k in options})

    def partitions(self) -> list[InputPartition]:
        hosts: dict[str, list[dict]] = {}
        for job in self.jobs:
            hosts.setdefault(urllib.parse.urlsplit(job["url"]).netloc, []).append(job)
        return [HostPartition(jobs) for _, jobs in sorted(hosts.items())]

    def read(self, partition: HostPartition) -> Iterator[pa.RecordBatch]:
        schema = _arrow(FETCHED, "at")
        for job in partition.jobs:
            for row in fetch_one(job, self.limits):
                yield _batch([row], schema)


def _page(endpoint: str, prefix: str, after: str, token: str | None, most: int, timeout: float) -> tuple[list[tuple[str, int]], str | None]:
    """Keys and sizes of one page, and what to continue with."""
    asked = {"list-type": "2", "prefix": prefix, "max-keys": str(most)} | ({"continuation-token": token} if token else {"start-after": after} if after else {})
    with _open(f"{endpoint}?{urllib.parse.urlencode(asked)}", {"User-Agent": Limits.agent}, timeout) as answer:
        if answer.status >= 400:
            raise Refused(explain(answer.status, endpoint), answer.status)
        root = ElementTree.fromstring(answer.read())
    text = lambda e, name: next((x.text or "" for x in e if x.tag.rpartition("}")[2] == name), "")
    found = [(text(c, "Key"), int(text(c, "Size") or 0)) for c in root if c.tag.rpartition("}")[2] == "Contents"]
    more = text(root, "NextContinuationToken") if text(root, "IsTruncated").lower() == "true" else ""
    return [x for x in found if x[0]], more or None


def key_ranges(endpoint: str, prefix: str = "", after: str = "", ranges: int = 16, timeout: float = 120.0) -> list[tuple[str, str | None]]:
    """Ranges (after, to], the last one open, that cover all keys: their bounds are first keys found behind the prefix and each character that keys go on with, one
    character deeper while that gives too few. Each probe asks for one key."""
    first = lambda at: next(iter(_page(endpoint, prefix, at, None, 1, timeout)[0]), (None,))[0]
    heads, bounds = [prefix], []
    for _ in range(3):
        found: dict[str, str] = {}
        for head in heads:
            at = max(head, after)
            while (key := first(at)) is not None and key.startswith(head) and len(key) > len(head):
                h = key[: len(head) + 1]
                found[h] = key
                at = h + "\U0010ffff"  # behind all keys that go on so
        if not found:
            break
        bounds, heads = sorted(found.values()), sorted(found)
        if len(heads) >= ranges:
            break
    starts = [after, *bounds[1:]]
    return list(zip(starts, [*starts[1:], None], strict=True))


class RangePartition(InputPartition):
    def __init__(self, after: str, to: str | None) -> None:
        super().__init__(after)
        self.after, self.to = after, to


class ListingSource(DataSource):
    """`spark.read.format("store_listing").option("endpoint", url)`: key and size of every object, a partition for each range of keys. Options: prefix, after, ranges, page (keys
    of a page), timeout."""

    @classmethod
    def name(cls) -> str:
        return "store_listing"

    def schema(self) -> str:
        return "key string, size long"

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(self.options)


class ListingReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.endpoint, self.prefix, self.after = options["endpoint"], options.get("prefix", ""), options.get("after", "")
        self.ranges, self.page, self.timeout = int(options.get("ranges", 16)), int(options.get("page", 1000)), float(options.get("timeout", 120))

    def partitions(self) -> list[InputPartition]:
        return [RangePartition(a, b) for a, b in key_ranges(self.endpoint, self.prefix, self.after, self.ranges, self.timeout)]

    def read(self, partition: RangePartition) -> Iterator[tuple[str, int]]:
        token = None
        while True:
            found, token = _page(self.endpoint, self.prefix, partition.after, token, self.page, self.timeout)
            for key, size in found:
                if partition.to is not None and key > partition.to:
                    return
                yield key, size
            if token is None:
                return


def list_store(spark: SparkSession, endpoint: str, prefix: str = "", after: str = "", max_keys: int | None = None, ranges: int = 16, page: int = 1000) -> DataFrame:
    """key, size of a store's objects behind `after`, the first max_keys in order if given."""
    spark.dataSource.register(ListingSource)
    options = {"endpoint": endpoint, "prefix": prefix, "after": after, "ranges": str(ranges), "page": str(page)}
    found = spark.read.format("store_listing").options(**options).load()
    return found if max_keys is None else found.orderBy("key").limit(max_keys)

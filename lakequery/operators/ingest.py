"""Ingestion without a network: registry, selection, enumeration, change detection and the state log."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.functions.text import fresh

# Tiers from small to large.
TIERS = ("core", "extended", "bulk", "massive")
ADAPTERS: dict = {}


@dataclass(frozen=True)
class Dataset:
    key: str
    url: str
    tier: str = "core"


@dataclass(frozen=True)
class Source:
    source_id: str
    domain: str
    tier: str = "core"
    enabled: bool = True
    adapter: str | None = None
    options: dict = field(default_factory=dict)
    datasets: tuple[Dataset, ...] = ()


def tier_rank(tier: str) -> int:
    if tier not in TIERS:
        raise ValueError(f"unknown tier {tier}")
    return TIERS.index(tier)


def parse_registry(document: dict) -> list[Source]:
    """Sources of one registry document; ids must be unique, adapters known, and a source have datasets or an adapter."""
    out, seen = [], set()
    for s in document.get("sources", []):
        if s["id"] in seen:
            raise ValueError(f"source {s['id']} occurs twice")
        seen.add(s["id"])
        tier = s.get("tier", "core")
        tier_rank(tier)
        if s.get("adapter") and s["adapter"] not in ADAPTERS:
            raise ValueError(f"unknown adapter {s['adapter']}")
        datasets = tuple(Dataset(d["id"], d["url"], d.get("tier", tier)) for d in s.get("datasets", []))
        if not datasets and not s.get("adapter"):
            raise ValueError(f"source {s['id']} has neither datasets nor an adapter")
        out.append(Source(s["id"], document["domain"], tier, s.get("enabled", True), s.get("adapter"), s.get("options", {}), datasets))
    return out


def select_sources(sources: list[Source], domains: list[str] | None = None, ids: list[str] | None = None, ceiling: str = "core") -> list[Source]:
    """Enabled sources within the tier, of any domain pattern, and of the ids if given."""
    return [s for s in sources if s.enabled and tier_rank(s.tier) <= tier_rank(ceiling) and (not ids or s.source_id in ids) and (not domains or any(re.search(d, s.domain) for d in domains))]


def adapter(name: str):
    def keep(f):
        ADAPTERS[name] = f
        return f

    return keep


@adapter("static_expand")
def static_expand(spark: SparkSession, options: dict) -> DataFrame:
    codes = spark.createDataFrame([(c,) for c in options["codes"]], "code string")
    return codes.select(F.concat(F.lit(options.get("prefix", "")), F.col("code")).alias("key"), F.replace(F.lit(options["template"]), F.lit("{code}"), F.col("code")).alias("url"))


ADAPTERS |= {n: static_expand for n in ("faostat_domains", "census_bds")}


def endpoints(spark: SparkSession, named: dict[str, str], prefix: str, url: str) -> DataFrame:
    """(key, url, filename) of named endpoints, put into a URL at {path}."""
    rows = spark.createDataFrame(list(named.items()), "name string, path string")
    key = F.concat(F.lit(prefix), "name")
    return rows.select(key.alias("key"), F.replace(F.lit(url), F.lit("{path}"), F.col("path")).alias("url"), F.concat(key, F.lit(".csv")).alias("filename"))


@adapter("fdic_api")
def fdic(spark: SparkSession, options: dict) -> DataFrame:
    names = ("institutions", "failures", "locations", "sod")
    url = f"{options.get('base', 'https://api.fdic.gov/banks')}/{{path}}?format=csv&limit={options.get('page_size', 10000)}&offset=0"
    return endpoints(spark, options.get("endpoints") or {n: n for n in names}, "fdic_", url)


@adapter("treasury_fiscaldata")
def treasury(spark: SparkSession, options: dict) -> DataFrame:
    url = f"https://api.fiscaldata.treasury.gov/services/api/fiscal_service/{{path}}?format=csv&page[size]={options.get('page_size', 10000)}&page[number]=1"
    return endpoints(spark, options.get("endpoints") or {}, "treasury_", url)


@adapter("federal_register")
def years_by_kind(spark: SparkSession, options: dict) -> DataFrame:
    """Every year of a range with every kind."""
    kinds = F.explode(F.array(*(F.lit(k) for k in options["kinds"])))
    years = spark.range(1).select(F.explode(F.sequence(F.lit(options["first"]), F.lit(options["last"]))).alias("year")).select("year", kinds.alias("kind"))
    return years.select(F.format_string("%s_%d", "kind", "year").alias("key"), F.replace(F.replace(F.lit(options["template"]), F.lit("{year}"), F.col("year").cast("string")), F.lit("{kind}"), F.col("kind")).alias("url"))


ADAPTERS["usaspending_archive"] = years_by_kind


@adapter("s3_public")
def listed(spark: SparkSession, options: dict) -> DataFrame:
    """Objects of a store within a byte budget and a number of keys: of a listing (key, size) at hand, or of the host's own, read by ranges of keys. Suffixes
    and max_keys count before the budget. Each object may be twice as large as listed, and a MiB at least."""
    from lakequery.sources.tables import within_budget
    from lakequery.sources.web import list_store

    host = options.get("host", "openalex.s3.amazonaws.com")
    base = options.get("endpoint") or f"https://{host}/"
    most = options.get("max_keys", 2000)
    listing = options["listing"] if "listing" in options else list_store(spark, base, options.get("prefix", ""), options.get("start_after", ""), most)
    ends = options.get("suffix") or []
    ends = [ends] if isinstance(ends, str) else ends
    if ends:
        listing = listing.where(reduce(lambda a, z: a | z, (F.col("key").endswith(e) for e in ends)))
    found = within_budget(listing, options.get("max_bytes", 20 << 30)).orderBy("key").limit(most)
    return found.withColumns({"url": F.concat(F.lit(base), "key"), "max_bytes": F.greatest(F.col("size") * 2, F.lit(1 << 20))})


@adapter("worldbank_indicators")
def indicators(spark: SparkSession, options: dict) -> DataFrame:
    wanted = F.col("code").isin(*options["codes"]) if options.get("codes") else F.lit(True)
    return options["rows"].where(wanted & (F.coalesce("availability", F.lit("")) != "n")).orderBy("code").limit(options.get("limit", 1000)).select(F.col("code").alias("key"), F.replace(F.lit(options["template"]), F.lit("{code}"), F.col("code")).alias("url"))


@adapter("gdelt_window")
def trailing(spark: SparkSession, options: dict) -> DataFrame:
    """Three-field lines (size, hash, url) whose file is stamped on or after the day some days ago, of the streams wanted; the last ones by file name."""
    f = F.split(F.trim("value"), r"\s+")
    file = F.element_at(F.split(f[2], "/"), -1)
    rows = options["lines"].where(F.size(f) == 3).select(file.alias("key"), f[2].alias("url"), F.substring(file, 1, 8).alias("stamp"))
    day = F.date_format(F.lit(options["now"]).cast("timestamp") - F.make_interval(days=F.lit(options.get("lookback_days", 7))), "yyyyMMdd")
    kind = F.coalesce(*(F.when(F.contains("key", F.lit(f".{k}.")), F.lit(k)) for k in ("export", "gkg", "mentions")), F.lit("other"))
    recent = rows.where(F.col("stamp").rlike("^[0-9]+$") & (F.col("stamp") >= day)).withColumn("kind", kind).where(F.col("kind").isin(*(options.get("streams") or ["export", "gkg"])))
    return recent.orderBy(F.desc("key")).limit(options.get("max_files", 400)).orderBy("key")


@adapter("stlouisfed_fredmd")
def first_links(spark: SparkSession, options: dict) -> DataFrame:
    """The first link of each frequency in a page."""
    page = F.lit(options["html"])
    rows = [spark.range(1).select(F.lit(k).alias("key"), F.try_element_at(F.regexp_extract_all(page, F.lit(p), F.lit(1)), F.lit(1)).alias("url")) for k, p in options["patterns"].items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.where("url is not null")


@adapter("eurostat")
def toc_codes(spark: SparkSession, options: dict) -> DataFrame:
    """Codes of a tab-separated table of contents, each once, in the order of their first place, with their addresses."""
    f = F.split("value", "\t")
    cell = lambda i: F.trim(F.trim(F.try_element_at(f, F.lit(i))), F.lit('"'))
    rows = options["lines"].select("ord", cell(2).alias("key"), cell(1).alias("notes")).where(F.col("key").rlike("^[a-z0-9_]{4,40}$"))
    if p := options.get("include_regex"):
        rows = rows.where(F.col("key").rlike(p))
    first = rows.groupBy("key").agg(F.min("ord").alias("ord"), F.min_by("notes", "ord").alias("notes")).orderBy("ord").limit(options.get("limit", 1000))
    url = F.concat(F.lit("https://ec.europa.eu/eurostat/api/dissemination/sdmx/2.1/data/"), "key", F.lit("/?format=TSV&compressed=true"))
    return first.select("key", url.alias("url"), F.concat("key", F.lit(".tsv.gz")).alias("filename"), "notes")


def dataflows(documents: DataFrame) -> DataFrame:
    """(ord, agency, id, name) of the dataflows in structure messages (value), whatever their prefixes; the first name that is not empty, or
    the id. A text that is no XML has none. Such a message is one small document, so it is read by one call."""

    def parse(batches):
        local = lambda e: e.tag.rpartition("}")[2]
        for pdf in batches:
            rows = []
            for text in pdf["value"]:
                try:
                    tree = ElementTree.fromstring(text)
                except ElementTree.ParseError:
                    continue
                for e in tree.iter():
                    if local(e) == "Dataflow" and e.get("id"):
                        names = [(x.text or "").strip() for x in e if local(x) == "Name"]
                        rows.append((len(rows), e.get("agencyID", ""), e.get("id"), next(filter(None, names), e.get("id"))))
            yield pd.DataFrame(rows, columns=["ord", "agency", "id", "name"])

    return documents.select("value").mapInPandas(parse, "ord long, agency string, id string, name string")


def flows(options: dict, url: Column, most: int) -> DataFrame:
    """Dataflows whose id or name the include pattern matches and the exclude pattern does not, in their order, the first ones."""
    hit = lambda p: F.col("id").rlike(p) | F.coalesce("name", F.lit("")).rlike(p)
    df = options["flows"] if "flows" in options else dataflows(options["documents"])
    if p := options.get("include_regex"):
        df = df.where(hit(p))
    if p := options.get("exclude_regex"):
        df = df.where(~hit(p))
    return df.orderBy("ord").limit(options.get("max_datasets", most)).select(F.col("id").alias("key"), url.alias("url"), F.concat("id", F.lit(".csv")).alias("filename"), F.col("name").alias("notes"))


@adapter("sdmx_oecd")
def oecd(spark: SparkSession, options: dict) -> DataFrame:
    return flows(options, F.concat(F.lit("https://sdmx.oecd.org/public/rest/data/"), "agency", F.lit(","), "id", F.lit(f",/all?format={options.get('format', 'csvfilewithlabels')}")), 60)


@adapter("sdmx_ecb")
def ecb(spark: SparkSession, options: dict) -> DataFrame:
    return flows(options, F.concat(F.lit("https://data-api.ecb.europa.eu/service/data/"), "id", F.lit("?format=csvdata")), 40)


@adapter("external_validation")
def nothing(spark: SparkSession, options: dict) -> DataFrame:
    return spark.createDataFrame([], "key string, url string")


ADAPTERS["bigquery_public"] = nothing


def changed(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Listed keys that are new or differ in etag or time from their last good state."""
    k, e, m = fresh(listing.columns, "k", "e", "m")
    good = state.where(F.col("status").isin("OK", "UNCHANGED")).select(F.col("key").alias(k), F.col("etag").alias(e), F.col("modified").alias(m))
    j = listing.join(good, F.col("key") == F.col(k), "left")
    return j.where(~(F.col("etag").eqNullSafe(F.col(e)) & F.col("modified").eqNullSafe(F.col(m))) | (F.col(e).isNull() & F.col(m).isNull())).drop(k, e, m)


def roll_up(state: DataFrame, by: str) -> DataFrame:
    return state.groupBy(by).agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("bytes"))


def too_many_failures(probes: DataFrame, most: float = 0.35) -> bool:
    """Whether the share of failing probes is above the threshold."""
    row = probes.agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("bad")).first()
    return bool(row["n"]) and row["bad"] / row["n"] > most


def run(datasets: list[Dataset], fetch, record, deadline: float | None = None, clock=time.time) -> dict[str, int]:
    """Fetch each dataset until the deadline; a failure is recorded and never stops the others, what is left at the deadline is SKIPPED. fetch returns a status
    or (status, bytes); record gets the dataset, status and error."""
    counts: dict[str, int] = {}
    for at, d in enumerate(datasets):
        if deadline is not None and clock() > deadline:
            counts["SKIPPED"] = len(datasets) - at
            break
        try:
            got = fetch(d)
            status, error = (got[0] if isinstance(got, tuple) else got), None
            counts["bytes"] = counts.get("bytes", 0) + (got[1] if isinstance(got, tuple) else 0)
        except Exception as e:  # noqa: BLE001  isolation is the point
            status, error = "FAILED", f"{type(e).__name__}: {e}"[:900]
        record(d, status, error)
        counts[status] = counts.get(status, 0) + 1
    if not counts.get("bytes"):
        counts.pop("bytes", None)
    return counts


def jobs_of(spark: SparkSession, sources: list[Source], ceiling: str = "massive", sample: int | None = None) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(jobs, errors): source_id, domain, key and url of all datasets within the ceiling, those of adapters too, and what adapters failed with; one that fails
    stops no other. sample takes so many datasets of an adapter only, as a health check does."""
    listed, out, errors = [], None, []
    for s in sources:
        if not s.adapter:
            listed += [(s.source_id, s.domain, f"{s.source_id}/{d.key}", d.url) for d in s.datasets if tier_rank(d.tier) <= tier_rank(ceiling)]
            continue
        try:
            found = ADAPTERS[s.adapter](spark, s.options).select(F.lit(s.source_id).alias("source_id"), F.lit(s.domain).alias("domain"), F.concat(F.lit(f"{s.source_id}/"), F.col("key")).alias("key"), "url")
            found = found if sample is None else found.orderBy("key").limit(sample)
            out = found if out is None else out.union(found)
        except Exception as e:  # noqa: BLE001  isolation is the point
            errors.append((s.source_id, f"{type(e).__name__}: {e}"[:400]))
    fixed = spark.createDataFrame(listed, "source_id string, domain string, key string, url string")
    return (fixed if out is None else fixed.union(out)), errors


def health(probed: DataFrame) -> str:
    """A Markdown report of probes (web.probe): counts, then failing and reachable entries in order of their keys."""
    rows = probed.orderBy("key").collect()  # one for each entry of a registry
    good, bad = [r for r in rows if r["ok"]], [r for r in rows if not r["ok"]]
    clean = lambda x: str(x).replace("|", "/")
    lines = ["# Health of the registry", "", f"- checked: {len(rows)}", f"- reachable: {len(good)}", f"- failing: {len(bad)}", ""]
    if bad:
        lines += ["## Failing", "", "| Key | Status | Why |", "|---|---|---|", *(f"| `{r['key']}` | {r['http_status'] or '-'} | {clean(r['note'])} |" for r in bad), ""]
    lines += ["## Reachable", "", "| Key | Bytes | Kind |", "|---|---:|---|", *(f"| `{r['key']}` | {'-' if r['size'] is None else format(r['size'], ',')} | {clean(r['note'])} |" for r in good)]
    return "\n".join(lines) + "\n"


def fetch_run(spark: SparkSession, jobs: DataFrame, raw: str, state: str, limits=None, tasks: int = 64, lanes: int = 1) -> dict[str, int]:
    """One run over jobs (source_id, domain, key, url and any other column of web.JOB). What the state log has as the last good etag and time of a key goes with its request. Chunks go to
    raw/run=N; the log gets a row for each key that was tried, all at the end and in one write, so a run that breaks off leaves no state and its chunks count for nothing. Returns
    how many jobs ended in each way, and bytes."""
    from lakequery.sources import web
    from lakequery.sources.tables import latest_state, path_exists

    if path_exists(spark, state):
        last = latest_state(spark.read.schema(STATE).parquet(state), "key", "at").where(F.col("status").isin("OK", "UNCHANGED"))
        known = last.select(F.col("key").alias("known_key"), F.col("etag").alias("known_etag"), F.col("modified").alias("known_modified"))
        asked = jobs.drop("etag", "modified").join(known, F.col("key") == F.col("known_key"), "left").withColumnsRenamed({"known_etag": "etag", "known_modified": "modified"}).drop("known_key")
    else:
        asked = jobs
    run = f"{int(time.time() * 1000):015d}"
    web.fetch(asked, limits or web.Limits(), tasks, lanes).write.option("compression", "zstd").parquet(f"{raw}/run={run}")
    ended = web.results(spark.read.parquet(f"{raw}/run={run}"))
    who = jobs.select(F.col("key").alias("job_key"), "source_id", "domain", "url")
    rows = ended.where("status <> 'SKIPPED'").join(who, F.col("key") == F.col("job_key"))
    rows.select(*(F.col(c.split()[0]) for c in STATE.split(", "))).coalesce(1).write.mode("append").parquet(state)
    counts = {r["status"]: r["n"] for r in ended.groupBy("status").agg(F.count("*").alias("n")).collect()}
    total = ended.agg(F.sum("bytes")).first()[0]
    return counts | ({"bytes": total} if total else {})


def raw_files(spark: SparkSession, raw: str, state: str) -> DataFrame:
    """key, seq, content: the chunks of the last whole download of each key."""
    from lakequery.functions.rank import top_n
    from lakequery.sources import web

    whole = top_n(spark.read.schema(STATE).parquet(state).where("status = 'OK'"), ["key"], [F.desc("at")]).select(F.col("key").alias("wk"), F.col("sha256").alias("ws"))
    fetched = spark.read.parquet(raw).withColumn("run", F.col("run").cast("string"))
    ok = web.results(fetched).where("status = 'OK'").join(whole, (F.col("key") == F.col("wk")) & (F.col("sha256") == F.col("ws")))
    first = ok.groupBy(F.col("key").alias("fk")).agg(F.max(F.struct("run", "attempt")).alias("f"))  # the same bytes may have come twice
    return fetched.where("seq is not null").join(first, (F.col("key") == F.col("fk")) & (F.col("run") == F.col("f.run")) & (F.col("attempt") == F.col("f.attempt"))).select("key", "seq", "content")


def compact_state(spark: SparkSession, state: str, target: str) -> None:
    """The log with only the newest row of each key, and its newest good one where that is older, written to target."""
    from lakequery.functions.rank import top_n

    log = spark.read.schema(STATE).parquet(state)
    kind = F.when(F.col("status").isin("OK", "UNCHANGED"), 0).otherwise(1)
    top_n(log.withColumn("state_kind", kind), ["key", "state_kind"], [F.desc_nulls_last("at")]).drop("state_kind").write.parquet(target)


STATE = "key string, source_id string, domain string, url string, status string, etag string, modified string, sha256 string, bytes long, error string, at timestamp"


def append_state(spark: SparkSession, rows: list[dict], path: str) -> None:
    """Add rows to the state log, which keeps every row; sources.tables.latest_state reads the newest of each key."""
    names = [c.split()[0] for c in STATE.split(", ")]
    spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], STATE).coalesce(1).write.mode("append").parquet(path)


def domains(sources: list[Source], patterns: list[str] | None = None) -> list[str]:
    names = sorted({s.domain for s in sources})
    return [n for n in names if not patterns or any(re.search(p, n) for p in patterns)]


def plan(sources: list[Source], ceiling: str = "massive") -> list[dict]:
    """What a run would take: each source with its kind, tier and the number of its datasets within the ceiling, or its adapter."""
    within = lambda s: sum(tier_rank(d.tier) <= tier_rank(ceiling) for d in s.datasets)
    return [{"source": s.source_id, "domain": s.domain, "kind": "adapter" if s.adapter else "static", "tier": s.tier, "datasets": f"via {s.adapter}" if s.adapter else str(within(s))} for s in sources]


def status(state: DataFrame, failures: int = 20) -> dict:
    """Files and bytes held, by status and by domain, and the latest failures, of the newest row of each key."""
    from lakequery.sources.tables import latest_state

    now = latest_state(state, "key", "at")
    rows = lambda by: {r[0]: (r["files"], r["bytes"]) for r in roll_up(now, by).collect()}
    held = now.where(F.col("status").isin("OK", "UNCHANGED")).agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
    failed = now.where("status = 'FAILED'").orderBy(F.desc("at"), "key").limit(failures).select("source_id", "key", F.substring("error", 1, 150).alias("error"))
    return {"files": held["n"], "bytes": held["b"], "by_status": rows("status"), "by_domain": rows("domain"), "failures": [tuple(r) for r in failed.collect()]}

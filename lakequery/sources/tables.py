"""Readers and writers of tables and of the lake's odd files."""

from __future__ import annotations

import gzip
import io
import json
import tarfile
import uuid
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; where that is unset, a local one serves a local master alone."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file:///tmp/checkpoints/lakequery"
    return where.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def persist_table(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and read it back, so that its values hold still."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_tables(spark: SparkSession, *paths: str, base: str | None = None, lineage: bool = False) -> DataFrame:
    """Parquet files by name, union of their columns; base keeps `key=value` folders as columns, lineage adds the file name."""
    reader = spark.read.option("mergeSchema", "true")
    if base:
        reader = reader.option("basePath", base)
    df = reader.parquet(*paths)
    return df.withColumn("filename", F.col("_metadata.file_path")) if lineage else df


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Company tickers, from an object of objects or an array; cik or cik_str, title or name. ord is the place in the file."""
    raw = spark.read.text(path, wholetext=True)
    row = "struct<cik_str:string,cik:string,ticker:string,title:string,name:string>"
    listed = F.from_json("value", f"array<{row}>")
    keyed = F.map_values(F.from_json("value", f"map<string,{row}>"))
    rows = raw.select(F.posexplode(F.when(F.ltrim("value").startswith("["), listed).otherwise(keyed)).alias("ord", "r"))
    return rows.select(F.coalesce("r.cik_str", "r.cik").alias("cik"), F.upper(F.trim("r.ticker")).alias("ticker"), F.trim(F.coalesce("r.title", "r.name")).alias("name"), F.lit(None).cast("string").alias("exchange"), F.lit("company_tickers").alias("source"), "ord")


def read_exchange(spark: SparkSession, path: str) -> DataFrame:
    """Columnar JSON: fields and rows of data."""
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", "struct<fields:array<string>,data:array<array<string>>>").alias("j"))
    rows = parsed.select("j.fields", F.posexplode("j.data").alias("ord", "d")).select("ord", F.map_from_arrays("fields", "d").alias("m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    return rows.select(get("cik").alias("cik"), F.upper(F.trim(get("ticker"))).alias("ticker"), F.trim(get("name")).alias("name"), get("exchange").alias("exchange"), F.lit("company_tickers_exchange").alias("source"), "ord")


def numbered_lines(spark: SparkSession, path: str, charset: str = "UTF-8") -> DataFrame:
    """(line, value) of a text file, or of a folder's files in the order of their names: lines end in \\n or \\r\\n and are numbered from 0 over all files.
    A file may be of any size: its blocks are read by tasks of their own, and a row for each block tells how many lines come before it."""
    block = ("_metadata.file_path", "_metadata.file_block_start")
    raw = spark.read.option("lineSep", "\n").text(path).select("value", *(F.col(c).alias(n) for c, n in zip(block, ("path", "start"), strict=True)), F.monotonically_increasing_id().alias("id"))
    blocks = raw.groupBy(F.col("path").alias("p"), F.col("start").alias("s")).agg(F.count("*").alias("n"), F.min("id").alias("first"))  # ids rise by one within a block
    before = F.coalesce(F.sum("n").over(Window.orderBy("p", "s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = raw.join(F.broadcast(blocks.select("p", "s", (before - F.col("first")).alias("shift"))), (F.col("path") == F.col("p")) & (F.col("start") == F.col("s")))
    return rows.select((F.col("id") + F.col("shift")).alias("line"), F.regexp_replace(F.decode(F.col("value").cast("binary"), charset), r"\r\z", "").alias("value"))


def read_filing_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Pipe-delimited filing indexes with a preamble, in ISO-8859-1; file and line numbers are kept, as ties go to the first line. A path is a file or a folder of one index's parts."""
    out = None
    for k, path in enumerate(paths):
        part = numbered_lines(spark, path, "ISO-8859-1").withColumn("file", F.lit(k))
        out = part if out is None else out.union(part)
    f = F.split("value", r"\|", -1)
    rows = out.where(F.size(f) == 5).select("file", "line", *(F.trim(f[i]).alias(c) for i, c in enumerate(("cik", "company_name", "form", "date", "filename"))))
    return rows.withColumn("filing_date", F.try_to_date("date", "yyyy-MM-dd")).where("filing_date is not null").drop("date")


def read_adjudications(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("multiLine", "true").json(path)
    return raw.select("policy", F.explode("items").alias("i")).select("policy", "i.*")


def read_zip_json(spark: SparkSession, path: str, schema: str = "member string, body string") -> DataFrame:
    """Members of ZIP archives as text, one archive a row of binaryFile."""

    def unzip(batches):
        for pdf in batches:
            rows = [(m, z.read(m).decode("utf-8", "replace")) for content in pdf["content"] for z in [zipfile.ZipFile(io.BytesIO(content))] for m in z.namelist()]
            yield pd.DataFrame(rows, columns=["member", "body"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(unzip, schema)


# Fields of a submission header and of its addresses, with their column names.
HEADER = {
    "name": "sec_entity_name", "entityType": "entity_type", "sic": "sic", "sicDescription": "sic_description", "ownerOrg": "owner_org", "ein": "ein", "lei": "lei", "description": "description", "website": "website",
    "investorWebsite": "investor_website", "category": "category", "fiscalYearEnd": "fiscal_year_end", "stateOfIncorporation": "state_of_incorporation", "stateOfIncorporationDescription": "state_of_incorporation_description", "phone": "phone",
}
ADDRESS = {
    "street1": "street1", "street2": "street2", "city": "city", "stateOrCountry": "state_or_country", "zipCode": "zip_code", "stateOrCountryDescription": "state_or_country_description",
    "isForeignLocation": "is_foreign_location", "foreignStateTerritory": "foreign_state_territory", "country": "country",
}


def issuer_metadata(members: DataFrame, companies: DataFrame) -> DataFrame:
    """The 38 columns of the companies that an archive of submissions has: master, header, both addresses flattened. No company at all, one
    twice, or one without a key is an error."""
    from lakequery.operators.resolve import pick

    address = "struct<" + ",".join(f"{k}:{'boolean' if k == 'isForeignLocation' else 'string'}" for k in ADDRESS) + ">"
    schema = f"struct<{','.join(f'{k}:string' for k in HEADER)},addresses:struct<business:{address},mailing:{address}>>"
    parsed = members.where(F.col("member").rlike("(^|/)CIK[0-9]{10}\\.json$")).select(F.regexp_extract("member", "CIK([0-9]{10})", 1).alias("member_cik"), F.from_json("body", schema).alias("j"))
    known = pick(companies, {c: (c,) for c in ("canonical_company_id", "cik", "company_name", "primary_ticker", "source_class")})
    flat = [F.col(f"j.{k}").alias(v) for k, v in HEADER.items()] + [F.col(f"j.addresses.{kind}.{k}").alias(f"{kind}_{v}") for kind in ("business", "mailing") for k, v in ADDRESS.items()]
    out = known.join(parsed, F.col("cik") == F.col("member_cik")).select(*known.columns, *flat)
    row = out.agg(F.count("*").alias("n"), F.countDistinct("canonical_company_id").alias("d"), F.count_if((F.coalesce("canonical_company_id", F.lit("")) == "") | (F.coalesce("cik", F.lit("")) == "")).alias("none")).first()
    if not row["n"] or row["n"] != row["d"] or row["none"]:
        raise ValueError(f"issuer metadata: {row['n']} rows, {row['d']} companies, {row['none']} without a key")
    return out


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files of a remote inventory, a JSON list of Path, Size and IsDir."""
    return spark.read.schema("Path string, Name string, Size long, ModTime string, IsDir boolean").option("multiLine", "true").json(path).where(~F.coalesce("IsDir", F.lit(False)))


def read_listing(spark: SparkSession, paths: list[str], prefix: str = "", start_after: str = "", max_keys: int = 5000) -> DataFrame:
    """(key, size) of saved pages of an object store's XML listing, by key, after start_after and max_keys at most; a missing size is 0."""
    pages = spark.read.text(paths, wholetext=True)
    tag = lambda name: F.regexp_extract_all("c", F.lit(rf"<(?:\w+:)?{name}>([^<]*)</"), F.lit(1))
    each = pages.select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<(?:\w+:)?Contents>(.*?)</(?:\w+:)?Contents>"), F.lit(1))).alias("c"))
    found = each.select(F.try_element_at(tag("Key"), F.lit(1)).alias("key"), F.coalesce(F.try_element_at(tag("Size"), F.lit(1)).try_cast("long"), F.lit(0)).alias("size"))
    for mark, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        found = found.withColumn("key", F.replace("key", F.lit(mark), F.lit(char)))
    return found.where((F.col("key") != "") & F.startswith("key", F.lit(prefix)) & (F.col("key") > start_after)).orderBy("key").limit(max_keys)


def list_folder(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, size, modified) of the files below a folder that Spark can reach; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where(F.col("path").endswith(suffix)).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def shard_of_rank(listing: DataFrame, key: str, shard: int, shards: int) -> DataFrame:
    """Every shards-th row of a listing in the order of its keys, from the shard's number on."""
    from lakequery.functions.rank import global_rank

    return global_rank(listing, [F.asc(key)], "_rank").where(F.pmod(F.col("_rank") - 1, F.lit(shards)) == shard).drop("_rank")


def read_counts(spark: SparkSession, path: str, skip: int = 0, sep: str = "\t") -> DataFrame:
    """A table of counts, plain or gzipped: lines after the first ones as (line, id, values)."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", "\r?\n$", ""), "\r?\n")).alias("line", "value")).where(F.col("line") >= skip)
    cells = F.transform(F.split("value", sep), lambda x: F.trim(x, F.lit('"')))
    return lines.select("line", cells.alias("c")).select("line", F.col("c")[0].alias("id"), F.slice("c", F.lit(2), F.size("c")).alias("values"))


def read_tar_text(spark: SparkSession, path: str) -> DataFrame:
    """(member, body) of the files in TAR archives, gzipped members unpacked; one archive a row of binaryFile."""

    def untar(batches):
        for pdf in batches:
            rows = []
            for content in pdf["content"]:
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    for m in t.getmembers():
                        if m.isfile():
                            body = t.extractfile(m).read()
                            rows.append((m.name, (gzip.decompress(body) if m.name.endswith(".gz") else body).decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["member", "body"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(untar, "member string, body string")


def read_series_matrix(spark: SparkSession, path: str, begin: str = "!series_matrix_table_begin", end: str = "!series_matrix_table_end") -> DataFrame:
    """Tab-separated lines between two marker lines, with their line numbers."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", "\r?\n").alias("ls"))
    lines = lines.select(F.array_position("ls", begin).cast("int").alias("a"), F.array_position("ls", end).cast("int").alias("b"), "ls")
    return lines.select(F.posexplode(F.slice("ls", F.col("a") + 1, F.col("b") - F.col("a") - 1)).alias("line", "value")).select("line", F.transform(F.split("value", "\t"), lambda x: F.trim(x, F.lit('"'))).alias("cells"))


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def within_budget(listing: DataFrame, budget: int, suffix: str = "", key: str = "key", size: str = "size") -> DataFrame:
    """Keys in order until their sizes add up to more than the budget; the suffix counts before. Sizes are not negative."""
    from lakequery.functions.rank import running

    fits = listing.where(F.col(key).endswith(suffix)) if suffix else listing
    return running(fits, [F.asc(key)], F.col(size), "running").where(F.col("running") <= budget)


def scan_guard(df: DataFrame, most_bytes: int) -> DataFrame:
    """Refuse a plan whose estimated input is larger."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > most_bytes:
        raise ValueError(f"the scan would read about {size} bytes; the limit is {most_bytes}")
    return df


def patents(df: DataFrame, columns: list[str], country: str, year: int | None = None) -> DataFrame:
    """Explicit columns of one country, publication dates as integers within a year, all by named parameters of a statement."""
    names = ", ".join(f"`{c}`" for c in columns)
    dates = " AND publication_date BETWEEN :first AND :last" if year else ""
    args = {"country": country} | ({"first": year * 10000 + 101, "last": year * 10000 + 1231} if year else {})
    return df.sparkSession.sql(f"SELECT {names} FROM {{df}} WHERE country_code = :country{dates}", args=args, df=df)


def like_between(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows whose text starts and ends with two pieces, one wildcard between; wildcards inside the pieces are plain characters."""
    plain = lambda x: x.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_")
    return df.where(F.col(column).like(f"{plain(start)}%{plain(end)}"))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, refuse_empty: bool = False) -> None:
    if refuse_empty and df.isEmpty():
        raise ValueError("no rows to write")
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.option("header", "true").csv(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """One file of one JSON array, an element a line, in the order of df; its rows pass through one task, which can spill. A null stays a null."""
    rows = df.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}).alias("value"), F.monotonically_increasing_id().alias("o"))
    end = df.sparkSession.range(0, 1, 1, 1).select(F.lit(None).cast("string").alias("value"), F.lit(2**63 - 1).alias("o"))
    # tasks are merged in any order, so by number again; only the end has no value
    one = rows.union(end).coalesce(1).sortWithinPartitions("o").select("value", (F.monotonically_increasing_id() == 0).alias("first"))
    mark = F.when(F.col("value").isNull(), F.when(F.col("first"), "[]").otherwise("]")).otherwise(F.concat(F.when(F.col("first"), "[").otherwise(","), "value"))
    one.select(mark.alias("value")).write.text(path)


def read_in_order(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of Parquet files with their place, from 0, over all files in the order of the files' names; Spark itself reads files in any order."""
    df = spark.read.parquet(path)
    rows = df.select("*", F.col("_metadata.file_path").alias(f"{name}_file"), F.col("_metadata.row_index").alias(f"{name}_row"))
    ends = rows.groupBy(F.col(f"{name}_file").alias(f"{name}_of")).agg(F.count("*").alias(f"{name}_n"))  # a row for each file
    before = ends.withColumn(f"{name}_before", F.coalesce(F.sum(f"{name}_n").over(Window.orderBy(f"{name}_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    both = rows.join(before, F.col(f"{name}_file") == F.col(f"{name}_of"))
    return both.select(*df.columns, (F.col(f"{name}_before") + F.col(f"{name}_row")).alias(name))


def write_text(df: DataFrame, path: str, column: str = "text") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def write_csv_signed(df: DataFrame, path: str) -> None:
    """One CSV file that opens with the UTF-8 signature, for spreadsheets."""
    first, *rest = df.columns
    df.coalesce(1).select(F.col(f"`{first}`").alias("\ufeff" + first), *(F.col(f"`{c}`") for c in rest)).write.option("header", "true").csv(path)


def shard_name(path: Column) -> Column:
    """File name of a shard: sixteen hexadecimal digits of the path's SHA-256."""
    return F.concat(F.substring(F.sha2(path.cast("binary"), 256), 1, 16), F.lit(".parquet"))


def json_array(df: DataFrame) -> DataFrame:
    """A small result as one JSON array."""
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))


def manifest(df: DataFrame, counts: dict[str, str]) -> str:
    """Sorted JSON of aggregates of df, from one row."""
    row = df.agg(*(F.expr(e).alias(k) for k, e in counts.items())).first().asDict()
    return json.dumps(row, sort_keys=True, default=str)


def markdown(df: DataFrame, title: str, limit: int = 100) -> str:
    """A report table of the first rows."""
    rows = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(rows + ["| " + " | ".join(str(x) for x in r) + " |" for r in df.limit(limit).collect()])


def latest_state(log: DataFrame, key: str, at: str) -> DataFrame:
    """The state of an append-only log: the newest row of each key."""
    from lakequery.functions.rank import top_n

    return top_n(log, [key], [F.desc_nulls_last(at)])

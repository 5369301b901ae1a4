"""A catalog of views with parameterised table functions, and a read-only query runner."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakequery.sources.tables import write_json_array

#: A column of a table goes before a parameter of the same name, so this is none that a table has; a qualified name would be taken for a field of a column.
PARAMETER = "lookup_value_"
# The names of the catalog's tables.
MASTERS = ("WORK_MASTER", "AUTHOR_MASTER", "INSTITUTION_MASTER", "SOURCE_MASTER", "TOPIC_MASTER")


def _with(edges: str, master: str, on: str, by: str) -> str:
    """Edges of a key with what a master says of their other end; the master's own id is left out, and an edge without a master row stays."""
    return f"SELECT e.*, m.* EXCEPT (id) FROM {edges} e LEFT JOIN {master} m ON m.id = e.{on} WHERE e.{by} = key"


_AUTHORS, _PLACES = {"WORK_AUTHOR_EDGES": {"work_id", "author_id"}}, {"AUTHOR_INSTITUTION_EDGES": {"work_id", "institution_id"}}
#: Table functions: name, tables and columns needed, and the query.
FUNCTIONS: dict[str, tuple[dict[str, set[str]], str]] = {
    **{t.removesuffix("_MASTER").lower(): ({t: {"id"}}, f"SELECT * FROM {t} WHERE id = key") for t in MASTERS},
    "work_topics": ({"WORK_TOPIC_EDGES": {"work_id", "topic_id"}, "TOPIC_MASTER": {"id"}}, _with("WORK_TOPIC_EDGES", "TOPIC_MASTER", "topic_id", "work_id")),
    "work_authors": ({**_AUTHORS, "AUTHOR_MASTER": {"id"}}, _with("WORK_AUTHOR_EDGES", "AUTHOR_MASTER", "author_id", "work_id")),
    "author_works": ({**_AUTHORS, "WORK_MASTER": {"id"}}, _with("WORK_AUTHOR_EDGES", "WORK_MASTER", "work_id", "author_id")),
    "coauthors": (
        {**_AUTHORS, "WORK_MASTER": {"id"}},
        "SELECT other.author_id AS coauthor_id, count(DISTINCT mine.work_id) AS shared_work_count FROM WORK_AUTHOR_EDGES mine JOIN WORK_AUTHOR_EDGES other USING (work_id) WHERE mine.author_id = key AND other.author_id <> mine.author_id GROUP BY 1 ORDER BY 2 DESC, 1",
    ),
    "institution_works": ({**_PLACES, "WORK_MASTER": {"id"}}, _with("AUTHOR_INSTITUTION_EDGES", "WORK_MASTER", "work_id", "institution_id")),
    "country_collaborations": (
        {"COUNTRY_COLLAB_EDGES": {"work_id", "country_a", "country_b", "_source_key"}},
        "SELECT work_id, country_a, country_b, if(country_a = key, country_b, country_a) AS partner_country, _source_key FROM COUNTRY_COLLAB_EDGES WHERE country_a = key OR country_b = key",
    ),
    "references_from": ({"CITATION_EDGES": {"work_id", "referenced_work_id"}}, "SELECT * FROM CITATION_EDGES WHERE work_id = key"),
    "citations_to": ({"CITATION_EDGES": {"work_id", "referenced_work_id"}}, "SELECT * FROM CITATION_EDGES WHERE referenced_work_id = key"),
}


def build_catalog(spark: SparkSession, tables: dict[str, DataFrame], required: tuple[str, ...] = ()) -> dict:
    """Temporary views of the tables, views lake_catalog, lake_columns and table_counts, and the table functions whose tables and columns are there."""
    if not tables:
        raise ValueError("no table is staged")
    if lost := sorted(set(required) - set(tables)):
        raise ValueError(f"required tables are missing: {', '.join(lost)}")
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    counts = catalog_of(spark, tables)
    counts.createOrReplaceTempView("lake_catalog")
    counts.select(F.col("name").alias("table_name"), F.when(F.col("name").endswith("_MASTER"), "master").otherwise("edge").alias("table_kind"), F.col("n_rows").alias("row_count"), F.col("n_columns").alias("column_count")).createOrReplaceTempView("table_counts")
    columns_of(spark, tables).createOrReplaceTempView("lake_columns")
    made = _functions(spark, tables, "TEMPORARY")
    return {"tables": sorted(tables), "functions": made}


def persist_catalog(spark: SparkSession, paths: dict[str, str], database: str, required: tuple[str, ...] = ()) -> dict:
    """The catalog as a database that outlives the session: tables over Parquet folders, tables `catalog` and `columns`, the view
    `table_counts`, and the table functions whose tables and columns are there. Whatever of that name was there is replaced. Spark calls table functions by their bare name, so with the
    database as the current one."""
    if lost := sorted(set(required) - set(paths)):
        raise ValueError(f"required tables are missing: {', '.join(lost)}")
    if unknown := sorted(n for n in paths if n not in MASTERS and not n.endswith("_EDGES")):
        raise ValueError(f"unknown tables: {', '.join(unknown)}")
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.catalog.setCurrentDatabase(database)
    try:
        rows, listed = None, []
        for name, path in sorted(paths.items()):
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            spark.sql(f"CREATE TABLE `{name}` USING parquet LOCATION '{path}'")
            df = spark.table(name)
            listed += [(name, i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema, 1)]
            kind = "master" if name in MASTERS else "edge"
            row = df.agg(F.count("*").alias("row_count"), F.countDistinct("_metadata.file_path").alias("source_file_count"))
            row = row.select(F.lit(name).alias("table_name"), F.lit(kind).alias("table_kind"), F.lit(path).alias("location"), "*", F.lit(len(df.columns)).alias("column_count"), F.current_timestamp().alias("created_at"))
            rows = row if rows is None else rows.union(row)
        for name, df in (("catalog", rows), ("columns", spark.createDataFrame(listed, "table_name string, ordinal_position int, column_name string, column_type string, nullable boolean"))):
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            df.write.mode("overwrite").saveAsTable(name)
        spark.sql("CREATE OR REPLACE VIEW table_counts AS SELECT table_name, table_kind, row_count, source_file_count, column_count FROM catalog ORDER BY table_kind, table_name")
        made = _functions(spark, {n: spark.table(n) for n in paths}, "")
    finally:
        spark.catalog.setCurrentDatabase(before)
    return {"tables": sorted(paths), "functions": made}


def _functions(spark: SparkSession, tables: dict[str, DataFrame], kind: str) -> list[str]:
    """Create the table functions whose tables and columns are there."""
    made = []
    for name, (needs, sql) in FUNCTIONS.items():
        if all(t in tables and cols <= set(tables[t].columns) for t, cols in needs.items()):
            schema = spark.sql(sql.replace("= key", "= ''")).schema
            returns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"CREATE OR REPLACE {kind} FUNCTION {name}({PARAMETER} STRING) RETURNS TABLE({returns}) RETURN {sql.replace('= key', f'= {PARAMETER}')}")
            made.append(name)
    return made


def catalog_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """name, n_rows, n_columns of each table: one count each, as one plan."""
    out = None
    for name, df in sorted(tables.items()):
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"))
        out = row if out is None else out.union(row)
    return out


def columns_of(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [(n, i, f.name, f.dataType.simpleString(), f.nullable) for n, df in sorted(tables.items()) for i, f in enumerate(df.schema)]
    return spark.createDataFrame(rows, "table_name string, ordinal long, column_name string, type string, nullable boolean")


def _nodes(plan):
    """Every node of a parsed plan: children, bodies of common table expressions, and subqueries in expressions."""
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        for more in (node.children(), node.innerChildren(), node.subqueries()):
            todo += [x for x in (more.apply(i) for i in range(more.size())) if x.getClass().getName().startswith("org.apache.spark.sql.") and hasattr(x, "children")]


def read_only(spark: SparkSession, sql: str) -> DataFrame:
    """The DataFrame of a query that starts with SELECT or WITH. Any command or other statement anywhere in its parsed plan refuses it: an insertion can stand
    behind common table expressions, or several in one statement."""
    text = sql.strip().rstrip(";").strip()
    if not text:
        raise ValueError("the query is empty")
    if text.split(None, 1)[0].lower() not in ("select", "with"):
        raise ValueError("only SELECT and WITH are allowed")
    logical = "org.apache.spark.sql.catalyst.plans.logical"
    kinds = [spark._jvm.java.lang.Class.forName(f"{logical}.{k}") for k in ("Command", "ParsedStatement")]
    for node in _nodes(spark._jsparkSession.sessionState().sqlParser().parsePlan(text)):
        if any(k.isInstance(node) for k in kinds):
            raise ValueError(f"only queries are allowed, not {node.nodeName()}")
    return spark.sql(text)


#: Files up to this size are read whole by tasks; larger ones are streamed.
WHOLE_FILE = 256 * 1024**2


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, sha256) of the part files of a folder, in the order of their names. Tasks read files of bounded size; larger ones, such as one JSON array,
    are streamed by the driver's JVM and never held."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    small = files.where(F.col("length") <= WHOLE_FILE).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    large = []
    for r in files.where(F.col("length") > WHOLE_FILE).select("path", "length").collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        stream = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(path)
        try:
            large.append((r["path"], r["length"], spark._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)))
        finally:
            stream.close()
    return small.union(spark.createDataFrame(large, "path string, size long, sha256 string")).orderBy("path")


def execute_query(spark: SparkSession, sql: str, output: str, fmt: str = "parquet") -> dict:
    """Run once, write, and tell rows, columns and digests: of each file in the order of the names, and of the query. The query's order is kept: files follow each
    other by name, and rows within each. JSON is one file of one array."""
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown format {fmt}")
    df = read_only(spark, sql)
    columns = df.columns
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("n"))
    if fmt == "parquet":
        df.write.option("compression", "zstd").parquet(output)
    elif fmt == "csv":
        df.write.option("header", "true").csv(output)
    else:
        write_json_array(df, output)
    digests = [r["sha256"] for r in file_digests(spark, output).collect()]  # one for each file
    query = sql.strip().rstrip(";").strip()
    return {"rows": seen.get["n"], "columns": columns, "format": fmt, "file_sha256": digests, "output_sha256": hashlib.sha256("".join(digests).encode()).hexdigest(), "query_sha256": hashlib.sha256(query.encode()).hexdigest()}

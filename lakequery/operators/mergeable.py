"""Year marts from partials that may overlap or repeat: exact distinct works and sums, however often a file comes.

A partial says for each year and key which works it has, by their numbers, and what each of them adds. Numbers go in buckets of 32,768. A bucket with few works
lists them; one with many holds bitmaps: one of its works, and one for each binary digit of what they add, in which a work's bit is that digit. A work
adds the same wherever it comes, so lists are united and bitmaps or-ed, and a work that came before changes nothing. A sum is the
bitmaps' counts times two to the power of their digit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.functions.text import ratio
from lakequery.operators.marts import DIMS, edge_sets, works_of

#: Works from which bitmaps are smaller than a list.
DENSE = 1024
#: Parts of one that a score is rounded to.
SCORE_UNIT = 1_000_000
WORKS = -1
MEASURES = ("cites", "score")


def work_number(work_id: Column) -> Column:
    """The number at the end of a work's id; null without one. Ids must differ in it."""
    return F.regexp_extract(work_id.cast("string"), r"(\d+)$", 1).try_cast("long")


def _planes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, bucket, plane, bits of rows with a place p and a value v: the works, and each digit that any value has."""
    digits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda i: F.getbit("v", i) == 1)
    each = rows.select(*keys, "bucket", "p", F.explode(F.concat(F.array(F.lit(WORKS)), digits)).alias("plane"))
    return each.groupBy(*keys, "bucket", "plane").agg(F.bitmap_construct_agg("p").alias("bits"))


def containers(rows: DataFrame, keys: list[str], measures: tuple[str, ...], dense: int = DENSE) -> DataFrame:
    """keys, measure, bucket, works (a list of p and v), plane, bits of rows with keys, number and a column for each measure. Of rows with the same keys and number the
    largest values hold; values are not negative. All is dealt once, by keys and bucket, with all measures in a row, and no bucket has more than 32,768 works."""
    value = lambda m: F.when(F.col(m) < 0, F.raise_error(F.lit("a value is negative"))).otherwise(F.col(m)).cast("long").alias(m)
    d = rows.select(*keys, F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").cast("int").alias("p"), *map(value, measures)).repartition(*keys, "bucket")
    d = d.groupBy(*keys, "bucket", "p").agg(*(F.max(m).alias(m) for m in measures)).withColumn("n", F.count("*").over(W.partitionBy(*keys, "bucket")))
    each = lambda df, name: df.select("*", F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias(name)) for m in measures))).alias("m"))
    lists = d.where(F.col("n") < dense).groupBy(*keys, "bucket").agg(*(F.sort_array(F.collect_list(F.struct("p", F.col(m).alias("v")))).alias(m) for m in measures))
    none = F.lit(None)
    few = each(lists, "works").select(*keys, "m.measure", "bucket", "m.works", none.cast("int").alias("plane"), none.cast("binary").alias("bits"))
    many = _planes(each(d.where(F.col("n") >= dense), "v").select(*keys, "m.measure", "bucket", "p", "m.v"), [*keys, "measure"])
    return few.union(many.select(*keys, "measure", "bucket", none.cast("array<struct<p:int,v:bigint>>"), "plane", "bits"))


def united(partials: DataFrame, keys: list[str], measures: tuple[str, ...]) -> DataFrame:
    """keys, and n (distinct works) and total of each measure, of containers of any number of partials. Lists that meet bitmaps become bitmaps first. Keys
    and bucket alone deal the rows until the last sums, as they have dealt the containers."""
    at = [*keys, "bucket"]
    full = partials.where("bits is not null")
    listed = partials.where("bits is null").select(*at, "measure", F.explode("works").alias("w")).groupBy(*at, "measure", "w.p").agg(F.max("w.v").alias("v"))
    have = full.select(*at).distinct()
    loose = listed.join(have, at, "left_anti").select(*keys, "measure", F.lit(1).cast("long").alias("n"), F.col("v").alias("total"))
    bits = full.select(*keys, "measure", "bucket", "plane", "bits").union(_planes(listed.join(have, at, "left_semi"), [*keys, "measure"]))
    bits = bits.groupBy(*at, "measure", "plane").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("c"))
    is_works, zero = F.col("plane") == WORKS, F.lit(0).cast("long")
    dense = bits.select(*keys, "measure", F.when(is_works, F.col("c")).otherwise(zero), F.when(is_works, zero).otherwise(F.col("c") * F.expr("shiftleft(1L, plane)")))
    sums = [F.sum(F.when(F.col("measure") == m, F.col(c))).cast("long").alias(f"{m}_{c}") for m in measures for c in ("n", "total")]
    return loose.union(dense).groupBy(*keys).agg(*sums)


def mart_partials(master: DataFrame, topics: DataFrame | None = None, institutions: DataFrame | None = None, collaboration: DataFrame | None = None, file: str | None = None, number: Callable[[Column], Column] = work_number, dense: int = DENSE, dealt: bool = False) -> dict[str, DataFrame]:
    """Partials of the marts for which there are tables. A work may come in several files, then with all its edges in each: `file` names the column of master and
    edges that keeps the files apart. Scores are rounded to millionths. A work's citations must be the same in all partials; where they
    are not, lists take the largest, and bitmaps mix them. Works whose id ends in no digit are an error. Edges meet works, and files each other, where the work lies; dealt says that the tables are dealt by work."""
    tag = [file] if file else []
    n = F.coalesce(number(F.col("id")).cast("long"), F.raise_error(F.concat(F.lit("no number in "), F.col("id").cast("string"))).cast("long"), F.lit(0).cast("long"))  # never null, so that no branch of a plan filters it and all share their exchanges
    w = works_of(master, *tag).withColumn("number", n)
    year = ["publication_year"]
    out = {"WORK_YEAR_METRICS": containers(w.select(*year, "number", "cites"), year, MEASURES[:1], dense)}
    wf = w.withColumnRenamed(file, "w_file") if file else w
    for name, edges in edge_sets(topics, institutions, collaboration, dealt=dealt, extra=tuple(tag)).items():
        on = edges["work_id"] == wf["id"]
        if file:
            on &= edges[file].between(wf["w_file"], wf["w_file"])  # equal, but the work alone deals the rows
        keys = [*year, *DIMS[name]]
        held = [m for m in MEASURES if m == MEASURES[0] or m in edges.columns]
        each = edges.join(wf, on).groupBy(*tag, "id", "number", *keys).agg(*(F.sum(m).alias(m) for m in held))
        if "score" in held:
            each = each.withColumn("score", F.round(F.col("score") * SCORE_UNIT).cast("long"))
        if file:
            each = each.groupBy("id", "number", *keys).agg(*(F.max(m).alias(m) for m in held))
        out[name] = containers(each.select(*keys, "number", *held), keys, tuple(held), dense)
    return out


def merge_marts(partials: DataFrame, name: str) -> DataFrame:
    """The mart of a name from its partials of all files."""
    keys = ["publication_year", *DIMS[name]]
    sums = [F.col("cites_n").alias("work_count"), F.col("cites_total").alias("citation_sum")]
    if name == "WORK_YEAR_TOPIC":
        sums.append((F.col("score_total") / SCORE_UNIT).alias("topic_score_sum"))
    return united(partials, keys, MEASURES).select(*keys, *sums).withColumn("mean_citations", ratio(F.col("citation_sum"), F.col("work_count")))


def paired_edges(spark: SparkSession, root: str, files: list[str], file: str) -> dict[str, DataFrame]:
    """Edges that lie beside the works' files, under the same names below the folders of their tables; a table without any of them is left out."""
    names = {"topics": "WORK_TOPIC_EDGES", "institutions": "AUTHOR_INSTITUTION_EDGES", "collaboration": "COUNTRY_COLLAB_EDGES"}
    out, hadoop = {}, spark._jsparkSession.sessionState().newHadoopConf()
    for kind, folder in names.items():
        paths = [f"{root}/{folder}/{f}" for f in files]
        there = [p for p in paths if (x := spark._jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(hadoop).exists(x)]
        if there:
            df = spark.read.option("mergeSchema", "true").parquet(*there)
            out[kind] = df.withColumn(file, F.substring_index("_metadata.file_path", f"/{folder}/", -1))
    return out

"""Tables stored in buckets of a key, so that joins by it move no rows, and shard-wise writing that can be resumed."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.sources.tables import shard_name


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def store_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write df below path as a table in buckets of the key, one file a bucket, sorted by the key, and a description beside it for attach_bucketed. Two tables of as many buckets
    join by their keys without an exchange, if the keys have the same type; what is then grouped by the key needs none either. A row without a key goes to a bucket too."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    dealt = df.repartition(buckets, key)  # by the hash that buckets have, so each task writes one file
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", "zstd").mode("overwrite").format("parquet").saveAsTable(table)
    spec = json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()})
    spark.range(1).select(F.lit(spec).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.spec")
    return spark.table(table)


def attach_bucketed(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The table of an earlier session at path, with its buckets."""
    spec = json.loads(spark.read.text(f"{path.rstrip('/')}.spec", wholetext=True).first()[0])
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec["schema"]))
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{spec['key']}`) SORTED BY (`{spec['key']}`) INTO {spec['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def batch_of(rank: Column, batches: int) -> Column:
    """The folder of a shard by its place, from 0, in the sorted list of shards."""
    return F.concat(F.lit("batch="), F.lpad(F.pmod(rank, F.lit(batches)).cast("string"), 3, "0"))


def shards(df: DataFrame, path_column: str, batches: int) -> DataFrame:
    """(relpath, target) of the shards that df has rows of: batch=NNN/<sixteen hexadecimal digits>.parquet, dealt to batches by their rank among all paths."""
    from lakequery.functions.rank import global_rank

    listed = global_rank(df.select(F.col(path_column).alias("relpath")).where("relpath is not null").distinct(), [F.asc("relpath")], "place")
    return listed.select("relpath", F.concat_ws("/", batch_of(F.col("place") - 1, batches), shard_name(F.col("relpath"))).alias("target"))


def write_shards(df: DataFrame, root: str, path_column: str, batches: int, only: DataFrame | None = None) -> int:
    """Write each shard's rows, without path_column, as one file root/batch=NNN/<sha16>.parquet, and tell how many were written. A shard whose file is there already is not
    written again, and its rows are not dealt, so a call that was cut short is made good by the next one. Files appear whole: they are written
    aside and renamed. `only` (relpath, target) gives the shards, if they are known. Rows without a path are an error."""
    spark = df.sparkSession
    if not df.where(F.col(path_column).isNull()).isEmpty():
        raise ValueError(f"rows without {path_column}")
    known = shards(df, path_column, batches) if only is None else only
    open_ = known.join(written_shards(spark, root), "target", "left_anti").withColumnRenamed("relpath", "shard_path")
    aside = f"{root.rstrip('/')}/_writing"
    part = df.join(open_, df[path_column] == open_["shard_path"]).drop("shard_path", path_column)
    # one file for each shard, as it is the unit of resuming
    part.repartition("target").write.mode("overwrite").option("compression", "zstd").partitionBy("target").parquet(aside)
    folder, fs = _fs(spark, aside)
    moved = 0
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith("target="):
            continue
        target = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name.removeprefix("target="))
        (file,) = [x.getPath() for x in fs.listStatus(status.getPath()) if x.getPath().getName().startswith("part-")]
        to = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{target}")
        fs.mkdirs(to.getParent())
        moved += bool(fs.rename(file, to))
    fs.delete(folder, True)
    return moved


def written_shards(spark: SparkSession, root: str) -> DataFrame:
    """(target) of the shard files below root; none where the folder does not exist yet."""
    folder, fs = _fs(spark, root)
    if not fs.exists(folder) or not fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/batch=*")):
        return spark.createDataFrame([], "target string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{root.rstrip('/')}/batch=*")
    return files.select(F.regexp_extract("path", r"(batch=[0-9]+/[^/]+)$", 1).alias("target"))

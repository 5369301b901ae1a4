"""Incremental refresh by Structured Streaming: each file once, partials appended, marts re-aggregated from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.operators.mergeable import mart_partials, merge_marts, paired_edges


def refresh(spark: SparkSession, source: str, schema: T.StructType, partials: str, checkpoint: str, partial, timeout: int | None = None, files_per_trigger: int = 1000) -> bool:
    """Process files of source that no earlier call has; partial maps a batch to its partial aggregate. A batch's partial goes to a folder of its own, so a
    repeated batch replaces itself. False if the timeout came first; the next call goes on from there."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{partials}/batch={number}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done = q.awaitTermination(timeout) if timeout else (q.awaitTermination() or True)
    if not done:
        q.stop()
    return bool(done)


def event_partial(batch: DataFrame) -> DataFrame:
    return batch.groupBy("event_type").agg(F.count("*").alias("events"), F.sum("value").alias("total"))


def merged(spark: SparkSession, partials: str) -> DataFrame:
    return spark.read.parquet(partials).groupBy("event_type").agg(F.sum("events").cast("long").alias("events"), F.sum("total").alias("total"))


def refresh_marts(spark: SparkSession, works: DataFrame, edges, partials: str, checkpoint: str, timeout: int | None = None, dense: int | None = None) -> bool:
    """Partials of the year marts from a stream of works; each file once. works has the column `_file` if files may share works; edges maps the files of a batch to
    its edges by kind (topics, institutions, collaboration). A batch writes a folder of its own for each mart, so that a repeated one replaces itself, and a work
    that comes again in another batch changes nothing. False if the timeout came first; the next call goes on from there."""
    tag = "_file" if "_file" in works.columns else None

    def write(batch: DataFrame, number: int) -> None:
        files = [r[0] for r in batch.select(tag).distinct().collect()] if tag else []  # as many as a trigger takes
        made = mart_partials(batch, **edges(files), file=tag, **({} if dense is None else {"dense": dense}))
        for name, df in made.items():
            df.write.mode("overwrite").parquet(f"{partials}/{name}/batch={number}")

    q = works.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    done = q.awaitTermination(timeout) if timeout else (q.awaitTermination() or True)
    if not done:
        q.stop()
    return bool(done)


def stream_works(spark: SparkSession, root: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the files below WORK_MASTER, each row with the name of its file there."""
    found = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").parquet(f"{root}/WORK_MASTER")
    return found.select("*", F.substring_index("_metadata.file_path", "/WORK_MASTER/", -1).alias("_file"))


def refresh_year_marts(spark: SparkSession, root: str, schema: T.StructType, partials: str, checkpoint: str, timeout: int | None = None, files_per_trigger: int = 1000, dense: int | None = None) -> bool:
    """refresh_marts over a curated folder, where a file's edges have the same name in the folders of their tables."""
    return refresh_marts(spark, stream_works(spark, root, schema, files_per_trigger), lambda files: paired_edges(spark, root, files, "_file"), partials, checkpoint, timeout, dense)


def streamed_mart(spark: SparkSession, partials: str, name: str) -> DataFrame:
    """A mart of all batches so far."""
    return merge_marts(spark.read.parquet(f"{partials}/{name}").drop("batch"), name)

"""Helpers the operators share: tables in the shared folder, word splitting and hashing, components of a graph."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The largest long stands for a missing doc_id where ids are compared.
NO_ID = 2**63 - 1
U64 = np.uint64
#: Of an Arrow batch that goes to or from a worker.
BATCH_BYTES = 8_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir. Where that is unset, a local one serves a local master alone; on a
    cluster the executors would not see it."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = "file:///tmp/checkpoints/lakequery"
    return where.rstrip("/")


def bounded(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for mapInArrow that hands memory back once its task ends, as workers are used again by later stages."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of a few megabytes, unless the session asks for smaller ones: long texts make 64 MB of the default, twice over."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).rstrip("b") == "67108864":
        spark.conf.set(key, str(BATCH_BYTES))


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as none of the taken ones has in any case, so that working columns clash with no column."""
    used = {c.lower() for c in taken}
    mark = "_"
    while any(mark + n in used for n in names):
        mark += "_"
    return [mark + n for n in names]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of materialize() that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._table)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files that no live plan refers to; long multi-job operators call it between jobs."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about limit bytes at most; a longer text is a slice of its own."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start, total = 0, 0
        for i in range(n):
            if i > start and total + sizes[i] > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(sizes[i])
        yield batch.slice(start, n - start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """Texts as UTF-8 bytes; a null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    return [b"" if t is None else t for t in pc.cast(col, pa.binary()).to_pylist()]


def ids_of(batch: pa.RecordBatch, column: str) -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def split_words(texts: list[bytes], lower: bool = False) -> tuple[list[bytes], np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of all texts in one list, and each text's first index in it (one more at the end)."""
    words: list[bytes] = []
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, t in enumerate(texts):
        words += (t.lower() if lower else t).split()  # bytes.split() cuts at exactly these six characters, bytes.lower() maps A-Z alone
        starts[i + 1] = len(words)
    return words, starts


def coded(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Dense number of each word, and the distinct words."""
    if not words:
        return np.zeros(0, dtype=np.int64), []
    d = pa.array(words, type=pa.binary()).dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary.to_pylist()


def hash64(items: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in items), dtype=U64, count=len(items))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    codes, distinct = coded(words)
    return hash64(distinct, seed)[codes] if len(words) else np.zeros(0, dtype=U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)


class Rolling:
    """Hashes of any run of words, from prefix sums of word hash times a power of an odd base, modulo 2^64."""

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes) + 1
        power = np.full(n, BASE, dtype=U64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        self.inverse = np.full(n, INVERSE, dtype=U64)
        self.inverse[0] = 1
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(n, dtype=U64)
        np.cumsum(hashes * power[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(U64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """Connected components of edges (u, v), as (node, root) for every node of an edge; a root is a node of its component.

    Each round points every node at its smallest neighbour and contracts the edges. Node ids must be hashes, so that their order is random: then a
    round leaves an expected constant share of the nodes, and stars need one round. Nothing but emptiness reaches the
    driver; hubs are partially aggregated before the shuffle."""
    e = edges.where("u <> v")
    mapping = None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        p = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p")), f"{tag}-parent")
        if mapping is None:
            mapping = p.select(F.col("u").alias("node"), F.col("p").alias("root"))
        elif p.isEmpty():
            return mapping
        else:
            q = p.select(F.col("u").alias("qu"), F.col("p").alias("qp"))
            mapping = materialize(mapping.join(q, mapping["root"] == q["qu"], "left").select("node", F.coalesce("qp", "root").alias("root")), f"{tag}-map")
        pu, pv = p.select(F.col("u").alias("au"), F.col("p").alias("ap")), p.select(F.col("u").alias("bu"), F.col("p").alias("bp"))
        e = materialize(e.join(pu, e["u"] == pu["au"]).join(pv, e["v"] == pv["bu"]).where("ap <> bp").select(F.least("ap", "bp").alias("u"), F.greatest("ap", "bp").alias("v")).distinct(), f"{tag}-edges")
        if e.isEmpty():
            return mapping

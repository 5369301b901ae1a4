"""Picking rows of groups, always with a total order and nulls last spelled out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.functions.text import fresh


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group; Spark keeps n rows of a group in each task before the shuffle."""
    (rn,) = fresh(df.columns, "rn")
    return df.withColumn(rn, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(rn) <= n).drop(rn)


def mode_by(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent value of each group, the smallest of equals."""
    (n,) = fresh(df.columns, "n")
    counted = df.groupBy(*keys, value).agg(F.count("*").alias(n))
    return top_n(counted, keys, [F.desc(n), F.asc_nulls_last(value)]).select(*keys, F.col(value).alias(name), F.col(n).alias("votes"))


def prefer_ok(df: DataFrame, key: str, status: str, position: str) -> DataFrame:
    """Of each key the first row with status OK, or else the last row."""
    ok = F.col(status) == "OK"
    return top_n(df, [key], [ok.desc_nulls_last(), F.when(ok, F.col(position)).otherwise(-F.col(position)).asc()])


def running(df: DataFrame, order: list[Column], value: Column, name: str, fn: str = "sum") -> DataFrame:
    """df with a running sum or minimum over all rows in an order, without one task that sees them all: range partitions of their own, plus what
    the partitions before come to (one row for each partition is ordered in one task). A column of that name is replaced."""
    from lakequery.sources.tables import persist_table

    total = {"sum": F.sum, "min": F.min}[fn]
    v, p, i, q, t, b, w = fresh([*df.columns, name], "v", "p", "i", "q", "t", "b", "w")
    parts = df.withColumn(v, value).repartitionByRange(*order).sortWithinPartitions(*order).withColumns({p: F.spark_partition_id(), i: F.monotonically_increasing_id()})
    kept = persist_table(parts)  # places must hold still
    before = kept.groupBy(F.col(p).alias(q)).agg(total(v).alias(t)).select(q, total(t).over(W.orderBy(q).rowsBetween(W.unboundedPreceding, -1)).alias(b))
    within = total(v).over(W.partitionBy(p).orderBy(i).rowsBetween(W.unboundedPreceding, 0))
    both = F.coalesce(b, F.lit(0)) + F.col(w) if fn == "sum" else F.least(b, w)
    return kept.withColumn(w, within).join(before, F.col(p) == F.col(q)).withColumn(name, both).drop(v, p, i, q, b, w)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """A rank from 1 over all rows, in an order without ties."""
    return running(df, order, F.lit(1).cast("long"), name)


#: Buckets of the numbers between a power of two and the next.
PER_OCTAVE = 1024


def _octave_bucket(x: Column) -> Column:
    """A whole number that grows with x, in even steps between powers of two; one for all x that are not positive, and one for NaN."""
    e = F.floor(F.log2(x))
    at = (e * PER_OCTAVE + F.floor((x / F.pow(F.lit(2.0), e) - 1) * PER_OCTAVE)).cast("long")
    return F.when(F.isnan(x), F.lit(2**40)).when(x > 0, at).otherwise(F.lit(-(2**40)))


def benjamini_hochberg(df: DataFrame, p: str, name: str, keys: list[str] | None = None) -> DataFrame:
    """False-discovery rates of p-values in each group, or over all rows; equal p-values have equal rates, a null p-value a null one.

    A rate is the least of p m / rank over this and all larger p-values, where rank counts the p-values up to it. Both running values are taken within
    buckets of the distinct p-values, whose totals are added up first: no task orders a whole group, only its buckets, 1,024 for each halving of p."""
    keys = keys or []
    x, c, b, k, m, r, ahead, later, bucket, bb, bm = fresh([*df.columns, name], "x", "c", "b", "k", "m", "r", "ahead", "later", "bucket", "bb", "bm")
    by = [F.col(key) for key in keys]
    held = fresh([*df.columns, name, x, c, b, k, m, r, ahead, later, bucket, bb, bm], *(f"g{i}" for i in range(len(keys))))
    of = lambda left: [F.col(left[i]).eqNullSafe(F.col(held[i])) for i in range(len(keys))]
    also = lambda on, left: reduce(lambda a, z: a & z, of(left), on)
    counted = df.where(F.col(p).isNotNull()).groupBy(*by, F.col(p).alias(x)).agg(F.count("*").alias(c)).withColumn(b, _octave_bucket(F.col(x).cast("double")))

    def spread(rows: DataFrame, value: Column, total, order: Column, out: str, whole: bool = False) -> DataFrame:
        """What the buckets before come to, in the order given, for each bucket."""
        sums = rows.groupBy(*by, F.col(b).alias(bb)).agg(value.alias(bm))
        w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        cols = [total(bm).over(w).alias(out), *([F.sum(bm).over(W.partitionBy(*by)).alias(m)] if whole else [])]
        sums = sums.select(*(F.col(key).alias(h) for key, h in zip(keys, held, strict=True)), F.col(bb).alias(bucket), *cols)
        return rows.join(sums, also(F.col(b) == F.col(bucket), keys)).drop(bucket, *held)

    up = W.partitionBy(*by, b).orderBy(x).rowsBetween(W.unboundedPreceding, 0)
    down = W.partitionBy(*by, b).orderBy(F.desc(x)).rowsBetween(W.unboundedPreceding, 0)
    ranked = spread(counted, F.sum(c), F.sum, F.asc(bb), ahead, whole=True).withColumn(k, F.coalesce(ahead, F.lit(0)) + F.sum(c).over(up))
    ranked = ranked.withColumn(r, F.col(x) * F.col(m) / F.col(k))
    rates = spread(ranked, F.min(r), F.min, F.desc(bb), later).withColumn(name, F.least(F.lit(1.0), later, F.min(r).over(down)))
    rates = rates.select(*(F.col(key).alias(h) for key, h in zip(keys, held, strict=True)), x, name)
    return df.drop(name).join(rates, also(F.col(p) == F.col(x), keys), "left").drop(x, *held)


def islands(df: DataFrame, keys: list[str], order: str, marker: Column, text: str) -> DataFrame:
    """Text of consecutive rows joined from one marker to the next; rows before the first marker are dropped."""
    (rows,) = fresh(df.columns, "rows")
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    cut = df.withColumn("record", F.sum(marker.cast("long")).over(w)).where("record > 0")
    grouped = cut.groupBy(*keys, "record").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias(rows))
    return grouped.select(*keys, "record", F.size(rows).cast("long").alias("n_rows"), F.array_join(F.transform(rows, lambda r: r["t"]), "\n").alias("text"))

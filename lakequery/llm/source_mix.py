"""Mixing of sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

A document's key is an exponential variate (from a hash of doc_id) over its quality weight; within a source, documents in order of their keys
are a weighted sample without replacement of any length. Complete epochs come first; the rest of the target is the prefix
of that order whose sizes add up to it. The running sum is taken in buckets of the key whose totals are added up first,
so no task orders a whole source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import fresh

SPAN = float(16**13)
#: Key buckets of a source.
BUCKETS = 4096
#: Share of documents that bucket bounds are laid out for, by weight. Documents of lower weight have larger keys; bounds for weight 1 alone would leave them to the last
#: bucket.
LAYOUT = ((0.5, 1.0), (0.1, 1 / 2), (0.1, 1 / 4), (0.1, 1 / 8), (0.1, 1 / 16), (0.1, 1 / 21))
WEIGHTS = (3, 1, 2)


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Weight from 0 to 1, lower the more mark-up symbols a text has; 1 for a null or empty text."""
    length = F.coalesce(F.length(text), F.lit(0)).cast("double")
    marks = length - F.coalesce(F.length(F.translate(text, "#*$%&|<>", "")), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * marks / F.greatest(length, F.lit(1.0)))


def sample_key(doc_id: Column, weight: Column, seed: int) -> Column:
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f"#{seed}"))), 1, 13)
    return -F.ln((F.conv(digits, 16, 10).cast("double") + 0.5) / SPAN) / weight


def key_bucket(key: Column) -> Column:
    """A number from 0 that grows with the key, about as often each for any usual mixture of weights."""
    below = sum((F.lit(share) * (F.lit(1.0) - F.exp(key * F.lit(-weight))) for share, weight in LAYOUT), F.lit(0.0))
    return F.least(F.lit(BUCKETS - 1), F.floor(below * BUCKETS)).cast("int")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """sizes (source, source_size) with target: shares by weight, none above most times its source's size, the excess reshared.

    The level at which sources fill up is found in one pass: sources in order of cap over weight fill up one after the other
    until one doesn't. This orders one row for each source, in one task."""
    rank = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.select("source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(most))).alias("cap"))
    order = W.orderBy((F.col("cap") / F.col("w")).asc(), F.asc_nulls_last("source"))
    every = W.partitionBy()
    s = s.select(
        "*",
        F.row_number().over(order).alias("k"),
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("total"),
        (F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("cap")).alias("filled"),
        F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)).alias("open"),
    )
    s = s.withColumn("level", (F.col("total") - F.col("filled")) / F.col("open"))
    s = s.withColumn("at", F.min(F.when(F.col("cap") > F.col("level") * F.col("w"), F.struct("k", "level"))).over(every))
    return s.select("source", "source_size", F.when(F.col("at").isNull() | (F.col("k") < F.col("at.k")), F.col("cap")).otherwise(F.col("at.level") * F.col("w")).alias("target"))


def mix_sources(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 11) -> DataFrame:
    """docs with size, source_size, target and taken added (a column of docs with one of these names is replaced, all others stay).

    size counts the words `[^\\x20\\x09-\\x0D]+` (null text: 0). A null source is a source of its own, ordered last. taken is size times the complete
    epochs, plus size again where half the document still fits the rest of the target in key order (ties by doc_id, then
    by the text's checksum; of repeated rows any may come first). Empty documents take 0. An empty table gives none."""
    names = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in names]
    n, key, crc, b, total, ts, ps, pb, ahead, run = fresh([*docs.columns, *names], "n", "key", "crc", "b", "total", "ts", "ps", "pb", "ahead", "run")
    sized = docs.select(*(F.col(f"`{c}`") for c in kept), n_words(F.col("text")).alias(n), sample_key(F.col("doc_id"), quality(F.col("text")), seed).alias(key), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias(crc))
    full = sized.withColumn(b, key_bucket(F.col(key)))
    parts = full.groupBy("source", b).agg(F.sum(n).alias(total))
    targets = source_targets(parts.groupBy("source").agg(F.sum(total).alias("source_size")), share, most, weights).select(F.col("source").alias(ts), "source_size", "target")
    before = parts.select(F.col("source").alias(ps), F.col(b).alias(pb), (F.sum(total).over(W.partitionBy("source").orderBy(b).rowsBetween(W.unboundedPreceding, 0)) - F.col(total)).alias(ahead))
    plan = before.join(targets, F.col(ps).eqNullSafe(F.col(ts)))
    order = W.partitionBy("source", b).orderBy(key, F.asc_nulls_last("doc_id"), crc).rowsBetween(W.unboundedPreceding, 0)
    full = full.withColumn(run, F.sum(n).over(order) - F.col(n))
    full = full.join(plan, F.col("source").eqNullSafe(F.col(ps)) & (F.col(b) == F.col(pb)))
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(int(most)))).otherwise(F.lit(0)).cast("long")
    left = F.col("target") - epochs * F.col("source_size")
    extra = (F.col(ahead) + F.col(run) + F.col(n) / F.lit(2.0) <= left).cast("long")
    taken = F.when(F.col(n) > 0, F.col(n) * (epochs + extra)).otherwise(F.lit(0)).cast("long")
    return full.select(*(F.col(f"`{c}`") for c in kept), F.col(n).alias("size"), "source_size", "target", taken.alias("taken"))


#: The same result in the oracle's SQL.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, text,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(coalesce(length(text), 0) AS DOUBLE) AS chars,
         CAST(coalesce(length(translate(text, '#*$%&|<>', '')), 0) AS DOUBLE) AS plain,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '#11'), 1, 13) AS BIGINT) AS DOUBLE) AS digits
  FROM documents),
k AS (SELECT doc_id, source, size, -ln((digits + 0.5) / 4503599627370496.0) / (1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * (chars - plain) / greatest(chars, 1.0::DOUBLE))) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
w AS (SELECT source, source_size, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS k, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total,
        sum(cap) OVER (o ROWS UNBOUNDED PRECEDING) - cap AS filled, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
v AS (SELECT *, (total - filled) / open AS level FROM l),
f AS (SELECT k AS cut, level AS lv FROM v WHERE cap > level * w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN cut IS NULL OR k < cut THEN cap ELSE lv * w END AS target FROM v LEFT JOIN f ON true),
r AS (SELECT k.doc_id, k.size, t.source_size, t.target,
        sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) - k.size AS run,
        CASE WHEN t.source_size > 0 THEN least(floor(t.target / t.source_size), 2) ELSE 0 END AS epochs
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size > 0 THEN size * (epochs + CASE WHEN run + size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) ELSE 0 END AS BIGINT) AS taken FROM r
"""

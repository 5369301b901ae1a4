"""Sharding by a hierarchical weighted hash tree.

A document descends region, rack and shard levels. At each level every child draws an exponential variate from a hash of
(doc_id, child) divided by its weight, and the smallest draw wins, so a child is chosen in proportion to its weight and,
where a weight grows, keys move only into that child's subtree. A further shard opens as a region of its own, which leaves
all other weights as they were: rows move only into it."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import fresh

#: Values of 13 hexadecimal digits.
SPAN = float(16**13)
#: Rows that share a slot counter on average; bounds what one task sorts.
COUNTER_ROWS = 200_000


@dataclass(frozen=True)
class Tree:
    """Regions, each a list of racks, each a list of shard weights; shards are numbered depth first."""

    regions: tuple[tuple[tuple[float, ...], ...], ...] = field(default=(((1.0, 1.0),) * 4,) * 3)

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grown(self, weight: float = 1.0) -> Tree:
        """With one more shard, in a region of its own."""
        return Tree((*self.regions, ((weight,),)))


def _draw(key: Column, name: Column, weight: Column) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit("|"), name)), 1, 13)
    unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / SPAN
    return -F.ln(unit) / weight


def _nodes(children: list[tuple[str, float, int]]) -> Column:
    """Nodes with names, weights and numbers, as a constant: the tree is data, so a large one makes no larger plan."""
    return F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("i")) for name, w, i in children))


def _first(key: Column, children: Column) -> Column:
    """Smallest draw of the children and the child's number."""
    return F.array_min(F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("d"), c["i"].alias("i"))))


def placed(df: DataFrame, doc_id: str, tree: Tree, shard: str, grown: str) -> DataFrame:
    """df with two columns added: the shard of a document by doc_id and tree alone, and the one with a further shard in a region of its own. A null
    doc_id hashes as the text 'null'. Only the children of the chosen region and rack are drawn."""
    key = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null"))
    region, rack = fresh([*df.columns, shard, grown], "region", "rack")
    weight = lambda of: math.fsum(w for r in of for w in r)
    regions, racks, shards, number = [], [], [], 0
    for g, of in enumerate(tree.regions):
        regions.append((str(g), weight(of), g))
        racks.append(_nodes([(f"{g}.{r}", math.fsum(x), r) for r, x in enumerate(of)]))
        held = []
        for r, x in enumerate(of):
            held.append(_nodes([(f"{g}.{r}.{s}", w, number + s) for s, w in enumerate(x)]))
            number += len(x)
        shards.append(F.array(*held))
    df = df.withColumn(region, _first(key, _nodes(regions)))
    at = F.col(region)["i"] + 1
    df = df.withColumn(rack, _first(key, F.element_at(F.array(*racks), at))["i"])
    df = df.withColumn(shard, _first(key, F.element_at(F.element_at(F.array(*shards), at), F.col(rack) + 1))["i"].cast("int"))
    further = len(tree.regions)
    new = _draw(key, F.lit(str(further)), F.lit(float(weight(tree.grown().regions[further])))) < F.col(region)["d"]
    return df.withColumn(grown, F.when(new, tree.n_shards).otherwise(F.col(shard)).cast("int")).drop(region, rack)


def assign_shards(docs: DataFrame, tree: Tree | None = None) -> DataFrame:
    """docs with size, text_crc32, law, shard, slot and grown_shard added; columns of docs with these names are replaced, all others stay.

    size: UTF-8 bytes of the text (null: none) plus 8; text_crc32 of a null text is 0, as of an empty one. The law is `key`: doc_id
    and the tree decide, so rows that share a doc_id share a shard, those without one too. slot numbers the rows of a shard from 0 without a gap,
    by counters of bounded size whose totals are added up first; no task sorts a whole shard. An empty table gives none."""
    tree = tree or Tree()
    names = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    kept = [c for c in docs.columns if c not in names]
    crc, size, shard, grown, part, at, in_shard, in_part, n, before = fresh(docs.columns, "crc", "size", "shard", "grown", "part", "at", "in_shard", "in_part", "n", "before")
    counters = max(8, math.ceil(docs.select("doc_id").count() / tree.n_shards / COUNTER_ROWS))
    crc_of = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias(crc)
    part_of = F.pmod(F.xxhash64("doc_id", crc), F.lit(counters)).cast("int").alias(part)
    size_of = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias(size)
    full = placed(docs.select(*(F.col(f"`{c}`") for c in kept), crc_of, size_of), "doc_id", tree, shard, grown).select("*", part_of)
    slim = placed(docs.select("doc_id", crc_of), "doc_id", tree, shard, grown).select(shard, part_of)
    totals = slim.groupBy(F.col(shard).alias(in_shard), F.col(part).alias(in_part)).agg(F.count("*").alias(n))
    ahead = totals.select(in_shard, in_part, (F.sum(n).over(W.partitionBy(in_shard).orderBy(in_part).rowsBetween(W.unboundedPreceding, 0)) - F.col(n)).alias(before))
    full = full.withColumn(at, F.row_number().over(W.partitionBy(shard, part).orderBy(F.asc_nulls_last("doc_id"), crc)))
    out = full.join(ahead, (F.col(shard) == F.col(in_shard)) & (F.col(part) == F.col(in_part)))
    slot = (F.col(at) - 1 + F.col(before)).cast("long")
    return out.select(*(F.col(f"`{c}`") for c in kept), F.col(size).alias("size"), F.col(crc).alias("text_crc32"), F.lit("key").alias("law"), F.col(shard).alias("shard"), slot.alias("slot"), F.col(grown).alias("grown_shard"))

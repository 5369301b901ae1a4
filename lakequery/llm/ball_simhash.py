"""Near-duplicates by SimHash, with fingerprints at three differing bits or fewer found by meeting in the middle.

Every fingerprint emits all values within half the radius of it, and values are shuffled. Two fingerprints within one bit of the same value
are within two of each other, so two bits meet at one bit from each. Three bits meet at one bit from one side and two from the other. That takes two savings:
- Fingerprints three bits apart have different parity, so only the odd ones emit values at two bits.
- Of three bits, two lie in the same half of the fingerprint, so values at two bits need both bits in one half: 992 in place of 2,016.

Whoever is within one bit of a value is within three bits of everyone that emitted it. So all rows of a value link to one of those, the hub, and no
pairs are made; a value without a hub links nothing. As fingerprints are distinct, a value has at most 65 rows within a bit and 992 at two.

Before that, fingerprints that can't have a partner leave: of three bits, one half has at most one, so a partner is within one bit of it in either half of 32 bits. Each
half emits its 33 values within one bit, and only fingerprints whose own half somebody else emitted go on."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import NO_ID, U64, bounded, components, discard, ids_of, materialize, release, signed, slices, texts_of

SIZE, SEED = 3, 42
#: Shingles whose bits are counted at a time, 64 bytes each.
BLOCK = 1 << 16


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of every run of three words of a text with A-Z lower-cased, repeats included; of fewer words, of the whole sequence."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=U64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SIZE + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), dtype=U64, count=n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; zero without any."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        some = hashes[i : i + BLOCK].astype("<u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist())


@bounded
def _fingerprinted(batches):
    for b in slices(batches):
        fp = np.fromiter((fingerprint(shingle_hashes(t)) for t in texts_of(b)), dtype=U64, count=b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(ids_of(b, "k"), pa.int64()), pa.array(signed(fp))], names=["k", "fp"])


def _masks(masks: list[int]) -> Column:
    """As a constant array of longs."""
    return F.array(*(F.lit(m - 2**64 if m >= 2**63 else m) for m in masks))


ONE = [0, *(1 << i for i in range(64))]
TWO = [1 << i | 1 << j for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]
HALF = [0, *(1 << i for i in range(32))]


def _halves() -> Column:
    """Both halves as a row each, told apart by bit 32."""
    return F.explode(F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(2**32 - 1)).bitwiseOR(F.lit(2**32))))


def with_partners(nodes: DataFrame) -> DataFrame:
    """The fingerprints (fp) with at most one differing bit from another one in either half."""
    own = nodes.select("fp", _halves().alias("half"))
    emitted = own.select("half", F.explode(_masks(HALF)).alias("m")).select(F.col("half").bitwiseXOR(F.col("m")).alias("v"))
    shared = emitted.groupBy("v").agg(F.count("*").alias("n")).where("n > 1").select("v")
    return own.join(shared, own["half"] == shared["v"], "left_semi").select("fp").distinct()


def ball_links(nodes: DataFrame) -> DataFrame:
    """Links (u, v) that join all distinct fingerprints (fp) at three differing bits or fewer into the same components, each at three bits or fewer itself."""
    odd = F.bit_count("fp").bitwiseAND(F.lit(1)) == 1
    emitted = nodes.select("fp", F.explode(F.when(odd, _masks(ONE + TWO)).otherwise(_masks(ONE))).alias("m"))
    emitted = emitted.select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("v"))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= 1
    met = emitted.withColumn("hub", F.min(F.when(near, F.col("fp"))).over(W.partitionBy("v"))).where("fp <> hub")
    return met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= 3).select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct()


def ball_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links reach, for every row; linked are
    rows whose fingerprints differ in three bits or fewer.

    A null text counts as empty. A text without words has the fingerprint zero and is linked like any other. Rows that share a doc_id, or have
    none, are judged by their own texts. A null doc_id counts as larger than any other and gives a null component_id
    only where a component has no other id. An empty table gives no rows. Other columns are ignored."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"), "text")
    rows = materialize(keyed.mapInArrow(_fingerprinted, "k long, fp long"), "ball-fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("k").alias("k")), "ball-nodes")
    some = materialize(with_partners(nodes), "ball-candidates")
    links = materialize(ball_links(some), "ball-links")
    discard(some)
    release(docs.sparkSession)
    # of a single long, this hash is one to one
    named = components(links.select(F.xxhash64("u").alias("u"), F.xxhash64("v").alias("v")), "ball-cc")
    held = nodes.withColumn("h", F.xxhash64("fp"))
    held = held.join(named, held["h"] == named["node"], "left").select("fp", "k", F.coalesce("root", "h").alias("root"))
    held = materialize(held, "ball-held")
    least = held.groupBy(F.col("root").alias("lr")).agg(F.min("k").alias("component"))
    least = held.join(least, held["root"] == least["lr"]).select(F.col("fp").alias("nf"), "component")
    none = F.lit(NO_ID)
    return rows.join(least, rows["fp"] == least["nf"]).select(F.nullif("k", none).alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.nullif("component", none).alias("component_id"))

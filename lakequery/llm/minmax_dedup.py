"""Near-duplicate documents by min-max hashing.

Each random permutation of a document's 5-word shingles gives two signature values, its minimum and its maximum, so half
as many hash evaluations fill a signature as with minima alone, and the estimate stays unbiased with lower variance. Bands of four
values (two permutations' extremes) make candidates; every link is confirmed on the full shingle sets.

Texts of the same words are one node from the start. A shingle that no other candidate holds can be in no intersection, which bounds a
node's similarity to any other: nodes that can't reach the threshold leave before a set is compared. No bucket makes all
its pairs. Its nodes are first compared with one of them, the pivot (the node that shares most buckets with others), and links are contracted. Buckets
that still hold different components are grouped under a set R that is the pivot of many, and compared with that. A pair x, z left in different
components has a member that is not linked to R, x say, so its difference D(x) from R (the shingles that one of the two sets has alone) is
larger than k (n(x) + n(R)), k = (100 - p) / (100 + p); a link of x and z needs their differences to share more than
(|D(z)| + k (n(R) - n(z))) / 2 shingles. So both need look only by the rarest of their differences: an edited copy is sought by its edits,
which nobody shares, and never by the text the whole group has. The few that meet are compared, or, where one
shingle of a difference still joins very many, the same step is taken with a pivot of their own. There is no cap: the rounds end
when every pair of different components has been compared or bounded below the threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import NO_ID, U64, Rolling, bounded, components, discard, ids_of, materialize, mix, release, signed, slices, split_words, texts_of, word_hashes

SHINGLE = 5
#: Pairs of holders of a shingle of a difference that one task looks at, most of which end there; beyond it the holders get a pivot of their own.
DIRECT = 1_000_000


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Sorted distinct shingle hashes of all texts, each text's first index in them, and a 128-bit hash of each text's words;
    a text of fewer words is one shingle."""
    words, starts = split_words(texts, lower=True)
    roll = Rolling(word_hashes(words))
    n = np.diff(starts)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + starts[:-1][owner]
    h = roll.of(first, first + np.minimum(size, n[owner]))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]) if len(h) else np.zeros(0, dtype=bool)
    h, owner = h[keep], owner[keep]
    whole = [xxhash.xxh3_128_digest(b" ".join(words[a:b])) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
    return h, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int64), whole


def signatures(h: np.ndarray, starts: np.ndarray, permutations: int, seed: int = 7) -> np.ndarray:
    """Minimum and maximum of each permutation, as columns 2i and 2i+1; rows of empty sets are zero."""
    full = np.flatnonzero(np.diff(starts) > 0)
    out = np.zeros((len(starts) - 1, 2 * permutations), dtype=U64)
    keys = np.random.default_rng(seed).integers(1, 2**63, size=(permutations, 2), dtype=np.uint64)
    for i, (a, b) in enumerate(keys):
        v = (h ^ b) * (a | U64(1))
        v ^= v >> U64(32)
        v *= U64(0xD6E8FEB86659FD93)
        out[full, 2 * i] = np.minimum.reduceat(v, starts[full]) if len(full) else 0
        out[full, 2 * i + 1] = np.maximum.reduceat(v, starts[full]) if len(full) else 0
    return out


def _signed(bands: int):
    def run(batches):
        for b in slices(batches, limit=2_000_000):
            h, starts, whole = shingles(texts_of(b))
            sig = signatures(h, starts, 2 * bands)
            band = np.zeros((b.num_rows, bands), dtype=U64)
            for i in range(bands):
                x = mix(sig[:, 4 * i] + U64(i + 1))
                for j in range(1, 4):
                    x = mix(x * U64(0x9E3779B97F4A7C15) + sig[:, 4 * i + j])
                band[:, i] = x
            lists = pa.FixedSizeListArray.from_arrays(pa.array(signed(band.ravel())), bands).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in ("k", "rid")), pa.array(np.diff(starts)), pa.array(whole, pa.binary()), lists], names=["k", "rid", "n", "fp", "bands"])

    return bounded(run)


@bounded
def _sets(batches):
    """Sets of the texts whose words are those asked for; another text of the same (k, rid) gives none."""
    for b in slices(batches, limit=2_000_000):
        h, starts, whole = shingles(texts_of(b))
        mine = [i for i, fp in enumerate(ids_of(b, "fp")) if fp == whole[i]]
        yield pa.RecordBatch.from_arrays([pa.array([whole[i] for i in mine], pa.binary()), pa.array([h[starts[i] : starts[i + 1]].tobytes() for i in mine], pa.binary())], names=["fp", "shingles"])


@bounded
def _exploded(batches):
    for b in slices(batches, "shingles"):
        sets = [np.frombuffer(x, dtype=np.int64) for x in ids_of(b, "shingles")]
        sid = np.repeat(np.asarray(ids_of(b, "sid"), dtype=np.int64), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets) if sets else sid), pa.array(sid)], names=["h", "sid"])


def _linked(percent: int):
    def run(batches):
        for b in slices(batches, "sx"):
            keep = []
            for x, y in zip(ids_of(b, "sx"), ids_of(b, "sy"), strict=True):
                x, y = np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield b.select(["u", "v", "cu", "cv"]).filter(pa.array(keep, pa.bool_()))

    return bounded(run)


@bounded
def _differences(batches):
    """One row for each shingle of a member's difference from the pivot, with the sizes of the difference, the member's set and the pivot's."""
    for b in slices(batches, "sx"):
        rows: list[list] = [[] for _ in range(8)]
        for g, x, c, far, sx, sp in zip(*(ids_of(b, k) for k in ("g", "x", "c", "far", "sx", "sp")), strict=True):
            sx, sp = np.frombuffer(sx, dtype=np.int64), np.frombuffer(sp, dtype=np.int64)
            d = np.setxor1d(sx, sp, assume_unique=True)
            for out, v in zip(rows, (g, x, c, far, len(d), len(sx), len(sp)), strict=False):
                out.append(np.full(len(d), v))
            rows[7].append(d)
        kinds = [pa.bool_() if k == 3 else pa.int64() for k in range(8)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(r) if r else [], t) for r, t in zip(rows, kinds, strict=True)], names=["g", "x", "c", "far", "d", "n", "np", "e"])


def near_duplicates(docs: DataFrame, percent: int = 85, bands: int = 24, direct: int = DIRECT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, n_links, rid (hash of doc_id and text), group (of the component) for every document; linked are documents with 100 * intersection >= percent * union.

    A set holds the distinct 5-word shingles of the text with A-Z lower-cased; a text of fewer words is one shingle. An empty or
    null text has no shingles and is linked with nothing. Rows with the same words are always linked, repeated rows too. Rows that share a
    doc_id, or have none, are judged by their own texts. A null doc_id counts as larger than any other and gives a null component_id
    only where a component has no other id; such rows are never the smallest and are kept only if alone. At 24 bands a pair at the
    threshold of 85 is missed with odds under 1e-7. `n_links` counts the confirmed links of the document's set to other
    sets that the rounds needed. Other columns are ignored."""
    source = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64("doc_id", "text").alias("rid"), "text")
    sig = materialize(source.mapInArrow(_signed(bands), "k long, rid long, n long, fp binary, bands array<long>"), "minmax-signatures")
    nodes = sig.where("n > 0").groupBy("fp").agg(F.min(F.struct("k", "rid")).alias("r"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    rows = materialize(nodes.select("fp", "r", "n", F.explode("bands").alias("b")), "minmax-bands")
    sizes = rows.groupBy(F.col("b").alias("sb")).agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(rows.join(sizes, rows["b"] == sizes["sb"]).select("b", "fp", "r", "n", "size"), "minmax-buckets")
    # texts of candidates alone are cut into sets again; each set once, under a number of its own in random order
    place = shared.select("fp", "r").distinct().select(F.col("fp").alias("pfp"), F.col("r.k").alias("pk"), F.col("r.rid").alias("prid"))
    asked = source.join(place, (source["k"] == place["pk"]) & (source["rid"] == place["prid"])).select(F.col("pfp").alias("fp"), "text")
    sets = asked.mapInArrow(_sets, "fp binary, shingles binary").groupBy("fp").agg(F.first("shingles").alias("shingles"))
    sets = materialize(sets.select(F.xxhash64(F.monotonically_increasing_id()).alias("sid"), "fp", "shingles"), "minmax-sets")
    lone = sets.mapInArrow(_exploded, "h long, sid long").groupBy("h").agg(F.count("*").alias("c"), F.min("sid").alias("lsid")).where("c = 1").groupBy("lsid").agg(F.count("*").alias("lone"))
    names = sets.select("sid", F.col("fp").alias("nfp")).join(lone, F.col("sid") == F.col("lsid"), "left").select("nfp", "sid", F.coalesce("lone", F.lit(0)).alias("lone"))
    can = shared.join(names, shared["fp"] == names["nfp"]).withColumn("s", F.col("n") - F.col("lone")).where(F.col("s") * 100 >= F.col("n") * percent)
    can = materialize(can.select("b", "sid", "n", "s", "size"), "minmax-linkable")
    score = can.groupBy(F.col("sid").alias("ssid")).agg(F.sum("size").alias("score"))
    buckets = can.join(score, can["sid"] == score["ssid"]).select("b", F.struct("score", "sid", "n", "s").alias("m"))
    best = buckets.groupBy(F.col("b").alias("pb")).agg(F.max("m").alias("p"))
    buckets = materialize(buckets.join(best, buckets["b"] == best["pb"]).where("m.sid <> p.sid").select("b", "m", "p"), "minmax-pivots")
    discard(rows, shared, can)
    release(docs.sparkSession)
    links, root = None, None

    def compared(asked: DataFrame) -> DataFrame:
        """Links of the pairs are kept; components they join, by their names before."""
        nonlocal links, root
        x, y = sets.select(F.col("sid").alias("xs"), F.col("shingles").alias("sx")), sets.select(F.col("sid").alias("ys"), F.col("shingles").alias("sy"))
        found = asked.join(x, asked["u"] == x["xs"]).join(y, asked["v"] == y["ys"]).select("u", "v", "cu", "cv", "sx", "sy").mapInArrow(_linked(percent), "u long, v long, cu long, cv long")
        found = materialize(found, "minmax-links")
        links = found.select("u", "v") if links is None else links.union(found.select("u", "v"))
        new = components(found.select(F.col("cu").alias("u"), F.col("cv").alias("v")), "minmax-cc")
        root = _composed(root, new)
        release(docs.sparkSession)
        return new

    compared(_pairs(buckets.select(*_both("p", "m", "m.sid", "p.sid")).distinct(), percent))
    groups, pairs = _hubs(buckets, root), None
    while not groups.isEmpty() or (pairs is not None and not pairs.isEmpty()):
        asked = _pairs(groups, percent)
        groups = _open(groups, compared(asked if pairs is None else asked.union(pairs).distinct()))
        if groups.isEmpty():
            break
        groups, pairs = _split(groups, sets, percent, direct)
    member = sets.select("fp", "sid").join(root, F.col("sid") == F.col("node"), "left").select("fp", "sid", F.coalesce("root", "sid").alias("c"))
    degree = links.select(F.col("u").alias("x")).union(links.select(F.col("v").alias("x"))).groupBy(F.col("x").alias("dx")).agg(F.count("*").alias("n_links"))
    member = materialize(member.join(degree, F.col("sid") == F.col("dx"), "left").select(F.col("fp").alias("mf"), "c", F.coalesce("n_links", F.lit(0)).alias("n_links")), "minmax-members")
    # a node that is no candidate is named by its words; one name for each component
    node = nodes.select("fp", F.col("r.k").alias("k")).join(member, F.col("fp") == F.col("mf"), "left").select("fp", "k", F.when(F.col("c").isNotNull(), F.hex(F.col("c"))).otherwise(F.hex("fp")).alias("group"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    least = node.groupBy(F.col("group").alias("lg")).agg(F.min("k").alias("component_id"))
    node = node.join(least, F.col("group") == F.col("lg")).select(F.col("fp").alias("nf"), "group", "component_id", "n_links")
    out = sig.join(node, (sig["fp"] == node["nf"]) & (sig["n"] > 0), "left")
    none, ident = F.lit(NO_ID), F.coalesce("component_id", "k")
    return out.select(F.nullif("k", none).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(ident, none).alias("component_id"), (F.col("k") == ident).alias("kept"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "rid", "group")


def _both(p: str, m: str, c: str, pc: str) -> list:
    """Columns of a pair from a struct of either side and their components."""
    return [F.col(f"{p}.sid").alias("p"), F.col(f"{p}.n").alias("pn"), F.col(f"{p}.s").alias("ps"), F.col(pc).alias("pc"), F.col(f"{m}.sid").alias("x"), F.col(f"{m}.n").alias("n"), F.col(f"{m}.s").alias("s"), F.col(c).alias("c")]


def _hubs(buckets: DataFrame, root: DataFrame) -> DataFrame:
    """Groups (g, p, x and what is known of both) of the buckets in which different components are left, each under one set R to compare with: the
    best pivot that its members have in any open bucket, so that the buckets of a group of copies come under one, whether or not they hold it."""
    named = root.select(F.col("node").alias("rn"), F.col("root").alias("rr"))
    now = buckets.join(named, F.col("m.sid") == F.col("rn"), "left").select("b", "m", "p", F.coalesce("rr", "m.sid").alias("c"))
    left = now.groupBy(F.col("b").alias("ob")).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("ob")
    now = materialize(now.join(left, now["b"] == left["ob"], "left_semi").select("b", "m", "c", F.col("p").alias("hub")), "minmax-open")
    for _ in range(2):
        own = now.groupBy(F.col("m.sid").alias("hx")).agg(F.max("hub").alias("h"))
        far = now.join(own, F.col("m.sid") == F.col("hx")).groupBy(F.col("b").alias("hb")).agg(F.max("h").alias("h"))
        now = now.join(far, now["b"] == far["hb"]).select("b", "m", "c", F.col("h").alias("hub"))
    one = now.where("m.sid <> hub.sid").select(F.col("hub.sid").alias("g"), "hub", "m", "c").distinct()
    one = one.join(named, F.col("hub.sid") == F.col("rn"), "left").withColumn("hc", F.coalesce("rr", "hub.sid"))
    return materialize(one.select("g", *_both("hub", "m", "c", "hc")), "minmax-groups")


def _pivoted(buckets: DataFrame) -> DataFrame:
    """Groups of the other members of each bucket (b, m) and its pivot."""
    best = buckets.groupBy(F.col("b").alias("pb")).agg(F.max("m").alias("p"))
    both = buckets.join(best, buckets["b"] == best["pb"]).where("m.sid <> p.sid")
    return both.select(F.col("b").alias("g"), *_both("p", "m", "m.c", "p.c"))


def _can_link(percent: int):
    """Of a pair, by sizes and by the shingles that others hold too: the intersection has no lone shingle."""
    most = F.least("s", "ps")
    return most * 100 >= (F.col("n") + F.col("pn") - most) * percent


def _pairs(df: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of (p, x) in different components, smaller number first."""
    ahead = F.col("p") < F.col("x")
    pick = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b))
    return df.where("c <> pc").where(_can_link(percent)).select(pick("p", "x").alias("u"), pick("x", "p").alias("v"), pick("pc", "c").alias("cu"), pick("c", "pc").alias("cv")).distinct()


def _composed(root: DataFrame | None, new: DataFrame) -> DataFrame:
    """Components of nodes after a round that joined components; a component's name is one of its nodes."""
    if root is None:
        return new
    moved = new.select(F.col("node").alias("nn"), F.col("root").alias("nr"))
    old = root.join(moved, root["root"] == moved["nn"], "left").select("node", F.coalesce("nr", "root").alias("root"))
    fresh = new.join(root.select(F.col("node").alias("on")), new["node"] == F.col("on"), "left_anti")
    return materialize(old.union(fresh), "minmax-roots")


def _open(groups: DataFrame, new: DataFrame) -> DataFrame:
    """Groups whose members, the pivot apart, are still of different components, with the components renamed."""
    a, b = new.select(F.col("node").alias("an"), F.col("root").alias("ar")), new.select(F.col("node").alias("bn"), F.col("root").alias("br"))
    now = groups.join(a, groups["c"] == a["an"], "left").join(b, groups["pc"] == b["bn"], "left")
    now = materialize(now.select("g", "p", "pn", "ps", F.coalesce("br", "pc").alias("pc"), "x", "n", "s", F.coalesce("ar", "c").alias("c")), "minmax-state")
    left = now.groupBy(F.col("g").alias("og")).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("og")
    return materialize(now.join(left, now["g"] == left["og"], "left_semi"), "minmax-open")


def _split(groups: DataFrame, sets: DataFrame, percent: int, direct: int) -> tuple[DataFrame, DataFrame]:
    """The groups that differences from the pivot leave, with pivots of their own, and pairs to compare directly.

    A pair has to share o = (d + d' - k (n + n')) / 2 shingles of its differences at least, so the first that it shares, in any order that holds
    for the whole group, is among the first d - o + 1 of either; the order is from the rarest among far members to the most frequent."""
    x, p = sets.select(F.col("sid").alias("xs"), F.col("shingles").alias("sx")), sets.select(F.col("sid").alias("ps_"), F.col("shingles").alias("sp"))
    both = groups.join(x, groups["x"] == x["xs"]).join(p, groups["p"] == p["ps_"])
    both = both.select("g", "x", "c", (F.col("c") != F.col("pc")).alias("far"), "sx", "sp")
    parts = materialize(both.mapInArrow(_differences, "g long, x long, c long, far boolean, d long, n long, np long, e long"), "minmax-differences")
    hold = parts.groupBy(F.col("g").alias("hg"), F.col("e").alias("he")).agg(F.count_if("far").alias("far_n"), F.min(F.when(F.col("far"), F.col("c"))).alias("lo"), F.max(F.when(F.col("far"), F.col("c"))).alias("hi"), F.count("*").alias("held"))
    ranked = parts.join(hold, (F.col("g") == F.col("hg")) & (F.col("e") == F.col("he")))
    ranked = ranked.withColumn("at", F.row_number().over(W.partitionBy("g", "x").orderBy("far_n", "e")))
    up, down = 100 + percent, 100 - percent  # all in units of 2 (100 + p)
    any_ = F.col("d") * up - F.lit(down) * (F.col("n") + F.floor(F.col("n") * 100 / percent))  # of any partner, as sets of a pair are no further apart in size
    far_ = F.col("d") * up + F.lit(down) * (F.col("np") - F.col("n"))  # of a far one, more than that
    places = lambda least: F.col("d") - F.greatest(F.lit(1), F.ceil(least / (2.0 * up) - 1e-9)) + 1
    seeks = (F.col("far_n") > F.col("far").cast("int")) & ((F.col("lo") != F.col("c")) | (F.col("hi") != F.col("c"))) & (F.col("at") <= places(F.greatest(any_, far_)))
    sought = F.col("far") & (F.col("held") > 1) & (F.col("at") <= places(any_))
    ends = materialize(ranked.select("g", "e", "x", "c", "d", "n", "at", seeks.alias("seeks"), sought.alias("sought")).where("seeks or sought"), "minmax-ends")
    load = ends.groupBy(F.col("g").alias("lg"), F.col("e").alias("le")).agg(F.count_if("seeks").alias("a"), F.count_if("sought").alias("b")).where("a > 0 and b > 0").select("lg", "le", (F.col("a") * F.col("b") <= direct).alias("few"))
    ends = ends.join(load, (F.col("g") == F.col("lg")) & (F.col("e") == F.col("le"))).drop("lg", "le")
    ends = materialize(ends, "minmax-met")
    one = ends.where("few and seeks").select(*(F.col(k).alias(f"a_{k}") for k in ("g", "e", "x", "c", "d", "n", "at")))
    least = F.ceil(((F.col("d") + F.col("a_d")) * up - F.lit(down) * (F.col("n") + F.col("a_n"))) / (2.0 * up) - 1e-9)
    fits = (F.col("x") != F.col("a_x")) & (F.col("c") != F.col("a_c")) & (F.col("at") + least <= F.col("d") + 1) & (F.col("a_at") + least <= F.col("a_d") + 1)
    met = ends.where("few and sought").join(one, (F.col("g") == F.col("a_g")) & (F.col("e") == F.col("a_e")) & fits)
    swap = F.col("x") < F.col("a_x")
    pick = lambda c, low: F.when(swap == low, F.col(c)).otherwise(F.col(f"a_{c}"))
    pairs = met.select(pick("x", True).alias("u"), pick("x", False).alias("v"), pick("c", True).alias("cu"), pick("c", False).alias("cv")).distinct()
    known = groups.select(F.col("g").alias("kg"), F.col("x").alias("kx"), F.struct(F.col("x").alias("sid"), "n", "s", "c").alias("m"))
    many = ends.where("not few").select("g", "e", "x").join(known, (F.col("g") == F.col("kg")) & (F.col("x") == F.col("kx")))
    many = materialize(many.select(F.xxhash64("g", "e").alias("b"), "m.*").distinct(), "minmax-many")
    # an edit changes several shingles, which the same members hold: one of such buckets is enough
    same = many.groupBy("b").agg(F.bit_xor(F.xxhash64("sid")).alias("who"), F.count("*").alias("size")).groupBy("who", "size").agg(F.min("b").alias("kb")).select("kb")
    many = many.join(same, many["b"] == same["kb"], "left_semi")
    weight = many.groupBy(F.col("sid").alias("wsid")).agg(F.count("*").alias("score"))
    many = many.join(weight, many["sid"] == weight["wsid"]).select("b", F.struct("score", "sid", "n", "s", "c").alias("m"))
    return materialize(_pivoted(many), "minmax-groups"), materialize(pairs, "minmax-pairs")


def without_near_duplicates(docs: DataFrame, percent: int = 80, bands: int = 32) -> DataFrame:
    """One row of docs, all columns, of each component: that with the smallest doc_id (null last, ties by the hash of doc_id and
    text; of identical rows any one). All rows without a word stay."""
    found = materialize(near_duplicates(docs, percent, bands).select("doc_id", "rid", "group"), "minmax-found")
    held = found.where("`group` is not null").select("group", F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), "rid").alias("r"))
    first = held.groupBy("group").agg(F.min("r").alias("r")).select(F.col("r.k").alias("kept_k"), F.col("r.rid").alias("kept_rid"))
    empty = found.where("`group` is null").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("kept_k"), F.col("rid").alias("kept_rid"))
    keep = first.union(empty).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # so that no name can clash
    keyed = docs.select(row, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("row_k"), F.xxhash64("doc_id", "text").alias("row_rid"))
    out = keyed.join(keep, (F.col("row_k") == F.col("kept_k")) & (F.col("row_rid") == F.col("kept_rid")), "left_semi")
    if not held.groupBy("r").count().where("count > 1").isEmpty():
        full = F.length(F.regexp_replace(F.coalesce(F.col("row.text"), F.lit("")), r"[\x20\x09-\x0D]+", "")) > 0
        out = out.where(full).dropDuplicates(["row_k", "row_rid"]).union(out.where(~full))
    return out.select("row.*")


#: The result of the registered query in the oracle's SQL.
SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON u = x.doc_id JOIN n y ON v = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT e.v, r.m FROM r JOIN e ON r.doc_id = e.u)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.m) AS component_id, d.doc_id = min(r.m) AS kept FROM d JOIN r ON d.doc_id = r.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id
"""

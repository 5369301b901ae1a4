"""Removal of long repeated passages, by a compressed FM-index per shard.

Every window of 50 words is routed by its smallest 8-word fingerprint, so equal windows meet in one shard. Consecutive
windows with the same fingerprint travel as one passage; equal passages are aggregated to their smallest doc_id before any
shuffle, and passages whose fingerprint only one document has are dropped, as they repeat nowhere. A shard's index is a
Burrows-Wheeler transform over its passages held in a wavelet matrix; backward search streams each passage through it,
keeping matching statistics capped at the window length, and reports the smallest doc_id of each window's interval.
A fingerprint with very many different passages (a phrase within a third of all documents, say) is split: its windows
are sharded one by one by their own hash, equal ones aggregated first, so that no shard grows with one key."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequery.llm.common import NO_ID, U64, Rolling, bounded, coded, discard, ids_of, materialize, mix, release, signed, slices, split_words, texts_of, word_hashes

WINDOW = 50
GRAM = 8
#: Different passages of one fingerprint from which its windows are sharded singly.
HOT = 2000
#: Passages an index shard holds on average.
SHARD_PASSAGES = 12_000


class Bits:
    """A bit vector with a 32-bit count for every 64 bits."""

    def __init__(self, bit: np.ndarray) -> None:
        packed = np.packbits(bit, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view(U64)
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1].astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        return self.counts[word] + np.bitwise_count(self.words[word] & ((U64(1) << (at & 63).astype(U64)) - U64(1))).astype(np.int64)


class WaveletMatrix:
    """Symbols of a sequence, one bit plane for each binary digit."""

    def __init__(self, values: np.ndarray, n_symbols: int) -> None:
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.planes, self.zeros = [], []
        v = values
        for level in range(self.levels - 1, -1, -1):
            bit = ((v >> level) & 1).astype(bool)
            self.planes.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            v = np.concatenate([v[~bit], v[bit]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place; adds the symbol's own start in the last plane, which `first` takes off."""
        at = at.copy()
        for k in range(self.levels):
            ones = self.planes[k].rank(at)
            bit = (symbols >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Index of passages (arrays of symbols from 1 on, each followed by a 0); each has an owner, the smallest doc_id that holds it."""

    def __init__(self, passages: np.ndarray, owners: np.ndarray, n_symbols: int, window: int = WINDOW) -> None:
        t, n, self.window = passages, len(passages), window
        rank, span, kept = t.astype(np.int32), 1, {}
        while True:  # suffixes in order of their first 2^k symbols, until that covers a window
            kept[span] = rank
            if span >= window:
                break
            second = np.full(n, -1, dtype=np.int64)
            second[: n - span if n > span else 0] = rank[span:]
            key = rank.astype(np.int64) * (max(n, n_symbols) + 2) + second + 1
            order = np.argsort(key, kind="stable")
            new = np.empty(n, dtype=np.int32)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank, span = new, span * 2
        order = np.argsort(rank, kind="stable")
        self.bwt = WaveletMatrix(t[order - 1], n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=n_symbols))])
        self.first = self.bwt.rank(np.arange(n_symbols), np.zeros(n_symbols, dtype=np.int64))
        self.n = n
        # suffixes with the same first window symbols, and with one less, as marks of where such a group begins
        full, short = self._opens(kept, order, window), self._opens(kept, order, window - 1)
        self.full, self.short = Bits(full), Bits(short)
        self.lowest = np.minimum.reduceat(owners[order], np.flatnonzero(full))
        self.short_lo = np.append(np.flatnonzero(short), n).astype(np.int32)

    def _opens(self, kept: dict[int, np.ndarray], order: np.ndarray, length: int) -> np.ndarray:
        """For each suffix, in their order, whether its first `length` symbols differ from those of the one before."""
        span = max(k for k in kept if k <= length)
        r, shift = kept[span], length - span
        there = np.full(self.n, -1, dtype=np.int32)
        there[: self.n - shift] = r[shift:] if shift else r
        a, b = r[order], there[order]
        return np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])

    def search(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of what they stand for with one more symbol in front."""
        both = self.bwt.rank(np.concatenate([symbols, symbols]), np.concatenate([lo, hi])) - np.tile(self.first[symbols], 2)
        return self.before[symbols] + both[: len(lo)], self.before[symbols] + both[len(lo) :]

    def owners(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """For each passage text[start:end], for each of its windows, the smallest owner of an equal window (all passages at once)."""
        n, length = len(starts), ends - starts
        lo, hi, matched = np.zeros(n, dtype=np.int64), np.full(n, self.n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        out = [np.full(max(0, k - self.window + 1), NO_ID, dtype=np.int64) for k in length]
        for step in range(int(length.max(initial=0))):
            on = np.flatnonzero(length > step)
            at = ends[on] - 1 - step
            full = matched[on] == self.window
            group = self.short.rank(lo[on] + 1) - 1
            lo[on] = np.where(full, self.short_lo[group], lo[on])
            hi[on] = np.where(full, self.short_lo[group + 1], hi[on])
            a, b = self.search(text[at], lo[on], hi[on])
            lo[on], hi[on] = a, b
            matched[on] = np.minimum(matched[on] + 1, self.window)
            done = np.flatnonzero((matched[on] == self.window) & (b > a))
            least = self.lowest[self.full.rank(a[done] + 1) - 1]
            for i, p, least_owner in zip(on[done], at[done] - starts[on[done]], least, strict=True):
                out[i][p] = least_owner
        return out


def passages_of(hashes: np.ndarray, starts: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text index, first word within the text, windows, fingerprint, hash) of each passage."""
    n = len(hashes)
    none = np.zeros(0, dtype=np.int64)
    if n < window:
        return none, none, none, none, none
    roll = Rolling(hashes)
    at = np.arange(n - gram + 1)
    least = mix(roll.of(at, at + gram) ^ U64(0x51ED270B))
    width, span = window - gram + 1, 1
    acc = least
    while span * 2 <= width:
        acc = np.minimum(acc[:-span], acc[span:])
        span *= 2
    if width > span:
        acc = np.minimum(acc[: len(acc) - (width - span)], acc[width - span :])
    # acc[i]: the smallest fingerprint of the window that starts at word i
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    first = np.arange(n - window + 1)
    valid = first + window <= starts[text[first] + 1]
    new = valid & np.concatenate([[True], (acc[1:] != acc[:-1]) | (text[first][1:] != text[first][:-1]) | ~valid[:-1]])
    begin = np.flatnonzero(new)
    if not len(begin):
        return none, none, none, none, none
    run = np.cumsum(new) - 1
    since = first - begin[np.maximum(run, 0)]
    new |= valid & (since > 0) & (since % width == 0)  # a run is cut into pieces of bounded length
    begin = np.flatnonzero(new)
    count = np.bincount((np.cumsum(new) - 1)[valid], minlength=len(begin))
    return text[begin], begin - starts[text[begin]], count, signed(acc[begin]), signed(roll.of(begin, begin + count + window - 1))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64("doc_id", "text").alias("rid"))


@bounded
def _cut(batches):
    for b in slices(batches):
        words, starts = split_words(texts_of(b))
        t, first, count, anchor, h = passages_of(word_hashes(words), starts)
        k, rid = np.asarray(ids_of(b, "k"), dtype=np.int64), np.asarray(ids_of(b, "rid"), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, h, k[t], rid[t], first.astype(np.int32), count.astype(np.int32))], names=["anchor", "h", "k", "rid", "first", "n"])


@bounded
def _fetch(batches):
    """Texts of the passages asked for; those of hot fingerprints window by window."""
    for b in slices(batches, limit=2_000_000):
        words, starts = split_words(texts_of(b))
        roll = Rolling(word_hashes(words))
        out: list[tuple] = []
        for i, wanted in enumerate(ids_of(b, "wanted")):
            for w in wanted:
                s = int(starts[i]) + w["first"]
                if not w["hot"]:
                    out.append((w["anchor"], w["h"], 0, w["h"], w["anchor"], w["k"], w["n"], b" ".join(words[s : s + w["n"] + WINDOW - 1])))
                    continue
                at = np.arange(s, s + w["n"])
                for j, u in enumerate(signed(roll.of(at, at + WINDOW)).tolist()):
                    out.append((w["anchor"], w["h"], j, u, u, w["k"], 1, b" ".join(words[s + j : s + j + WINDOW])))
        cols = list(zip(*out, strict=True)) or [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], names=["anchor", "h", "off", "unit", "key", "k", "n", "words"])


def search_shard(passages: pd.DataFrame) -> pd.DataFrame:
    """Index one shard's passages and stream them through it: per passage, stretches of windows with one smallest owner."""
    words, starts = split_words(list(passages["words"]))
    codes, distinct = coded(words)
    gaps = np.arange(len(passages) + 1)
    text = np.zeros(len(words) + len(passages), dtype=np.int64)
    place = np.arange(len(words)) + np.repeat(gaps[:-1], np.diff(starts))
    text[place] = codes + 1
    owner = np.repeat(passages["k"].to_numpy(), np.diff(starts) + 1)
    index = FMIndex(text, owner, len(distinct) + 1)
    anchor, unit, off, count, least = [], [], [], [], []
    for a, u, mins in zip(passages["anchor"], passages["unit"], index.owners(text, starts[:-1] + gaps[:-1], starts[1:] + gaps[:-1]), strict=True):
        cut = np.flatnonzero(np.concatenate([[True], mins[1:] != mins[:-1]]))
        anchor += [a] * len(cut)
        unit += [u] * len(cut)
        off += cut.tolist()
        count += np.diff(np.append(cut, len(mins))).tolist()
        least += mins[cut].tolist()
    return pd.DataFrame({"anchor": np.array(anchor, dtype=np.int64), "unit": np.array(unit, dtype=np.int64), "at": np.array(off, dtype=np.int32), "many": np.array(count, dtype=np.int32), "least": np.array(least, dtype=np.int64)})


@bounded
def _strip(batches):
    for b in slices(batches):
        doc, n_words, n_removed, digest, spans = ids_of(b, "doc_id"), [], [], [], []
        for t, covered in zip(texts_of(b), ids_of(b, "covered"), strict=True):
            words = t.split()
            merged: list[list[int]] = []
            for c in sorted((c["a"], c["b"]) for c in covered or ()):
                if merged and c[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], c[1])
                else:
                    merged.append(list(c))
            kept, last = [], 0
            for a, e in merged:
                kept += words[last:a]
                last = e
            kept += words[last:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            text = b" ".join(kept)
            digest.append((hashlib.sha256(text).hexdigest(), text.decode()))
            spans.append([{"first": a, "end": e} for a, e in merged])
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array([d for d, _ in digest], pa.string()), pa.array([t for _, t in digest], pa.string()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())])))],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "spans"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text and spans (removed word intervals) of every document.

    A word goes if a window of 50 words over it also starts in a document with a smaller doc_id. A null or empty text has
    no words. A null doc_id counts as larger than any other. Rows that share a doc_id are judged one by one and never
    against each other. Texts under 50 words lose nothing. Other columns are ignored."""
    spark = docs.sparkSession
    source = _keyed(docs)
    runs = materialize(source.select("k", "rid", "text").mapInArrow(_cut, "anchor long, h long, k long, rid long, first int, n int"), "repeats-runs")
    best = materialize(runs.groupBy("anchor", "h").agg(F.min(F.struct("k", "rid", "first", "n")).alias("r"), F.max("k").alias("top")), "repeats-distinct")
    release(spark)
    anchors = best.groupBy(F.col("anchor").alias("a")).agg(F.count("*").alias("many"), F.min("r.k").alias("lo"), F.max("top").alias("hi")).where("lo < hi").select("a", (F.col("many") > HOT).alias("hot"))
    wanted = best.join(anchors, best["anchor"] == anchors["a"]).select("r.k", "r.rid", F.struct("anchor", "h", "r.k", "r.first", "r.n", "hot").alias("w"))
    wanted = wanted.groupBy(F.col("k").alias("wk"), F.col("rid").alias("wrid")).agg(F.collect_list("w").alias("wanted"))
    texts = source.select("k", "rid", "text")
    asked = texts.join(wanted, (texts["k"] == wanted["wk"]) & (texts["rid"] == wanted["wrid"])).select("text", "wanted")
    pieces = materialize(asked.mapInArrow(_fetch, "anchor long, h long, off int, unit long, key long, k long, n int, words binary"), "repeats-pieces")
    discard(best)
    release(spark)
    # a passage is known by its fingerprint and its hash, 128 bits together
    units = pieces.groupBy("anchor", "unit").agg(F.min("k").alias("k"), F.first("key").alias("key"), F.first("n").alias("n"), F.first("words").alias("words"))
    shards = max(1, -(-pieces.count() // SHARD_PASSAGES))
    found = units.groupBy(F.pmod("key", F.lit(shards)).alias("shard")).applyInPandas(lambda pdf: search_shard(pdf), "anchor long, unit long, at int, many int, least long")
    found = materialize(found, "repeats-found")
    where = pieces.select(F.col("anchor").alias("pa"), F.col("h").alias("ph"), "off", F.col("unit").alias("pu")).distinct()
    stretches = where.join(found, (where["pa"] == found["anchor"]) & (where["pu"] == found["unit"])).select("pa", "ph", (F.col("off") + F.col("at")).alias("at"), "many", "least")
    hits = runs.join(stretches, (runs["anchor"] == stretches["pa"]) & (runs["h"] == stretches["ph"])).where("least < k").select(F.col("k").alias("hk"), F.col("rid").alias("hrid"), F.struct((F.col("first") + F.col("at")).alias("a"), (F.col("first") + F.col("at") + F.col("many") + WINDOW - 1).alias("b")).alias("c"))
    covered = materialize(hits.groupBy("hk", "hrid").agg(F.collect_set("c").alias("covered")), "repeats-covered")
    release(spark)
    discard(runs, pieces, found)
    full = source.select("doc_id", "k", "rid", "text")
    return full.join(covered, (full["k"] == covered["hk"]) & (full["rid"] == covered["hrid"]), "left").select("doc_id", "text", "covered").mapInArrow(_strip, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, spans array<struct<first:int,end:int>>")


#: The same result in the oracle's SQL.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
v AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT h, min(doc_id) AS lo FROM v GROUP BY h),
c AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i FROM v JOIN f USING (h) WHERE lo < doc_id), range(50) AS r(k)),
k AS (SELECT t.doc_id, count(*) AS n_words, count(c.p) AS n_removed, string_agg(word, ' ' ORDER BY t.p) FILTER (WHERE c.p IS NULL) AS kept FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.p = c.p GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

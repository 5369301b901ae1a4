"""Benchmark passages inside documents, by SimHash over item-sized windows.

The benchmark is a stated query set, gone through in blocks of bounded size, each broadcast. A window is as long as an item, or the whole
document where that is shorter but has shingles enough to reach the threshold. It is a candidate if so
many of its 5-word shingles occur in the block that the similarity can reach the threshold (a bound that loses nothing); its SimHash, over shingles
and the numbers of their occurrences, is looked up in a multi-index over eight blocks of eight bits, which returns every item fingerprint within the radius; the
weighted-shingle similarity (multisets of shingles, minimum over maximum of the counts) then decides."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.llm.common import U64, Rolling, bounded, mix, slices, small_batches, texts_of, word_hashes

SHINGLE = 5
#: Bytes of a block of the benchmark as it is broadcast: its texts, twice that for their shingles, and ITEM_BYTES for each item's entries in the index.
BLOCK_BYTES = 64_000_000
ITEM_BYTES = 2_400
#: Of 64 bits; numbered shingle sets of similarity 0.8 differ in 8 to 9.5 of them on average, with a deviation of 3, for items of 14 words and more (those of fewer must
#: share all shingles). tests/llm/test_recall.py counts what is missed, with repeated shingles too.
RADIUS = 23
#: A-Z become a-z, other ASCII but letters and digits a space; other bytes stay.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.IntegerType()), T.StructField("n_words", T.IntegerType())]))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    words: list[bytes] = []
    starts = [0]
    for t in texts:
        words += t.translate(TABLE).split()
        starts.append(len(words))
    return word_hashes(words), np.array(starts, dtype=np.int64)


def _numbered(grams: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Hash of a shingle and of its how-manieth occurrence it is."""
    return mix(grams + k.astype(U64) * U64(0x9E3779B97F4A7C15))


def _ones(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32)


def _sliding(grams: np.ndarray, count: int) -> np.ndarray:
    """SimHash of every window of `count` shingles. A window's set has a shingle's first occurrence, its second and so on, so the next window loses the last
    occurrence of the shingle that leaves, and gains one more of that which comes."""
    n = len(grams)
    _, code = np.unique(grams, return_inverse=True)
    order = np.argsort(code, kind="stable")
    places = code[order] * (n + 1) + order  # sorted by shingle and place
    start = np.searchsorted(code[order], code)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    rank -= start  # occurrences before

    def before(at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences before `end` of the shingle at `at`."""
        return np.searchsorted(places, code[at] * (n + 1) + end) - start[at]

    f = np.arange(n - count)
    leaves = _numbered(grams[f], before(f, f + count) - rank[f])
    comes = _numbered(grams[f + count], rank[f + count] + 1 - before(f + count, f + 1))
    votes = np.empty((n - count + 1, 64), dtype=np.int32)
    votes[0] = _ones(_numbered(grams[:count], rank[:count] + 1)).sum(axis=0)
    if len(f):
        votes[1:] = votes[0] + np.cumsum(_ones(comes) - _ones(leaves), axis=0, dtype=np.int32)
    return np.packbits(2 * votes > count, axis=1, bitorder="little").view(U64).ravel()


def fingerprints(grams: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """SimHash of each window of `count` shingles that starts at an ascending place of `first`. Occurrences of a shingle are numbered, as equal ones would vote as
    one block; so the weighted similarity of two windows is the plain one of what is hashed. Windows that overlap are gone through together."""
    out = np.zeros(len(first), dtype=U64)
    if not len(first):
        return out
    cuts = np.flatnonzero(np.diff(first) > count) + 1
    for lo, hi in zip(np.concatenate([[0], cuts]).tolist(), np.concatenate([cuts, [len(first)]]).tolist(), strict=True):
        at = lo
        while at < hi:  # at most 8192 places at a time
            end = max(at + 1, int(np.searchsorted(first[:hi], first[at] + 8192)))
            run = first[at:end]
            out[at:end] = _sliding(grams[run[0] : run[-1] + count], count)[run - run[0]]
            at = end
    return out


class MultiIndex:
    """Fingerprints by eight blocks of eight bits; every one within the radius of a query agrees with it in some block to radius // 8 bits."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS) -> None:
        self.prints, self.radius = prints, radius
        near = [np.flatnonzero(np.bitwise_count(np.arange(256) ^ v) <= radius // 8) for v in range(256)]
        self.tables = []
        for k in range(8):
            block = ((prints >> U64(8 * k)) & U64(255)).astype(np.int64)
            at = np.concatenate([near[v] for v in block]) if len(block) else np.zeros(0, dtype=np.int64)
            item = np.repeat(np.arange(len(prints)), [len(near[v]) for v in block])
            order = np.argsort(at, kind="stable")
            self.tables.append((np.concatenate([[0], np.cumsum(np.bincount(at, minlength=256))]), item[order]))

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (query, fingerprint) pairs within the radius."""
        codes = []
        for k, (ptr, items) in enumerate(self.tables):
            v = ((queries >> U64(8 * k)) & U64(255)).astype(np.int64)
            n = ptr[v + 1] - ptr[v]
            q = np.repeat(np.arange(len(queries)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + ptr[v][q]
            codes.append(q * max(1, len(self.prints)) + items[place])
        code = np.unique(np.concatenate(codes))
        q, i = code // max(1, len(self.prints)), code % max(1, len(self.prints))
        ok = np.bitwise_count(queries[q] ^ self.prints[i]) <= self.radius
        return q[ok], i[ok]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two sorted multisets."""
    x, m = np.unique(a, return_counts=True)
    y, n = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(m[i], n[j]).sum())
    return common / (len(a) + len(b) - common)


class Items:
    """A block of benchmark items, ready for search."""

    def __init__(self, items: list[tuple[int | None, bytes]], threshold: float, radius: int) -> None:
        self.threshold = threshold
        h, starts = words_of([t for _, t in items])
        roll = Rolling(h)
        self.by_length: dict[int, dict] = {}
        groups: dict[int, list[int]] = defaultdict(list)
        for i in range(len(items)):
            if n := int(starts[i + 1] - starts[i]):
                groups[n].append(i)
        every = []
        for n, members in groups.items():
            size = min(SHINGLE, n)
            grams = []
            for i in members:
                at = np.arange(starts[i], starts[i + 1] - size + 1)
                grams.append(np.sort(roll.of(at, at + size)))
                if n >= SHINGLE:
                    every.append(grams[-1])
            ids = [items[i][0] for i in members]
            if n < SHINGLE:
                self.by_length[n] = {"short": {int(g[0]): [k for k, x in zip(ids, grams, strict=True) if x[0] == g[0]] for g in grams}}
            else:
                prints = np.concatenate([fingerprints(g, np.zeros(1, dtype=np.int64), len(g)) for g in grams])
                self.by_length[n] = {"ids": ids, "grams": grams, "index": MultiIndex(prints, radius), "need": self._need(n - SHINGLE + 1, n - SHINGLE + 1)}
        self.grams = np.unique(np.concatenate(every)) if every else np.zeros(0, dtype=U64)
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.grams >> U64(44)).astype(np.int64)] = True
        self.least = min((self._need(math.ceil(threshold * c - 1e-9), c) for c in (n - SHINGLE + 1 for n, x in self.by_length.items() if "need" in x)), default=1 << 60)
        self.shorts = sorted(n for n, x in self.by_length.items() if "short" in x)

    def _need(self, window: int, count: int) -> int:
        """Shingles that a window and an item of so many must share to reach the threshold."""
        return math.ceil((window + count) * self.threshold / (1 + self.threshold) - 1e-9)

    def matches(self, texts: list[bytes]) -> list[list[dict]]:
        h, starts = words_of(texts)
        roll = Rolling(h)
        n = max(0, len(h) - SHINGLE + 1)
        grams = roll.of(np.arange(n), np.arange(n) + SHINGLE)
        hit = self.filter[(grams >> U64(44)).astype(np.int64)]
        there = np.flatnonzero(hit)
        if len(there) and len(self.grams):
            place = np.minimum(np.searchsorted(self.grams, grams[there]), len(self.grams) - 1)
            hit[there] = self.grams[place] == grams[there]
        total = np.concatenate([[0], np.cumsum(hit)])
        out: list[list[dict]] = []
        for i in range(len(texts)):
            a, b = int(starts[i]), int(starts[i + 1])
            best: dict = {}
            if b - a >= SHINGLE and total[b - SHINGLE + 1] - total[a] >= self.least:
                self._search(grams, total, a, b, best)
            for size in self.shorts:
                at = np.arange(a, max(a, b - size + 1))
                table = self.by_length[size]["short"]
                g = roll.of(at, at + size)
                for j in np.flatnonzero(np.isin(g, np.fromiter(table, dtype=U64))):
                    for item in table[int(g[j])]:
                        best.setdefault(item, (1.0, -int(j), size))
            out.append([{"item_id": k, "similarity": s, "first_word": -f, "n_words": m} for k, (s, f, m) in sorted(best.items(), key=lambda x: (x[0] is None, x[0] or 0))])
        return out

    def _search(self, grams: np.ndarray, total: np.ndarray, a: int, b: int, best: dict) -> None:
        for size, x in self.by_length.items():
            if "need" not in x:
                continue
            words, count, need = size, size - SHINGLE + 1, x["need"]
            if b - a < size:
                words, have = b - a, b - a - SHINGLE + 1
                if have < self.threshold * count - 1e-9:
                    continue
                count, need = have, self._need(have, count)
            first = np.arange(a, b - words + 1)
            first = first[total[first + count] - total[first] >= need]
            if not len(first):
                continue
            for q, i in zip(*x["index"].within(fingerprints(grams, first, count)), strict=True):
                at = int(first[q])
                s = similarity(grams[at : at + count], x["grams"][i])
                found = (s, -(at - a), words)
                if s >= self.threshold and found > best.get(x["ids"][i], (0.0, 0, 0)):
                    best[x["ids"][i]] = found


def _blocks(benchmark: DataFrame, block_bytes: int):
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("text is not null")
    total = texts.agg(F.sum(3 * F.octet_length("text") + ITEM_BYTES)).first()[0] or 0
    n = max(1, -(-total // block_bytes) * 2) if total > block_bytes else 1  # twice as many, as hashing is uneven
    for k in range(n):
        part = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else texts
        yield [(r["item_id"], r["text"].encode()) for r in part.collect()]


def _matching(held, clean: bool):
    def run(batches):
        for b in slices(batches, limit=1_000_000):
            found = held.value.matches(texts_of(b))
            if clean:
                yield b.filter(pa.array([not x for x in found], pa.bool_()))
            else:
                some = np.flatnonzero([bool(x) for x in found])
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int32()), ("n_words", pa.int32())]))
                yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")).take(pa.array(some)), pa.array([found[i] for i in some], kind)], names=["doc_id", "matches"])

    return bounded(run)


def find_matches(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, radius: int = RADIUS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words: the best window (the earliest of equals) for each document row and item it matches.
    A document shorter than an item is one window.

    Words are runs of letters and digits (ASCII punctuation separates, A-Z lower-cased). An item of fewer than five words is one shingle and
    matches where it occurs word for word. Null or empty texts and items match nothing; a null doc_id or item_id stays null;
    repeated rows match alike. Items that share an item_id, or have none, are one item with several texts, of which the best match counts in each block. No benchmark gives no rows. Other columns are ignored."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("matches", MATCH)])
    out = None
    for items in _blocks(benchmark, block_bytes):
        held = spark.sparkContext.broadcast(Items(items, threshold, radius))
        part = docs.select("doc_id", "text").mapInArrow(_matching(held, False), schema)
        out = part if out is None else out.union(part)
    return out.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.similarity", "m.first_word", "m.n_words")


def without_matches(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, radius: int = RADIUS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, that match no benchmark item. Null and empty texts match nothing and stay; repeated rows
    stay or go alike; without a benchmark, or of an empty table, all stay."""
    spark = docs.sparkSession
    small_batches(spark)
    for items in _blocks(benchmark, block_bytes):
        docs = docs.mapInArrow(_matching(spark.sparkContext.broadcast(Items(items, threshold, radius)), True), docs.schema)
    return docs

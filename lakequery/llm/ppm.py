"""Document scores by prediction by partial matching over bytes.

The trie is held as counts of five-symbol strings (four bytes of context, then a byte or the end): shorter contexts are
their sums. A byte unseen in its context escapes to the next shorter one with method C's estimate (distinct symbols over symbols plus
count), and what the longer context has seen is excluded there; below no context, all symbols left are alike. The trie
is counted over all training texts by Spark and goes to the workers in parts, split by the last two symbols of the context: every escape chain of
a position lies in one part down to two symbols of context, and what is shorter (257 x 258 counts at most) goes to all. A part holds
PART_STRINGS on average, and no less than its commonest pair of symbols has, which is a few hundredths of all. Each part costs one more pass over the texts. The word base needs each word's count: words that make up at least one in half a
million of all tokens (at most half a million words, by definition) are broadcast, the others joined."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.llm.common import U64, bounded, coded, hash64, ids_of, materialize, release, signed, slices, split_words, texts_of

ORDER = 4
END, PAD = 256, 257
SYMBOLS = 257
PAIR = (1 << 18) - 1
#: Strings a trie part holds on average, which bounds the broadcast.
PART_STRINGS = 3_000_000
#: A word is common if it makes up at least one in so many tokens.
COMMON = 500_000
END_TOKEN = b"\x00end"
#: Words or strings a task holds before it hands their counts on.
HELD = 1_000_000


def held_out(modulus: int = 7) -> Column:
    """crc32 of doc_id as text, modulo; remainder 2 is held out. A null doc_id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == 2, F.lit(False))


def strings(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Keys (nine bits a symbol) of every position of every text with its context, the end's position last; first index of each text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    s = np.full(int((sizes + order + 1).sum()), PAD, dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(sizes + order + 1)])
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    s[np.arange(len(flat)) + (at[:-1] + order - np.concatenate([[0], np.cumsum(sizes)])[:-1])[owner]] = flat
    s[at[1:] - 1] = END
    key = np.zeros(len(s), dtype=np.uint64)
    for k in range(order + 1):
        key[order:] |= s[k : len(s) - order + k] << U64(9 * (order - k))
    return key[s != PAD], np.concatenate([[0], np.cumsum(sizes + 1)])


def _add_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, dtype=np.int64)
    return k[first], np.add.reduceat(n, first) if len(k) else n


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token, each text's end last; first index of each text."""
    words, starts = split_words(texts, lower=True)
    codes, distinct = coded(words)
    n = np.diff(starts)
    out = np.empty(len(words) + len(texts), dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(n + 1)])
    out[at[1:] - 1] = hash64([END_TOKEN])[0]
    if words:
        out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), n)] = hash64(distinct)[codes]
    return out, at


def _count(order: int):
    def run(batches):
        held: list[list] = [[], []]
        for b in slices(batches, limit=2_000_000):
            texts = [t.lower() for t in texts_of(b)]
            for kind, (keys, _) in enumerate((strings(texts, order), _tokens(texts))):
                held[kind].append(np.unique(keys, return_counts=True))
                if sum(len(k) for k, _ in held[kind]) > HELD:
                    held[kind] = [_add_up(held[kind])]
                    if len(held[kind][0][0]) > HELD // 2:
                        yield _batch(kind, held[kind].pop())
        for kind in (0, 1):
            if held[kind]:
                yield _batch(kind, _add_up(held[kind]))

    return bounded(run)


def _batch(kind: int, counts: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    k, n = counts
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, dtype=np.int32)), pa.array(signed(k)), pa.array(n.astype(np.int64))], names=["kind", "key", "n"])


class Trie:
    """log10 probabilities of strings, from the counts of a part's strings and of all symbols."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, symbols: np.ndarray, order: int, pairs: tuple[np.ndarray, np.ndarray]) -> None:
        """symbols: training count of each of the 257 symbols; pairs: strings of one symbol of context with their counts, of all parts."""
        self.order, self.symbols = order, symbols
        self.grams, self.ctx, self.link = [None] * (order + 1), [None] * (order + 1), [None] * (order + 1)
        for j in range(order, 0, -1):
            g, n = _add_up([(keys & U64((1 << (9 * (j + 1))) - 1), counts)] if j > 1 else [pairs])
            c = g >> U64(9)
            first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, dtype=np.int64)
            total = np.add.reduceat(n, first) if len(c) else n
            kinds = np.diff(np.append(first, len(c)))
            self.grams[j], self.ctx[j] = (g, n), (c[first], total, kinds, first)
        for j in range(1, order + 1):  # what is left of the shorter context once this one's symbols are excluded
            g, _ = self.grams[j]
            c, _, kinds, first = self.ctx[j]
            if j == 1:
                shorter, t, d = symbols[(g & U64(511)).astype(np.int64)], np.full(len(c), symbols.sum()), np.full(len(c), (symbols > 0).sum())
            else:
                g1, n1 = self.grams[j - 1]
                shorter = n1[np.searchsorted(g1, g & U64((1 << (9 * j)) - 1))]
                place = np.searchsorted(self.ctx[j - 1][0], c & U64((1 << (9 * (j - 1))) - 1))
                t, d = self.ctx[j - 1][1][place], self.ctx[j - 1][2][place]
            taken = np.add.reduceat(shorter, first) if len(c) else shorter
            self.link[j] = (t - taken, d - kinds)
        self._table()

    def logp(self, keys: np.ndarray) -> np.ndarray:
        """By the escape chain; for keys whose last two symbols of context are in this part."""
        out = np.zeros(len(keys))
        open_ = np.arange(len(keys))
        total, kinds = np.full(len(keys), -1, dtype=np.int64), np.full(len(keys), -1, dtype=np.int64)  # after exclusion; -1: none
        for j in range(self.order, -1, -1):
            if not len(open_):
                return out
            k = keys[open_] & U64((1 << (9 * (j + 1))) - 1)
            if j:
                c, t, d, _ = self.ctx[j]
                at = np.minimum(np.searchsorted(c, k >> U64(9)), max(0, len(c) - 1))
                seen = (c[at] == k >> U64(9)) if len(c) else np.zeros(len(k), dtype=bool)
                g, n = self.grams[j]
                ga = np.minimum(np.searchsorted(g, k), max(0, len(g) - 1))
                count = np.where(g[ga] == k, n[ga], 0) if len(g) else np.zeros(len(k), dtype=np.int64)
                full_t, full_d = (t[at], d[at]) if len(c) else (count, count)
            else:
                seen = np.full(len(k), self.symbols.sum() > 0)
                count = self.symbols[k.astype(np.int64)]
                full_t, full_d = np.full(len(k), self.symbols.sum()), np.full(len(k), (self.symbols > 0).sum())
            use_t = np.where(total[open_] >= 0, total[open_], full_t)
            use_d = np.where(kinds[open_] >= 0, kinds[open_], full_d)
            base = use_t + use_d
            found = seen & (count > 0)
            out[open_[found]] += np.log10(count[found] / base[found])
            escape = seen & ~found & (base > 0)
            out[open_[escape]] += np.log10(use_d[escape] / base[escape])
            if j:
                total[open_[seen]], kinds[open_[seen]] = self.link[j][0][at[seen]], self.link[j][1][at[seen]]
            open_ = open_[~found]
        left = SYMBOLS - int((self.symbols > 0).sum())
        out[open_] += -np.log10(max(1, left))
        return out

    def _table(self) -> None:
        """Open addressing over the strings of training, with their log10 probabilities."""
        g, n = self.grams[self.order]
        self.bits = max(10, int(2 * len(g)).bit_length())
        self.slot_keys = np.full(1 << self.bits, 2**64 - 1, dtype=np.uint64)
        self.slot_logs = np.zeros(1 << self.bits)
        if not len(g):
            return
        p = self.logp(g)
        left, at = np.arange(len(g)), self._home(g)
        while len(left):
            free = self.slot_keys[at] == U64(2**64 - 1)
            self.slot_keys[at[free]] = g[left[free]]  # of several for one place the last stays
            won = self.slot_keys[at] == g[left]
            self.slot_logs[at[won]] = p[left[won]]
            left, at = left[~won], (at[~won] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def scores(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        hit = self.slot_keys[at] == keys
        out = np.where(hit, self.slot_logs[at], 0.0)
        left = np.flatnonzero(~hit)
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            there = self.slot_keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.slot_logs[at[hit]]
            miss = there == U64(2**64 - 1)
            if miss.any():
                lost, back = np.unique(keys[left[miss]], return_inverse=True)
                out[left[miss]] = self.logp(lost)[back]
            go = ~hit & ~miss
            left, at = left[go], at[go]
        return out


_TRIES: dict[str, Trie] = {}


def _trie(tag: str, held) -> Trie:
    if tag not in _TRIES:
        _TRIES.clear()
        _TRIES[tag] = Trie(*held.value)
    return _TRIES[tag]


def _score(tag: str, held, part: int, parts: int, common, order: int):
    def run(batches):
        trie = _trie(tag, held)
        for b in slices(batches, limit=2_000_000):
            texts = [t.lower() for t in texts_of(b)]
            keys, starts = strings(texts, order)
            if parts > 1:
                mine = ((keys >> U64(9)) & U64(PAIR)) % U64(parts) == U64(part)
                logs = np.zeros(len(keys))
                logs[mine] = trie.scores(keys[mine])
            else:
                logs = trie.scores(keys)
            score = np.add.reduceat(logs, starts[:-1])
            row = b.column(b.schema.get_field_index("row"))
            if common is None:
                yield pa.RecordBatch.from_arrays([row, pa.array(score)], names=["row", "score"])
                continue
            words, counts = common.value
            tokens, first = _tokens(texts)
            owner = np.repeat(np.arange(len(texts)), np.diff(first))
            at = np.minimum(np.searchsorted(words, tokens), max(0, len(words) - 1))
            is_common = (words[at] == tokens) if len(words) else np.zeros(len(tokens), dtype=bool)
            n_common = np.bincount(owner[is_common], minlength=len(texts))
            logs = np.bincount(owner[is_common], weights=np.log10(counts[at[is_common]] + 1.0) if len(words) else None, minlength=len(texts)) if is_common.any() else np.zeros(len(texts))
            rest, whose = tokens[~is_common], owner[~is_common]
            ends = np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(texts)))]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(rest)))
            yield pa.RecordBatch.from_arrays(
                [row, *(b.column(b.schema.get_field_index(c)) for c in ("doc_id", "held_out")), pa.array(np.diff(first)), pa.array(n_common.astype(np.int64)), pa.array(logs.astype(np.float64)), rare, pa.array(score)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_common", "common_logs", "rare", "score"],
            )

    return bounded(run)


def score_documents(docs: DataFrame, modulus: int = 7, order: int = ORDER, part_strings: int = PART_STRINGS, common: int = COMMON) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    score is the log10 probability that the model, trained on the rows not held out, gives the UTF-8 bytes of the text (A-Z
    lower-cased) and its end; base_score that of a word model with one added to each count. A null text is empty: its end alone
    is scored. Rows that share a doc_id are scored each. Without training rows all symbols and words are alike. Other
    columns are ignored."""
    spark = docs.sparkSession
    source = docs.select("doc_id", "text", held_out(modulus).alias("held_out"))
    counts = source.where("not held_out").select("text").mapInArrow(_count(order), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "ppm-counts")
    release(spark)
    grams, words = counts.where("kind = 0"), counts.where("kind = 1")
    short = grams.groupBy(F.col("key").bitwiseAND(PAIR).alias("s")).agg(F.sum("n").alias("n")).toArrow()  # 257 x 258 rows at most
    pairs = (short["s"].to_numpy().astype(np.uint64), short["n"].to_numpy()) if short.num_rows else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    symbols = np.bincount((pairs[0] & U64(511)).astype(np.int64), weights=pairs[1], minlength=512).astype(np.int64)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = words.where(F.col("n") * common >= F.lit(int(total["n"]))).select("key", "n").toArrow()
    keys = top["key"].to_numpy().astype(np.int64).view(np.uint64) if top.num_rows else np.zeros(0, dtype=np.uint64)
    sort = np.argsort(keys)
    held_common = spark.sparkContext.broadcast((keys[sort], top["n"].to_numpy()[sort] if top.num_rows else np.zeros(0, dtype=np.int64)))
    parts = max(1, -(-grams.count() // part_strings))
    rows = source.withColumn("row", F.monotonically_increasing_id())
    if parts > 1:  # scored once a part: row numbers must stay the same
        rows = materialize(rows, "ppm-rows")
    first, others = None, []
    for part in range(parts):
        mine = grams if parts == 1 else grams.where(F.pmod(F.shiftrightunsigned("key", 9).bitwiseAND(PAIR), F.lit(parts)) == part)
        t = mine.select("key", "n").toArrow()
        k, n = (t["key"].to_numpy().astype(np.int64).view(np.uint64), t["n"].to_numpy()) if t.num_rows else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
        held = spark.sparkContext.broadcast((k, n, symbols, order, pairs))
        run = _score(uuid.uuid4().hex, held, part, parts, None if part else held_common, order)
        if part == 0:
            kind = docs.schema["doc_id"].dataType.simpleString()
            first = materialize(rows.mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_common long, common_logs double, rare array<long>, score double"), "ppm-scored")
        else:
            others.append(materialize(rows.select("row", "text").mapInArrow(run, "row long, score double"), "ppm-more"))
        held.unpersist()
        del t, k, n
    release(spark)
    rare = first.select("row", F.explode("rare").alias("w"))
    hits = rare.join(words.select("key", "n"), F.col("w") == F.col("key"))
    hits = hits.groupBy(F.col("row").alias("hrow")).agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1.0)).alias("rare_logs"))
    out = first.drop("rare").join(hits, F.col("row") == F.col("hrow"), "left")
    score = F.col("score")
    if others:
        sums = reduce(DataFrame.union, others).groupBy(F.col("row").alias("orow")).agg(F.sum("score").alias("more"))
        out = out.join(sums, F.col("row") == F.col("orow"))
        score = score + F.col("more")
    base = F.col("common_logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * F.log10(F.lit(float(total["n"] + total["v"] + 1)))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_common") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(int(total["n"])).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))

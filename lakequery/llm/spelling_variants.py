"""Spelling variants of the corpus's words: words one edit apart, each with its commonest neighbour as form.

Where two words differ by one edit, one half of the first is in the other unchanged. A minimal acyclic automaton of the words, read forward, finds
those with the same first half: it matches that half exactly and completes the rest with one error. A second automaton, of the words read
backward, does so for the other half. Each state counts the words that can still be completed from it, so a path tells its word's number in
sorted order, and the automaton needs no words at its ends. Both directions can find the same word; duplicates go.

Words are dealt to automata by the half that must be equal: an asking word of length l by its first l // 2 letters and by its others, and every word
under what it would share with asking words of its own length, one more and one less. Where a half is shared by more words than one automaton should
hold, the other half, in which the error lies, is halved again: either part of it may hold the error, and the other one then narrows the group. No word is ever
compared with a whole group, and an automaton holds a bounded number of words."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.llm.common import bounded, discard, ids_of, materialize, slices

#: A-Z to a-z; what is no letter of Latin-1 ends a run. Characters beyond Latin-1 come as question marks.
LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 192 else 32 for i in range(256))
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Rows for one automaton; a group that shares a half is no larger, or is halved again.
BLOCK = 40_000
DROP, SHORTEST, LEAST, RATIO = 199, 6, 5, 5


def counted_words(doc_id, text: str | None, shortest: int = SHORTEST, drop: int = DROP) -> Counter:
    """Occurrences of the words of a text. A run whose checksum, with the document's id before it, is a multiple of `drop` loses one letter."""
    runs = (text or "").encode("latin-1", "replace").translate(LETTERS).split()
    found = Counter(r for r in runs if len(r) >= shortest)
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter()
    for run, n in found.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
        if h % drop == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < shortest:
                continue
        out[run] += n
    return out


def _counted(shortest: int, drop: int):
    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for b in slices(batches):
            for k, t in zip(ids_of(b, "doc_id"), ids_of(b, "text"), strict=True):
                for w, n in counted_words(k, t, shortest, drop).items():
                    held[w] += n
            if len(held) >= HELD:
                yield batch(held)
                held.clear()
        if held:
            yield batch(held)

    return bounded(run)


class Automaton:
    """Minimal acyclic automaton of distinct words in sorted order. arcs[s] maps a letter to the next state and to the number of words
    that come before those beyond it; final has the states where a word ends."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.words: list[int] = []  # below each state
        self._known: dict[tuple, int] = {}
        path: list[tuple[list[str], list[int]]] = [([], [])]  # letters and states of the open states' arcs; the last letter's state is still open
        ends = [False]
        before = ""
        for w in words:
            same, most = 0, min(len(w), len(before))
            while same < most and w[same] == before[same]:
                same += 1
            self._close(path, ends, same)
            for c in w[same:]:
                path[-1][0].append(c)
                path.append(([], []))
                ends.append(False)
            ends[-1] = True
            before = w
        self._close(path, ends, 0)
        self.root = self._state(ends[0], *path[0])

    def _close(self, path, ends, depth: int) -> None:
        """Open states below a depth can get no further arcs: each is one that is known, or new."""
        while len(path) > depth + 1:
            state = self._state(ends.pop(), *path.pop())
            path[-1][1].append(state)

    def _state(self, final: bool, letters: list[str], states: list[int]) -> int:
        key = (final, "".join(letters), tuple(states))
        known = self._known.get(key)
        if known is None:
            known = self._known[key] = len(self.arcs)
            arcs, n = {}, int(final)
            for c, s in zip(letters, states, strict=True):
                arcs[c] = (s, n)
                n += self.words[s]
            self.arcs.append(arcs)
            self.final.append(final)
            self.words.append(n)
        return known

    def number(self, word: str) -> int | None:
        """Of a word, its place in sorted order."""
        state, n = self.root, 0
        for c in word:
            arc = self.arcs[state].get(c)
            if arc is None:
                return None
            state, n = arc[0], n + arc[1]
        return n if self.final[state] else None

    def near(self, word: str, exact: int, last: int) -> set[int]:
        """Numbers of the words that differ from `word` by one edit, which begins at a place from `exact` to `last`."""
        arcs, final, found = self.arcs, self.final, set()

        def rest(state: int, n: int, i: int) -> None:
            for c in word[i:]:
                arc = arcs[state].get(c)
                if arc is None:
                    return
                state, n = arc[0], n + arc[1]
            if final[state]:
                found.add(n)

        state, n, size = self.root, 0, len(word)
        for i in range(size + 1):
            here = arcs[state]
            if i >= exact:
                if i < size:
                    mine, after = word[i], word[i + 1] if i + 1 < size else None
                    if after is None or after in here:
                        rest(state, n, i + 1)  # without this letter
                    for c, (to, skip) in here.items():
                        if c != mine and (after is None or after in arcs[to]):
                            rest(to, n + skip, i + 1)  # another one in its place
                        if mine in arcs[to]:
                            rest(to, n + skip, i)  # one more before it
                else:
                    for to, skip in here.values():
                        if final[to]:
                            found.add(n + skip)
                if i == last:
                    break
            arc = here.get(word[i]) if i < size else None
            if arc is None:
                break
            state, n = arc[0], n + arc[1]
        return found


def _matched(limit: int):
    """Near words (word, n, near, near_n) of the asking rows of each block; a block ends where a key does."""
    names = ("key", "word", "n", "back", "asks", "exact", "last")

    def block(rows: list[list]):
        out: tuple[list, ...] = ([], [], [], [])
        for back in (False, True):
            mine = [r for r in zip(*rows, strict=True) if r[3] == back]
            turn = (lambda w: w[::-1]) if back else (lambda w: w)
            counts = {turn(r[1]): r[2] for r in mine}
            words = sorted(counts)
            if len(words) < 2:
                continue
            automaton = Automaton(words)
            for _, word, n, _, asks, exact, last in mine:
                if asks:
                    own = turn(word)
                    for i in automaton.near(own, exact, last):
                        if words[i] != own:
                            for column, v in zip(out, (word, n, turn(words[i]), counts[words[i]]), strict=True):
                                column.append(v)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["word", "n", "near", "near_n"])

    def run(batches):
        rows: list[list] = [[] for _ in names]
        for b in batches:
            for column, c in zip(rows, names, strict=True):
                column += ids_of(b, c)
            if len(rows[0]) > limit:
                cut = bisect_left(rows[0], rows[0][-1])  # the last key may go on
                if cut:
                    yield block([x[:cut] for x in rows])
                    rows = [x[cut:] for x in rows]
        if rows[0]:
            yield block(rows)

    return bounded(run)


def _dealt(words: DataFrame, shortest: int) -> DataFrame:
    """Each word under both halves that it would share with asking words of each length at most one apart from its own; lo and hi bound the
    part of the asking word in which the error lies."""
    size = F.length("word")
    df = words.select("word", "n", size.alias("size"), F.explode(F.array(size - 1, size, size + 1)).alias("ask")).where(F.col("ask") >= shortest)
    half = F.floor(F.col("ask") / 2).cast("int")
    parts = F.explode(F.array(F.struct(half.alias("lo"), F.col("ask").alias("hi"), F.lit(False).alias("back")), F.struct(F.lit(0).alias("lo"), half.alias("hi"), F.lit(True).alias("back"))))
    return _keyed(df.select("word", "n", "size", "ask", parts.alias("p")).select("word", "n", "size", "ask", "p.*"))


def _keyed(df: DataFrame) -> DataFrame:
    """With the key of what must be equal: the letters before lo, and those from hi on, counted from the end."""
    shared = F.left("word", F.col("lo")), F.right("word", F.col("ask") - F.col("hi"))
    return df.withColumn("key", F.xxhash64("ask", "lo", "hi", *shared))


def _halved(df: DataFrame) -> DataFrame:
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.explode(F.array(F.struct(mid.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), mid.alias("hi"))))
    return _keyed(df.select("word", "n", "size", "ask", "back", parts.alias("p")).select("word", "n", "size", "ask", "p.*", "back"))


def near_words(words: DataFrame, shortest: int = SHORTEST, block: int = BLOCK) -> DataFrame:
    """Pairs (word, n, near, near_n), in both directions, of distinct words at one edit; words has word and n, with words of at least shortest code points.
    A pair can come more than once."""
    rows, done = materialize(_dealt(words, shortest), "spelling-halves"), None
    while True:
        many = rows.where("hi - lo > 1").groupBy(F.col("key").alias("mk")).agg(F.count("*").alias("m")).where(F.col("m") > block).select("mk")
        many = materialize(many, "spelling-crowded")
        if many.isEmpty():
            break
        few = rows.join(many, rows["key"] == many["mk"], "left_anti")
        done = few if done is None else done.union(few)
        rows = materialize(_halved(rows.join(many, rows["key"] == many["mk"], "left_semi")), "spelling-halves")
    rows = rows if done is None else done.union(rows.select(*done.columns))
    exact, last = (F.when(F.col("back"), b).otherwise(f).alias(x) for x, b, f in (("exact", F.col("ask") - F.col("hi"), F.col("lo")), ("last", F.col("ask") - F.col("lo"), F.col("hi"))))
    rows = rows.select("key", "word", "n", "back", (F.col("ask") == F.col("size")).alias("asks"), exact, last)
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(_matched(block), "word string, n long, near string, near_n long")


def word_counts(docs: DataFrame, least: int = LEAST, shortest: int = SHORTEST, drop: int = DROP) -> DataFrame:
    """word, n of every word with at least `least` occurrences; see counted_words."""
    words = docs.select("doc_id", "text").mapInArrow(_counted(shortest, drop), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def spelling_groups(docs: DataFrame, least: int = LEAST, shortest: int = SHORTEST, drop: int = DROP, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word with at least `least` occurrences and `shortest` code points.

    Words are runs of ASCII letters and of the characters U+00C0 to U+00FF, with only A-Z lower-cased; a checksum of doc_id and run takes a letter out
    of some. Near are words at one inserted, deleted or replaced code point. A word's form is its near word with the largest n
    (of equals the first in code-point order) if that is at least ratio times its own n, and null otherwise; the root is where the forms end, the word itself
    without one. A null text has no words; a null doc_id counts as an empty text in the checksum. Repeated rows count each
    time. An empty table gives no rows. Other columns are ignored."""
    words = materialize(word_counts(docs, least, shortest, drop), "spelling-words")
    pairs = near_words(words, shortest, block).repartition("word")  # a word has as many rows as it has neighbours, each a few times
    best = pairs.groupBy(F.col("word").alias("w")).agg(F.count_distinct("near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form"))).alias("b"))
    first = -F.col("b.m")
    rows = words.join(best, words["word"] == best["w"], "left")
    holds = first >= ratio * F.col("n")
    rows = materialize(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(holds, F.col("b.form")).alias("form"), F.when(holds, first).alias("form_n")), "spelling-forms")
    roots = _roots(rows.where("form is not null").select("word", F.col("form").alias("root")))
    roots = roots.select(F.col("word").alias("rw"), "root")
    return rows.join(roots, rows["word"] == roots["rw"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root) with every step followed to its end. Each round follows twice as many steps as the one before; as n grows by the ratio with each, five rounds at most."""
    steps = materialize(steps, "spelling-steps")
    while True:
        on = steps.select(F.col("word").alias("w"), F.col("root").alias("further"))
        moved = materialize(steps.join(on, steps["root"] == on["w"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-steps")
        discard(steps)
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        steps = moved


#: The result of the registered query in the oracle's SQL: the checksum byte by byte, and neighbours by the words' deletions.
SQL = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+') AS w FROM documents),
r AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(w) AS w FROM d) WHERE length(w) >= 6 GROUP BY id, w),
b AS (SELECT w, n, flatten(list_transform(string_split(id || ':' || w, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END)) AS bytes FROM r),
h AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, c: xor(a >> 8, t[xor(a, c) % 256 + 1]))) AS h FROM b, t),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM h) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word)))::INT AS i FROM v)),
p AS (SELECT a.word, b.word AS near FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word UNION SELECT x.word, v.word FROM x JOIN v ON v.word = x.rest UNION SELECT v.word, x.word FROM x JOIN v ON v.word = x.rest),
q AS (SELECT p.word, p.near, v.n, row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, p.near) AS k, count(*) OVER (PARTITION BY p.word) AS n_near FROM p JOIN v ON v.word = p.near),
f AS (SELECT v.word, v.n, coalesce(q.n_near, 0) AS n_near, CASE WHEN q.n >= 5 * v.n THEN q.near END AS form, CASE WHEN q.n >= 5 * v.n THEN q.n END AS form_n FROM v LEFT JOIN q ON q.word = v.word AND q.k = 1),
s AS (SELECT word, coalesce(form, word) AS root FROM f UNION SELECT s.word, f.form FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL),
e AS (SELECT s.word, s.root FROM s JOIN f ON f.word = s.root WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM f JOIN e ON e.word = f.word
"""

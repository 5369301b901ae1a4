"""Audit of how far the sources of a language diverge, by inclusion-exclusion over supports.

Each group (language, source) has a smoothed distribution over the language's kept terms, in whole billionths:
p(c) = 1 + (2 + c) * SCALE / (N + 2 V), rounded down, for a term the group holds c times. Two groups differ in a term by f(p, q) = (p - q)^2 / (p + q), rounded down. The
sum of f over all V terms never visits a term that neither group holds. With z = p(0) of either group it is

    V f(z, z') + sum over g's terms of [f(p, z') - f(z, z')] + the same of h's terms + sum over shared terms of [f(p, p') - f(p, z') - f(z, p') + f(z, z')]

The first part is a constant. The second and third depend on a term's count alone, so a histogram of each group's counts prices them. Only the
fourth needs the terms of both, from a join of postings by term. All of it is whole numbers, and so exact in any order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import bounded, discard, materialize, slices, small_batches

SCALE = 1_000_000_000
#: A-Z to a-z; all other characters of ASCII but a-z end a term, and every byte of any other character is part of one.
LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i > 127 else 32 for i in range(256))
COUNTED = "lang string, source string, term string, n long, d long"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, and the text each is from."""
    at = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = bytes(memoryview(data)[at[0] : at[-1]]).translate(LETTERS) if data is not None else b""
    lists = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), pa.py_buffer((at - at[0]).astype(np.int32)), pa.py_buffer(data)))
    terms, owner = lists.flatten(), np.asarray(pc.list_parent_indices(lists), dtype=np.int64)
    full = pc.not_equal(terms, "")
    return terms.filter(full), owner[full.to_numpy(zero_copy_only=False)]


@bounded
def _counted(batches):
    """Occurrences (n) and documents (d) of each term, by group, of a few megabytes of texts at a time."""
    for b in slices(batches, limit=8_000_000):
        lang, source, text = (b.column(b.schema.get_field_index(c)) for c in ("lang", "source", "text"))
        terms, owner = terms_of(text)
        if not len(terms):
            continue
        coded = terms.dictionary_encode()
        size = len(coded.dictionary)
        pair, n = np.unique(owner * size + coded.indices.to_numpy(), return_counts=True)  # of a text and a term
        langs, sources = lang.dictionary_encode(), source.dictionary_encode()
        group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        _, group = np.unique(group, return_inverse=True)
        first = np.zeros(group.max() + 1, dtype=np.int64)
        first[group] = np.arange(len(group))  # a text of each group
        key = group[pair // size] * size + pair % size
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        of = pa.array(first[key[starts] // size])
        d = np.diff(np.append(starts, len(key)))
        yield pa.RecordBatch.from_arrays([lang.take(of), source.take(of), coded.dictionary.take(pa.array(key[starts] % size)), pa.array(np.add.reduceat(n, starts)), pa.array(d)], names=["lang", "source", "term", "n", "d"])


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + SCALE * (count + 2) / (total + 2 * kept), rounded down; long division digit group by digit group, so that no product leaves a long.
    Null where no term is kept."""
    whole = F.nullif(total + 2 * kept, F.lit(0))
    out, rest = F.lit(0).cast("long"), count + 2
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + _div(rest, whole), rest % whole
    return out + 1


def _div(a: Column, b: Column) -> Column:
    """Of whole numbers that are not negative."""
    return F.call_function("div", a, b)


def _f(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def source_divergence(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: for each occurring group (lang, source), part `pair` has its divergence from each other
    source of the language, and part `term` the top terms by which the group exceeds the language as a whole.

    Null text, lang and source are read as ''. Terms are runs of ASCII letters and of all characters beyond ASCII, with only A-Z lower-cased; a
    language keeps those in at least least_docs of its documents. Each row counts as a document, repeated rows too, whatever its
    doc_id. A group without terms has rows of part `pair` only; a language with one source has none; without kept terms
    values are 0. Ranks go by value, largest first, then by item as UTF-8. An empty table gives no rows. Other columns are ignored."""
    small_batches(docs.sparkSession)
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = plain.mapInArrow(_counted, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    # one row for each source that has the term
    of_term = W.partitionBy("lang", "term")
    counts = counts.withColumns({"docs": F.sum("d").over(of_term), "lang_n": F.sum("n").over(of_term), "first": F.col("source") == F.min("source").over(of_term)})
    postings = materialize(counts.where(F.col("docs") >= least_docs).select("lang", "source", "term", "n", "lang_n", "first"), "divergence-postings")

    sums = postings.groupBy(F.col("lang").alias("sl"), F.col("source").alias("ss")).agg(F.sum("n").alias("total"), F.count_if("first").alias("kept"))
    groups = plain.select("lang", "source").distinct()
    groups = groups.join(sums, (F.col("lang") == F.col("sl")) & (F.col("source") == F.col("ss")), "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    groups = materialize(groups.select(F.monotonically_increasing_id().alias("gid"), "*"), "divergence-sums")
    langs = groups.groupBy(F.col("lang").alias("ll")).agg(F.sum("total").alias("lang_total"), F.sum("kept").alias("v"))
    groups = groups.join(langs, groups["lang"] == langs["ll"]).select("gid", "lang", "source", "total", "lang_total", "v", _p(F.lit(0).cast("long"), F.col("total"), F.col("v")).alias("z"))
    groups = materialize(groups, "divergence-groups")

    g = groups.select("gid", F.col("lang").alias("gl"), F.col("source").alias("gs"), "total", "lang_total", "v", "z")
    priced = postings.join(g, (postings["lang"] == g["gl"]) & (postings["source"] == g["gs"]))
    priced = priced.select("gid", "lang", "source", "term", "n", "z", _p(F.col("n"), F.col("total"), F.col("v")).alias("p"), _p(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"))
    priced = materialize(priced, "divergence-priced")
    discard(postings)

    by_item = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= top)

    pairs = _pairs(groups, priced)
    both = F.explode(F.array(F.struct(F.col("as").alias("source"), F.col("bs").alias("item")), F.struct(F.col("bs").alias("source"), F.col("as").alias("item"))))
    pairs = pairs.select("lang", "value", both.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    return pairs.withColumn("rank", F.row_number().over(by_item)).union(terms.select("lang", "source", "part", "item", "value", "rank"))


def _pairs(groups: DataFrame, priced: DataFrame) -> DataFrame:
    """lang, as, bs, value for each two groups of a language, once."""
    # one-sided terms: a group's histogram of counts against each p(0) that occurs in its language
    hist = priced.groupBy("gid", "lang", "p", "z").agg(F.count("*").alias("terms"))
    zeros = groups.select(F.col("lang").alias("zl"), F.col("z").alias("oz")).distinct()
    one = hist.join(zeros, hist["lang"] == zeros["zl"]).groupBy("gid", "oz").agg(F.sum(F.col("terms") * (_f(F.col("p"), F.col("oz")) - _f(F.col("z"), F.col("oz")))).alias("one"))
    one = materialize(one, "divergence-one-sided")
    # shared terms: postings of a term meet
    side = lambda s: priced.select(*(F.col(c).alias(s + c) for c in ("gid", "lang", "term", "p", "z")))
    a, b = side("a"), side("b")
    met = a.join(b, (a["alang"] == b["blang"]) & (a["aterm"] == b["bterm"]) & (a["agid"] < b["bgid"]))
    p, q, z, y = (F.col(c) for c in ("ap", "bp", "az", "bz"))
    shared = met.groupBy("agid", "bgid").agg(F.sum(_f(p, q) - _f(p, y) - _f(z, q) + _f(z, y)).alias("shared"))
    shared = shared.select(F.col("agid").alias("xg"), F.col("bgid").alias("yg"), "shared")
    # the constant of both-zero terms, and the parts together
    a, b = (groups.select(*(F.col(c).alias(s + c[0]) for c in ("gid", "lang", "source", "v", "z"))) for s in "ab")
    out = a.join(b, (a["al"] == b["bl"]) & (a["ag"] < b["bg"]))
    by = lambda s: one.select(F.col("gid").alias(s + "og"), F.col("oz").alias(s + "oz"), F.col("one").alias(s + "one"))
    out = out.join(by("a"), (F.col("ag") == F.col("aog")) & (F.col("bz") == F.col("aoz")), "left").join(by("b"), (F.col("bg") == F.col("bog")) & (F.col("az") == F.col("boz")), "left")
    out = out.join(shared, (F.col("ag") == F.col("xg")) & (F.col("bg") == F.col("yg")), "left")
    parts = [F.col("av") * _f(F.col("az"), F.col("bz")), F.col("aone"), F.col("bone"), F.col("shared")]
    value = sum((F.coalesce(x, F.lit(0)) for x in parts), F.lit(0).cast("long"))
    return out.select(F.col("al").alias("lang"), "as", "bs", value.alias("value"))


#: The result of the registered query in the oracle's SQL: every group against every term.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT k) AS docs FROM (SELECT k, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
dense AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS lang_n FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT lang, source, sum(n) AS total FROM dense GROUP BY lang, source),
p AS (SELECT dense.lang, dense.source, term, n, (1 + 1000000000::HUGEINT * (n + 2) // (s.total + 2 * v))::HUGEINT AS p, (1 + 1000000000::HUGEINT * (lang_n + 2) // (l.total + 2 * v))::HUGEINT AS q
    FROM dense JOIN s ON s.lang = dense.lang AND s.source = dense.source JOIN l ON l.lang = dense.lang),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, b.source AS item FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
r AS (SELECT every.lang, every.source, 'pair' AS part, every.item, coalesce(value, 0)::BIGINT AS value FROM every LEFT JOIN pair ON pair.lang = every.lang AND pair.source = every.source AND pair.item = every.item
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

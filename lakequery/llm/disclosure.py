"""Personal data, and the terms that give it away, in DataFrame operations alone.

Base entities are found by patterns and checks. The corpus then tells how strongly a term near an entity discloses it: with N
documents, n(t) that hold the term, n(e) that hold the entity and n(t,e) that hold the term near the entity, the
entity's share is p = n(e) / N and the term's certainty (n(t,e) - p n(t)) / ((n(t) + PRIOR) (1 - p)): how far the term raises the odds of the
entity from its share towards one, were the term also in PRIOR documents that hold the entity by that share. It depends on shares, not
on N. A term above the threshold is generalised to its class (name, number, code or word) wherever it occurs, or removed where its certainty is
high; its bits, log2(N n(t,e) / (n(t) n(e))), are told only.

Secrets are protected like the base entities, and terms that give them away are looked for alike: strings of at least 20 letters, digits,
hyphens and underscores, with four letters and four digits, whose characters carry three bits each or more by their own frequencies.

Patterns are written so that the regular expression engine neither restarts inside a run of characters nor nests groups
without bound: separators inside a number or a domain become one private character first, which keeps all places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
#: A secret's length, digits and letters, and bits a character, at least.
SECRET_CHARS, SECRET_EACH, SECRET_BITS = 20, 4, 3.0
#: Code points of context on either side of an entity.
CONTEXT = 64
#: Documents added to a term's own, so that a few sightings count for less than many.
PRIOR = 2
LEAST_CERTAINTY = 0.5
REMOVE_CERTAINTY = 0.9
#: Terms up to which a term table is broadcast (about 100 bytes each); a larger one is joined by shuffle.
BROADCAST_TERMS = 100_000
JOINED, OTHER = "\ue000", "\ue001"
TERM = r"[\p{L}\p{N}]+"


def _matches(text: Column, pattern: str) -> tuple[Column, Column]:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _joined(text: Column, pattern: str) -> Column:
    return F.regexp_replace(F.replace(text, F.lit(JOINED), F.lit(OTHER)), pattern, JOINED)


def _sources(text: Column) -> dict[str, tuple[Column, Column, str]]:
    """For each kind: whether a text can hold one, the text to search, and the pattern."""
    return {
        "email": (F.contains(text, F.lit("@")), _joined(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])"), rf"(?:(?<![A-Za-z0-9._%+{JOINED}-])|\G)[A-Za-z0-9._%+{JOINED}-]++@[A-Za-z0-9-]+{JOINED}[A-Za-z0-9{JOINED}-]*"),
        "ip": (F.rlike(text, F.lit(r"[0-9]\.[0-9]+\.[0-9]")), text, r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"),
        "card": (F.rlike(text, F.lit(r"[0-9](?:[ -]?[0-9]){13}")), _joined(text, r"(?<=[0-9])[ -](?=[0-9])"), rf"[0-9][0-9{JOINED}]+"),
        "phone": (F.contains(text, F.lit("+")), text, r"\+[0-9][ ().0-9-]+[0-9]"),
        "secret": (F.rlike(text, F.lit(f"[A-Za-z0-9_-]{{{SECRET_CHARS}}}")), text, rf"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{{{SECRET_CHARS},}}+"),
    }


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def char_bits(v: Column) -> Column:
    """Bits a character of a text carries by the frequencies of its own characters."""
    n = F.length(v).cast("double")
    counts = F.transform(F.array_distinct(F.split(v, "")), lambda c: n - F.length(F.replace(v, c, F.lit(""))))
    return F.aggregate(F.filter(counts, lambda k: k > 0), F.lit(0.0), lambda a, k: a - k / n * F.log2(k / n))


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    n = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": F.forall(F.split(v, r"\.", -1), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False))),
        "card": F.when((n >= 14) & (n <= 19), _luhn(digits)).otherwise(F.lit(False)),
        "phone": (n >= 10) & (n <= 15),
        "secret": (n >= SECRET_EACH) & (F.length(F.regexp_replace(v, "[^A-Za-z]", "")) >= SECRET_EACH) & (char_bits(v) >= SECRET_BITS),
    }[kind]


def _placed(found: Column, gaps: Column) -> Column:
    """Matches with their places, from the stretches between them."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("n"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))
    step = lambda a, s: F.struct((a["at"] + s["g"] + s["n"]).alias("at"), F.concat(a["out"], F.array(F.struct((a["at"] + s["g"]).alias("start"), (a["at"] + s["g"] + s["n"]).alias("end"), s["m"].alias("value")))).alias("out"))
    return F.aggregate(steps, start, step, lambda a: a["out"])


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _spans(kind: str, rank: int) -> Column:
    """Valid matches of a kind as spans."""
    m, g = F.col(f"_e_{kind}"), F.col(f"_g_{kind}")
    placed = F.when(F.size(m) > 0, _placed(m, g)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    good = F.filter(placed, lambda s: _valid(kind, s["value"]))
    return F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.replace(s["value"], F.lit(JOINED), F.lit(".")).alias("value"))).cast(SPAN)


def find_entities(docs: DataFrame) -> DataFrame:
    """docs with `_e_spans`, base entities by start, then kind as listed, and `_x_spans`, those and the secrets that overlap none. A null text has
    none; repeated rows have the same."""
    text = F.col("text")
    df = docs
    for kind, (can, source, pattern) in _sources(text).items():
        found, gaps = _matches(source, pattern)
        none = F.array().cast("array<string>")
        df = df.withColumns({f"_e_{kind}": F.when(can, found).otherwise(none), f"_g_{kind}": F.when(can, gaps).otherwise(none)})
    all_spans = [_spans(kind, rank) for rank, kind in enumerate(KINDS)]
    df = df.select(*(F.col(f"`{c}`") for c in docs.columns), F.array_sort(F.concat(*all_spans)).alias("_e_spans"), _spans("secret", len(KINDS)).alias("_s_spans"))
    return df.withColumn("_x_spans", F.array_sort(F.concat("_e_spans", _apart("_s_spans", "_e_spans")))).drop("_s_spans")


def _apart(spans: str | Column, others: str) -> Column:
    return F.filter(spans, lambda s: ~F.exists(others, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _near(text: Column, s: Column) -> Column:
    """Terms near an entity; one that the context's edge cuts is left out, which the code point beyond the edge tells."""
    left = F.substring(text, F.greatest(F.lit(1), s["start"] - CONTEXT), F.least(s["start"], F.lit(CONTEXT + 1)))
    left = F.when(s["start"] > CONTEXT, F.regexp_replace(left, f"^{TERM}", "")).otherwise(left)
    right = F.substring(text, s["end"] + 1, F.lit(CONTEXT + 1))
    right = F.when(F.length(right) > CONTEXT, F.regexp_replace(right, f"{TERM}$", "")).otherwise(right)
    return _terms(F.concat_ws(" ", left, right))


def _class(v: Column) -> Column:
    """What a term is generalised to."""
    return F.when(F.rlike(v, F.lit(r"^\p{N}+$")), "NUMBER").when(F.rlike(v, F.lit(r"\p{N}")), "CODE").when(F.rlike(v, F.lit(r"^\p{Lu}")), "NAME").otherwise("WORD")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a table of terms only once its size is known to be bounded."""
    return F.broadcast(df) if df.count() <= BROADCAST_TERMS else df


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(term, bits, certainty, remove) of the terms above the threshold. found: docs with entities alone. Rows that share a doc_id, or are
    repeated, count each; a null text has no terms."""
    pairs = found.select(
        F.array_distinct(
            F.flatten(F.transform("_x_spans", lambda s: F.transform(_near(F.col("text"), s), lambda t: F.struct(F.xxhash64(s["kind"], s["value"]).alias("e"), t.alias("term")))))
        ).alias("p"),
        F.array_distinct(F.transform("_x_spans", lambda s: F.xxhash64(s["kind"], s["value"]))).alias("es"),
    )
    least = LEAST_CERTAINTY * PRIOR / (1 - LEAST_CERTAINTY)  # as certainty <= n_te / (n_te + PRIOR), fewer documents cannot reach it
    near = materialize(pairs.select(F.explode("p").alias("p")).groupBy("p.e", "p.term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= least), "disclosure-pairs")
    entities = pairs.select(F.explode("es").alias("ee")).groupBy("ee").agg(F.count("*").alias("n_e"))
    candidates = materialize(near.select(F.col("term").alias("ct")).distinct(), "disclosure-candidates")
    used = docs.select(F.explode(_terms(F.col("text"))).alias("t")).groupBy("t").agg(F.count("*").alias("n_t"))
    n_t = used.join(_small(candidates), F.col("t") == F.col("ct")).select("t", "n_t")  # inner: a semi join would go below the counts
    total = docs.select("doc_id").count()
    both = near.join(entities, near["e"] == entities["ee"]).join(n_t, F.col("term") == F.col("t"))
    n, n_te = F.lit(float(total)), F.least("n_te", "n_t")  # beside letters an entity can end a term that is longer elsewhere
    certainty = F.try_divide(n * n_te - F.col("n_e") * F.col("n_t"), (F.col("n_t") + PRIOR) * (n - F.col("n_e")))  # null where all documents hold the entity
    bits = F.log2(n * n_te / (F.col("n_t") * F.col("n_e")))
    strong = both.select("term", certainty.alias("certainty"), bits.alias("bits")).where(F.col("certainty") >= LEAST_CERTAINTY)
    return materialize(strong.groupBy("term").agg(F.max("bits").alias("bits"), F.max("certainty").alias("certainty")).withColumn("remove", F.col("certainty") >= REMOVE_CERTAINTY), "disclosure-terms")


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_term, n_private (all spans), sanitised of every document.

    Places are code points, ends exclusive. `sanitised` is the text with entities replaced by their kind in brackets, generalised terms by their
    class, and removed terms left out; of overlapping spans the first counts. A null text is empty and stays null there.
    Terms inside an entity stay with it. Rows that share a doc_id are judged each; other columns are ignored."""
    source = docs.select("doc_id", "text")
    based = find_entities(source)
    found = materialize(based.where(F.size("_x_spans") > 0), "disclosure-entities")
    terms = disclosing_terms(source, found)
    keyed = source.select(F.xxhash64("doc_id", "text").alias("rid"), F.explode(_terms(F.col("text"))).alias("t"))
    hits = keyed.join(_small(terms.select(F.col("term").alias("ft"), "remove")), F.col("t") == F.col("ft"))
    hits = materialize(hits.groupBy("rid").agg(F.collect_set("t").alias("told"), F.collect_set(F.when(F.col("remove"), F.col("t"))).alias("gone")), "disclosure-hits")
    full = based.withColumn("_k", F.xxhash64("doc_id", "text")).join(hits, F.col("_k") == F.col("rid"), "left")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join("told", "|"), F.lit(r")(?![\p{L}\p{N}])"))
    none = F.array().cast("array<string>")
    full = full.withColumns({"_e_term": F.when(F.col("rid").isNotNull(), F.regexp_extract_all("text", pattern, F.lit(0))).otherwise(none), "_g_term": F.when(F.col("rid").isNotNull(), F.split("text", pattern, -1)).otherwise(none)})
    placed = F.when(F.size("_e_term") > 0, _placed(F.col("_e_term"), F.col("_g_term"))).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    free = _apart(placed, "_x_spans")
    extra = F.transform(free, lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS) + 1).alias("rank"), s["end"].alias("end"), F.lit("term").alias("kind"), s["value"].alias("value"))).cast(SPAN)
    full = full.withColumn("_all", F.array_sort(F.concat("_x_spans", extra)))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("_all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    shown = lambda s: F.when(F.coalesce(F.array_contains("gone", F.lower(s["value"])), F.lit(False)) & (s["kind"] == "term"), F.lit("")).otherwise(F.concat(F.lit("["), F.when(s["kind"] == "term", _class(s["value"])).otherwise(F.upper(s["kind"])), F.lit("]")))
    step = lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), shown(s)).alias("out")))
    clean = F.aggregate("_all", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return full.select("doc_id", *(count(k) for k in KINDS), F.sha2(listed("_e_spans"), 256).alias("base_sha256"), listed("_all").alias("spans"), count("secret"), count("term"), F.size("_all").cast("long").alias("n_private"), F.when(F.size("_all") > 0, clean).otherwise(F.col("text")).alias("sanitised"))

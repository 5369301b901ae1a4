"""Text functions as Column expressions; the two without a built-in are Arrow UDFs."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Trailing legal forms of company names, the other words an acronym skips, and what counts as true.
LEGAL_SUFFIXES = ("inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "plc", "llc", "lp", "llp", "sa", "ag", "nv", "bv", "spa", "srl", "gmbh", "pte", "pty", "holdco")
STOP_WORDS = ("the", "of", "and", "for", "a", "an")
TRUE_WORDS = ("1", "true", "t", "yes", "y")


def fresh(taken, *names: str) -> list[str]:
    """The names, each with as many underscores before it as none of the taken ones has in any case, so that working columns clash with no column."""
    used, mark = {c.lower() for c in taken}, "_"
    while any((mark + n).lower() in used for n in names):
        mark += "_"
    return [mark + n for n in names]


def norm_name(c: Column) -> Column:
    """Lower case, every run of other than a-z and 0-9 one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def legal_core(normalised: Column) -> Column:
    """A normalised name without its trailing legal forms, however many."""
    return F.trim(F.regexp_replace(normalised, "(?:(?:^| )(?:" + "|".join(LEGAL_SUFFIXES) + ")(?= |$))+$", ""))


def acronym(core: Column) -> Column:
    """First letters of a core's words but stop words and legal forms; empty for fewer than two."""
    words = F.filter(F.split(core, " "), lambda w: (w != "") & ~w.isin(*STOP_WORDS, *LEGAL_SUFFIXES))
    return F.when(F.size(words) >= 2, F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")).otherwise("")


def compact(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def letter_counts(c: Column) -> Column:
    """How often each of a-z and 0-9 stands in a compact name."""
    return F.array(*(F.length(c) - F.length(F.replace(c, F.lit(x), F.lit(""))) for x in "abcdefghijklmnopqrstuvwxyz0123456789"))


def ratio_bound(length_a: Column, length_b: Column, letters_a: Column, letters_b: Column) -> Column:
    """What sequence_ratio can reach at most: letters that both have, whatever their order."""
    common = F.aggregate(F.zip_with(letters_a, letters_b, lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
    return F.lit(2.0) * common / (length_a + length_b)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of a to b, in this order (it is not symmetric)."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.StringType())
def nfkc(c: pd.Series) -> pd.Series:
    return c.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).lower().split()))


def cik10(c: Column) -> Column:
    """A company number as ten digits; a trailing .0 goes, other than digits gives null, longer stays whole."""
    d = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(d.rlike("^[0-9]+$"), F.when(F.length(d) < 10, F.lpad(d, 10, "0")).otherwise(d))


def try_bigint(c: Column) -> Column:
    """Text to integer, fractions rounded half away from zero and exponents allowed; null otherwise."""
    return F.coalesce(c.try_cast("bigint"), F.round(c.try_cast("double")).try_cast("bigint"))


def ratio(total: Column, count: Column) -> Column:
    return F.when(count != 0, total / count)


def truthy(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c.cast("string"), F.lit("")))).isin(*TRUE_WORDS)


def url_file(url: Column) -> Column:
    """Last path segment of a URL without its query."""
    return F.element_at(F.split(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), "/"), -1)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def looks_html(c: Column) -> Column:
    return F.lower(F.ltrim(F.substring(c, 1, 2048))).rlike("^<(!doctype html|html|head>)")


def human_bytes(c: Column) -> Column:
    """Size with a binary unit and one decimal."""
    out = F.format_string("%.1f TiB", c / F.lit(float(1 << 40)))
    for unit, power in (("GiB", 30), ("MiB", 20), ("KiB", 10)):
        out = F.when(c < (1 << (power + 10)), F.format_string(f"%.1f {unit}", c / F.lit(float(1 << power)))).otherwise(out)
    return F.when(c < 1024, F.format_string("%d B", c.cast("long"))).otherwise(out)


def http_diagnosis(code: Column) -> Column:
    """What a status code means for a fetch."""
    return F.when(code == 304, "unchanged").when(code.between(200, 299), "ok").when(code.isin(401, 403), "forbidden").when(code == 404, "missing").when(code == 429, "throttled").when(code >= 500, "server error").otherwise("unexpected")


def choose_ocr(text: Column, ocr: Column) -> Column:
    """The OCR text where the embedded one is short and the OCR clearly longer."""
    return F.when((F.length(text) < 40) & (F.length(ocr) > F.length(text) + 20), ocr).otherwise(text)


def key_path(key: Column) -> Column:
    """Entity and file of a storage key: the segment after `data`, and the rest joined."""
    parts = F.split(key, "/")
    at = F.array_position(parts, "data").cast("int")
    return F.when(at > 0, F.struct(F.try_element_at(parts, at + 1).alias("entity"), F.array_join(F.slice(parts, at + 1, F.size(parts)), "/").alias("relative")))

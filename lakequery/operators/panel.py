"""Panels of measurements: probes to ids, replicates, results of a list of targets, and tolerances. Moderated statistics are not here."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequery.functions.rank import benjamini_hochberg
from lakequery.functions.text import fresh


def only_id(text: Column, pattern: str) -> Column:
    """The one id that a text names, in capitals; null if it names none, or several."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(0)), lambda x: F.upper(x)))
    return F.when(F.size(found) == 1, found[0])


def log2_values(values: Column) -> Column:
    """log2 of each value; a value of 0 gives minus infinity and one below it NaN."""
    return F.transform(values, lambda v: F.when(v == 0, F.lit(float("-inf"))).when(v < 0, F.lit(float("nan"))).otherwise(F.log2(v)))


def average_replicates(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The mean of each column over the rows of an id; rows without an id, or with a value that is no finite number, are left out."""
    finite = reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) for c in columns))
    return df.where(F.col(key).isNotNull() & finite).groupBy(key).agg(*(F.avg(c).alias(c) for c in columns))


def target_results(targets: DataFrame, results: DataFrame, on: str, columns: list[str], dataset: str, contrast: str) -> DataFrame:
    """Every target with its row of results, null where there is none, and the false-discovery rate among the distinct probes of the panel."""
    other, probe = fresh([*targets.columns, *columns], "other", "probe")
    found = results.select(F.col(on).alias(other), *columns)
    rows = targets.join(found, F.col(on) == F.col(other), "left").drop(other).withColumns({"dataset": F.lit(dataset), "contrast": F.lit(contrast)})
    panel = benjamini_hochberg(rows.select(on, "PValue").distinct(), "PValue", "FDR_panel").select(F.col(on).alias(probe), "FDR_panel")
    return rows.join(panel, F.col(on) == F.col(probe), "left").drop(probe)


def bound(tables: list[DataFrame], columns: list[str]) -> DataFrame:
    """Rows of several result sets, one after the other, by their common columns."""
    return reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])


def differs(a: str, b: Column, tolerance: float = 1e-12) -> Column:
    """Whether two numbers are further apart than a tolerance."""
    return F.abs(F.col(a) - b) > tolerance

"""Change detection in the state store over several runs, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakequery.streaming import keyed_state as ks

T0 = dt.datetime(2026, 1, 1)


def put(spark, path, rows):
    df = spark.createDataFrame([(k, s, e, m, p, T0 + dt.timedelta(hours=h)) for k, s, e, m, p, h in rows], ks.OBSERVED)
    df.coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, gone="10 hours"):
    watched = spark.readStream.schema(ks.OBSERVED).parquet(f"{tmp_path}/in")
    assert ks.record_changes(spark, watched, f"{tmp_path}/out", f"{tmp_path}/ck", gone_after=gone)
    return sorted(((r.key, (r.at - T0).total_seconds() / 3600, r.event, r.etag) for r in spark.read.schema(ks.CHANGES).parquet(f"{tmp_path}/out").collect()), key=str)


def test_over_restarts(spark, tmp_path):
    src = f"{tmp_path}/in"
    put(spark, src, [("a", "OK", "e1", "m", 1, 0), ("b", "FAILED", None, None, 2, 0), ("c", "OK", "e1", None, 3, 0), ("d", "OK", None, None, 4, 0)])
    assert [x[2] for x in run(spark, tmp_path)] == ["new", "failed", "new", "new"]
    # changed, failed then good, unchanged, and an answer without validators
    put(spark, src, [("a", "OK", "e2", "m", 5, 2), ("b", "OK", "e1", None, 6, 2), ("c", "OK", "e1", None, 7, 2), ("c", "FAILED", None, None, 8, 3), ("d", "OK", None, None, 9, 2), (None, "OK", "x", None, 10, 2), ("e", "OK", "x", None, 11, None or 2)])
    got = run(spark, tmp_path)
    assert [x for x in got if x[1] >= 2] == [("a", 2.0, "changed", "e2"), ("b", 2.0, "new", "e1"), ("c", 2.0, "unchanged", "e1"), ("c", 3.0, "failed", None), ("d", 2.0, "changed", None), ("e", 2.0, "new", "x")]
    # c's last good state has outlived its failure; UNCHANGED keeps a key alive
    put(spark, src, [("c", "OK", "e1", None, 12, 9), ("a", "UNCHANGED", None, None, 13, 9)])
    assert [x for x in run(spark, tmp_path) if x[1] == 9] == [("a", 9.0, "unchanged", None), ("c", 9.0, "unchanged", "e1")]
    # b, d and e have not been seen for ten hours; then b comes again
    put(spark, src, [("a", "OK", "e2", "m", 14, 13)])
    got = run(spark, tmp_path)
    assert [x for x in got if x[2] == "vanished"] == [("b", 12.0, "vanished", "e1"), ("d", 12.0, "vanished", None), ("e", 12.0, "vanished", "x")]
    put(spark, src, [("b", "OK", "e1", None, 15, 14), ("a", "FAILED", None, None, 16, 14)])
    got = run(spark, tmp_path)
    assert [x for x in got if x[1] == 14] == [("a", 14.0, "failed", None), ("b", 14.0, "new", "e1")]
    assert run(spark, tmp_path) == got  # nothing new, nothing twice
    told = {(r.key, r.etag, r.modified) for r in ks.validators(spark.read.schema(ks.CHANGES).parquet(f"{tmp_path}/out")).collect()}
    assert told == {("b", "e1", None), ("c", "e1", None)}  # a failed last, d and e vanished


@pytest.mark.parametrize("seed", [1])
def test_random_batches(spark, tmp_path, seed):
    r = random.Random(seed)
    state, want, p = {}, [], 0
    for batch in range(3):
        rows = []
        for _ in range(60):
            p += 1
            key, status = r.choice("abcdefg"), r.choice(["OK", "OK", "FAILED", "UNCHANGED"])
            etag = r.choice(["1", "2", None]) if status == "OK" else None
            rows.append((key, status, etag, None, p, batch * 100 + p % 50))
        put(spark, f"{tmp_path}/in", rows)
        for key, status, etag, _, at, h in sorted(rows, key=lambda x: (x[5], x[4])):
            event = ks.judged(status, etag, None, (state[key], None) if key in state else None)
            if status == "OK":
                state[key] = etag
            want.append((key, float(h), event, etag))
        got = run(spark, tmp_path, gone="400 hours")
    assert got == sorted(want, key=lambda x: (x[0], x[1], x[2], x[3])) if all(x[3] is not None for x in want) else sorted(map(str, got)) == sorted(map(str, want))
    assert {x[2] for x in want} == {"new", "changed", "unchanged", "failed"}


def test_empty_stream(spark, tmp_path):
    spark.createDataFrame([], ks.OBSERVED).write.parquet(f"{tmp_path}/in")
    watched = spark.readStream.schema(ks.OBSERVED).parquet(f"{tmp_path}/in")
    assert ks.record_changes(spark, watched, f"{tmp_path}/out", f"{tmp_path}/ck")
    assert ks.validators(spark.createDataFrame([], ks.CHANGES)).count() == 0 and F is not None

"""Change detection over a stream of observations, with the last good state of each key held by Spark's state store.

Each observation says how a look at a key went. What has been seen of a key before, in this or an earlier run, decides what it means; a key that nothing is seen of for
a while is told as vanished by a timer of event time. A restart goes on from the checkpoint."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OBSERVED = "key string, status string, etag string, modified string, position long, at timestamp"
CHANGES = "key string, event string, etag string, modified string, position long, at timestamp"
STATE = "etag string, modified string, status string, good boolean, due long"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def judged(status: str, etag: str | None, modified: str | None, before: tuple | None) -> str:
    """What an observation means, after the last good etag and time (None without any): new, changed, unchanged or failed. An answer that is OK
    without etag and time can't be told from a change."""
    if status == "UNCHANGED":
        return "unchanged"
    if status != "OK":
        return "failed"
    if before is None:
        return "new"
    return "unchanged" if (etag, modified) == before and (etag is not None or modified is not None) else "changed"


def _plain(x):
    return None if x is None or x is pd.NaT or x != x else x


class ChangeProcessor(StatefulProcessor):
    """Of each key the last good etag and time, how the last look went, and when the key counts as vanished."""

    def __init__(self, gone_after_ms: int) -> None:
        self.gone_after_ms = gone_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        looks = pd.concat(list(rows)).sort_values(["at", "position"], kind="stable")  # of one key and batch
        etag, modified, status, good, due = self.seen.get() if self.seen.exists() else (None, None, None, False, None)
        out, last = [], None
        for r in looks.itertuples(index=False):
            e, m = _plain(r.etag), _plain(r.modified)
            event = judged(r.status, e, m, (etag, modified) if good else None)
            if r.status == "OK":
                etag, modified, good = e, m, True
            status, last = r.status, r.at
            out.append((key[0], event, e, m, r.position, r.at))
        if due is not None:
            self.handle.deleteTimer(due)
        ms = int(last.timestamp() * 1000) + self.gone_after_ms
        due = ms if due is None else max(ms, due)
        self.handle.registerTimer(due)
        self.seen.update((etag, modified, status, good, due))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        etag, modified, _, _, due = self.seen.get()
        self.seen.clear()
        yield self._frame([(key[0], "vanished", etag, modified, None, pd.Timestamp(due, unit="ms"))])

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        df = pd.DataFrame(rows, columns=["key", "event", "etag", "modified", "position", "at"])
        return df.astype({"position": "Int64", "at": "datetime64[us]"})

    def close(self) -> None:
        pass


def changes(observed: DataFrame, gone_after: str = "30 days", late: str = "0 seconds") -> DataFrame:
    """Rows of CHANGES of a stream of OBSERVED: one for each observation, in the order of at and position in each batch, and one when a key vanishes: when event
    time, less `late`, is past its last observation by gone_after. A key that comes again after that is new. After a failure the last good
    state still decides whether the next answer is a change. Observations without a key or a time are left out."""
    seconds = observed.sparkSession.sql(f"SELECT CAST(INTERVAL {gone_after} AS INTERVAL DAY TO SECOND) AS i").first()["i"].total_seconds()
    looks = observed.where("key is not null and at is not null").withWatermark("at", late)
    return looks.groupBy("key").transformWithStateInPandas(statefulProcessor=ChangeProcessor(int(seconds * 1000)), outputStructType=CHANGES, outputMode="Append", timeMode="EventTime")


def record_changes(spark: SparkSession, observed: DataFrame, target: str, checkpoint: str, gone_after: str = "30 days", late: str = "0 seconds", timeout: int | None = None) -> bool:
    """Append the changes of all observations that no earlier call has taken to Parquet at target; each once, also over restarts. False if the timeout came first."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)
    try:
        q = changes(observed, gone_after, late).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    done = q.awaitTermination(timeout) if timeout else (q.awaitTermination() or True)
    if not done:
        q.stop()
    return bool(done)


def validators(changes: DataFrame) -> DataFrame:
    """key, etag, modified to ask with, from recorded changes: of keys whose last look was good; the etag is that of the last new or changed answer."""
    from lakequery.functions.rank import top_n

    order = [F.desc("at"), F.desc_nulls_first("position")]  # a vanishing has no position and comes last
    last = top_n(changes, ["key"], order).where(F.col("event").isin("new", "changed", "unchanged")).select("key")
    good = top_n(changes.where(F.col("event").isin("new", "changed")), ["key"], order)
    return good.join(last, "key", "left_semi").select("key", "etag", "modified")

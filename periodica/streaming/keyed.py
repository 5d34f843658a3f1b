"""W2 as keyed state: each publisher's last issues in the state store of a streaming query.

A publisher is a key. Its state is a map from issue to value and reason and the newest issue it has seen. Results
may arrive in any order: one that is a window or more older than the newest issue seen before it is refused and
handed on as a row of its own; any other sets its cell. Cells that leave the window go at once, and by a timer
on the clock of arrivals where a publisher falls silent.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions import fixed

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "publisher long, issue int, value string, reason string, seq long, kind string"
CHANGE = Row("publisher", "issue", "value", "reason", "seq", "kind")
GRACE = "1 second"  # by which the clock of arrivals runs behind


class LastIssues(StatefulProcessor):
    """Rows in: publisher, issue, value, reason, seq (order of arrival), at (time of arrival). Rows out: OUTPUT, of kind
    `held` for each cell that was set, `refused` for each late result, `expired` for each cell that left the window."""

    def __init__(self, start: datetime, window: int = fixed.WINDOW):
        self.start, self.window = start, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "issue int", "value string, reason string")
        self.newest = handle.getValueState("newest", "issue int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        publisher = key[0]
        newest = self.newest.get()[0] if self.newest.exists() else None
        before, touched, refused = newest, {}, []
        for r in sorted(rows, key=lambda r: r.seq):
            if newest is not None and r.issue <= newest - self.window:
                refused.append(CHANGE(publisher, r.issue, r.value, r.reason, r.seq, "refused"))
                continue
            newest = r.issue if newest is None else max(newest, r.issue)
            touched[r.issue] = r
        if newest != before:
            self.newest.update((newest,))
            yield from self.without(publisher, [i for i in self.held() if i <= newest - self.window])
        for issue, r in touched.items():
            if issue > newest - self.window:
                if not self.cells.containsKey((issue,)):
                    self.handle.registerTimer(self.expiry(issue))
                self.cells.updateValue((issue,), (r.value, r.reason))
                yield CHANGE(publisher, issue, r.value, r.reason, r.seq, "held")
        yield from refused

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        yield from self.without(key[0], [i for i in self.held() if self.expiry(i) <= now])

    def held(self) -> list[int]:
        return [k[0] for k in self.cells.keys()]

    def without(self, publisher, issues: list[int]) -> Iterator[Row]:
        for issue in issues:
            self.cells.removeKey((issue,))
            yield CHANGE(publisher, issue, None, None, None, "expired")

    def expiry(self, issue: int) -> int:
        """When the arrivals' clock says that no run can ask for the issue any more: milliseconds."""
        return int((self.start + timedelta(days=issue - 1 + self.window)).timestamp() * 1000)

    def close(self) -> None:
        pass


def keyed_stream(results: DataFrame, path: str, checkpoint: str, start: datetime = datetime(2024, 1, 1, tzinfo=UTC), window: int = fixed.WINDOW) -> StreamingQuery:
    """A streaming query from `results` (publisher, issue, value, reason, seq, at) to Parquet files of OUTPUT and the
    batch's number below `path`. A batch that runs again replaces its own folder. Issue 1 is the day `start`.

    Two outputs of one state: `held_cells` and `refused_results` read them. Needs the RocksDB state store, which is set for
    this query. A null publisher is a key of its own; a row without issue or seq is left out.
    """
    spark = results.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)  # read when the query starts
    try:
        own = results.where("issue IS NOT NULL AND seq IS NOT NULL").withWatermark("at", GRACE)
        changes = own.groupBy("publisher").transformWithState(LastIssues(start, window), OUTPUT, "Update", "EventTime")

        def write(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

        return changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def changes(spark, path: str) -> DataFrame:
    return spark.read.schema(f"{OUTPUT}, batch long").parquet(path)


def held_cells(log: DataFrame) -> DataFrame:
    """publisher, issue, value, reason as the state holds them: of each cell the last change, unless it expired. In a
    batch results come before timers, and a result sets no cell that it lets expire."""
    order = F.struct("batch", F.col("kind") == "expired")
    last = log.where("kind != 'refused'").groupBy("publisher", "issue").agg(F.max_by(F.struct("value", "reason", "kind"), order).alias("x"))
    return last.where("x.kind = 'held'").select("publisher", "issue", "x.value", "x.reason")


def refused_results(log: DataFrame) -> DataFrame:
    return log.where("kind = 'refused'").select("seq", "publisher", "issue", "value", "reason")

"""The rolling state as a stream: results arrive by issue, late ones within the window."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import fixed
from ..operators import rolling


class StateStore:
    """Versions of the state below a folder all executors see. A version holds the state, or, where there are
    faults in all of its issues, points to the version that goes on being the state; the faults; and the log of results
    that wait: those of every issue that was refused, with the version that refused it and the fault."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def holder(self, version: int) -> int | None:
        """The version whose state is that of `version`; None before the first good one."""
        return self.spark.read.parquet(f"{self.root}/pointer-{version}").first()["version"] if version >= 0 else None

    def read(self, version: int) -> DataFrame | None:
        held = self.holder(version)
        return None if held is None else self.spark.read.parquet(f"{self.root}/state-{held}")

    def faults(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/faults-{version}")

    def waiting(self, version: int) -> DataFrame | None:
        """publisher, issue, value, reason, version, fault of results that wait after `version`."""
        return self.spark.read.parquet(f"{self.root}/waiting-{version}") if version >= 0 else None

    def write(self, state: DataFrame | None, version: int, faults: DataFrame, waiting: DataFrame | None = None) -> None:
        """All that `version` has. A null state leaves the last one, and so do faults unless what has them waits. The
        pointer comes last, so that a version is there as a whole or not at all, and a batch that is run again writes the same."""
        faults.write.mode("overwrite").parquet(f"{self.root}/faults-{version}")
        if waiting is not None:
            waiting.write.mode("overwrite").parquet(f"{self.root}/waiting-{version}")
        good = state is not None and (waiting is not None or self.faults(version).isEmpty())
        if good:
            state.write.mode("overwrite").parquet(f"{self.root}/state-{version}")
        pointer = version if good else self.holder(version - 1)
        self.spark.createDataFrame([(pointer,)], "version int").write.mode("overwrite").parquet(f"{self.root}/pointer-{version}")


class Merged(NamedTuple):
    state: DataFrame | None
    refused: DataFrame
    faults: DataFrame


def merge_batch(state: DataFrame | None, publishers: DataFrame, batch: DataFrame, window: int = fixed.WINDOW, missed: list[int] | None = None) -> Merged:
    """The state after a batch of results (publisher, issue, value, reason), what it refused, and the faults.
    Issues newer than the state's are rolled, those inside the window are corrections (R6), older ones are refused; an
    issue of `missed`, whose run never took place, is rolled where it belongs. Gates (R2 to R5, A5) are rows of
    faults: with any, the state must not be taken. A batch without rows changes nothing."""
    now = None if state is None else state.agg(F.max("issue")).first()[0]
    asked = sorted(r["issue"] for r in batch.select("issue").distinct().collect())  # issues of one batch
    late = [i for i in missed or [] if now is not None and now - window < i <= now and i in asked]
    refused = batch.where(F.lit(False)).select("publisher", "issue", F.lit("").alias("why"))
    faults = rolling.batch_faults(batch, publishers, now)
    if late:
        state = rolling.roll_runs(state, publishers, batch.where(F.col("issue").isin(late)), late, window, now)
    rest = [i for i in asked if now is not None and i <= now and i not in late]
    if rest:
        state, refused = rolling.correct(state, batch.where(F.col("issue").isin(rest)), now, window)
    new = [i for i in asked if now is None or i > now]
    if new:
        old = state if state is not None else batch.where(F.lit(False)).select("publisher", "issue", "value", "reason")
        state = rolling.roll_runs(old, publishers, batch.where(F.col("issue").isin(*new)), new, window)
    newest = max(asked[-1], now or asked[-1]) if asked else now
    if asked:
        faults = faults.unionByName(rolling.state_faults(state, publishers, newest, window))
    return Merged(state, refused, faults)


RESULT = ("publisher", "issue", "value", "reason")


def with_waiting(batch: DataFrame, waiting: DataFrame | None) -> DataFrame:
    """A batch with the results that wait for the issues it brings: its own take the place of those of the same
    publisher and issue."""
    own = batch.select(*RESULT)
    if waiting is None:
        return own
    asked, given = own.select("issue").distinct(), own.select("publisher", "issue").distinct()
    return own.unionByName(waiting.join(F.broadcast(asked), "issue", "left_semi").join(given, ["publisher", "issue"], "left_anti").select(*RESULT))


def roll_stream(results: DataFrame, publishers: DataFrame, store: StateStore, checkpoint: str, window: int = fixed.WINDOW) -> StreamingQuery:
    """A streaming query that rolls `results` as they arrive. Version n + 1 is written from the state of version n,
    so a batch that is run again after a failure writes the same version.

    An issue with a fault is refused as a whole and waits, its good results with it; the batch's other issues are
    taken. When a later batch brings results for an issue that waits, the two are joined, judged again and, once good,
    taken in as if the issue had come right at once. What waits for longer than the window is refused by then."""

    def each(batch: DataFrame, number: int) -> None:
        before, waited = store.read(number - 1), store.waiting(number - 1)
        rows = with_waiting(batch, waited).persist()
        missed = [] if waited is None else [r["issue"] for r in waited.select("issue").distinct().collect()]  # issues of refused runs
        merged = merge_batch(before, publishers, rows, window, missed)
        found = merged.faults.persist()
        bad = sorted({r["issue"] for r in found.where("issue IS NOT NULL").select("issue").distinct().collect()})
        taken = merged
        if not found.isEmpty():
            good = rows.where(~F.col("issue").isin(bad)) if bad else rows.where(F.lit(False))
            taken = merge_batch(before, publishers, good, window, missed)
            if good.isEmpty() or not taken.faults.isEmpty():
                taken = Merged(None, taken.refused.where(F.lit(False)), found)
        left = rows if taken.state is None else rows.where(F.col("issue").isin(bad)) if bad else rows.where(F.lit(False))
        if found.isEmpty():
            left = rows.where(F.lit(False))
        said = found.where("issue IS NOT NULL").groupBy("issue").agg(F.min("fault").alias("fault"))
        waiting = left.join(F.broadcast(said), "issue", "left").select(*RESULT, F.lit(number).alias("version"), F.coalesce("fault", F.lit("state")).alias("fault"))
        if waited is not None:
            waiting = waited.join(F.broadcast(rows.select("issue").distinct()), "issue", "left_anti").select(waiting.columns).unionByName(waiting)
        store.write(taken.state, number, found, waiting)
        taken.refused.write.mode("overwrite").parquet(f"{store.root}/refused-{number}")
        rows.unpersist()
        found.unpersist()

    return results.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def horizon(results: DataFrame, window: int = fixed.WINDOW) -> DataFrame:
    """W2 on a table: publisher, issue, status of results in arrival order (seq): late if an earlier arrival
    had an issue `window` or more newer. The maximum so far is taken by day of arrival first, so no
    window runs over all rows."""
    days = results.groupBy("arrived").agg(F.max("issue").alias("top"))
    so_far = days.withColumn("before", F.expr("max(top) over (order by arrived rows between unbounded preceding and 1 preceding)"))  # a row a day
    joined = results.join(so_far.select("arrived", "before"), "arrived")
    late = F.coalesce(F.col("issue") <= F.col("before") - window, F.lit(False))
    return joined.withColumn("status", F.when(late, "refused").otherwise("accepted"))

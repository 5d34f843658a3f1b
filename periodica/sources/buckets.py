"""R1, R6 on a rolling state that is stored by identity.

The state (publisher, issue, value, reason) is dealt by a hash of the publisher into segments, and each segment is a
table bucketed and sorted by publisher. A run or a correction is joined with a segment where it lies: the batch is
brought to the buckets, the state isn't moved. Only segments that change are written, as new tables beside the
old; the pointer that names each segment's table is written last, so readers see all of an update or nothing, and
what another version still names keeps its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, issues
from ..operators import rolling

COLUMNS = "publisher BIGINT, issue INT, value STRING, reason STRING"
SEGMENTS, BUCKETS = 8, 4


class BucketedState:
    """Versions of a state below `root`, a folder all executors see. `segments` and `buckets` are fixed when the first
    version is written; both may grow with the publishers."""

    def __init__(self, spark: SparkSession, root: str, segments: int = SEGMENTS, buckets: int = BUCKETS):
        self.spark, self.root, self.segments, self.buckets = spark, root.rstrip("/"), segments, buckets

    def segment(self, name: str = "publisher"):
        return F.pmod(F.xxhash64(F.lit("segment"), F.col(name).cast("long")), F.lit(self.segments)).cast("int")

    def paths(self, version: int) -> dict[int, str]:
        """Where each segment of a version lies."""
        rows = self.spark.read.schema("segment int, path string").parquet(f"{self.root}/pointer-{version}").collect()  # one for each segment
        return {r["segment"]: r["path"] for r in rows}

    def table(self, path: str) -> DataFrame:
        """A segment's table, with its buckets known to the planner."""
        name = "segment_" + path.rsplit("/", 1)[1].replace("-", "_")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({COLUMNS}) USING parquet CLUSTERED BY (publisher) SORTED BY (publisher) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def read(self, version: int) -> DataFrame:
        """The whole state of a version."""
        found = [self.table(path) for _, path in sorted(self.paths(version).items())]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more)
        return out

    def create(self, state: DataFrame, version: int = 0) -> None:
        marked = state.select("publisher", "issue", "value", "reason", self.segment().alias("segment"))
        self.point({k: self.write(marked.where(F.col("segment") == k).drop("segment")) for k in range(self.segments)}, version)

    def write(self, segment: DataFrame) -> str:
        """A segment as a new table; its path."""
        ident = uuid.uuid4().hex
        path = f"{self.root}/{ident}"
        own = segment.selectExpr("CAST(publisher AS BIGINT) AS publisher", "CAST(issue AS INT) AS issue", "value", "reason").repartition(self.buckets, "publisher")
        own.write.bucketBy(self.buckets, "publisher").sortBy("publisher").option("path", path).format("parquet").saveAsTable(f"segment_{ident}")
        return path

    def point(self, paths: dict[int, str], version: int) -> None:
        self.spark.createDataFrame(sorted(paths.items()), "segment int, path string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointer-{version}")

    def changed(self, version: int, asked: DataFrame, change: Callable[[DataFrame, int], DataFrame]) -> None:
        """Version `version` + 1: change(segment's state, segment) for each segment that has a publisher in `asked`; the
        others stay where they are."""
        touched = {r[0] for r in asked.select(self.segment().alias("segment")).distinct().collect()}  # at most the segments
        paths = self.paths(version)
        fresh = {k: self.write(change(self.table(paths[k]), k)) for k in sorted(touched)}
        self.point(paths | fresh, version + 1)

    def roll(self, version: int, publishers: DataFrame, results: DataFrame, issue: int, window: int = fixed.WINDOW) -> None:
        """The run of `issue` (results: publisher, value, reason). Every segment with an active publisher changes."""
        active = publishers.where("NOT archived")
        self.changed(version, active, lambda state, k: rolled(state, active.where(self.segment() == k), results.where(self.segment() == k), issue, window))

    def correct(self, version: int, corrections: DataFrame, issue: int, window: int = fixed.WINDOW) -> DataFrame:
        """Corrections (publisher, issue, value, reason). Only segments with a cell to correct are written. Returns what
        is refused: publisher, issue, why."""
        inside = F.col("issue").between(issue - window + 1, issue)
        self.changed(version, corrections.where(inside), lambda state, k: corrected(state, corrections.where(inside & (self.segment() == k))))
        outside = corrections.where(~inside).select("publisher", "issue", F.lit("outside the window").alias("why"))
        held = self.read(version).select("publisher").distinct()
        unknown = corrections.where(inside).join(held, "publisher", "left_anti").select("publisher", "issue", F.lit("unknown publisher").alias("why"))
        return outside.unionByName(unknown)


CELLS = "array<struct<issue:int,value:string,reason:string>>"


def by_publisher(rows: DataFrame, name: str) -> DataFrame:
    """A row for each publisher of a batch: its cells."""
    return rows.groupBy("publisher").agg(F.collect_list(F.struct("issue", "value", "reason")).cast(CELLS).alias(name))


def rolled(state: DataFrame, active: DataFrame, results: DataFrame, issue: int, window: int) -> DataFrame:
    """rolling.roll on a segment: its old cells are grouped where they lie, and the batch, one row for each publisher,
    comes to them."""
    old = state.where(F.col("issue").between(issue - window + 1, issue - 1)).groupBy("publisher").agg(F.collect_list(F.struct("issue", "value", "reason")).alias("old"))
    new = results.groupBy("publisher").agg(F.first(F.struct("value", "reason")).alias("new"))
    batch = active.select(F.col("publisher").cast("long").alias("publisher")).distinct().join(new, "publisher", "left")
    both = batch.join(old.hint("merge"), "publisher", "left")  # the state is sorted where it lies, and never broadcast
    rows = both.select("publisher", "new", "old", F.explode(issues.window(F.lit(issue), window)).alias("issue")).withColumn("cell", F.get(F.filter("old", lambda c: c["issue"] == F.col("issue")), F.lit(0)))
    now = F.col("issue") == issue
    value = F.when(now, F.col("new.value")).otherwise(F.col("cell.value"))
    reason = F.when(value.isNull(), F.when(now, F.coalesce("new.reason", F.lit(fixed.DEFAULT_REASON))).otherwise(F.coalesce("cell.reason", rolling.missing_reason(F.col("issue")))))
    return rows.select("publisher", "issue", value.alias("value"), reason.alias("reason"))


def corrected(state: DataFrame, corrections: DataFrame) -> DataFrame:
    """rolling.correct on a segment."""
    joined = state.join(by_publisher(corrections, "cells"), "publisher", "left")
    new = F.get(F.filter("cells", lambda c: c["issue"] == F.col("issue")), F.lit(0))
    marked = joined.withColumn("new", new)
    value = F.when(F.col("new").isNotNull(), F.col("new.value")).otherwise(F.col("value"))
    reason = F.when(F.col("new").isNotNull(), F.when(F.col("new.value").isNull(), F.coalesce("new.reason", F.lit(fixed.DEFAULT_REASON)))).otherwise(F.col("reason"))
    return marked.select("publisher", "issue", value.alias("value"), reason.alias("reason"))

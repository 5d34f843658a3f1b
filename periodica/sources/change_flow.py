"""V23 to V13 as a flow of changes: only publishers with a changed document are decided again.

A version holds the candidates of all documents and the decisions on them, dealt by a hash of the publisher into
parts. A change set brings documents whole: all candidates of each, or that it is gone. What equals the last
version's document is no change. Parts in which a publisher changed are written anew, decisions of other publishers
carried over; all others keep their files. The pointer to each part's files is written last.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..helpers.tables import stored
from ..operators import reconcile

PARTS = 32


class ChangeFlow:
    """`decide` takes candidates (publisher, document, ...) to decisions (publisher, ...), each publisher by itself;
    `candidates` and `decisions` are their schemas."""

    def __init__(self, spark: SparkSession, root: str, decide: Callable[[DataFrame], DataFrame], parts: int = PARTS):
        self.spark, self.root, self.decide, self.parts = spark, root.rstrip("/"), decide, parts

    def part(self):
        return F.pmod(F.xxhash64(F.lit("part"), F.col("publisher").cast("long")), F.lit(self.parts)).cast("int")

    def pointer(self, version: int) -> dict[int, str]:
        rows = self.spark.read.schema("part int, folder string").parquet(f"{self.root}/pointer-{version}").collect()  # one for each part
        return {r["part"]: r["folder"] for r in rows}

    def read(self, version: int, kind: str, parts: set[int] | None = None) -> DataFrame:
        """`candidates` or `decisions` of a version; of some parts only, if these are given."""
        folders: dict[str, list[int]] = {}
        for part, folder in self.pointer(version).items():
            if parts is None or part in parts:
                folders.setdefault(folder, []).append(part)
        schema = self.spark.read.schema("json string").parquet(f"{self.root}/schema-{kind}").first()["json"]
        out = self.spark.createDataFrame([], schema)
        for folder, own in sorted(folders.items()):
            out = out.unionByName(self.spark.read.schema(f"{schema}, part int").parquet(f"{self.root}/{folder}/{kind}").where(F.col("part").isin(own)).drop("part"))
        return out

    def write(self, candidates: DataFrame, decisions: DataFrame) -> str:
        folder = uuid.uuid4().hex
        for kind, rows in (("candidates", candidates), ("decisions", decisions)):
            dealt = rows.withColumn("part", self.part()).repartition("part", F.pmod(F.xxhash64("publisher"), F.lit(4))).sortWithinPartitions("part", "publisher")
            dealt.write.partitionBy("part").parquet(f"{self.root}/{folder}/{kind}")
        return folder

    def point(self, folders: dict[int, str], version: int) -> None:
        self.spark.createDataFrame(sorted(folders.items()), "part int, folder string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointer-{version}")

    def create(self, candidates: DataFrame) -> None:
        """Version 0: everything is decided."""
        decisions = self.decide(candidates)
        for kind, rows in (("candidates", candidates), ("decisions", decisions)):
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            self.spark.createDataFrame([(ddl,)], "json string").write.mode("overwrite").parquet(f"{self.root}/schema-{kind}")
        folder = self.write(candidates, decisions)
        self.point(dict.fromkeys(range(self.parts), folder), 0)

    def apply(self, version: int, fresh: DataFrame, gone: DataFrame) -> DataFrame:
        """Version `version` + 1 from a change set: all candidates of the documents that are new or changed, and
        (publisher, document) of those that are gone. Returns the changes: path, change (V23)."""
        fresh = stored(fresh)
        ids = stored(fresh.select("publisher", "document").unionByName(gone.select("publisher", "document")).distinct())
        asked = {r["part"] for r in ids.select(self.part().alias("part")).distinct().collect()}  # at most all parts
        known = self.read(version, "candidates", asked)
        before = known.join(ids, ["publisher", "document"], "left_semi")
        changes = stored(reconcile.changed_files(listing(before), listing(fresh)))
        changed = changes.select(F.from_json("path", "publisher bigint, document string").alias("x")).select("x.*")
        changed = stored(changed.withColumn("part", self.part()))
        touched = {r["part"] for r in changed.select("part").distinct().collect()}
        publishers, documents = changed.select("publisher").distinct(), changed.select("publisher", "document")
        if not touched:
            self.point(self.pointer(version), version + 1)
            return changes
        rows = stored(self.read(version, "candidates", touched).join(documents, ["publisher", "document"], "left_anti").unionByName(fresh.join(documents, ["publisher", "document"], "left_semi")))
        again = self.decide(rows.join(publishers, "publisher", "left_semi"))
        kept = self.read(version, "decisions", touched).join(publishers, "publisher", "left_anti")
        folder = self.write(rows, kept.unionByName(again))
        self.point(self.pointer(version) | dict.fromkeys(touched, folder), version + 1)
        return changes


def listing(rows: DataFrame) -> DataFrame:
    """path, size, digest of documents: how many candidates each has, and sums of their hashes, in any order."""
    whole = F.struct(*sorted(rows.columns))
    path = F.to_json(F.struct(F.col("publisher").cast("long").alias("publisher"), "document"))
    halves = [F.sum(F.xxhash64(F.lit(k), F.to_json(whole)).cast("decimal(38,0)")) for k in (0, 1)]
    return rows.groupBy(path.alias("path")).agg(F.count("*").alias("size"), F.concat_ws(":", *[h.cast("string") for h in halves]).alias("digest"))

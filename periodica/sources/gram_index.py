"""D2 against a stored index: which publishers have which values of consecutive issues.

A row is (issue, gram, publisher, cells), where cells are all of the publisher's values in the window. Rows are dealt into
parts by a hash of issue and gram, a folder each, and sorted inside, with a Bloom filter on the gram in each file. New
publishers' grams are looked up by an equi-join that reads only the folders they hash to; row groups without the gram are
skipped by the files' own filters. Since one row of a publisher tells its whole window, its runs need no other rows of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..helpers.tables import stored
from ..operators import series

PARTS = 64


class GramIndex:
    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.path, self.parts = spark, path, parts

    def part(self):
        return F.pmod(F.xxhash64("issue", "gram"), F.lit(self.parts)).cast("int")

    def rows(self, existing: DataFrame) -> DataFrame:
        cells = series.class_cells(existing).groupBy("publisher").agg(F.collect_list(F.struct("issue", "value")).alias("cells"))
        return series.class_grams(existing).join(cells, "publisher").withColumn("part", self.part())

    def write(self, existing: DataFrame) -> None:
        """Index publisher, issue, value, paired of all publishers. Replaces what was there."""
        rows = self.rows(existing)
        dealt = rows.repartition("part", F.pmod(F.xxhash64("publisher"), F.lit(4))).sortWithinPartitions("part", "issue", "gram")  # a hot part has several files
        options = {"parquet.bloom.filter.enabled#gram": "true", "parquet.bloom.filter.expected.ndv#gram": "100000"}
        dealt.write.mode("overwrite").partitionBy("part").options(**options).parquet(self.path)

    def add(self, existing: DataFrame) -> None:
        """Index further publishers beside those that are there."""
        rows = self.rows(existing)
        rows.repartition("part").sortWithinPartitions("part", "issue", "gram").write.mode("append").partitionBy("part").parquet(self.path)

    def read(self, parts: list[int]) -> DataFrame:
        rows = self.spark.read.schema("publisher long, issue int, gram string, cells array<struct<issue: int, value: string>>, part int").parquet(self.path)
        return rows.where(F.col("part").isin(parts))

    def hits(self, cells: DataFrame) -> DataFrame:
        """candidate, publisher, issue: the equal grams of candidates (publisher, issue, gram) and indexed publishers."""
        asked = cells.select(F.col("publisher").alias("candidate"), "issue", "gram").withColumn("part", self.part())
        met = asked.join(self.read(self.asked_parts(asked)), ["part", "issue", "gram"])
        return met.where("candidate != publisher").select("candidate", "publisher", "issue")

    def asked_parts(self, asked: DataFrame) -> list[int]:
        return sorted(r["part"] for r in asked.select("part").distinct().collect())  # at most all parts

    def runs(self, candidates: DataFrame) -> DataFrame:
        """As series.candidate_runs of candidates (publisher, issue, value, paired) and the indexed publishers: of these, those with
        a gram that some candidate has are compared."""
        cells = stored(series.class_cells(candidates))
        by = series.window_scale(cells)
        if not by:
            return series.judged_runs(candidates, self.hits(series.class_grams(candidates)))
        asked = stored(series.class_grams(candidates).select("issue", "gram").distinct().withColumn("part", self.part()))
        met = self.read(self.asked_parts(asked)).join(asked, ["part", "issue", "gram"], "left_semi")
        held = met.select("publisher", "cells").distinct().select("publisher", F.explode("cells").alias("c"))
        return series.kinds_of_runs(cells, held.select("publisher", "c.issue", "c.value"), by)

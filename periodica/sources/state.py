"""Rolling state files (JSON) and versioned state tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, issues
from ..functions import text as T

SCHEMA = (
    "schema int, period int, window int, config_fingerprint string, site_count int, vector_count int, fail_count int, fail_lines array<string>, "
    "sites array<struct<name:string,url:string,pick:string,archived:boolean,periods:array<int>,values:array<string>,extended:int,failed_periods:array<int>,failure_reasons:map<string,string>>>"
)


def state_items(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(header of one row, items with their place) of a state file."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json(F.regexp_replace("value", "^﻿", ""), SCHEMA).alias("s")).select("s.*")
    items = raw.select(F.posexplode("sites").alias("place", "item")).select("place", "item.*").withColumn("archived", F.coalesce("archived", F.lit(False)))
    return raw.drop("sites"), items


def state_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same of a state that is written as lines of JSON: one with the header's fields and one for each item,
    with its place. So no row holds the whole state."""
    fields = SCHEMA.split(", sites array<struct<")
    item = f"place int, {fields[1].removesuffix('>>')}".replace("place int, ", "place int,")
    both = f"{fields[0]}, item struct<{item.replace('place int,', 'place:int,')}>"
    texts = spark.read.text(path).where("trim(value) != ''")
    is_header = F.get_json_object("value", "$.schema").isNotNull() | F.get_json_object("value", "$.window").isNotNull()
    header = texts.where(is_header).select(F.from_json("value", both).alias("s")).select("s.*").drop("item")
    items = texts.where(~is_header).select(F.from_json(F.concat(F.lit('{"item":'), "value", F.lit("}")), both).alias("s")).select("s.item.*")
    return header, items.withColumn("archived", F.coalesce("archived", F.lit(False)))


def state_faults(header: DataFrame, items: DataFrame, issue: int, paired: DataFrame, fingerprint: str | None = None, complete: bool = True, window: int = fixed.WINDOW) -> DataFrame:
    """fault: what is wrong with a state; empty for a good one. complete=True is the strict reading (every
    active item has the whole window), False allows holes that their reasons explain. paired: url, paired."""
    wanted = issues.window(F.lit(issue), window)
    active = items.where("NOT archived").join(paired.select("url", "paired"), "url", "left")
    failed = F.coalesce("failed_periods", F.array().cast("array<int>"))
    reasons = F.array_sort(F.transform(F.coalesce(F.map_keys("failure_reasons"), F.array().cast("array<string>")), lambda k: k.try_cast("int")))
    values_good = (F.size("periods") == F.size("values")) & F.forall("values", lambda v: T.valid_value(v, F.coalesce("paired", F.lit(False))))
    whole = (F.col("periods") == wanted) & (F.size(failed) == 0) & (F.size(reasons) == 0)
    explained = (
        (F.size(F.array_intersect("periods", failed)) == 0)
        & (F.array_sort(F.array_union("periods", failed)) == F.array_sort(wanted))
        & (F.array_sort(failed) == reasons)
        & (F.col("periods") == F.sort_array(F.array_distinct("periods"), asc=False))
    )
    good = F.coalesce(values_good & (whole if complete else explained), F.lit(False))
    bad_items = active.where(~good).select(F.format_string("item %d", "place").alias("fault"))
    repeated = items.groupBy(F.trim("name"), F.trim("url"), T.canonical_pick("pick")).count().where("count > 1").select(F.lit("identity twice").alias("fault"))
    counts = active.agg(F.count("*").alias("sites"), F.count_if(F.size(failed) == 0).alias("full"), F.count_if(F.size(failed) > 0).alias("holed")).first()
    head = header.withColumns({k: F.lit(counts[k]) for k in ("sites", "full", "holed")}).select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.col("schema").eqNullSafe(2), "schema"), F.when(~F.col("window").eqNullSafe(window), "window"), F.when(~F.col("period").eqNullSafe(issue), "issue"),
                    F.when(~F.col("site_count").eqNullSafe(F.col("sites")), "site count"), F.when(~F.col("vector_count").eqNullSafe(F.col("full")), "vector count"),
                    F.when(~F.col("fail_count").eqNullSafe(F.lit(0).cast("long") if complete else F.col("holed")), "fail count"),
                    F.when(F.lit(fingerprint is not None) & ~F.col("config_fingerprint").eqNullSafe(F.lit(fingerprint)), "fingerprint"),
                )
            )
        ).alias("fault")
    )
    return head.unionByName(bad_items).unionByName(repeated)


def long_state(items: DataFrame) -> DataFrame:
    """publisher (name|url|pick), issue, value, reason of active items."""
    ident = F.concat_ws("|", F.trim("name"), F.trim("url"), T.canonical_pick("pick")).alias("publisher")
    active = items.where("NOT archived")
    held = active.select(ident, F.explode(F.arrays_zip("periods", "values")).alias("c")).select("publisher", F.col("c.periods").alias("issue"), F.col("c.values").alias("value"), F.lit(None).cast("string").alias("reason"))
    holes = active.select(ident, F.explode("failure_reasons").alias("i", "reason")).select("publisher", F.col("i").try_cast("int").alias("issue"), F.lit(None).cast("string").alias("value"), "reason")
    return held.unionByName(holes)


def write_version(state: DataFrame, root: str, faults: DataFrame | None = None) -> str | None:
    """Write a new version of a state table below `root` and return its path; None if there are faults. What
    is being read is never overwritten: readers go on with their version."""
    if faults is not None and not faults.isEmpty():
        return None
    path = f"{root}/version-{uuid.uuid4().hex}"
    state.write.parquet(path)
    return path

"""Rankings, summaries, health counters. Everything is aggregated before a window sees it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def digit_ranking(results: DataFrame, by: Sequence[str] = ("issue",)) -> DataFrame:
    """A1: by, value, times, rank: pairs count for both digits, other values as they are; dense rank by count."""
    parts = T.ranking_parts(F.col("value"))
    exploded = results.where(F.col("value").isNotNull()).select(
        *by, F.explode(F.when(F.size(parts) > 0, parts).otherwise(F.array("value"))).alias("value")
    )
    counted = exploded.groupBy(*by, "value").agg(F.count("*").alias("times"))
    return counted.withColumn("rank", F.dense_rank().over(Window.partitionBy(*by).orderBy(F.desc("times"))))


def success_report(results: DataFrame) -> DataFrame:
    """A2: issue, section, place, line: the lines in publisher order, then the ranking block."""
    lines = results.where("value IS NOT NULL").select("issue", F.lit(1).alias("section"), F.col("idx").cast("long").alias("place"), T.result_line(F.col("value"), F.col("name")).alias("line"))
    ranked = digit_ranking(results).withColumn(
        "place", F.row_number().over(Window.partitionBy("issue").orderBy(F.desc("times"), "value")).cast("long")
    )
    label = F.when(F.col("value").rlike(r"^\d$"), F.concat("value", F.lit("尾"))).otherwise(F.col("value"))
    block = ranked.select("issue", F.lit(2).alias("section"), "place", F.concat_ws(" ", label, "times", "rank").alias("line"))
    return lines.unionByName(block)


def failure_summary(failures: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A3: failures (reason) by class, most frequent first."""
    return failures.groupBy(*by, T.failure_class(F.col("reason")).alias("class")).agg(F.count("*").alias("times"))


def run_totals(results: DataFrame) -> DataFrame:
    """A4: by issue: successes, failures, total; A5: whether the state may be rolled."""
    good = F.count_if(F.col("value").isNotNull())
    return results.groupBy("issue").agg(
        good.alias("successes"), F.count_if(F.col("value").isNull()).alias("failures"), F.count("*").alias("total"), (good > 0).alias("may_roll")
    )


def rebuild_report(state: DataFrame, publishers: DataFrame, issue: int) -> tuple[DataFrame, DataFrame]:
    """The values of one issue from the rolling state for active publishers, and those skipped."""
    active = publishers.where("NOT archived")
    values = state.where((F.col("issue") == issue) & F.col("value").isNotNull())
    held = active.join(values.select("publisher", "issue", "value"), "publisher")
    return held, active.join(values.select("publisher"), "publisher", "left_anti")


def health(old: DataFrame, results: DataFrame) -> DataFrame:
    """Counters by health key. results: key, at, ok, reason; old: the columns returned.
    A success blanks the category and keeps the error's text."""
    fresh = results.select(
        "key", F.when(F.col("ok"), 1).otherwise(0).cast("long").alias("success_count"), F.when(F.col("ok"), 0).otherwise(1).cast("long").alias("fail_count"),
        F.when(F.col("ok"), F.col("at")).alias("last_success"), F.when(~F.col("ok"), F.col("at")).alias("last_failure"),
        F.when(~F.col("ok"), F.struct("at", "reason")).alias("error"),
        F.struct("at", F.when(F.col("ok"), F.lit("")).otherwise(T.failure_class(F.col("reason"))).alias("class")).alias("state"),
    )
    then = F.coalesce(F.greatest("last_success", "last_failure"), F.lit(0).cast("timestamp"))
    before = old.select(
        "key", "success_count", "fail_count", "last_success", "last_failure",
        F.when(F.col("last_error").isNotNull(), F.struct(F.col("last_failure").alias("at"), F.col("last_error").alias("reason"))).alias("error"),
        F.struct(then.alias("at"), F.col("last_error_category").alias("class")).alias("state"),
    )
    return before.unionByName(fresh).groupBy("key").agg(
        F.sum("success_count").alias("success_count"), F.sum("fail_count").alias("fail_count"),
        F.max("last_success").alias("last_success"), F.max("last_failure").alias("last_failure"),
        F.max("error")["reason"].alias("last_error"), F.max("state")["class"].alias("last_error_category"),
    )


def health_keys(publishers: DataFrame, old: DataFrame) -> DataFrame:
    """Idx, key: the URL, or url#name=name where the URL's entry belongs to another name. The entry
    is the old one's or else that of the lowest idx."""
    owners = old.select(F.col("key").alias("url"), F.col("name").alias("old_owner"))
    first = publishers.groupBy("url").agg(F.min_by("name", "idx").alias("first_owner"))
    joined = publishers.join(first, "url").join(owners, "url", "left")
    mine = T.normalize(F.coalesce(F.nullif(F.col("old_owner"), F.lit("")), F.col("first_owner"))) == T.normalize(F.col("name"))
    return joined.select("idx", F.when(mine, F.col("url")).otherwise(F.concat("url", F.lit("#name="), "name")).alias("key"))


def match_report(matches: DataFrame) -> DataFrame:
    """Matches by level. A row of counted_runs stands for its `pairs`, another for one."""
    pairs = F.sum("pairs") if "pairs" in matches.columns else F.count("*")
    return matches.groupBy("level").agg(pairs.alias("pairs"), F.max("length").alias("longest"))


def ordered_matches(matches: DataFrame, series: DataFrame, publishers: DataFrame) -> DataFrame:
    """Place, level, a, b, a_name, b_name, start, end, values: the matches of equal_runs, newest start first, then by
    the name of a (then a, b); values are those of the run, newest first. Places are counted up by start and
    name, then within these, so that no window runs over all matches."""
    names = publishers.select("publisher", "name")
    named = matches.join(names.toDF("a", "a_name"), "a").join(names.toDF("b", "b_name"), "b")
    cells = series.select(F.col("publisher").alias("a"), "issue", "value")
    run = named.select("a", "b", "start", "end").join(cells, "a").where(F.col("issue").between(F.col("end"), F.col("start")))
    values = run.groupBy("a", "b").agg(F.transform(F.sort_array(F.collect_list(F.struct("issue", "value")), asc=False), lambda x: x["value"]).alias("values"))
    starts = named.groupBy("start").agg(F.count("*").alias("n"))  # a row an issue
    firsts = starts.select("start", (F.sum("n").over(Window.orderBy(F.desc("start"))) - F.col("n")).alias("before"))
    groups = named.groupBy("start", "a_name").agg(F.count("*").alias("n"))
    inside = groups.select("start", "a_name", (F.sum("n").over(Window.partitionBy("start").orderBy("a_name")) - F.col("n")).alias("above"))
    own = F.row_number().over(Window.partitionBy("start", "a_name").orderBy("a", "b"))
    placed = named.join(F.broadcast(firsts), "start").join(inside, ["start", "a_name"]).withColumn("place", F.col("before") + F.col("above") + own)
    return placed.join(values, ["a", "b"]).select("place", "level", "a", "b", "a_name", "b_name", "start", "end", "values")

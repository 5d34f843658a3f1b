"""The rolling ten-issue state, in long form: publisher, issue, value, reason.

A row has either a value or a reason. Gates are aggregates that return violations; a caller
writes a new version only where they are empty (see sources.state.write_version).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, issues
from ..functions import text as T


FINGERPRINT_BLOCK = 1000


def missing_reason(issue: Column) -> Column:
    return F.concat(F.lit("缓存缺少"), issue.cast("string"), F.lit("期有效数据"))


def roll(state: DataFrame, publishers: DataFrame, results: DataFrame, issue: int, window: int = fixed.WINDOW) -> DataFrame:
    """The state after the run of `issue`; results: publisher, value, reason."""
    fresh = results.select("publisher", F.lit(issue).alias("issue"), "value", "reason")
    return roll_runs(state, publishers, fresh, [issue], window)


def roll_runs(state: DataFrame, publishers: DataFrame, results: DataFrame, runs: list[int], window: int = fixed.WINDOW, newest: int | None = None) -> DataFrame:
    """R1 for one or more runs at once: the state after those of the issues in `runs`, whose results
    (publisher, issue, value, reason) are joined in together. With `newest` beyond them the runs are made up for:
    the window stays where it is, and what it holds of later issues too.

    The grid is publishers x the last issues (linear in the publishers). Old values stay
    inside the window, but for the issues run; a success sets the value and clears the
    reason, a failure or a missing result sets a reason; any other hole keeps its reason or
    gets a default one. Archived publishers aren't rolled (see archived_part).
    """
    issue = max(runs) if newest is None else max(*runs, newest)
    current = F.col("issue").isin(*[i for i in runs if i > issue - window])
    old = state.where(F.col("issue").between(issue - window + 1, issue)).select("publisher", "issue", F.col("value").alias("old_value"), F.col("reason").alias("old_reason"))
    grid = publishers.where("NOT archived").select("publisher", F.explode(issues.window(F.lit(issue), window)).alias("issue"))
    fresh = results.select("publisher", "issue", F.col("value").alias("new_value"), F.col("reason").alias("new_reason"))
    joined = grid.join(old, ["publisher", "issue"], "left").join(fresh, ["publisher", "issue"], "left")
    value = F.when(current, F.col("new_value")).otherwise(F.col("old_value"))
    now = F.when(current, F.coalesce("new_reason", F.lit(fixed.DEFAULT_REASON)))
    reason = F.when(value.isNull(), F.coalesce(now, F.col("old_reason"), missing_reason(F.col("issue"))))
    return joined.select("publisher", "issue", value.alias("value"), reason.alias("reason"))


def archived_part(items: DataFrame, publishers: DataFrame) -> DataFrame:
    """Archived publishers' rows, kept as they are unless the publisher is active again."""
    return items.join(publishers.where("NOT archived").select("publisher"), "publisher", "left_anti")


def as_vectors(state: DataFrame) -> DataFrame:
    """One row for each publisher: issues and values newest first, holes, failed issues, reasons."""
    order = lambda cond: F.sort_array(F.collect_list(F.when(cond, F.struct("issue", "value", "reason"))), asc=False)
    packed = state.groupBy("publisher").agg(order(F.col("value").isNotNull()).alias("good"), order(F.col("value").isNull()).alias("bad"))
    return packed.select(
        "publisher", F.col("good.issue").alias("issues"), F.col("good.value").alias("values"), F.size("bad").alias("extended"),
        F.col("bad.issue").alias("failed"), F.map_from_entries(F.transform("bad", lambda b: F.struct(b["issue"].cast("string"), b["reason"]))).alias("reasons"),
    )


def value_faults(vectors: DataFrame, paired: DataFrame) -> DataFrame:
    """R2: publishers whose issues and values differ in number, or whose issues aren't positive, distinct
    and newest first, or that hold a value of the wrong form."""
    both = vectors.join(paired.select("publisher", "paired"), "publisher", "left")
    good = (
        (F.size("issues") == F.size("values"))
        & F.forall("issues", lambda i: i > 0)
        & (F.col("issues") == F.sort_array(F.array_distinct("issues"), asc=False))
        & F.forall("values", lambda v: T.valid_value(v, F.coalesce("paired", F.lit(False))))
    )
    return both.where(~F.coalesce(good, F.lit(False))).select("publisher", F.lit("values").alias("fault"))


def failure_faults(vectors: DataFrame, issue: int, window: int = fixed.WINDOW) -> DataFrame:
    """Publishers whose failed issues and reasons don't match inside the window, or whose reason is blank."""
    wanted = issues.window(F.lit(issue), window)
    inside = F.map_filter("reasons", lambda k, v: F.array_contains(wanted, k.try_cast("int")))
    keys = F.array_sort(F.transform(F.map_keys(inside), lambda k: k.cast("int")))
    failed = F.array_sort(F.array_intersect("failed", wanted))
    good = (
        (F.size("failed") == F.size(F.array_distinct("failed")))
        & F.forall("failed", lambda i: i > 0)
        & F.forall(F.map_keys("reasons"), lambda k: k.rlike(r"^\d+$"))
        & (failed == keys)
        & F.forall(F.map_values(inside), lambda r: F.trim(r) != "")
    )
    return vectors.where(~F.coalesce(good, F.lit(False))).select("publisher", F.lit("reasons").alias("fault"))


def result_faults(results: DataFrame, publishers: DataFrame) -> DataFrame:
    """Idx, fault of results (idx, value, success_line, fail_line): repeated or unknown idx; a success
    whose value or line isn't as expected or that also failed; a failure with a value or without a line."""
    repeated = results.groupBy("idx").count().where("count > 1").select("idx", F.lit("repeated").alias("fault"))
    joined = results.join(publishers.select("idx", "name", "paired"), "idx", "left")
    expected = T.result_line(F.col("value"), F.col("name"))
    good_success = F.col("fail_line").isNull() & T.valid_value(F.col("value"), F.col("paired")) & (F.col("success_line") == expected)
    good_failure = F.col("value").isNull() & (F.coalesce("fail_line", F.lit("")) != "")
    fault = (
        F.when(F.col("name").isNull(), "unknown")
        .when(F.col("success_line").isNotNull() & ~F.coalesce(good_success, F.lit(False)), "success")
        .when(F.col("success_line").isNull() & ~good_failure, "failure")
    )
    return joined.select("idx", fault.alias("fault")).where("fault IS NOT NULL").unionByName(repeated)


def batch_faults(batch: DataFrame, publishers: DataFrame, newest: int | None) -> DataFrame:
    """R4, A5 for results (publisher, issue, value, reason) as they arrive: publisher, issue, fault for results
    that occur twice, of publishers that aren't configured, with a value of the wrong form or with both a
    value and a reason; a row without publisher for each issue newer than `newest` in which nothing succeeded."""
    paired = publishers.select("publisher", F.coalesce("paired", F.lit(False)).alias("paired")) if "paired" in publishers.columns else publishers.select("publisher", F.lit(False).alias("paired"))
    judged = batch.join(paired, "publisher", "left").withColumn(
        "fault",
        F.when(F.col("paired").isNull(), "unknown")
        .when(F.col("value").isNotNull() & F.col("reason").isNotNull(), "value and reason")
        .when(F.col("value").isNotNull() & ~T.valid_value(F.col("value"), F.col("paired")), "value"),
    )
    repeated = batch.groupBy("publisher", "issue").count().where("count > 1").select("publisher", "issue", F.lit("repeated").alias("fault"))
    totals = batch.groupBy("issue").agg(F.count("value").alias("successes"))
    new = totals if newest is None else totals.where(F.col("issue") > newest)
    failed = new.where("successes = 0").select(F.lit(None).cast(batch.schema["publisher"].dataType).alias("publisher"), "issue", F.lit("nothing succeeded").alias("fault"))
    return judged.where("fault IS NOT NULL").select("publisher", "issue", "fault").unionByName(repeated).unionByName(failed)


def state_faults(state: DataFrame, publishers: DataFrame, issue: int, window: int = fixed.WINDOW) -> DataFrame:
    """R2, R3, R5 for a state that is about to be written: publisher, issue (null), fault."""
    vectors = as_vectors(state)
    plain = publishers if "paired" in publishers.columns else publishers.withColumn("paired", F.lit(False))
    found = value_faults(vectors, plain).unionByName(failure_faults(vectors, issue, window))
    twice = publishers.where("NOT archived").groupBy("publisher").count().where("count > 1").select("publisher", F.lit("identity twice").alias("fault"))
    return found.unionByName(twice).select("publisher", F.lit(None).cast("int").alias("issue"), "fault")


def identity_faults(items: DataFrame) -> DataFrame:
    """Identities (name, url, pick) that occur more than once."""
    ident = [F.trim("name").alias("name"), F.trim("url").alias("url"), T.canonical_pick("pick").alias("pick")]
    return items.select(*ident).groupBy("name", "url", "pick").count().where("count > 1")


def correct(state: DataFrame, corrections: DataFrame, issue: int, window: int = fixed.WINDOW) -> tuple[DataFrame, DataFrame]:
    """(new state, refused). corrections: publisher, issue, value, reason. Corrections outside the
    window or of publishers that the state hasn't got are refused; other cells stay untouched."""
    held = state.select("publisher").distinct().withColumn("held", F.lit(True))
    judged = corrections.join(held, "publisher", "left").withColumn(
        "why", F.when(~F.col("issue").between(issue - window + 1, issue), "outside the window").when(F.col("held").isNull(), "unknown publisher")
    )
    good = judged.where("why IS NULL").select("publisher", "issue", F.struct("value", "reason").alias("new"))
    joined = state.join(good, ["publisher", "issue"], "left")
    value = F.when(F.col("new").isNotNull(), F.col("new.value")).otherwise(F.col("value"))
    reason = F.when(F.col("new").isNotNull(), F.when(F.col("new.value").isNull(), F.coalesce("new.reason", F.lit(fixed.DEFAULT_REASON)))).otherwise(F.col("reason"))
    return joined.select("publisher", "issue", value.alias("value"), reason.alias("reason")), judged.where("why IS NOT NULL").select("publisher", "issue", "why")


def header(state: DataFrame) -> DataFrame:
    """One row: publishers, complete ones, those with failures."""
    each = state.groupBy("publisher").agg(F.count_if(F.col("value").isNull()).alias("holes"))
    return each.agg(F.count("*").alias("site_count"), F.count_if(F.col("holes") == 0).alias("vector_count"), F.count_if(F.col("holes") > 0).alias("fail_count"))


def fingerprint(publishers: DataFrame) -> DataFrame:
    """One row, a SHA-256 that depends on order, identity and rule of all active publishers. Each
    publisher is digested first, then each block of FINGERPRINT_BLOCK places, then the blocks in order."""
    order = lambda place: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(place, "print"))), lambda x: x["print"]), ",")
    own = publishers.where("NOT archived").select(
        "idx", F.floor(F.col("idx") / FINGERPRINT_BLOCK).alias("block"), F.sha2(F.to_json(F.struct("name", "url", T.canonical_pick("pick").alias("pick"), "rule")), 256).alias("print")
    )
    blocks = own.groupBy("block").agg(F.sha2(order("idx"), 256).alias("print"))
    return blocks.agg(F.sha2(order("block"), 256).alias("fingerprint"))


def merge_successes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Results by (publisher, issue), the newer one winning."""
    both = old.withColumn("age", F.lit(0)).unionByName(new.withColumn("age", F.lit(1)))
    return both.groupBy("publisher", "issue").agg(F.max_by("value", "age").alias("value"))


def complete_vectors(state: DataFrame, issue: int, window: int = fixed.WINDOW) -> DataFrame:
    """Publishers that have a value for every issue of the window."""
    inside = state.where((F.col("issue") <= issue) & (F.col("issue") > issue - window) & F.col("value").isNotNull())
    full = inside.withColumn("n", F.count("*").over(Window.partitionBy("publisher"))).where(F.col("n") == window)
    return full.select("publisher", "issue", "value")

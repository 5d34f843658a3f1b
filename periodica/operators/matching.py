"""Joins of publishers, results, state and reports. Violations are rows, never exceptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls
from ..helpers.tables import stored


def effective_rules(publishers: DataFrame, by_name: DataFrame, by_url: DataFrame, several: DataFrame) -> DataFrame:
    """Publishers with rule, several, violation. by_name: url, name, rule; by_url: url, rule;
    several: urls with several records an issue. A URL that has names configured takes no other."""
    named = by_name.select("url", T.normalize("name").alias("plain"), F.col("rule").alias("named_rule"))
    has_names = by_name.select("url").distinct().withColumn("has_names", F.lit(True))
    joined = (
        publishers.withColumn("plain", T.normalize("name"))
        .join(named, ["url", "plain"], "left")
        .join(by_url.select("url", F.col("rule").alias("url_rule")), "url", "left")
        .join(has_names, "url", "left")
        .join(several.select("url", F.lit(True).alias("several")).distinct(), "url", "left")
    )
    violation = F.when(F.col("has_names") & F.col("named_rule").isNull(), "name not configured").when(
        F.coalesce("named_rule", "url_rule").isNull(), "no rule"
    )
    rule = F.when(violation.isNull(), F.coalesce("named_rule", "url_rule"))
    return joined.select(*publishers.columns, rule.alias("rule"), F.coalesce("several", F.lit(False)).alias("several"), violation.alias("violation"))


def result_gaps(results: DataFrame, publishers: DataFrame) -> DataFrame:
    """Idx, gap: publishers without exactly one result, results of none, other names or values."""
    own = results.groupBy("idx").agg(F.count("*").alias("n"), F.min("name").alias("result_name"), F.min("value").alias("value"), F.min("line_value").alias("line_value"))
    both = own.join(publishers.select("idx", "name"), "idx", "full")
    gap = (
        F.when(F.col("name").isNull(), "no publisher")
        .when(F.col("n").isNull(), "no result")
        .when(F.col("n") > 1, "several results")
        .when(~F.col("result_name").eqNullSafe(F.col("name")), "other name")
        .when(~F.col("value").eqNullSafe(F.col("line_value")), "other value")
    )
    return both.select("idx", gap.alias("gap")).where("gap IS NOT NULL")


def state_gaps(items: DataFrame, publishers: DataFrame) -> DataFrame:
    """Identities that only one side has, or that stand at another place. Both: place, name, url, pick."""
    ident = lambda d, side: d.select(F.trim("name").alias("name"), F.trim("url").alias("url"), T.canonical_pick("pick").alias("pick"), F.col("place").alias(side))
    both = ident(items, "state_place").join(ident(publishers, "config_place"), ["name", "url", "pick"], "full")
    gap = F.when(F.col("config_place").isNull(), "only in state").when(F.col("state_place").isNull(), "only configured").when(F.col("state_place") != F.col("config_place"), "moved")
    return both.select("name", "url", "pick", gap.alias("gap")).where("gap IS NOT NULL")


def existing_publishers(candidates: DataFrame, publishers: DataFrame) -> DataFrame:
    """Candidate, idx: the first configured publisher of the same name, URL identity or source. The
    disjunction is a union of three equi-joins. Both sides have name and url."""

    def keyed(d: DataFrame) -> DataFrame:
        ident = urls.identity(F.col("url"))
        return d.withColumns({
            "k1": T.normalize("name"),
            "k2": F.when(ident.isNull(), "none").otherwise(F.to_json(ident)),
            "k3": F.to_json(urls.source(F.col("url"))),
        })

    left = keyed(candidates).select("candidate", "k1", "k2", "k3")
    right = keyed(publishers).groupBy
    found = [left.join(right(k).agg(F.min("idx").alias("idx")), k).select("candidate", "idx") for k in ("k1", "k2", "k3")]
    return reduce(DataFrame.unionByName, found).groupBy("candidate").agg(F.min("idx").alias("idx"))


def identity_clusters(publishers: DataFrame, most_rounds: int = 60) -> DataFrame:
    """J4, transitively: idx, cluster (the smallest idx reached) of publishers (idx, name, url) that share a name, a URL
    identity or a source with each other, or with one that does.

    Publishers and keys are the two sides of a graph: a key takes the smallest label of its publishers, a publisher that
    of its keys and then its label's label, until nothing changes. No pairs are made, and a key that a third of
    all share is a partial minimum in each task. Rows without idx are left out; a blank name or no URL ties nothing."""
    ident = urls.identity(F.col("url"))
    keys = F.array_compact(F.array(
        F.when(T.normalize("name") != "", F.concat(F.lit("n"), T.normalize("name"))),
        F.when(ident.isNotNull(), F.concat(F.lit("u"), F.to_json(ident))),
        F.when(ident.isNotNull(), F.concat(F.lit("s"), F.to_json(urls.source(F.col("url"))))),
    ))
    rows = publishers.where("idx IS NOT NULL")
    ties = stored(rows.select(F.col("idx").cast("long").alias("idx"), F.explode(keys).alias("key")).distinct())
    labels = stored(rows.select(F.col("idx").cast("long").alias("idx")).distinct().withColumn("label", F.col("idx")))
    for _ in range(most_rounds):
        least = ties.join(labels, "idx").groupBy("key").agg(F.min("label").alias("low"))
        own = ties.join(least, "key").groupBy("idx").agg(F.min("low").alias("low"))
        near = labels.join(own, "idx", "left").select("idx", F.col("label").alias("before"), F.least("label", F.coalesce("low", "label")).alias("label"))
        above = labels.select(F.col("idx").alias("label"), F.col("label").alias("jump"))
        fresh = stored(near.join(above, "label", "left").select("idx", "before", F.least("label", F.coalesce("jump", "label")).alias("label")))
        labels = fresh.select("idx", "label")
        if fresh.where("label < before").isEmpty():
            return labels.withColumnRenamed("label", "cluster")
    raise ValueError(f"labels still move after {most_rounds} rounds")


def retry_targets(blocks: DataFrame, publishers: DataFrame, issue: int) -> DataFrame:
    """Distinct failed (name, url, pick) of the issue that are configured; place is the first one's."""
    mine = blocks.where(F.col("issue") == issue).groupBy("name", "url", "pick").agg(F.min("place").alias("place"))
    return mine.join(publishers.select("name", "url", "pick").distinct(), ["name", "url", "pick"], "left_semi")


def still_open(blocks: DataFrame, passed: DataFrame) -> DataFrame:
    """Blocks whose (name, url, pick, issue) hasn't passed; unparsable ones (nulls) stay."""
    return blocks.join(passed.select("name", "url", "pick", "issue").distinct(), ["name", "url", "pick", "issue"], "left_anti")


def all_failed(publishers: DataFrame, issues: DataFrame, successes: DataFrame, failures: DataFrame, runs: DataFrame) -> DataFrame:
    """Name, issue, reason for publishers without a success in any of the issues: the run's failure,
    the recorded reason, or a default. runs: issue, code. The issues asked for are few."""
    broken = runs.where("code != 0").groupBy("issue").agg(F.max("code").alias("code"))
    valid = successes.join(broken, "issue", "left_anti").join(issues, "issue", "left_semi")
    failed = publishers.join(valid.select("name").distinct(), "name", "left_anti")
    asked = F.array_sort(F.collect_set("issue"))
    grid = failed.select("name").withColumn("issue", F.explode(F.lit(issues.agg(asked).first()[0] or [])))
    recorded = failures.groupBy("name", "issue").agg(F.max_by("reason", "place").alias("recorded"))
    joined = grid.join(recorded, ["name", "issue"], "left").join(broken, "issue", "left")
    run = F.when(F.col("code").isNotNull(), F.format_string("单期子进程退出码%d，本轮输出无效", F.col("code")))
    return joined.select("name", "issue", F.coalesce(run, F.nullif("recorded", F.lit("")), F.lit("未生成失败记录，且成功文件中也未找到该目录")).alias("reason"))


def report_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Name, kind of two reports (name, value): only left, only right, different."""
    both = left.select("name", F.col("value").alias("l"), F.lit(True).alias("in_l")).join(right.select("name", F.col("value").alias("r"), F.lit(True).alias("in_r")), "name", "full")
    kind = F.when(F.col("in_r").isNull(), "only left").when(F.col("in_l").isNull(), "only right").when(~F.col("l").eqNullSafe(F.col("r")), "different")
    return both.select("name", kind.alias("kind")).where("kind IS NOT NULL")

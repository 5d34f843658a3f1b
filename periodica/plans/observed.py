"""Observations, candidates and publishers derived from the `events` table, in Spark and in SQL.

publisher = user_id, issue = day number, value = a digit, authority = event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAST_ISSUE = 25  # of the rolling state in the queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.floor("value").cast("long") % 10
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("publisher"), (F.datediff("ts", F.lit("2024-01-01").cast("date")) + 1).cast("int").alias("issue"),
        F.col("event_id").alias("seq"), F.col("event_type").alias("kind"), digit.cast("string").alias("value"),
        (F.col("user_id") % 2 == 0).alias("bottom"),
    )


OBS = """obs AS (SELECT user_id AS publisher, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS issue, event_id AS seq,
  event_type AS kind, CAST(CAST(floor(value) AS BIGINT) % 10 AS VARCHAR) AS value, user_id % 2 = 0 AS bottom FROM events)"""


def series(spark: SparkSession, sf_dir: str, modulus: int = 10) -> DataFrame:
    """One value for each publisher and issue: the last event's for bottom publishers, else the first one's."""
    value = F.when(F.bool_or("bottom"), F.max_by("value", "seq")).otherwise(F.min_by("value", "seq"))
    return observations(spark, sf_dir).groupBy("publisher", "issue").agg((value.cast("int") % modulus).cast("string").alias("value"))


def series_sql(modulus: int = 10) -> str:
    return f"""{OBS}, series AS (SELECT publisher, issue, CAST(CAST(CASE WHEN bool_or(bottom) THEN arg_max(value, seq) ELSE arg_min(value, seq) END AS INTEGER) % {modulus} AS VARCHAR) AS value
  FROM obs GROUP BY publisher, issue)"""


def publishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """publisher, idx, name, url, pick, archived, paired, several, scope, bottom."""
    ids = table(spark, sf_dir, "events").select(F.col("user_id").alias("publisher")).distinct()
    p = F.col("publisher")
    text = p.cast("string")
    return ids.select(
        "publisher", (p + 1).cast("int").alias("idx"), F.concat(F.lit("P"), text).alias("name"), F.concat(F.lit("https://p"), text, F.lit(".example/list")).alias("url"),
        F.when(p % 2 == 0, "bottom").otherwise("top").alias("pick"), (p % 23 == 0).alias("archived"), (p % 7 == 0).alias("paired"), (p % 5 == 0).alias("several"),
        F.when(p % 9 == 0, "bottom").when(p % 9 == 1, "top").alias("scope"), (p % 2 == 0).alias("bottom"),
    )


PUBLISHERS = """publishers AS (SELECT DISTINCT user_id AS publisher, CAST(user_id + 1 AS INTEGER) AS idx, 'P' || user_id AS name, 'https://p' || user_id || '.example/list' AS url,
  CASE WHEN user_id % 2 = 0 THEN 'bottom' ELSE 'top' END AS pick, user_id % 23 = 0 AS archived, user_id % 7 = 0 AS paired, user_id % 5 = 0 AS several,
  CASE WHEN user_id % 9 = 0 THEN 'bottom' WHEN user_id % 9 = 1 THEN 'top' END AS scope, user_id % 2 = 0 AS bottom FROM events)"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates as operators.reconcile takes them: authorities mostly agree."""
    p, i, s = F.col("publisher"), F.col("issue"), F.col("seq")
    digit = F.when(s % 17 == 0, F.col("value").cast("long")).otherwise((p + i) % 10)
    value = F.when((p % 7 == 0) & (s % 19 != 0), F.concat_ws("、", digit.cast("string"), ((digit + 1) % 10).cast("string"))).otherwise(digit.cast("string"))
    return observations(spark, sf_dir).select(
        "publisher", "issue", value.alias("value"), F.length("kind").alias("document_order"), (i.cast("long") * 10_000_000 + s).alias("position"),
        F.lit("compact").alias("parser"), F.concat_ws("/", p.cast("string"), "kind").alias("document"), F.concat(F.lit("https://p"), p.cast("string"), F.lit(".example/list")).alias("source_url"),
        F.lit("browser").alias("source_type"), F.lit("").alias("record"), s.alias("seq"), F.when(s % 29 != 0, F.concat(F.lit("row "), s.cast("string"))).otherwise("").alias("block"),
        F.when(s % 101 == 0, "broken row").when(s % 103 == 0, "开0000占位记录").alias("error"),
    )


CANDIDATES = f"""{OBS}, raw AS (SELECT *, CASE WHEN seq % 17 = 0 THEN CAST(value AS BIGINT) ELSE (publisher + issue) % 10 END AS digit FROM obs),
candidates AS (SELECT publisher, issue, CASE WHEN publisher % 7 = 0 AND seq % 19 <> 0 THEN digit || '、' || (digit + 1) % 10 ELSE CAST(digit AS VARCHAR) END AS value,
  length(kind) AS document_order, CAST(issue AS BIGINT) * 10000000 + seq AS position, publisher || '/' || kind AS document, seq,
  CASE WHEN seq % 29 <> 0 THEN 'row ' || seq ELSE '' END AS block, CASE WHEN seq % 101 = 0 THEN 'broken row' WHEN seq % 103 = 0 THEN '开0000占位记录' END AS error FROM raw)"""


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """publishers with the target issue: mostly the issue at the edge."""
    ends = observations(spark, sf_dir).groupBy("publisher").agg(F.min("issue").alias("low"), F.max("issue").alias("high"))
    p = F.col("publisher")
    edge = F.when(p % 2 == 0, F.col("high")).otherwise(F.col("low"))
    target = F.when(p % 13 == 0, F.lit(999)).when(p % 11 == 0, edge + F.when(p % 2 == 0, -1).otherwise(1)).otherwise(edge)
    return publishers(spark, sf_dir).join(ends, "publisher").withColumn("target", target.cast("int")).drop("low", "high")


TARGETS = f"""{PUBLISHERS}, targets AS (SELECT p.*, CAST(CASE WHEN p.publisher % 13 = 0 THEN 999 WHEN p.publisher % 11 = 0 THEN e.edge + CASE WHEN p.publisher % 2 = 0 THEN -1 ELSE 1 END ELSE e.edge END AS INTEGER) AS target
  FROM publishers p JOIN (SELECT publisher, CASE WHEN publisher % 2 = 0 THEN max(issue) ELSE min(issue) END AS edge FROM obs GROUP BY publisher) e USING (publisher))"""


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rolling state whose current issue is the one before LAST_ISSUE: publisher, issue, value, reason."""
    held = series(spark, sf_dir).where(F.col("issue").between(LAST_ISSUE - 10, LAST_ISSUE - 1))
    bad = F.col("publisher") % 10 == F.col("issue") % 10
    return held.select("publisher", "issue", F.when(~bad, F.col("value")).alias("value"), F.when(bad, F.concat(F.lit("原因: timeout "), F.col("issue").cast("string"))).alias("reason"))


STATE = f"""state AS (SELECT publisher, issue, CASE WHEN publisher % 10 <> issue % 10 THEN value END AS value,
  CASE WHEN publisher % 10 = issue % 10 THEN '原因: timeout ' || issue END AS reason FROM series WHERE issue BETWEEN {LAST_ISSUE - 10} AND {LAST_ISSUE - 1})"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of LAST_ISSUE: publisher, value, reason; a third fails."""
    own = series(spark, sf_dir).where(F.col("issue") == LAST_ISSUE)
    bad = F.col("publisher") % 3 == 0
    return own.select("publisher", F.when(~bad, F.col("value")).alias("value"), F.when(bad, "HTTP Error 500").alias("reason"))


RESULTS = f"""results AS (SELECT publisher, CASE WHEN publisher % 3 <> 0 THEN value END AS value, CASE WHEN publisher % 3 = 0 THEN 'HTTP Error 500' END AS reason
  FROM series WHERE issue = {LAST_ISSUE})"""

"""Success and failure reports as text, written and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ranking

FAILURE = r"^失败 (.+) (\S+) 方向: (\S+) 期数: (\d+) 阶段: (.+?) 原因: ?(.*)$"
NO_REASON = "失败原因为空"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """place, line of text files; place is unique and rises within a file."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.posexplode(F.split(F.regexp_replace("value", "^﻿|\r", ""), "\n")).alias("place", "line"))


def success_lines(lines: DataFrame) -> DataFrame:
    """Name, line, value; the last line of a name wins. A line is split at its last white space, so a name
    with spaces leaves no digit label on the left and the line is passed over."""
    bare = F.trim("line")
    label, name = F.regexp_extract(bare, r"^(.*\S)\s+(\S+)$", 1), F.regexp_extract(bare, r"^(.*\S)\s+(\S+)$", 2)
    parts = T.ranking_parts(label)
    good = lines.where((F.size(parts) > 0) & ~bare.rlike(r"\s\d+次$")).select(name.alias("name"), "place", bare.alias("line"), F.array_join(parts, "、").alias("value"))
    last = good.groupBy("name").agg(F.max_by(F.struct("line", "value"), "place").alias("x"))
    return last.select("name", "x.line", "x.value")


def failure_fields(line: Column) -> list[Column]:
    names = ("name", "url", "pick", "issue", "stage", "reason")
    return [F.nullif(F.regexp_extract(line, FAILURE, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)]


def failure_blocks(texts: DataFrame) -> DataFrame:
    """Place and the fields of each blank-line separated block's first line (nulls where it has another
    form). texts: value."""
    blocks = texts.select(F.posexplode(F.split(F.regexp_replace("value", "^﻿|\r", ""), r"\n\s*\n")).alias("place", "block"))
    full = blocks.where(F.trim(F.replace("block", F.lit("\n"), F.lit(""))) != "")
    first = F.trim(F.regexp_extract(F.ltrim(F.regexp_replace("block", r"^\s+", "")), r"^([^\n]*)", 1))
    return full.select("place", *failure_fields(first)).withColumn("issue", F.col("issue").try_cast("int"))


def failure_reasons(lines: DataFrame) -> DataFrame:
    """Name, reason from lines of the current form or the old one (no direction); others are passed over,
    the last line of a name wins."""
    bare = F.trim("line")
    prefix, reason = F.regexp_extract(bare, r"^失败 (.*) 原因:(.*)$", 1), F.trim(F.regexp_extract(bare, r"^失败 (.*) 原因:(.*)$", 2))
    directed = F.contains(prefix, F.lit(" 方向:"))
    good_meta = F.substring_index(prefix, " 方向:", -1).rlike(r"^\s*\S+\s+期数:\s*\d+\s+阶段:\s*\S.*$")
    head = F.trim(F.when(directed, F.substring_index(prefix, " 方向:", 1)).otherwise(prefix))
    name = F.regexp_extract(head, r"^(.*\S)\s+(\S+)$", 1)
    good = lines.where((prefix != "") & (~directed | good_meta) & (name != "")).select(name.alias("name"), "place", F.when(reason == "", NO_REASON).otherwise(reason).alias("reason"))
    return good.groupBy("name").agg(F.max_by("reason", "place").alias("reason"))


def report_text(results: DataFrame) -> DataFrame:
    """Issue, successes, failures: the two reports of each issue as texts. results: issue, idx, name, value, line."""
    report = ranking.success_report(results)
    block = lambda n: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("section") == n, F.struct("place", "line")))), lambda x: x["line"]), "\n")
    good = report.groupBy("issue").agg(F.concat_ws("\n\n", F.nullif(block(1), F.lit("")), F.nullif(F.concat_ws("\n", F.when(block(2) != "", "内容 次数 排名"), block(2)), F.lit(""))).alias("successes"))
    bad = results.where("value IS NULL").groupBy("issue").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "line"))), lambda x: x["line"]), "\n\n").alias("failures"))
    return good.join(bad, "issue", "full")


def report_lines(results: DataFrame) -> DataFrame:
    """Issue, report (successes or failures), section, place, line: the reports of report_text as rows, blank lines too,
    so that no cell holds a whole report. results: issue, idx, name, value, line."""
    found = ranking.success_report(results).select("issue", F.lit("successes").alias("report"), (2 * F.col("section") - 1).alias("section"), "place", "line")
    head = found.select("issue", "report").distinct().select("issue", "report", F.lit(2).alias("section"), F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit("").alias("line")), F.struct(F.lit(1).alias("place"), F.lit("内容 次数 排名").alias("line")))).alias("x"))
    bad = results.where("value IS NULL").select("issue", F.lit("failures").alias("report"), F.lit(1).alias("section"), F.explode(F.array(F.struct((2 * F.col("idx")).alias("place"), "line"), F.struct((2 * F.col("idx") + 1).alias("place"), F.lit("").alias("line")))).alias("x"))
    rows = [d.select("issue", "report", "section", F.col("x.place").cast("long").alias("place"), F.col("x.line").alias("line")) for d in (head, bad)]
    return found.withColumn("place", F.col("place").cast("long")).unionByName(rows[0]).unionByName(rows[1])


def write_reports(lines: DataFrame, path: str) -> None:
    """A text file for each issue and report, its lines in their order."""
    order = ["issue", "report", "section", "place"]
    lines.repartition("issue", "report").sortWithinPartitions(*order).select("issue", "report", F.col("line").alias("value")).write.partitionBy("issue", "report").text(path)


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files by their place: file, start of the part that a task read, and number in it."""
    rows = spark.read.text(path)
    own = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return rows.select(own.alias("place"), F.regexp_replace("value", "^\ufeff|\r", "").alias("line"), *[c for c in rows.columns if c != "value"])


def read_report_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of text files that blank lines separate, a row each, as failure_blocks takes them. Tasks read byte
    ranges that end at a blank line."""
    return spark.read.option("lineSep", "\n\n").text(path)


def write_results(results: DataFrame, path: str) -> None:
    """Results by issue; a second run of an issue replaces its partition only."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("issue").parquet(path)



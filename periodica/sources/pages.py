"""Stored pages as documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed, urls
from ..helpers.values import decoded


def documents_of(pages: DataFrame, url: str = "url", content: str = "html") -> DataFrame:
    """source_url, content, source_type, record_id, document_id of stored pages."""
    return pages.select(
        F.col(url).alias("source_url"), F.col(content).alias("content"), F.lit("page").alias("source_type"),
        urls.record_id(F.col(url)).alias("record_id"), F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("document_id"),
    )


def raw_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Files of raw bodies: path, body."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("content").alias("body"))


def decode(bodies: DataFrame) -> DataFrame:
    """Adds text and decode_status (ok, or charset not usable) to bodies (body, content_type, encoding)."""
    found = bodies.withColumn("decoded", decoded("body", "content_type", "encoding"))
    return found.withColumns({"text": F.col("decoded.text"), "decode_status": F.col("decoded.status")}).drop("decoded")


def placeholder(body: Column) -> Column:
    """A body that stands for none."""
    return F.lower(F.trim(F.trim(F.trim(F.coalesce(body, F.lit(""))), F.lit("\"'")))).isin(*fixed.PLACEHOLDER_BODIES)


TASK_BYTES = 64 << 20  # of pages that a task should get


def packed(pages: DataFrame, content: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The same rows, dealt by size before Python works on them: a page larger than `task_bytes` has a task to itself, all
    others go by hash to as many tasks as their bytes ask for. Two reads of the sizes, one shuffle of the pages.

    Large pages are named by a hash of the row; there are at most as many as tasks. Equal large rows share a task.
    Null content has no size; an empty table gives an empty one."""
    size = F.coalesce(F.octet_length(content), F.lit(0)).cast("long")
    marked = pages.select(F.struct("*").alias("row"), size.alias("size"), F.xxhash64(*pages.columns).alias("own"))
    large = marked.where(F.col("size") > task_bytes).groupBy("own").agg(F.max("size").alias("size")).select("own")
    places = sorted(r["own"] for r in large.collect())  # fewer than all bytes / task_bytes
    light = marked.where(F.col("size") <= task_bytes).agg(F.sum("size")).first()[0] or 0
    tasks = max(1, -(-light // task_bytes))
    place = F.create_map(*[F.lit(x) for i, own in enumerate(places) for x in (own, i)])[F.col("own")] if places else F.lit(None).cast("int")
    spread = F.lit(len(places)) + F.pmod(F.xxhash64("own", F.monotonically_increasing_id()), F.lit(tasks)).cast("int")
    dealt = marked.withColumn("task", F.when(F.col("size") > task_bytes, place).otherwise(spread).cast("int"))
    return dealt.repartitionById(len(places) + tasks, "task").select("row.*")

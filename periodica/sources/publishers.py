"""Publishers from a JSON array. Violations are rows beside the valid ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls

BLOCK = 10_000
ITEM = "array<struct<name:string,url:string,pick:string,archived:string>>"


def load_publishers(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, violations) of a configuration file: a JSON array, read as one text.

    valid: idx (position among active ones), name, url, pick. violations: place, violation;
    a single row of place -1 if the file is no array or has no active item.
    """
    texts = spark.read.text(path, wholetext=True)
    plain = F.regexp_replace("value", "^\ufeff", "")
    shaped = texts.where(plain.rlike(r"^\s*\[")).select(F.from_json(plain, ITEM).alias("items"))
    return judged(shaped.select(F.posexplode("items").alias("place", "item")).select("place", "item.*"))


def load_publisher_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same of a configuration with one JSON object a line, each with its place."""
    item = "place long, " + ITEM.removeprefix("array<struct<").removesuffix(">>").replace(":", " ")
    texts = spark.read.text(path).where("trim(value) != ''")
    return judged(texts.select(F.from_json("value", item).alias("item")).select("item.*"))


def numbered(rows: DataFrame) -> DataFrame:
    """rows with idx, their number by place from 1: blocks of places are numbered each for itself, behind the
    rows of the blocks before."""
    blocked = rows.withColumn("block", F.floor(F.col("place") / BLOCK))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each BLOCK places
    sizes = blocked.groupBy("block").count().select("block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("block").orderBy("place"))
    return blocked.withColumn("n", inside).join(sizes, "block").withColumn("idx", (F.col("offset") + F.col("n")).cast("int")).drop("block", "n", "offset")


def judged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, violations) of rows of place, name, url, pick and archived (as texts)."""
    archived = F.coalesce("archived", F.lit("false"))
    host = urls.authority(F.col("url"))
    active = archived == "false"
    names = rows.where(active).groupBy(F.trim("name").alias("plain")).agg(F.count("*").alias("n"))
    joined = rows.withColumn("plain", F.trim("name")).join(names, "plain", "left")
    scheme = F.lower(F.coalesce(urls.part(F.trim("url"), "PROTOCOL"), F.lit("")))
    violation = (
        F.when(~archived.isin("true", "false"), "archived is no boolean")
        .when(F.coalesce(F.col("plain"), F.lit("")) == "", "no name")
        .when(~scheme.isin("http", "https") | (host == ""), "no http URL with a host")
        .when(F.col("pick").isNull(), "no pick")
        .when(T.canonical_pick("pick").isNull(), "unknown pick")
        .when(active & (F.col("n") > 1), "name twice")
    )
    marked = joined.withColumn("violation", violation)
    good = numbered(marked.where("violation IS NULL").where(active))
    valid = good.select("idx", F.col("plain").alias("name"), F.trim("url").alias("url"), T.canonical_pick("pick").alias("pick"))
    none = rows.agg(F.coalesce(F.count_if(active), F.lit(0)).alias("n")).where("n < 1").select(F.lit(-1).cast("long").alias("place"), F.lit("no active publisher").alias("violation"))
    found = marked.where("violation IS NOT NULL").select(F.col("place").cast("long").alias("place"), "violation")
    return valid, found.unionByName(none)

"""Which series agree at which issues, by bits of whole numbers.

A publisher is one row: `held` has a bit for each issue with a value (bit 0: the newest), v0, v1, .. have the bits of the
values' numbers. Two such rows tell all issues at which both agree, so that nothing about a pair has to be gathered: a pair
meets at each gram (values of consecutive issues) that both have, and the newest one of these alone gives the pair on.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..helpers.tables import stored

SPAN, KINDS = 62, 256  # issues and different values that the numbers have room for
TILE = 1_000  # rows that share a gram and lie in one tile
TASK = 20_000_000  # meetings of two rows in a task


class Scale(NamedTuple):
    """The newest issue, the number of issues, and the values by their numbers."""

    top: int
    span: int
    values: list[str]

    @property
    def planes(self) -> list[str]:
        return [f"v{k}" for k in range(max(1, (len(self.values) - 1).bit_length()))]


def scale(series: DataFrame, n: int) -> Scale | None:
    """Of publisher, issue, value; None if it has too many issues or values, or grams of n values too many bits."""
    ends = series.where("value IS NOT NULL").groupBy("value").agg(F.max("issue").alias("high"), F.min("issue").alias("low")).limit(KINDS + 1).collect()
    values = sorted(r["value"] for r in ends)
    top = max((r["high"] for r in ends), default=0)
    found = Scale(top, top - min((r["low"] for r in ends), default=0) + 1, values)
    return found if found.span <= SPAN and len(values) <= KINDS and n * len(found.planes) <= 24 else None


def marks(cells: DataFrame, by: Scale) -> DataFrame:
    """publisher, held and the planes of publisher, issue, value. Other issues and values than those of the scale are left out."""
    at = (F.lit(by.top) - F.col("issue")).cast("int")
    known = cells.where(F.col("value").isin(by.values) & at.between(0, by.span - 1))
    place = F.array_position(F.array(*map(F.lit, by.values or [""])), F.col("value")) - 1
    bits = known.select("publisher", place.alias("place"), F.call_function("shiftleft", F.lit(1).cast("long"), at).alias("bit"))
    plane = lambda k: F.bit_or(F.when(F.col("place").bitwiseAND(1 << k) != 0, F.col("bit")).otherwise(F.lit(0).cast("long")))
    return bits.groupBy("publisher").agg(F.bit_or("bit").alias("held"), *[plane(k).alias(v) for k, v in enumerate(by.planes)])


def code(by: Scale, n: int) -> Column:
    """A number for the n values of a row from bit `at` on and for `at`."""
    part = lambda c: f"shiftrightunsigned({c}, at) & {(1 << n) - 1}L"
    parts = [f"shiftleft({part(v)}, {n * k})" for k, v in enumerate(by.planes)]
    return F.expr(f"({' + '.join(parts)}) * 64 + at")


def met_at(rows: DataFrame, by: Scale, n: int) -> DataFrame:
    """rows with at, key for each n consecutive issues with a value."""
    full = (1 << n) - 1
    places = F.expr(f"filter(sequence(0, {max(by.span - n, 0)}), i -> (shiftrightunsigned(held, i) & {full}L) = {full}L)")
    return rows.withColumn("at", F.explode(places)).withColumn("key", code(by, n))


def runs_from(mask: str, n: int) -> str:
    """Of a mask, the bits from which n are set."""
    return " & ".join([mask, *[f"shiftrightunsigned({mask}, {i})" for i in range(1, n)]])


def tiles(rows: DataFrame, counts: DataFrame, own: str, other: str | None) -> DataFrame:
    """rows with the tile that each lies in and, of its key, the number of tiles on this side and on the other."""
    size = lambda c: F.least(F.coalesce(F.ceil(F.col(c) / TILE), F.lit(1)), F.lit(1 << 15)).cast("int")
    dealt = rows.join(F.broadcast(counts), "key", "left").withColumn("tiles", size(own)).withColumn("others", size(other or own))
    return dealt.withColumn("tile", F.pmod(F.xxhash64("publisher"), F.col("tiles")).cast("int"))


def meetings(left: DataFrame, right: DataFrame | None, by: Scale, n: int, kept: tuple[str, ...] = ()) -> DataFrame:
    """x, y, mask for each two publishers that agree at n or more consecutive issues: mask has the bits of all issues at which
    they agree. left, right: publisher, held, planes and columns `kept`, which are given as x_ and y_; without right
    each two of left, once. Rows are cut into tiles by the keys that many have, and a task gets two tiles at a time."""
    columns = ["publisher", "held", *by.planes, *kept]
    one = met_at(left.select(columns), by, n)
    two = one if right is None else met_at(right.select(columns), by, n)
    counts = one.groupBy("key").agg(F.count("*").alias("l"))
    counts = counts.withColumn("r", F.col("l")) if right is None else counts.join(two.groupBy("key").agg(F.count("*").alias("r")), "key")
    counts = stored(counts)
    total = counts.agg(F.sum(F.col("l").cast("double") * F.col("r"))).first()[0] or 0.0
    tasks = int(min(max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), total / TASK), 10_000))
    many = counts.where((F.col("l") > TILE) | (F.col("r") > TILE))

    def dealt(side: DataFrame, own: str, other: str | None, letter: str, i: Column, j: Column) -> DataFrame:
        cut = tiles(side, many, own, other).withColumn("i", i).withColumn("j", j)
        names = [F.col(c).alias(f"{letter}_{c}") for c in columns]
        return cut.select(F.expr("shiftleft(key, 32) + shiftleft(i, 16) + j").alias("meet"), "at", (F.col("i") < F.col("j")).alias("mixed"), *names).repartition(tasks, "meet")

    if right is None:
        x = dealt(one, "l", None, "x", F.col("tile"), F.explode(F.expr("sequence(tile, tiles - 1)")))
        y = dealt(two, "r", None, "y", F.explode(F.expr("sequence(0, tile)")), F.col("tile"))
        apart = "mixed OR x_publisher < y_publisher"
    else:
        x = dealt(one, "l", "r", "x", F.col("tile"), F.explode(F.expr("sequence(0, others - 1)")))
        y = dealt(two, "r", "l", "y", F.explode(F.expr("sequence(0, others - 1)")), F.col("tile"))
        apart = "x_publisher != y_publisher"
    mask = " & ".join(["x_held & y_held", *[f"~(x_{v} ^ y_{v})" for v in by.planes]])
    met = x.join(y.drop("at", "mixed").hint("shuffle_hash"), "meet").withColumn("mask", F.expr(mask))
    newest = F.expr(f"({runs_from('mask', n)}) & (shiftleft(2L, at) - 1L)") == F.expr("shiftleft(1L, at)")
    found = met.where(apart).where(newest)
    return found.select(F.col("x_publisher").alias("x"), F.col("y_publisher").alias("y"), "mask", *[f"{s}_{c}" for c in kept for s in "xy"])


def longest(rows: DataFrame, mask: str, by: Scale) -> DataFrame:
    """rows with length, start, end of the longest run of bits in the column `mask`, the newest on ties: bits from which 2, 4, 8, .. are
    set by doubling, then the length from its greatest power of two down. To the optimizer a partition's number isn't
    deterministic, so it leaves later filters above these steps; below, they would repeat each step in each."""
    steps = [1 << k for k in range(by.span.bit_length())]
    rows = rows.withColumn("_1", F.col(mask))
    for s in steps[1:]:
        rows = rows.withColumn(f"_{s}", F.expr(f"_{s // 2} & shiftrightunsigned(_{s // 2}, {s // 2})"))
    rows = rows.withColumns({"_from": F.lit(-1).cast("long"), "_length": F.lit(0)})
    for s in reversed(steps):
        rows = rows.withColumn("_next", F.expr(f"_from & shiftrightunsigned(_{s}, _length)"))
        rows = rows.withColumns({"_from": F.expr("if(_next != 0, _next, _from)"), "_length": F.expr(f"if(_next != 0, _length + {s}, _length)")})
    guarded = lambda c: F.when(F.spark_partition_id() >= 0, F.col(c)).otherwise(F.lit(0))
    rows = rows.withColumns({c: guarded(c) for c in ("_from", "_length")})
    start = F.lit(by.top) - F.expr("bit_count((_from & -_from) - 1)").cast("int")
    found = rows.withColumn("length", F.col("_length").cast("long")).withColumn("start", start).withColumn("end", F.col("start") - F.col("_length") + 1)
    return found.drop("_from", "_length", "_next", *[f"_{s}" for s in steps])


def all_runs(session, by: Scale, n: int) -> DataFrame:
    """mask, length, start, end of each run of n or more bits of each mask; for spans of a few issues."""
    bits = session.range(1 << by.span).select(F.col("id").alias("mask"), F.explode(F.sequence(F.lit(0), F.lit(by.span - 1))).alias("at"))
    first = bits.where("(shiftrightunsigned(mask, at) & 1L) = 1L AND (shiftleft(mask, 1) & shiftleft(1L, at)) = 0L")
    rest = F.expr("~shiftrightunsigned(mask, at)")
    length = F.expr("bit_count((rest & -rest) - 1)").cast("long")
    start = F.lit(by.top) - F.col("at")
    runs = first.withColumn("rest", rest).select("mask", length.alias("length"), start.alias("start"))
    return runs.where(F.col("length") >= n).withColumn("end", (F.col("start") - F.col("length") + 1).cast("int"))

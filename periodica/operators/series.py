"""Series of values by issue: equal runs between publishers, admission, segments.

Long form: publisher, issue, value; one row for each publisher and issue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed, issues
from ..helpers.tables import stored
from . import overlap


HEAVY = 1_000  # publishers that share a gram from which on it is joined in tiles, and of a tile
HEAVIEST, SKETCHED = 1_000, 20_000  # grams that the sketch names, and that it tracks


def classes_of_equal_series(series: DataFrame) -> DataFrame:
    """publisher, rep: publishers whose whole series are equal share the smallest as rep. Series are
    compared by a 256-bit digest of their ordered cells, at most a window's worth a publisher."""
    cells = F.array_sort(F.collect_list(F.struct("issue", "value")))
    prints = series.groupBy("publisher").agg(F.sha2(F.to_json(cells), 256).alias("print"))
    reps = prints.groupBy("print").agg(F.min("publisher").alias("rep"))
    return prints.join(reps, "print").select("publisher", "rep")


def grams(series: DataFrame, n: int = fixed.SUSPECT_RUN) -> DataFrame:
    """publisher, issue, gram: the values of n consecutive issues, newest first."""
    down = Window.partitionBy("publisher").orderBy(F.desc("issue"))
    values = [F.col("value"), *[F.lead("value", i).over(down) for i in range(1, n)]]
    full = series.withColumn("last", F.lead("issue", n - 1).over(down)).withColumn("gram", F.concat_ws("|", *values))
    return full.where(F.col("issue") - F.col("last") == n - 1).select("publisher", "issue", "gram")


def longest_runs(hits: DataFrame, n: int) -> DataFrame:
    """a, b, length, start, end of the longest run of consecutive issues at which both have an equal
    gram; the newest on ties."""
    down = Window.partitionBy("a", "b").orderBy(F.desc("issue"))
    runs = (
        hits.withColumn("island", F.col("issue") + F.row_number().over(down))
        .groupBy("a", "b", "island")
        .agg(F.max("issue").alias("start"), (F.min("issue") - (n - 1)).alias("end"), (F.count("*") + (n - 1)).alias("length"))
    )
    best = runs.groupBy("a", "b").agg(F.max(F.struct("length", "start", "end")).alias("best"))
    return best.select("a", "b", "best.length", "best.start", "best.end")


def heavy_grams(own: DataFrame) -> DataFrame:
    """issue, gram, tiles of grams that more than HEAVY publishers have: a sketch of frequent items, merged over all
    tasks, names at most HEAVIEST of them, which are then counted."""
    key = F.concat_ws("|", "issue", "gram")
    named = own.agg(F.expr(f"approx_top_k(concat_ws('|', issue, gram), {HEAVIEST}, {SKETCHED})").alias("top")).select(F.explode("top").alias("x")).where(F.col("x.count") > HEAVY).select(F.col("x.item").alias("key"))
    counted = own.join(F.broadcast(named), key == F.col("key"), "left_semi").groupBy("issue", "gram").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > HEAVY).select("issue", "gram", F.ceil(F.col("n") / HEAVY).cast("int").alias("tiles"))


def equal_grams(own: DataFrame) -> DataFrame:
    """a, b, issue for publishers a < b with an equal gram at an issue. A gram that many have is cut into tiles of about
    HEAVY publishers; each pair of tiles is a key of its own, so that no task gets more than two tiles of it."""
    heavy = stored(heavy_grams(own))
    rare = own.join(F.broadcast(heavy), ["issue", "gram"], "left_anti")
    one, two = (rare.select(F.col("publisher").alias(c), "issue", "gram") for c in "ab")
    plain = one.join(two, ["issue", "gram"]).where("a < b").select("a", "b", "issue")
    tiled = own.join(F.broadcast(heavy), ["issue", "gram"]).withColumn("tile", F.pmod(F.xxhash64("publisher"), F.col("tiles")).cast("int"))
    left = tiled.select(F.col("publisher").alias("x"), "issue", "gram", F.col("tile").alias("i"), F.explode(F.expr("sequence(tile, tiles - 1)")).alias("j"))
    right = tiled.select(F.col("publisher").alias("y"), "issue", "gram", F.explode(F.expr("sequence(0, tile)")).alias("i"), F.col("tile").alias("j"))
    met = left.join(right.hint("shuffle_hash"), ["issue", "gram", "i", "j"]).where("i < j OR x < y")
    return plain.unionByName(met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "issue"))


def class_runs(series: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """classes_of_equal_series; the grams of their representatives; a, b, length, start, end of pairs of them."""
    classes = classes_of_equal_series(series)
    reps = series.join(classes.where("publisher = rep").select("publisher"), "publisher", "left_semi")
    own = stored(grams(reps, least))
    return classes, own, longest_runs(equal_grams(own), least)


def own_runs(own: DataFrame, least: int) -> DataFrame:
    """The runs of class members among each other, a = b being the representative."""
    return longest_runs(own.select(F.col("publisher").alias("a"), F.col("publisher").alias("b"), "issue"), least)


def levelled(found: DataFrame) -> DataFrame:
    return found.withColumn("level", F.when(F.col("length") >= fixed.DUPLICATE_RUN, "duplicate").otherwise("suspect"))


def equal_runs(series: DataFrame, least: int = fixed.SUSPECT_RUN, expand: bool = True) -> DataFrame:
    """A, b, length, start, end, level for pairs a < b of publishers with an equal run of `least` or more.

    An equal run implies an equal gram, so pairs come from an equi-join on (issue, gram), frequent ones in tiles; where
    issues and values fit the bits of `overlap`, a row knows its whole series and no pair's grams are gathered.
    With expand=False publishers of equal series are one class and the pairs are
    those of class representatives (see classes_of_equal_series for the members).
    """
    series = stored(series.select("publisher", "issue", "value"))
    if by := overlap.scale(series, least):
        rows = stored(overlap.marks(series, by))
        return levelled(bit_runs(rows if expand else bit_classes(rows, by), by, least).drop("x_n", "y_n"))
    classes, own, found = class_runs(series, least)
    if expand:
        x = classes.select(F.col("publisher").alias("x"), F.col("rep").alias("a"))
        y = classes.select(F.col("publisher").alias("y"), F.col("rep").alias("b"))
        across = found.join(x, "a").join(y, "b")
        within = own_runs(own, least).join(x, "a").join(y, "b").where("x < y")
        found = across.unionByName(within).select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "length", "start", "end"
        )
    return levelled(found)


def bit_classes(rows: DataFrame, by: overlap.Scale) -> DataFrame:
    """The representatives of equal series, with n, the number of each one's members."""
    return rows.groupBy("held", *by.planes).agg(F.min("publisher").alias("publisher"), F.count("*").alias("n"))


def bit_runs(rows: DataFrame, by: overlap.Scale, least: int) -> DataFrame:
    """a, b, length, start, end of pairs a < b of rows; x_n and y_n where rows have n."""
    sizes = ("n",) if "n" in rows.columns else ()
    found = overlap.longest(overlap.meetings(rows, None, by, least, sizes), "mask", by)
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "length", "start", "end", *[f"{s}_{c}" for c in sizes for s in "xy"])


def counted_runs(series: DataFrame, least: int = fixed.SUSPECT_RUN) -> DataFrame:
    """D1 without expanding copies: as equal_runs of class representatives and of those with themselves (a = b), with
    `pairs`, the number of pairs of publishers that a row stands for."""
    columns = ["a", "b", "length", "start", "end", "pairs"]
    series = stored(series.select("publisher", "issue", "value"))
    if by := overlap.scale(series, least):
        rows = stored(bit_classes(overlap.marks(series, by), by))
        across = bit_runs(rows, by, least).withColumn("pairs", F.col("x_n") * F.col("y_n"))
        alike = overlap.longest(rows.where("n > 1").where(f"({overlap.runs_from('held', least)}) != 0"), "held", by)
        within = alike.select(F.col("publisher").alias("a"), F.col("publisher").alias("b"), "length", "start", "end", F.expr("n * (n - 1) div 2").alias("pairs"))
        return levelled(across.select(columns).unionByName(within))
    classes, own, found = class_runs(series, least)
    sizes = classes.groupBy("rep").agg(F.count("*").alias("n"))
    x, y = sizes.toDF("a", "x"), sizes.toDF("b", "y")
    across = found.join(x, "a").join(y, "b").withColumn("pairs", F.col("x") * F.col("y"))
    within = own_runs(own, least).join(x.where("x > 1"), "a").withColumn("pairs", F.expr("x * (x - 1) div 2"))
    return levelled(across.select(columns).unionByName(within.select(columns)))


def candidate_runs(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidate, publisher, kind, length, start, end. Both sides: publisher, issue, value, paired.

    Equal in all of ten issues: one `identical` row. Else every run of 6 and more is
    `duplicate`; only where there is none every run of 3 to 5 is `suspicion`. Publishers are
    compared within their class (single or pair values, J9); a gap in the candidate breaks a run.
    Cells lie in a window of ten issues, so each kind takes a run of 3 or more: pairs come from
    an equi-join on issue, class and the values of three consecutive issues. All runs of a pair are those of
    the bits of the window's issues at which both agree.
    """
    asked = stored(class_cells(candidates))
    if by := window_scale(asked):
        return kinds_of_runs(asked, class_cells(existing), by)
    own = class_grams(candidates).withColumnRenamed("publisher", "candidate")
    return judged_runs(candidates, own.join(class_grams(existing), ["issue", "gram"]).where("candidate != publisher"))


def class_cells(side: DataFrame) -> DataFrame:
    """publisher, issue, value of publisher, issue, value, paired; values of different classes differ."""
    return side.where("value IS NOT NULL").select("publisher", "issue", F.concat_ws(":", F.col("paired").cast("string"), "value").alias("value"))


def window_scale(asked: DataFrame) -> overlap.Scale | None:
    """The scale of candidates' cells; None if they don't lie in a window of ten issues."""
    by = overlap.scale(asked, fixed.SUSPECT_RUN)
    return by if by and by.span <= fixed.WINDOW else None


def kinds_of_runs(asked: DataFrame, existing: DataFrame, by: overlap.Scale) -> DataFrame:
    """D2 of class_cells: a table of all masks of ten issues tells the kinds of the runs in each."""
    runs = overlap.all_runs(asked.sparkSession, by, fixed.SUSPECT_RUN)
    most = runs.groupBy("mask").agg(F.max("length").alias("most"))
    hard = F.col("length") >= fixed.DUPLICATE_RUN
    kind = F.when(F.col("length") == fixed.WINDOW, "identical").when(F.col("most") >= fixed.DUPLICATE_RUN, F.when(hard, "duplicate")).otherwise("suspicion")
    kinds = runs.join(most, "mask").select("mask", kind.alias("kind"), "length", "start", "end").where("kind IS NOT NULL")
    met = overlap.meetings(stored(overlap.marks(asked, by)), stored(overlap.marks(existing, by)), by, fixed.SUSPECT_RUN)
    return met.join(F.broadcast(stored(kinds)), "mask").select(F.col("x").alias("candidate"), F.col("y").alias("publisher"), "kind", "length", "start", "end")


def class_grams(side: DataFrame) -> DataFrame:
    """publisher, issue, gram of publisher, issue, value, paired; grams of different classes differ."""
    tagged = F.concat_ws(":", F.col("paired").cast("string"), "value").alias("value")
    return grams(side.select("publisher", "issue", tagged), fixed.SUSPECT_RUN)


def judged_runs(candidates: DataFrame, hits: DataFrame) -> DataFrame:
    """D2 from the equal grams: candidate, publisher, issue."""
    n = fixed.SUSPECT_RUN
    wanted = candidates.groupBy(F.col("publisher").alias("candidate")).agg(F.count("*").alias("cells"))
    down = Window.partitionBy("candidate", "publisher").orderBy(F.desc("issue"))
    runs = (
        hits.withColumn("island", F.col("issue") + F.row_number().over(down))
        .groupBy("candidate", "publisher", "island")
        .agg(F.max("issue").alias("start"), (F.min("issue") - (n - 1)).alias("end"), (F.count("*") + (n - 1)).alias("length"))
    )
    pair = Window.partitionBy("candidate", "publisher")
    judged = (
        runs.join(wanted, "candidate")
        .withColumn("equal", F.sum("length").over(pair))
        .withColumn("hard", F.max("length").over(pair) >= fixed.DUPLICATE_RUN)
        .withColumn("same", (F.col("cells") == fixed.WINDOW) & (F.col("equal") == fixed.WINDOW))
        .withColumn("newest", F.max("start").over(pair))
        .withColumn("oldest", F.min("end").over(pair))
    )
    kind = (
        F.when(F.col("same"), F.when(F.col("start") == F.col("newest"), "identical"))
        .when(F.col("hard"), F.when(F.col("length") >= fixed.DUPLICATE_RUN, "duplicate"))
        .when(F.col("length") >= fixed.SUSPECT_RUN, "suspicion")
    )
    return judged.withColumn("kind", kind).where("kind IS NOT NULL").select(
        "candidate", "publisher", "kind", F.when(F.col("same"), F.col("equal")).otherwise(F.col("length")).alias("length"), "start",
        F.when(F.col("same"), F.col("oldest")).otherwise(F.col("end")).alias("end"),
    )


def told_apart(found: DataFrame) -> DataFrame:
    """D3: with `soft`: duplicates (false) and suspicions (true) in one pass."""
    return found.withColumn("soft", F.col("kind") == "suspicion")


def admission_history(records: DataFrame, base: DataFrame) -> DataFrame:
    """Publisher, issue, value, error. records: publisher, issue, value, valid, issues wanted only;
    base: publisher, issue, value of the directed reading. Each issue needs exactly one record, a
    valid one; the base value has to agree with the history and fills it where it has nothing."""
    counted = records.groupBy("publisher", "issue").agg(F.count("*").alias("n"), F.count_if("valid").alias("good"), F.min("value").alias("value"))
    both = counted.join(base.select("publisher", "issue", F.col("value").alias("base_value")), ["publisher", "issue"], "full")
    unique = (F.col("n") == 1) & (F.col("good") == 1)
    error = F.when(F.col("n").isNotNull() & ~unique, "not unique").when(F.col("value") != F.col("base_value"), "conflict")
    return both.select("publisher", "issue", F.when(error.isNull(), F.coalesce("value", "base_value")).alias("value"), error.alias("error"))


def admission(candidates: DataFrame, history: DataFrame, found: DataFrame) -> DataFrame:
    """Candidate, accepted, reason. candidates: candidate, known (J4), state_ok, issue_ok, base_ok."""
    told = history.groupBy(F.col("publisher").alias("candidate")).agg(
        F.bool_or(F.col("error") == "not unique").alias("bad"), F.bool_or(F.col("error") == "conflict").alias("torn"), F.count("value").alias("cells")
    )
    hits = found.groupBy("candidate").agg(F.count_if(F.col("kind") != "suspicion").alias("hard"), F.count_if(F.col("kind") == "suspicion").alias("soft"))
    reason = (
        F.when(F.col("known"), "exists")
        .when(~F.col("state_ok"), "state")
        .when(~F.col("issue_ok"), "issue")
        .when(~F.col("base_ok"), "base")
        .when(F.col("bad"), "history")
        .when(F.col("torn"), "conflict")
        .when(F.coalesce("cells", F.lit(0)) == 0, "no data")
        .when(F.col("hard") > 0, "duplicate")
        .when(F.col("soft") > 0, "suspicion")
        .otherwise("accepted")
    )
    joined = candidates.join(told, "candidate", "left").join(hits, "candidate", "left").withColumn("reason", reason)
    return joined.select("candidate", (F.col("reason") == "accepted").alias("accepted"), "reason")


def segments(rows: DataFrame) -> DataFrame:
    """G1: adds `segment`: rows (publisher, place, issue) in order of place, cut where the step isn't one
    or its direction flips. After a break the direction is open again, so within a run of flips
    breaks alternate, beginning with one."""
    order = Window.partitionBy("publisher").orderBy("place")
    step = rows.withColumn("step", issues.delta(F.lag("issue").over(order), F.col("issue")))
    good = F.abs("step") == 1
    marked = step.withColumn("good", F.coalesce(good, F.lit(False))).withColumn("before", F.lag("step").over(order)).withColumn("good_before", F.lag("good").over(order))
    flips = marked.withColumn("flip", F.col("good") & F.coalesce(F.col("good_before"), F.lit(False)) & (F.col("before") != F.col("step")))
    placed = flips.withColumn("n", F.row_number().over(order))
    last = F.coalesce(F.max(F.when(~F.col("flip"), F.col("n"))).over(order), F.lit(0))
    cut = ~F.col("good") | (F.col("flip") & ((F.col("n") - last) % 2 == 1))
    broken = placed.withColumn("cut", cut)
    return broken.withColumn("segment", F.sum(F.col("cut").cast("int")).over(order)).drop("step", "good", "before", "good_before", "flip", "n", "cut")


def chosen_segment(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """G1: the segment that holds the target (the edge-most if several do), else the edge one.
    targets: publisher, target (null for none), edge (first or last)."""
    marked = segments(rows).join(targets, "publisher")
    summed = marked.groupBy("publisher", "edge", "segment").agg(F.bool_or(F.coalesce(F.col("issue") == F.col("target"), F.lit(False))).alias("holds"))
    weight = F.when(F.col("edge") == "last", F.col("segment")).otherwise(-F.col("segment"))
    pick = summed.groupBy("publisher").agg(F.max_by("segment", F.struct(F.col("holds"), weight)).alias("segment"))
    return marked.join(pick, ["publisher", "segment"], "left_semi").drop("target", "edge")


def primary_history(rows: DataFrame) -> DataFrame:
    """Rows (publisher, place, issue, title, edge): where the title's issue occurs again after other
    issues, a first-edge publisher keeps what stands before the second time, a last-edge one up to
    and with the first."""
    order = Window.partitionBy("publisher").orderBy("place")
    hit = F.col("issue") == F.col("title")
    hits = rows.withColumn("hits", F.sum(hit.cast("int")).over(order)).withColumn("between", F.sum((~hit).cast("int")).over(order))
    ends = hits.where(hit).groupBy("publisher").agg(
        F.min("place").alias("first"), F.min(F.struct("place", "between")).alias("one"), F.min(F.when(F.col("hits") == 2, F.struct("place", "between"))).alias("two")
    )
    joined = rows.join(ends, "publisher", "left")
    apart = F.coalesce(F.col("two.between") > F.col("one.between"), F.lit(False))
    keep = F.when(~apart, True).when(F.col("edge") == "last", F.col("place") <= F.col("first")).otherwise(F.col("place") < F.col("two.place"))
    return joined.where(keep).select(rows.columns)


def largest_group(rows: DataFrame) -> DataFrame:
    """Of each publisher's groups of rows (publisher, part, place) the longest, the first on ties."""
    sizes = rows.groupBy("publisher", "part").agg(F.count("*").alias("size"), F.min("place").alias("first"))
    best = sizes.groupBy("publisher").agg(F.max_by("part", F.struct(F.col("size"), -F.col("first"))).alias("part"))
    return rows.join(best, ["publisher", "part"], "left_semi")

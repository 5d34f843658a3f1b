"""Equal runs with frequent grams in tiles, and the stored index of grams."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from periodica.operators import overlap, series
from periodica.sources.gram_index import GramIndex

SERIES = "publisher long, issue int, value string"
UNSHUFFLED = [("d1_equal_runs", None), ("a9_match_report", "level"), ("d2_candidate_runs", None), ("d5_admission", "candidate"), ("d3_duplicates_and_suspicions", None), ("d2_stored_index", None)]


def near_constant(n=90, top=12):
    """A third of the publishers say 5 nearly always."""
    rnd = random.Random(31)
    flat = lambda: "5" if rnd.random() < 0.93 else "6"
    return [(p, i, flat() if p % 3 == 0 else str(rnd.randrange(4))) for p in range(n) for i in range(1, top + 1)]


def loop(rows, least=3):
    cells = {}
    for p, i, v in rows:
        cells.setdefault(p, {})[i] = v
    out = set()
    for a, b in combinations(sorted(cells), 2):
        best, run = None, []
        for i in sorted(set(cells[a]) | {max(cells[a]) + 1}, reverse=True):
            if cells[a].get(i) is not None and cells[a].get(i) == cells[b].get(i):
                run.append(i)
                continue
            if len(run) >= least and (best is None or len(run) > len(best)):
                best = run
            run = []
        if len(run) >= least and (best is None or len(run) > len(best)):
            best = run
        if best:
            out.add((a, b, len(best), best[0], best[-1]))
    return out


def test_runs_with_tiles_equal_a_loop(spark, monkeypatch):
    rows = near_constant()
    frame = spark.createDataFrame(rows, SERIES)
    for heavy in (1_000, 5):
        monkeypatch.setattr(series, "HEAVY", heavy)
        found = series.equal_runs(frame)
        assert {(r["a"], r["b"], r["length"], r["start"], r["end"]) for r in found.collect()} == loop(rows)


def test_no_key_has_more_than_two_tiles(spark, monkeypatch):
    monkeypatch.setattr(series, "HEAVY", 8)
    own = series.grams(spark.createDataFrame(near_constant(300), SERIES))
    heavy = series.heavy_grams(own).collect()
    counts = {(r["issue"], r["gram"]): r["count"] for r in own.groupBy("issue", "gram").count().collect()}
    assert {(r["issue"], r["gram"]) for r in heavy} == {k for k, n in counts.items() if n > 8} and heavy
    assert all(r["tiles"] == -(-counts[r["issue"], r["gram"]] // 8) for r in heavy)
    tiles = own.join(series.heavy_grams(own), ["issue", "gram"]).groupBy("issue", "gram", F.pmod(F.xxhash64("publisher"), F.col("tiles"))).count()
    sizes = sorted(r["count"] for r in tiles.collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_only_asked_parts_of_the_index_are_read(spark, tmp_path):
    rows = near_constant(120)
    frame = spark.createDataFrame(rows, SERIES).withColumn("paired", F.lit(False))
    index = GramIndex(spark, str(tmp_path / "index"), 16)
    index.write(frame.where("publisher != 7"))
    few = frame.where("publisher = 7 AND issue <= 4")
    cells = series.class_grams(few)
    hits = index.hits(cells)
    asked = sorted(r["part"] for r in cells.select(index.part().alias("part")).distinct().collect())
    assert 0 < len(asked) <= 2
    read = index.read(asked).select(F.regexp_extract("_metadata.file_path", r"part=(\d+)", 1).cast("int").alias("part")).distinct().collect()
    assert {r["part"] for r in read} <= set(asked)
    assert "PartitionFilters: [part" in hits._jdf.queryExecution().executedPlan().toString()
    plain = series.candidate_runs(few, frame.where("publisher != 7"))
    assert sorted(map(tuple, series.judged_runs(few, hits).collect())) == sorted(map(tuple, plain.collect()))
    assert index.hits(cells.where("false")).count() == 0


def test_d1_takes_the_two_valued_series_of_all_publishers(spark, sf_dir):
    from periodica.plans import catalog
    from periodica.plans import observed as O

    cells = {(r["publisher"], r["issue"]): r["value"] for r in O.series(spark, sf_dir, 2).collect()}
    rows = [(p, i, cells.get((p, i), f"none of {p}")) for p in {p for p, _ in cells} for i in range(1, 31)]
    found = catalog.QUERIES["d1_equal_runs"](spark, sf_dir)
    pairs = {(r["a"], r["b"], r["length"], r["start"], r["end"]) for r in found.collect()}
    assert pairs == loop(rows) and len(pairs) > 50


def test_match_report_counts_copies_without_expanding_them(spark, sf_dir, tmp_path):
    from periodica.operators import ranking
    from periodica.plans import catalog
    from periodica.plans import observed as O

    rows = near_constant(30)
    rows += [(100 + k, i, v) for k in range(5) for p, i, v in rows if p == k % 2]  # copies of 0 and 1
    expected = {}
    for a, b, length, *_ in loop(rows):
        expected.setdefault("duplicate" if length >= 6 else "suspect", []).append(length)
    frame = spark.createDataFrame(rows, SERIES)
    for found in (series.counted_runs(frame), series.equal_runs(frame)):
        assert {tuple(r) for r in ranking.match_report(found).collect()} == {(k, len(v), max(v)) for k, v in expected.items()}

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    copies = events.where("user_id < 4").withColumn("user_id", F.col("user_id") + 1_500).withColumn("event_id", F.col("event_id") + 100_000)
    events.unionByName(copies).write.parquet(str(tmp_path / "events.parquet"))
    alone, found = ({r["level"]: r["pairs"] for r in catalog.QUERIES["a9_match_report"](spark, d).collect()} for d in (sf_dir, str(tmp_path)))
    every = series.equal_runs(O.series(spark, str(tmp_path), 2)).groupBy("level").count()
    assert found == {r["level"]: r["count"] for r in every.collect()}
    assert sum(found.values()) > sum(alone.values()) > 50


def by_sql(name, folder):
    import duckdb

    from periodica.plans import catalog

    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    found = con.sql(catalog.ORACLE_SQL[name])
    return list(found.columns), sorted(map(str, found.fetchall()))


def with_copies(spark, sf_dir, folder):
    """The events and those of publishers below 10 as four publishers more each."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    copies = events.where("user_id < 10").crossJoin(spark.range(1, 5).toDF("k")).withColumn("user_id", F.expr("user_id + 30 * k")).withColumn("event_id", F.expr("event_id + 100000 * k")).drop("k")
    events.unionByName(copies).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_d1_gives_the_pairs_of_copies_too(spark, sf_dir, tmp_path):
    from periodica.plans import catalog

    folder = with_copies(spark, sf_dir, tmp_path)
    names, expected = by_sql("d1_equal_runs", folder)
    found = catalog.QUERIES["d1_equal_runs"](spark, folder).select(names).collect()
    assert sorted(str(tuple(r)) for r in found) == expected
    assert {(r["a"], r["b"]) for r in found} >= {(p, p + 30 * k) for p in range(10) for k in range(1, 5)}


@pytest.mark.parametrize("name, by", UNSHUFFLED)
def test_nothing_of_a_pair_is_shuffled(spark, sf_dir, name, by):
    """Above the join of publishers there is no exchange, or only one of sums by another key."""
    from periodica.plans import catalog

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ShuffledHashJoin") == 1
    above = plan[: plan.index("ShuffledHashJoin")]
    assert "Window" not in above
    if by:
        assert f"HashAggregate(keys=[{by}" in above.split("Exchange")[-1]
    else:
        assert "Exchange hashpartitioning" not in above and "Union" not in above


def random_series(publishers, issues, values, seed=3, kept=0.9):
    """Series of which a third copy stretches of others, some cells missing."""
    rnd = random.Random(seed)
    cells = {p: {i: rnd.choice(values) for i in issues if rnd.random() < kept} for p in range(publishers)}
    for p in range(0, publishers, 3):
        first = rnd.randrange(len(issues))
        cells[p] |= {i: v for i, v in cells[rnd.randrange(publishers)].items() if issues[first] <= i < issues[first] + 7}
    return [(p, i, v) for p, own in cells.items() for i, v in own.items()]


def test_runs_of_all_spans_and_values_equal_a_loop(spark, monkeypatch):
    digits, many = [str(k) for k in range(10)], [f"v{k}" for k in range(3_000)]
    cases = [(range(1, 31), ["0", "1"]), (range(40, 102), digits), (range(1, 64), ["0", "1"]), (range(1, 20), many), (range(5, 6), ["1"]), (range(-3, 9), ["1"])]
    for issues, values in cases:
        rows = random_series(24, issues, values)
        frame = spark.createDataFrame(rows, SERIES)
        assert (overlap.scale(frame, 3) is None) == (len(issues) > 62 or values is many)
        cells = {(p, i): v for p, i, v in rows}
        expected = loop([(p, i, cells.get((p, i), f"none of {p}")) for p in range(24) for i in issues])
        monkeypatch.setattr(overlap, "TILE", 3)
        found = series.equal_runs(frame)
        assert {(r["a"], r["b"], r["length"], r["start"], r["end"]) for r in found.collect()} == expected
        hard = found.where("level = 'duplicate' AND start > 3")
        assert {(r["a"], r["b"]) for r in hard.collect()} == {(a, b) for a, b, length, start, _ in expected if length >= 6 and start > 3}
    assert series.equal_runs(frame.where("false")).count() == 0


def test_missing_values_agree_with_none(spark):
    rows = [(p, i, None if i in (3, 4, 5) else "1" if i != 9 else str(p)) for p in range(3) for i in range(1, 13)]
    found = {(r["a"], r["b"], r["length"], r["start"], r["end"]) for r in series.equal_runs(spark.createDataFrame(rows, SERIES)).collect()}
    assert found == {(a, b, 3, 12, 10) for a, b in combinations(range(3), 2)}
    frame = spark.createDataFrame([(*r, False) for r in rows], SERIES + ", paired boolean").where("issue <= 10")
    judged = series.candidate_runs(frame.where("publisher = 0"), frame.where("publisher != 0"))
    assert {tuple(r)[1:] for r in judged.collect()} == {(p, "suspicion", 3, 8, 6) for p in (1, 2)}


def test_the_index_gives_the_runs_of_candidates(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame(random_series(60, range(16, 26), ["0", "1", "2"]), SERIES).withColumn("paired", F.col("publisher") % 7 == 0)
    index = GramIndex(spark, str(tmp_path / "index"), 16)
    index.write(frame.where("publisher % 4 = 1"))
    index.add(frame.where("publisher % 4 > 1"))
    asked = frame.where("publisher % 4 = 0")
    expected = series.judged_runs(asked, index.hits(series.class_grams(asked))).collect()
    for tile in (1_000, 3):
        monkeypatch.setattr(overlap, "TILE", tile)
        assert sorted(map(tuple, index.runs(asked).collect())) == sorted(map(tuple, expected))
        assert sorted(map(tuple, series.candidate_runs(asked, frame.where("publisher % 4 != 0")).collect())) == sorted(map(tuple, expected))
    assert {r["kind"] for r in expected} >= {"duplicate", "suspicion"}
    assert index.runs(asked.where("false")).count() == 0

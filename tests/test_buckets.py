"""A state bucketed by identity: plans that don't move it, segments that keep their files, versions that stay readable."""

import os

from pyspark.sql import functions as F

from periodica.operators import rolling
from periodica.sources import buckets

STATE = "publisher long, issue int, value string, reason string"


def made(spark, publishers=60, top=10):
    rows = [(p, i, str((p + i) % 10) if (p + i) % 7 else None, None if (p + i) % 7 else "late") for p in range(publishers) for i in range(1, top + 1)]
    return spark.createDataFrame(rows, STATE)


def rows(frame):
    return sorted((r["publisher"], r["issue"], str(r["value"]), str(r["reason"])) for r in frame.select("publisher", "issue", "value", "reason").collect())


def files(path):
    return {(d, f, os.path.getmtime(os.path.join(d, f))) for d, _, names in os.walk(path) for f in names}


def moved(frame):
    """The parts of the plan that bring a batch or the state elsewhere, with all that stands below them."""
    text = frame._jdf.queryExecution().optimizedPlan().toString() and frame._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in text.split("\n") if line.strip()]
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    out = []
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = []
            for other in lines[i + 1 :]:
                if depth(other) <= depth(line):
                    break
                below.append(other)
            out.append("\n".join(below))
    return out


def test_roll_and_correct_equal_the_plain_ones(spark, tmp_path):
    state = made(spark)
    publishers = spark.createDataFrame([(p, p % 9 == 0) for p in range(70)], "publisher long, archived boolean")
    results = spark.createDataFrame([(p, "5" if p % 3 else None, None if p % 3 else "HTTP Error 500") for p in range(0, 65) if p % 4], "publisher long, value string, reason string")
    held = buckets.BucketedState(spark, str(tmp_path / "state"), 4, 2)
    held.create(state)
    assert rows(held.read(0)) == rows(state)
    held.roll(0, publishers, results, 11)
    expected = rolling.roll(state, publishers, results, 11)
    assert rows(held.read(1)) == rows(expected)
    fixes = spark.createDataFrame([(3, 10, "9", None), (3, 11, None, "gone"), (4, 1, "9", None), (900, 11, "9", None), (9, 11, "1", None)], STATE)
    refused = held.correct(1, fixes, 11)
    plain, no = rolling.correct(expected, fixes, 11)
    assert rows(held.read(2)) == rows(plain)
    assert sorted(map(tuple, refused.collect())) == sorted(map(tuple, no.collect()))
    assert rows(held.read(0)) == rows(state)


def test_untouched_segments_keep_their_files(spark, tmp_path):
    held = buckets.BucketedState(spark, str(tmp_path / "state"), 6, 2)
    held.create(made(spark))
    before = {k: (p, files(p)) for k, p in held.paths(0).items()}
    held.correct(0, spark.createDataFrame([(7, 10, "9", None)], STATE), 10)
    own = spark.range(7, 8).select(held.segment("id").alias("k")).first()["k"]
    after = held.paths(1)
    assert {k for k in after if after[k] != before[k][0]} == {own}
    assert all(files(p) == f for p, f in before.values())
    held.correct(1, spark.createDataFrame([(7, 1, "9", None)], STATE).where("issue > 1"), 10)
    assert held.paths(2) == after


def test_the_state_is_not_exchanged(spark, tmp_path):
    held = buckets.BucketedState(spark, str(tmp_path / "state"), 2, 4)
    held.create(made(spark, 200))
    state = held.table(held.paths(0)[0])
    active = spark.range(200).select(F.col("id").alias("publisher"))
    results = spark.createDataFrame([(p, "5", None) for p in range(200)], "publisher long, value string, reason string")
    fixes = spark.createDataFrame([(7, 10, "9", None)], STATE)
    for plan in (buckets.rolled(state, active, results, 11, 10), buckets.corrected(state, fixes)):
        parts = moved(plan)
        assert parts and not any("segment_" in part for part in parts)
        assert "segment_" in plan._jdf.queryExecution().executedPlan().toString()

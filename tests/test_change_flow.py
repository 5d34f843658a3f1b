"""Changes decide again what they touch, and nothing else."""

from pyspark.sql import functions as F

from periodica.sources.change_flow import ChangeFlow

ROWS = "publisher long, document string, value string"


def largest(seen):
    def decide(rows):
        seen.append(rows.count())
        return rows.groupBy("publisher").agg(F.max("value").alias("value"), F.count("*").alias("n"))

    return decide


def made(spark):
    return spark.createDataFrame([(p, f"d{d}", f"{(p * 7 + d * 3 + k) % 50:02d}") for p in range(100) for d in range(3) for k in range(4)], ROWS)


def decided(frame):
    return sorted(map(tuple, frame.select("publisher", "value", "n").collect()))


def test_three_changes_equal_a_full_run(spark, tmp_path):
    seen = []
    flow = ChangeFlow(spark, str(tmp_path / "flow"), largest(seen), 8)
    rows = made(spark)
    flow.create(rows)
    none = rows.where("false")
    steps = [
        (spark.createDataFrame([(3, "d1", "99"), (3, "d1", "98"), (200, "d0", "77")], ROWS), none),
        (rows.where("publisher = 5 AND document = 'd0'"), none),  # the same again
        (spark.createDataFrame([(7, "d9", "55")], ROWS), spark.createDataFrame([(3, "d1"), (9, "d0"), (9, "no such")], "publisher long, document string")),
    ]
    now, told = rows, []
    for k, (fresh, gone) in enumerate(steps):
        changes = flow.apply(k, fresh, gone)
        told.append(sorted((r["path"], r["change"]) for r in changes.collect()))
        now = now.join(fresh.select("publisher", "document").unionByName(gone.select("publisher", "document")).distinct(), ["publisher", "document"], "left_anti").unionByName(fresh)
        assert decided(flow.read(k + 1, "decisions")) == decided(now.groupBy("publisher").agg(F.max("value").alias("value"), F.count("*").alias("n")))
        assert sorted(map(tuple, flow.read(k + 1, "candidates").select("publisher", "document", "value").collect())) == sorted(map(tuple, now.select("publisher", "document", "value").collect()))
    assert [c for _, c in told[0]] == ["new", "changed"] and told[1] == [] and sorted(c for _, c in told[2]) == ["gone", "gone", "new"]
    assert seen[0] == 1200 and seen[1] == 11 and len(seen) == 3 and seen[2] == 8 + 13 + 8
    assert flow.pointer(1) == flow.pointer(2) and sum(flow.pointer(0)[p] == flow.pointer(1)[p] for p in range(8)) >= 6
    assert decided(flow.read(0, "decisions")) == decided(rows.groupBy("publisher").agg(F.max("value").alias("value"), F.count("*").alias("n")))

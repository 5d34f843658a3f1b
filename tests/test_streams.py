"""Keyed state over restarts and silence; refused issues that wait; clusters of identities."""

import random
from datetime import datetime, timedelta

from periodica.operators import matching
from periodica.streaming import keyed, roll

ARRIVAL = "publisher long, issue int, value string, reason string, seq long, at timestamp"
DAY = datetime(2024, 1, 1)


def arrivals():
    """Shuffled within some days; publisher 4 falls silent; one has no id."""
    rnd = random.Random(3)
    rows = []
    for seq in range(400):
        second = seq * 6000
        issue = second // 86400 + 1 - rnd.choice([0, 0, 0, 1, 3, 9, 12])
        p = rnd.choice([0, 1, 2, 3, 4 if seq < 100 else 1, None])
        if issue > 0:
            rows.append((p, issue, str(rnd.randrange(10)), None, seq, DAY + timedelta(seconds=second)))
    return rows


def brute(rows, window=10):
    newest, held, refused = {}, {}, set()
    for p, i, v, _, seq, _ in rows:
        if p in newest and i <= newest[p] - window:
            refused.add(seq)
            continue
        newest[p] = max(i, newest.get(p, i))
        held[p, i] = v
    clock = max(r[5] for r in rows) - timedelta(seconds=1)
    return {(p, i, v) for (p, i), v in held.items() if i > newest[p] - window and DAY + timedelta(days=i - 1 + window) > clock}, refused


def streamed(spark, rows, root, parts):
    n = len(rows)
    for k in range(parts):
        part = rows[k * n // parts : (k + 1) * n // parts]
        spark.createDataFrame(part, ARRIVAL).coalesce(1).write.mode("append").parquet(f"{root}/in")
        keyed.keyed_stream(spark.readStream.schema(ARRIVAL).parquet(f"{root}/in"), f"{root}/log", f"{root}/checkpoint").awaitTermination()
    log = keyed.changes(spark, f"{root}/log")
    return {(r["publisher"], r["issue"], r["value"]) for r in keyed.held_cells(log).collect()}, {r["seq"] for r in keyed.refused_results(log).collect()}


def test_keyed_state_is_the_same_after_restarts(spark, tmp_path):
    rows = arrivals()
    expected = brute(rows)
    assert expected[1] and not any(p == 4 for p, _, _ in expected[0])
    assert streamed(spark, rows, tmp_path / "one", 1) == expected
    assert streamed(spark, rows, tmp_path / "three", 3) == expected


RESULT = "publisher long, issue int, value string, reason string"


def test_a_refused_issue_waits_and_is_made_up_for(spark, tmp_path):
    publishers = spark.createDataFrame([(p, False) for p in range(4)], "publisher long, archived boolean")
    good = lambda i, **odd: [(p, i, odd.get(f"p{p}", str((p + i) % 10)), None) for p in range(4)]
    batches = [good(21), good(22, p1="77x") + good(23), [(0, 29, "5", None), (0, 29, "5", None)], [(1, 22, "3", None)], good(24)]
    for name, own in (("faulty", batches), ("undisturbed", [good(21), good(22) + good(23), good(24)])):
        store = roll.StateStore(spark, str(tmp_path / name / "state"))
        for rows in own:
            spark.createDataFrame(rows, RESULT).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
            source = spark.readStream.schema(RESULT).parquet(str(tmp_path / name / "in"))
            roll.roll_stream(source, publishers, store, str(tmp_path / name / "checkpoint")).awaitTermination()
    rows = lambda s, v: sorted(map(str, s.read(v).collect()))
    store, plain = (roll.StateStore(spark, str(tmp_path / n / "state")) for n in ("faulty", "undisturbed"))
    assert rows(store, 4) == rows(plain, 2)
    waiting = [sorted((r["issue"], r["version"], r["fault"]) for r in store.waiting(v).collect()) for v in range(5)]
    assert waiting[0] == [] and waiting[1] == [(22, 1, "value")] * 4
    assert waiting[2] == [(22, 1, "value")] * 4 + [(29, 2, "repeated")] * 2
    assert waiting[3] == waiting[4] == [(29, 2, "repeated")] * 2
    assert store.holder(2) == 1 and store.holder(3) == 3


def test_identity_clusters(spark):
    chain = [(i, f"n{i // 2}", f"https://h{(i + 1) // 2}.example/x") for i in range(60)]
    rows = chain + [(100, "", None), (101, None, ""), (102, "solo", "https://solo.example/"), (None, "n1", "https://h1.example/x")] + [(200 + i, f"m{i}", "https://hot.example/list") for i in range(50)]
    frame = spark.createDataFrame(rows, "idx int, name string, url string")
    found = {r["idx"]: r["cluster"] for r in matching.identity_clusters(frame).collect()}
    assert found == {**dict.fromkeys(range(60), 0), 100: 100, 101: 101, 102: 102, **dict.fromkeys(range(200, 250), 200)}
    assert matching.identity_clusters(frame.where("false")).count() == 0

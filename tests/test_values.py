"""Values in rows, their context, windows, draws: the shapes that have gone wrong elsewhere, in own words."""

import random

import pytest
from pyspark.sql import functions as F

from periodica.functions import text as T
from periodica.helpers.markup import blocks_of, tables_of
from periodica.helpers.values import decode_body, find_value
from periodica.operators import guards


@pytest.mark.parametrize(
    ("text", "value", "refused"),
    [
        ("12期 杀一尾[5] 开:鼠01准", 5, None),
        ("12期 绝杀一尾:7 开:?00", 7, None),
        ("12期 上期杀一尾[9] 本期杀一尾[4] 开:鼠01", 4, None),
        ("12期 上期杀一尾[9] 开:鼠01", None, "prior values only"),
        ("12期 上期命中 杀一尾[3] 开:鼠01", 3, None),
        ("12期 上期推荐命中 杀一尾[3]", None, "prior values only"),
        ("12期 上期杀一尾3，再说说别的很长一段文字之后 杀一尾[8]", None, "prior value first"),
        ("12期 杀一尾[333] 开", 3, None),
        ("12期 杀一尾[12] 开", None, None),
        ("12期 杀2、3尾", None, None),
        ("12期 没有字段", None, None),
        ("", None, None),
    ],
)
def test_find_value(text, value, refused):
    assert find_value(text) == (value, refused)


@pytest.mark.parametrize(
    ("text", "value", "proven", "fault"),
    [
        ("杀一尾[5] 开:鼠01", 5, True, None),
        ("杀一尾 ◆ 5", 5, True, None),
        ("杀一尾 另见栏目 5", 5, False, "other words between"),
        ("杀一尾[12]", 1, False, "several digits"),
        ("杀一尾 2、3尾", 2, False, "several values"),
        ("杀【4】尾", 4, True, None),
        ("nothing", 4, False, None),
    ],
)
def test_adjacency(spark, text, value, proven, fault):
    frame = spark.createDataFrame([(text, str(value))], "text string, value string")
    assert tuple(frame.select(guards.adjacent(F.col("text"), F.col("value")).alias("x")).first()["x"]) == (proven, fault)


def one(spark, column, *values):
    frame = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return frame.select(column.alias("x")).first()["x"]


def test_window_never_cuts_a_number_or_bracket(spark):
    text = "12期 " + "词" * 70 + " [12] 尾"
    for span in range(80, 90):
        cut = one(spark, T.bounded_window(F.col("c0"), span), text)
        assert cut.count("[") == cut.count("]")
    assert one(spark, T.bounded_window(F.col("c0"), 80), "短") == "短"


@pytest.mark.parametrize(("text", "found"), [("公开12期", False), ("开奖:87127.com", False), ("开准", True), ("开:鼠12", True), ("尾: 0000 准", False), ("7尾: 0000 准", True), ("开始", False)])
def test_draw_signal(spark, text, found):
    assert one(spark, T.has_draw(F.col("c0")), text) is found


def test_failure_classes_keep_their_order(spark):
    for text, name in (("missing SSL", "没有数据"), ("ssl timeout", "TLS失败"), ("connection reset, timed out", "连接断开"), ("timeout http error", "超时"), ("x", "抓取/解析失败")):
        assert one(spark, T.failure_class(F.col("c0")), text) == name


def test_nested_tables_are_scopes_of_their_own():
    html = "<table><tr><td>a</td></tr><tr><td><table><tr><th>b</th></tr></table></td></tr></table>"
    assert tables_of(html) == [[["b"]], [["a"], [""]]]
    assert tables_of("<tr><td>x</td></tr>") == [[["x"]]]
    assert tables_of(None) == []


def test_blocks_name_their_ancestors():
    found = blocks_of('<div id="a" class="b c"><p>one<p>two</div><p>three')
    assert [(b[1], b[3]) for b in found] == [("div#a.b.c>p", "one"), ("div#a.b.c>p", "two"), ("p", "three")]


def test_bodies_are_decoded():
    import gzip
    import zlib

    text = "杀一尾[5]"
    assert decode_body(gzip.compress(text.encode("gbk")), "text/html; charset=gb2312", "") == text
    assert decode_body(zlib.compress(text.encode()), None, "deflate") == text
    assert decode_body(b'<meta charset="gbk">' + text.encode("gbk"), "", "").endswith(text)
    assert decode_body(None, None, None) == ""
    assert decode_body(b"\x1f\x8bxx", "", "") == "\x1f�xx"


def test_issue_lists(spark):
    parse = T.parse_issues(F.col("c0"))
    assert one(spark, parse, " 298, 299，298  300 ") == [298, 299, 300]
    for bad in ("", "1 x", "0", "-3"):
        assert one(spark, parse, bad) is None


def test_year_wrap(spark):
    from periodica.functions.issues import delta

    rows = spark.createDataFrame([(365, 1), (1, 365), (5, 6), (5, 5), (90, 2)], "a int, b int")
    assert [r[0] for r in rows.select(delta(F.col("a"), F.col("b"))).collect()] == [1, -1, 1, 0, -88]


def loop_segments(issues):
    out, number, way = [], 0, None
    for i, issue in enumerate(issues):
        step = None
        if i:
            step = issue - issues[i - 1]
            step = 1 if step <= -300 else -1 if step >= 300 else step
        if step not in (1, -1) or (way is not None and step != way):
            number, way = number + 1, None
        else:
            way = step
        out.append(number)
    return out


def test_segments_equal_a_loop(spark):
    from periodica.operators.series import segments

    rnd, rows, expected = random.Random(3), [], {}
    for p in range(120):
        issues = [rnd.choice((1, 2, 364, 365))]
        for _ in range(rnd.randrange(1, 14)):
            issues.append((issues[-1] + rnd.choice((1, 1, -1, -1, 0, 5)) - 1) % 365 + 1)
        rows += [(p, i, x) for i, x in enumerate(issues)]
        expected[p] = loop_segments(issues)
    found = segments(spark.createDataFrame(rows, "publisher int, place int, issue int")).orderBy("publisher", "place").collect()
    for p, want in expected.items():
        assert [r["segment"] for r in found if r["publisher"] == p] == want


def loop_run(a, b):
    best, now, last = [], [], None
    for issue in sorted(set(a) & set(b), reverse=True):
        same = a[issue] == b[issue]
        now = ([*now, issue] if now and last - issue == 1 else [issue]) if same else []
        best = now if len(now) > len(best) else best
        last = issue
    return best


@pytest.mark.parametrize("expand", [True, False])
def test_equal_runs_equal_a_loop(spark, expand):
    from periodica.operators.series import equal_runs

    rnd = random.Random(5)
    series = {p: {i: rnd.choice("01") for i in range(1, 13) if rnd.random() < 0.85} for p in range(25)}
    series |= {30: dict(series[3]), 31: dict(series[3]), 32: {i: "1" for i in range(1, 13)}, 33: {i: "1" for i in range(1, 13)}}
    rows = [(p, i, v) for p, s in series.items() for i, v in s.items()]
    found = {(r["a"], r["b"]): (r["start"], r["end"], r["length"], r["level"]) for r in equal_runs(spark.createDataFrame(rows, "publisher int, issue int, value string"), expand=expand).collect()}
    expected = {}
    for a in series:
        for b in series:
            if not expand and {a, b} & {30, 31, 33}:  # members of the classes of 3 and 32
                continue
            if a < b and len(run := loop_run(series[a], series[b])) >= 3:
                expected[a, b] = (run[0], run[-1], len(run), "duplicate" if len(run) >= 6 else "suspect")
    assert found == expected


def test_fragments_equal_a_loop(spark):
    from periodica.operators.reconcile import without_fragments

    rnd, rows, docs = random.Random(7), [], {}
    for d in range(40):
        docs[d] = [rnd.choice("ab") for _ in range(rnd.randrange(1, 7))]
    for d, blocks in docs.items():
        for i, b in enumerate(blocks):
            rows.append((1, 5, "1", 0, i, "compact", f"d{d}", "u", "page", "r", d * 100 + i, f"block {b}", None))
    schema = "publisher int, issue int, value string, document_order int, position int, parser string, document string, source_url string, source_type string, record string, seq int, block string, error string"
    kept = {r["document"] for r in without_fragments(spark.createDataFrame(rows, schema)).select("document").distinct().collect()}
    text = {d: "".join(b) for d, b in docs.items()}
    assert kept == {f"d{d}" for d, t in text.items() if not any(len(o) > len(t) and t in o for o in text.values())}


def test_unknown_source_kind_is_an_error(spark):
    from periodica.operators.extract import extract

    with pytest.raises(ValueError, match="unknown source kind"):
        extract(spark.range(1), "no such kind")


def test_versions_are_written_only_without_faults(spark, tmp_path):
    from periodica.sources.state import write_version

    state = spark.createDataFrame([(1, 2, "3", None)], "publisher int, issue int, value string, reason string")
    assert write_version(state, str(tmp_path), state) is None
    path = write_version(state, str(tmp_path), state.where("false"))
    assert spark.read.parquet(path).count() == 1


def test_a_batch_with_faults_or_without_rows_leaves_the_state(spark, tmp_path):
    from periodica.streaming.roll import StateStore, merge_batch

    results = "publisher int, issue int, value string, reason string"
    publishers = spark.createDataFrame([(1, False), (2, False)], "publisher int, archived boolean")
    store = StateStore(spark, str(tmp_path))

    def arrive(number, *rows):
        state, refused, faults = merge_batch(store.read(number - 1), publishers, spark.createDataFrame(list(rows), results))
        store.write(state, number, faults)
        return sorted(r["fault"] for r in store.faults(number).collect())

    assert arrive(0) == [] and store.read(0) is None
    assert arrive(1, (1, 20, "5", None), (2, 20, None, "timeout")) == []
    kept = sorted(map(str, store.read(1).collect()))
    for number, (rows, found) in enumerate([
        ([], []),
        ([(1, 21, "77x", None), (2, 21, "4", None)], ["value", "values"]),
        ([(1, 21, None, "down"), (2, 21, None, "down")], ["nothing succeeded"]),
        ([(1, 21, "5", None), (1, 21, "6", None)], ["repeated"]),
        ([(9, 21, "5", None)], ["unknown"]),
        ([(1, 21, "5", "and a reason")], ["value and reason"]),
    ], start=2):
        faults = arrive(number, *rows)
        assert set(found) <= set(faults) and bool(found) == bool(faults)
        assert sorted(map(str, store.read(number).collect())) == kept
    assert arrive(8, (1, 21, "6", None)) == []
    assert {(r["publisher"], r["value"]) for r in store.read(8).where("issue = 21").collect()} == {(1, "6"), (2, None)}


def test_runs_rolled_together_equal_runs_rolled_one_by_one(spark):
    from periodica.operators.rolling import roll, roll_runs

    rnd = random.Random(9)
    schema = "publisher int, issue int, value string, reason string"
    publishers = spark.createDataFrame([(p, p == 3) for p in range(6)], "publisher int, archived boolean")
    rows = [(p, i, *rnd.choice([("4", None), (None, "down")])) for p in range(6) for i in (5, 7, 8, 19) if rnd.random() < 0.8]
    batch, now = spark.createDataFrame(rows, schema), spark.createDataFrame([(0, 4, "1", None), (1, 3, None, "old")], schema)
    together = roll_runs(now, publishers, batch, [5, 7, 8, 19])
    for i in (5, 7, 8, 19):
        now = roll(now, publishers, batch.where(F.col("issue") == i), i)
    assert sorted(map(str, together.collect())) == sorted(map(str, now.collect()))


def test_candidates_run_by_grams_equal_a_loop(spark):
    from periodica.operators.series import candidate_runs

    rnd = random.Random(11)
    series = {p: {i: rnd.choice("01") for i in range(1, 11) if rnd.random() < 0.95} for p in range(40)}
    series |= {40: {i: "1" for i in range(1, 11)}, 41: {i: "1" for i in range(1, 11)}}
    frame = lambda ids: spark.createDataFrame([(p, i, v, p % 3 == 0) for p in ids for i, v in series[p].items()], "publisher int, issue int, value string, paired boolean")
    ids = [p for p in series if p % 4 == 0]
    expected = set()
    for c in ids:
        for p in series:
            if p in ids or (p % 3 == 0) != (c % 3 == 0):
                continue
            same = sorted((i for i in series[c] if series[p].get(i) == series[c][i]), reverse=True)
            runs = []
            for i in same:
                if runs and runs[-1][-1] - i == 1:
                    runs[-1].append(i)
                else:
                    runs.append([i])
            if len(same) == len(series[c]) == 10:
                expected.add((c, p, "identical", 10, 10, 1))
                continue
            hard = any(len(r) >= 6 for r in runs)
            expected |= {(c, p, "duplicate" if hard else "suspicion", len(r), r[0], r[-1]) for r in runs if len(r) >= (6 if hard else 3)}
    found = candidate_runs(frame(ids), frame([p for p in series if p not in ids])).collect()
    assert {(r["candidate"], r["publisher"], r["kind"], r["length"], r["start"], r["end"]) for r in found} == expected


def test_written_literals_and_configuration_files(spark, tmp_path):
    from periodica.sources.publishers import load_publishers

    page = r"""document.writeln('<p>a\nb\\c\t\'q\'</p>'); document.writeln("x\ry");"""
    assert one(spark, T.written_html(F.col("c0")), page) == "<p>a\nb\\c\t'q'</p>\nx\ry"
    path = tmp_path / "sites.json"
    path.write_text('﻿[{"name":" a ","url":"https://a.example/","pick":"top"},{"name":"b","url":"x","pick":"top","archived":true},{"name":"c","url":"https://c.example/","pick":"下"}]', "utf-8")
    valid, bad = load_publishers(spark, str(path))
    assert sorted((r["idx"], r["name"], r["pick"]) for r in valid.collect()) == [(1, "a", "top"), (2, "c", "bottom")]
    assert [(r["place"], r["violation"]) for r in bad.collect()] == [(1, "no http URL with a host")]
    path.write_text("{}", "utf-8")
    assert [(r["place"], r["violation"]) for r in load_publishers(spark, str(path))[1].collect()] == [(-1, "no active publisher")]

"""Malformed input is a row with a status, never an exception; long authorities are compared in linear rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from periodica.operators import extract, feeds, reconcile
from periodica.sources import pages


def test_odd_charsets_are_read_as_utf8(spark):
    names = ["idna", "undefined", "punycode", "no-such", "utf-8", "gb2312", "hex", "zlib", "rot13", "unicode_escape", "utf-16", None]
    rows = [(n, "abc 第1期".encode() + b"\xff", f"text/html; charset={n}" if n else None, "") for n in names]
    found = {r["n"]: r for r in pages.decode(spark.createDataFrame(rows, "n string, body binary, content_type string, encoding string")).collect()}
    assert len(found) == len(names)
    for n in ("idna", "undefined", "no-such", "hex"):
        assert found[n]["text"].startswith("abc 第1期") and found[n]["decode_status"] == "charset not usable"
    assert found["utf-8"]["decode_status"] == found[None]["decode_status"] == "ok"


def test_malformed_links_have_no_target(spark):
    html = '<a href="http://[x">bad</a><a href="/ok">good word</a><a href="">none</a><a href="http://[::1">word bad</a>'
    found = extract.links(spark.createDataFrame([("https://a.example/p", html), ("http://[bad", '<a href="x">word</a>')], "url string, html string"))
    rows = {(r["url"], r["place"]): (r["target"], r["status"]) for r in found.collect()}
    assert rows["https://a.example/p", 0] == (None, "malformed link") and rows["https://a.example/p", 3] == (None, "malformed link")
    assert rows["https://a.example/p", 1] == ("https://a.example/ok", "ok") and rows["http://[bad", 0][0] is None
    assert {(r["url"], r["target"]) for r in extract.chosen_link(found, ["word"], True).collect()} == {("https://a.example/p", "https://a.example/ok")}


def test_pages_of_one_url_keep_their_own_links(spark, tmp_path):
    import duckdb

    from periodica.plans import catalog

    link = lambda h: f'<a href="/{h}">{h}</a>'
    same = "https://a.example/p"
    rows = [(1, same, link("one") + link("two")), (2, same, link("three")), (3, same, "none"), (4, "https://b.example/", link("one") * 2), (None, same, link("five"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.sql(f"SELECT page_id, place, target FROM ({catalog.ORACLE_SQL['x25_links']})").fetchall()
    assert sorted(map(tuple, catalog.QUERIES["x25_links"](spark, str(tmp_path)).select("page_id", "place", "target").collect())) == sorted(expected)
    assert len(expected) == 5


def deep(levels, inner):
    return '{"a":[' * (levels // 2) + inner + "]}" * (levels // 2)


def test_articles_at_any_depth(spark):
    own = json.dumps({"id": "7", "authorNickname": "N", "title": "T", "html": "<p>x</p>"})
    texts = {"flat": own, "two": f"[{own},{own}]", "deep": deep(60, own), "deepest": deep(100_000, own), "open": '{"a":' * 5000, "none": None, "bad": "{", "number": '{"x":[{"_id":7,"content":null,"authorNickname":"N","title":"T","html":"h"}]}'}
    frame = spark.createDataFrame([(k, "7", "N", t) for k, t in texts.items()], "page string, target_id string, author string, text string")
    found = {r["page"]: r["status"] for r in feeds.nested_articles(frame).collect()}
    assert set(found) == set(texts)
    assert found["flat"] == found["deep"] == "ok" and found["two"] == "2 articles"
    assert {found[k] for k in ("deepest", "open", "none", "bad")} == {"0 articles"}
    assert feeds.nested_articles(frame.where("false")).count() == 0


CANDIDATE = "publisher long, issue int, value string, document_order int, position long, parser string, document string, source_url string, source_type string, record string, seq long, block string, error string"


def authority(name, cells, publisher=1, url="u", start=0):
    return [(publisher, i, v, 0, k + start, "p", name, url, "page", "", k, b, None) for k, (i, v, b) in enumerate(cells)]


def brute_fragments(rows):
    whole = {}
    for r in rows:
        whole.setdefault((r[0], r[7], r[6]), []).append(r)
    shown = {k: [(r[1], r[2], (r[11] or "").strip()) for r in sorted(own, key=lambda r: r[4])] for k, own in whole.items()}
    shown = {k: c for k, c in shown.items() if all(b for _, _, b in c)}
    inside = lambda s, c: any(c[i : i + len(s)] == s for i in range(len(c) - len(s) + 1))
    return {k for k, s in shown.items() if any(k[:2] == o[:2] and len(s) < len(c) and inside(s, c) for o, c in shown.items())}


def test_fragments_equal_brute_force(spark):
    rnd = random.Random(17)
    rows = []
    for p in range(12):
        base = [(rnd.randrange(3), str(rnd.randrange(2)), "b") for _ in range(rnd.randrange(1, 30))]
        for d in range(8):
            a = rnd.randrange(len(base))
            cells = base[a : a + rnd.randrange(1, 12)]
            if rnd.random() < 0.3:
                cells = [*cells, (9, "9", rnd.choice(["", "b"]))]
            rows += authority(f"d{d}", cells, p, rnd.choice(["u", "v"]), rnd.randrange(5))
        rows += authority("all", base, p) + authority("again", base, p, start=3)
    rows += [(*authority("x", [(1, "1", "b")])[0][:8], "feed", *authority("x", [(1, "1", "b")])[0][9:])]
    frame = spark.createDataFrame(rows, CANDIDATE)
    gone = brute_fragments([r for r in rows if r[8] == "page"])
    left = {(r["publisher"], r["source_url"], r["document"]) for r in reconcile.without_fragments(frame).collect()}
    assert left == {(r[0], r[7], r[6]) for r in rows} - gone and gone
    assert reconcile.without_fragments(frame.where("false")).count() == 0


def test_a_long_authority_stays_linear(spark):
    """100,000 records of one page, a fragment of 40,000 in them and one that differs in its last record."""
    n = 100_000
    rows = spark.range(n).select(F.col("id").alias("k"), F.lit("all").alias("document"))
    part = spark.range(30_000, 70_000).select(F.col("id").alias("k"), F.lit("part").alias("document"))
    off = spark.range(50_000, 60_000).select(F.when(F.col("id") == 59_999, -1).otherwise(F.col("id")).alias("k"), F.lit("off").alias("document"))
    frame = rows.unionByName(part).unionByName(off).select(
        F.lit(1).cast("long").alias("publisher"), (F.col("k") % 365).cast("int").alias("issue"), (F.col("k") % 10).cast("string").alias("value"), F.lit(0).alias("document_order"),
        F.when(F.col("k") < 0, n).otherwise(F.col("k")).cast("long").alias("position"), F.lit("p").alias("parser"), "document", F.lit("u").alias("source_url"), F.lit("page").alias("source_type"),
        F.lit("").alias("record"), F.col("k").alias("seq"), F.concat(F.lit("b"), (F.abs("k") % 5000).cast("string")).alias("block"), F.lit(None).cast("string").alias("error"),
    )
    assert {r["document"] for r in reconcile.without_fragments(frame).select("document").distinct().collect()} == {"all", "off"}


@pytest.mark.parametrize("exponent", [0, 1, 2, 1000, 123_456_789])
def test_powers(spark, exponent):
    for base, prime in zip(reconcile.BASES, reconcile.PRIMES):
        for b in (base, pow(base, -1, prime)):
            assert spark.range(1).select(reconcile.power(b, prime, F.lit(exponent).cast("long"))).first()[0] == pow(b, exponent, prime)


def test_a_huge_page_has_a_task_of_its_own(spark):
    small = spark.range(10_000).select(F.col("id").cast("string").alias("url"), F.repeat(F.lit("x"), (F.col("id") % 3000).cast("int")).alias("html"))
    huge = spark.range(1).select(F.lit("huge").alias("url"), F.repeat(F.lit("y"), 5_000_000).alias("html"))
    none = spark.range(1).select(F.lit("none").alias("url"), F.lit(None).cast("string").alias("html"))
    dealt = pages.packed(small.unionByName(huge).unionByName(none), "html", 1_000_000)
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("bytes"), F.max("url").alias("url")).collect()
    assert [(r["n"], r["url"]) for r in tasks if r["bytes"] >= 5_000_000] == [(1, "huge")]
    rest = [r["bytes"] for r in tasks if r["bytes"] < 5_000_000]
    assert len(rest) == 14 and max(rest) < 1.3 * sum(rest) / len(rest) and sum(r["n"] for r in tasks) == 10_002
    assert pages.packed(small.where("false"), "html").count() == 0

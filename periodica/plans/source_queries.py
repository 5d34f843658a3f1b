"""Sources and the stream, on data rendered from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..helpers.tables import scratch
from ..sources import pages, reports
from ..streaming import roll
from . import observed as O
from .registry import query


def named(spark, sf_dir):
    own = O.series(spark, sf_dir).join(O.publishers(spark, sf_dir).select("publisher", "idx", "name", "url", "pick"), "publisher")
    bad = F.col("publisher") % 6 == 0
    fail = F.format_string("失败 %s %s 方向: %s 期数: %d 阶段: issue 原因: timeout %d", "name", "url", "pick", "issue", "issue")
    return own.select("issue", "idx", "name", "url", "pick", F.when(~bad, F.col("value")).alias("value"), F.when(bad, fail).alias("line"))


@query("s4_s7_success_reports", f"WITH {O.series_sql()} SELECT issue, 'P' || publisher AS name, value FROM series WHERE publisher % 6 <> 0")
def s4(spark, sf_dir):
    path = scratch(spark)
    reports.write_reports(reports.report_lines(named(spark, sf_dir)), path)
    lines = reports.read_report_lines(spark, path).where("report = 'successes'")
    keyed = lines.withColumn("line", F.when(F.col("line").rlike("尾 P"), F.concat("line", F.lit("@"), "issue")).otherwise(F.col("line")))
    found = reports.success_lines(keyed)
    return found.select(F.substring_index("name", "@", -1).cast("int").alias("issue"), F.substring_index("name", "@", 1).alias("name"), "value")


@query("s5_failure_blocks", f"WITH {O.series_sql()} SELECT 'P' || publisher AS name, 'https://p' || publisher || '.example/list' AS url, CASE WHEN publisher % 2 = 0 THEN 'bottom' ELSE 'top' END AS pick, issue, 'issue' AS stage, 'timeout ' || issue AS reason FROM series WHERE publisher % 6 = 0")
def s5(spark, sf_dir):
    path = scratch(spark)
    reports.write_reports(reports.report_lines(named(spark, sf_dir)), path)
    return reports.failure_blocks(reports.read_report_blocks(spark, path).where("report = 'failures'")).drop("place")


@query("s6_failure_lines", f"WITH {O.series_sql()} SELECT 'P ' || publisher AS name, CASE WHEN max(issue) % 4 = 0 THEN '失败原因为空' ELSE 'r' || max(issue) END AS reason FROM series GROUP BY publisher")
def s6(spark, sf_dir):
    p, i = F.col("publisher").cast("string"), F.col("issue").cast("string")
    old = F.concat(F.lit("失败 P "), p, F.lit(" https://p.example/ 原因: "), F.when(F.col("issue") % 4 == 0, "").otherwise(F.concat(F.lit("r"), i)))
    new = F.concat(F.lit("失败 P "), p, F.lit(" https://p.example/ 方向: top 期数: "), i, F.lit(" 阶段: x 原因: "), F.when(F.col("issue") % 4 == 0, "").otherwise(F.concat(F.lit("r"), i)))
    broken = F.concat(F.lit("失败 P "), p, F.lit(" https://p.example/ 方向: top 原因: late"))
    own = O.series(spark, sf_dir)
    lines = own.select(F.col("issue").alias("place"), F.when(F.col("issue") % 2 == 0, old).otherwise(new).alias("line")).unionByName(own.select((F.col("issue") + 100).alias("place"), broken.alias("line")))
    return reports.failure_reasons(lines)


@query("s7_written_results", f"WITH {O.series_sql()} SELECT issue, publisher, CASE WHEN issue = 7 THEN '0' ELSE value END AS value FROM series")
def s7(spark, sf_dir):
    own, path = O.series(spark, sf_dir).select("issue", "publisher", "value"), scratch(spark)
    reports.write_results(own, path)
    reports.write_results(own.where("issue = 7").withColumn("value", F.lit("0")), path)  # replaces that issue only
    return spark.read.schema(own.schema).parquet(path).select("issue", "publisher", "value")


@query("s8_documents", "SELECT url AS source_url, 'page' AS source_type, '' AS record_id, sha256(html) AS document_id FROM pages")
def s8(spark, sf_dir):
    return pages.documents_of(O.table(spark, sf_dir, "pages")).drop("content")


@query("s8_packed_pages", "SELECT url AS source_url, sha256(html) AS document_id, length(html) AS n FROM pages")
def s8_packed(spark, sf_dir):
    """Pages dealt by their bytes: tasks of about a hundredth of all."""
    own = O.table(spark, sf_dir, "pages").select("url", "html")
    every = own.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    return pages.packed(own, "html", max(1, every // 100)).select(F.col("url").alias("source_url"), F.sha2("html", 256).alias("document_id"), F.char_length("html").cast("long").alias("n"))


@query("s9_decoded_bodies", "SELECT doc_id, text FROM documents")
def s9(spark, sf_dir):
    docs = O.table(spark, sf_dir, "documents").select("doc_id", "text")
    k = F.col("doc_id") % 3
    body = F.when(k == 0, F.encode("text", "UTF-8")).when(k == 1, F.encode("text", "UTF-16LE")).otherwise(F.encode("text", "UTF-16BE"))
    kind = F.when(k == 0, "text/html").when(k == 1, "text/html; charset=utf-16-le").otherwise('text/html; charset="UTF-16-BE"')
    return pages.decode(docs.select("doc_id", body.alias("body"), kind.alias("content_type"), F.lit("").alias("encoding"))).select("doc_id", "text")


@query("s10_placeholders", "SELECT event_id, event_id % 5 < 3 AS empty FROM events")
def s10(spark, sf_dir):
    k = F.col("event_id") % 5
    body = F.when(k == 0, ' "OK" ').when(k == 1, "''").when(k == 2, "AbcAbc").otherwise(F.concat(F.lit("ok "), F.col("event_type")))
    return O.table(spark, sf_dir, "events").select("event_id", pages.placeholder(body).alias("empty"))


@query("t1_t2_normalize", "SELECT event_id, '[1尾] ' || event_type || ':绝杀' AS text, CASE event_id % 4 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' WHEN 2 THEN 'bottom' END AS pick FROM events")
def t1(spark, sf_dir):
    k = F.col("event_id") % 4
    text = F.concat(F.lit("　【①尾】\xa0 "), F.col("event_type"), F.lit("：絕殺 "))
    pick = F.when(k == 0, " 顶部").when(k == 1, "下").when(k == 2, "Bottom ").otherwise("side")
    return O.table(spark, sf_dir, "events").select("event_id", T.normalize(text).alias("text"), T.canonical_pick(pick).alias("pick"))


ROLL = f"""WITH {O.series_sql()}, {O.PUBLISHERS}, top AS (SELECT max(issue) AS top FROM series), grid AS (SELECT publisher, CAST(unnest(range(top - 9, top + 1)) AS INTEGER) AS issue FROM publishers, top WHERE NOT archived),
late AS (SELECT publisher, issue, CAST((CAST(value AS INTEGER) + 1) % 10 AS VARCHAR) AS value FROM series, top WHERE issue = top - 4 AND publisher % 4 = 1)"""


def streamed(spark, sf_dir, batches):
    """The store after a stream in which each of `batches` (functions of the series and its last issue) arrived as files."""
    root = scratch(spark)
    own = O.series(spark, sf_dir).withColumn("reason", F.lit(None).cast("string"))
    top = own.agg(F.max("issue")).first()[0] or 0
    store = roll.StateStore(spark, f"{root}/state")
    held = O.publishers(spark, sf_dir).withColumn("paired", F.lit(False))
    for batch in batches:
        batch(own, top).coalesce(8).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(own.schema).option("maxFilesPerTrigger", 1000).parquet(f"{root}/in")
        roll.roll_stream(source, held, store, f"{root}/checkpoint").awaitTermination()
    return store


def corrections(own, top):
    late = own.where(F.col("issue").isin(top - 4, 3) & (F.col("publisher") % 4 == 1))
    return late.withColumn("value", ((F.col("value").cast("int") + 1) % 10).cast("string"))


@query("w1_continuous_roll", ROLL + """ SELECT g.publisher, g.issue, coalesce(l.value, s.value) AS value FROM grid g LEFT JOIN series s USING (publisher, issue) LEFT JOIN late l ON l.publisher = g.publisher AND l.issue = g.issue""")
def w1(spark, sf_dir):
    """All but the last two issues arrive, then those with corrections of an issue of the window and of an older one, which is refused."""
    first = lambda own, top: own.where(F.col("issue") <= top - 2)
    store = streamed(spark, sf_dir, [first, lambda own, top: own.where(F.col("issue") > top - 2).unionByName(corrections(own, top))])
    return store.read(1).select("publisher", "issue", "value")


@query("w1_gated_roll", ROLL + """, old AS (SELECT publisher, CAST(unnest(range(top - 11, top - 1)) AS INTEGER) AS issue FROM publishers, top WHERE NOT archived)
SELECT 'state' AS what, o.publisher, o.issue, s.value AS said FROM old o LEFT JOIN series s USING (publisher, issue)
UNION ALL SELECT 'faults 1', publisher, issue, 'value' FROM series, top WHERE issue = top - 1 AND publisher % 10 = 1
UNION ALL SELECT 'faults 1', publisher, NULL, 'values' FROM series, top WHERE issue = top - 1 AND publisher % 10 = 1 AND publisher % 23 <> 0
UNION ALL SELECT 'faults 2', NULL, top - 1, 'nothing succeeded' FROM top""")
def w1_gated(spark, sf_dir):
    """A good batch, one with values of the wrong form and one in which all failed: the state stays that of the first."""
    bad = F.when(F.col("publisher") % 10 == 1, "77x").otherwise(F.col("value"))
    store = streamed(spark, sf_dir, [
        lambda own, top: own.where(F.col("issue") <= top - 2),
        lambda own, top: own.where(F.col("issue") == top - 1).withColumn("value", bad),
        lambda own, top: own.where(F.col("issue") == top - 1).select("publisher", "issue", F.lit(None).cast("string").alias("value"), F.lit("HTTP Error 500").alias("reason")),
    ])
    rows = store.read(2).select(F.lit("state").alias("what"), "publisher", "issue", F.col("value").alias("said"))
    for version in (1, 2):
        rows = rows.unionByName(store.faults(version).select(F.lit(f"faults {version}").alias("what"), "publisher", "issue", F.col("fault").alias("said")))
    return rows


@query("w1_quarantine_replay", ROLL + f""" SELECT 'state' AS what, g.publisher, g.issue, s.value, CASE WHEN s.value IS NULL THEN '{fixed.DEFAULT_REASON}' END AS reason FROM grid g LEFT JOIN series s ON s.publisher = g.publisher AND s.issue = g.issue
UNION ALL SELECT 'waiting 1', publisher, issue, CASE WHEN publisher % 10 = 1 THEN '77x' ELSE value END, 'value' FROM series, top WHERE issue = top - 2
UNION ALL SELECT 'waiting 2', publisher, issue, CASE WHEN publisher % 10 = 1 THEN '77x' ELSE value END, 'value' FROM series, top WHERE issue = top - 2""")
def w1_replay(spark, sf_dir):
    """An issue comes with values of the wrong form beside a good one, which is taken; later ones follow; then the bad
    values alone come right. The state is that of a run without a fault, and nothing waits any more."""
    bad = F.when((F.col("publisher") % 10 == 1) & (F.col("issue") == F.col("top") - 2), "77x").otherwise(F.col("value"))
    issue = F.col("issue")
    store = streamed(spark, sf_dir, [
        lambda own, top: own.where(issue <= top - 4),
        lambda own, top: own.where(issue.between(top - 3, top - 2)).withColumn("top", F.lit(top)).withColumn("value", bad).drop("top"),
        lambda own, top: own.where(issue == top - 1),
        lambda own, top: own.where((issue == top) | (issue == top - 2) & (F.col("publisher") % 10 == 1)),
    ])
    rows = store.read(3).select(F.lit("state").alias("what"), "publisher", "issue", "value", "reason")
    for version in (1, 2, 3):
        rows = rows.unionByName(store.waiting(version).select(F.lit(f"waiting {version}").alias("what"), "publisher", "issue", "value", F.col("fault").alias("reason")))
    return rows


ARRIVALS = """o AS (SELECT event_id AS seq, user_id AS publisher, CAST(CAST(floor(value) AS BIGINT) % 10 AS VARCHAR) AS value, (event_id * 2937600) // (SELECT max(event_id) + 1 FROM events) AS second FROM events),
a AS (SELECT *, CAST(second // 86400 + 1 - (seq * 7919) % 15 AS INTEGER) AS issue FROM o), b AS (SELECT * FROM a WHERE issue >= 1),
j AS (SELECT *, coalesce(issue <= max(issue) OVER (PARTITION BY publisher ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10, false) AS refused, max(issue) OVER (PARTITION BY publisher) AS newest, max(second) OVER () AS clock FROM b)"""


@query("w2_keyed_state", f"""WITH {ARRIVALS} SELECT 'held' AS kind, publisher, issue, arg_max(value, seq) AS value, NULL AS seq FROM j WHERE NOT refused AND issue > newest - 10 AND (issue + 9) * 86400 > clock - 1 GROUP BY publisher, issue
UNION ALL SELECT 'refused', publisher, issue, value, seq FROM j WHERE refused""")
def w2_keyed(spark, sf_dir):
    """Results in shuffled order in three parts, the query started anew from its checkpoint for each."""
    from ..streaming import keyed

    rows = O.observations(spark, sf_dir).select("publisher", "value", "seq")
    ids = rows.agg(F.max("seq")).first()[0] or 0
    second = F.expr(f"(seq * 2937600L) div {ids + 1}L")
    issue = (F.floor(second / 86400) + 1 - (F.col("seq") * 7919) % 15).cast("int")
    own = rows.select("publisher", issue.alias("issue"), "value", F.lit(None).cast("string").alias("reason"), "seq", F.timestamp_seconds(second + 1704067200).alias("at")).where("issue >= 1")
    root = scratch(spark)
    for part in range(3):
        third = F.expr(f"(seq * 3L) div {ids + 1}L") == part
        own.where(third).coalesce(8).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(own.schema).option("maxFilesPerTrigger", 1000).parquet(f"{root}/in")
        keyed.keyed_stream(source, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    log = keyed.changes(spark, f"{root}/log")
    held = keyed.held_cells(log).select(F.lit("held").alias("kind"), "publisher", "issue", "value", F.lit(None).cast("long").alias("seq"))
    return held.unionByName(keyed.refused_results(log).select(F.lit("refused").alias("kind"), "publisher", "issue", "value", "seq"))


@query("w2_late_results", """WITH o AS (SELECT event_id, user_id AS publisher, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS arrived, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 - event_id % 15 AS INTEGER) AS issue FROM events),
d AS (SELECT arrived, max(max(issue)) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o GROUP BY arrived)
SELECT event_id, CASE WHEN issue <= before - 10 THEN 'refused' ELSE 'accepted' END AS status FROM o JOIN d USING (arrived)""")
def w2(spark, sf_dir):
    own = O.observations(spark, sf_dir).select(F.col("seq").alias("event_id"), "publisher", F.col("issue").alias("arrived"), (F.col("issue") - F.col("seq") % 15).cast("int").alias("issue"))
    return roll.horizon(own).select("event_id", "status")


def written(spark, lines):
    """The column `value` written as lines of text; the path."""
    path = scratch(spark)
    lines.select("value").write.text(path)
    return path


@query("s1_publishers", f"""WITH {O.PUBLISHERS}, p AS (SELECT *, publisher % 10 = 3 AS bad_pick, publisher % 10 = 4 AS bad_url, publisher % 10 = 5 AS twice FROM publishers),
n AS (SELECT publisher, row_number() OVER (ORDER BY publisher) AS idx FROM p WHERE NOT archived AND NOT bad_pick AND NOT bad_url AND NOT (twice AND (SELECT count(*) FROM p WHERE twice AND NOT archived) > 1))
SELECT publisher AS place, CASE WHEN bad_pick THEN 'unknown pick' WHEN bad_url THEN 'no http URL with a host' WHEN twice AND NOT archived AND (SELECT count(*) FROM p WHERE twice AND NOT archived) > 1 THEN 'name twice' ELSE pick || ' ' || n.idx END AS said
FROM p LEFT JOIN n USING (publisher) WHERE NOT archived OR bad_pick OR bad_url""")
def s1(spark, sf_dir):
    from ..sources.publishers import load_publisher_lines

    p = F.col("publisher")
    item = F.struct(
        p.alias("place"), F.when(p % 10 == 5, " same").otherwise(F.col("name")).alias("name"), F.when(p % 10 == 4, "ftp://x").otherwise(F.col("url")).alias("url"),
        F.when(p % 10 == 3, "side").when(p % 2 == 0, "尾部").otherwise(" Top").alias("pick"), F.col("archived").alias("archived"),
    )
    ids = O.publishers(spark, sf_dir)
    valid, bad = load_publisher_lines(spark, written(spark, ids.select(F.to_json(item).alias("value"))))
    good = valid.join(ids.select("publisher", "url"), "url").select(F.col("publisher").alias("place"), F.concat_ws(" ", "pick", "idx").alias("said"))
    return good.unionByName(bad.select(F.col("place").cast("long").alias("place"), F.col("violation").alias("said")))


def state_lines(spark, v, header):
    """A state of vectors `v` (with idx, name, url, pick, archived), written as lines."""
    item = F.struct(
        F.col("idx").alias("place"), "name", "url", "pick", "archived", F.col("issues").alias("periods"), "values", "extended",
        F.col("failed").alias("failed_periods"), F.col("reasons").alias("failure_reasons"),
    )
    return written(spark, header.select(F.to_json(F.struct("*")).alias("value")).unionByName(v.select(F.to_json(item).alias("value"))))


@query("s2_s3_state_file", f"""WITH {O.series_sql()}, {O.STATE}, {O.RESULTS}, {O.PUBLISHERS}, grid AS (SELECT publisher, CAST(unnest(range({O.LAST_ISSUE - 9}, {O.LAST_ISSUE + 1})) AS INTEGER) AS issue FROM publishers WHERE NOT archived),
v AS (SELECT publisher, issue, CASE WHEN issue = {O.LAST_ISSUE} THEN r.value ELSE s.value END AS value FROM grid LEFT JOIN state s USING (publisher, issue) LEFT JOIN results r USING (publisher))
SELECT 'P' || publisher || '|https://p' || publisher || '.example/list|' || CASE WHEN publisher % 2 = 0 THEN 'bottom' ELSE 'top' END AS publisher, issue, value, '' AS faults FROM v""")
def s2(spark, sf_dir):
    from ..operators import rolling
    from ..sources import state as S

    pubs = O.publishers(spark, sf_dir)
    rolled = rolling.roll(O.state(spark, sf_dir), pubs, O.results(spark, sf_dir), O.LAST_ISSUE)
    v = rolling.as_vectors(rolled).join(pubs.select("publisher", "idx", "name", "url", "pick", "archived"), "publisher")
    holed = F.size("failed") > 0
    head = v.agg(
        F.lit(2).alias("schema"), F.lit(O.LAST_ISSUE).alias("period"), F.lit(10).alias("window"), F.count("*").alias("site_count"), F.count_if(~holed).alias("vector_count"), F.count_if(holed).alias("fail_count")
    )
    header, items = S.state_lines(spark, state_lines(spark, v, head))
    plain = pubs.select("url", F.lit(False).alias("paired"))
    faults = S.state_faults(header, items, O.LAST_ISSUE, plain, complete=False).agg(F.array_join(F.array_sort(F.collect_set("fault")), ",").alias("faults"))
    return S.long_state(items).select("publisher", "issue", "value", F.lit(faults.first()["faults"]).alias("faults"))


@query("s2_strict_faults", f"""WITH {O.series_sql()}, {O.PUBLISHERS}, w AS (SELECT publisher, count(*) AS n FROM series WHERE issue BETWEEN {O.LAST_ISSUE - 9} AND {O.LAST_ISSUE} GROUP BY publisher),
v AS (SELECT publisher, idx, n FROM publishers JOIN w USING (publisher) WHERE NOT archived)
SELECT 'item ' || idx AS fault FROM v WHERE n < 10 OR publisher % 10 IN (1, 2) UNION ALL SELECT 'fingerprint' UNION ALL SELECT 'fail count' FROM (SELECT count(*) FILTER (n < 10) AS f FROM v) WHERE f > 0""")
def s2_strict(spark, sf_dir):
    """The strict reading of a state in which some values have the wrong form, some issues the wrong order, and whose fingerprint is an old one."""
    from ..operators import rolling
    from ..sources import state as S

    pubs, p = O.publishers(spark, sf_dir), F.col("publisher")
    none = O.series(spark, sf_dir).where(F.lit(False)).select("publisher", "issue", "value", F.lit("").alias("reason"))
    runs = list(range(O.LAST_ISSUE - 9, O.LAST_ISSUE + 1))
    own = O.series(spark, sf_dir).where(F.col("issue").isin(*runs)).withColumn("reason", F.lit(None).cast("string"))
    kept = pubs.join(own.select("publisher").distinct(), "publisher", "left_semi")
    v = rolling.as_vectors(rolling.roll_runs(none, kept, own, runs)).join(pubs.select("publisher", "idx", "name", "url", "pick", "archived"), "publisher")
    v = v.withColumn("values", F.when(p % 10 == 1, F.transform("values", lambda x: F.concat(x, F.lit("尾")))).otherwise(F.col("values")))
    v = v.withColumn("issues", F.when(p % 10 == 2, F.reverse("issues")).otherwise(F.col("issues")))
    holed = F.size("failed") > 0
    head = v.agg(
        F.lit(2).alias("schema"), F.lit(O.LAST_ISSUE).alias("period"), F.lit(10).alias("window"), F.lit("old").alias("config_fingerprint"),
        F.count("*").alias("site_count"), F.count_if(~holed).alias("vector_count"), F.count_if(holed).alias("fail_count"),
    )
    header, items = S.state_lines(spark, state_lines(spark, v, head))
    return S.state_faults(header, items, O.LAST_ISSUE, pubs.select("url", F.lit(False).alias("paired")), fingerprint="new", complete=True)

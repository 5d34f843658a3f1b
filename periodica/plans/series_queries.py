"""Queries on series, rolling state, rankings and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed, issues
from ..functions import text as T
from ..helpers.tables import scratch, stored
from ..operators import ranking, rolling
from ..operators import series as S
from ..sources.buckets import BucketedState
from ..sources.gram_index import GramIndex
from . import observed as O
from .registry import query

SERIES = O.series_sql()
BINARY = O.series_sql(2)


@query("a1_digit_ranking", f"""WITH {O.CANDIDATES}, picked AS (SELECT publisher, issue, CASE WHEN publisher % 2 = 0 THEN arg_max(value, seq) ELSE arg_min(value, seq) END AS value FROM candidates GROUP BY publisher, issue),
e AS (SELECT issue, unnest(string_split(value, '、')) AS value FROM picked), c AS (SELECT issue, value, count(*) AS times FROM e GROUP BY issue, value)
SELECT issue, value, times, CAST(dense_rank() OVER (PARTITION BY issue ORDER BY times DESC) AS INTEGER) AS rank FROM c""")  # fmt: skip
def a1(spark, sf_dir):
    own = O.candidates(spark, sf_dir)
    even = F.col("publisher") % 2 == 0
    picked = own.groupBy("publisher", "issue").agg(F.when(F.bool_or(even), F.max_by("value", "seq")).otherwise(F.min_by("value", "seq")).alias("value"))
    return ranking.digit_ranking(picked)


@query("a2_success_report", f"""WITH {SERIES}, {O.PUBLISHERS}, r AS (SELECT issue, idx, name, value FROM series JOIN publishers USING (publisher)),
c AS (SELECT issue, value, count(*) AS times FROM r GROUP BY issue, value),
k AS (SELECT *, dense_rank() OVER (PARTITION BY issue ORDER BY times DESC) AS rank, row_number() OVER (PARTITION BY issue ORDER BY times DESC, value) AS place FROM c)
SELECT issue, 1 AS section, CAST(idx AS BIGINT) AS place, value || '尾 ' || name AS line FROM r
UNION ALL SELECT issue, 2, place, value || '尾 ' || times || ' ' || rank FROM k""")
def a2(spark, sf_dir):
    named = O.series(spark, sf_dir).join(O.publishers(spark, sf_dir).select("publisher", "idx", "name"), "publisher")
    return ranking.success_report(named)


@query("a3_failure_summary", """WITH f AS (SELECT user_id % 5 AS site, CASE event_id % 7 WHEN 0 THEN 'HTTP Error 404' WHEN 1 THEN 'read timed out' WHEN 2 THEN 'SSL: UNEXPECTED_EOF' WHEN 3 THEN 'connection reset by peer'
  WHEN 4 THEN '没有找到期' WHEN 5 THEN '值非0-9尾' ELSE 'odd ' || event_type END AS reason FROM events)
SELECT site, CASE WHEN contains(reason, '没有找到') THEN '没有数据' WHEN contains(reason, '非0-9尾') THEN '非0-9尾' WHEN contains(lower(reason), 'ssl') THEN 'TLS失败' WHEN contains(reason, 'connection reset') THEN '连接断开'
  WHEN contains(reason, 'timed out') THEN '超时' WHEN contains(lower(reason), 'http error') THEN 'HTTP失败' ELSE '抓取/解析失败' END AS class, count(*) AS times FROM f GROUP BY ALL""")
def a3(spark, sf_dir):
    k = F.col("event_id") % 7
    texts = ["HTTP Error 404", "read timed out", "SSL: UNEXPECTED_EOF", "connection reset by peer", "没有找到期", "值非0-9尾"]
    reason = F.concat(F.lit("odd "), F.col("event_type"))
    for i, t in enumerate(texts):
        reason = F.when(k == i, t).otherwise(reason)
    rows = O.table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("site"), reason.alias("reason"))
    return ranking.failure_summary(rows, ["site"])


@query("a4_run_totals", f"""WITH {O.OBS} SELECT issue, count(*) FILTER (kind <> 'error') AS successes, count(*) FILTER (kind = 'error') AS failures, count(*) AS total, count(*) FILTER (kind <> 'error') > 0 AS may_roll FROM obs GROUP BY issue""")
def a4(spark, sf_dir):
    return ranking.run_totals(O.observations(spark, sf_dir).withColumn("value", F.when(F.col("kind") != "error", F.col("value"))))


@query("a6_rebuild_report", f"""WITH {SERIES}, {O.STATE}, {O.PUBLISHERS} SELECT p.publisher, s.value, s.value IS NULL AS skipped FROM publishers p
LEFT JOIN (SELECT * FROM state WHERE issue = {O.LAST_ISSUE - 3} AND value IS NOT NULL) s USING (publisher) WHERE NOT archived""")
def a6(spark, sf_dir):
    held, skipped = ranking.rebuild_report(O.state(spark, sf_dir), O.publishers(spark, sf_dir), O.LAST_ISSUE - 3)
    return held.select("publisher", "value", F.lit(False).alias("skipped")).unionByName(skipped.select("publisher", F.lit(None).cast("string").alias("value"), F.lit(True).alias("skipped")))


@query("a7_health", """WITH r AS (SELECT 'https://p' || user_id || '.example/list' AS key, ts, event_type <> 'error' AS ok, 'HTTP Error ' || (event_id % 600) AS reason FROM events)
SELECT key, count(*) FILTER (ok) AS success_count, count(*) FILTER (NOT ok) AS fail_count, max(ts) FILTER (ok) AS last_success, max(ts) FILTER (NOT ok) AS last_failure,
arg_max(reason, ts) FILTER (NOT ok) AS last_error, arg_max(CASE WHEN ok THEN '' ELSE 'HTTP失败' END, ts) AS last_error_category FROM r GROUP BY key""")
def a7(spark, sf_dir):
    ok = F.col("event_type") != "error"
    rows = O.table(spark, sf_dir, "events").select(
        F.concat(F.lit("https://p"), F.col("user_id").cast("string"), F.lit(".example/list")).alias("key"), F.col("ts").cast("timestamp").alias("at"), ok.alias("ok"),
        F.concat(F.lit("HTTP Error "), (F.col("event_id") % 600).cast("string")).alias("reason"),
    )
    early = F.col("at") < F.lit("2024-01-15").cast("timestamp")
    empty = rows.where(F.lit(False)).select("key", *[F.lit(0).cast("long").alias(c) for c in ("success_count", "fail_count")], F.col("at").alias("last_success"), F.col("at").alias("last_failure"), F.col("reason").alias("last_error"), F.col("reason").alias("last_error_category"))
    found = ranking.health(ranking.health(empty, rows.where(early)), rows.where(~early))
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_success", "last_failure")})


@query("a8_health_keys", f"""WITH {O.PUBLISHERS}, p AS (SELECT idx, name, 'https://shared' || publisher // 3 || '.example/' AS url FROM publishers),
f AS (SELECT url, arg_min(name, idx) AS owner FROM p GROUP BY url) SELECT idx, CASE WHEN name = owner THEN url ELSE url || '#name=' || name END AS key FROM p JOIN f USING (url)""")
def a8(spark, sf_dir):
    url = F.concat(F.lit("https://shared"), F.floor(F.col("publisher") / 3).cast("string"), F.lit(".example/"))
    own = O.publishers(spark, sf_dir).select("idx", "name", url.alias("url"))
    return ranking.health_keys(own, own.where(F.lit(False)).select(F.col("url").alias("key"), "name"))


def runs_sql(series: str, more: str = "true") -> str:
    return f"""WITH {series}, p AS (SELECT publisher, string_agg(issue || ':' || value, ',' ORDER BY issue) AS cells FROM series WHERE {more} GROUP BY publisher), rep AS (SELECT * FROM series WHERE publisher IN (SELECT min(publisher) FROM p GROUP BY cells)),
{best_sql("rep")}"""


def best_sql(series: str) -> str:
    return f"""eq AS (SELECT a.publisher AS a, b.publisher AS b, a.issue FROM {series} a JOIN {series} b ON a.issue = b.issue AND a.value = b.value AND a.publisher < b.publisher),
g AS (SELECT *, issue + row_number() OVER (PARTITION BY a, b ORDER BY issue DESC) AS island FROM eq),
r AS (SELECT a, b, max(issue) AS start, min(issue) AS "end", count(*) AS length FROM g GROUP BY a, b, island HAVING count(*) >= 3),
best AS (SELECT a, b, length, start, "end", CASE WHEN length >= 6 THEN 'duplicate' ELSE 'suspect' END AS level FROM r QUALIFY row_number() OVER (PARTITION BY a, b ORDER BY length DESC, start DESC) = 1)"""


FEW = "publisher % 50 = 0"  # whose values are taken modulo 2, which makes long runs


@query("d1_equal_runs", f"WITH {BINARY}, {best_sql('series')} SELECT * FROM best")
def d1(spark, sf_dir):
    """All pairs of publishers, copies too."""
    return S.equal_runs(O.series(spark, sf_dir, 2))


@query("d1_equal_real_runs", runs_sql(SERIES) + " SELECT * FROM best")
def d1_real(spark, sf_dir):
    """Of all ten digits: pairs of class representatives."""
    return S.equal_runs(O.series(spark, sf_dir), expand=False)


@query("d1_long_equal_runs", runs_sql(BINARY, FEW) + " SELECT * FROM best")
def d1_long(spark, sf_dir):
    return S.equal_runs(O.series(spark, sf_dir, 2).where(FEW), expand=False)


@query("a9_match_report", f"WITH {BINARY}, {best_sql('series')}" + " SELECT level, count(*) AS pairs, max(length) AS longest FROM best GROUP BY level")
def a9(spark, sf_dir):
    """All pairs of publishers, copies too, counted by class."""
    return ranking.match_report(S.counted_runs(O.series(spark, sf_dir, 2)))


@query("a9_ordered_matches", runs_sql(BINARY, FEW) + """, v AS (SELECT b.a, b.b, string_agg(s.value, '|' ORDER BY s.issue DESC) AS "values" FROM best b JOIN series s ON s.publisher = b.a AND s.issue BETWEEN b."end" AND b.start GROUP BY b.a, b.b)
SELECT row_number() OVER (ORDER BY start DESC, 'P' || a, a, b) AS place, level, a, b, 'P' || a AS a_name, 'P' || b AS b_name, start, "end", "values" FROM best JOIN v USING (a, b)""")
def a9_ordered(spark, sf_dir):
    names = O.publishers(spark, sf_dir).select("publisher", "name")
    found = ranking.ordered_matches(d1_long(spark, sf_dir), O.series(spark, sf_dir, 2), names)
    return found.withColumn("values", F.array_join("values", "|"))


@query("d1_equal_series_classes", f"""WITH {SERIES}, w AS (SELECT publisher, issue, CAST(CAST(value AS INTEGER) % 2 AS VARCHAR) AS value FROM series),
p AS (SELECT publisher, string_agg(issue || ':' || value, ',' ORDER BY issue) AS cells FROM w GROUP BY publisher) SELECT publisher, min(publisher) OVER (PARTITION BY cells) AS rep FROM p""")
def d1_classes(spark, sf_dir):
    return S.classes_of_equal_series(O.series(spark, sf_dir, 2))


D2 = f"""WITH {BINARY}, w AS (SELECT *, publisher % 7 = 0 AS paired FROM series WHERE issue BETWEEN 16 AND 25),
cells AS (SELECT publisher AS candidate, count(*) AS cells FROM w WHERE publisher % 10 = 3 GROUP BY publisher),
eq AS (SELECT c.publisher AS candidate, e.publisher, issue FROM w c JOIN w e USING (issue, value, paired) WHERE c.publisher % 10 = 3 AND e.publisher % 10 <> 3),
g AS (SELECT *, issue + row_number() OVER (PARTITION BY candidate, publisher ORDER BY issue DESC) AS island FROM eq),
r AS (SELECT candidate, publisher, max(issue) AS start, min(issue) AS "end", count(*) AS length FROM g GROUP BY candidate, publisher, island),
j AS (SELECT r.*, cells, sum(length) OVER (PARTITION BY candidate, publisher) AS equal, max(length) OVER (PARTITION BY candidate, publisher) AS most FROM r JOIN cells USING (candidate)),
found AS (SELECT candidate, publisher, CASE WHEN cells = 10 AND equal = 10 THEN 'identical' WHEN most >= 6 AND length >= 6 THEN 'duplicate' WHEN most < 6 AND length >= 3 THEN 'suspicion' END AS kind, length, start, "end" FROM j)"""


def judged(spark, sf_dir):
    own = O.series(spark, sf_dir, 2).where("issue BETWEEN 16 AND 25").withColumn("paired", F.col("publisher") % 7 == 0)
    return S.candidate_runs(own.where("publisher % 10 = 3"), own.where("publisher % 10 != 3"))


@query("d2_candidate_runs", D2 + " SELECT * FROM found WHERE kind IS NOT NULL")
def d2(spark, sf_dir):
    return judged(spark, sf_dir)


@query("d2_stored_index", D2 + " SELECT * FROM found WHERE kind IS NOT NULL")
def d2_index(spark, sf_dir):
    """As d2_candidate_runs, with the existing publishers in a stored index, half of them added later."""
    own = stored(O.series(spark, sf_dir, 2).where("issue BETWEEN 16 AND 25").withColumn("paired", F.col("publisher") % 7 == 0))
    existing, index = own.where("publisher % 10 != 3"), GramIndex(spark, scratch(spark))
    index.write(existing.where("publisher % 2 = 0"))
    index.add(existing.where("publisher % 2 = 1"))
    return index.runs(own.where("publisher % 10 = 3"))


@query("d3_duplicates_and_suspicions", D2 + " SELECT candidate, publisher, length, kind = 'suspicion' AS soft FROM found WHERE kind IS NOT NULL")
def d3(spark, sf_dir):
    return S.told_apart(judged(spark, sf_dir)).select("candidate", "publisher", "length", "soft")


HISTORY = f"""{O.OBS}, recent AS (SELECT * FROM obs WHERE issue BETWEEN 16 AND 25 AND publisher % 10 = 3),
rec AS (SELECT publisher, issue, value, seq % 31 <> 0 AS valid FROM recent WHERE (publisher + issue) % 4 = 0
  UNION ALL SELECT publisher, issue, CASE WHEN bool_or(bottom) THEN arg_max(value, seq) ELSE arg_min(value, seq) END, min(seq) % 31 <> 0 FROM recent WHERE (publisher + issue) % 4 <> 0 GROUP BY publisher, issue),
base AS (SELECT publisher, 25 AS issue, CASE WHEN bool_or(bottom) THEN arg_max(value, seq) ELSE arg_min(value, seq) END AS value FROM obs WHERE issue = 25 AND publisher % 10 = 3 GROUP BY publisher),
h AS (SELECT publisher, issue, count(*) AS n, count(*) FILTER (valid) AS good, min(value) AS value FROM rec GROUP BY publisher, issue),
jj AS (SELECT publisher, issue, h.value, base.value AS base_value, CASE WHEN n IS NOT NULL AND NOT (n = 1 AND good = 1) THEN 'not unique' WHEN h.value <> base.value THEN 'conflict' END AS error FROM h FULL JOIN base USING (publisher, issue)),
history AS (SELECT publisher, issue, CASE WHEN error IS NULL THEN coalesce(value, base_value) END AS value, error FROM jj)"""


def history(spark, sf_dir):
    """Every record of the window: all as they come in a quarter of the cells, one of each other cell."""
    rows = O.observations(spark, sf_dir).where("publisher % 10 = 3")
    value = F.when(F.bool_or("bottom"), F.max_by("value", "seq")).otherwise(F.min_by("value", "seq"))
    recent = rows.where("issue BETWEEN 16 AND 25")
    single = recent.where("(publisher + issue) % 4 != 0").groupBy("publisher", "issue").agg(value.alias("value"), (F.min("seq") % 31 != 0).alias("valid"))
    records = recent.where("(publisher + issue) % 4 = 0").select("publisher", "issue", "value", (F.col("seq") % 31 != 0).alias("valid")).unionByName(single)
    base = rows.where("issue = 25").groupBy("publisher", "issue").agg(value.alias("value"))
    return S.admission_history(records, base)


@query("d4_admission_history", f"WITH {HISTORY} SELECT * FROM history")
def d4(spark, sf_dir):
    return history(spark, sf_dir)


@query("d5_admission", D2 + f""", {HISTORY.replace(O.OBS + ', ', '')},
c AS (SELECT DISTINCT publisher AS candidate, publisher % 40 = 3 AS known, publisher % 50 <> 13 AS base_ok FROM obs WHERE publisher % 10 = 3),
t AS (SELECT publisher AS candidate, bool_or(error = 'not unique') AS bad, bool_or(error = 'conflict') AS torn, count(value) AS cells FROM history GROUP BY publisher),
f AS (SELECT candidate, count(*) FILTER (kind <> 'suspicion') AS hard, count(*) FILTER (kind = 'suspicion') AS soft FROM found WHERE kind IS NOT NULL GROUP BY candidate),
d AS (SELECT candidate, CASE WHEN known THEN 'exists' WHEN NOT base_ok THEN 'base' WHEN bad THEN 'history' WHEN torn THEN 'conflict' WHEN coalesce(t.cells, 0) = 0 THEN 'no data' WHEN hard > 0 THEN 'duplicate' WHEN soft > 0 THEN 'suspicion' ELSE 'accepted' END AS reason
  FROM c LEFT JOIN t USING (candidate) LEFT JOIN f USING (candidate)) SELECT candidate, reason = 'accepted' AS accepted, reason FROM d""")
def d5(spark, sf_dir):
    p = F.col("publisher")
    asked = O.publishers(spark, sf_dir).where("publisher % 10 = 3").select(p.alias("candidate"), (p % 40 == 3).alias("known"), F.lit(True).alias("state_ok"), F.lit(True).alias("issue_ok"), (p % 50 != 13).alias("base_ok"))
    return S.admission(asked, history(spark, sf_dir), judged(spark, sf_dir))


# rows in event order whose issue numbers run up and down, wrap at 365 and jump
WALK = """walk AS (SELECT user_id AS publisher, event_id AS place, CAST((CASE WHEN (n // 5) % 2 = 0 THEN n ELSE 2 * (n // 5) * 5 + 4 - n END + CASE WHEN event_id % 11 = 0 THEN 40 ELSE 0 END + 360) % 365 + 1 AS INTEGER) AS issue
  FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events))"""
SEGMENTS = f"""WITH {WALK}, s AS (SELECT *, issue - lag(issue) OVER w AS raw, row_number() OVER w AS n FROM walk WINDOW w AS (PARTITION BY publisher ORDER BY place)),
t AS (SELECT *, CASE WHEN raw <= -300 THEN 1 WHEN raw >= 300 THEN -1 ELSE raw END AS step FROM s),
u AS (SELECT *, coalesce(abs(step) = 1, false) AS good, lag(step) OVER (PARTITION BY publisher ORDER BY place) AS before FROM t),
v AS (SELECT *, good AND coalesce(lag(good) OVER (PARTITION BY publisher ORDER BY place), false) AND before <> step AS flip FROM u),
x AS (SELECT *, NOT good OR (flip AND (n - coalesce(max(CASE WHEN NOT flip THEN n END) OVER (PARTITION BY publisher ORDER BY place), 0)) % 2 = 1) AS cut FROM v),
seg AS (SELECT publisher, place, issue, sum(CAST(cut AS INTEGER)) OVER (PARTITION BY publisher ORDER BY place) AS segment FROM x)"""


def walk(spark, sf_dir):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = O.table(spark, sf_dir, "events").withColumn("n", n)
    n, block = F.col("n"), F.floor(F.col("n") / 5).cast("int")
    value = F.when(block % 2 == 0, n).otherwise(2 * block * 5 + 4 - n) + F.when(F.col("event_id") % 11 == 0, 40).otherwise(0)
    return rows.select(F.col("user_id").alias("publisher"), F.col("event_id").alias("place"), ((value + 360) % 365 + 1).cast("int").alias("issue"))


@query("g1_segments", SEGMENTS + " SELECT publisher, place, issue, CAST(segment AS BIGINT) AS segment FROM seg")
def g1(spark, sf_dir):
    return S.segments(walk(spark, sf_dir))


@query("g1_chosen_segment", SEGMENTS + """, h AS (SELECT publisher, segment, bool_or(issue = publisher % 60 + 1) AS holds FROM seg GROUP BY publisher, segment),
p AS (SELECT publisher, segment FROM h QUALIFY row_number() OVER (PARTITION BY publisher ORDER BY holds DESC, CASE WHEN publisher % 2 = 0 THEN -segment ELSE segment END) = 1)
SELECT publisher, place, issue, CAST(segment AS BIGINT) AS segment FROM seg JOIN p USING (publisher, segment)""")
def g1_chosen(spark, sf_dir):
    p = F.col("publisher")
    goals = O.publishers(spark, sf_dir).select("publisher", (p % 60 + 1).cast("int").alias("target"), F.when(p % 2 == 0, "last").otherwise("first").alias("edge"))
    return S.chosen_segment(walk(spark, sf_dir), goals).select("publisher", "place", "issue", "segment")


@query("g2_primary_history", f"""WITH {WALK}, r AS (SELECT *, publisher % 40 + 1 AS title FROM walk), h AS (SELECT *, sum(CASE WHEN issue = title THEN 1 ELSE 0 END) OVER w AS hits, sum(CASE WHEN issue <> title THEN 1 ELSE 0 END) OVER w AS between_ FROM r WINDOW w AS (PARTITION BY publisher ORDER BY place)),
e AS (SELECT publisher, min(place) AS one, arg_min(between_, place) AS b1, min(place) FILTER (hits = 2) AS two, arg_min(between_, place) FILTER (hits = 2) AS b2 FROM h WHERE issue = title GROUP BY publisher)
SELECT publisher, place, issue FROM r LEFT JOIN e USING (publisher) WHERE CASE WHEN NOT coalesce(b2 > b1, false) THEN true WHEN publisher % 2 = 0 THEN place <= one ELSE place < two END""")
def g2(spark, sf_dir):
    p = F.col("publisher")
    rows = walk(spark, sf_dir).withColumns({"title": (p % 40 + 1).cast("int"), "edge": F.when(p % 2 == 0, "last").otherwise("first")})
    return S.primary_history(rows).select("publisher", "place", "issue")


@query("g3_largest_group", """WITH g AS (SELECT user_id AS publisher, event_type AS part, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL),
b AS (SELECT publisher, part FROM g QUALIFY row_number() OVER (PARTITION BY publisher ORDER BY n DESC, first) = 1) SELECT publisher, part, event_id AS place FROM events JOIN b ON user_id = publisher AND event_type = part""")
def g3(spark, sf_dir):
    return S.largest_group(O.table(spark, sf_dir, "events").select(F.col("user_id").alias("publisher"), F.col("event_type").alias("part"), F.col("event_id").alias("place")))


ROLLED = f"""WITH {SERIES}, {O.STATE}, {O.RESULTS}, {O.PUBLISHERS},
grid AS (SELECT publisher, CAST(unnest(range({O.LAST_ISSUE - 9}, {O.LAST_ISSUE + 1})) AS INTEGER) AS issue FROM publishers WHERE NOT archived),
rolled AS (SELECT publisher, issue, CASE WHEN issue = {O.LAST_ISSUE} THEN r.value ELSE s.value END AS value,
  CASE WHEN CASE WHEN issue = {O.LAST_ISSUE} THEN r.value ELSE s.value END IS NOT NULL THEN NULL WHEN issue = {O.LAST_ISSUE} THEN coalesce(r.reason, '{fixed.DEFAULT_REASON}')
  ELSE coalesce(s.reason, '缓存缺少' || issue || '期有效数据') END AS reason
  FROM grid LEFT JOIN state s USING (publisher, issue) LEFT JOIN (SELECT publisher, value, reason FROM results) r USING (publisher))"""


def rolled(spark, sf_dir):
    return rolling.roll(O.state(spark, sf_dir), O.publishers(spark, sf_dir), O.results(spark, sf_dir), O.LAST_ISSUE)


@query("r1_roll", ROLLED + " SELECT * FROM rolled")
def r1(spark, sf_dir):
    return rolled(spark, sf_dir)


@query("r1_vectors", ROLLED + """ SELECT publisher, coalesce(string_agg(issue || '=' || value, ',' ORDER BY issue DESC) FILTER (value IS NOT NULL), '') AS cells,
CAST(count(*) FILTER (value IS NULL) AS INTEGER) AS extended, coalesce(string_agg(issue, ',' ORDER BY issue DESC) FILTER (value IS NULL), '') AS failed FROM rolled GROUP BY publisher""")
def r1_vectors(spark, sf_dir):
    v = rolling.as_vectors(rolled(spark, sf_dir))
    cells = F.zip_with("issues", "values", lambda i, x: F.concat_ws("=", i.cast("string"), x))
    return v.select("publisher", F.array_join(cells, ",").alias("cells"), "extended", F.array_join(F.col("failed").cast("array<string>"), ",").alias("failed"))


@query("r2_r3_state_faults", ROLLED + """ SELECT publisher, CASE WHEN publisher % 12 = 0 THEN 'values' ELSE 'reasons' END AS fault FROM (SELECT publisher, count(*) FILTER (value IS NOT NULL) AS good, count(*) FILTER (value IS NULL) AS bad FROM rolled GROUP BY publisher)
WHERE (publisher % 12 = 0 AND good > 0) OR (publisher % 12 = 1 AND bad > 0)""")
def r2_r3(spark, sf_dir):
    v = rolling.as_vectors(rolled(spark, sf_dir))
    spoilt = v.withColumn("values", F.when(F.col("publisher") % 12 == 0, F.transform("values", lambda x: F.concat(x, F.lit("尾")))).otherwise(F.col("values")))
    spoilt = spoilt.withColumn("reasons", F.when(F.col("publisher") % 12 == 1, F.transform_values("reasons", lambda k, r: F.lit(" "))).otherwise(F.col("reasons")))
    plain = O.publishers(spark, sf_dir).select("publisher", F.lit(False).alias("paired"))
    return rolling.value_faults(spoilt, plain).unionByName(rolling.failure_faults(spoilt, O.LAST_ISSUE))


R4 = f"""{SERIES}, {O.PUBLISHERS}, res AS (SELECT idx, name, value, idx % 10 = 4 AS failed, s.issue FROM series s JOIN publishers USING (publisher) WHERE s.issue = 25 OR (s.issue = 24 AND idx % 20 = 7))"""


@query("r4_result_faults", f"""WITH {R4} SELECT idx, 'repeated' AS fault FROM res GROUP BY idx HAVING count(*) > 1
UNION ALL SELECT idx, CASE WHEN NOT failed AND (idx - 1) % 7 = 0 OR idx % 10 = 5 AND NOT failed THEN 'success' ELSE 'failure' END FROM res WHERE (NOT failed AND ((idx - 1) % 7 = 0 OR idx % 10 = 5)) OR (failed AND idx % 20 = 4)""")
def r4(spark, sf_dir):
    i = F.col("idx")
    pubs = O.publishers(spark, sf_dir)
    own = O.series(spark, sf_dir).join(pubs.select("publisher", "idx", "name"), "publisher").where("issue = 25 OR (issue = 24 AND idx % 20 = 7)")
    failed = i % 10 == 4
    line = F.concat(F.col("value"), F.lit("尾 "), F.when(i % 10 == 5, F.lit("other")).otherwise(F.col("name")))
    rows = own.select("idx", F.when(~failed, F.col("value")).alias("value"), F.when(~failed, line).alias("success_line"), F.when(failed & (i % 20 != 4), F.lit("失败")).alias("fail_line"))
    return rolling.result_faults(rows, pubs)


@query("r5_identity_faults", """WITH p AS (SELECT 'P' || user_id % 40 AS name, CASE WHEN user_id % 2 = 0 THEN 'top' ELSE 'bottom' END AS pick, user_id FROM (SELECT DISTINCT user_id FROM events))
SELECT name, 'https://p.example/' AS url, pick, count(*) AS count FROM p GROUP BY name, pick HAVING count(*) > 1""")
def r5(spark, sf_dir):
    p = F.col("publisher")
    items = O.publishers(spark, sf_dir).select(F.concat(F.lit(" P"), (p % 40).cast("string")).alias("name"), F.lit("https://p.example/ ").alias("url"), F.when(p % 2 == 0, "顶部").otherwise("下").alias("pick"))
    return rolling.identity_faults(items)


CORRECTED = ROLLED + f""", fix AS (SELECT publisher, CAST(CASE WHEN publisher % 8 = 0 THEN 3 ELSE 20 END AS INTEGER) AS issue, CASE WHEN publisher % 3 = 0 THEN '7' END AS value FROM publishers WHERE publisher % 4 = 0),
good AS (SELECT fix.* FROM fix SEMI JOIN rolled USING (publisher) WHERE fix.issue > {O.LAST_ISSUE - 10}),
corrected AS (SELECT publisher, issue, CASE WHEN g.publisher IS NOT NULL THEN g.value ELSE r.value END AS value, CASE WHEN g.publisher IS NOT NULL THEN CASE WHEN g.value IS NULL THEN '{fixed.DEFAULT_REASON}' END ELSE r.reason END AS reason
  FROM rolled r LEFT JOIN good g USING (publisher, issue))"""


def corrections(spark, sf_dir):
    p = F.col("publisher")
    return O.publishers(spark, sf_dir).where("publisher % 4 = 0").select("publisher", F.when(p % 8 == 0, 3).otherwise(20).alias("issue"), F.when(p % 3 == 0, "7").alias("value"), F.lit(None).cast("string").alias("reason"))


def corrected(spark, sf_dir):
    return rolling.correct(rolled(spark, sf_dir), corrections(spark, sf_dir), O.LAST_ISSUE)


@query("r6_correct", CORRECTED + " SELECT * FROM corrected")
def r6(spark, sf_dir):
    return corrected(spark, sf_dir)[0]


@query("r6_refused", CORRECTED + f""" SELECT f.publisher, f.issue, CASE WHEN f.issue <= {O.LAST_ISSUE - 10} THEN 'outside the window' ELSE 'unknown publisher' END AS why FROM fix f ANTI JOIN good USING (publisher)""")
def r6_refused(spark, sf_dir):
    return corrected(spark, sf_dir)[1]


@query("r1_bucketed_roll", ROLLED + " SELECT * FROM rolled")
def r1_bucketed(spark, sf_dir):
    """As r1_roll, on segments bucketed by publisher."""
    held = BucketedState(spark, scratch(spark))
    held.create(O.state(spark, sf_dir))
    held.roll(0, O.publishers(spark, sf_dir), O.results(spark, sf_dir), O.LAST_ISSUE)
    return held.read(1)


@query("r6_bucketed_correct", CORRECTED + """ SELECT 'state' AS what, publisher, issue, value, reason FROM corrected
UNION ALL SELECT 'refused', f.publisher, f.issue, NULL, CASE WHEN f.issue <= """ + str(O.LAST_ISSUE - 10) + """ THEN 'outside the window' ELSE 'unknown publisher' END FROM fix f ANTI JOIN good USING (publisher)""")
def r6_bucketed(spark, sf_dir):
    """As r6_correct and r6_refused, on segments bucketed by publisher."""
    held = BucketedState(spark, scratch(spark))
    held.create(rolled(spark, sf_dir))
    refused = held.correct(0, corrections(spark, sf_dir), O.LAST_ISSUE)
    none = F.lit(None).cast("string")
    rows = held.read(1).select(F.lit("state").alias("what"), "publisher", "issue", "value", "reason")
    return rows.unionByName(refused.select(F.lit("refused").alias("what"), "publisher", "issue", none.alias("value"), F.col("why").alias("reason")))


@query("r7_header", ROLLED + """ SELECT count(*) AS site_count, count(*) FILTER (holes = 0) AS vector_count, count(*) FILTER (holes > 0) AS fail_count FROM (SELECT publisher, count(*) FILTER (value IS NULL) AS holes FROM rolled GROUP BY publisher)""")
def r7(spark, sf_dir):
    return rolling.header(rolled(spark, sf_dir))


@query("r8_fingerprint", f"""WITH {O.PUBLISHERS}, p AS (SELECT idx, sha256('{{"name":"' || name || '","url":"' || url || '","pick":"' || pick || '","rule":"r' || idx % 3 || '"}}') AS print FROM publishers WHERE NOT archived),
b AS (SELECT idx // 1000 AS block, sha256(string_agg(print, ',' ORDER BY idx)) AS print FROM p GROUP BY block) SELECT sha256(string_agg(print, ',' ORDER BY block)) AS fingerprint FROM b""")
def r8(spark, sf_dir):
    return rolling.fingerprint(O.publishers(spark, sf_dir).withColumn("rule", F.concat(F.lit("r"), (F.col("idx") % 3).cast("string"))))


@query("r9_merge_successes", f"""WITH {SERIES}, o AS (SELECT * FROM series WHERE publisher % 3 <> 0), n AS (SELECT publisher, issue, '9' AS value FROM series WHERE publisher % 5 = 0)
SELECT publisher, issue, coalesce(n.value, o.value) AS value FROM o FULL JOIN n USING (publisher, issue)""")
def r9(spark, sf_dir):
    own = O.series(spark, sf_dir)
    return rolling.merge_successes(own.where("publisher % 3 != 0"), own.where("publisher % 5 = 0").withColumn("value", F.lit("9")))


@query("s2_complete_vectors", f"""WITH {SERIES} SELECT publisher, issue, value FROM series WHERE issue BETWEEN 16 AND 25 QUALIFY count(*) OVER (PARTITION BY publisher) = 10""")
def s2_complete(spark, sf_dir):
    return rolling.complete_vectors(O.series(spark, sf_dir), O.LAST_ISSUE)


@query("t27_t29_issue_windows", """SELECT o_orderkey, string_agg(CAST(o_custkey - i AS VARCHAR), ',' ORDER BY i) AS issues, CASE WHEN d <= -300 THEN 1 WHEN d >= 300 THEN -1 ELSE d END AS step
FROM (SELECT o_orderkey, o_custkey, o_custkey % 366 - o_orderkey % 366 AS d FROM orders), range(0, 10) t(i) GROUP BY o_orderkey, o_custkey, d""")
def t27_t29(spark, sf_dir):
    own = O.table(spark, sf_dir, "orders")
    step = issues.delta(F.col("o_orderkey") % 366, F.col("o_custkey") % 366)
    return own.select("o_orderkey", F.array_join(issues.window(F.col("o_custkey"), 10).cast("array<string>"), ",").alias("issues"), step.cast("long").alias("step"))


@query("t22_t24_values", f"""WITH {O.CANDIDATES} SELECT seq, array_to_string(string_split(value, '、'), '|') AS parts, CASE WHEN publisher % 7 = 0 THEN contains(value, '、') ELSE NOT contains(value, '、') END AS valid,
array_to_string(list_transform(string_split(value, '、'), lambda d: d || '尾'), ' ') || ' P' || publisher AS line FROM candidates""")
def t22_t24(spark, sf_dir):
    v, p = F.col("value"), F.col("publisher")
    return O.candidates(spark, sf_dir).select("seq", F.array_join(T.ranking_parts(v), "|").alias("parts"), T.valid_value(v, p % 7 == 0).alias("valid"), T.result_line(v, F.concat(F.lit("P"), p.cast("string"))).alias("line"))

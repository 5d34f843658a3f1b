"""Queries on candidates, joins and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..helpers.tables import scratch
from ..operators import matching, reconcile
from ..sources.change_flow import ChangeFlow
from . import observed as O
from .registry import query

BASE = f"WITH {O.CANDIDATES}, {O.TARGETS}"
ASKED = f"""{BASE}, asked AS (SELECT c.*, t.target, t.bottom, t.paired, t.several, t.scope FROM candidates c JOIN targets t USING (publisher)),
ends AS (SELECT publisher, min(document_order) AS low, max(document_order) AS high FROM asked GROUP BY publisher),
scoped AS (SELECT a.* FROM asked a JOIN ends USING (publisher) WHERE CASE scope WHEN 'bottom' THEN document_order = high WHEN 'top' THEN document_order = low ELSE true END)"""
AUTH = ASKED + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY publisher, document ORDER BY position * CASE WHEN bottom THEN -1 ELSE 1 END) AS r FROM scoped),
auth AS (SELECT publisher, document, max(target) AS target, any_value(paired) AS paired, any_value(several) AS several, max(CASE WHEN r = 1 THEN issue END) AS edge_issue, max(CASE WHEN r = 1 THEN value END) AS edge_value,
  max(CASE WHEN r = 1 THEN error END) AS edge_error, min(seq) AS first_seq, bool_or(issue = target) AS has_target, list_sort(list_distinct(list(value) FILTER (issue = target))) AS vals FROM ranked GROUP BY publisher, document)"""
CONTRACT = "CASE WHEN {e} IS NOT NULL AND {e} <> '开0000占位记录' THEN 'parser' WHEN contains({v}, '、') <> paired THEN 'value' END"


@query("v2_direction_scope", ASKED + " SELECT seq, document_order FROM scoped")
def v2(spark, sf_dir):
    return reconcile.scoped(O.candidates(spark, sf_dir), O.publishers(spark, sf_dir)).select("seq", "document_order")


@query("v1_candidates", f"""WITH {O.OBS}, r AS (SELECT publisher, seq, publisher || '/' || kind AS document, CASE WHEN seq % 4 = 0 THEN 'dedicated' ELSE 'compact' END AS parser, seq % 11 <> 0 AS allowed FROM obs),
k AS (SELECT * FROM r WHERE allowed AND (publisher % 3 = 0) = (parser = 'dedicated'))
SELECT seq, row_number() OVER (PARTITION BY publisher, document, parser ORDER BY seq) - 1 AS position, CASE WHEN seq % 5 <> 0 THEN seq % 5 ELSE seq END AS document_order,
CASE WHEN seq % 6 = 0 THEN '杀尾' WHEN seq % 2 = 0 THEN '绝杀' END AS keyword FROM k""")
def v1(spark, sf_dir):
    s, p = F.col("seq"), F.col("publisher")
    url = lambda tail: F.concat(F.lit("https://p"), p.cast("string"), F.lit(tail))
    records = O.observations(spark, sf_dir).select(
        "publisher", "seq", F.concat_ws("/", p.cast("string"), "kind").alias("document"), F.when(s % 4 == 0, "dedicated").otherwise("compact").alias("parser"),
        F.when(s % 11 == 0, url(".example/other")).otherwise(url(".example/list")).alias("source_url"), (s % 5).alias("document_order"), s.alias("input_order"),
        F.when(s % 6 == 0, "绝杀 and 杀尾").when(s % 2 == 0, "only 绝杀").otherwise("none").alias("snippet"),
    )
    rules = O.publishers(spark, sf_dir).select("publisher", F.array("url").alias("sources"), (p % 3 == 0).alias("dedicated"), F.array(F.lit("杀尾"), F.lit("绝杀")).alias("words"))
    found = reconcile.built(records, rules)
    return found.select("seq", F.col("position").cast("long").alias("position"), "document_order", "keyword")


@query("v3_presentations", f"""{BASE}, k AS (SELECT *, (seq // 2) % 3 AS grp FROM candidates), d AS (SELECT publisher, issue, value, grp, seq, position, row_number() OVER (PARTITION BY publisher, issue, value, grp, document ORDER BY document_order, seq) AS n FROM k)
SELECT seq FROM d WHERE n = 1""")
def v3(spark, sf_dir):
    own = O.candidates(spark, sf_dir).withColumns({"position": (F.floor(F.col("seq") / 2) % 3), "block": F.lit("")})
    return reconcile.presentations(own).select("seq")


@query("v4_fragments", f"""{BASE}, big AS (SELECT publisher, document, seq, issue, value, position FROM candidates WHERE publisher % 2 = 0),
part AS (SELECT publisher, document || '#part' AS document, seq, issue, value, position FROM (SELECT *, row_number() OVER (PARTITION BY document ORDER BY position) AS n, count(*) OVER (PARTITION BY document) AS m FROM big) WHERE n > 1 AND n < m AND (publisher % 4 = 0 OR n % 2 = 0)),
al AS (SELECT * FROM big UNION ALL SELECT * FROM part), s AS (SELECT publisher, document, '|' || string_agg(seq || ':' || issue || ':' || value, '|' ORDER BY position) || '|' AS proof FROM al GROUP BY publisher, document),
gone AS (SELECT a.publisher, a.document FROM s a JOIN s b ON a.publisher = b.publisher AND a.document <> b.document AND length(a.proof) < length(b.proof) AND contains(b.proof, a.proof))
SELECT document, count(*) AS rows FROM al ANTI JOIN gone USING (publisher, document) GROUP BY document""")
def v4(spark, sf_dir):
    from pyspark.sql import Window

    by = Window.partitionBy("document")
    big = O.candidates(spark, sf_dir).where("publisher % 2 = 0").withColumns({"source_type": F.lit("page"), "error": F.lit(None).cast("string"), "block": F.concat(F.lit("row "), F.col("seq").cast("string"))})
    placed = big.withColumn("n", F.row_number().over(by.orderBy("position"))).withColumn("m", F.count("*").over(by))
    part = placed.where("n > 1 AND n < m AND (publisher % 4 = 0 OR n % 2 = 0)").drop("n", "m").withColumn("document", F.concat("document", F.lit("#part")))
    return reconcile.without_fragments(big.unionByName(part)).groupBy("document").agg(F.count("*").alias("rows"))


@query("v5_authority_edges", AUTH + " SELECT publisher, document, edge_issue, edge_value, has_target, coalesce(array_to_string(vals, ','), '') AS vals FROM auth")
def v5(spark, sf_dir):
    asked = reconcile.scoped(O.candidates(spark, sf_dir), O.publishers(spark, sf_dir)).join(O.targets(spark, sf_dir).select("publisher", "target", "bottom"), "publisher")
    found = reconcile.authority_edges(asked)
    return found.select("publisher", "document", F.col("edge.issue").alias("edge_issue"), F.col("edge.value").alias("edge_value"), "has_target", F.array_join(F.array_sort("values"), ",").alias("vals"))


@query("v6_absolute_edge", ASKED + """ SELECT publisher, issue AS edge_issue, value AS edge_value FROM asked QUALIFY row_number() OVER (PARTITION BY publisher ORDER BY
document_order * CASE WHEN bottom THEN -1 ELSE 1 END, position * CASE WHEN bottom THEN -1 ELSE 1 END) = 1""")
def v6(spark, sf_dir):
    asked = O.candidates(spark, sf_dir).join(O.targets(spark, sf_dir).select("publisher", "target", "bottom"), "publisher")
    return reconcile.absolute_edge(asked).select("publisher", F.col("edge.issue").alias("edge_issue"), F.col("edge.value").alias("edge_value"))


@query("v7_missing_target", AUTH + """ SELECT publisher, CASE WHEN count(DISTINCT edge_issue) = 1 THEN min(edge_issue) END AS edge_issue FROM auth GROUP BY publisher HAVING NOT bool_or(has_target)""")
def v7(spark, sf_dir):
    asked = reconcile.scoped(O.candidates(spark, sf_dir), O.publishers(spark, sf_dir)).join(O.targets(spark, sf_dir).select("publisher", "target", "bottom"), "publisher")
    return reconcile.missing_target(asked)


@query("v9_cross_block_conflicts", AUTH + """, f AS (SELECT publisher, arg_min(vals, first_seq) AS first FROM auth WHERE has_target GROUP BY publisher)
SELECT DISTINCT publisher FROM auth JOIN f USING (publisher) WHERE has_target AND NOT list_has_any(vals, first)""")
def v9(spark, sf_dir):
    asked = reconcile.scoped(O.candidates(spark, sf_dir), O.publishers(spark, sf_dir)).join(O.targets(spark, sf_dir).select("publisher", "target", "bottom"), "publisher")
    return reconcile.cross_block_conflict(reconcile.authority_edges(asked))


@query("v10_select_by_issue", f"""{BASE}, g AS (SELECT publisher, issue, count(DISTINCT value) AS n, string_agg(DISTINCT value, '、' ORDER BY value) AS vals, CASE WHEN publisher % 2 = 0 THEN arg_max(value, seq) ELSE arg_min(value, seq) END AS pick FROM candidates GROUP BY publisher, issue)
SELECT publisher, issue, CASE WHEN n > 1 THEN 'conflict' ELSE 'ok' END AS status, CASE WHEN n = 1 THEN pick END AS value, vals AS "values" FROM g""")
def v10(spark, sf_dir):
    return reconcile.select_by_issue(O.candidates(spark, sf_dir).withColumn("bottom", F.col("publisher") % 2 == 0))


@query("v11_number_same_issue", f"""{BASE}, n AS (SELECT seq, issue, row_number() OVER (PARTITION BY publisher, issue ORDER BY document_order, position) AS i, count(*) OVER (PARTITION BY publisher, issue) AS m FROM candidates)
SELECT seq, '专属区' || issue || '期记录编号 ' || i || '/' || m AS marker FROM n""")
def v11(spark, sf_dir):
    return reconcile.number_same_issue(O.candidates(spark, sf_dir)).select("seq", "marker")


DECIDE = AUTH + f""", held AS (SELECT *, CASE WHEN edge_issue <> target THEN 'edge' ELSE {CONTRACT.format(e='edge_error', v='edge_value')} END AS off FROM auth WHERE has_target AND NOT several),
s AS (SELECT publisher, arg_min(off, first_seq) FILTER (off IS NOT NULL) AS worst, arg_min(edge_issue, first_seq) FILTER (off IS NOT NULL) AS worst_issue, string_agg(DISTINCT edge_value, '、' ORDER BY edge_value) AS edges, count(DISTINCT edge_value) AS n, arg_min(edge_value, first_seq) AS value FROM held GROUP BY publisher),
f AS (SELECT publisher, arg_min(vals, first_seq) AS first FROM held GROUP BY publisher), torn AS (SELECT DISTINCT publisher FROM held JOIN f USING (publisher) WHERE NOT list_has_any(vals, first)),
one AS (SELECT publisher, CASE WHEN worst IS NOT NULL THEN worst WHEN n > 1 THEN 'edges differ' WHEN torn.publisher IS NOT NULL THEN 'blocks differ' ELSE 'ok' END AS status, value, CASE WHEN worst = 'edge' THEN CAST(worst_issue AS VARCHAR) WHEN n > 1 THEN edges ELSE '' END AS detail FROM s LEFT JOIN torn USING (publisher)),
m AS (SELECT publisher, target, paired, issue, value, error FROM scoped WHERE several AND publisher IN (SELECT publisher FROM scoped WHERE issue = target)
  QUALIFY row_number() OVER (PARTITION BY publisher ORDER BY document_order * CASE WHEN bottom THEN -1 ELSE 1 END, position * CASE WHEN bottom THEN -1 ELSE 1 END) = 1),
two AS (SELECT publisher, CASE WHEN issue <> target THEN 'edge' ELSE coalesce({CONTRACT.format(e='error', v='value')}, 'ok') END AS status, value, CASE WHEN issue <> target THEN CAST(issue AS VARCHAR) ELSE '' END AS detail FROM m),
ab AS (SELECT publisher, CASE WHEN count(DISTINCT edge_issue) = 1 THEN min(edge_issue) END AS stood FROM auth GROUP BY publisher HAVING NOT bool_or(has_target)),
decided AS (SELECT t.publisher, t.target, coalesce(d.status, CASE WHEN stood IS NOT NULL THEN 'edge' ELSE 'no record' END) AS status, CASE WHEN d.status = 'ok' THEN d.value END AS value, coalesce(d.detail, CAST(stood AS VARCHAR), '') AS detail
  FROM targets t LEFT JOIN (SELECT * FROM one UNION ALL SELECT * FROM two) d USING (publisher) LEFT JOIN ab USING (publisher))"""


@query("v13_decide", DECIDE + " SELECT * FROM decided")
def v13(spark, sf_dir):
    return reconcile.decide(O.candidates(spark, sf_dir), O.targets(spark, sf_dir))


@query("v13_change_flow", DECIDE + " SELECT * FROM decided")
def v13_changes(spark, sf_dir):
    """As v13_decide, from a version with other values and without some documents, and three change sets."""
    own, targets = O.candidates(spark, sf_dir), O.targets(spark, sf_dir)
    p, late = F.col("publisher"), F.length("document") % 3 == 0
    off = F.when(p % 8 == 3, F.lit("9")).otherwise(F.col("value"))
    decide = lambda rows: reconcile.decide(rows, targets.join(rows.select("publisher").distinct(), "publisher", "left_semi"))
    flow = ChangeFlow(spark, scratch(spark), decide, 8)
    extra = own.where(p % 10 == 4).withColumns({"document": F.concat("document", F.lit("#old")), "value": F.lit("1")})
    flow.create(own.where(~((p % 5 == 1) & late)).withColumn("value", off).unionByName(extra))
    none = own.where(F.lit(False))
    flow.apply(0, own.where((p % 5 == 1) & late).unionByName(own.where(p % 7 == 0)), none)  # new documents, and some that are the same
    flow.apply(1, own.where(p % 8 == 3), none)  # changed ones
    flow.apply(2, none, extra.select("publisher", "document").distinct())  # gone ones
    return flow.read(3, "decisions")


@query("v14_v17_warnings", AUTH + """, w0 AS (SELECT *, row_number() OVER (PARTITION BY publisher, document ORDER BY position) AS r FROM asked WHERE scope IS NOT NULL AND NOT several),
wide AS (SELECT publisher, document, max(target) AS target, min(seq) AS first_seq, list_distinct(list(value) FILTER (issue = target)) AS vals FROM w0 GROUP BY publisher, document HAVING bool_or(issue = target)),
f AS (SELECT publisher, arg_min(vals, first_seq) AS first FROM wide GROUP BY publisher),
d AS (SELECT publisher, target, 'documents' AS kind, array_to_string(list_sort(list_distinct(flatten(list(vals)))), '、') AS "values" FROM wide WHERE publisher IN (SELECT publisher FROM wide JOIN f USING (publisher) WHERE NOT list_has_any(vals, first)) GROUP BY publisher, target),
b AS (SELECT publisher, target, 'block' AS kind, array_to_string(arg_min(vals, first_seq), '、') AS "values" FROM auth WHERE NOT several AND len(vals) > 1 GROUP BY publisher, target),
m AS (SELECT publisher, target, 'several' AS kind, string_agg(DISTINCT value, '、' ORDER BY value) AS "values" FROM asked WHERE several AND issue = target GROUP BY publisher, target HAVING count(DISTINCT value) > 1)
SELECT * FROM d UNION ALL SELECT * FROM b UNION ALL SELECT * FROM m""")
def v14(spark, sf_dir):
    return reconcile.warnings(O.candidates(spark, sf_dir), O.targets(spark, sf_dir))


@query("v18_current_record", f"""{BASE}, l AS (SELECT c.publisher, c.issue, c.value, t.target, row_number() OVER (PARTITION BY publisher ORDER BY position * CASE WHEN t.bottom THEN -1 ELSE 1 END) AS r FROM candidates c JOIN targets t USING (publisher))
SELECT publisher, target AS issue, CASE WHEN issue = target THEN value END AS value, issue AS edge_issue FROM l WHERE r = 1""")
def v18(spark, sf_dir):
    own = O.candidates(spark, sf_dir).join(O.targets(spark, sf_dir).select("publisher", "bottom", F.col("target").alias("wanted")), "publisher")
    return reconcile.current_record(own.withColumn("place", F.col("position")))


@query("v20_run_results", DECIDE + """ SELECT idx, name, d.target AS issue, d.value, CASE status WHEN 'ok' THEN NULL WHEN 'edge' THEN 'issue' WHEN 'no record' THEN 'issue' WHEN 'value' THEN 'field' ELSE 'parse' END AS stage,
CASE WHEN status <> 'ok' THEN status || CASE WHEN detail <> '' THEN ' ' || detail ELSE '' END END AS reason,
CASE WHEN status = 'ok' THEN array_to_string(list_transform(string_split(d.value, '、'), lambda x: x || '尾'), ' ') || ' ' || name
ELSE '失败 ' || name || ' ' || url || ' 方向: ' || pick || ' 期数: ' || d.target || ' 阶段: ' || CASE status WHEN 'edge' THEN 'issue' WHEN 'no record' THEN 'issue' WHEN 'value' THEN 'field' ELSE 'parse' END || ' 原因: ' || status || CASE WHEN detail <> '' THEN ' ' || detail ELSE '' END END AS line
FROM decided d JOIN targets USING (publisher)""")
def v20(spark, sf_dir):
    return reconcile.run_result(v13(spark, sf_dir), O.publishers(spark, sf_dir))


@query("v21_verdicts", ASKED + f""", e AS (SELECT publisher, issue AS edge_issue FROM asked QUALIFY row_number() OVER (PARTITION BY publisher ORDER BY document_order * CASE WHEN bottom THEN -1 ELSE 1 END, position * CASE WHEN bottom THEN -1 ELSE 1 END) = 1),
g AS (SELECT publisher, max(target) AS target, count(*) FILTER (issue = target) AS found, bool_or(issue = target AND block <> '') AS anchored, coalesce(bool_and(({CONTRACT.format(e='error', v='value')}) IS NULL) FILTER (issue = target), true) AS valid, count(DISTINCT CASE WHEN issue = target THEN value END) AS n FROM asked GROUP BY publisher),
v AS (SELECT *, CASE WHEN found = 0 THEN 'not found' WHEN edge_issue <> target THEN 'direction' WHEN NOT anchored THEN 'anchor' WHEN NOT valid THEN 'value' WHEN n > 1 THEN 'conflict' END AS reason FROM g JOIN e USING (publisher))
SELECT publisher, found, edge_issue = target AS at_edge, found > n AS repeated, reason, reason IS NULL AS pass FROM v""")
def v21(spark, sf_dir):
    return reconcile.verdicts(O.candidates(spark, sf_dir), O.targets(spark, sf_dir))


@query("v22_distinct_documents", """WITH b AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '<[^>]+>', '', 'g'), '[\\s\\x{0085}\\x{00A0}\\x{2028}\\x{2029}\\x{3000}]+', '', 'g') AS bare FROM documents)
SELECT min(doc_id) AS place, CAST(min(doc_id) AS VARCHAR) AS document, count(*) AS copies FROM b GROUP BY bare""")
def v22(spark, sf_dir):
    own = O.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("place"), F.col("doc_id").cast("string").alias("document"), F.col("text").alias("content"))
    return reconcile.distinct_documents(own)


@query("v23_changed_files", """WITH b AS (SELECT doc_id AS path, length(text) AS size, sha256(text) AS digest FROM documents WHERE doc_id % 5 <> 0), a AS (SELECT doc_id AS path, length(text) AS size, sha256(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS digest FROM documents WHERE doc_id % 3 <> 0)
SELECT path, CASE WHEN b.digest IS NULL THEN 'new' WHEN a.digest IS NULL THEN 'gone' ELSE 'changed' END AS change FROM b FULL JOIN a USING (path) WHERE b.digest IS DISTINCT FROM a.digest""")
def v23(spark, sf_dir):
    own = O.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.length("text").alias("size"), "text")
    marked = F.when(F.col("path") % 7 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return reconcile.changed_files(own.where("path % 5 != 0").withColumn("digest", F.sha2("text", 256)), own.where("path % 3 != 0").withColumn("digest", F.sha2(marked, 256)))


# joins


@query("j1_effective_rules", f"""WITH {O.PUBLISHERS} SELECT idx, CASE WHEN publisher % 4 = 0 AND publisher % 8 <> 0 THEN NULL WHEN publisher % 8 = 0 THEN 'named' WHEN publisher % 3 <> 0 THEN 'plain' END AS rule, publisher % 6 = 0 AS several,
CASE WHEN publisher % 4 = 0 AND publisher % 8 <> 0 THEN 'name not configured' WHEN publisher % 8 <> 0 AND publisher % 3 = 0 THEN 'no rule' END AS violation FROM publishers""")
def j1(spark, sf_dir):
    pubs, p = O.publishers(spark, sf_dir), F.col("publisher")
    by_name = pubs.where(p % 4 == 0).select("url", F.when(p % 8 == 0, F.concat(F.lit(" "), F.col("name"))).otherwise("other").alias("name"), F.lit("named").alias("rule"))
    by_url = pubs.where(p % 3 != 0).select("url", F.lit("plain").alias("rule"))
    return matching.effective_rules(pubs.drop("several"), by_name, by_url, pubs.where(p % 6 == 0).select("url")).select("idx", "rule", "several", "violation")


@query("j2_result_gaps", f"""WITH {O.series_sql()}, {O.PUBLISHERS}, r AS (SELECT idx + CASE WHEN publisher % 17 = 0 THEN 1000 ELSE 0 END AS idx, name || CASE WHEN publisher % 11 = 0 THEN '?' ELSE '' END AS name, s.value, CASE WHEN publisher % 13 = 0 THEN 'x' ELSE s.value END AS line FROM series s JOIN publishers USING (publisher) WHERE s.issue = 25 OR (s.issue = 24 AND publisher % 10 = 9)),
g AS (SELECT idx, count(*) AS n, min(name) AS rname, min(value) AS v, min(line) AS l FROM r GROUP BY idx), j AS (SELECT idx, CASE WHEN p.name IS NULL THEN 'no publisher' WHEN n IS NULL THEN 'no result' WHEN n > 1 THEN 'several results' WHEN rname <> p.name THEN 'other name' WHEN v <> l THEN 'other value' END AS gap FROM g FULL JOIN publishers p USING (idx))
SELECT idx, gap FROM j WHERE gap IS NOT NULL""")
def j2(spark, sf_dir):
    pubs, p = O.publishers(spark, sf_dir), F.col("publisher")
    own = O.series(spark, sf_dir).join(pubs.select("publisher", "idx", "name"), "publisher").where("issue = 25 OR (issue = 24 AND publisher % 10 = 9)")
    rows = own.select((F.col("idx") + F.when(p % 17 == 0, 1000).otherwise(0)).alias("idx"), F.concat("name", F.when(p % 11 == 0, "?").otherwise("")).alias("name"), "value", F.when(p % 13 == 0, "x").otherwise(F.col("value")).alias("line_value"))
    return matching.result_gaps(rows, pubs)


@query("j3_state_gaps", f"""WITH {O.PUBLISHERS}, i AS (SELECT name, url, pick, CASE WHEN publisher % 9 = 0 THEN idx + 1 ELSE idx END AS sp FROM publishers WHERE publisher % 10 <> 0), c AS (SELECT name, url, pick, idx AS cp FROM publishers WHERE publisher % 7 <> 0),
j AS (SELECT name, url, pick, CASE WHEN cp IS NULL THEN 'only in state' WHEN sp IS NULL THEN 'only configured' WHEN sp <> cp THEN 'moved' END AS gap FROM i FULL JOIN c USING (name, url, pick)) SELECT * FROM j WHERE gap IS NOT NULL""")
def j3(spark, sf_dir):
    pubs, p = O.publishers(spark, sf_dir), F.col("publisher")
    items = pubs.where(p % 10 != 0).withColumn("place", F.when(p % 9 == 0, F.col("idx") + 1).otherwise(F.col("idx")))
    return matching.state_gaps(items, pubs.where(p % 7 != 0).withColumn("place", F.col("idx")))


@query("j4_existing_publishers", """WITH c AS (SELECT page_id, url, 'N' || page_id // 2 % 60 AS name, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages),
cand AS (SELECT page_id AS candidate, replace(url, '?page=2&ref=x', '#') AS url, CASE WHEN page_id % 3 = 0 THEN name ELSE 'new' || page_id END AS name FROM c WHERE page_id % 2 = 1),
conf AS (SELECT page_id AS idx, url, name FROM c WHERE page_id % 2 = 0),
k AS (SELECT candidate, name AS k1, lower(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)) || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) || '?' || regexp_extract(url, '\\?([^#]*)', 1) || '#' || regexp_extract(url, '#(.*)$', 1) AS k2 FROM cand),
m AS (SELECT idx, name AS k1, lower(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)) || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) || '?' || regexp_extract(url, '\\?([^#]*)', 1) || '#' || regexp_extract(url, '#(.*)$', 1) AS k2 FROM conf)
SELECT candidate, min(idx) AS idx FROM (SELECT candidate, idx FROM k JOIN m USING (k1) UNION ALL SELECT candidate, idx FROM k JOIN m USING (k2)) GROUP BY candidate""")
def j4(spark, sf_dir):
    p = F.col("page_id")
    pages = O.table(spark, sf_dir, "pages").withColumn("name", F.concat(F.lit("N"), (F.floor(p / 2) % 60).cast("string")))
    asked = pages.where(p % 2 == 1).select(p.alias("candidate"), F.replace("url", F.lit("?page=2&ref=x"), F.lit("#")).alias("url"), F.when(p % 3 == 0, F.col("name")).otherwise(F.concat(F.lit("new"), p.cast("string"))).alias("name"))
    return matching.existing_publishers(asked, pages.where(p % 2 == 0).select(p.alias("idx"), "url", "name"))


@query("j4_identity_clusters", """WITH RECURSIVE p AS (SELECT page_id AS idx, 'N' || page_id // 2 % 60 AS name, 'https://h' || page_id % 45 || '.example/a' || page_id % 77 AS url FROM pages),
k AS (SELECT idx, name AS key FROM p UNION ALL SELECT idx, url FROM p), e AS (SELECT DISTINCT a.idx AS a, b.idx AS b FROM k a JOIN k b USING (key)),
r(a, b) AS (SELECT idx, idx FROM p UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS idx, min(b) AS cluster FROM r GROUP BY a""")
def j4_clusters(spark, sf_dir):
    p = F.col("page_id")
    url = F.concat(F.lit("https://h"), (p % 45).cast("string"), F.lit(".example/a"), (p % 77).cast("string"))
    rows = O.table(spark, sf_dir, "pages").select(p.alias("idx"), F.concat(F.lit("N"), (F.floor(p / 2) % 60).cast("string")).alias("name"), url.alias("url"))
    return matching.identity_clusters(rows)


BLOCKS = """blocks AS (SELECT 'P' || user_id AS name, 'https://p' || user_id || '.example/list' AS url, CASE WHEN user_id % 2 = 0 THEN 'bottom' ELSE 'top' END AS pick, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS issue, event_id AS place FROM events WHERE event_type = 'error')"""


def blocks(spark, sf_dir):
    own = O.observations(spark, sf_dir).where("kind = 'error'").join(O.publishers(spark, sf_dir).select("publisher", "name", "url", "pick"), "publisher")
    return own.select("name", "url", "pick", "issue", F.col("seq").alias("place"))


@query("j5_retry_targets", f"""WITH {BLOCKS}, {O.PUBLISHERS} SELECT b.name, b.url, b.pick, min(place) AS place FROM blocks b SEMI JOIN (SELECT * FROM publishers WHERE NOT archived) p ON b.name = p.name AND b.url = p.url AND b.pick = p.pick WHERE issue = 20 GROUP BY ALL""")
def j5(spark, sf_dir):
    return matching.retry_targets(blocks(spark, sf_dir), O.publishers(spark, sf_dir).where("NOT archived"), 20)


@query("j6_still_open", f"""WITH {BLOCKS}, {O.OBS}, passed AS (SELECT DISTINCT 'P' || publisher AS name, issue FROM obs WHERE kind = 'signup') SELECT place, CASE WHEN place % 50 <> 0 THEN name END AS name FROM blocks b WHERE place % 50 = 0 OR NOT EXISTS (SELECT 1 FROM passed p WHERE p.name = b.name AND p.issue = b.issue)""")
def j6(spark, sf_dir):
    passed = O.observations(spark, sf_dir).where("kind = 'signup'").join(O.publishers(spark, sf_dir).select("publisher", "name", "url", "pick"), "publisher")
    own = blocks(spark, sf_dir).withColumn("name", F.when(F.col("place") % 50 != 0, F.col("name")))
    return matching.still_open(own, passed).select("place", "name")


@query("j7_all_failed", f"""WITH {O.OBS}, {O.PUBLISHERS}, i AS (SELECT unnest([3, 4, 5]) AS issue), ok AS (SELECT DISTINCT publisher FROM obs WHERE kind = 'signup' AND issue IN (3, 5)),
f AS (SELECT publisher, issue, arg_max('seen ' || seq, seq) AS recorded FROM obs WHERE kind = 'error' GROUP BY publisher, issue)
SELECT name, CAST(i.issue AS INTEGER) AS issue, CASE WHEN i.issue = 4 THEN '单期子进程退出码2，本轮输出无效' ELSE coalesce(recorded, '未生成失败记录，且成功文件中也未找到该目录') END AS reason FROM publishers p CROSS JOIN i LEFT JOIN f USING (publisher, issue) WHERE publisher NOT IN (SELECT publisher FROM ok)""")
def j7(spark, sf_dir):
    pubs = O.publishers(spark, sf_dir)
    own = O.observations(spark, sf_dir).join(pubs.select("publisher", "name"), "publisher")
    asked = own.where("issue IN (3, 4, 5)").select("issue").distinct()
    failed = own.where("kind = 'error'").select("name", "issue", F.concat(F.lit("seen "), F.col("seq").cast("string")).alias("reason"), F.col("seq").alias("place"))
    runs = asked.withColumn("code", F.when(F.col("issue") == 4, 2).otherwise(0))
    return matching.all_failed(pubs, asked, own.where("kind = 'signup'").select("name", "issue"), failed, runs)


@query("j8_report_diff", f"""WITH {O.series_sql()}, l AS (SELECT publisher, value FROM series WHERE issue = 10), r AS (SELECT publisher, value FROM series WHERE issue = 11)
SELECT 'P' || publisher AS name, CASE WHEN r.value IS NULL THEN 'only left' WHEN l.value IS NULL THEN 'only right' ELSE 'different' END AS kind FROM l FULL JOIN r USING (publisher) WHERE l.value IS DISTINCT FROM r.value""")
def j8(spark, sf_dir):
    own = O.series(spark, sf_dir).withColumn("name", F.concat(F.lit("P"), F.col("publisher").cast("string")))
    return matching.report_diff(own.where("issue = 10"), own.where("issue = 11"))


@query("t12_url_identity", """SELECT page_id, lower(regexp_extract(url, '^([a-z]+):', 1)) AS scheme, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS authority, CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) END AS path,
regexp_extract(url, '\\?([^#]*)', 1) AS query, rtrim(regexp_extract(url, '#(.*)$', 1), '/') AS fragment FROM pages""")
def t12(spark, sf_dir):
    return O.table(spark, sf_dir, "pages").select("page_id", urls.identity(F.col("url")).alias("i")).select("page_id", "i.scheme", "i.authority", "i.path", "i.query", "i.fragment")


@query("t13_t15_source_identity", """WITH u AS (SELECT page_id, page_id % 8 AS k, CASE page_id % 8 WHEN 0 THEN 'https://H.example/#/users/' || page_id WHEN 1 THEN 'https://h.example/#/forums/' || page_id || '/' WHEN 2 THEN 'https://h.example/#/users/7/references/' || page_id
  WHEN 3 THEN 'https://h.example/article/Manager/A' || page_id || '?x=1' WHEN 4 THEN 'https://h.example/Article/ar_content/id/' || page_id || '/tid/82.html' WHEN 5 THEN 'https://h.example/topic/' || page_id || '.html#x' WHEN 6 THEN 'https://h.example/bbs/read.php?a=1&tid=' || page_id ELSE url END AS url FROM pages)
SELECT page_id, CASE k WHEN 0 THEN 'h.example spa-user ' || page_id WHEN 1 THEN 'h.example spa-forum ' || page_id WHEN 2 THEN 'h.example spa-reference 7/' || page_id WHEN 3 THEN 'h.example article a' || page_id
  WHEN 4 THEN 'h.example static-article ' || page_id WHEN 5 THEN 'h.example topic ' || page_id WHEN 6 THEN 'h.example /bbs/read.php?tid ' || page_id END AS source,
CASE k WHEN 1 THEN CAST(page_id AS VARCHAR) WHEN 3 THEN 'A' || page_id ELSE '' END AS record_id, k = 0 AS unscoped FROM u""")
def t13(spark, sf_dir):
    p, k = F.col("page_id").cast("string"), F.col("page_id") % 8
    shapes = [
        F.concat(F.lit("https://H.example/#/users/"), p), F.concat(F.lit("https://h.example/#/forums/"), p, F.lit("/")), F.concat(F.lit("https://h.example/#/users/7/references/"), p),
        F.concat(F.lit("https://h.example/article/Manager/A"), p, F.lit("?x=1")), F.concat(F.lit("https://h.example/Article/ar_content/id/"), p, F.lit("/tid/82.html")),
        F.concat(F.lit("https://h.example/topic/"), p, F.lit(".html#x")), F.concat(F.lit("https://h.example/bbs/read.php?a=1&tid="), p),
    ]
    url = F.col("url")
    for i, shape in enumerate(shapes):
        url = F.when(k == i, shape).otherwise(url)
    own = O.table(spark, sf_dir, "pages").select("page_id", url.alias("url")).withColumn("s", urls.source(F.col("url")))
    return own.select("page_id", F.when(F.col("s").isNotNull(), F.concat_ws(" ", "s.host", "s.kind", "s.id")).alias("source"), urls.record_id(F.col("url")).alias("record_id"), urls.unscoped(F.col("url")).alias("unscoped"))

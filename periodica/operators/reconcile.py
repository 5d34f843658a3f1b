"""Reconciliation of candidates, fail-closed.

Candidates: publisher, issue, value, and the order and origin columns
    document_order, position, parser, document         the order key K
    source_url, source_type, record                    with the former the authority A
    seq                                                input order
    block                                              the evidence's text
    error                                              a parser's diagnosis or null
Edges are aggregates by struct (partial before the shuffle); nothing depends on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..helpers.tables import stored

K = ("document_order", "position", "parser", "document")
A = ("publisher", "source_url", "source_type", "record", "document", "document_order", "parser")
PLACEHOLDER = "开0000占位记录"


def key() -> Column:
    return F.struct(*K)


def edge(of: Column, bottom: Column) -> Column:
    """The first or last by K; `bottom` is constant within a group."""
    return F.when(F.bool_or(bottom), F.max_by(of, key())).otherwise(F.min_by(of, key()))


def document_order(candidates: DataFrame) -> DataFrame:
    """V1: the document's own order, or where that is 0 the input order."""
    return candidates.withColumn("document_order", F.when(F.col("document_order") != 0, F.col("document_order")).otherwise(F.col("input_order")))


def numbered(records: DataFrame) -> DataFrame:
    """V1: the position of each record among its document's and parser's."""
    return records.withColumn("position", F.row_number().over(Window.partitionBy("publisher", "document", "parser").orderBy("seq")) - 1)


def built(records: DataFrame, rules: DataFrame) -> DataFrame:
    """V1: candidates from the records of all parsers. rules: publisher, sources (allowed URLs), dedicated,
    words. Where a publisher has a dedicated parser only its records count; a record's URL must be one
    of the rule's; its keyword is the first configured word that its snippet has (null without one)."""
    ruled = records.join(rules, "publisher").where(
        (F.col("dedicated") == (F.col("parser") == "dedicated")) & F.array_contains("sources", F.col("source_url"))
    )
    keyword = F.try_element_at(F.filter("words", lambda w: F.contains(F.col("snippet"), w)), F.lit(1))
    return document_order(numbered(ruled.withColumn("keyword", keyword).drop("sources", "dedicated", "words")))


def scoped(candidates: DataFrame, publishers: DataFrame) -> DataFrame:
    """V2: where the publisher has a document scope (top, bottom), only its first or last document's."""
    asked = candidates.join(publishers.select("publisher", "scope"), "publisher", "left")
    ends = asked.groupBy("publisher").agg(F.min("document_order").alias("low"), F.max("document_order").alias("high"))
    joined = asked.join(ends, "publisher")
    keep = F.when(F.col("scope") == "bottom", F.col("document_order") == F.col("high")).when(F.col("scope") == "top", F.col("document_order") == F.col("low"))
    return joined.where(F.coalesce(keep, F.lit(True))).select(candidates.columns)


def presentations(candidates: DataFrame) -> DataFrame:
    """V3: one candidate, the first by K, of those that present the same block at the same position of the
    same record; without a block, of those of the same document and parser too."""
    plain = T.normalize("block")
    has = plain != ""
    scope = [F.when(~has, F.col(c)) for c in ("document", "parser")]
    keys = ["publisher", "issue", "value", "position", "record"]
    tagged = candidates.withColumns({"p0": plain, "p1": scope[0], "p2": scope[1]})
    best = Window.partitionBy(*keys, "p0", "p1", "p2").orderBy(*K, "seq")
    return tagged.withColumn("n", F.row_number().over(best)).where("n = 1").select(candidates.columns)


PRIMES = (2147483629, 2147483587)  # below 2 ** 31, so that a product of two residues fits into 63 bits
BASES = (911382323, 972663749)
POWER_BITS = 31  # of a place in an authority


def power(base: int, prime: int, exponent: Column) -> Column:
    """base ** exponent modulo prime, from the powers of two that the exponent has."""
    squares = [pow(base, 1 << k, prime) for k in range(POWER_BITS)]
    found = F.lit(1).cast("long")
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(x).cast("long").alias("x")) for k, x in enumerate(squares)])
    return F.aggregate(steps, found, lambda acc, s: F.when(F.bit_get(exponent, s["k"]) == 1, acc * s["x"] % prime).otherwise(acc))


def authority_rows(pages: DataFrame) -> DataFrame:
    """A row for each candidate of the authorities whose blocks all have a text: auth and origin (digests of their
    columns), n (place from 1), size, proof, and the rolling fingerprint: p0, p1 (sums of a polynomial over the
    proofs up to here, to two moduli), x0, x1 (this row's part), i0, i1 (what shifts a window that starts here to the front)."""
    digest = lambda columns: F.unhex(F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})))
    block = T.normalize("block")
    rows = pages.select(
        digest([F.col(c) for c in A]).alias("auth"), digest([F.col(c) for c in ("publisher", "source_url", "source_type", "record", "parser")]).alias("origin"),
        *[F.col(c).alias(f"k_{c}") for c in K], digest(["issue", "value", block.alias("block"), "error"]).alias("proof"), (F.coalesce(block, F.lit("")) != "").alias("has"),
    )
    every = Window.partitionBy("auth")
    order = every.orderBy(*[f"k_{c}" for c in K], "proof")
    placed = rows.withColumns({"n": F.row_number().over(order), "size": F.count("*").over(every), "proven": F.min("has").over(every)}).where("proven")
    number = F.xxhash64("proof")
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        place = (F.col("n") - 1).cast("long")
        placed = placed.withColumn(f"x{k}", (F.pmod(number, F.lit(prime)) + 1) * power(base, prime, place) % prime).withColumn(f"i{k}", power(pow(base, -1, prime), prime, place))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for k, prime in enumerate(PRIMES):
        placed = placed.withColumn(f"p{k}", F.sum(f"x{k}").over(so_far) % prime)
    return placed.select("auth", "origin", "n", "size", "proof", "x0", "x1", "i0", "i1", "p0", "p1")


def without_fragments(candidates: DataFrame) -> DataFrame:
    """V4: without page authorities whose whole evidence is a strictly shorter contiguous part of another
    one's of the same URL, type, record and parser.

    Authorities of equal evidence are one class. A class meets the places of longer ones at which its first
    proof stands; of such a place only the row at which a window of its length ends is joined in, and the two
    sums there give the window's fingerprint. Of the equal ones one is compared proof by proof. All joins are on
    equal keys, and rows are moved in proportion to the candidates and to the places that a first proof meets."""
    rows = stored(authority_rows(candidates.where("source_type = 'page'")))
    whole = rows.where("n = size").select("auth", "origin", "size", F.col("p0").alias("t0"), F.col("p1").alias("t1"))
    firsts = rows.where("n = 1").select("auth", "proof")
    members = whole.join(firsts, "auth")
    classes = members.groupBy("origin", "size", "t0", "t1", "proof").agg(F.min("auth").alias("rep"))
    large = rows.join(classes.select(F.col("rep").alias("auth")), "auth", "left_semi")
    start = large.select("origin", "proof", F.col("auth").alias("host"), F.col("n").alias("at"), F.col("size").alias("host_size"), *[((F.col(f"p{k}") - F.col(f"x{k}")) % PRIMES[k]).alias(f"b{k}") for k in (0, 1)], "i0", "i1")
    met = classes.join(start, ["origin", "proof"]).where((F.col("size") < F.col("host_size")) & (F.col("at") + F.col("size") - 1 <= F.col("host_size")))
    end = large.select(F.col("auth").alias("host"), F.col("n").alias("until"), "p0", "p1")
    closed = met.withColumn("until", F.col("at") + F.col("size") - 1).join(end, ["host", "until"])
    same = [F.pmod(F.col(f"p{k}") - F.col(f"b{k}"), F.lit(PRIMES[k])) * F.col(f"i{k}") % PRIMES[k] == F.col(f"t{k}") for k in (0, 1)]
    one = closed.where(same[0] & same[1]).groupBy("rep", "size").agg(F.min(F.struct("host", "at")).alias("x")).select("rep", "size", "x.host", "x.at")
    parts = rows.select(F.col("auth").alias("rep"), "n", "proof").join(one, "rep").withColumn("n", F.col("n") + F.col("at") - 1)
    proven = parts.join(rows.select(F.col("auth").alias("host"), "n", "proof"), ["host", "n", "proof"]).groupBy("rep", "size").count().where(F.col("count") == F.col("size"))
    gone = members.join(classes.join(proven.select("rep"), "rep", "left_semi"), ["origin", "size", "t0", "t1", "proof"]).select(F.col("auth").alias("gone"))
    digest = F.unhex(F.md5(F.to_json(F.struct(*A), {"ignoreNullFields": "false"})))
    return candidates.join(gone, (F.col("source_type") == "page") & (digest == F.col("gone")), "left_anti")


def null_safe_anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    other = right.select(*[F.col(c).alias(f"r_{c}") for c in on])
    condition = None
    for c in on:
        same = F.col(c).eqNullSafe(F.col(f"r_{c}"))
        condition = same if condition is None else condition & same
    return left.join(other, condition, "left_anti")


def authority_edges(candidates: DataFrame) -> DataFrame:
    """V5: for each authority that has the target: edge issue, value and error, values of the target, first seq.
    Needs columns target and bottom."""
    target = F.col("issue") == F.col("target")
    return candidates.groupBy(*A).agg(
        F.max("target").alias("target"), edge(F.struct("issue", "value", "error"), F.col("bottom")).alias("edge"), F.min("seq").alias("first_seq"),
        F.bool_or(target).alias("has_target"), F.collect_set(F.when(target, F.col("value"))).alias("values"),
    )


def absolute_edge(candidates: DataFrame) -> DataFrame:
    """V6: by publisher: the edge of all candidates."""
    return candidates.groupBy("publisher").agg(F.max("target").alias("target"), edge(F.struct("issue", "value", "error"), F.col("bottom")).alias("edge"))


def missing_target(candidates: DataFrame) -> DataFrame:
    """V7: publishers without a candidate of the target: the one issue at which all authorities' edges stand, or null."""
    edges = authority_edges(candidates)
    summed = edges.groupBy("publisher").agg(F.bool_or("has_target").alias("any"), F.collect_set("edge.issue").alias("at"))
    return summed.where("NOT any").select("publisher", F.when(F.size("at") == 1, F.col("at")[0]).alias("edge_issue"))


def contract_error(value: Column, error: Column, paired: Column) -> Column:
    """Null if the value keeps the contract; a placeholder draw alone is no error."""
    return F.when(error.isNotNull() & (error != "") & (error != PLACEHOLDER), F.lit("parser")).when(
        ~T.valid_value(value, F.coalesce(paired, F.lit(False))), F.lit("value")
    )


def cross_block_conflict(authorities: DataFrame) -> DataFrame:
    """V9: publishers of which an authority's values of the target don't meet those of the first one."""
    held = authorities.where("has_target")
    first = held.groupBy("publisher").agg(F.min_by("values", "first_seq").alias("first_values"))
    return held.join(first, "publisher").where(~F.arrays_overlap("values", "first_values")).select("publisher").distinct()


def select_by_issue(candidates: DataFrame) -> DataFrame:
    """V10 (history): publisher, issue, status, value, values: a conflict where an issue has several values,
    else the first or last in input order."""
    grouped = candidates.groupBy("publisher", "issue").agg(
        F.array_sort(F.collect_set("value")).alias("all"), F.when(F.bool_or("bottom"), F.max_by("value", "seq")).otherwise(F.min_by("value", "seq")).alias("value")
    )
    clash = F.size("all") > 1
    return grouped.select(
        "publisher", "issue", F.when(clash, "conflict").otherwise("ok").alias("status"), F.when(~clash, F.col("value")).alias("value"), F.array_join("all", "、").alias("values")
    )


def number_same_issue(candidates: DataFrame) -> DataFrame:
    """Adds place_in_issue, count_in_issue and the marker."""
    issue = Window.partitionBy("publisher", "issue")
    counted = candidates.withColumn("place_in_issue", F.row_number().over(issue.orderBy(*K, "seq"))).withColumn("count_in_issue", F.count("*").over(issue))
    return counted.withColumn("marker", F.format_string("专属区%d期记录编号 %d/%d", "issue", "place_in_issue", "count_in_issue"))


def decide(candidates: DataFrame, publishers: DataFrame) -> DataFrame:
    """Publisher, target, status, value, detail; one row for each publisher that has a target.

    publishers: publisher, target, bottom, paired, scope, several. Order of precedence: no
    target; an authority's edge off the target or a value out of contract, of the earliest
    such authority; edge values that differ; blocks that contradict each other. The chosen
    value is the edge of the earliest authority (V8: all edges agree).
    """
    asked = scoped(candidates, publishers).join(publishers.select("publisher", "target", "bottom", "paired", "several"), "publisher")
    single = asked.where("NOT several")
    kept = without_fragments(single)
    held = authority_edges(kept).join(publishers.select("publisher", "paired"), "publisher").where("has_target")
    off = F.when(F.col("edge.issue") != F.col("target"), F.lit("edge")).otherwise(contract_error(F.col("edge.value"), F.col("edge.error"), F.col("paired")))
    judged = held.withColumn("off", off)
    summed = judged.groupBy("publisher").agg(
        F.min(F.when(F.col("off").isNotNull(), F.struct("first_seq", "off", "edge.issue"))).alias("worst"),
        F.array_sort(F.collect_set("edge.value")).alias("edges"), F.min_by("edge.value", "first_seq").alias("value"),
    )
    torn = cross_block_conflict(authority_edges(single)).withColumn("torn", F.lit(True))
    first = summed.join(torn, "publisher", "left")
    status = (
        F.when(F.col("worst").isNotNull(), F.col("worst.off"))
        .when(F.size("edges") > 1, "edges differ")
        .when(F.col("torn"), "blocks differ")
        .otherwise("ok")
    )
    detail = F.when(F.col("worst.off") == "edge", F.col("worst.issue").cast("string")).when(F.size("edges") > 1, F.array_join("edges", "、")).otherwise("")
    by_authority = first.select("publisher", status.alias("status"), "value", detail.alias("detail"))

    unique = presentations(asked.where("several"))
    ends = absolute_edge(unique).join(publishers.select("publisher", "paired"), "publisher")
    present = unique.groupBy("publisher").agg(F.bool_or(F.col("issue") == F.col("target")).alias("any")).where("any")
    wrong = F.when(F.col("edge.issue") != F.col("target"), F.lit("edge")).otherwise(contract_error(F.col("edge.value"), F.col("edge.error"), F.col("paired")))
    by_edge = ends.join(present, "publisher", "left_semi").select(
        "publisher", F.coalesce(wrong, F.lit("ok")).alias("status"), F.col("edge.value").alias("value"),
        F.when(wrong == "edge", F.col("edge.issue").cast("string")).otherwise("").alias("detail"),
    )
    decided = by_authority.unionByName(by_edge)
    absent = missing_target(asked).select("publisher", F.col("edge_issue").cast("string").alias("at"))
    joined = publishers.where("target IS NOT NULL").select("publisher", "target").join(decided, "publisher", "left").join(absent, "publisher", "left")
    final = F.coalesce("status", F.when(F.col("at").isNotNull(), "edge").otherwise("no record"))
    return joined.select(
        "publisher", "target", final.alias("status"), F.when(final == "ok", F.col("value")).alias("value"), F.coalesce("detail", "at", F.lit("")).alias("detail")
    )


def warnings(candidates: DataFrame, publishers: DataFrame) -> DataFrame:
    """Distinct (publisher, target, kind, values): documents that disagree (before the scope; only
    scoped publishers), several values in one block (the first such), several in a publisher of many records."""
    asked = candidates.join(publishers.select("publisher", "target", "bottom", "scope", "several"), "publisher")
    base = ["publisher", "target"]
    wide = authority_edges(asked.where("scope IS NOT NULL AND NOT several")).where("has_target")
    apart = cross_block_conflict(wide)
    all_values = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("values")))), "、").alias("values")
    documents = wide.join(apart, "publisher", "left_semi").groupBy(*base).agg(all_values).withColumn("kind", F.lit("documents"))
    single = scoped(candidates, publishers).join(publishers.select("publisher", "target", "bottom", "several"), "publisher").where("NOT several")
    inner = authority_edges(single).where("size(values) > 1")
    block = inner.groupBy(*base).agg(F.array_join(F.array_sort(F.min_by("values", "first_seq")), "、").alias("values")).withColumn("kind", F.lit("block"))
    many = presentations(asked.where("several")).where("issue = target").groupBy(*base).agg(F.collect_set("value").alias("v")).where("size(v) > 1")
    several = many.select(*base, F.array_join(F.array_sort("v"), "、").alias("values"), F.lit("several").alias("kind"))
    return documents.unionByName(block).unionByName(several).distinct()


def current_record(decided: DataFrame) -> DataFrame:
    """Publisher, issue, value, edge_issue: the first or last of the decided list (place) has to be the issue wanted."""
    ends = decided.groupBy("publisher").agg(
        F.max("wanted").alias("wanted"),
        F.when(F.bool_or("bottom"), F.max_by(F.struct("issue", "value"), "place")).otherwise(F.min_by(F.struct("issue", "value"), "place")).alias("edge"),
    )
    good = F.col("edge.issue") == F.col("wanted")
    return ends.select("publisher", F.col("wanted").alias("issue"), F.when(good, F.col("edge.value")).alias("value"), F.col("edge.issue").alias("edge_issue"))


def rejections(extracted: DataFrame) -> DataFrame:
    """How often the value helper refused, by reason."""
    return extracted.where("rejected IS NOT NULL").groupBy(F.col("rejected").alias("reason")).agg(F.count("*").alias("times"))


def run_result(decisions: DataFrame, publishers: DataFrame) -> DataFrame:
    """Idx, name, value, stage, reason, line: a success line or a fail line that carries the identity."""
    joined = decisions.join(publishers.select("publisher", "idx", "name", "url", "pick"), "publisher")
    stage = F.when(F.col("status") == "ok", F.lit(None)).when(F.col("status").isin("edge", "no record"), "issue").when(F.col("status") == "value", "field").otherwise("parse")
    reason = F.when(F.col("status") != "ok", F.concat_ws(" ", "status", F.nullif("detail", F.lit(""))))
    fail = F.format_string("失败 %s %s 方向: %s 期数: %d 阶段: %s 原因: %s", "name", "url", "pick", "target", stage, reason)
    line = F.when(F.col("status") == "ok", T.result_line(F.col("value"), F.col("name"))).otherwise(fail)
    return joined.select("idx", "name", F.col("target").alias("issue"), "value", stage.alias("stage"), reason.alias("reason"), line.alias("line"))


def verdicts(candidates: DataFrame, publishers: DataFrame) -> DataFrame:
    """By publisher: candidates, found, at_edge, anchored, valid, conflict, repeated, first failing reason, pass."""
    joined = candidates.join(publishers.select("publisher", "target", "bottom", "paired"), "publisher")
    target = F.col("issue") == F.col("target")
    summed = joined.groupBy("publisher").agg(
        F.max("target").alias("target"), F.count_if(target).alias("found"), edge(F.col("issue"), F.col("bottom")).alias("edge_issue"),
        F.bool_or(target & (T.normalize("block") != "")).alias("anchored"),
        F.bool_and(F.when(target, contract_error(F.col("value"), F.col("error"), F.col("paired")).isNull())).alias("valid"),
        F.count_distinct(F.when(target, F.col("value"))).alias("values"),
    )
    reason = (
        F.when(F.col("found") == 0, "not found")
        .when(F.col("edge_issue") != F.col("target"), "direction")
        .when(~F.col("anchored"), "anchor")
        .when(~F.col("valid"), "value")
        .when(F.col("values") > 1, "conflict")
    )
    return summed.select("publisher", "found", (F.col("edge_issue") == F.col("target")).alias("at_edge"), (F.col("found") > F.col("values")).alias("repeated"), reason.alias("reason"), reason.isNull().alias("pass"))


def distinct_documents(documents: DataFrame) -> DataFrame:
    """Of documents equal without tags and white space the first (by place)."""
    bare = F.sha2(F.regexp_replace(F.regexp_replace(F.coalesce("content", F.lit("")), "<[^>]+>", ""), r"(?U)\s+", ""), 256)
    return documents.withColumn("bare", bare).groupBy("bare").agg(F.min(F.struct("place", "document")).alias("first"), F.count("*").alias("copies")).select("first.*", "copies")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Path, change of two listings (path, size, digest)."""
    b = before.select("path", F.struct("size", "digest").alias("b"))
    a = after.select("path", F.struct("size", "digest").alias("a"))
    change = F.when(F.col("b").isNull(), "new").when(F.col("a").isNull(), "gone").when(F.col("a") != F.col("b"), "changed")
    return b.join(a, "path", "full").select("path", change.alias("change")).where("change IS NOT NULL")

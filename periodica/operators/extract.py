"""Extraction: documents to records.

documents: publisher, document, content, and the rule's columns (see default_rule). Records:
publisher, document, position, issue, value, draw, snippet. What a rule says is data, so a
new publisher needs a row, not code; further kinds are registered with register_extractor.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import fixed
from ..functions import text as T
from ..helpers import markup
from ..helpers.tables import scratch
from ..helpers.values import absolute_url, unescape, value_in



def default_rule() -> dict[str, Column]:
    """Columns of a rule with their defaults."""
    return {
        "name": F.lit(""), "signals": T.words(fixed.SIGNAL_WORDS), "excluded": T.words(fixed.EXCLUDED_WORDS), "span": F.lit(240), "lead": F.lit(700),
        "need_site": F.lit(True), "need_draw": F.lit(True), "sections": T.words(fixed.SECTION_WORDS), "stops": T.words(()), "section_span": F.lit(1500),
        "headers": T.words(fixed.TABLE_HEADERS), "required": T.words(()), "anchors": T.words(()), "scope_re": F.lit(None).cast("string"), "value_re": F.lit(None).cast("string"),
    }


RECORD = ("publisher", "document", "position", "issue", "value", "draw", "snippet")
EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_extractor(kind: str, function: Callable[[DataFrame], DataFrame]) -> None:
    EXTRACTORS[kind] = function


def extract(documents: DataFrame, kind: str) -> DataFrame:
    if kind not in EXTRACTORS:
        raise ValueError(f"unknown source kind: {kind}")
    return EXTRACTORS[kind](documents)


def extract_all(documents: DataFrame) -> DataFrame:
    """RECORD and kind of documents of any kinds (publisher, document, content, kind, and columns of a rule, null for its
    default). They are written once, a folder for each kind, and each extractor reads its own folder only: all
    documents are read twice in sum, however many kinds there are. Unknown kinds give no rows (see unknown_kinds)."""
    ruled = documents.withColumns({k: F.coalesce(F.col(k), v) for k, v in default_rule().items() if k in documents.columns})
    path = scratch(documents.sparkSession)
    ruled.where(F.col("kind").isin(list(EXTRACTORS))).write.partitionBy("kind").parquet(path)
    schema = StructType([f for f in ruled.schema if f.name != "kind"] + [f for f in ruled.schema if f.name == "kind"])
    held = documents.sparkSession.read.schema(schema).parquet(path)
    found = [extract(held.where(F.col("kind") == kind).drop("kind"), kind).select(*RECORD, F.lit(kind).alias("kind")) for kind in sorted(EXTRACTORS)]
    return reduce(DataFrame.unionByName, found)


def unknown_kinds(documents: DataFrame) -> DataFrame:
    """kind, documents: how many documents have a kind that no extractor is registered for."""
    return documents.where(F.col("kind").isNull() | ~F.col("kind").isin(list(EXTRACTORS))).groupBy("kind").agg(F.count("*").alias("documents"))


def with_rule(documents: DataFrame) -> DataFrame:
    return documents.withColumns({k: v for k, v in default_rule().items() if k not in documents.columns})


def page_text(content: Column) -> Column:
    """T5 with entities undone."""
    return T.normalize(unescape(F.regexp_replace(F.coalesce(content, F.lit("")), "<[^>]+>", " ")))


def positioned(records: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("publisher", "document").orderBy("place")) - 1
    return records.withColumn("position", place).select(*RECORD)


def chunk_rows(documents: DataFrame, text: str) -> DataFrame:
    """One row for each issue chunk of the column `text`, with its issue; excluded ones left out. Texts
    without an issue mark are dropped before anything dear."""
    cut = documents.where(F.contains(F.col(text), F.lit("期"))).select("*", F.posexplode(T.issue_chunks(F.col(text))).alias("place", "chunk"))
    return cut.withColumn("issue", T.leading_issue(F.col("chunk"))).where(F.col("issue").isNotNull() & T.contains_none(F.col("chunk"), F.col("excluded")))


def gated(chunks: DataFrame) -> DataFrame:
    """Rows whose bounded window passes the site, signal and draw gates, with value or wave."""
    signals = T.signal_words(F.col("signals"), F.col("name"))
    windowed = chunks.withColumn("window", T.bounded_window(F.col("chunk"), F.col("span"))).where(
        (~F.col("need_site") | T.names_site(F.col("window"), F.col("name")))
        & ((F.size(signals) == 0) | T.contains_any(F.col("window"), signals))
        & (~F.col("need_draw") | T.has_draw(F.col("window")))
    )
    found = windowed.withColumn("found", value_in("window")).withColumn("wave", T.wave_value(F.col("window")))
    value = F.coalesce(F.col("found.value").cast("string"), F.nullif("wave", F.lit("")))
    return found.withColumn("value", value).withColumn("draw", T.draw_text(F.col("window"))).withColumn("snippet", T.snippet(F.col("window"))).withColumn("rejected", F.col("found.rejected"))


def compact(documents: DataFrame) -> DataFrame:
    """X1."""
    rows = gated(chunk_rows(with_rule(documents).withColumn("text", page_text(F.col("content"))), "text"))
    return positioned(rows.where("value IS NOT NULL"))


def refused(documents: DataFrame) -> DataFrame:
    """V19's input: windows whose value the helper refused, with the reason."""
    rows = gated(chunk_rows(with_rule(documents).withColumn("text", page_text(F.col("content"))), "text"))
    return rows.where("rejected IS NOT NULL").select("publisher", "document", "issue", "rejected")


def section(documents: DataFrame) -> DataFrame:
    """The text after the first configured section word that occurs, cut at the first stop word; where
    that yields nothing the uncut section counts (uncut = true)."""
    text = with_rule(documents).withColumn("text", page_text(F.col("content")))
    marked = text.withColumn("mark", F.filter("sections", lambda k: F.contains(F.col("text"), k))[0]).where("mark IS NOT NULL")
    begin = F.position(F.col("mark"), F.col("text"))
    full = marked.withColumn("whole", F.substring(F.col("text"), begin + F.length("mark"), F.greatest(F.lit(200), F.col("section_span"))))
    signals = T.signal_words(F.col("signals"), F.col("name"))
    named = ~F.col("need_site") | T.names_site(F.col("whole"), F.col("name")) | T.names_site(T.normalize("mark"), F.col("name"))
    passed = full.where(named & ((F.size(signals) == 0) | T.contains_any(F.col("whole"), signals)))
    stops = F.filter(F.transform("stops", lambda s: F.position(s, F.col("whole"))), lambda p: p > 0)
    cut = F.when(F.size(stops) > 0, F.substring(F.col("whole"), F.lit(1), F.array_min(stops) - 1)).otherwise(F.col("whole"))
    both = passed.withColumn("part", F.explode(F.array(F.struct(F.lit(False).alias("uncut"), cut.alias("t")), F.struct(F.lit(True).alias("uncut"), F.col("whole").alias("t")))))
    rows = gated(chunk_rows(both.select("*", "part.uncut", F.col("part.t").alias("section_text")), "section_text")).where("found.value IS NOT NULL")
    ends = Window.partitionBy("publisher", "document")
    chosen = rows.withColumn("cut_rows", F.count_if(~F.col("uncut")).over(ends)).where("uncut = (cut_rows = 0)")
    place = F.row_number().over(ends.orderBy("place")) - 1
    return chosen.withColumn("position", place).select(*RECORD, "uncut")


def lead_compact(documents: DataFrame) -> DataFrame:
    """X1 over the head of the text; records within 40 issues of the first."""
    head = with_rule(documents).withColumn("text", page_text(F.col("content")))
    head = head.withColumn("text", F.substring(F.col("text"), F.lit(1), F.greatest(F.lit(200), F.col("lead"))))
    rows = positioned(gated(chunk_rows(head, "text")).where("value IS NOT NULL"))
    first = F.min_by("issue", "position").over(Window.partitionBy("publisher", "document"))
    return rows.withColumn("first", first).where(F.abs(F.col("issue") - F.col("first")) <= 40).drop("first")


def user_feed(documents: DataFrame) -> DataFrame:
    """Every match of the feed row's form: issue and one digit. The context of a match is looked at
    from its start."""
    text = with_rule(documents).withColumn("text", page_text(F.col("content")))
    form, reach = "(?s)" + fixed.FEED_ROW, F.greatest(F.lit(80), F.col("span"))
    cut = text.withColumn("pieces", F.split(F.regexp_replace("text", form, "\u0001$0"), "\u0001", -1))  # each but the first begins with a match
    found = cut.select("*", F.posexplode("pieces").alias("place", "piece")).where("place > 0")
    context = F.substring(F.array_join(F.slice("pieces", F.col("place") + 1, reach), ""), F.lit(1), reach)  # a piece has a character at least
    found = found.withColumn("hit", F.struct(F.regexp_extract("piece", form, 1).alias("no"), F.regexp_extract("piece", form, 2).alias("digit")))
    signals = T.signal_words(F.col("signals"), F.col("name"))
    rows = found.withColumn("window", context).where(
        (~F.col("need_site") | T.names_site(F.col("window"), F.col("name")))
        & ((F.size(signals) == 0) | T.contains_any(F.col("window"), signals))
        & (~F.col("need_draw") | T.has_draw(F.col("window")))
        & T.contains_none(F.col("window"), F.col("excluded"))
        & F.col("hit.digit").rlike(r"^\d$")
    )
    return positioned(
        rows.withColumns({
            "issue": F.col("hit.no").cast("int"), "value": F.col("hit.digit"), "draw": T.draw_text(F.col("window")),
            "snippet": T.snippet(F.concat_ws(" ", T.normalize("name"), "window")),
        })
    )


def table(documents: DataFrame) -> DataFrame:
    """Tables between anchor and stop words. A header row sets the value and draw columns for the rows
    below it in its table (one that lacks a required header, or has no value column, clears them)."""
    content = F.coalesce("content", F.lit(""))
    ruled = with_rule(documents).where(~F.col("need_site") | T.names_site(T.normalize(content), F.col("name")))
    starts = F.filter(F.transform("anchors", lambda a: F.position(a, content)), lambda p: p > 0)
    ruled = ruled.where((F.size("anchors") == 0) | (F.size(starts) > 0)).withColumn(
        "content", F.when(F.size(starts) > 0, F.substring(content, F.array_min(starts), F.length(content))).otherwise(content)
    )
    ends = F.filter(F.transform("stops", lambda a: F.position(a, F.col("content"))), lambda p: p > 1)
    ruled = ruled.withColumn("content", F.when(F.size(ends) > 0, F.substring(F.col("content"), F.lit(1), F.array_min(ends) - 1)).otherwise(F.col("content")))
    cells = markup.table_rows(ruled).join(ruled.drop("content"), "document").withColumn("row_text", F.array_join("cells", " "))
    last = lambda test: F.array_max(F.filter(F.transform("cells", lambda c, i: F.when(test(c), i + 1)), lambda i: i.isNotNull()))
    value_at = last(lambda c: T.contains_any(c, F.col("headers")) | (F.contains(c, F.lit("禁")) & F.contains(c, F.lit("尾"))))
    draw_at = last(lambda c: F.contains(c, F.lit("开奖")))
    issue = T.first_issue(F.col("cells")[0])
    heading = issue.isNull() & (F.col("row_text").rlike("期数|期号|开奖结果") | F.exists("cells", lambda c: F.contains(c, F.lit("开奖"))))
    marked = cells.withColumns({"value_at": value_at, "draw_at": draw_at}).withColumn("heading", heading | F.col("value_at").isNotNull())
    complete = F.forall("required", lambda h: F.contains(F.col("row_text"), h))
    set_at = F.when(F.col("heading"), F.struct(F.when(complete, F.col("value_at")).alias("v"), F.col("draw_at").alias("d")))
    above = Window.partitionBy("document", "table_no").orderBy("row_no")
    rows = marked.withColumn("at", F.last(set_at, ignorenulls=True).over(above)).where("NOT heading AND at.v <= size(cells)")
    rows = rows.withColumn("issue", issue).withColumn("value", T.cell_digit(F.col("cells")[F.col("at.v") - 1]).cast("string"))
    rows = rows.where(F.col("issue").isNotNull() & F.col("value").isNotNull() & T.contains_none(F.col("row_text"), F.col("excluded")))
    source = T.normalize(F.coalesce(F.try_element_at("cells", F.col("at.d")), F.col("row_text")))
    return positioned(rows.withColumns({"draw": T.draw_text(source), "snippet": T.snippet(T.normalize("row_text")), "place": F.struct("table_no", "row_no")}))


def row_regex(documents: DataFrame) -> DataFrame:
    """Within the scope that scope_re finds (or from each place where the publisher is named), chunks
    whose value_re matches; the last digit of its last group is the value."""
    text = with_rule(documents).withColumn("text", page_text(F.col("content")))
    header = F.expr("regexp_instr(text, scope_re)")
    begin = F.when(F.col("scope_re").isNotNull(), header).otherwise(F.position(F.col("name"), F.col("text")))
    scoped = text.withColumn("begin", begin).where("begin > 0")
    scoped = scoped.withColumn("scope", F.substring(F.col("text"), F.col("begin"), F.col("section_span")))
    ends = F.filter(F.transform("stops", lambda s: F.position(s, F.col("scope"))), lambda p: p > 1)
    scoped = scoped.withColumn("scope", F.when(F.size(ends) > 0, F.substring(F.col("scope"), F.lit(1), F.array_min(ends) - 1)).otherwise(F.col("scope")))
    rows = chunk_rows(scoped, "scope").where(~F.col("need_draw") | T.has_draw(F.col("chunk")))
    raw = F.expr("regexp_extract(chunk, value_re, 1)")
    rows = rows.withColumn("value", F.nullif(F.right(raw, F.lit(1)), F.lit(""))).where("value IS NOT NULL")
    return positioned(rows.withColumns({"draw": T.draw_text(F.col("chunk")), "snippet": T.snippet(F.col("chunk"))}))


def body_rows(documents: DataFrame, container: str) -> DataFrame:
    """Rows of a body container (a regex over the ancestors' path, such as `div\\.body`): publisher, document,
    container, place, tag, path, text; the input of X7 to X17 and X24."""
    blocks = markup.text_blocks(documents).where(F.col("path").rlike(container))
    return blocks.join(documents.drop("content"), "document").withColumnRenamed("block_no", "place")


def shaped_rows(rows: DataFrame, shape: str) -> DataFrame:
    """Rows whose whole text has the publisher's shape: regex with issue and value groups (one or
    two digits, the second group optional)."""
    issue = F.regexp_extract("text", shape, 1).try_cast("int")
    one, two = F.regexp_extract("text", shape, 2), F.regexp_extract("text", shape, 3)
    value = F.when(two != "", F.concat_ws("、", one, two)).otherwise(F.nullif(one, F.lit("")))
    return rows.withColumn("issue", issue).withColumn("value", value).where("issue IS NOT NULL AND value IS NOT NULL")


def one_value_each(rows: DataFrame, bottom: Column) -> DataFrame:
    """Publisher, issue, value, conflict: presentations that agree count once."""
    return rows.groupBy("publisher", "issue").agg(
        F.when(F.size(F.collect_set("value")) == 1, F.min("value")).alias("value"), (F.size(F.collect_set("value")) > 1).alias("conflict"),
        F.when(F.bool_or(bottom), F.max("place")).otherwise(F.min("place")).alias("place"),
    )


def titled(blocks: DataFrame, title: Column) -> DataFrame:
    """Blocks below a heading that satisfies `title`, up to the next heading; with the heading's
    text and issue."""
    order = Window.partitionBy("document").orderBy("place")
    heading = F.col("tag").rlike(r"^h[1-6]$")
    marked = blocks.withColumn("heading", F.last(F.when(heading, F.struct("text", title.alias("wanted"))), ignorenulls=True).over(order))
    below = marked.where(~heading & F.col("heading.wanted"))
    return below.withColumn("title", F.col("heading.text")).withColumn("title_issue", T.first_issue(F.col("heading.text"))).drop("heading")


def authored(blocks: DataFrame, author: str) -> DataFrame:
    """Blocks of documents in which the block whose path matches `author` is exactly the publisher's
    name; others are left out as a whole."""
    told = blocks.where(F.col("path").rlike(author)).groupBy("document").agg(F.bool_and(T.normalize("text") == T.normalize("name")).alias("mine"))
    return blocks.join(told.where("mine").select("document"), "document", "left_semi")


def first_container(blocks: DataFrame) -> DataFrame:
    """Of each document's containers the first: a thread's first post."""
    first = blocks.groupBy("document").agg(F.min("container").alias("container"))
    return blocks.join(first, ["document", "container"], "left_semi")


def detail_rows(blocks: DataFrame, shape: str, issue: str = r"^(\d{1,4})\s*期") -> DataFrame:
    """Rows of the one titled detail: publisher, issue, value, error. A row of an issue that hasn't
    the publisher's shape is an error record; a document with several details of the title has none."""
    single = blocks.groupBy("document").agg(F.count_distinct("title").alias("titles"), F.count_distinct("container").alias("parts")).where("titles = 1 AND parts = 1")
    rows = blocks.join(single.select("document"), "document", "left_semi").withColumn("issue", F.regexp_extract("text", issue, 1).try_cast("int")).where("issue IS NOT NULL")
    fits = F.col("text").rlike(shape)
    value = F.when(fits, F.regexp_extract("text", shape, 2))
    return rows.select("publisher", "document", "place", "issue", value.alias("value"), F.when(~fits, "invalid row").alias("error"))


def keyword_block(documents: DataFrame, marker: str, reach: int = 160, field: int = 100) -> DataFrame:
    """X10 (text form): from the marker up to its next occurrence; the publisher within `reach` characters;
    per chunk the digit within `field` characters after the marker's category word."""
    text = with_rule(documents).withColumn("text", page_text(F.col("content")))
    at = F.position(F.lit(marker), F.col("text"))
    block = text.where(at > 0).withColumn("rest", F.substring(F.col("text"), at + len(marker), F.length("text")))
    following = F.position(F.lit(marker), F.col("rest"))
    block = block.withColumn("block", F.when(following > 0, F.substring(F.col("rest"), F.lit(1), following - 1)).otherwise(F.col("rest")))
    block = block.where(~F.col("need_site") | T.names_site(F.substring(F.col("text"), F.greatest(F.lit(1), at - reach), F.lit(2 * reach)), F.col("name")))
    rows = chunk_rows(block, "block")
    value = F.nullif(F.regexp_extract(F.substring(F.col("chunk"), F.lit(1), F.lit(field)), r"[\[(]\s*(\d)\s*尾?\s*[\])]", 1), F.lit(""))
    return positioned(rows.withColumns({"value": value, "draw": T.draw_text(F.col("chunk")), "snippet": T.snippet(F.col("chunk"))}).where("value IS NOT NULL"))


def target_blocks(documents: DataFrame) -> DataFrame:
    """Distinct texts of blocks under an element whose id is exactly the document's target_id, never a
    link, that name the author."""
    blocks = markup.text_blocks(documents).join(documents.drop("content"), "document")
    own = F.exists(F.split("path", ">"), lambda p: F.regexp_extract(p, r"#([^.@]+)", 1) == F.col("target_id"))
    rows = blocks.where((F.col("tag") != "a") & own)
    named = rows.groupBy("publisher", "document", "container").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_no", "text"))), lambda x: x["text"]), " ").alias("text"), F.max("name").alias("name")
    )
    return named.where(T.names_site(T.normalize("text"), F.col("name"))).select("publisher", "document", "text").distinct()


def links(pages: DataFrame) -> DataFrame:
    """Url, place, text, target, status of the anchors of pages (url, html), resolved against the page, with the
    pages' further columns. A malformed link has no target."""
    form = F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""")
    both = F.arrays_zip(F.regexp_extract_all("html", form, F.lit(1)).alias("href"), F.regexp_extract_all("html", form, F.lit(2)).alias("inner"))
    own = [c for c in pages.columns if c != "html"]
    rows = pages.select(*own, F.posexplode(both).alias("place", "a"))
    resolved = rows.select(*own, "place", page_text(F.col("a.inner")).alias("text"), absolute_url("url", F.col("a.href")).alias("target"))
    return resolved.withColumn("status", F.when(F.col("target").isNull(), "malformed link").otherwise("ok"))


def chosen_link(found: DataFrame, keywords: list[str], bottom: bool) -> DataFrame:
    """By page the first or last link whose text has all keywords."""
    fits = found.where(F.col("target").isNotNull() & F.forall(T.words(keywords), lambda k: F.contains(F.col("text"), k)))
    pick = F.max_by if bottom else F.min_by
    return fits.groupBy("url").agg(pick("target", "place").alias("target"))


def follow(start: DataFrame, found: DataFrame, next_word: str, goal: list[str], depth: int = 10) -> DataFrame:
    """From start (url), at most `depth` pages along links that say next_word, to the first page with a
    link whose text has all of `goal`: url, page, target. Each step is an equi-join with the stored links."""
    goals = chosen_link(found, goal, False).withColumnRenamed("url", "page")
    nexts = chosen_link(found, [next_word], False).withColumnRenamed("url", "page").withColumnRenamed("target", "next")
    now, done = start.select("url", F.col("url").alias("page")), None
    for _ in range(depth):
        hit = now.join(goals, "page").select("url", "page", "target")
        done = hit if done is None else done.unionByName(hit)
        now = now.join(goals.select("page"), "page", "left_anti").join(nexts, "page").where("next != page").select("url", F.col("next").alias("page"))
    return done.dropDuplicates(["url"])


def structured_only(documents: DataFrame, text_only: Column) -> DataFrame:
    """Of a publisher's documents those with tags, if any has; all others where the rule wants text."""
    tags = F.col("content").rlike(r"<[a-zA-Z][^>]*>")
    some = F.max(tags).over(Window.partitionBy("publisher"))
    return documents.withColumn("some", some).where(F.when(text_only, ~tags).otherwise(tags | ~F.col("some"))).drop("some")


def diagnosis(documents: DataFrame, target: Column, signals: Column) -> DataFrame:
    """By publisher: lacks_issue, lacks_signal, and why nothing was found."""
    text = page_text(F.col("content"))
    rows = documents.withColumn("text", text)
    has_issue = F.array_contains(T.all_issues(F.col("text")), target)
    mine = F.exists(T.issue_chunks(F.col("text")), lambda c: (T.leading_issue(c) == target) & T.has_draw(c))
    summed = rows.groupBy("publisher").agg(
        F.bool_or(F.coalesce(has_issue, F.lit(False))).alias("issue"), F.bool_or(F.coalesce(mine, F.lit(False))).alias("field"), F.bool_or(T.contains_any(F.col("text"), signals)).alias("word")
    )
    why = F.concat_ws("; ", F.when(~F.col("issue"), "issue absent"), F.when(F.col("issue") & ~F.col("field"), "no valid field"), F.when(~F.col("word"), "keyword absent"))
    return summed.select("publisher", (~F.col("issue")).alias("lacks_issue"), (~F.col("word")).alias("lacks_signal"), why.alias("why"))


for _kind, _function in {"compact": compact, "section": section, "lead_compact": lead_compact, "user_feed": user_feed, "table": table, "dedicated": row_regex}.items():
    register_extractor(_kind, _function)

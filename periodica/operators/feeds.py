"""Feeds and articles in JSON. What has the wrong type is null and passed over, as if absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..helpers.tables import stored

ITEM = (
    "struct<id:string,user_id:string,user:struct<id:string,nickname:string>,topic:string,sub_topic:string,title:string,draw:string,content:string,body:string>"
)
ARTICLE = (
    "struct<id:string,authorNickname:string,title:string,html:string,content:string,sectionId:string,formSections:array<struct<disclaimerHtml:string,htmlCode:string>>>"
)


def item_issue(item: Column) -> Column:
    """The issue of a feed item: its draw if that is a number, else the first in its title."""
    draw = F.trim(item["draw"])
    return F.coalesce(F.when(draw.rlike(r"^\d+$"), draw.try_cast("int")), T.first_issue(F.coalesce(item["title"], F.lit(""))))


PAGE_ITEMS = 1_000_000  # more than a page of a feed has


def paged_items(feeds: DataFrame) -> DataFrame:
    """The items of feeds with their place. A feed may come in pages, one text each, numbered by page_no from 0, so that
    no row holds all of its history."""
    rows = feeds.select("*", F.posexplode(F.from_json("text", f"array<{ITEM}>")).alias("at", "item"))
    page = F.col("page_no").cast("long") * PAGE_ITEMS if "page_no" in feeds.columns else F.lit(0).cast("long")
    return rows.withColumn("place", page + F.col("at")).drop("at")


def feed_items(feeds: DataFrame) -> DataFrame:
    """Items of feeds (feed, owner, name, keyword, text, perhaps page_no): owned, with an id, on the topic, by the
    publisher, with a body. A repeated id of the owner's fails the feed."""
    rows = paged_items(feeds)
    owner = F.trim(F.coalesce("item.user_id", "item.user.id"))
    mine = rows.where((owner == F.col("owner")) & (F.coalesce("item.id", F.lit("")) != ""))
    body = F.coalesce(F.nullif("item.content", F.lit("")), F.col("item.body"))
    fields = F.array_compact(F.array("item.user.nickname", "item.topic", "item.sub_topic", "item.title", body))
    full = F.filter(fields, lambda f: F.trim(f) != "")
    document = F.array_join(F.when(F.array_contains(full, F.col("name")), full).otherwise(F.concat(F.array("name"), full)), "\n")
    nickname = F.coalesce("item.user.nickname", F.lit(""))
    repeated = F.count("*").over(Window.partitionBy("feed", "item.id")) > 1
    return (
        mine.withColumn("repeated", F.max(repeated).over(Window.partitionBy("feed")))
        .withColumns({"item_id": F.col("item.id"), "issue": item_issue(F.col("item")), "document": document, "body": body})
        .where(F.contains("document", F.col("keyword")) & ((nickname == "") | (T.normalize(nickname) == T.normalize("name"))) & F.col("body").isNotNull())
        .select("feed", "name", "place", "item_id", "issue", "document", "repeated")
    )


def edge_items(items: DataFrame, targets: DataFrame) -> DataFrame:
    """Feed, status, item_id, document: the items of the target issue, whose edge one has to stand
    at the feed's edge; several only where the publisher has several records an issue.
    targets: feed, target, bottom, several."""
    joined = items.join(targets, "feed")
    target = F.coalesce(F.col("issue") == F.col("target"), F.lit(False))
    ends = joined.groupBy("feed").agg(
        F.when(F.bool_or("bottom"), F.max_by("issue", "place")).otherwise(F.min_by("issue", "place")).alias("edge_issue"),
        F.count_if(target).alias("n"), F.bool_or("repeated").alias("repeated"), F.bool_or("several").alias("several"), F.max("target").alias("target"),
    )
    status = (
        F.when(F.col("repeated"), "repeated id")
        .when(F.col("n") == 0, "no record")
        .when(~F.col("edge_issue").eqNullSafe(F.col("target")), "edge")
        .when((F.col("n") > 1) & ~F.col("several"), "several records")
        .otherwise("ok")
    )
    judged = ends.select("feed", status.alias("status"))
    return judged.join(joined.where(target).select("feed", "place", "item_id", "document"), "feed", "left").select(
        "feed", "status", *[F.when(F.col("status") == "ok", F.col(c)).alias(c) for c in ("item_id", "document")]
    ).distinct()


def history_items(histories: DataFrame) -> DataFrame:
    """Items of reference histories (feed, owner, sub_topic, text, perhaps page_no) as edge_items takes them."""
    rows = paged_items(histories)
    mine = (F.coalesce("item.user_id", F.lit("")) == F.col("owner")) & (T.normalize(F.col("item.sub_topic")) == T.normalize("sub_topic"))
    return rows.where(mine).select(
        "feed", "place", F.col("item.id").alias("item_id"), item_issue(F.col("item")).alias("issue"), F.lit(None).cast("string").alias("document"), F.lit(False).alias("repeated")
    ).where("issue IS NOT NULL")


def details(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Wanted (feed, item_id, owner, sub_topic, name) joined by id to detail records (item_id, text);
    status tells what doesn't fit."""
    both = wanted.join(stored.select("item_id", F.from_json("text", ITEM).alias("d")), "item_id", "left")
    status = (
        F.when(F.col("d").isNull() | (F.coalesce("d.id", F.lit("")) != F.col("item_id")), "other id")
        .when(F.coalesce("d.user_id", F.lit("")) != F.col("owner"), "other author")
        .when(T.normalize(F.col("d.sub_topic")) != T.normalize("sub_topic"), "other topic")
        .when(F.trim(F.coalesce("d.content", F.lit(""))) == "", "no body")
        .otherwise("ok")
    )
    text = F.concat_ws("\n", "name", F.coalesce("d.topic", F.lit("")), F.coalesce("d.sub_topic", F.lit("")), "d.content")
    return both.select("feed", "item_id", status.alias("status"), F.when(status == "ok", text).alias("document"))


def mirrors(items: DataFrame) -> DataFrame:
    """Publisher, status of items (publisher, item_id, document, several) from several endpoints: an id
    must have one body everywhere; without `several` there may be one id only."""
    each = items.groupBy("publisher", "item_id").agg(F.count_distinct("document").alias("bodies"), F.bool_or("several").alias("several"))
    summed = each.groupBy("publisher").agg(F.max("bodies").alias("bodies"), F.count("*").alias("ids"), F.bool_or("several").alias("several"))
    status = F.when(F.col("bodies") > 1, "bodies differ").when((F.col("ids") > 1) & ~F.col("several"), "several ids").otherwise("ok")
    return summed.select("publisher", "ids", status.alias("status"))


def article_status(article: Column, target: Column, author: Column) -> Column:
    """What is wrong with an article, or ok."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    body = F.coalesce(F.nullif(article["html"], F.lit("")), article["content"])
    return (
        F.when(article["id"] != target, "other id")
        .when(blank(article["authorNickname"]), "no author")
        .when(blank(article["title"]), "no title")
        .when(blank(body), "empty shell")
        .when((author != "") & (T.normalize(article["authorNickname"]) != T.normalize(author)), "other author")
        .otherwise("ok")
    )


def article_documents(article: Column) -> Column:
    """Fields of an article, base64 undone where it is valid, each followed by its text without tags where that
    differs; at the end all joined."""
    forms = F.flatten(F.transform(F.coalesce(article["formSections"], F.array().cast("array<struct<disclaimerHtml:string,htmlCode:string>>")), lambda f: F.array(f["disclaimerHtml"], f["htmlCode"])))
    fields = F.filter(F.concat(F.array(article["authorNickname"], article["title"], article["html"], article["content"]), forms), lambda f: F.coalesce(f, F.lit("")) != "")

    def undone(f: Column) -> Column:
        text = F.trim(f)
        padded = F.concat(text, F.repeat(F.lit("="), F.pmod(-F.length(text), F.lit(4)).cast("int")))
        decoded = F.when(padded.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$"), F.try_validate_utf8(F.try_to_binary(padded, F.lit("base64")).cast("string")))
        return F.coalesce(F.nullif(decoded, F.lit("")), f)

    def both(f: Column) -> Column:
        return F.transform(F.array(f), lambda d: F.array_compact(F.array(d, F.when((T.strip_tags(d) != "") & (T.strip_tags(d) != d), T.strip_tags(d)))))[0]

    parts = F.flatten(F.transform(F.transform(fields, undone), both))
    return F.when(F.size(parts) > 0, F.concat(parts, F.array(F.array_join(parts, "\n")))).otherwise(parts)


def landing_articles(pages: DataFrame) -> DataFrame:
    """Page, status, documents of landing pages (page, target_id, author, text): the one article of the
    id among all sections, whose own section has to be that one."""
    sections = F.from_json("text", f"struct<sectionData:map<string,struct<adminArticles:array<{ARTICLE}>>>>")["sectionData"]
    rows = pages.select("page", "target_id", "author", F.explode_outer(sections).alias("section", "held")).select("page", "target_id", "author", "section", F.explode_outer("held.adminArticles").alias("article"))
    return single_article(rows, (F.coalesce("one.article.sectionId", F.lit("")) != "") & (F.col("one.article.sectionId") != F.col("one.section")))


def single_article(rows: DataFrame, astray: Column) -> DataFrame:
    fits = F.col("article.id") == F.col("target_id")
    grouped = rows.groupBy("page").agg(F.count_if(fits).alias("n"), F.first(F.when(fits, F.struct("section", "article")), ignorenulls=True).alias("one"), F.max("target_id").alias("target_id"), F.max("author").alias("author"))
    status = F.when(F.col("n") != 1, F.concat(F.col("n").cast("string"), F.lit(" articles"))).when(astray, "other section").otherwise(article_status(F.col("one.article"), F.col("target_id"), F.col("author")))
    return grouped.select("page", status.alias("status"), F.when(status == "ok", article_documents(F.col("one.article"))).alias("documents"))


def nested_articles(pages: DataFrame) -> DataFrame:
    """As X22, from JSON of any nesting: objects with the target's id (or _id) and a field of an article. The text
    is read as a variant and taken apart level by level, each level a join with the children of the last, until a
    level has none. Text that isn't JSON, or nests deeper than the JSON reader goes (about a thousand levels), has no articles."""
    spark = pages.sparkSession
    rows = pages.select("page", "target_id", "author", F.try_parse_json(F.coalesce("text", F.lit(""))).alias("v"))
    level = rows.where("v IS NOT NULL")
    field = lambda name, kind="string": F.try_variant_get("v", f"$.{name}", kind)
    ident = F.trim(F.coalesce(field("id"), field("_id")))
    article = field("html", "variant").isNotNull() | field("content", "variant").isNotNull() | field("authorNickname", "variant").isNotNull()
    hits = None
    while True:
        found = level.where((ident == F.col("target_id")) & article).select("page", F.to_json("v").alias("article"))
        hits = found if hits is None else hits.unionByName(found)
        children = spark.tvf.variant_explode(F.col("v").outer()).select(F.col("value").alias("child"))
        below = level.lateralJoin(children).select("page", "target_id", "author", F.col("child").alias("v"))
        level = stored(below.where(F.to_json("v").rlike(r"^[\[{]")))
        if level.isEmpty():
            break
    own = pages.select("page", "target_id", "author").join(hits, "page", "left")
    return single_article(own.select("page", "target_id", "author", F.lit("").alias("section"), F.from_json("article", ARTICLE).alias("article")), F.lit(False))


def forum_details(pages: DataFrame) -> DataFrame:
    """Page, status, documents of forum details (page, target_id, author, text)."""
    kind = "struct<data:struct<id:string,title:string,content:string,authorNickname:string,author:string,user:struct<nickname:string,name:string>>>"
    d = F.col("d")
    rows = pages.withColumn("d", F.from_json("text", kind)["data"])
    author = F.coalesce(*[F.nullif(c, F.lit("")) for c in (d["authorNickname"], d["author"], d["user"]["nickname"], d["user"]["name"])], F.lit(""))
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    status = (
        F.when(d.isNull(), "no data")
        .when(F.coalesce(d["id"], F.lit("")) != F.col("target_id"), "other id")
        .when(blank(d["title"]), "no title")
        .when(blank(d["content"]), "no body")
        .when((F.col("author") != "") & (T.normalize(author) != T.normalize("author")), "other author")
        .otherwise("ok")
    )
    return rows.select("page", status.alias("status"), F.when(status == "ok", F.array(d["title"], d["content"], F.concat_ws("\n", d["title"], d["content"]))).alias("documents"))

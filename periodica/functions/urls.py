"""Identities of URLs as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def authority(url: Column) -> Column:
    return F.lower(F.coalesce(part(url, "AUTHORITY"), F.lit("")))


def fragment(url: Column) -> Column:
    return F.regexp_extract(F.trim(url), "#(.*)$", 1)


def identity(url: Column) -> Column:
    """Scheme, authority, path, params, query, fragment as one struct; null without scheme or host.
    Params are what follows a semicolon in the path's last segment."""
    url = F.trim(url)
    path = F.coalesce(part(url, "PATH"), F.lit(""))
    bare = F.regexp_replace(path, ";[^/]*$", "")
    fields = F.struct(
        F.lower(part(url, "PROTOCOL")).alias("scheme"),
        authority(url).alias("authority"),
        F.when(bare == "", F.lit("/")).otherwise(bare).alias("path"),
        F.regexp_extract(path, ";([^/]*)$", 1).alias("params"),
        F.coalesce(part(url, "QUERY"), F.lit("")).alias("query"),
        F.rtrim(fragment(url), F.lit("/")).alias("fragment"),
    )
    return F.when(part(url, "PROTOCOL").isNotNull() & (authority(url) != ""), fields)


def source(url: Column) -> Column:
    """Host, kind and id of the source behind a URL; null if it names none."""
    url = F.trim(url)
    host = authority(url)
    path = F.coalesce(part(url, "PATH"), F.lit(""))
    place = F.trim(fragment(url), F.lit("/"))
    endpoint = F.lower(F.rtrim(path, F.lit("/")))
    query = F.coalesce(part(url, "QUERY"), F.lit(""))

    def made(kind: Column | str, ident: Column) -> Column:
        return F.struct(host.alias("host"), (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), ident.alias("id"))

    def asked(key: str) -> Column:
        return F.lower(F.trim(F.coalesce(F.try_url_decode(F.regexp_extract(query, rf"(?:^|&){key}=([^&]+)", 1)), F.lit(""))))

    user, item = (F.regexp_extract(place, r"(?i)^users/(\d+)/references/(\d+)$", i) for i in (1, 2))
    article = F.regexp_extract(path, r"(?i)/article/(?:admin|manager|lottery)/([^/?#]+)", 1)
    static = F.regexp_extract(path, r"(?i)/article/ar_content/id/([^/?#]+)", 1)
    topic = F.regexp_extract(path, r"(?i)/topic/([^/?#]+)", 1)
    return F.when(
        host != "",
        F.when(user != "", made("spa-reference", F.concat_ws("/", user, item)))
        .when(place.rlike(r"(?i)^forums/\d+$"), made("spa-forum", F.regexp_extract(place, r"(\d+)$", 1)))
        .when(place.rlike(r"(?i)^users/\d+$"), made("spa-user", F.regexp_extract(place, r"(\d+)$", 1)))
        .when(article != "", made("article", F.lower(article)))
        .when(static != "", made("static-article", F.lower(static)))
        .when(topic != "", made("topic", F.lower(F.regexp_replace(topic, r"(?i)\.html?$", ""))))
        .when((endpoint != "/list.aspx") & (asked("tid") != ""), made(F.concat(endpoint, F.lit("?tid")), asked("tid")))
        .when((endpoint != "/list.aspx") & (asked("id") != ""), made(F.concat(endpoint, F.lit("?id")), asked("id"))),
    )


def record_id(url: Column) -> Column:
    """The article id of the path, else the forum id of the fragment, else empty."""
    article = F.regexp_extract(F.coalesce(part(F.trim(url), "PATH"), F.lit("")), r"(?i)/article/(?:admin|manager|lottery)/([^/?#]+)", 1)
    forum = F.regexp_extract(F.trim(fragment(url), F.lit("/")), r"(?i)^forums/(\d+)$", 1)
    return F.coalesce(F.nullif(article, F.lit("")), forum)


def unscoped(url: Column) -> Column:
    """A URL that aggregates sources and so must not be read without a rule."""
    place = F.trim(fragment(url), F.lit("/"))
    feed = F.trim(F.coalesce(part(F.trim(url), "PATH"), F.lit("")), F.lit("/")) == "user"
    owner = F.regexp_extract(F.coalesce(part(F.trim(url), "QUERY"), F.lit("")), "(?:^|&)userId=([^&]+)", 1)
    return place.rlike(r"(?i)^users/\d+$") | (feed & (owner != ""))

"""Sources without a feed: channel listings with embedded JSON, article pages, numbered issues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwick.functions import html as H
from loomwick.functions.dates import listing_date, month_day, parse_date
from loomwick.functions.text import one_space, strip
from loomwick.functions.url import ISSUE
from loomwick.operators.sequential import last_issue

#: Article addresses, the JSON keys of a date in order, limits.
ARTICLE = r"(?i)\A(?:https?://(?:www|m)\.thepaper\.cn)?/newsDetail_forward_(\d{5,12})(?:[/?#]|\z)"
ARTICLE_HOME = "https://www.thepaper.cn/newsDetail_forward_"
DATE_KEYS = ["pubTimeLong", "publishTime", "pubTime", "pubTimeNew"]
COPY_LIMIT, LEAST_ARTICLE, LEAST_ISSUE = 60_000, 300, 500
MOST_ISSUES, MISSES, BACKLOG = 2000, 3, 30


def objects(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Every object of the JSON that pages (html) embed, in document order: keep, pos, node."""
    data = H.tag_text(F.col("html"), "script", "id", "__NEXT_DATA__")
    return pages.lateralJoin(H.JsonObjects(data.outer())).select(*keep, "pos", "node")


def _field(name: str) -> Column:
    return F.get_json_object("node", f"$.{name}")


def _date(now: Column) -> Column:
    return listing_date(F.filter(F.array(*[_field(k) for k in DATE_KEYS]), lambda v: v.isNotNull() & ~v.isin("", "true", "false")), now)


def listing(pages: DataFrame, now: Column) -> DataFrame:
    """channel, cid, title, at, ord of listed articles (pages: channel, html): embedded JSON first, else the links.

    Links repeat their title, which is halved; of several links to one article the longest text counts.
    """
    name = strip(F.coalesce(F.nullif(_field("name"), F.lit("")), _field("title"), F.lit("")))
    link = F.coalesce(_field("link"), _field("url"), F.lit(""))
    rows = objects(pages, ["channel"]).select("channel", F.coalesce(_field("contId"), F.lit("")).alias("cid"), name.alias("title"), link.alias("link"), _date(now).alias("at"), "pos")
    good = rows.filter(F.col("cid").rlike(r"\A\d+\z") & (F.col("title") != "") & ((F.col("link") == "") | F.col("link").rlike(ARTICLE)))
    first = good.groupBy("channel", "cid").agg(F.min_by(F.struct("title", "at", "pos"), "pos").alias("r")).select("channel", "cid", "r.title", "r.at", F.col("r.pos").cast("long").alias("ord"))
    anchors = F.regexp_extract_all("html", F.lit(r"(?is)<a\b[^<>]*>.*?</a"), F.lit(0))
    links = pages.select("channel", F.posexplode(anchors).alias("pos", "a")).withColumn("href", H.attribute(F.regexp_extract("a", r"(?is)\A<a\b([^<>]*)>", 1), "href"))
    text = one_space(F.regexp_replace(F.regexp_replace("a", r"(?is)</a\z", ""), r"<[^<>]*>", " "))
    half = F.floor(F.length("t") / 2).cast("int")
    front = strip(F.expr("substring(t, 1, cast(floor(length(t) / 2) as int))"))
    back = strip(F.expr("substring(t, cast(floor(length(t) / 2) as int) + 1)"))
    links = links.select("channel", "pos", F.regexp_extract("href", ARTICLE, 1).alias("cid"), "href", text.alias("t")).filter("cid <> '' and href not like '%commTag%'")
    links = links.withColumn("t", F.when((half > 0) & (front == back), front).otherwise(F.col("t"))).filter("t <> ''")
    longest = links.groupBy("channel", "cid").agg(F.max_by(F.struct("t", "pos"), F.struct(F.length("t"), -F.col("pos"))).alias("r"))
    longest = longest.select("channel", "cid", F.col("r.t").alias("title"), F.lit(None).cast("timestamp").alias("at"), F.col("r.pos").cast("long").alias("ord"))
    return first.unionByName(longest.join(first.select("channel").distinct(), "channel", "left_anti"))


def articles(pages: DataFrame, now: Column) -> DataFrame:
    """cid, content, at of article pages (cid, html): the article's own longest body, else the longest other, else its element."""
    rows = objects(pages, ["cid"]).withColumns({"own": F.coalesce(_field("contId"), F.lit("")) == F.col("cid"), "c": _field("content"), "at": _date(now)})
    body = F.max_by(F.when(F.contains("c", F.lit("<")), F.col("c")), F.when(F.contains("c", F.lit("<")), F.struct("own", F.length("c"), -F.col("pos"))))
    when = F.min_by(F.when(F.col("own"), F.col("at")), F.when(F.col("own") & F.col("at").isNotNull(), F.col("pos")))
    found = rows.groupBy("cid").agg(body.alias("body"), when.alias("json_at"))
    both = pages.join(found, "cid", "left")
    element = F.coalesce(H.tag_text(F.col("html"), "article"), H.tag_text(F.col("html"), "main"))
    meta = F.try_element_at(H.meta_values(F.col("html"), ["article:published_time"]), F.lit(1))
    written = F.regexp_extract("html", r"(20\d{2}-\d{2}-\d{2} \d{2}:\d{2})", 1)
    at = F.coalesce("json_at", parse_date(meta), parse_date(F.nullif(written, F.lit(""))) - F.expr("interval 8 hours"))
    text = H.html_to_text(F.coalesce("body", element, F.lit("")))
    return both.select("cid", text.alias("t"), at.alias("at")).select("cid", F.when(F.length("t") >= LEAST_ARTICLE, F.substring("t", 1, COPY_LIMIT)).otherwise("").alias("content"), "at")


def open_articles(listed: DataFrame, archive: DataFrame) -> DataFrame:
    """Listed articles that are new or still without a text: the only ones to fetch."""
    known = archive.select(F.regexp_extract("url", ARTICLE, 1).alias("cid"), "summary").filter("cid <> '' and coalesce(summary, '') <> ''")
    return listed.join(known.select("cid"), "cid", "left_anti")


def listing_raws(listed: DataFrame, fetched: DataFrame, archive: DataFrame, category: str, source: str) -> DataFrame:
    """Raw rows of a listing: fetched body and date first, then the listed date, then the stored one."""
    known = archive.select(F.regexp_extract("url", ARTICLE, 1).alias("cid"), parse_date(F.col("published_at")).alias("stored")).filter("cid <> ''")
    known = known.groupBy("cid").agg(F.max("stored").alias("stored"))
    rows = listed.join(fetched.select("cid", "content", F.col("at").alias("page_at")), "cid", "left").join(known, "cid", "left")
    return rows.select(
        "ord", F.lit(category).alias("category"), F.lit(source).alias("source"), "title", F.concat(F.lit(ARTICLE_HOME), "cid").alias("url"),
        F.coalesce("page_at", "at", "stored").alias("published_at"), F.lit("").alias("feed_url"), F.coalesce("content", F.lit("")).alias("content"),
        F.array().cast("array<string>").alias("images"),
    )


def issues(pages: DataFrame, today: Column, name: str = "BestBlogs.dev") -> DataFrame:
    """n, title, content, at of issue pages (n, html)."""
    title = strip(F.regexp_replace(H.page_title(F.col("html")), rf"\s*\|\s*{name.replace('.', chr(92) + '.')}\s*\z", ""))
    rows = pages.select("n", title.alias("title"), H.html_to_text(F.coalesce(H.tag_text(F.col("html"), "main"), H.tag_text(F.col("html"), "article"), F.col("html"))).alias("t"), F.try_element_at(H.meta_values(F.col("html"), ["article:published_time"]), F.lit(1)).alias("meta"))
    full = F.regexp_extract("t", r"(20\d{2}-\d{2}-\d{2})(?!\d)", 1)
    short = F.regexp_extract("meta", r"(\d{1,2}-\d{1,2})", 1)
    padded = F.array_join(F.transform(F.split(short, "-"), lambda p: F.lpad(p, 2, "0")), "-")
    at = F.when(full != "", parse_date(full)).when(short != "", month_day(padded, today).cast("timestamp"))
    return rows.select("n", "title", F.when(F.length("t") >= LEAST_ISSUE, F.substring("t", 1, COPY_LIMIT)).otherwise("").alias("content"), at.alias("at"))


def known_issue(archive: DataFrame) -> int:
    """The highest stored issue number, 0 if none."""
    return archive.agg(F.coalesce(F.max(F.regexp_extract("url", ISSUE, 1).try_cast("int")), F.lit(0))).first()[0]


def new_issues(archive: DataFrame, exists: Callable[[int], bool], too_old: Callable[[int], bool]) -> list[int]:
    """Numbers to add: upward from the highest known one; without one, back from the last until one is too old."""
    known = known_issue(archive)
    seen: dict[int, bool] = {}
    probe = lambda n: seen.setdefault(n, exists(n)) if n not in seen else seen[n]
    last = last_issue(probe, known, MOST_ISSUES, MISSES)
    if known:
        return [n for n in range(known + 1, last + 1) if probe(n)]
    out = []
    for n in range(last, max(0, last - BACKLOG), -1):
        if probe(n):
            if too_old(n):
                break
            out.append(n)
    return sorted(out)

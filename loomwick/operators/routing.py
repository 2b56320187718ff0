"""Which source a pending record's text comes from, and what becomes of the record afterwards."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwick.functions.text import blank, strip
from loomwick.functions.url import host_in, is_episode, is_youtube
from loomwick.schemas import BLANK_SUMMARY, GONE_SUMMARY

#: Titles of marks on a review site, whose note stands in the feed copy alone.
MARK_TITLE = r"\A(?:想|在|最近在)?(?:看|读|讀|听|聽|玩)(?:过|過)?.{1,80}"


def route(
    url: Column, title: Column, feed_content: Column, feed_images: Column, has_transcript: Column,
    skip: Iterable[str] = (), feed_first: Iterable[str] = (), mark_title: str = MARK_TITLE,
) -> Column:
    """youtube, podcast, douban, feed or fetch; null if the record waits.  The first rule that applies decides.

    A feed copy of null means that no feed listed the record in this run, an empty one that the copy has no text.
    """
    copy = ~blank(feed_content) | (F.coalesce(F.size(feed_images), F.lit(0)) > 0)
    mark = host_in(url, ["douban.com"]) & strip(F.coalesce(title, F.lit(""))).rlike(mark_title)
    return (
        F.when(host_in(url, list(skip)), None)
        .when(is_youtube(url), "youtube")
        .when(is_episode(url), F.when(has_transcript, "podcast"))
        .when(mark, F.when(feed_content.isNotNull(), "douban"))
        .when(host_in(url, list(feed_first)) & copy, "feed")
        .otherwise("fetch")
    )


def settle(rows: DataFrame, status_col: str = "status") -> DataFrame:
    """New summary of routed rows from (route, status, built): the text, a blank mark, the gone mark, or null to wait.

    built null: undecodable, tried again later; empty: nothing but boilerplate, which is final.
    """
    built, status = F.col("built"), F.col(status_col)
    fetched = (
        F.when(status == "gone", GONE_SUMMARY).when(status.isin("blocked", "retry", "failed"), None).when(built == "", BLANK_SUMMARY).otherwise(built)
    )
    offline = F.when(built == "", BLANK_SUMMARY).otherwise(built)
    new = F.when(F.col("route").isin("douban", "feed", "youtube", "podcast"), offline).when(F.col("route") == "fetch", fetched)
    return rows.withColumn("summary", new)


def capped(rows: DataFrame, most: int, order: str) -> DataFrame:
    """The rows that may be fetched in this run; 0 or less: none."""
    return rows.orderBy(order).limit(max(most, 0))

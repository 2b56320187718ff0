"""Keyed merging of records: de-duplication, upsert, retention, ordering.

First-wins and stable rules go by an explicit column ``ord``; no rule relies on partition order.  Groups are
folded by aggregates with map-side combine, never by collecting a group's rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwick.functions.dates import iso, parse_date
from loomwick.functions.text import blank, strip
from loomwick.functions.url import canonical_url, host_of, make_id, scheme
from loomwick.schemas import FALLBACK_MARK, ITEM


def _first_known(value: Column, ord_: Column) -> Column:
    """The first value in order that is not blank."""
    known = ~blank(value)
    return F.min_by(F.when(known, value), F.when(known, ord_))


def better_text(text: Column, ord_: Column) -> Column:
    """Aggregate: real text over one with a fallback mark, then the longer, then the first; null if all are blank."""
    known = ~blank(text)
    rank = F.struct(~F.contains(text, F.lit(FALLBACK_MARK)), F.length(text), -ord_)
    return F.max_by(F.when(known, text), F.when(known, rank))


def absorb(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """Folds the rows of each key into the first: its id, the better summary, the latest sighting, else first known values.

    A first row whose summary is only a blank mark keeps it when no row has a real one.
    """
    ord_ = F.col(order)
    fields = [c for c in rows.columns if c not in {*keys, order, "id", "summary", "last_seen_at"}]
    aggs = [F.min(ord_).alias(order)]
    if "id" in rows.columns and "id" not in keys:
        aggs.append(F.min_by("id", ord_).alias("id"))
    if "summary" in rows.columns:
        mark = F.min_by(F.struct("summary"), ord_)["summary"]
        aggs.append(F.coalesce(better_text(F.col("summary"), ord_), mark).alias("summary"))
    if "last_seen_at" in rows.columns:
        aggs.append(F.max("last_seen_at").alias("last_seen_at"))
    for c in fields:
        kind = rows.schema[c].dataType.simpleString()
        plain = F.min_by(F.col(c), F.when(F.col(c).isNotNull(), ord_))
        aggs.append((F.coalesce(_first_known(F.col(c), ord_), F.min_by(F.struct(c), ord_)[c]) if kind == "string" else plain).alias(c))
    return rows.groupBy(*keys).agg(*aggs).select(*rows.columns)


def dedupe(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Two passes: by (published_at, source, url) where all three are known, then by id; rows without an id go."""
    keys = ["published_at", "source", "url"]
    whole = F.lit(True)
    for k in keys:
        whole = whole & (F.coalesce(F.col(k).cast("string"), F.lit("")) != "")
    once = absorb(rows.filter(whole), keys, order).unionByName(rows.filter(~whole))
    return absorb(once.filter(F.coalesce(F.col("id"), F.lit("")) != ""), ["id"], order)


def heal(items: DataFrame, origins: dict[str, str] | None = None) -> DataFrame:
    """Stored rows with today's canonical urls, new ids where the url changed, and duplicates folded."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    new = canonical_url(F.col("url"), F.col("source"), origins=origins)
    moved = items.withColumn("__new", new).withColumn("__moved", (F.col("__new") != "") & ~F.col("__new").eqNullSafe(F.col("url")))
    moved = moved.withColumn("id", F.when(F.col("__moved"), make_id(text("category"), text("source"), text("title"), F.col("__new"))).otherwise(F.col("id")))
    return dedupe(moved.withColumn("url", F.when(F.col("__moved"), F.col("__new")).otherwise(F.col("url"))).drop("__new", "__moved"))


def valid_raws(raws: DataFrame, origins: dict[str, str] | None = None) -> DataFrame:
    """Fetched entries that make a record, with title, canonical url and id."""
    url = canonical_url(F.col("url"), F.col("source"), F.col("feed_url"), origins)
    rows = raws.withColumn("title", strip(F.coalesce(F.col("title"), F.lit("")))).withColumn("url", url)
    rows = rows.filter((F.col("title") != "") & scheme(F.col("url")).isin("http", "https") & (host_of(F.col("url")) != ""))
    return rows.withColumn("id", make_id(F.col("category"), F.col("source"), F.col("title"), F.col("url")))


def ingest(archive: DataFrame, raws: DataFrame, now: Column, origins: dict[str, str] | None = None) -> DataFrame:
    """The archive with fetched entries folded in.

    Of entries with one id the last names category, source, title and url; the last known date wins, over the
    stored one too.  Entries without a stored summary bring the first feed copy that has text (an empty one
    says that the feed lists the entry) and the first pictures.  One pass of each side, one full outer join.
    """
    seen = valid_raws(raws, origins)
    last = lambda c: F.max_by(c, "ord").alias(f"n_{c}")
    when_known = F.when(F.col("published_at").isNotNull(), F.col("ord"))
    text_at = F.struct(F.coalesce(F.col("content"), F.lit("")) == "", F.col("ord"))
    fresh = seen.groupBy("id").agg(
        *[last(c) for c in ("category", "source", "title", "url")],
        F.max_by("published_at", when_known).alias("n_date"),
        F.min_by(F.coalesce("content", F.lit("")), text_at).alias("n_content"),
        F.min_by("images", F.when(F.size(F.coalesce("images", F.array().cast("array<string>"))) > 0, F.col("ord"))).alias("n_images"),
        F.min("ord").alias("n_ord"),
    )
    old = archive if "ord" in archive.columns else archive.withColumn("ord", F.lit(None).cast("long"))
    both = old.join(fresh.withColumn("listed", F.lit(True)), "id", "full_outer")
    listed, pending = F.col("listed").isNotNull(), F.coalesce(F.col("summary"), F.lit("")) == ""
    pick = {c: F.when(listed, F.col(f"n_{c}")).otherwise(F.col(c)) for c in ("category", "source", "title", "url")}
    return both.withColumns(
        pick
        | {
            "published_at": F.coalesce(iso(F.col("n_date")), F.col("published_at")),
            "last_seen_at": F.when(listed, iso(now)).otherwise(F.col("last_seen_at")),
            "feed_content": F.when(listed & pending, F.col("n_content")),
            "feed_images": F.when(listed & pending, F.col("n_images")),
            "ord": F.coalesce(F.col("ord"), F.lit(1 << 40) + F.col("n_ord")),
        }
    ).select("ord", *ITEM.names, "feed_content", "feed_images")


def seen_at(now: Column) -> Column:
    return F.coalesce(parse_date(F.col("last_seen_at")), parse_date(F.col("published_at")), now)


def retain(items: DataFrame, now: Column, days: int) -> DataFrame:
    """Rows seen within so many days (the limit included); what was never dated stays."""
    return items.filter(seen_at(now) >= now - F.make_dt_interval(F.lit(days)))


def archive_order(items: DataFrame) -> DataFrame:
    """Latest seen first, never seen last, else as they came."""
    return items.orderBy(parse_date(F.col("last_seen_at")).desc_nulls_last(), F.col("ord").asc())


def first_rows(rows: DataFrame, keys: list[str], order: str = "ord") -> DataFrame:
    """The first row of each key, by a combined minimum instead of a window."""
    cols = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.col(order)).alias("r")).select(*keys, "r.*").select(*rows.columns)


def pending(summary: Column, url: Column) -> Column:
    """Whether a record waits for a summary: a blank mark is one, so nothing is trimmed."""
    return (F.coalesce(url, F.lit("")) != "") & (F.coalesce(summary, F.lit("")) == "")


def top_by(rows: DataFrame, order: list[Column], n: int, none_means_all: bool = False) -> DataFrame:
    """The first n rows in an order; n of 0 or less is none, or all where that is the setting's meaning."""
    if n <= 0 and none_means_all:
        return rows.orderBy(*order)
    return rows.orderBy(*order).limit(max(n, 0))


def numbered(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= n).drop("__n")

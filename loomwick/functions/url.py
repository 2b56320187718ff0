"""Urls as columns: splitting, normal and canonical forms, hosts, video ids, stable record ids."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwick.functions.text import strip

#: Query keys dropped besides utm_*.
TRACKING = ["ref", "spm", "fbclid", "gclid", "igshid", "mkt_tok", "mc_cid", "mc_eid", "_hsenc", "_hsmi"]
#: Hosts with a second spelling.
HOST_ALIASES = {"open.firstory.me": "open.firstory.fm"}
#: Patterns of development origins, author pages, issues, videos and episodes.
DEV_ORIGIN = r"(?i)\A(?:localhost|127\.0\.0\.1|0\.0\.0\.0|\[::1\]|[^.]+\.local)(?::\d+)?\z"
AUTHOR_PAGE = r"\A(https?://(?:www\.)?vocus\.cc)/@[^/]*/([0-9A-Za-z]+)(.*)\z"
ISSUE = r"(?i)\Ahttps?://(?:www\.)?bestblogs\.dev(?:/[a-z]{2})?/newsletter/issue(\d{1,4})/?\z"
ISSUE_HOME = "https://www.bestblogs.dev/newsletter/issue"
VIDEO_ID = r"\A[A-Za-z0-9_-]{11}\z"
VIDEO_PATH = r"\A/(?:shorts|live|embed|v)/([^/?#]+)/?\z"
EPISODE = (
    r"(?i)\A(?:https?://(?:www\.)?xiaoyuzhoufm\.com/episode/[0-9a-f]{16,32}"
    r"|https?://open\.firstory\.(?:fm|me)/story/[0-9a-z]{16,40})"
)
AUDIO = r"(?i)\Ahttps?://[^?#]*\.(?:mp3|m4a|aac)(?:[?#].*)?\z"

#: scheme, "//" + authority, authority, path, "?" + query, query, "#" + fragment
PARTS = r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*):(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#.*)?\z"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, evaluated once: without it a value used in many places is written out, and computed, in each."""
    return F.get(F.transform(F.array(value), body), 0)


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def host_of(url: Column) -> Column:
    """Lower-case authority, with port and user; empty if there is none."""
    return F.lower(part(url, 3))


def path_of(url: Column) -> Column:
    return part(url, 4)


def query_of(url: Column) -> Column:
    return part(url, 6)


def _decode(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), F.translate(x, "+", " "))


def _encode(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def query_pairs(query: Column) -> Column:
    """Decoded key and value of each non-empty field; a field without = has an empty value."""
    fields = F.filter(F.split(query, "&"), lambda f: f != "")
    return F.transform(
        fields,
        lambda f: F.struct(
            _decode(F.regexp_extract(f, r"(?s)\A([^=]*)", 1)).alias("key"), _decode(F.regexp_extract(f, r"(?s)\A[^=]*=(.*)\z", 1)).alias("value")
        ),
    )


def first_value(query: Column, key: str) -> Column:
    return F.coalesce(F.try_element_at(F.filter(query_pairs(query), lambda p: (p["key"] == key) & (p["value"] != "")), F.lit(1))["value"], F.lit(""))


def is_tracking(key: Column) -> Column:
    low = F.lower(key)
    return F.startswith(low, F.lit("utm_")) | low.isin(TRACKING)


def normalize_url(raw: Column) -> Column:
    """Lower scheme and host, tracking keys and fragment dropped, query written anew, no slash at the end.

    A text without a scheme is only stripped; a null is the empty text.
    """
    return let(strip(F.coalesce(raw, F.lit(""))), lambda text: F.when(part(text, 1) == "", text).otherwise(_normal(text)))


def _normal(text: Column) -> Column:
    url = F.regexp_replace(text, r"[\t\r\n]", "")
    kept = F.filter(query_pairs(query_of(url)), lambda p: ~is_tracking(p["key"]))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["key"]), F.lit("="), _encode(p["value"]))), "&")
    front = F.concat(scheme(url), F.lit(":"), F.when(part(url, 2) != "", F.concat(F.lit("//"), host_of(url))).otherwise(""), path_of(url))
    return let(query, lambda q: F.rtrim(F.concat(front, F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")), F.lit("/")))


def host_in(url: Column, suffixes: Iterable[str] | Column) -> Column:
    """Whether the host is one of the suffixes or below one."""
    host = host_of(url)
    each = suffixes if isinstance(suffixes, Column) else F.array(*[F.lit(s) for s in suffixes]).cast("array<string>")
    return F.exists(each, lambda s: (host == s) | F.endswith(host, F.concat(F.lit("."), s)))


def host_suffixes(host: Column) -> Column:
    """The host and every domain above it: join keys for large suffix tables."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels) - k + 1), "."))


def youtube_video_id(url: Column) -> Column:
    """The 11-character id of a video url, else null."""

    def found(url: Column) -> Column:
        path, host = path_of(url), host_of(url)
        return (
            F.when(~host_in(url, ["youtube.com", "youtu.be"]), None)
            .when(host.isin("youtu.be", "www.youtu.be"), F.btrim(path, F.lit("/")))
            .when(F.rtrim(path, F.lit("/")) == "/watch", first_value(query_of(url), "v"))
            .otherwise(F.regexp_extract(path, VIDEO_PATH, 1))
        )

    return let(url, lambda u: let(found(u), lambda vid: F.when(vid.rlike(VIDEO_ID), vid)))


def is_youtube(url: Column) -> Column:
    return youtube_video_id(url).isNotNull()


def youtube_watch_url(url: Column) -> Column:
    """The plain address of a video; an error for any other url."""
    vid = youtube_video_id(url)
    return F.when(vid.isNotNull(), F.concat(F.lit("https://www.youtube.com/watch?v="), vid)).otherwise(
        F.raise_error(F.concat(F.lit("not a video url: "), F.coalesce(url, F.lit("null")))).cast("string")
    )


def is_episode(url: Column) -> Column:
    return F.coalesce(url, F.lit("")).rlike(EPISODE)


def is_audio_url(url: Column) -> Column:
    return F.coalesce(url, F.lit("")).rlike(AUDIO)


def canonical_url(raw: Column, source: Column | None = None, feed_url: Column | None = None, origins: dict[str, str] | None = None) -> Column:
    """One spelling for one page: normal form, then aliases, real origins, author pages, issues and videos, in this order.

    origins: a source's real origin, for feeds that publish links on a development host; else the feed's own
    origin serves.  Without either the link is left alone.
    """
    source = F.lit("") if source is None else F.coalesce(source, F.lit(""))
    feed = F.lit("") if feed_url is None else F.coalesce(feed_url, F.lit(""))
    table = F.create_map(*[F.lit(x) for kv in (origins or {}).items() for x in kv]) if origins else F.create_map().cast("map<string,string>")

    def unaliased(url: Column) -> Column:
        for old, new in HOST_ALIASES.items():
            url = F.when(host_of(url) == old, F.regexp_replace(url, r"\A([^:]*://)[^/?#]*", f"$1{new}")).otherwise(url)
        return url

    def moved(url: Column) -> Column:
        own = F.when(
            scheme(feed).isin("http", "https") & (part(feed, 3) != "") & ~part(feed, 3).rlike(DEV_ORIGIN), F.concat(scheme(feed), F.lit("://"), part(feed, 3))
        )
        origin = F.coalesce(F.try_element_at(table, F.lower(strip(source))), own)
        return F.rtrim(F.concat(F.rtrim(origin, F.lit("/")), F.regexp_replace(url, r"\A[^:]*://[^/?#]*", "")), F.lit("/"))

    def spelled(url: Column) -> Column:
        def video(vid: Column) -> Column:
            tail = F.when(F.rtrim(path_of(url), F.lit("/")) == "/watch", F.concat(F.lit("?v="), vid)).otherwise("")
            return F.when(vid.isNotNull(), F.concat(F.regexp_extract(url, r"\A([^?#]*)", 1), tail)).otherwise(url)

        return (
            F.when((host_of(url) != "") & host_of(url).rlike(DEV_ORIGIN), F.coalesce(moved(url), url))
            .when(url.rlike(AUTHOR_PAGE), F.regexp_replace(url, AUTHOR_PAGE, "$1/article/$2$3"))
            .when(url.rlike(ISSUE), F.concat(F.lit(ISSUE_HOME), F.regexp_extract(url, ISSUE, 1).try_cast("int").cast("string")))
            .otherwise(let(youtube_video_id(url), video))
        )

    return let(normalize_url(raw), lambda n: let(unaliased(n), spelled))


def make_id(category: Column, source: Column, title: Column, url: Column) -> Column:
    """The stable id of a record: sha1 of its category, source, title and url."""
    low = [F.lower(strip(F.coalesce(c, F.lit("")))) for c in (category, source, title)]
    return F.sha1(F.concat_ws("||", *low, normalize_url(url)).cast("binary"))


def valid_id(value: Column) -> Column:
    return F.coalesce(value.rlike(r"\A[0-9a-f]{40}\z"), F.lit(False))


def pause_key(url: Column, domains: Iterable[str]) -> Column:
    """The first listed domain that the host is in, else the host."""
    host = host_of(url)
    listed = F.array(*[F.lit(d) for d in domains]).cast("array<string>")
    return F.coalesce(F.try_element_at(F.filter(listed, lambda d: (host == d) | F.endswith(host, F.concat(F.lit("."), d))), F.lit(1)), host)


def comparable_path(url: Column) -> Column:
    """Lower-case path after the host, without query and end slashes, for comparing addresses of one text."""
    bare = F.rtrim(F.substring_index(F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"\Ahttps?://(?:www\.)?", ""), "?", 1), F.lit("/"))
    return F.when(F.contains(bare, F.lit("/")), F.regexp_replace(bare, r"(?s)\A[^/]*/", "")).otherwise(bare)


def origin(url: Column) -> Column:
    """Scheme, host and port (with defaults), without credentials."""
    bare = F.regexp_replace(host_of(url), r"\A.*@", "")
    port = F.regexp_extract(bare, r":(\d+)\z", 1).try_cast("int")
    return F.struct(
        scheme(url).alias("scheme"),
        F.regexp_replace(bare, r":\d*\z", "").alias("host"),
        F.coalesce(port, F.when(scheme(url) == "https", 443).otherwise(80)).alias("port"),
    )

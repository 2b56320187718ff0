"""Media pages and tool messages as columns: why a video fails, whether it can be had yet, where an episode's audio is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwick.functions import html as H
from loomwick.functions.dates import hms
from loomwick.functions.text import ascii_lower, unescape_common
from loomwick.functions.url import is_audio_url

#: A download tool's own words, anchored to its error lines, and states without a finished recording.
COOKIES_REJECTED = r"(?i)cookies (?:are|is) no longer valid|cookies? (?:have|has) (?:likely )?been rotated|sign in to confirm you(?:'|’)?re not a bot"
RESTRICTED = {
    "members only": r"(?m)^ERROR: \[youtube\] [\w-]+: (?:This video is available to this channel's members|Join this channel to get access to members-only content)",
    "not available in the runner's country": r"(?m)^ERROR: \[youtube\] [\w-]+: The uploader has not made this video available in your country",
}
NOT_YET = {"is_upcoming": "not yet premiered", "is_live": "still live"}
AUDIO_KEYS = ["og:audio", "og:audio:url", "og:audio:secure_url"]
MINUTES = r"(\d{1,4})\s*分钟"


def restricted(stderr: Column) -> Column:
    """Why a video is closed for good; null if it isn't."""
    return F.coalesce(*[F.when(F.coalesce(stderr, F.lit("")).rlike(p), F.lit(why)) for why, p in RESTRICTED.items()])


def cookies_rejected(stderr: Column) -> Column:
    return F.coalesce(stderr, F.lit("")).rlike(COOKIES_REJECTED)


def why_failed(stderr: Column, limit: int = 300) -> Column:
    """The error lines, else the last two, each cut to the limit."""
    rows = F.filter(F.transform(F.split(F.coalesce(stderr, F.lit("")), r"\r?\n"), F.trim), lambda x: x != "")
    errors = F.filter(rows, lambda x: F.startswith(x, F.lit("ERROR:")))
    last = F.slice(rows, F.greatest(F.lit(1), F.size(rows) - 1), F.lit(2))
    cut = lambda x: F.when(F.length(x) > limit, F.concat(F.substring(x, 1, limit), F.lit("..."))).otherwise(x)
    joined = F.array_join(F.transform(F.when(F.size(errors) > 0, errors).otherwise(last), cut), " / ")
    return F.when(joined != "", joined).otherwise("no output")


def not_yet(is_live: Column, live_status: Column) -> Column:
    """Why there is no recording yet, a running stream first; null if there is one."""
    status = F.when(F.coalesce(is_live, F.lit(False)), "is_live").otherwise(live_status)
    return F.coalesce(*[F.when(status == s, F.lit(why)) for s, why in NOT_YET.items()])


def probe_outcome(stderr: Column, is_live: Column, live_status: Column, failed: Column) -> Column:
    """struct(state, why): closed for good, stop (the account is refused), wait, failed, or ready."""
    say = lambda s, why: F.struct(F.lit(s).alias("state"), why.alias("why"))
    return (
        F.when(cookies_rejected(stderr), say("stop", F.lit("cookies rejected")))
        .when(restricted(stderr).isNotNull(), say("closed", restricted(stderr)))
        .when(failed, say("failed", why_failed(stderr)))
        .when(not_yet(is_live, live_status).isNotNull(), say("wait", not_yet(is_live, live_status)))
        .otherwise(say("ready", F.lit(None).cast("string")))
    )


def audio_in_page(page: Column) -> Column:
    """The page's audio: its meta tag, else the first audio address in the text, escaped slashes included; empty if none."""
    tagged = F.try_element_at(H.meta_values(page, AUDIO_KEYS), F.lit(1))
    plain = F.replace(F.replace(F.coalesce(page, F.lit("")), F.lit("\\u002F"), F.lit("/")), F.lit("\\/"), F.lit("/"))
    tokens = F.filter(F.split(plain, r"""[\s"'<>\\]+"""), lambda t: F.contains(ascii_lower(t), F.lit("http")))
    addresses = F.transform(tokens, lambda t: F.substring(t, F.instr(ascii_lower(t), "http"), F.length(t)))
    found = F.try_element_at(F.filter(addresses, is_audio_url), F.lit(1))
    return unescape_common(F.coalesce(F.when(tagged != "", tagged), found, F.lit("")))


def episodes_of_pages(pages: DataFrame) -> DataFrame:
    """url and eid of episode pages with their html to audio and seconds (0: unknown); pages without audio drop out.

    The length comes from the embedded object of the same episode, else from minutes in the page's text.
    """
    with_audio = pages.withColumn("audio", audio_in_page(F.col("html"))).filter("audio <> ''")
    objects = with_audio.select("url", "eid", "html").lateralJoin(H.JsonObjects(H.tag_text(F.col("html"), "script", "id", "__NEXT_DATA__").outer()))
    own = objects.filter(F.get_json_object("node", "$.eid") == F.col("eid")).withColumn("d", F.get_json_object("node", "$.duration").try_cast("double"))
    first = own.filter("d is not null").groupBy("url").agg(F.min_by("d", "pos").alias("d"))
    minutes = F.regexp_extract("html", MINUTES, 1).try_cast("double") * 60
    joined = with_audio.join(first, "url", "left")
    return joined.select("url", "eid", "audio", F.coalesce(F.when(F.col("d") > 0, F.col("d")), minutes, F.lit(0.0)).alias("seconds"))


def episodes_of_feeds(entries: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted id (sid) the first feed entry that names it: audio and seconds.

    entries: ord, feed, where_text (ids and links), audio, duration (text); wanted: sid, feed.
    """
    both = wanted.join(entries.filter(is_audio_url(F.col("audio"))), "feed").filter(F.contains(F.lower("where_text"), F.lower("sid")))
    first = both.groupBy("sid").agg(F.min_by(F.struct("audio", "duration"), "ord").alias("e"))
    return first.select("sid", "e.audio", hms(F.col("e.duration")).alias("seconds"))

"""The three jobs as plans over DataFrames: collect, media, summarize.  Effects come from providers.

Steps that several consumers read, or that a provider feeds, are written to the shared folder once, so that a
provider is asked once for each address and lineage stays short.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from loomwick.config import Config, Rules
from loomwick.functions import net, text, thumbs
from loomwick.functions.encoding import decode_body
from loomwick.functions.html import html_to_text, page_title, thumb_candidates
from loomwick.functions.url import pause_key
from loomwick.operators import merge, qc, routing, sequential, subtitles
from loomwick.providers import Fetcher, Transcriber, Translator
from loomwick.schemas import BLANK_SUMMARY, FALLBACK_MARK, ITEM
from loomwick.sources import feeds as feeds_


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the session's checkpoint folder and read again."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        return df.checkpoint() if spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() else df.persist()
    path = f"{root.rstrip('/')}/loomwick-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Run:
    """A run's clock and counts: stages are watched by observations, which cost no pass of their own."""

    def __init__(self, cfg: Config | None = None):
        self.cfg, self.began, self.watched = cfg or Config(), time.monotonic(), {}

    def watch(self, df: DataFrame, name: str, **figures: Column) -> DataFrame:
        """df, whose rows (and further aggregates) count under the name once an action has read it."""
        seen = Observation(name)
        self.watched[name] = seen
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in figures.items()])

    def metrics(self, wait: float = 5.0) -> dict[str, dict]:
        """The figures of every stage that an action has read; a stage without any by then is left out."""
        found: dict[str, dict] = {}
        for name, seen in self.watched.items():
            asking = threading.Thread(target=lambda n=name, s=seen: found.update({n: s.get}), daemon=True)
            asking.start()
            asking.join(wait)
        return dict(found)

    def timed_out(self, share: float = 1.0) -> bool:
        return bool(self.cfg.time_budget) and time.monotonic() - self.began >= share * self.cfg.time_budget


def answered(urls: DataFrame, fetcher: Fetcher, second: Fetcher | None = None) -> DataFrame:
    """Answers, where blocked ones are asked again by the second fetcher; what that gives then counts."""
    answers = written(fetcher.fetch(urls.select("url").distinct()), "answers")
    if second is None:
        return answers
    blocked = net.status_class(F.col("status")) == "blocked"
    again = written(second.fetch(answers.filter(blocked).select("url")), "answers")
    return answers.filter(~F.coalesce(blocked, F.lit(False))).unionByName(again.select(*answers.columns))


def fetch_feeds(feeds: DataFrame, fetcher: Fetcher, rules: Rules | None = None, second: Fetcher | None = None) -> tuple[DataFrame, DataFrame]:
    """(raws, failures): one request for each address, parsed once for each feed that names it.

    Channel pages are read for their feeds first.  failures: url, title and why.
    """
    rules = rules or Rules()
    if "youtube_page" in feeds.columns and feeds.filter("youtube_page").take(1):
        asked = answered(feeds.filter("youtube_page"), fetcher, second)
        feeds = written(feeds_.resolve_channels(feeds, asked.select("url", decode_body(F.col("content"), F.col("headers")).alias("html"))), "resolved")
    answers = answered(feeds, fetcher, second)
    good = answers.filter(net.status_class(F.col("status")) == "ok").select("url", decode_body(F.col("content"), F.col("headers")).alias("body"))
    bodies = written(feeds.join(good, "url"), "bodies")
    of = lambda kind: bodies.filter(F.col("parser") == kind)
    raws = feeds_.parse_rss(of("rss"), rules.hosts("feed_content_skip"))
    raws = raws.unionByName(feeds_.parse_preview(of("telegram"))).unionByName(feeds_.parse_jike(of("jike")))
    failed = feeds.join(good.select("url"), "url", "left_anti").select("url", "title").join(answers.select("url", "status", "error"), "url", "left")
    return raws, failed.select("url", "title", F.coalesce("error", F.concat(F.lit("status "), F.col("status")), F.lit("no answer")).alias("error"))


def collect(archive: DataFrame, feeds: DataFrame, fetcher: Fetcher, now: Column, cfg: Config | None = None, rules: Rules | None = None, more: DataFrame | None = None) -> DataFrame:
    """The archive after a run: healed, with all sources folded in, expired rows gone.  more: further raw rows."""
    cfg, rules = cfg or Config(), rules or Rules()
    raws, _ = fetch_feeds(feeds, fetcher, rules)
    if more is not None:
        raws = raws.unionByName(more.withColumn("ord", F.col("ord") + F.lit(1 << 38)))
    origins = rules.mapping("origin_fixups")
    out = merge.retain(merge.ingest(merge.heal(archive, origins), raws, now, origins), now, cfg.archive_days)
    return written(out, "archive")


def media(items: DataFrame, tracks: DataFrame, durations: DataFrame, transcriber: Transcriber, cfg: Config | None = None) -> DataFrame:
    """Pending media to WebVTT: id, vtt, origin (track or speech), reason.

    Items with a track take the best one; the others queue for speech recognition, newest first, under the
    budget, whose decisions depend on each other and run as one ordered fold over at most max_media rows.
    """
    cfg = cfg or Config()
    waiting = items.filter(merge.pending(F.col("summary"), F.col("url")))
    queue = merge.top_by(waiting, [F.col("published_at").desc_nulls_last(), F.col("ord").asc()], cfg.max_media)
    best = subtitles.choose_track(tracks, ["id"])
    chosen = queue.select("id").join(best, "id")
    rest = queue.join(best.select("id"), "id", "left_anti").join(durations, "id", "left")
    line = rest.agg(F.array_sort(F.collect_list(F.struct((-F.coalesce(F.unix_seconds(F.col("published_at").try_cast("timestamp")), F.lit(0))).alias("k"), "ord", "id", "url", F.coalesce("duration", F.lit(0.0)).alias("duration")))).alias("q"))
    decided = sequential.greedy_budget(F.transform("q", lambda x: x["duration"]), cfg.max_asr_total, cfg.max_asr_jobs, cfg.max_asr_duration)
    plan = line.select(F.explode(F.arrays_zip("q", decided.alias("d"))).alias("z")).select("z.q.id", "z.q.url", "z.d.accepted", "z.d.reason")
    plan = written(plan, "asr")
    heard = written(transcriber.transcribe(plan.filter("accepted").select("id", "url", F.lit("und").alias("orig"))), "heard")
    spoken = heard.select("id", F.nullif(subtitles.to_vtt(F.coalesce("segments", F.array().cast("array<struct<start:double,end:double,text:string>>"))), F.lit("")).alias("vtt"), F.lit("speech").alias("origin"), F.col("error").alias("reason"))
    none = F.lit(None).cast("string")
    return (
        chosen.select("id", none.alias("vtt"), F.lit("track").alias("origin"), F.col("lang").alias("reason"))
        .unionByName(spoken)
        .unionByName(plan.filter("not accepted").select("id", none.alias("vtt"), F.lit("refused").alias("origin"), "reason"))
    )


def staged(urls: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """The cheapest answer first: each stage sees only the addresses that no earlier one resolved.

    A stage maps urls to (url, body, status) rows.  Its answers are written before the next stage is planned, so no
    stage runs twice and none runs for rows that are done.
    """
    left, found = urls.select("url").distinct(), None
    for name, stage in stages:
        answers = written(stage(left).select("url", "body", "status", F.lit(name).alias("stage")), f"stage-{name}")
        done = answers.filter("body is not null or status = 'gone'")
        found = done if found is None else found.unionByName(done)
        left = left.join(done.select("url"), "url", "left_anti")
    rest = left.select("url", F.lit(None).cast("string").alias("body"), F.lit("failed").alias("status"), F.lit(None).cast("string").alias("stage"))
    return rest if found is None else found.unionByName(rest)


def page_stage(fetcher: Fetcher, least: int = 200) -> Callable[[DataFrame], DataFrame]:
    def stage(urls: DataFrame) -> DataFrame:
        got = fetcher.fetch(urls).withColumn("page", decode_body(F.col("content"), F.col("headers")))
        body = text.classify_body(html_to_text(F.col("page")), page_title(F.col("page")), least)
        kind = net.status_class(F.col("status"))
        return got.select("url", F.when(kind == "ok", body["text"]).alias("body"), kind.alias("status"))

    return stage


def through(stage: Callable[[DataFrame], DataFrame], address: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """A stage that asks another address for each url: a reader or an archive that holds the page."""

    def asked(urls: DataFrame) -> DataFrame:
        both = urls.select("url", address(F.col("url")).alias("other"))
        got = stage(both.select(F.col("other").alias("url")).distinct()).withColumnRenamed("url", "other")
        # an archive's "gone" says nothing of the page itself
        status = F.when((F.col("status") == "gone") & (F.col("other") != F.col("url")), "failed").otherwise(F.col("status"))
        return both.join(got, "other").select("url", "body", status.alias("status"))

    return asked


def paused_hosts(stage: Callable[[DataFrame], DataFrame], domains: tuple[str, ...] = ()) -> Callable[[DataFrame], DataFrame]:
    """A stage that asks one page of each host first: a host that blocks it is left alone, its other pages wait as blocked."""

    def asked(urls: DataFrame) -> DataFrame:
        keyed = urls.select("url", pause_key(F.col("url"), domains).alias("host"))
        first = keyed.groupBy("host").agg(F.min("url").alias("url"))
        probe = written(stage(first.select("url")).select("url", "body", "status"), "probes")
        closed = first.join(probe.filter("status = 'blocked'"), "url").select("host")
        rest = keyed.join(first.select("url"), "url", "left_anti")
        waiting = rest.join(closed, "host", "left_semi").select("url", F.lit(None).cast("string").alias("body"), F.lit("blocked").alias("status"))
        return probe.unionByName(stage(rest.join(closed, "host", "left_anti").select("url")).select("url", "body", "status")).unionByName(waiting)

    return asked


def article_ladder(fetcher: Fetcher, rules: Rules) -> list[tuple[str, Callable[[DataFrame], DataFrame]]]:
    """The ways to a page's text: the page, then what the sites table names as reader and as archive (prefixes of the address)."""
    stages = [("page", paused_hosts(page_stage(fetcher), rules.hosts("pause_domains")))]
    for name in ("reader", "archive"):
        for prefix in rules.hosts(name)[:1]:
            stages.append((name, through(page_stage(fetcher), lambda u, p=prefix: F.concat(F.lit(p), u))))
    return stages


def summarize(items: DataFrame, transcripts: DataFrame, fetcher: Fetcher, cfg: Config | None = None, rules: Rules | None = None) -> DataFrame:
    """Pending items to texts: routed, fetched once, settled, passed through the quality gate.

    items carry ord and the scratch columns; transcripts: id, text.
    """
    cfg, rules = cfg or Config(), rules or Rules()
    waiting = items.filter(merge.pending(F.col("summary"), F.col("url"))).join(transcripts.withColumnRenamed("text", "transcript"), "id", "left")
    way = routing.route(
        F.col("url"), F.col("title"), F.col("feed_content"), F.col("feed_images"), F.col("transcript").isNotNull(),
        rules.hosts("skip_hosts"), rules.hosts("feed_first_hosts"),
    )
    routed = written(waiting.withColumn("route", way), "routed")
    fetchable = routing.capped(routed.filter("route = 'fetch'"), cfg.max_items, "ord").select("id", "url")
    pages = staged(fetchable, article_ladder(fetcher, rules))
    texts = routed.join(fetchable.join(pages, "url").select("id", "body", F.col("status").alias("fetch_status")), "id", "left")
    offline = F.when(F.col("route") == "douban", text.note_of_mark(F.col("feed_content"))).when(F.col("route") == "feed", F.col("feed_content")).otherwise(F.col("transcript"))
    built = F.when(F.col("route") == "fetch", F.coalesce("body", F.when(~text.blank(F.col("feed_content")), F.concat("feed_content", F.lit(FALLBACK_MARK)))))
    settled = routing.settle(texts.withColumn("built", F.coalesce(built, F.when(F.col("route") != "fetch", F.coalesce(offline, F.lit(""))))), "fetch_status")
    new = written(settled.select("ord", *ITEM.names).filter("summary is not null"), "new")
    gated = qc.gate(new.filter(~text.blank(F.col("summary"))), items.filter(~text.blank(F.col("summary"))).select("ord", *ITEM.names))
    fresh = gated.select("id", F.col("summary").alias("fresh")).unionByName(new.filter(text.blank(F.col("summary"))).select("id", F.col("summary").alias("fresh")))
    return items.join(fresh, "id", "left").withColumn("summary", F.coalesce("fresh", "summary")).drop("fresh")


def backfill(items: DataFrame, translator: Translator | None = None, cfg: Config | None = None, rules: Rules | None = None, rules_changed: bool = True) -> DataFrame:
    """Stored rows under today's rules: quality fixes, pictures cleaned or dropped, boilerplate cut, translations filled in."""
    cfg, rules = cfg or Config(), rules or Rules()
    if rules_changed:
        items = qc.apply(items).drop("finding", "action")
        clean = thumbs.thumb_clean(F.col("thumbnail"))
        ok = thumbs.thumb_still_valid(clean, F.coalesce("url", F.lit("")), rules.hosts("thumb_skip_hosts"))["ok"]
        items = items.withColumn("thumbnail", F.when(F.col("thumbnail").isNotNull() & ok, clean))
        if rules.boilerplate:
            cut = text.strip(F.regexp_replace("summary", "|".join(f"(?:{b})" for b in rules.boilerplate), ""))
            items = items.withColumn("summary", F.when(text.blank(F.col("summary")), F.col("summary")).when(cut == "", BLANK_SUMMARY).otherwise(cut))
    if translator is None or not cfg.translate:
        return items
    foreign = items.filter(~text.blank(F.col("summary")) & ~F.col("summary").rlike(r"[\x{4e00}-\x{9fff}]")).select("id", F.col("summary").alias("text"), "ord")
    foreign = merge.top_by(foreign, [F.col("ord").asc()], cfg.backfill_limit, none_means_all=True)
    done = translator.translate(foreign.select("id", "text")).select("id", F.col("text").alias("translated"))
    return items.join(done, "id", "left").withColumn("summary", F.coalesce("translated", "summary")).drop("translated")


def pages_to_thumbnails(items: DataFrame, pages: DataFrame, skip_hosts: tuple[str, ...] = ()) -> DataFrame:
    """id and thumbnail of items from their pages (url, html)."""
    found = items.select("id", "url").join(pages, "url")
    return found.select("id", thumbs.thumb_pick(thumb_candidates(F.col("html"), F.col("url")), F.col("url"), skip_hosts).alias("thumbnail"))

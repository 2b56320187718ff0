"""Subtitle tracks and cues: choosing, pruning, writing, reading text out of rolling captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwick.functions.dates import cue_time
from loomwick.functions.lang import NO_LANGUAGE, file_rank, norm, track_rank
from loomwick.functions.text import one_space, unescape_common


def choose_track(tracks: DataFrame, keys: list[str], orig: str = "orig") -> DataFrame:
    """The best track of each key: rows of (keys, lang, manual, orig) to one row with manual and lang.

    Ranks decide, then manual before automatic, then the code; chat replays are no tracks.
    """
    real = tracks.filter(~norm(F.col("lang")).isin(NO_LANGUAGE))
    rank = F.struct(track_rank(F.col("lang"), F.col(orig), F.col("manual")), ~F.col("manual"), F.col("lang"))
    return real.groupBy(*keys).agg(F.min_by(F.struct("manual", "lang"), rank).alias("best")).select(*keys, "best.*")


def tracks_of_maps(items: DataFrame, manual: str, auto: str) -> DataFrame:
    """Track maps to rows: the keys of both maps."""
    rest = [c for c in items.columns if c not in (manual, auto)]
    rows = [items.select(*rest, F.explode(F.map_keys(c)).alias("lang"), F.lit(is_manual).alias("manual")) for c, is_manual in ((manual, True), (auto, False))]
    return rows[0].unionByName(rows[1])


def name_parts(name: Column) -> Column:
    """struct(item_id, orig, sub) of {id}.{orig}.{sub}.vtt; null for other names."""
    p = F.split(name, r"\.")
    fine = (F.size(p) == 4) & F.element_at(p, 1).rlike(r"\A[0-9a-f]{40}\z") & (F.element_at(p, -1) == "vtt")
    get = lambda k: F.try_element_at(p, F.lit(k))
    return F.when(fine, F.struct(get(1).alias("item_id"), get(2).alias("orig"), get(3).alias("sub")))


def ranked_files(files: DataFrame) -> DataFrame:
    """Subtitle files (column name) with their parts and rank."""
    parts = files.withColumn("p", name_parts(F.col("name"))).filter("p is not null")
    return parts.select("p.*", "name", file_rank(F.col("p.sub"), F.col("p.orig")).alias("rank"))


def pick_subtitle(files: DataFrame) -> DataFrame:
    """item_id and the best file name of each item."""
    return ranked_files(files).groupBy("item_id").agg(F.min_by("name", F.struct("rank", "name")).alias("name"))


def surplus_files(files: DataFrame) -> DataFrame:
    """Names to delete so that each item keeps its best file; items without a valid file keep all."""
    owned = files.withColumn("item_id", F.substring_index("name", ".", 1))
    best = pick_subtitle(files).withColumnRenamed("name", "best")
    return owned.join(best, "item_id").filter("name <> best").select("name")


def orphan_files(files: DataFrame, items: DataFrame) -> DataFrame:
    """Names whose item is gone; none at all when there are no items, which would point to a failed load."""
    owned = files.withColumn("id", F.substring_index("name", ".", 1)).join(items.select("id"), "id", "left_anti").select("name")
    return owned if items.take(1) else owned.filter("false")


def without_transcript(items: DataFrame, files: DataFrame) -> DataFrame:
    return items.join(pick_subtitle(files).withColumnRenamed("item_id", "id").select("id"), "id", "left_anti")


def clamp_cues(segments: Column) -> Column:
    """Ordered array of struct(start, end, text) to cues that never overlap: a fold, as each start depends on the end before.

    Blank texts go; an end not after its start becomes half a second later; a text equal to the one before extends it.
    """
    cue = "struct<start:double,end:double,text:string>"
    zero = F.struct(F.array().cast(f"array<{cue}>").alias("cues"), F.lit(0.0).alias("prev"))

    def step(acc: Column, s: Column) -> Column:
        text = one_space(F.coalesce(s["text"], F.lit("")))
        start = F.greatest(s["start"].cast("double"), F.lit(0.0), acc["prev"])
        end = F.when(s["end"].cast("double") > start, s["end"].cast("double")).otherwise(start + 0.5)
        last = F.try_element_at(acc["cues"], F.lit(-1))
        same = last["text"].eqNullSafe(text)
        front = F.when(same, F.slice(acc["cues"], 1, F.size(acc["cues"]) - 1)).otherwise(acc["cues"])
        new = F.struct(F.when(same, last["start"]).otherwise(start).alias("start"), end.alias("end"), text.alias("text"))
        moved = F.struct(F.concat(front, F.array(new)).alias("cues"), end.alias("prev"))
        return F.when(text == "", acc).otherwise(moved)

    return F.aggregate(segments, zero, step)["cues"]


def to_vtt(segments: Column) -> Column:
    """WebVTT text of clamped cues; empty if there are none."""
    cues = clamp_cues(segments)
    body = F.transform(cues, lambda c: F.concat(cue_time(c["start"]), F.lit(" --> "), cue_time(c["end"]), F.lit("\n"), c["text"], F.lit("\n")))
    return F.when(F.size(cues) > 0, F.concat(F.lit("WEBVTT\n\n"), F.array_join(body, "\n"))).otherwise("")


def payload_lines(payload: Column) -> Column:
    """Visible lines of a cue: inline tags and time stamps dropped, entities decoded, blank lines dropped."""
    plain = unescape_common(F.regexp_replace(payload, r"<[^<>\n]{0,200}>", ""))
    return F.filter(F.transform(F.split(plain, "\n"), one_space), lambda x: x != "")


def transcript(cues: DataFrame, key: str = "item_id") -> DataFrame:
    """The text of each item: lines in cue order, each once where the caption rolls or repeats."""
    lines = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("cue_no", payload_lines(F.col("payload")).alias("lines")))), lambda c: c["lines"]))
    once = F.filter(
        F.transform(F.sequence(F.lit(1), F.size("all")), lambda k: F.when((k == 1) | (F.get("all", k - 1) != F.get("all", k - 2)), F.get("all", k - 1))),
        lambda x: x.isNotNull(),
    )
    grouped = cues.groupBy(key).agg(lines.alias("all"))
    return grouped.select(key, F.when(F.size("all") > 0, F.array_join(once, "\n")).otherwise("").alias("text"))

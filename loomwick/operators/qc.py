"""Quality control of stored texts: promotion, damaged characters, loops, page leftovers, texts shared across titles.

Findings are struct(category, detail, action, fixed); the first category that applies decides.  Native checks
come as columns, so that a row goes to Python only for what no built-in can do.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loomwick.functions.encoding import diagnose
from loomwick.functions.text import blank, compact, keywords, share_key, snippet
from loomwick.functions.url import comparable_path, is_youtube, let
from loomwick.schemas import BLANK_SUMMARY, FALLBACK_MARK, GONE_PREFIX, GONE_SUMMARY
from loomwick.types import plain, struct

KIND = "struct<category:string,detail:string,action:string,fixed:string,excerpt:string>"
CATEGORIES = ["garbled", "loop", "scrape", "mismatch", "spam"]
#: Signals of promotion by kind, an auxiliary one, topics that need one kind only, and reporting voice.
PROMOTION = {
    "slot": r"KEBAYA\w*|tebak skor|slot gacor|situs (?:judi|slot|resmi|terpercaya)",
    "signup": r"member aktif|deposit\s*(?:minimal|Rp)|daftar sekarang|link alternatif|bonus new member",
    "agency": r"growth studio|full-stack growth|SEO, AEO|成長工作室",
    "topup": r"代儲|儲值\s*\d|首儲|註冊送|加入會員[領送]|招募會員|top[\s-]?up\s*\$?\d",
    "followers": r"刷粉|buy followers",
    "ghostwriting": r"代寫論文",
    "contact": r"加賴|加\s*LINE",
}
#: Every signal above holds one of these in lower case: plain searches that spare most texts the patterns.
STEMS = "kebaya tebak slot situs member deposit daftar alternatif bonus growth seo, 成長 代儲 儲值 首儲 註冊送 會員 top 刷粉 followers 代寫 加".split()
AUXILIARY = r"\bRp\s?\d"
TOPIC = r"\bjudi\b|togel|taruhan|bandar|casino|betting|sportsbook|博彩|娛樂城|百家樂|線上賭|老虎機|porn|onlyfans|escort|成人影片"
NEWS_VOICE = (
    r"表示|指出|據悉|報導|报道|記者|记者|警方|調查|调查|官員|官员|發言人|发言人"
    r"|\b(?:said|says|reported|according to|police|officials?|spokesperson|investigat\w+)\b"
)
KINDS, KINDS_IN_NEWS = 2, 3
#: Markup left in a text, and markup that is damning alone.
LEFTOVER = (
    r"</?(?:div|span|script|style|iframe|table|tr|td|img|meta|link|svg|path|button|"
    r"input|p|br|li|ul|ol|a|h[1-6]|section|article|nav|footer|header)\b[^>\n]{0,200}>|&nbsp;|&amp;|&lt;|&gt;|&#\d+;"
)
STRONG = (
    r"width=device-width|name=[\"']?viewport|OptanonWrapper|crossorigin=|"
    r"<meta\b|<script\b[^<>]{0,300}?\bsrc=|<link\b[^<>]{0,300}?\brel=|class=\"[\w\- :/\[\]]{20,}\""
)
#: Fixed value: paths that a template left unfilled.
BROKEN_URL = r"(?i)/(?:undefined|null|NaN|None)(?:/|$|\?)"
#: Our own small default rules for page chrome; sites add theirs.
CHROME = r"enable javascript|accept (?:all )?cookies|cookie policy|access denied|are you a robot|verify you are human|請啟用 ?javascript|页面不存在"
CODE = r"(?m)^\s*(?:def |class |import |#include|function\b|const |let |var |public |<\?php|SELECT )|[{};]\s*$"
RETITLED, KEEPER = 0.3, 0.2


def _no_finding() -> Column:
    return F.lit(None).cast(KIND)


def finding(category: str, detail: Column | str, action: Column | str, fixed: Column | None = None, excerpt: Column | None = None) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(category).alias("category"), lit(detail).alias("detail"), lit(action).alias("action"),
        (none if fixed is None else fixed).alias("fixed"), (none if excerpt is None else excerpt).alias("excerpt"),
    )


def around(text: Column, part: Column) -> Column:
    """The text where a part of it first stands."""
    return snippet(text, F.greatest(F.lit(0), F.instr(text, part) - 1))


def promotion_hits(text: Column, groups: dict[str, str] | None = None) -> Column:
    """For each kind of promotion its distinct signals, sorted, in lower case."""
    found = lambda p: F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(f"(?iU){p}"), F.lit(0)), F.lower)))
    return F.array(*[found(p) for p in (groups or PROMOTION).values()])


def check_spam(text: Column, title: Column, groups: dict[str, str] | None = None, topic: str = TOPIC, voice: str = NEWS_VOICE, aux: str = AUXILIARY) -> Column:
    both = F.concat_ws(" ", text, F.coalesce(title, F.lit("")))
    hits = promotion_hits(both, groups)
    extra = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(both, F.lit(f"(?iU){aux}"), F.lit(0)), F.lower)))

    def judged(x: Column) -> Column:
        own = F.size(F.filter(x["hits"], lambda h: F.size(h) > 0))
        kinds = own + F.when(F.size(x["extra"]) > 0, 1).otherwise(0)
        spam = (own > 0) & F.when(x["news"], kinds >= KINDS_IN_NEWS).otherwise((kinds >= KINDS) | x["topic"])
        signals = F.concat(F.flatten(x["hits"]), x["extra"])
        detail = F.concat(F.lit("promotion: "), F.substring(F.array_join(signals, ", "), 1, 60))
        shown = around(F.lower(both), F.try_element_at(signals, F.lit(1)))
        return F.when(spam, finding("spam", detail, "blank", excerpt=shown)).otherwise(_no_finding())

    # bound once: the rule reads them in many places
    seen = F.struct(hits.alias("hits"), extra.alias("extra"), both.rlike(f"(?iU){voice}").alias("news"), both.rlike(f"(?iU){topic}").alias("topic"))
    found = let(seen, judged)
    if groups is None:
        low, stem = F.lower(both), F.lit(False)
        for s in STEMS:
            stem = stem | F.contains(low, F.lit(s))
        found = F.when(stem, F.when(both.rlike("(?iU)" + "|".join(PROMOTION.values())), found)).otherwise(_no_finding())
    return found


@pandas_udf(struct("unit string, fixed string"))
def find_loop(texts: pd.Series) -> pd.DataFrame:
    """The unit of the longest loop and the text with loops collapsed to one round; nulls if there is none.

    A loop of period p repeats p characters ten times or more, so the text equals itself shifted by p over at
    least 9p characters.  Samples every 3p characters find such stretches: three in a row must be equal.  The cost
    is linear in the text, where a back reference would be superlinear.
    """
    import numpy as np

    def stretch(text, at, period):
        lo = hi = at
        while lo > 0 and text[lo - 1] == text[lo - 1 + period]:
            lo -= 1
        while hi + period < len(text) and text[hi] == text[hi + period]:
            hi += 1
        return lo, hi

    def one(text):
        if text is None or len(text) < 10:
            return None, None
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        taken, loops = np.zeros(len(code), bool), []
        for period in range(1, min(40, len(code) // 10) + 1):
            at = np.arange(0, len(code) - period, 3 * period)
            same = code[at] == code[at + period]
            same = same[:-2] & same[1:-1] & same[2:]
            if not same.any():
                continue
            first, seen = at[:-2][same], 0
            for k in first[~taken[first]].tolist():  # what touches a loop already found is none of its own
                if k < seen:
                    continue
                a, b = stretch(text, k, period)
                seen = b
                rounds = (b - a) // period + 1
                if rounds >= 10 and not taken[a : b + period].any() and text[a : a + period].strip():
                    taken[a : b + period] = True
                    loops.append((a, a + rounds * period, period))
        if not loops:
            return None, None
        a, b, period = max(loops, key=lambda x: (x[1] - x[0], -x[0]))
        out, at = [], 0
        for lo, hi, p in sorted(loops):
            out.append(text[at : lo + p])
            at = hi
        return text[a : a + period], "".join([*out, text[at:]])

    return pd.DataFrame([one(t) for t in texts], columns=["unit", "fixed"])


#: Marked as not deterministic so that a filter on findings isn't pushed below and evaluated twice.
_loop, _diagnose = find_loop.asNondeterministic(), diagnose.asNondeterministic()


def check_garbled(text: Column) -> Column:
    found = _diagnose(text)
    return F.when(found["what"].isNotNull(), finding("garbled", found["what"], F.when(found["fixed"].isNotNull(), "repair").otherwise("refetch"), found["fixed"], snippet(text, found["at"]))).otherwise(
        _no_finding()
    )


def check_loop(text: Column) -> Column:
    found = _loop(F.when(F.length(text) >= 10, text))
    fixed = found["fixed"]
    mostly = (F.length(F.trim(fixed)) < 30) | (F.length(fixed) < 0.4 * F.length(text))
    detail = F.concat(F.lit('"'), F.substring(F.trim(found["unit"]), 1, 20), F.lit('" repeated'))
    return (
        F.when(fixed.isNull(), _no_finding())
        .when(mostly, finding("loop", F.concat(detail, F.lit(", mostly loop")), "refetch", excerpt=around(text, found["unit"])))
        .otherwise(finding("loop", detail, "repair", fixed, around(text, found["unit"])))
    )


def strip_markup(text: Column) -> Column:
    """Tags and common entities to spaces, lines collapsed, empty lines dropped."""
    plain = F.regexp_replace(F.regexp_replace(text, r"<[^>]{0,300}>", " "), r"&(?:nbsp|amp|lt|gt|#\d+);", " ")
    lines = F.transform(F.split(plain, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, r"[ \t\r\f\x0B]+", " "), r"(?U)\A\s+|\s+\z", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def check_scrape(text: Column, chrome: str = CHROME) -> Column:
    n_chrome = F.when(text.rlike(f"(?i){chrome}"), F.regexp_count(text, F.lit(f"(?i){chrome}"))).otherwise(0)
    n_tags, strong = F.regexp_count(text, F.lit(f"(?i){LEFTOVER}")), text.rlike(f"(?i){STRONG}")
    size = F.length(text)
    only_chrome = (n_chrome > 0) & ((size < 800) | (n_chrome >= 3))
    # without any of these characters no pattern of markup can match
    marked_up = F.contains(text, F.lit("<")) | F.contains(text, F.lit("&")) | F.contains(text, F.lit("=")) | F.contains(text, F.lit("OptanonWrapper"))
    leftover = marked_up & (strong | (n_tags >= 5) | ((n_tags > 0) & (size < 300))) & ~text.rlike(CODE)
    ended = F.regexp_replace(text, r"(?U)\s+\z", "")
    marked = F.endswith(ended, F.lit(FALLBACK_MARK))
    body = F.when(marked, F.regexp_replace(ended, rf"(?U)\s*{FALLBACK_MARK}\z", "")).otherwise(ended)

    def stripped(x: Column) -> Column:
        clean, shown = x["clean"], around(text, F.regexp_extract(text, f"(?i){LEFTOVER}|{STRONG}", 0))
        good = (F.length(clean) >= 80) & (F.length(clean) >= 0.6 * x["size"]) & ~clean.rlike(f"(?i){STRONG}")
        fixed = F.concat(clean, F.when(x["marked"], f" {FALLBACK_MARK}").otherwise(""))
        return F.when(good, finding("scrape", "leftover HTML, tags stripped", "repair", fixed, shown)).otherwise(finding("scrape", "leftover HTML", "refetch", excerpt=shown))

    cleaned = let(F.struct(strip_markup(body).alias("clean"), F.length(body).alias("size"), marked.alias("marked")), stripped)
    first = F.regexp_extract(text, f"(?i){chrome}", 0)
    only = finding("scrape", F.concat(F.lit('site chrome only: "'), first, F.lit('"')), "refetch", excerpt=around(text, first))
    return F.when(only_chrome, only).when(leftover, cleaned).otherwise(_no_finding())


def inspect(items: DataFrame, text: str = "summary", title: str = "title") -> DataFrame:
    """items with the column finding: spam, then garbled, loop, scrape.

    The native checks run first as one projection; texts that spam decides reach Python as null.
    """
    col = F.when(~blank(F.col(text)) & (F.col(text) != GONE_SUMMARY), F.col(text))
    spam = items.withColumn("__spam", F.when(col.isNotNull(), check_spam(col, F.col(title))))
    rest = F.when(F.col("__spam").isNull(), col)
    found = spam.withColumns({"__garbled": check_garbled(rest), "__loop": check_loop(rest), "__scrape": F.when(rest.isNotNull(), check_scrape(rest))})
    return found.withColumn("finding", F.coalesce("__spam", "__garbled", "__loop", "__scrape")).drop("__spam", "__garbled", "__loop", "__scrape")


def overlap(a: Column, b: Column) -> Column:
    """Common elements over the size of the smaller set."""
    return F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))


@pandas_udf(plain("double"))
def path_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching characters by longest common blocks.  No built-in computes it."""
    from difflib import SequenceMatcher

    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


_ratio = path_ratio.asNondeterministic()


def shared_index(items: DataFrame, text: str = "summary") -> DataFrame:
    """Items with a real text of 60 characters or more without white space, and its key."""
    real = ~blank(F.col(text)) & ~F.startswith(F.col(text), F.lit(GONE_PREFIX))
    key = F.when(real, share_key(F.col(text)))
    return items.withColumn("share_key", key).filter(F.length("share_key") >= 60)


def check_shared(items: DataFrame, text: str = "summary", order: str = "ord") -> DataFrame:
    """id and finding of items whose text stands under titles that differ.

    Each item is compared with the first of its group, so the group is never collected: the first item and the
    group's figures come from aggregates and join back on the key.
    """
    title = F.coalesce(F.col("title"), F.lit(""))
    rows = shared_index(items, text).withColumns(
        {
            "t": keywords(title),
            "plain": F.substring(F.regexp_replace(F.lower(title), r"(?U)\W", ""), 1, 40),
            "path": comparable_path(F.col("url")),
            "broken": F.coalesce(F.col("url"), F.lit("")).rlike(BROKEN_URL),
            "about": keywords(F.substring(F.col(text), 1, 1500)),
        }
    )
    groups = rows.groupBy("share_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("plain").alias("titles"), F.bool_or("broken").alias("any_broken"),
        F.min_by(F.struct("t", "path", "about", order), F.col(order)).alias("first"),
    ).filter("n > 1 and titles > 1")
    here = F.col(order) == F.col(f"first.{order}")
    near_titles = (F.size("first.t") > 0) & (F.size("t") > 0) & (overlap(F.col("first.t"), F.col("t")) >= RETITLED)
    # paths that are equal need no comparison: those columns are null there
    differ = ~here & ~F.col("first.path").eqNullSafe(F.col("path"))
    both = rows.join(groups, "share_key").select(
        "id", order, "share_key", "broken", "any_broken", F.col("title").alias("shown"), (F.size("first.t") > 0).alias("titled"),
        (F.size(F.array_intersect("t", "first.about")) / F.greatest(F.lit(1), F.size("t"))).alias("score"),
        F.when(differ, _ratio(F.when(differ, F.col("first.path")), F.when(differ, F.col("path"))) >= 0.6).otherwise(True).alias("near"), (here | near_titles).alias("retitled"),
    )
    both = both.repartition("id")  # one exchange that both readers below share: paths are compared once, and a hot key is spread
    # of the best scores the highest, how many have it, and the first item that has it
    by_score = both.groupBy("share_key", "score").agg(
        F.count(F.lit(1)).alias("ties"), F.min(order).alias("best"), F.bool_and("near").alias("near"), F.bool_and(F.col("retitled") & F.col("titled")).alias("retitled"), F.min("shown").alias("shown")
    )
    verdict = by_score.groupBy("share_key").agg(
        F.bool_and("near").alias("all_near"), F.bool_and("retitled").alias("all_retitled"), F.max("score").alias("top"),
        F.max_by(F.struct("ties", "best"), "score").alias("b"), F.min("shown").alias("like"),
    )
    judged = both.join(verdict, "share_key").filter("any_broken or not (all_near or all_retitled)")
    keeper = (F.col(order) == F.col("b.best")) & (F.col("top") >= KEEPER) & (F.col("b.ties") == 1)
    why = F.when(F.col("broken"), "broken url").otherwise("title does not match")
    detail = F.concat(why, F.lit("; text shared with "), compact(F.col("like"), 40))
    return judged.filter(F.col("broken") | ~keeper).select("id", finding("mismatch", detail, "refetch").alias("finding"))


def settled(action: Column, category: Column, url: Column) -> Column:
    """A video is not fetched again but blanked, loops apart: its subtitle would give the same text."""
    return F.when((action == "refetch") & (category != "loop") & is_youtube(F.coalesce(url, F.lit(""))), "blank").otherwise(action)


def apply(items: DataFrame, text: str = "summary", order: str = "ord") -> DataFrame:
    """items with finding, action and the text after it: repaired, blanked, or null to be fetched again.

    Shared texts are judged on the texts as they came, before any repair.
    """
    shared = check_shared(items, text, order).withColumnRenamed("finding", "__shared")
    found = inspect(items, text).join(shared, "id", "left").withColumn("finding", F.coalesce("finding", "__shared")).drop("__shared")
    action = settled(F.col("finding.action"), F.col("finding.category"), F.col("url"))
    new = F.when(action == "repair", F.col("finding.fixed")).when(action == "blank", BLANK_SUMMARY).when(action == "refetch", None).otherwise(F.col(text))
    return found.withColumn("action", action).withColumn(text, new)


def gate(fresh: DataFrame, stored: DataFrame, text: str = "summary", order: str = "ord") -> DataFrame:
    """New texts as they may be written: repaired, or blanked where another fetch would give the same.

    A new text is compared with stored ones and with new ones that come before it in order.
    """
    cols = ["id", "title", "url", text, order]
    shift = F.col(order) + F.lit(1 << 41)
    pool = stored.select(*cols).join(fresh.select("id"), "id", "left_anti").unionByName(fresh.select(*[c for c in cols if c != order], shift.alias(order)).select(*cols))
    shared = check_shared(pool, text, order).withColumnRenamed("finding", "__shared")
    found = inspect(fresh, text).join(shared, "id", "left").withColumn("finding", F.coalesce("finding", "__shared")).drop("__shared")
    new = F.when(F.col("finding").isNull(), F.col(text)).when(F.col("finding.action") == "repair", F.col("finding.fixed")).otherwise(BLANK_SUMMARY)
    return found.withColumn(text, new)


def report(rows: DataFrame) -> DataFrame:
    """For each category the number of findings and at most five titles, in report order."""
    known = rows.filter("finding is not null").select("finding.category", "action", F.substring(F.coalesce("title", "url"), 1, 40).alias("title"))
    safe = known.withColumn("title", F.regexp_replace(F.replace(F.col("title"), F.lit("::"), F.lit(": :")), r"[\r\n]", " "))
    counts = safe.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    # five titles of each category by bounded sorts; a category may hold any number of rows
    tops = [safe.filter(F.col("category") == c).select("category", "title").distinct().orderBy("title").limit(5) for c in CATEGORIES]
    firsts = reduce(DataFrame.unionByName, tops).groupBy("category").agg(F.array_sort(F.collect_list("title")).alias("titles"))
    order = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("category"))
    return counts.join(firsts, "category").orderBy(order)


#: What to do about each category, for the report.
HINTS = {
    "garbled": "repaired where the bytes are known, else fetched again", "loop": "rounds cut to one", "scrape": "page furniture: extend the chrome rules",
    "mismatch": "one text under several titles: look at the feed", "spam": "promotion: text blanked",
}


def report_lines(rows: DataFrame) -> list[str]:
    """The report as text: a line for each category, then its titles as an annotation of one line.  rows: report()."""
    out = []
    for r in rows.collect():  # a row for each category
        out.append(f"{r['category']}: {r['n']} ({HINTS[r['category']]})")
        titles = "%0A".join(t.replace("%", "%25") for t in r["titles"])
        out.append(f"::warning title={r['category']} {r['n']}::{titles}")
    return out

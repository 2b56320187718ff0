"""Language codes of subtitle tracks as columns, and how tracks rank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Regions and codes that make a track Chinese; track names that are no language; ranks.
ZH_REGIONS = ["tw", "hk", "cn", "mo", "sg"]
ZH_BASE = ["zh", "zh-hant", "zh-hans", "zh-chs", "zh-cht"]
NO_LANGUAGE = ["live-chat", "rechat"]
MANUAL_RANKS = {"zh": 0, "orig": 1, "other": 2, "chained": 6}
AUTO_RANKS = {"orig": 3, "zh": 4, "other": 5, "chained": 6}
FILE_RANKS = {"zh": 0, "orig": 1, "other": 2, "chained": 3}
CODE = r"\A[A-Za-z]{2,3}(?:-[A-Za-z0-9]{1,8})*\z"


def norm(lang: Column) -> Column:
    return F.replace(F.lower(F.trim(F.coalesce(lang, F.lit("")))), F.lit("_"), F.lit("-"))


def safe_lang(code: Column, default: str = "und") -> Column:
    """The code if it looks like one, else the default."""
    code = F.trim(code)
    return F.when(code.rlike(CODE) & (F.length(code) <= 35), code).otherwise(F.lit(default))


def is_chained(lang: Column) -> Column:
    """A translation of an automatic track: a script code followed by something that is no region."""
    tail = F.regexp_extract(norm(lang), r"\Azh-han[ts]-(.*)\z", 1)
    return norm(lang).rlike(r"\Azh-han[ts]-") & ~tail.isin(ZH_REGIONS)


def is_zh(lang: Column) -> Column:
    parts = F.split(norm(lang), "-")
    regional = (F.element_at(parts, 1) == "zh") & F.element_at(parts, -1).isin(ZH_REGIONS)
    return ~is_chained(lang) & (norm(lang).isin(ZH_BASE) | regional)


def lang_class(lang: Column, orig: Column) -> Column:
    return (
        F.when(is_chained(lang), "chained")
        .when(is_zh(lang), "zh")
        .when((norm(lang) != "") & (norm(lang) == norm(orig)), "orig")
        .otherwise("other")
    )


def _rank(kind: Column, ranks: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[kind]


def track_rank(lang: Column, orig: Column, manual: Column) -> Column:
    kind = lang_class(lang, orig)
    return F.when(manual, _rank(kind, MANUAL_RANKS)).otherwise(_rank(kind, AUTO_RANKS))


def file_rank(lang: Column, orig: Column) -> Column:
    return _rank(lang_class(lang, orig), FILE_RANKS)

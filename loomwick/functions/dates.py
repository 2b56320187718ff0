"""Times as columns: ISO text, epoch and free-form dates, durations, cue time stamps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loomwick.functions.text import strip
from loomwick.types import plain

EPOCH = r"\A[0-9]{9,}(?:\.[0-9]+)?\z"
#: Patterns tried in order after ISO forms, once the weekday is gone; what has no zone is UTC.
PATTERNS = ["d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss", "d MMM yyyy", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd"]
ZONED = r"(?i)(?:z|[+-]\d{2}:?\d{2}|\b(?:utc|gmt))\z"
RELATIVE = r"(\d{1,3})\s*(分钟|小时|天)前"


def iso(ts: Column) -> Column:
    """UTC text ending in Z, with microseconds only where there are some."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(whole, F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def from_epoch(number: Column) -> Column:
    """Seconds, or milliseconds where the number is too large for seconds."""
    seconds = F.when(number > 1e10, number / 1000).otherwise(number)
    return F.timestamp_micros(F.round(seconds * 1_000_000).cast("long"))


def parse_date(text: Column) -> Column:
    """Epoch numbers and the common written forms; null for all else.  Session time zone: UTC."""
    s = strip(F.regexp_replace(text, r"\A\$D", ""))
    bare = F.regexp_replace(s, r"\A(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    tries = [bare.try_cast("timestamp"), *[F.try_to_timestamp(bare, F.lit(p)) for p in PATTERNS]]
    return F.when(s.rlike(EPOCH), from_epoch(s.try_cast("double"))).otherwise(F.coalesce(*tries))


@pandas_udf(plain("timestamp"))
def parse_free_form(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """What parse_date leaves null, read by dateutil; for the few rows that need it."""
    from dateutil import parser, tz

    def one(s):
        try:
            t = parser.parse(s)
        except (ValueError, OverflowError, TypeError):
            return None
        t = t.replace(tzinfo=tz.UTC) if t.tzinfo is None else t.astimezone(tz.UTC)
        return t.replace(tzinfo=None)

    for part in texts:
        yield pd.to_datetime(part.map(one, na_action="ignore"), errors="coerce")


def parse_any(text: Column) -> Column:
    """parse_date, and for what that leaves null the free forms: such rows alone carry their text to Python."""
    fast = parse_date(text)
    return F.coalesce(fast, parse_free_form(F.when(fast.isNull() & text.rlike(r"\d"), strip(text))))


def listing_date(fields: Column, now: Column) -> Column:
    """The first readable of several date fields (an array of strings), for pages in Chinese.

    Epochs and zoned texts as they are; "N minutes (hours, days) ago" from now; other texts need a year of
    four digits and are read as UTC+8.
    """

    def one(v: Column) -> Column:
        n = F.regexp_extract(v, RELATIVE, 1).try_cast("int")
        unit = F.regexp_extract(v, RELATIVE, 2)
        seconds = n * F.when(unit == "分钟", 60).when(unit == "小时", 3600).otherwise(86400)
        when = parse_date(v)
        shifted = F.when(strip(v).rlike(ZONED), when).otherwise(when - F.expr("interval 8 hours"))
        return (
            F.when(strip(v).rlike(EPOCH), when)
            .when(unit != "", F.timestamp_micros(F.unix_micros(now) - seconds.cast("long") * 1_000_000))
            .when(v.rlike(r"\d{4}"), shifted)
        )

    return F.try_element_at(F.filter(F.transform(fields, one), lambda t: t.isNotNull()), F.lit(1))


def month_day(text: Column, today: Column) -> Column:
    """A bare MM-DD: this year, or the year before if that is more than a day ahead; 29 February stays as it is."""
    guess = F.try_to_timestamp(F.concat(F.year(today).cast("string"), F.lit("-"), text), F.lit("yyyy-MM-dd")).cast("date")
    leap_day = (F.month(guess) == 2) & (F.dayofmonth(guess) == 29)
    return F.when((guess > F.date_add(today, 1)) & ~leap_day, F.add_months(guess, -12)).otherwise(guess)


def hms(text: Column) -> Column:
    """s, m:s or h:m:s to seconds; malformed, longer or negative texts to 0."""
    parts = F.split(strip(F.coalesce(text, F.lit(""))), ":")
    numbers = F.transform(parts, lambda p: p.try_cast("double"))
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc * 60 + x)
    return F.when((F.size(parts) <= 3) & ~F.exists(numbers, lambda x: x.isNull()), F.greatest(total, F.lit(0.0))).otherwise(0.0)


def cue_time(seconds: Column) -> Column:
    """HH:MM:SS.mmm; milliseconds rounded half to even, not below zero."""
    ms = F.bround(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", F.expr("1") * F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def dimension(text: Column) -> Column:
    """The leading one to six digits, else 0."""
    return F.coalesce(F.regexp_extract(F.coalesce(text, F.lit("")), r"\A\s*(\d{1,6})", 1).try_cast("int"), F.lit(0))

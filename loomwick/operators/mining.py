"""Repeated sentences and lines across sources: candidates for boilerplate rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHORTEST, LONGEST, TOP = 6, 120, 60


def sentences(items: DataFrame, text: str, pattern: str = r"(?<=[。！？!?])|\n|(?<=\.)\s+") -> DataFrame:
    cut = F.explode(F.split(F.coalesce(F.col(text), F.lit("")), pattern)).alias("raw")
    return items.select("source", cut).select("source", F.regexp_replace("raw", r"(?U)\A\s+|\s+\z", "").alias("sentence"))


def mine_boilerplate(items: DataFrame, least: int, text: str = "summary", ruled: str | None = None, pattern: str | None = None, top: int = TOP) -> DataFrame:
    """Sentences of 6 to 120 characters that occur ``least`` times or more: within one source, and across sources.

    Counts combine on the map side, so a sentence in most rows is one row a task in the shuffle; the reports
    are the top of each class.
    """
    rows = sentences(items, text, pattern) if pattern else sentences(items, text)
    rows = rows.filter(F.length("sentence").between(SHORTEST, LONGEST))
    if ruled:
        rows = rows.filter(~F.col("sentence").rlike(ruled))
    each = rows.groupBy("sentence", "source").agg(F.count(F.lit(1)).alias("n"))
    total = each.groupBy("sentence").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sources")).filter(F.col("n") >= least)
    found = total.withColumn("kind", F.when(F.col("sources") >= 2, "shared").otherwise("single"))
    order = [F.desc("n"), F.desc("sentence")]
    # a bounded top of each class first, so that only those few rows are numbered in one place
    tops = [found.filter(F.col("kind") == k).orderBy(*order).limit(top) for k in ("shared", "single")]
    return tops[0].unionByName(tops[1]).withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(*order)))


def most_common(rows: DataFrame, column: str, n: int = 5) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(n)

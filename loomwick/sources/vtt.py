"""WebVTT files as rows of cues, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.operators.subtitles import name_parts

TIMES = r"(?m)^((?:\d{2,}:)?\d{2}:\d{2}\.\d{3}) --> ((?:\d{2,}:)?\d{2}:\d{2}\.\d{3})(?:[ \t]+(\S.*))?$"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """name and text of each file; small files share tasks, as whole-text splits pack."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("text"))


def _seconds(t):
    p = F.split(t, ":")
    return F.aggregate(F.transform(p, lambda x: x.try_cast("double")), F.lit(0.0), lambda a, x: a * 60 + x)


def cues(files: DataFrame) -> DataFrame:
    """item_id, orig, sub, has_header and the cue fields.  A cue ends at an empty line; one of white space is text."""
    text = F.regexp_replace(F.regexp_replace(F.col("text"), "\r\n?", "\n"), "\\A\ufeff", "")
    blocks = files.select(name_parts(F.col("name")).alias("p"), F.regexp_extract(text, r"\A([^\n]*(?:\n[^\n]+)*)", 1).rlike(r"(?m)^Kind:").alias("has_header"), F.split(text, r"\n\n+").alias("b"))
    timed = blocks.select("p.*", "has_header", F.posexplode(F.filter("b", lambda x: x.rlike(TIMES))).alias("cue_no", "block"))
    return timed.select(
        "item_id", "orig", "sub", "has_header", "cue_no",
        _seconds(F.regexp_extract("block", TIMES, 1)).alias("start_s"), _seconds(F.regexp_extract("block", TIMES, 2)).alias("end_s"),
        F.nullif(F.regexp_extract("block", TIMES, 3), F.lit("")).alias("settings"),
        F.regexp_extract("block", r"(?s)-->[^\n]*\n(.*)\z", 1).alias("payload"),
    )


def read_cues(spark: SparkSession, path: str) -> DataFrame:
    return cues(read_files(spark, path))

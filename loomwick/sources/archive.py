"""The JSON archive, the inbox and the status file: reading with strict schemas, writing whole or not at all."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from loomwick.functions.dates import parse_date
from loomwick.functions.text import strip
from loomwick.functions.url import canonical_url, host_of, part, scheme
from loomwick.schemas import ITEM


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """ord and the item fields.  Missing file: empty.  A bare list is an archive too; members that are no objects are dropped.

    A file that can't be parsed is an error, so that it is never overwritten.
    """
    schema = T.StructType([T.StructField("ord", T.LongType()), *ITEM.fields])
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return archive_of(spark.read.text(path, wholetext=True), path)


def archive_of(files: DataFrame, name: str = "the file", value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """keep, ord and the item fields of whole JSON documents, which their first character tells apart."""
    text = files.select(*keep, strip(F.col(value)).alias("doc"))
    tree = F.try_parse_json("doc")
    broken = F.raise_error(F.lit(f"{name} is no archive"))
    listed = F.when(tree.isNull() & (F.col("doc") != ""), broken.cast("string")).when(F.startswith("doc", F.lit("[")), F.col("doc")).otherwise(F.get_json_object("doc", "$.items"))
    members = F.from_json(listed, "array<string>")
    rows = text.select(*keep, F.posexplode(members).alias("ord", "json")).filter(F.startswith(F.ltrim("json"), F.lit("{")))
    return rows.select(*keep, F.col("ord").cast("long").alias("ord"), F.from_json("json", ITEM).alias("r")).select(*keep, "ord", "r.*")


def archive_rows(items: DataFrame) -> DataFrame:
    """One JSON text for each item: allowed fields alone, missing ones left out, order kept in ord."""
    return items.select("ord", F.to_json(F.struct(*ITEM.names), {"ignoreNullFields": "true"}).alias("json"))


def write_archive(items: DataFrame, path: str, generated_at: str, rules_hash: str | None = None) -> int:
    """The single-file form, an item a line; written beside the target, then renamed.  Streams rows, never holds them all."""
    meta = {"generated_at": generated_at} | ({"rules_hash": rules_hash} if rules_hash else {})
    rows = archive_rows(items).orderBy("ord").select("json")
    n = 0

    def lines():
        nonlocal n
        for row in rows.toLocalIterator(prefetchPartitions=True):
            yield ("," if n else "") + "\n" + row["json"]
            n += 1

    def parts():
        yield json.dumps(meta, ensure_ascii=False, separators=(",", ":"))[:-1] + ',"items":['
        yield from lines()
        yield f'\n],"total_items":{n}}}\n'

    write_atomic(path, parts())
    return n


def write_atomic(path: str, parts) -> None:
    """All parts or the old file: temporary file, flush to disk, rename."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder, prefix=".part-")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.writelines(parts)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def read_inbox(spark: SparkSession, path: str, cutoff: Column, last: int = 500) -> DataFrame:
    """ord, url, added of the last entries that are valid, each url once; credentials and odd schemes are refused."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "ord long, url string, added timestamp")
    return inbox_of(spark.read.text(path, wholetext=True), cutoff, last)


def inbox_of(files: DataFrame, cutoff: Column, last: int = 500) -> DataFrame:
    """read_inbox of a document's text, in the column value."""
    kind = "struct<urls:array<struct<url:string,added:string>>>"
    doc = files.select(F.from_json("value", kind).alias("d"))
    listed = F.coalesce("d.urls", F.array().cast("array<struct<url:string,added:string>>"))
    tail = F.slice(listed, F.greatest(F.lit(1), F.size(listed) - last + 1), F.lit(last))
    rows = doc.select(F.posexplode(tail)).select(F.col("pos").cast("long").alias("ord"), strip(F.coalesce("col.url", F.lit(""))).alias("url"), parse_date(F.col("col.added")).alias("added"))
    fine = (
        (F.length("url") <= 2048) & scheme(F.col("url")).isin("http", "https") & (host_of(F.col("url")) != "")
        & ~F.contains(part(F.col("url"), 3), F.lit("@")) & F.col("added").isNotNull() & (F.col("added") >= cutoff)
    )
    good = rows.filter(fine)
    return good.groupBy("url").agg(F.min_by(F.struct("ord", "added"), F.col("ord")).alias("r")).select("r.ord", "url", "r.added")


def inbox_raws(inbox: DataFrame, archive: DataFrame, titles: DataFrame, category: str, source: str) -> DataFrame:
    """Inbox entries as raw rows: a known url keeps its stored title and source, others take the fetched title."""
    canonical = inbox.withColumn("canonical", canonical_url(F.col("url")))
    known = archive.groupBy("url").agg(F.max_by(F.struct("title", "source"), F.col("ord")).alias("known")).withColumnRenamed("url", "canonical")
    rows = canonical.join(known, "canonical", "left").join(titles.select("url", F.col("title").alias("fetched")), "url", "left")
    return rows.select(
        "ord", F.lit(category).alias("category"), F.coalesce("known.source", F.lit(source)).alias("source"),
        F.coalesce("known.title", "fetched", "url").alias("title"), "url", F.col("added").alias("published_at"), F.lit("").alias("feed_url"),
        F.lit("").alias("content"), F.array().cast("array<string>").alias("images"),
    )


def record_status(path: str, states: dict[str, str], now: str) -> bool:
    """Keeps each key's state with the time it was seen; writes only on a change or while a key is expired."""
    try:
        with open(path, encoding="utf-8") as f:
            stored = json.load(f)
    except (OSError, ValueError):
        stored = {}
    new = dict(stored)
    for key, state in states.items():
        if (stored.get(key) or {}).get("state") != state or state == "expired":
            new[key] = {"state": state, "checked_at": now}
    if new == stored:
        return False
    write_atomic(path, [json.dumps(new, ensure_ascii=False, indent=1) + "\n"])
    return True

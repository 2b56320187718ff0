"""Records as streams: idempotent upserts by batch, expiry, sessions and windows with late data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwick.operators import merge
from loomwick.types import struct


def upsert(stream: DataFrame, path: str, checkpoint: str, now: Callable[[], Column], days: int = 60, once: bool = True, every: str = "30 seconds"):
    """Folds each batch of raw rows into a table of versions under ``path``.

    A batch writes version ``batch_id`` from the one before, so a batch that runs again after a failure writes
    the same rows.  Late or corrected dates are a rule of the merge, not of a watermark.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        old = spark.read.parquet(f"{path}/v={batch_id - 1}") if batch_id else None
        if old is None:
            from loomwick.schemas import ITEM

            old = spark.createDataFrame([], ITEM).withColumn("ord", F.lit(None).cast("long"))
        out = merge.retain(merge.ingest(old, batch, now()), now(), days)
        out.drop("feed_content", "feed_images").write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    writer = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def first_seen(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Each key once, by state that a watermark bounds."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windows(events: DataFrame, time: str, delay: str, size: str, slide: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and sums of value in tumbling or sliding windows; rows later than the delay are dropped in streams."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    w = F.window(time, size, slide) if slide else F.window(time, size)
    out = timed.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")


def sessions(events: DataFrame, time: str, delay: str, gap: str, by: str) -> DataFrame:
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    out = timed.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def expiring_latest(events: DataFrame, key: str, time: str, days: int) -> DataFrame:
    """For each key the number of sightings and the last one; a key not seen for so many days leaves the state.

    events: key, time (timestamp).  Emits the state after each batch, and a row with expired = true at its end.
    """
    out = struct("key string, n long, last timestamp, expired boolean")
    state = struct("n long, last timestamp")

    def step(k: tuple, frames: Iterator[pd.DataFrame], group) -> Iterator[pd.DataFrame]:
        if group.hasTimedOut:
            n, last = group.get
            group.remove()
            yield pd.DataFrame({"key": [str(k[0])], "n": [n], "last": [last], "expired": [True]})
            return
        n, last = group.get if group.exists else (0, None)
        for f in frames:
            n += len(f)
            top = f[time].max()
            last = top if last is None or top > last else last
        group.update((n, last))
        group.setTimeoutTimestamp(int(last.timestamp() * 1000) + days * 86_400_000)
        yield pd.DataFrame({"key": [str(k[0])], "n": [n], "last": [last], "expired": [False]})

    timed = events.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias(time)).withWatermark(time, "0 seconds")
    return timed.groupBy("key").applyInPandasWithState(step, out, state, "update", "EventTimeTimeout")

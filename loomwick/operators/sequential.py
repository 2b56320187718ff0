"""Order-dependent rules: greedy budgets, pausing hosts, islands of equal neighbours, searching the last issue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def greedy_budget(
    durations: Column, budget: float, most: int = 0, longest: float = 0.0, enabled: bool = True, engine: bool = True, clock: float = 0.0, pace: float = 1.0
) -> Column:
    """Ordered durations to struct(accepted, reason, left) each: refused ones use nothing up, so no running sum will do.

    Checks in order: switched off, no engine, number of items, wall clock, own length (permanent), what is left.  0 means
    no limit.  The clock counts ``pace`` seconds of work for each second accepted; it is up once it has been reached.
    """
    kind = "struct<accepted:boolean,reason:string,left:double>"
    total = F.lit(float(budget) if budget else float("inf"))
    zero = F.struct(F.array().cast(f"array<{kind}>").alias("out"), total.alias("left"), F.lit(0).alias("count"), F.lit(0.0).alias("worked"))
    closed = F.when(F.lit(not enabled), "disabled").when(F.lit(not engine), "engine missing")

    def step(acc: Column, d: Column) -> Column:
        d = d.cast("double")
        full = (acc["count"] >= most) if most else F.lit(False)
        late = (acc["worked"] >= clock) if clock else F.lit(False)
        long = (d > longest) if longest else F.lit(False)
        reason = F.coalesce(closed, F.when(full, "count").when(late, "wall clock").when(long, "too long").when(d > acc["left"], "budget"))
        ok = reason.isNull()
        used = F.when(ok, F.greatest(d, F.lit(0.0))).otherwise(0.0)
        left = acc["left"] - used
        row = F.struct(ok.alias("accepted"), reason.alias("reason"), left.alias("left"))
        return F.struct(
            F.concat(acc["out"], F.array(row)).alias("out"), left.alias("left"), (acc["count"] + ok.cast("int")).alias("count"), (acc["worked"] + used * pace).alias("worked")
        )

    return F.aggregate(durations, zero, step)["out"]


def stop_now(refused_for_budget: Column, left: Column, least: float = 600.0) -> Column:
    """Whether a run should end: something was refused for budget, and what is left fits nothing."""
    return refused_for_budget & (left <= least)


def paused(rows: DataFrame, host: str, order: str, blocked: str) -> DataFrame:
    """rows with paused: an earlier row of the host was blocked."""
    before = Window.partitionBy(host).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("paused", F.coalesce(F.max(F.col(blocked)).over(before), F.lit(False)))


def until_streak(rows: DataFrame, key: str, order: str, failed: str, most: int = 4) -> DataFrame:
    """The rows of each key up to and with its first ``most`` failures in a row; what comes after waits for another run."""
    by = Window.partitionBy(key).orderBy(order)
    last = by.rowsBetween(1 - most, 0)
    bad = (F.sum(F.col(failed).cast("int")).over(last) == most) & (F.count(F.lit(1)).over(last) == most)
    marked = rows.withColumn("__streak", bad)
    over = F.max(F.col("__streak").cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    return marked.withColumn("__over", F.coalesce(over, F.lit(0))).filter("__over = 0").drop("__streak", "__over")


def in_batches(rows: DataFrame, order: str, do: Callable[[DataFrame], DataFrame], ok: Callable[[DataFrame], int], size: int = 25, most: int = 4) -> list[DataFrame]:
    """What do gives for one batch after another, until ``most`` batches in a row bring nothing good; rows: a capped queue."""
    queue = rows.withColumn("__b", F.floor((F.row_number().over(Window.orderBy(order)) - 1) / size))
    out, bad = [], 0
    for k in range((queue.agg(F.max("__b")).first()[0] or 0) + 1):
        done = do(queue.filter(F.col("__b") == k).drop("__b"))
        out.append(done)
        bad = 0 if ok(done) else bad + 1
        if bad >= most:
            break
    return out


def ladder(rungs: Column, last: Column) -> Column:
    """Ways to try in order: the one that worked last first, the others as they stand."""
    return F.when(F.array_contains(rungs, last), F.concat(F.array(last), F.array_remove(rungs, last))).otherwise(rungs)


def unknown(given: Column, known: Column) -> Column:
    """Names that are given and not known, each once, in order."""
    return F.array_except(given, known)


def merge_equal_neighbours(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Runs of equal values as one row: keys, value, first and last of the order, n."""
    by = Window.partitionBy(*keys).orderBy(order)
    new = ~F.col(value).eqNullSafe(F.lag(value).over(by)) | (F.row_number().over(by) == 1)
    island = rows.withColumn("__i", F.sum(new.cast("int")).over(by))
    return island.groupBy(*keys, "__i").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("__i")


def last_issue(exists: Callable[[int], bool], known: int = 0, most: int = 2000, misses: int = 3) -> int:
    """The number of the last issue: upward from a known one until ``misses`` gaps in a row, else by doubling and bisection."""
    if known:
        last, gap = known, 0
        while gap < misses and last + gap + 1 <= most:
            gap += 1
            if exists(last + gap):
                last, gap = last + gap, 0
        return last
    low, high = 0, 1
    while high <= most and exists(high):
        low, high = high, 2 * high
    high = min(high, most + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if exists(middle) else (low, middle)
    return low

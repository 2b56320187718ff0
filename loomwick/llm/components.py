"""Connected components of a link table, by contraction inside tasks and alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwick.llm.common import materialise, released, spread_join

MAX_ROUNDS = 60
#: Edges that a task contracts at once.
LOCAL_EDGES = 500_000


def unite(label, a, b) -> None:
    """Gives a[i] and b[i] the same label, the smallest of their components; label[i] <= i."""
    import numpy as np

    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


@released
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges u, v to an edge from each node to the smallest of its component, among so many edges at a time."""
    import numpy as np

    def stars(held):
        u, v = (np.concatenate(x) for x in zip(*held, strict=True))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        label = np.arange(len(nodes))
        unite(label, at[: len(u)], at[len(u) :])
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], ["u", "v"])

    held, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, LOCAL_EDGES):
            part = batch.slice(at, LOCAL_EDGES)
            if size + part.num_rows > LOCAL_EDGES:
                yield stars(held)
                held, size = [], 0
            held.append((part.column(0).to_numpy(), part.column(1).to_numpy()))
            size += part.num_rows
    if held:
        yield stars(held)


def _with_least(edges: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """edges with m, the least of u and its neighbours; and these (u, m) alone.  A centre of many edges is spread over tasks."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("n"))
    return spread_join(edges, least, ["u"], rows), least.select("u", "m")


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    led, _ = _with_least(both, 2 * rows)
    return led.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    # every edge already runs from its larger end u to its smaller end v
    led, least = _with_least(edges, rows)
    moved = led.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of the component) for every node but the roots; links: a, b (longs).

    Tasks first contract their own edges to stars, at most ``LOCAL_EDGES`` at a time; where one task holds all edges that
    is the answer.  Else rounds of both stars follow.  Each round is written to the shared folder, so lineage stays short
    and lost executors cost one round.  A round with no change in the set of edges (by count and hash sum) is the last.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "edges")
    tasks = -(-edges.count() // LOCAL_EDGES)
    edges = materialise(edges.coalesce(max(1, tasks)).mapInArrow(_contract, "u long, v long"), "edges")
    if tasks <= 1:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    state = lambda: tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = state()
    for _ in range(MAX_ROUNDS):
        edges = materialise(_small_star(_large_star(edges, before[0]), before[0]), "edges")
        now = state()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")

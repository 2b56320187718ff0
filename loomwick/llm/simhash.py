"""SimHash near-duplicates: all links within a Hamming radius, found in BK-trees.

Fingerprints are first reduced to distinct values.  Those that differ in at most ``RADIUS`` of 64 bits agree
in at least ``b - RADIUS`` of ``b`` blocks, so each value goes to one shard for each choice of that many
blocks, keyed by the blocks' bits: no link is lost.  A shard holds a BK-tree (children keyed by their distance
to the parent) in flat arrays; a query follows only edges within the radius of its distance to the node.
Trees are not broadcast: together they grow with the corpus, so the queries of a shard travel to its tree.

A shard hands on a star for each local component, never its pairs.  A key with more than ``HOT`` values is
not built at once: its values are dealt anew by finer keys (half of eight blocks), again without loss; a finer key
that still has more is cut into blocks of values, and a tree is built for each pair of blocks, so a task's trees are
bounded whatever a key holds.  Components of the stars then come from a distributed star algorithm.

Defined cases: a null or empty text has fingerprint zero and links like any other; repeated rows share a
fingerprint; a null ``doc_id`` is skipped when the smallest id is taken; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import materialise, released, spread_join, table
from loomwick.llm.components import components, unite

SHINGLE, SEED, RADIUS = 4, 42, 4
#: More distinct values than this under one key are dealt anew by finer keys.
HOT = 20_000
FINE_BLOCKS = 8
#: Pairs (query, node) looked at in one step.
SLICE = 400_000


def fingerprint(raw: bytes) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest as h

    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    k = min(SHINGLE, len(words))
    hashes = np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, starts[k:], strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    for batch in batches:
        fps = np.array([fingerprint(t or b"") for t in batch.column(2).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text) and fp (the 64 bits as a signed long) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))
    return cols.mapInArrow(_fingerprints, "doc_id long, th long, fp long")


def blocks_for(values: int) -> int:
    """Blocks to cut 64 bits into: more values need longer keys.  Any answer is exact."""
    return 6 if values < 1 << 27 else 7 if values < 1 << 33 else 8


def masks(blocks: int, radius: int = RADIUS) -> list[int]:
    """A mask (signed) for each choice of the blocks that a linked pair may agree in."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    out = [sum(c) for c in combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


class Forest:
    """BK-trees of many groups in flat arrays; values are distinct within a group."""

    def __init__(self, group, values):
        import numpy as np

        self.values = values
        n = len(values)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        self.root = np.repeat(first, np.diff(np.append(first, n)))
        parent, edge, current = np.full(n, -1, np.int64), np.zeros(n, np.int64), self.root.copy()
        left = np.flatnonzero(self.root != np.arange(n))
        while len(left):
            d = np.bitwise_count(values[left] ^ values[current[left]]).astype(np.int64)
            _, child, of = np.unique(current[left] * 128 + d, return_index=True, return_inverse=True)
            parent[left[child]], edge[left[child]] = current[left[child]], d[child]
            current[left] = left[child][of]
            left = left[current[left] != left]
        self.children = np.argsort(parent * 128 + edge, kind="stable")
        self.keys = (parent * 128 + edge)[self.children]

    def near(self, radius: int):
        """Arrays q, node of all pairs q > node within the radius, some at a time: only edges within the radius are followed."""
        import numpy as np

        queries = np.flatnonzero(np.bincount(self.root, minlength=len(self.values))[self.root] > 1)
        stack = [(queries[a : a + SLICE], self.root[queries[a : a + SLICE]]) for a in range(0, len(queries), SLICE)]
        while stack:
            q, node = stack.pop()
            d = np.bitwise_count(self.values[q] ^ self.values[node]).astype(np.int64)
            hit = (d <= radius) & (q > node)
            yield q[hit], node[hit]
            lo = np.searchsorted(self.keys, node * 128 + np.maximum(d - radius, 1))
            n_kids = np.searchsorted(self.keys, node * 128 + d + radius, side="right") - lo
            ends = np.cumsum(n_kids)
            total, at, a = int(ends[-1]) if len(ends) else 0, 0, 0
            while at < total:
                b = max(a + 1, int(np.searchsorted(ends, at + SLICE, side="right")))
                k = n_kids[a:b]
                inner = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)
                stack.append((np.repeat(q[a:b], k), self.children[np.repeat(lo[a:b], k) + inner]))
                at, a = int(ends[b - 1]), b

    def stars(self, radius: int):
        """The smallest index of each value's component, by links within the radius."""
        import numpy as np

        label = np.arange(len(self.values))
        for q, node in self.near(radius):
            unite(label, q, node)
        return label


def _stars(radius: int, hot: int | None):
    """Rows sorted by (t, key, fp) to star links (kind 0) and the values of hot keys (kind 1)."""

    def out(kind, a, b):
        import numpy as np

        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"]
        )

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def shard(t, key, fp):
            same = (t[1:] == t[:-1]) & (key[1:] == key[:-1])
            group = np.concatenate([[0], np.cumsum(~same)])
            size = np.bincount(group)[group]
            keep = size > 1
            if keep.any():
                values = fp[keep]
                label = Forest(group[keep], values).stars(radius)
                linked = label != np.arange(len(label))
                yield out(0, values[linked], values[label[linked]])

        held, passing = None, None  # rows whose key may go on; a hot key that is passed on
        for batch in batches:
            t, key, fp = (batch.column(k).to_numpy() for k in range(3))
            fp = fp.view(np.uint64)
            if passing is not None:
                same = (t == passing[0]) & (key == passing[1])
                yield out(1, fp[same], fp[same])
                t, key, fp = t[~same], key[~same], fp[~same]
                if not len(t):
                    continue
                passing = None
            if held is not None:
                t, key, fp = (np.concatenate(x) for x in zip(held, (t, key, fp), strict=True))
            last = int(np.flatnonzero((t == t[-1]) & (key == key[-1]))[0])
            if len(t) < SLICE // 4 and len(t) - last <= (hot or len(t)):
                held = (t, key, fp)
                continue
            if last:
                yield from shard(t[:last], key[:last], fp[:last])
            held = (t[last:], key[last:], fp[last:])
            if hot and len(held[0]) > hot:
                passing, rest = (held[0][0], held[1][0]), held[2]
                held = None
                yield out(1, rest, rest)
        if held is not None:
            yield from shard(*held)

    return run


def _dealt(values: DataFrame, blocks: int, radius: int) -> DataFrame:
    """t, key and fp: every value once for each choice of blocks."""
    picks = [F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks(blocks, radius))]
    return values.select(F.explode(F.array(*picks)).alias("x"), "fp").select(F.col("x.t").cast("long").alias("t"), "x.key", "fp")


def _links(values: DataFrame, blocks: int, radius: int, hot: int | None) -> DataFrame:
    return _dealt(values, blocks, radius).repartition("t", "key").sortWithinPartitions("t", "key", "fp").mapInArrow(_stars(radius, hot), "kind int, a long, b long")


def _fine_links(values: DataFrame, blocks: int, radius: int, limit: int) -> DataFrame:
    """Star links of values dealt by finer keys; a key of more than ``limit`` values is cut into blocks, and each pair of blocks is a shard."""
    dealt = materialise(_dealt(values, blocks, radius), "dealt")
    counts = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).withColumn("cut", F.ceil(F.col("n") / limit).cast("int"))
    sized = spread_join(dealt, counts, ["t", "key"], dealt.count())
    own = F.pmod(F.xxhash64("fp"), F.col("cut"))
    paired = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    shard = F.col("t") * (1 << 40) + F.least("own", "other") * (1 << 20) + F.greatest("own", "other")
    rows = paired.select(shard.alias("t"), "key", "fp").repartition("t", "key").sortWithinPartitions("t", "key", "fp")
    return rows.mapInArrow(_stars(radius, None), "kind int, a long, b long").select("a", "b").distinct()


def near_links(values: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Star links a, b whose components are those of all pairs of distinct fp within the radius."""
    values = values.select("fp")
    first = materialise(_links(values, max(blocks_for(values.count()), radius + 1), radius, hot).distinct(), "links")
    links, again = first.filter("kind = 0").select("a", "b"), first.filter("kind = 1").select(F.col("a").alias("fp")).distinct()
    if again.take(1):
        links = links.unionByName(_fine_links(again, max(FINE_BLOCKS, radius + 1), radius, hot)).distinct()
    return links


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, th, fp and component_id, the smallest doc_id that links lead to, of every row."""
    prints = materialise(fingerprints(docs), "fingerprints")
    values = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "values")
    roots = components(near_links(values, radius)).withColumnRenamed("node", "fp")
    placed = materialise(values.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = spread_join(placed.select("root", "fp", "copies"), least, ["root"], placed.count())
    return spread_join(prints, named.select("fp", F.col("copies").alias("n"), "component_id"), ["fp"], prints.count())


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_of().alias("fingerprint"), "component_id")

"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints of such texts differ in about 10 of 64 bits (standard deviation 3), too many for block keys.
So shards are keyed by MinHash bands: a pair of similarity 0.8 shares none of the ``BANDS`` bands with a
probability of 5 in a million, a pair of higher similarity with a lower one.  Within a shard BK-trees over the
fingerprints find the pairs that differ in at most ``RADIUS`` bits (5 standard deviations, about 4 for texts of a
few shingles: some in 100,000 of their pairs are further apart), and these are compared exactly, by their texts.

A shard first compares its members with one centre; that links most of a large group of near copies at the cost of a
star.  Shards whose members are still in different components are then searched whole: members in different components
are compared until they are linked, each pair in the first band that it shares.  A shard of many members, or of long
texts, is cut into blocks, and each pair of blocks is a task of its own, so that memory is bounded and no pair is lost.

Defined cases: a null text counts as empty; texts without words are copies of each other; a text of fewer than five
words has one shingle, all its words; words are those of ``simhash.fingerprint``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwick.llm.common import materialise, released, spread_join, whole_text
from loomwick.llm.components import components
from loomwick.llm.simhash import Forest

SHINGLE, SEED, LEAST_PERCENT = 5, 42, 80
BANDS, BAND_ROWS, RADIUS = 40, 6, 24
#: Shingles whose permutations are looked at in one step.
PART = 4096
#: Members, and shingles of them, that a block of a searched shard holds.
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 1 << 20
#: Members of shards that are searched at once.
SEARCH_MEMBERS = 4096
#: Pairs whose bands are looked at in one step.
STEP = 20_000


def shingles(raw: bytes):
    """The distinct hashes of the shingles of a text, ascending."""
    import numpy as np
    from xxhash import xxh64_intdigest as h

    words = raw.lower().split()
    if not words:
        return np.zeros(1, np.uint64)
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    k = min(SHINGLE, len(words))
    return np.unique(np.array([h(joined[a : b - 1], SEED) for a, b in zip(starts, starts[k:], strict=False)], np.uint64))


def similar(a, b) -> bool:
    """Whether two ascending sets of shingles have a similarity of LEAST_PERCENT or more."""
    import numpy as np

    if 100 * min(len(a), len(b)) < LEAST_PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= LEAST_PERCENT * (len(a) + len(b) - both)


def similar_to(a, others: list) -> list[bool]:
    """Whether each of the other sets is similar to a: all looked up at once."""
    import numpy as np

    sizes = np.array([len(b) for b in others])
    joined = np.concatenate(others)
    same = a[np.minimum(np.searchsorted(a, joined), len(a) - 1)] == joined
    both = np.add.reduceat(same, np.cumsum(sizes) - sizes, dtype=np.int64)
    return (100 * both >= LEAST_PERCENT * (len(a) + sizes - both)).tolist()


def simhash_of(hashes) -> int:
    import numpy as np

    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), PART):
        bits = np.unpackbits(hashes[at : at + PART].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def constants():
    import numpy as np

    rng = np.random.default_rng(SEED)
    draw = lambda n: rng.integers(0, 1 << 64, n, np.uint64)
    n = BANDS * BAND_ROWS
    return draw((n, 1)), draw((n, 1)) | np.uint64(1), draw((BANDS, BAND_ROWS)) | np.uint64(1), draw(BANDS)


def band_keys(hashes, fixed):
    """A key for each band: texts share it where the band's minima are the same shingles."""
    import numpy as np

    flip, times, mix, start = fixed
    least = np.full(len(flip), (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), PART):
        np.minimum(least, ((hashes[at : at + PART] ^ flip) * times).min(1), out=least)
    least ^= least >> np.uint64(31)
    key = (least.reshape(BANDS, BAND_ROWS) * mix).sum(1, dtype=np.uint64) + start
    return (key ^ (key >> np.uint64(29))).view(np.int64)


@released
def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    fixed = constants()
    for batch in batches:
        sets = [shingles(t or b"") for t in batch.column(2).to_pylist()]
        keys = np.concatenate([band_keys(s, fixed) for s in sets]) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([simhash_of(s) for s in sets], pa.int64()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys)),
                pa.array([keys[a : a + BANDS].tobytes() for a in range(0, len(keys), BANDS)], pa.binary()),
            ],
            ["doc_id", "th", "size", "fp", "keys", "packed"],
        )


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text), number of shingles, fingerprint and band keys (a list, and its bytes) of every row."""
    text = whole_text()
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("text"))
    return cols.mapInArrow(_prints, "doc_id long, th long, size long, fp long, keys array<long>, packed binary")


@released
def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known, left = None, None
    for batch in batches:
        keep = []
        for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
            if a != known:
                known, left = a, shingles(x.as_py())
            keep.append(similar(left, shingles(y.as_py())))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def compared(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs a, b of similar texts; held: th and text."""
    right = pairs.join(held.select(F.col("th").alias("b"), F.col("text").alias("y")), "b")
    both = right.join(held.select(F.col("th").alias("a"), F.col("text").alias("x")), "a").select("a", "b", "x", "y")
    return both.mapInArrow(_compared, "a long, b long")


def _possible(a: str, b: str):
    """Whether the members a and b (th, size, fp) may be similar."""
    small, large = F.least(f"{a}.size", f"{b}.size"), F.greatest(f"{a}.size", f"{b}.size")
    near = F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp"))) <= RADIUS
    return (100 * small >= LEAST_PERCENT * large) & near


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct a < b of rows with the columns c and m (members)."""
    found = rows.filter((F.col("c.th") != F.col("m.th")) & _possible("c", "m"))
    return found.select(F.least("c.th", "m.th").alias("a"), F.greatest("c.th", "m.th").alias("b")).distinct()


class Searched:
    """Members of some shards; finds links between members in different components."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.groups: list[int] = []

    def add(self, group: int, row: tuple) -> None:
        """row: block, other block, own block, band, th, root, size, fp, keys, text."""
        self.rows.append(row)
        self.groups.append(group)

    def _candidates(self):
        """Pairs of rows whose fingerprints, sizes, blocks, components and bands call for a comparison."""
        import numpy as np

        group = np.array(self.groups)
        column = lambda k: np.array([r[k] for r in self.rows], np.int64)
        left, right, own, band, root, size = (column(k) for k in (0, 1, 2, 3, 5, 6))
        fp = column(7).view(np.uint64)
        keys = np.frombuffer(b"".join(r[8] for r in self.rows), np.int64).reshape(len(self.rows), BANDS)
        order = np.lexsort((fp, group))
        new = np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (fp[order][1:] != fp[order][:-1])])
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(order)))
        node_of = np.empty(len(order), np.int64)
        node_of[order] = np.cumsum(new) - 1

        def members(q, node):
            """All rows with one value against all with the other."""
            n = many[node]
            a, b = np.repeat(q, n), np.repeat(first[node], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            n = many[a]
            x = np.repeat(first[a], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            return order[x], order[np.repeat(b, n)]

        def wanted(a, b):
            crossing = (left[a] == right[a]) | (own[a] != own[b])
            small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            keep = crossing & (root[a] != root[b]) & (100 * small >= LEAST_PERCENT * large)
            a, b = a[keep], b[keep]
            for at in range(0, len(a), STEP):
                x, y = a[at : at + STEP], b[at : at + STEP]
                shared = (keys[x] == keys[y]).argmax(1) == band[x]
                yield x[shared], y[shared]

        equal = np.flatnonzero(many > 1)
        if len(equal):  # different texts of one fingerprint
            a, b = members(equal, equal)
            yield from wanted(a[a < b], b[a < b])
        for q, node in Forest(group[order][first], fp[order][first]).near(RADIUS):
            for at in range(0, len(q), STEP):
                yield from wanted(*members(q[at : at + STEP], node[at : at + STEP]))

    def links(self) -> tuple[list[int], list[int]]:
        import numpy as np

        if len(self.rows) < 2:
            return [], []
        a, b, up, sets = [], [], {}, {}

        def top(x):
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        def words(k):
            th = self.rows[k][4]
            if th not in sets:
                sets[th] = shingles(self.rows[k][9] or b"")
            return sets[th]

        for one, other in self._candidates():
            order = np.argsort(one, kind="stable")
            one, other = one[order], other[order]
            edges = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])).tolist() if len(one) else []
            for lo, hi in zip(edges, [*edges[1:], len(one)], strict=False):
                k = int(one[lo])
                open_ = [j for j in other[lo:hi].tolist() if top(self.rows[j][5]) != top(self.rows[k][5])]
                if not open_:
                    continue
                for j, yes in zip(open_, similar_to(words(k), [words(j) for j in open_]), strict=True):
                    x, y = top(self.rows[j][5]), top(self.rows[k][5])
                    if yes and x != y:
                        up[max(x, y)] = min(x, y)
                        a.append(self.rows[k][4])
                        b.append(self.rows[j][4])
        return a, b


@released
def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: key and blocks, then what Searched.add takes."""

    def out(held: Searched):
        a, b = held.links()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    held, shard, group, weight = Searched(), None, -1, 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:3] != shard:
                if len(held.rows) >= SEARCH_MEMBERS or weight >= BLOCK_SHINGLES:
                    yield out(held)
                    held, weight = Searched(), 0
                shard, group = row[:3], group + 1
            held.add(group, row[1:])
            weight += row[7]
    yield out(held)


def searched(apart: DataFrame, shards: DataFrame, held: DataFrame, rows: int) -> DataFrame:
    """Links a, b of members in different components.

    apart: key, band, th, root, size, fp, keys; shards: key, n (members), weight (their shingles), one row each.
    """
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    sized = spread_join(apart, shards.select("key", "n", blocks.alias("blocks")), ["key"], rows)
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("th", F.lit("block")), F.col("blocks")).cast("int")).otherwise(0)
    dealt = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = dealt.select("key", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own", "band", "th", "root", "size", "fp", "keys")
    with_text = placed.join(held, "th").select("key", "left", "right", "own", "band", "th", "root", "size", "fp", "keys", "text")
    sorted_ = with_text.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "th")
    return sorted_.mapInArrow(_search, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, th and root (the th that names the component) of every row."""
    of = materialise(prints(docs), "prints")
    each = of.groupBy("th").agg(F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies"))
    each = materialise(each, "texts")
    dealt = each.select(F.posexplode("keys").alias("band", "key"), F.struct("th", "size", "fp").alias("m"))
    shared = dealt.groupBy("key").agg(F.min("m").alias("c"), F.max("m.th").alias("last"), F.count(F.lit(1)).alias("n")).filter("c.th < last").drop("last")
    shared = materialise(shared, "shards")
    total = shared.agg(F.sum("n")).first()[0] or 0
    members = materialise(spread_join(dealt, shared, ["key"], total), "members")
    text = docs.select(F.xxhash64(whole_text()).alias("th"), whole_text().cast("binary").alias("text"))
    involved = members.select(F.col("m.th").alias("th")).distinct().join(each.select("th", F.col("copies").alias("n")), "th")
    rows = of.count()
    held = materialise(spread_join(text, involved, ["th"], rows).dropDuplicates(["th"]), "held")

    links = materialise(compared(_pairs(members), held), "links")
    roots = components(links).withColumnRenamed("node", "th")
    placed = members.select("key", "band", "m.*").join(roots, "th", "left").withColumn("root", F.coalesce("root", "th"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("weight"))
    mixed = materialise(mixed.filter("r < s").select("key", "n", "weight"), "mixed")
    total = mixed.agg(F.sum("n")).first()[0] or 0
    if total:
        apart = spread_join(placed, mixed.select("key", "n"), ["key"], total).join(each.select("th", F.col("packed").alias("keys")), "th")
        links = links.unionByName(materialise(searched(apart, mixed, held, total), "links"))
        roots = components(links).withColumnRenamed("node", "th")
    copies = each.select("th", F.col("copies").alias("n")).join(roots, "th", "left").withColumn("root", F.coalesce("root", "th"))
    return spread_join(of.select("doc_id", "th"), copies, ["th"], rows)

"""Suffix-array dedup: every byte inside a string of ``LENGTH`` bytes that also starts anywhere else.

The corpus is cut into bounded shards so that no match crosses one, and each shard gets a run-length index.

1. *Anchors.*  Each window of ``LENGTH`` bytes picks the least-hashed gram of ``GRAM`` bytes inside it.  Equal
   windows pick the same gram, so windows need to meet only where their anchors' grams are equal.  The
   windows of one anchor are consecutive; their bytes form a segment.
2. *Multiplicity.*  Segments with equal anchor and content are one variant with a count.  All windows of a
   variant with two or more occurrences repeat.  An anchor with one single segment matches nothing.
3. *Run-length index.*  The variants that share an anchor with other variants go to a shard.  Its suffix
   array gives the Burrows-Wheeler transform, which is kept as runs with text positions sampled at run heads
   and run ends, and the length matched with the neighbour there.  Along the text these lengths fall by one
   a byte between samples, so one pass streams the matching statistics of every byte against all others;
   windows with a match of ``LENGTH`` or more are marked.
4. An anchor with more than ``ANCHOR_BYTES`` of variants (a passage in very many different surroundings) is dealt
   again before any shuffle by anchor: its variants are cut by anchors of another hash, below the first ones, and
   steps 2 and 3 follow for these.  That is repeated up to ``LEVELS`` times; what is still too large then (windows
   that differ almost nowhere) is counted by whole windows with map-side sums, which loses no match.

Hashes are 64 bits for grams, with a second 64 for contents: of 128 bits where equality is decided.

Rows are told apart by (doc_id, hash of the text), so ids may repeat or be null; equal rows are copies of
each other.  A null text is empty; texts of fewer than ``LENGTH`` bytes keep all; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import drop_path, made_here, materialise, released, spread_join, table

LENGTH, GRAM = 200, 32
#: Bytes of segments that one run-length index holds.
SHARD_BYTES = 1 << 20
#: Bytes of variants that one anchor may bring to a shard, and how often larger anchors are dealt again.
ANCHOR_BYTES, LEVELS = 1 << 18, 6
#: Windows handled at once in a long text; positions inside fit the low bits of a gram's rank.
CHUNK, LOW_BITS = 1 << 19, 20
SEG = "doc_id long, th long, start long, nwin int, fp long, sh long, n long, known boolean"


def anchors(t, length: int = LENGTH, gram: int = GRAM, level: int = 0):
    """first window, number of windows, anchor position and gram hash of each run of windows of a byte array.

    Each level has a hash of its own.
    """
    import numpy as np

    u = np.uint64
    firsts, counts, places, prints = [], [], [], []
    for w0 in range(0, len(t) - length + 1, CHUNK):
        a = t[w0 : w0 + CHUNK + length - 1].astype(u)
        a = a[:-1] | (a[1:] << u(8))
        a = a[:-2] | (a[2:] << u(16))
        a = a[:-4] | (a[4:] << u(32))
        m = len(a) - gram + 8
        h = np.full(m, level * 0xA24BAED4963EE407 % (1 << 64), u)
        for k, c in zip(range(0, gram, 8), (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93), strict=False):
            x = a[k : k + m] * u(c)
            h += x ^ (x >> u(31))
            h *= u(0xFF51AFD7ED558CCD)
        h ^= h >> u(33)
        h *= u(0xC4CEB9FE1A85EC53)
        h ^= h >> u(29)
        low = u((1 << LOW_BITS) - 1)
        best = (h & ~low) | np.arange(m, dtype=u)
        width, full = 1, length - gram + 1
        while 2 * width <= full:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        if full > width:
            best = np.minimum(best[: len(best) - (full - width)], best[full - width :])
        at = (best & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        firsts.append(first + w0)
        counts.append(np.diff(np.append(first, len(at))))
        places.append(at[first] + w0)
        prints.append(h[at[first]])
    if not firsts:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, u),)
    return tuple(np.concatenate(x) for x in (firsts, counts, places, prints))


def _segments(length: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            rows, starts, nwins, fps, shs = [], [], [], [], []
            for i, raw in enumerate(batch.column(2).to_pylist()):
                if raw is None or len(raw) < length:
                    continue
                first, count, place, fp = anchors(np.frombuffer(raw, np.uint8), length)
                rows.append(np.full(len(first), i, np.int64))
                starts.append(first)
                nwins.append(count)
                fps.append(fp)
                # the place of the anchor in the segment is part of what must be equal
                shs.append(np.array([digest(raw[a:b], c) for a, b, c in zip(first.tolist(), (first + count + length - 1).tolist(), (place - first).tolist(), strict=True)], np.uint64))
            if not rows:
                continue
            row, start, nwin, fp, sh = (np.concatenate(x) for x in (rows, starts, nwins, fps, shs))
            order = np.lexsort((sh, fp))
            new = np.concatenate([[True], (fp[order][1:] != fp[order][:-1]) | (sh[order][1:] != sh[order][:-1])])
            times = np.diff(np.append(np.flatnonzero(new), len(order)))
            n, known = np.zeros(len(order), np.int64), np.zeros(len(order), bool)
            n[order[new]] = times
            known[order] = np.repeat(times > 1, times)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(start), pa.array(nwin.astype(np.int32)), pa.array(fp.view(np.int64)), pa.array(sh.view(np.int64)), pa.array(n), pa.array(known)],
                [c.split()[0] for c in SEG.split(", ")],
            )

    return run


class RunLengthIndex:
    """The run-compressed BWT of short texts, with positions and match lengths sampled at run heads and ends."""

    def __init__(self, parts: list[bytes]):
        import numpy as np

        size = np.array([len(p) for p in parts], np.int64)
        self.text = np.frombuffer(b"".join(parts), np.uint8)
        self.first = np.cumsum(size) - size
        self.end = np.repeat(self.first + size, size)
        self.at_start = np.zeros(len(self.text), bool)
        self.at_start[self.first[size > 0]] = True
        self._packed = self._pack(7, 9)
        sa = self._suffix_array(int(size.max(initial=0)))
        n = len(sa)
        before = self.text[np.maximum(sa - 1, 0)].astype(np.int32)
        starts = np.flatnonzero(self.at_start[sa])
        before[starts] = 256 + np.arange(len(starts))  # each part has an end of its own before it
        change = before[1:] != before[:-1]
        edge = np.flatnonzero(change) + 1
        #: first rows of the runs, and the character that each run repeats
        self.heads = np.concatenate([[0], edge]) if n else edge
        self.letters = before[self.heads]
        lcp = self._common(sa[edge - 1], sa[edge])
        self.head_at, self.head_len = sa[edge], lcp  # against the row above
        self.end_at, self.end_len = sa[edge - 1], lcp  # against the row below
        if n:
            self.end_at = np.append(self.end_at, sa[-1])
            self.end_len = np.append(self.end_len, 0)
            self.head_at = np.append(self.head_at, sa[0])
            self.head_len = np.append(self.head_len, 0)

    def _pack(self, chars: int, bits: int):
        """The next characters (each plus one, 0 past the part's end) as one integer."""
        import numpy as np

        n = len(self.text)
        out, pos = np.zeros(n, np.int64), np.arange(n)
        for k in range(chars):
            c = np.zeros(n, np.int64)
            c[: n - k] = self.text[k:].astype(np.int64) + 1 if n > k else 0
            c[pos + k >= self.end] = 0
            out = (out << bits) | c
        return out

    def _suffix_array(self, longest: int):
        """Prefix doubling; suffixes equal to their ends keep text order, as if each end were a letter of its own."""
        import numpy as np

        n = len(self.text)
        sa = np.argsort(self._packed, kind="stable")
        key = self._packed[sa]
        new = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[sa] = head
        size = np.bincount(head, minlength=n)[head] if n else head
        rows, h = np.flatnonzero(size > 1), 7
        while len(rows) and h < longest:
            p = sa[rows]
            open_ = p + h < self.end[p]
            second = np.where(open_, rank[np.minimum(p + h, n - 1)] + 1, 0)
            key = rank[p] * (n + 2) + second
            order = np.argsort(key, kind="stable")
            p, key, second = p[order], key[order], second[order]
            sa[rows] = p
            new = np.concatenate([[True], key[1:] != key[:-1]])
            group = np.cumsum(new) - 1
            rank[p] = rows[np.flatnonzero(new)][group]
            more = (np.bincount(group)[group] > 1) & (second > 0)
            rows, h = rows[more], 2 * h
        return sa

    def _common(self, a, b):
        """Length of the common prefix of the suffixes at a and b, within their parts."""
        import numpy as np

        most = np.minimum(self.end[a] - a, self.end[b] - b)
        out, live, k = np.zeros(len(a), np.int64), np.arange(len(a)), 0
        while len(live):
            x, y = self._packed[a[live] + k], self._packed[b[live] + k]
            same = x == y
            go = same & (k + 7 < most[live])
            done = live[same & ~go]
            out[done] = most[done]
            diff = live[~same]
            bit = np.frexp((x[~same] ^ y[~same]).astype(np.float64))[1]  # a float rounds up past 53 bits: checked below
            z = x[~same] ^ y[~same]
            bit = np.where((z >> np.minimum(bit - 1, 62)) == 0, bit - 1, bit)
            out[diff] = np.minimum(k + (63 - bit) // 9, most[diff])
            live, k = live[go], k + 7
        return out

    def matching_statistics(self):
        """For each byte the longest match of what starts there with what starts at any other byte."""
        import numpy as np

        n = len(self.text)
        pos, out = np.arange(n), np.zeros(n, np.int64)
        for at, length in ((self.head_at, self.head_len), (self.end_at, self.end_len)):
            sample = np.full(n, -1, np.int64)
            sample[at] = length
            out = np.maximum(out, np.maximum.accumulate(np.where(sample >= 0, sample + pos, -1)) - pos)
        return out


def marks_of(parts: list[bytes], length: int = LENGTH):
    """For each part the runs (first window, last window + 1) of windows that occur elsewhere in the parts."""
    import numpy as np

    index = RunLengthIndex(parts)
    hit = index.matching_statistics() >= length
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    lo, hi = edges[::2], edges[1::2]
    part = np.searchsorted(index.first, lo, side="right") - 1
    return part, lo - index.first[part], hi - index.first[part]


CUT = "fp long, spread long, doc_id long, th long, start long, n long, bytes binary"


def _index_shards(length: int, limit: int):
    """Rows of CUT sorted by fp to marks (kind 0: lo, hi in bytes of the text); those with spread pass as they are (kind 1)."""
    names = ["kind", "fp", "doc_id", "th", "start", "lo", "hi", "n", "bytes"]

    def passed(rows):
        none = pa.array([0] * len(rows), pa.int64())
        fp, doc, th, start, n = (pa.array([r[k] for r in rows], pa.int64()) for k in (0, 2, 3, 4, 5))
        return pa.RecordBatch.from_arrays([pa.array([1] * len(rows), pa.int32()), fp, doc, th, start, none, none, n, pa.array([r[6] for r in rows], pa.binary())], names)

    def index(rows):
        if len(rows) < 2:
            return
        part, lo, hi = marks_of([r[6] for r in rows], length)
        picked = [rows[k] for k in part.tolist()]
        fp, doc, th, start, n = (pa.array([r[k] for r in picked], pa.int64()) for k in (0, 2, 3, 4, 5))
        at = start.to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * len(picked), pa.int32()), fp, doc, th, start, pa.array(lo + at), pa.array(hi - 1 + length + at), n, pa.nulls(len(picked), pa.binary())],
            names,
        )

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, fp, through = [], 0, None, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[1]:
                    through.append(row)
                    if len(through) >= 1000:
                        yield passed(through)
                        through = []
                    continue
                if row[0] != fp and size >= limit // 2:
                    yield from index(held)
                    held, size = [], 0
                fp = row[0]
                held.append(row)
                size += len(row[6])
        if through:
            yield passed(through)
        yield from index(held)

    return run


MATCHES = "kind int, fp long, doc_id long, th long, start long, lo long, hi long, n long, bytes binary"


def _matches(cut: DataFrame, length: int, limit: int) -> DataFrame:
    dealt = cut.repartition("fp", "spread").sortWithinPartitions("fp", "spread", "doc_id", "th", "start")
    return materialise(dealt.mapInArrow(_index_shards(length, limit), MATCHES), "matches")


def _dealt_again(length: int, level: int):
    """Variants (fp, doc_id, th, start, n, bytes) to the segments that the anchors of a level cut them into."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from xxhash import xxh3_64_intdigest as digest

        for batch in batches:
            out = []
            for fp, doc, th, start, n, raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first, count, place, below = anchors(np.frombuffer(raw, np.uint8), length, level=level)
                for a, c, p, g in zip(first.tolist(), count.tolist(), place.tolist(), below.tolist(), strict=True):
                    part = raw[a : a + c + length - 1]
                    key = digest(g.to_bytes(8, "little"), fp % (1 << 64))
                    out.append((key - (1 << 64) if key >> 63 else key, digest(part, p - a), doc, th, start + a, c, n, part))
            if out:
                cols = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in (cols[0], *cols[2:7])]
                yield pa.RecordBatch.from_arrays([arrays[0], pa.array(np.array(cols[1], np.uint64).view(np.int64)), *arrays[1:], pa.array(cols[7], pa.binary())], [c.split()[0] for c in AGAIN.split(", ")])

    return run


AGAIN = "fp long, sh long, doc_id long, th long, start long, nwin long, n long, bytes binary"


def _windows(length: int):
    """The single windows of segments: doc_id, th, at, two content hashes, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest as digest

        for batch in batches:
            rows, at, one, two = [], [], [], []
            for i, (start, raw) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                for k in range(len(raw) - length + 1):
                    h = digest(raw[k : k + length])
                    rows.append(i)
                    at.append(start + k)
                    one.append((h >> 65) - (1 << 62))
                    two.append((h & ((1 << 63) - 1)) - (1 << 62))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(at, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), batch.column(3).take(take)],
                ["doc_id", "th", "at", "h1", "h2", "n"],
            )

    return run


def _cut(length: int):
    """A text's wanted segments: one row each with its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, th, raws, wants = (c.to_pylist() for c in batch.columns)
            out = [(w["fp"], w["spread"], d, t, w["start"], w["n"], raw[w["start"] : w["start"] + w["nwin"] + length - 1]) for d, t, raw, ws in zip(doc, th, raws, wants, strict=True) for w in ws]
            for a in range(0, len(out), 20_000):
                cols = list(zip(*out[a : a + 20_000], strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:6]], pa.array(cols[6], pa.binary())], [c.split()[0] for c in CUT.split(", ")])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, th (a hash of the text) and the text's bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("raw"))


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def _wanted(variants: DataFrame, length: int, anchor_bytes: int) -> DataFrame:
    """The variants whose windows must be compared: fp, n and rep of anchors with several; spread is not 0 for too large anchors.

    An anchor's variants differ; one that occurs twice is marked whole, so that anchors without a single one need no more.
    """
    size = F.sum(F.col("rep.nwin") + (length - 1))
    anchor = variants.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("n").alias("least"), size.alias("size")).filter("n > 1 and least = 1")
    mixed = spread_join(variants, anchor.select("fp", "n", "size"), ["fp"], variants.count())
    spread = F.when(F.col("size") > anchor_bytes, F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) + 1).otherwise(0)
    return mixed.withColumn("spread", spread).drop("size", "sh")


def repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES, levels: int = LEVELS) -> DataFrame:
    """doc_id, th and spans (lo, hi in bytes, some may touch or overlap) of texts with repeated windows.

    The spans are written; the tables that lead to them are deleted.
    """
    with made_here() as paths:
        found = materialise(_spans(docs, length, shard_bytes, anchor_bytes, levels), "spans")
    for path in paths[:-1]:
        drop_path(docs.sparkSession, path)
    return found


def _spans(docs: DataFrame, length: int, shard_bytes: int, anchor_bytes: int, levels: int) -> DataFrame:
    texts = keyed(docs)
    segs = materialise(texts.filter(F.length("raw") >= length).mapInArrow(_segments(length), SEG), "segments")
    span = [F.col("start").alias("lo"), (F.col("start") + F.col("nwin") + (length - 1)).alias("hi")]
    variants = segs.filter("n > 0").groupBy("fp", "sh").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "th", "start", "nwin")).alias("rep"))
    variants = materialise(variants, "variants")
    wanted = _wanted(variants, length, anchor_bytes).select("fp", "n", "spread", "rep.*")
    lists = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("fp", "start", "nwin", "n", "spread")).alias("wants"))
    fetched = texts.join(lists, _same(texts, lists)).select(texts["doc_id"], texts["th"], "raw", "wants")
    found = _matches(fetched.mapInArrow(_cut(length), CUT), length, shard_bytes)
    twice = variants.filter("n > 1").select("fp", "sh")
    marks = segs.filter("known").select("doc_id", "th", *span)
    marks = marks.unionByName(segs.filter("not known").join(twice, ["fp", "sh"], "left_semi").select("doc_id", "th", *span))
    marks = marks.unionByName(found.filter("kind = 0").select("doc_id", "th", "lo", "hi"))
    hot = found.filter("kind = 1").select("fp", "doc_id", "th", "start", "n", "bytes")
    for level in range(1, levels + 1):
        if not hot.take(1):
            break
        parts = materialise(hot.mapInArrow(_dealt_again(length, level), AGAIN), "parts")
        variants = parts.groupBy("fp", "sh").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "th", "start", "nwin", "bytes")).alias("rep"))
        variants = materialise(variants, "variants")
        # rows of n > 1 stand for variants that are marked whole
        single = parts.filter("n = 1").select("fp", "sh", "doc_id", "th", "start", "nwin")
        marks = marks.unionByName(single.join(variants.filter("n > 1").select("fp", "sh"), ["fp", "sh"], "left_semi").select("doc_id", "th", *span))
        wanted = _wanted(variants, length, anchor_bytes)
        cut = wanted.select("fp", F.col("spread").cast("long").alias("spread"), "rep.doc_id", "rep.th", "rep.start", "n", "rep.bytes")
        found = _matches(cut, length, shard_bytes)
        marks = marks.unionByName(found.filter("kind = 0").select("doc_id", "th", "lo", "hi"))
        hot = found.filter("kind = 1").select("fp", "doc_id", "th", "start", "n", "bytes")
    if hot.take(1):
        single = hot.select("doc_id", "th", "start", "n", "bytes").mapInArrow(_windows(length), "doc_id long, th long, at long, h1 long, h2 long, n long")
        single = materialise(single, "windows")
        often = single.groupBy("h1", "h2").agg(F.sum("n").alias("n")).filter("n > 1").select("h1", "h2")
        more = single.filter("n = 1").join(often, ["h1", "h2"], "left_semi")
        marks = marks.unionByName(more.select("doc_id", "th", F.col("at").alias("lo"), (F.col("at") + length).alias("hi")))
    return marks.groupBy("doc_id", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted maximal runs."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            if hi > out[-1][1]:
                out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for lo, hi in spans:
        out.append(raw[at:lo])
        at = hi
    return b"".join([*out, raw[at:]])


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the bytes of characters that they hold in part."""
    out = []
    for lo, hi in spans:
        while lo < hi and raw[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            runs = merged([(s["lo"], s["hi"]) for s in spans or []])
            rows.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(raw, runs)).hexdigest()))
        cols = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def with_spans(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES, levels: int = LEVELS) -> DataFrame:
    """doc_id, raw and spans (null if none) of every row."""
    texts, found = keyed(docs), repeats(docs, length, shard_bytes, anchor_bytes, levels)
    return texts.join(found, _same(texts, found), "left").select(texts["doc_id"], "raw", "spans")


def digest(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES, levels: int = LEVELS) -> DataFrame:
    rows = with_spans(docs, length, shard_bytes, anchor_bytes, levels)
    return rows.mapInArrow(_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))

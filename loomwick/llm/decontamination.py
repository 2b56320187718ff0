"""Benchmark decontamination: an FM-index for each training shard, searched for all test phrases.

Texts are read as lower-case words.  A test item gives its windows of ``WINDOW`` words (an item with fewer words
is one window).  A shard is a bounded run of a partition's documents.  Words that no test item has end a
phrase, so a shard's text is its maximal runs of test words, long enough for the shortest window.  Over them an
FM-index is built: the Burrows-Wheeler transform of the word sequence in a wavelet matrix, counts of smaller
words, and text positions sampled at every ``SAMPLE``-th word and at run starts.  All windows are searched
backwards at once; occurrences are located by walking to the next sampled position; the words of all
occurrences merge to removal spans.

Test items travel with the tasks, so they are taken in blocks of about ``BLOCK_BYTES`` of text.  One block is one pass
over the rows.  Of several each is one job over the texts, whose finds are written to the shared folder before the
next block is read, so that driver and workers hold one block at a time whatever the benchmark's size; the finds of
a text then add up and join its rows.

Defined cases: a null or empty text has no words and is clean; items without words, or with a null id, are
skipped; item rows with equal ids are one item; equal rows are judged alike; an empty table gives an empty
result and an empty benchmark marks nothing; extra columns are kept by ``scan`` and ignored by ``digest``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import materialise, released, spread_join, table

WINDOW, SAMPLE = 10, 8
#: Text of the test items that one pass carries.
BLOCK_BYTES = 8 << 20
#: A shard ends at so many bytes of text: about a million words if all are test words.
SHARD_TEXT = 6 << 20
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_KEEP = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _KEEP else 0x20 for b in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


class Windows:
    """The distinct windows of some test items, as word ids, and the items that have each."""

    def __init__(self, items: list[tuple[str, str]], width: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of((text or "").encode())]
            for a in range(max(1, len(ids) - width + 1) if ids else 0):
                seen.setdefault(tuple(ids[a : a + width]), set()).add(item)
        self.windows = list(seen)
        self.items = [sorted(s) for s in seen.values()]
        self.shortest = min(map(len, self.windows), default=0)


class FMIndex:
    """Backward search and location over runs of words; ids holds the runs, starts where each begins."""

    def __init__(self, ids, starts, letters: int):
        import numpy as np

        n = len(ids)
        self.n, self.ids = n, ids
        end = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
        sa = self._suffix_array(ids, end)
        first = np.zeros(n, bool)
        first[starts] = True
        bwt = np.where(first[sa], 0, ids[np.maximum(sa - 1, 0)])
        count = np.bincount(ids, minlength=letters + 1)
        self.less = np.cumsum(count) - count
        self.count = count
        self.ends = np.bincount(ids[np.append(starts[1:], n) - 1], minlength=letters + 1)
        self.bwt = bwt
        self.levels = []
        cur = bwt
        for b in range(max(1, int(letters).bit_length()) - 1, -1, -1):
            one = ((cur >> b) & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((b, ones, n - int(ones[-1])))
            cur = np.concatenate([cur[~one], cur[one]])
        sampled = first[sa] | (sa % SAMPLE == 0)
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = sa[sampled]

    @staticmethod
    def _suffix_array(ids, end):
        import numpy as np

        n = len(ids)
        sa = np.argsort(ids, kind="stable")
        key = ids[sa]
        rank = np.empty(n, np.int64)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa] = head
        rows, h = np.flatnonzero(np.bincount(head, minlength=n)[head] > 1), 1
        while len(rows):
            p = sa[rows]
            open_ = p + h < end[p]
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

    def rank(self, c, i):
        """How often each word c stands in the first i places of the transform."""
        import numpy as np

        lo, hi = np.zeros_like(i), i
        for b, ones, zeros in self.levels:
            bit = (c >> b) & 1 == 1
            a, z = ones[lo], ones[hi]
            lo = np.where(bit, zeros + a, lo - a)
            hi = np.where(bit, zeros + z, hi - z)
        return hi - lo

    def search(self, patterns):
        """Rows lo, hi of each pattern; patterns: a matrix of word ids."""
        import numpy as np

        c = patterns[:, -1]
        lo, hi = self.less[c], self.less[c] + self.count[c]
        live = np.flatnonzero(hi > lo)
        for k in range(patterns.shape[1] - 2, -1, -1):
            c = patterns[live, k]
            base = self.less[c] + self.ends[c]
            lo[live], hi[live] = base + self.rank(c, lo[live]), base + self.rank(c, hi[live])
            live = live[hi[live] > lo[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows):
        """Text positions of rows."""
        import numpy as np

        out, at, steps, live = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(live):
            hit = self.sampled[at[live]]
            done = live[hit]
            out[done] = self.samples[self.sample_rank[at[done]]] + steps
            live, steps = live[~hit], steps + 1
            c = self.bwt[at[live]]
            at[live] = self.less[c] + self.ends[c] + self.rank(c, at[live])
        return out


def search_texts(raws: list[bytes], windows: Windows, matrices) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """For each text: its number of words, the merged spans of hit words and the items found."""
    import numpy as np

    get, n_words, pieces, docs, offsets = windows.vocabulary.get, [], [], [], []
    for d, raw in enumerate(raws):
        words = words_of(raw)
        n_words.append(len(words))
        if windows.shortest and len(words) >= windows.shortest:
            ids = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
            edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if b - a >= windows.shortest:
                    pieces.append(ids[a:b])
                    docs.append(d)
                    offsets.append(a)
    spans: list[list[tuple[int, int]]] = [[] for _ in raws]
    items: list[list[str]] = [[] for _ in raws]
    if not pieces:
        return n_words, spans, items
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    index = FMIndex(np.concatenate(pieces), starts, len(windows.vocabulary))
    edge = np.zeros(index.n + 1, np.int64)
    found: set[tuple[int, int]] = set()
    doc_of, starts_list = np.array(docs), starts
    for numbers, matrix in matrices:
        lo, hi = index.search(matrix)
        n = hi - lo
        rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        at = index.locate(rows)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + matrix.shape[1], -1)
        where = doc_of[np.searchsorted(starts_list, at, side="right") - 1]
        pairs = np.unique(where * len(windows.windows) + np.repeat(numbers, n))
        found.update(zip((pairs // len(windows.windows)).tolist(), (pairs % len(windows.windows)).tolist(), strict=True))
    hit = np.cumsum(edge)[:-1] > 0
    begins = np.zeros(index.n, bool)
    begins[starts] = True
    new = hit & (np.concatenate([[True], ~hit[:-1]]) | begins)
    last = hit & np.concatenate([~hit[1:] | begins[1:], [True]])
    for a, b in zip(np.flatnonzero(new).tolist(), np.flatnonzero(last).tolist(), strict=True):
        run = int(np.searchsorted(starts_list, a, side="right")) - 1
        shift = offsets[run] - int(starts[run])
        spans[docs[run]].append((a + shift, b + 1 + shift))
    for d, w in found:
        items[d] += windows.items[w]
    return n_words, spans, [sorted(set(x)) for x in items]


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


_SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _shards(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(text_at).nbytes
        if size >= SHARD_TEXT:
            yield held
            held, size = [], 0
    if held:
        yield held


class Search:
    """The windows of a block of test items, ready to be searched in a shard."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        import numpy as np

        self.windows = Windows(items, width)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(self.windows.windows):
            by_length.setdefault(len(w), []).append(k)
        self.matrices = [(np.array(ks), np.array([self.windows.windows[k] for k in ks], np.int64)) for ks in by_length.values()]

    def texts(self, held: list[pa.RecordBatch], text_at: int):
        raws = [(t or "").encode() for b in held for t in b.column(text_at).to_pylist()]
        return search_texts(raws, self.windows, self.matrices)


def _lists(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"lo": lo, "hi": hi} for lo, hi in s] for s in spans], _SPANS)


def _finished(batch: pa.RecordBatch, text_at: int, names: list[str], n_words, spans, items, remove: bool) -> pa.RecordBatch:
    """The columns of names with what was found, or with the found spans cut from the text."""
    cols = batch.columns[: len(names)]
    if remove:
        texts = [without_spans(t, s) if s else t for t, s in zip(batch.column(text_at).to_pylist(), spans, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == text_at else c for k, c in enumerate(cols)], names)
    return pa.RecordBatch.from_arrays([*cols, pa.array(n_words, pa.int64()), _lists(spans), pa.array(items, pa.list_(pa.string()))], [*names, *FOUND])


FOUND = ["n_words", "hit_spans", "hit_items"]


def _one_pass(items, text_at: int, names: list[str], width: int, remove: bool):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items.value, width)
        for held in _shards(batches, text_at):
            n_words, spans, found = search.texts(held, text_at)
            at = 0
            for b in held:
                sl = slice(at, at + b.num_rows)
                at += b.num_rows
                yield _finished(b, text_at, names, n_words[sl], spans[sl], found[sl], remove)

    return run


def _block_pass(items, width: int):
    """Rows of two hashes and a text to the hashes, spans and items of those with finds."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items.value, width)
        for held in _shards(batches, 2):
            _, spans, found = search.texts(held, 2)
            keep = [k for k, s in enumerate(spans) if s]
            take = pa.array(keep, pa.int64())
            hashes = [pa.concat_arrays([b.column(k) for b in held]).take(take) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*hashes, _lists([spans[k] for k in keep]), pa.array([found[k] for k in keep], pa.list_(pa.string()))], ["h1", "h2", *FOUND[1:]])

    return run


def _last_pass(text_at: int, names: list[str], remove: bool):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words = [len(words_of((t or "").encode())) for t in b.column(text_at).to_pylist()]
            spans = [union([(s["lo"], s["hi"]) for s in x or []]) for x in b.column(len(names)).to_pylist()]
            items = [sorted(set(x or [])) for x in b.column(len(names) + 1).to_pylist()]
            yield _finished(b, text_at, names, n_words, spans, items, remove)

    return run


def list_blocks(benchmark: DataFrame, block_bytes: int) -> list[Callable[[], list[tuple[str, str]]]]:
    """The test items in blocks of about so many bytes, each read when it is called for."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).dropna()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    return [lambda k=k: [tuple(r) for r in rows.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).collect()] for k in range(n)]


def _scanned(rows: DataFrame, text_at: int, benchmark: DataFrame, width: int, block_bytes: int, remove: bool) -> DataFrame:
    """rows (columns c0, c1, ...) with the columns FOUND, or with texts cut; one Python function a task at any time."""
    spark, names = rows.sparkSession, rows.columns
    rows = rows.withColumn(names[text_at], F.col(names[text_at]).cast("string"))
    empty = rows.withColumns({"n_words": F.lit(0).cast("long"), "hit_spans": F.array().cast("array<struct<lo:int,hi:int>>"), "hit_items": F.array().cast("array<string>")})
    schema = rows.schema if remove else empty.schema
    blocks = list_blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        return rows.mapInArrow(_one_pass(spark.sparkContext.broadcast(blocks[0]()), text_at, names, width, remove), schema)
    text = F.coalesce(F.col(names[text_at]), F.lit(""))
    keyed = rows.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("benchmark"), text)})
    found = []
    for block in blocks:
        items = spark.sparkContext.broadcast(block())
        hits = keyed.select("h1", "h2", text.alias("text")).mapInArrow(_block_pass(items, width), "h1 long, h2 long, hit_spans array<struct<lo:int,hi:int>>, hit_items array<string>")
        once = hits.groupBy("h1", "h2").agg(F.first("hit_spans").alias("spans"), F.first("hit_items").alias("items"), F.count(F.lit(1)).alias("n"))
        found.append(materialise(once, "finds"))
        items.destroy()
    each = reduce(DataFrame.unionByName, found).groupBy("h1", "h2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"), F.max("n").alias("n"))
    joined = spread_join(keyed, each, ["h1", "h2"], rows.count(), "left").select(*names, "spans", "items")
    return joined.mapInArrow(_last_pass(text_at, names, remove), schema)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def scan(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, hit_spans (word numbers lo, hi) and hit_items; clashing columns are replaced."""
    docs = docs.drop(*FOUND)
    return _scanned(_numbered(docs), docs.columns.index("text"), benchmark, width, block_bytes, False).toDF(*docs.columns, *FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with the spans of hit words cut from the texts, from the first to the last word of each."""
    return _scanned(_numbered(docs), docs.columns.index("text"), benchmark, width, block_bytes, True).toDF(*docs.columns)


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["hi"] - s["lo"]).cast("long"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without what lies from the first to the last word of each span."""
    places, at, out = [m.span() for m in WORD.finditer(text)], 0, []
    for lo, hi in spans:
        out.append(text[at : places[lo][0]])
        at = places[hi - 1][1]
    return "".join([*out, text[at:]])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")))


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, list_slice(w, k, k + {WINDOW - 1}) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - {WINDOW - 2}))) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, m, list_slice(w, k, k + m - 1) AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT len(g) AS m FROM iw) WHERE len(w) >= m)),
hits AS (SELECT doc_id, k, m, item_id FROM dw JOIN iw USING (g)),
hw AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS x FROM hits) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

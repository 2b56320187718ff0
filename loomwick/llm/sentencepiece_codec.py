"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a one-pass Viterbi.

Ids are those of the segmentation with the highest sum of the model's piece scores.  At each byte the automaton
moves once; following its output links names all pieces that end there, and each relaxes the best score.  A
character that no piece spells is written as byte pieces, at a cost below any piece.  Where segmentations
tie, the one whose last piece is longest wins.

Spaces stand for the model's word mark, and a text gets one in front.  As no piece goes on from a word into the
next space, texts fall apart before each run of spaces; each distinct part is segmented once, many parts at a
time in arrays, and remembered.  A part of over ``LONG_PART`` characters (a text without spaces) is segmented alone, with
five bytes of back pointers a byte of text and scores of the last bytes only, and not remembered.  A word mark that a text holds itself is written in bytes, so decoding gives back
every text exactly.

Models may be of any type with scored pieces.  For a model trained by merges the scores are its merge ranks, so
ids are the best-scoring ones, which need not be those that replaying the merges gives.

Defined cases: a null or empty text has no ids and decodes to the empty text; a null list of ids too; repeated
rows give equal rows; an empty table gives an empty result; extra columns are kept by ``encode``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import ChainMap
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import released, table

MARK = "▁"
#: Below the lowest score of any piece: what an unspelled character costs.
UNSPELLED = 10.0
#: Parts a generation of a worker's memory holds; bytes of parts segmented at once.
CACHE_PARTS, TOGETHER = 120_000, 1 << 19
#: Characters above which a part is segmented alone; bytes whose scores such a pass remembers, more than any piece has.
LONG_PART, RING = 1 << 14, 1 << 10
#: Rows of an output batch.
OUT_ROWS = 128
PART = re.compile(r" *[^ ]+| +")
_workers: dict[str, Codec] = {}


class Automaton:
    """Goto table with failures resolved, output links, and the pieces' ids, lengths and scores."""

    def __init__(self, pieces: list[tuple[bytes, int, float]]):
        import numpy as np

        letters = sorted({b for p, _, _ in pieces for b in p})
        self.classes = np.zeros(256, np.int64)
        self.classes[letters] = np.arange(1, len(letters) + 1)
        width = len(letters) + 1
        of = self.classes.tolist()
        children: list[dict[int, int]] = [{}]
        piece_at = {}
        for k, (p, _, _) in enumerate(pieces):
            s = 0
            for b in p:
                nxt = children[s].get(of[b])
                if nxt is None:
                    nxt = children[s][of[b]] = len(children)
                    children.append({})
                s = nxt
            piece_at[s] = k
        n = len(children)
        goto = np.zeros((n, width), np.int32)
        fail = [0] * n
        own = np.full(n, -1, np.int32)
        own[list(piece_at)] = list(piece_at.values())
        #: the longest piece that ends in a state, and for each state the next shorter state with a piece
        self.link = np.zeros(n, np.int32)
        has = own >= 0
        queue = [0]
        for s in queue:
            if s:
                goto[s] = goto[fail[s]]
                f = fail[s]
                self.link[s] = f if has[f] else self.link[f]
            for c, t in children[s].items():
                fail[t] = int(goto[s, c]) if s else 0
                queue.append(t)
            if children[s]:
                goto[s, list(children[s])] = list(children[s].values())
        self.goto = goto.astype(np.uint16) if n <= 1 << 16 else goto
        self.own = own
        self.first = np.where(has, np.arange(n), self.link).astype(np.int32)
        self.ids = np.array([i for _, i, _ in pieces], np.int32)
        self.sizes = np.array([len(p) for p, _, _ in pieces], np.int32)
        self.scores = np.array([s for _, _, s in pieces])


class Codec:
    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        pieces, self.bytes_of, self.byte_ids = [], [], np.full(256, -1, np.int32)
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes_of.append(bytes([int(text[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(text.replace(MARK, " ").encode())
                pieces.append((self.bytes_of[-1], i, sp.get_score(i)))
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no pieces for bytes, so it can't spell every text")
        texts = [p.decode() for p, _, _ in pieces]
        self.split = PART.findall if not any(re.search("[^ ] ", p) for p in texts) else (lambda t: [t] if t else [])
        self.spelled = {p for p in texts if len(p) == 1}
        self.unspelled = min(s for _, _, s in pieces) - UNSPELLED
        if max(len(p) for p, _, _ in pieces) >= min(RING, 256):
            raise ValueError("the model has a piece of 256 bytes or more")
        self.auto = Automaton(pieces)
        self.piece_size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.piece_start = np.cumsum(self.piece_size) - self.piece_size
        self.blob = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _segment(self, parts: list[str]) -> list[bytes]:
        """The ids of parts of like length, as native 32-bit integers."""
        import numpy as np

        auto, raws = self.auto, [p.encode("utf-8", "surrogatepass") for p in parts]
        order = sorted(range(len(raws)), key=lambda k: -len(raws[k]))
        sizes = np.array([len(raws[k]) for k in order])
        n, longest = len(order), int(sizes[0])
        grid = np.zeros((n, longest), np.uint8)
        flat = np.frombuffer(b"".join(raws[k] for k in order), np.uint8)
        inside = np.arange(longest) < sizes[:, None]
        grid[inside] = flat
        alone = np.zeros((n, longest), np.int8)  # 1: first byte of an unspelled character, 2: a later byte
        for row, k in enumerate(order):
            if not self.spelled.issuperset(parts[k]):
                at = 0
                for c in parts[k]:
                    m = len(c.encode("utf-8", "surrogatepass"))
                    if c not in self.spelled:
                        alone[row, at] = 1
                        alone[row, at + 1 : at + m] = 2
                    at += m
        grid, alone = np.ascontiguousarray(grid.T), np.ascontiguousarray(alone.T)
        active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
        best = np.full((longest + 1, n), -np.inf)
        best[0] = 0
        back = np.zeros((longest + 1, n), np.int32)
        step = np.ones((longest + 1, n), np.int32)
        state = np.zeros(n, np.int64)
        for t, a in enumerate(active.tolist(), 1):
            byte = grid[t - 1, :a]
            state = auto.goto[state[:a], auto.classes[byte]].astype(np.int64)
            kind = alone[t - 1, :a]
            odd = np.flatnonzero(kind)
            if len(odd):
                best[t, odd] = best[t - 1, odd] + np.where(kind[odd] == 1, self.unspelled, 0.0)
                back[t, odd] = self.byte_ids[byte[odd]]
            out, live = auto.first[state], None
            live = np.flatnonzero(out)
            out = out[live]
            while len(live):
                piece = auto.own[out]
                size = auto.sizes[piece]
                value = best[t - size, live] + auto.scores[piece]
                more = value > best[t, live]
                w = live[more]
                best[t, w] = value[more]
                back[t, w] = auto.ids[piece[more]]
                step[t, w] = size[more]
                out = auto.link[out]
                on = out > 0
                live, out = live[on], out[on]
        pos, rows = sizes.copy(), np.arange(n)
        found, count = [], np.zeros(n, np.int64)
        while len(rows):
            ids = np.full(n, -1, np.int32)
            at = pos[rows]
            ids[rows] = back[at, rows]
            pos[rows] = at - step[at, rows]
            count[rows] += 1
            found.append(ids)
            rows = rows[pos[rows] > 0]
        ids = np.array(found[::-1], np.int32).T  # a part's ids are the last of its row
        raw, width, ends = np.ascontiguousarray(ids).tobytes(), 4 * ids.shape[1], count.tolist()
        result: list[bytes] = [b""] * n
        for row, k in enumerate(order):
            result[k] = raw[(row + 1) * width - 4 * ends[row] : (row + 1) * width]
        return result

    def _segment_long(self, part: str) -> bytes:
        """The ids of one long part: the same pass byte by byte, whose memory is a few bytes for each byte of text."""
        auto, raw = self.auto, part.encode("utf-8", "surrogatepass")
        goto, classes, first, link, own = auto.goto.item, auto.classes.tolist(), auto.first.item, auto.link.item, auto.own.item
        sizes, scores, ids, mask = auto.sizes.tolist(), auto.scores.tolist(), auto.ids.tolist(), RING - 1
        unspelled, bytes_of, state = self.unspelled, self.byte_ids.tolist(), 0
        best, back, step = [0.0] * RING, array("i", bytes(4 * (len(raw) + 1))), bytearray(len(raw) + 1)
        t = 0
        for c in part:
            spelled = c in self.spelled
            for k, byte in enumerate(c.encode("utf-8", "surrogatepass")):
                t += 1
                state = goto(state, classes[byte])
                top, name, size = float("-inf"), 0, 1
                if not spelled:
                    top, name = best[(t - 1) & mask] + (0.0 if k else unspelled), bytes_of[byte]
                out = first(state)
                while out:
                    piece = own(out)
                    value = best[(t - sizes[piece]) & mask] + scores[piece]
                    if value > top:
                        top, name, size = value, ids[piece], sizes[piece]
                    out = link(out)
                best[t & mask], back[t], step[t] = top, name, size
        found = array("i")
        while t:
            found.append(back[t])
            t -= step[t]
        found.reverse()
        return found.tobytes()

    def _learn(self, parts: list[str]) -> None:
        new = []
        for p in dict.fromkeys(parts):
            known = self.older.get(p)
            if known is None:
                new.append(p)
            else:
                self.cache[p] = known
        new.sort(key=len)
        a = 0
        while a < len(new):
            b = a + 1
            while b < len(new) and (b + 1 - a) * len(new[b]) <= TOGETHER:
                b += 1
            self.cache.update(zip(new[a:b], self._segment(new[a:b]), strict=True))
            a = b

    def forget(self) -> None:
        """Empties the memory of parts: other stages of a worker need the room."""
        self.cache, self.older = {}, {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """For each text its ids as native 32-bit integers."""
        if len(self.cache) >= CACHE_PARTS:
            self.cache, self.older = {}, self.cache
        parts = [self.split(" " + t) if t else [] for t in texts]
        long = {p: self._segment_long(p) for ps in parts for p in ps if len(p) > LONG_PART} if any(t and len(t) > LONG_PART for t in texts) else {}
        missing = [p for ps in parts for p in ps if p not in self.cache and p not in long]
        if missing:
            self._learn(missing)
        known = ChainMap(long, self.cache) if long else self.cache
        return [b"".join(map(known.__getitem__, ps)) for ps in parts]

    def decode_many(self, lists: list[bytes]) -> list[str]:
        """The texts of lists of native 32-bit ids."""
        import numpy as np

        ids = np.frombuffer(b"".join(lists), np.int32)
        size = self.piece_size[ids]
        ends = np.cumsum(size)
        raw = self.blob[np.repeat(self.piece_start[ids] - (ends - size), size) + np.arange(int(size.sum()))].tobytes()
        ends = np.concatenate([[0], ends])[np.cumsum([0] + [len(x) // 4 for x in lists])].tolist()
        return [raw[a + 1 : b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: list[int]) -> str:
        return self.decode_many([array("i", ids).tobytes()])[0]


def codec(path: str) -> Codec:
    if path not in _workers:
        _workers[path] = Codec(path)
    return _workers[path]


def _encode(path: str, text_at: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        worker = codec(path)
        for batch in batches:
            ids = worker.encode(batch.column(text_at).to_pylist())
            for a in range(0, len(ids), OUT_ROWS):  # lists are as long as texts: hand on few at a time
                part = ids[a : a + OUT_ROWS]
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in part])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(part), np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, OUT_ROWS).columns[:-1], lists], batch.schema.names)
        worker.forget()

    return run


def encode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """docs with the column ids (one of that name is replaced)."""
    docs = docs.drop("ids").withColumn(text_col, F.col(text_col).cast("string"))
    out = docs.withColumn("ids", F.array().cast("array<int>"))
    return out.mapInArrow(_encode(model, docs.columns.index(text_col)), out.schema)


def _encode_whole(path: str, text_at: int):
    """Appends ids, their number, and the sha256 of the text that they decode to."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        worker = codec(path)
        for batch in batches:
            for a in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(a, OUT_ROWS)
                ids = worker.encode(part.column(text_at).to_pylist())
                n = [len(x) // 4 for x in ids]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))
                digests = [hashlib.sha256(t.encode()).hexdigest() for t in worker.decode_many(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(n, pa.int64()), pa.array(digests, pa.string())], [*part.schema.names, "ids", "n_tokens", "decoded_sha256"])
        worker.forget()

    return run


def encode_and_decode(docs: DataFrame, model: str, text_col: str = "text") -> DataFrame:
    """docs with ids, n_tokens and decoded_sha256, the digest of the text that the ids spell; one pass, one Python function."""
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    out = docs.withColumns({"ids": F.array().cast("array<int>"), "n_tokens": F.lit(0).cast("long"), "decoded_sha256": F.lit("")})
    return docs.mapInArrow(_encode_whole(model, docs.columns.index(text_col)), out.schema)


def _decode(path: str):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(path)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            texts = worker.decode_many([array("i", ids or []).tobytes() for ids in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], batch.schema.names)

    return run


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """encoded with the column decoded, the texts that the ids spell."""
    out = encoded.drop("decoded").withColumn("decoded", F.lit("").cast("string"))
    return out.mapInArrow(_decode(model), out.schema)


def _digest(path: str):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = codec(path)
        for batch in batches:
            ids = worker.encode(batch.column(1).to_pylist())
            back = worker.decode_many(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"],
            )
        worker.forget()

    return run


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of 32-bit little-endian ids) and the sha256 of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_digest(default_model()), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")

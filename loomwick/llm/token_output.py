"""Token-id output: whole texts to Parquet list columns that allow selective reads.

Layout of a written set: rows in ascending ``doc_id`` order, one file for each range of ids, columns
``part`` (the file's rank), ``doc_id``, ``local_start`` (ids before the document in its file), ``n_tokens``
and ``ids``.  ``ids`` is dictionary encoded (the vocabulary fits one dictionary page), the ascending columns
are delta encoded, row groups and pages have set sizes, and pages carry column indexes, so that a filter on
``doc_id`` or ``local_start`` reads few pages and a read of the metadata never touches the ids.

Defined cases: a null text is the empty text and yields the end id alone; a null ``doc_id`` sorts first;
rows with equal ids keep both, ordered by text hash; an empty table yields an empty set.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import gone_at_end, scratch, table, texts

#: Pieces in a generation of a worker's memory; a full one is kept as the older until the next is full.
CACHE_PIECES = 550_000
#: Code points below this have letter and number classes that no Unicode version changes.
SAFE_LIMIT = 0x500
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 64 << 10

OUT = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"
_workers: dict[str, PieceEncoder] = {}


def _char_class(letter: str) -> str:
    chars = [chr(c) for c in range(SAFE_LIMIT) if unicodedata.category(chr(c))[0] == letter]
    return "".join(map(re.escape, chars))


class PieceEncoder:
    """The library's encoding of whole texts, with the ids of each pre-token remembered.

    A byte-level BPE never merges across pre-tokens, so a text's ids are its pre-tokens' ids in a row.  Texts
    with characters whose class depends on the Unicode version, or with an added token, go through the
    library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        space, letters, numbers = r"\t-\r \x85\xa0", _char_class("L"), _char_class("N")
        # the pattern's alternatives, the common ones first: at no place can two of the first three match
        self.split = re.compile(
            rf" ?[{letters}]+| ?[{numbers}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
        ).findall
        self.unsafe = re.compile(f"[^\\x00-{chr(SAFE_LIMIT - 1)}]").search
        # the byte alphabet: printable latin-1 bytes stand for themselves, the others follow from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in set(plain)]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, piece: str) -> bytes:
        known = self.older.get(piece)
        if known is None:
            mapped = piece.encode().decode("latin-1").translate(self.alphabet)
            known = array("i", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        self.cache[piece] = known
        return known

    def encode(self, text: str) -> bytes:
        """The ids as native 32-bit integers, one after another."""
        if any(a in text for a in self.added) or (not text.isascii() and self.unsafe(text)):
            return array("i", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.cache) >= CACHE_PIECES:
            self.cache, self.older = {}, self.cache
        pieces, get, learn = self.split(text), self.cache.get, self._learn
        return b"".join([get(piece) or learn(piece) for piece in pieces])


def encoder(path: str) -> PieceEncoder:
    if path not in _workers:
        _workers[path] = PieceEncoder(path)
    return _workers[path]


def _encode_partition(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        part, start, enc = TaskContext.get().partitionId(), 0, encoder(path)
        end = array("i", [end_id]).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                rows = [enc.encode(t or "") + end for t in piece.column(1).to_pylist()]
                n = np.array([len(r) // 4 for r in rows], np.int64)
                ends = np.cumsum(n)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), part, np.int32)),
                        piece.column(0),
                        pa.array(start + ends - n),
                        pa.array(n),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32))),
                    ],
                    ["part", "doc_id", "local_start", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode every text and write the set to ``path`` (any store Spark writes)."""
    ordered = (
        texts(docs)
        .repartitionByRange("doc_id")  # an id is one document: ranges are cut without reading texts
        .withColumn("tie", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    (
        ordered.mapInArrow(_encode_partition(tokenizer, end_id), OUT)
        .write.option("compression", "snappy")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#local_start", "false")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The set with ``start``, the ids of all documents before; columns not selected are not read."""
    rows = spark.read.schema(OUT).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # a row for each file
    bases, at = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in totals):
        bases.append((part, at))
        at += n
    base = spark.createDataFrame(bases, "part int, base long")
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"
    )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    for batch in batches:
        ids = batch.column(3)
        raw = memoryview(np.ascontiguousarray(ids.flatten().to_numpy(), "<u4").tobytes())
        ends = np.cumsum(np.diff(ids.offsets.to_numpy())).tolist()
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip([0, *ends], ends, strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    cols = tokens.select("doc_id", "start", "n_tokens", "ids")
    return cols.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, default_tokenizer())
    gone_at_end(spark, path)
    return digest(read_tokens(spark, path))

"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows as Parquet and
reads them again as the next one's docs.  All stages but the last return the columns of docs.  Texts that a
stage shortens get a new ``n_chars`` where docs has it.  Further columns pass through.

Cases: an empty table goes through every stage as an empty table; a null text has no letter, so the first stage
drops it; of rows with one id and one text the second stage keeps that whose other columns come first as JSON text, so
of equal rows one.  Columns of any name pass through: a stage calls them by numbers while it works.  The last stage
adds ``ids``, ``n_tokens`` and ``decoded_sha256`` and replaces columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm import decontamination, language_id, near_copies, sentencepiece_codec, suffix_dedup
from loomwick.llm.common import drop_path, made_here, materialise, released, table

#: A document whose language is less sure than this is rejected.  Scores are relative to the best learned language, so
#: undecided text still scores about 1/k for k languages: with fewer than ten, only texts without letters fall below.
LEAST_SCORE = 0.1


def _resized(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _rewritten(docs: DataFrame, columns: list[str], at: int, rewrite, extra: list[str]) -> DataFrame:
    """docs with the text, the column of number at, changed by rewrite(text, *extra columns)."""
    wide = docs.select(*columns, *extra)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = [batch.column(k).to_pylist() for k in (at, *range(len(columns), batch.num_columns))]
            texts = pa.array([rewrite(*row) for row in zip(*given, strict=True)], pa.string())
            kept = [texts if k == at else batch.column(k) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays(kept, columns)

    return wide.mapInArrow(run, docs.select(*columns).schema)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without letters go.

    They have no language.  A text in a language or script that was not learned stays, as the score compares learned
    languages only.
    """
    docs = docs.withColumn("text", F.col("text").cast("string"))
    model = spark.sparkContext.broadcast(language_id.train(docs))
    at = docs.columns.index("text")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = language_id.Judge(model.value)
        for held in language_id.together(batches, at):
            lang, score, _ = judge.judge([t for b in held for t in b.column(at).to_pylist()])
            keep = pa.array([x != language_id.UNKNOWN and s >= LEAST_SCORE for x, s in zip(lang, score.tolist(), strict=True)], pa.bool_())
            first = 0
            for batch in held:
                yield batch.filter(keep.slice(first, batch.num_rows))
                first += batch.num_rows

    return docs.mapInArrow(run, docs.schema)


def _numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its columns called c0, c1, ..., and these names: no name of a stage's own can clash with them."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each component of near copies the document with the smallest id stays.

    Near copies have a similarity of 0.8 or more by five-word shingles, compared exactly; the radius of 4 bits and the
    four-word shingles of op9 bind op9 alone.  Documents without an id count after all others, by a hash of the text.
    """
    rows, names = _numbered(docs)
    text = F.coalesce(F.col(names[docs.columns.index("text")]).cast("string"), F.lit(""))
    unnamed = F.shiftrightunsigned(F.xxhash64(text), 1).bitwiseOR(F.lit(1 << 62))
    given = F.col(names[docs.columns.index("doc_id")]).cast("long")
    named = rows.withColumns({"doc_id": F.coalesce(given, unnamed), "th": F.xxhash64(text), "text": text})
    with made_here() as paths:
        found = near_copies.near_copies(named.select("doc_id", "text"))
        seen = found.groupBy("root", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
        stay = seen.groupBy("root").agg(F.min(F.struct("doc_id", "th", "n")).alias("x"))
        stay = materialise(stay.select("x.*"), "stay")
    for path in paths[:-1]:  # what led to the rows that stay
        drop_path(spark, path)
    key = ["doc_id", "th"]
    once = named.join(stay.filter("n = 1").select(*key), key, "left_semi").select(*names)
    if stay.filter("n > 1").take(1):  # rows with one id and one text
        several = named.join(stay.filter("n > 1").select(*key), key, "left_semi")
        first = several.groupBy(*key).agg(F.min_by(F.struct(*names), F.to_json(F.struct(*names), {"ignoreNullFields": "false"})).alias("x"))
        once = once.unionByName(first.select("x.*"))
    return once.toDF(*docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Suffix-array dedup: repeated passages go from every text, in whole characters."""
    found = suffix_dedup.repeats(docs).withColumnsRenamed({"doc_id": "of", "th": "key"})
    rows, names = _numbered(docs)
    text = F.col(names[docs.columns.index("text")]).cast("string")
    keyed = rows.withColumns({names[docs.columns.index("text")]: text, "th": F.xxhash64(F.coalesce(text, F.lit(""))), "id": F.col(names[docs.columns.index("doc_id")]).cast("long")})
    joined = keyed.join(found, F.col("id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("key")), "left").select(*names, "spans")

    def rewrite(text, spans):
        if not spans:
            return text
        raw = text.encode()
        runs = suffix_dedup.whole_characters(raw, suffix_dedup.merged([(s["lo"], s["hi"]) for s in spans]))
        return suffix_dedup.kept_bytes(raw, runs).decode()

    return _resized(_rewritten(joined, names, docs.columns.index("text"), rewrite, ["spans"]).toDF(*docs.columns))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: spans of test phrases go from every text."""
    return _resized(decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids of every text, their number, and the sha256 of the text that the ids decode to."""
    model = sentencepiece_codec.default_model()
    kept = [c for c in docs.columns if c not in ("ids", "n_tokens", "decoded_sha256")]
    rows, names = _numbered(docs.select(*kept))
    back = sentencepiece_codec.encode_and_decode(rows, model, names[kept.index("text")])
    return back.toDF(*kept, "ids", "n_tokens", "decoded_sha256")


STAGES = [
    ("language ID", keep_known_languages),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("suffix-array dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_benchmark_passages),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: SQL has none of XXH64, the automata or the classifier; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after all stages.  A stage's intermediate tables, and the rows before it, are deleted once its own are written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with made_here() as paths:
            docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
        for path in before + paths[:-1]:
            drop_path(spark, path)
        before = paths[-1:]
    return docs

"""Quality rules: fixed base rules, then thresholds adapted to each language and source.

The adaptive limits come from mergeable quantile sketches.  A sketch is a set of (bin, count) rows with
log-linear bins of at most 1/16 relative width, computed by integer arithmetic: two sketches merge by adding
counts, so that map-side sums build them for any number of rows, a hot source included, and the result is the
same in every run.  A measure fails above its group's median by more than ``SPREAD * (median - lower quantile)``
and by more than a small margin, and above a ceiling.  Low-side quantiles are used because up to a third of a group
may be junk.  A group of fewer than ``LEAST_ROWS`` rows takes the quantiles of its language, a small language those
of all rows.

Defined cases: a null text has no words and fails the base rules; null ``lang`` or ``source`` form groups of
their own; rows are judged one by one, repeated rows alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwick.llm.common import materialise, table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: measure -> (margin above the median, ceiling) in thousandths.  On labelled texts of quality 1 of sf0.1 (3,302 that pass
#: the base rules) 99.8 % stay within 0, 333, 211, 26 and 28 of their group's median, all within 0, 333, 281, 35 and 46.
LIMITS = {
    "symbol_share": (20, 200),
    "dup_line_share": (340, 600),
    "repeat_share": (210, 300),
    "upper_share": (70, 600),
    "stutter_share": (90, 500),
}
LEAST_ROWS = 100
LOW, MIDDLE, SPREAD = 0.10, 0.50, 4
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_alpha", "n_stutter"]
CHUNK = 1 << 20


def text_counts(raw: bytes) -> tuple[int, ...]:
    """COUNTS of one UTF-8 text."""
    import numpy as np

    hist = np.zeros(256, np.int64)
    for at in range(0, len(raw), CHUNK):
        hist += np.bincount(np.frombuffer(raw, np.uint8, min(CHUNK, len(raw) - at), at), minlength=256)
    words = raw.split()  # bytes split on 0x20 and 0x09-0x0D alone
    chars = int(hist[:128].sum() + hist[192:].sum()) - int(hist[32] + hist[9:14].sum())
    symbols = int(sum(hist[c] for c in b"#*$%&|<>"))
    upper = int(hist[65:91].sum())
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    stutter = sum(map(eq, words, words[1:]))  # words that repeat the one before
    return len(words), chars, symbols, dup, repeated_words(words), lines, upper, upper + int(hist[97:123].sum()), stutter


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more."""
    import numpy as np

    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        ids = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        ids = (ids ^ (ids >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        ids ^= ids >> np.uint64(32)
        key = np.zeros(n, np.uint64)
        for k in range(width):
            key = key * np.uint64(0x9FB21C651E98DF25) + ids[k : k + n]
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(same):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    hit = np.unique(np.concatenate([order[same], order[same + 1]]))
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_counts(t or b"") for t in batch.column(3).to_pylist()]
        counts = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(COUNTS))]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)] + counts, ["doc_id", "lang", "source", *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS and the shares (in thousandths) of every row."""
    cols = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    share = lambda a, b: F.when(F.col(b) > 0, F.expr(f"least(1000, 1000 * {a} div {b})")).otherwise(0).cast("int")
    return (
        cols.mapInArrow(_count, schema)
        .withColumn("symbol_share", share("n_symbols", "word_chars"))
        .withColumn("dup_line_share", share("n_dup_lines", "n_lines"))
        .withColumn("repeat_share", share("n_repeat_words", "n_words"))
        .withColumn("upper_share", share("n_upper", "n_alpha"))
        .withColumn("stutter_share", share("n_stutter", "n_words"))
    )


def bin_of(value: Column) -> Column:
    """The bin of a non-negative integer: exact below 32, then 16 bins an octave."""
    top = F.length(F.bin(value.cast("long"))) - 1
    return F.when(value < 32, value.cast("int")).otherwise(
        (32 + (top - 5) * 16 + F.call_function("shiftright", value.cast("int"), (top - 4).cast("int")) - 16).cast("int")
    )


def upper_edge(bin_: Column) -> Column:
    """The largest integer of a bin."""
    octave = F.floor((bin_ - 32) / 16).cast("int")
    first = F.call_function("shiftleft", (16 + (bin_ - 32) % 16).cast("int"), (octave + 1).cast("int"))
    return F.when(bin_ < 32, bin_).otherwise(first + F.call_function("shiftleft", F.lit(1), (octave + 1).cast("int")) - 1)


def sketch(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """A quantile sketch of each value for each group: keys, measure, bin, n."""
    stacked = rows.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(v).alias("measure"), bin_of(F.col(v)).alias("bin")) for v in values])).alias("m")
    )
    return stacked.groupBy(*keys, "m.measure", "m.bin").agg(F.count(F.lit(1)).alias("n"))


def merge(first: DataFrame, second: DataFrame) -> DataFrame:
    """The sketch of both inputs' rows."""
    keys = [c for c in first.columns if c != "n"]
    return first.unionByName(second).groupBy(*keys).agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, keys: list[str], qs: dict[str, float]) -> DataFrame:
    """For each group and measure the upper edges of the bins that hold the quantiles."""
    group = Window.partitionBy(*keys, "measure")
    seen = F.sum("n").over(group.orderBy("bin"))
    run = sketches.withColumn("seen", seen).withColumn("total", F.sum("n").over(group))
    picks = [F.min(F.when(F.col("seen") >= F.col("total") * q, F.col("bin"))).alias(name) for name, q in qs.items()]
    out = run.groupBy(*keys, "measure").agg(*picks)
    return out.select(*keys, "measure", *[upper_edge(F.col(n)).alias(n) for n in qs])


def thresholds(measures: DataFrame) -> DataFrame:
    """One row for each (lang, source): the limit of each measure."""
    own = sketch(measures, ["lang", "source"], list(LIMITS))
    pool = lambda level, lang, source: own.groupBy(
        F.lit(level).alias("level"), lang.alias("lang"), source.alias("source"), "measure", "bin"
    ).agg(F.sum("n").alias("n"))
    none = F.lit(None).cast("string")
    pools = pool(0, F.col("lang"), F.col("source")).unionByName(pool(1, F.col("lang"), none)).unionByName(pool(2, none, none))
    q = quantiles(pools, ["level", "lang", "source"], {"low": LOW, "middle": MIDDLE})
    pick = lambda m, margin, hi: F.max(
        F.when(F.col("measure") == m, F.least(F.lit(hi), F.col("middle") + F.greatest(F.lit(margin), SPREAD * (F.col("middle") - F.col("low")))))
    ).alias(f"max_{m}")
    limits = q.groupBy("level", "lang", "source").agg(*[pick(m, margin, hi) for m, (margin, hi) in LIMITS.items()])
    sizes = own.filter(F.col("measure") == next(iter(LIMITS))).groupBy("lang", "source").agg(F.sum("n").alias("rows"))
    sizes = sizes.withColumn("of_lang", F.sum("rows").over(Window.partitionBy("lang")))
    level = F.when(F.col("rows") >= LEAST_ROWS, 0).when(F.col("of_lang") >= LEAST_ROWS, 1).otherwise(2)
    groups = sizes.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), level.alias("g_level"))
    same = (
        (F.col("level") == F.col("g_level"))
        & F.col("lang").eqNullSafe(F.when(F.col("g_level") < 2, F.col("g_lang")))
        & F.col("source").eqNullSafe(F.when(F.col("g_level") < 1, F.col("g_source")))
    )
    return groups.join(limits, same).select(F.col("g_lang").alias("lang"), F.col("g_source").alias("source"), *[f"max_{m}" for m in LIMITS])


def judge(docs: DataFrame) -> DataFrame:
    """Counts, base_failed and kept of every row."""
    m = materialise(measure(docs), "quality")
    t = thresholds(m).withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    joined = m.join(t, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    within = F.lit(True)
    for name in LIMITS:
        within = within & (F.col(name) <= F.coalesce(F.col(f"max_{name}"), F.lit(1000)))
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & within)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

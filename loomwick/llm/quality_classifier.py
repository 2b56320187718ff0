"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every word has a sparse ternary index vector made from its hash.  Its context vector is the sum of the index
vectors of its neighbours in the training texts, kept for hashed words; a word's vector joins both with the
vector of its shape (capitals, digits, signs).  A document pools its words' vectors (mean and spread, how
alike neighbours are, how many words differ), and a numpy network with one hidden layer scores it.  The logit is
divided by a temperature fitted on a part of the training rows that the network did not see.

The classifier is fitted on about ``TRAIN_ROWS`` labelled texts at most (a hash of the id picks them, whatever their
length): the bound of this classifier.  Executors read these texts, whole; the driver gets sums for each word bucket and one
row of features a text.  Scoring covers every row and whole texts.  Inputs are texts alone.

Defined cases: a null or empty text is scored as a text without words; without labels of both kinds every
score is the share of label 1 (0.5 if there is no label); labels other than 0 and 1 are ignored; a null ``doc_id``
is not held out; repeated rows score alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import held_out_by, materialise, table

TRAIN_ROWS = 6000
DIM, NONZERO, NEAR = 32, 4, 2
BUCKETS = 1 << 14
HIDDEN, EPOCHS, RATE, DECAY, SEED = 24, 60, 0.01, 1e-4, 11
CACHE_WORDS = 200_000
#: Words of a text whose neighbours are summed in one step.
STEP = 1 << 15
TOKEN = re.compile(r"\w+|[^\w\s]+")
SHAPES = 6


def shape_of(word: str) -> int:
    if not (word[0].isalnum() or word[0] == "_"):
        return 0 if len(word) > 1 else 1
    if any(c.isdigit() for c in word):
        return 2
    if len(word) > 1 and word.isupper():
        return 3
    return 4 if word[0].isupper() else 5


def index_vectors(hashes):
    """Sparse ternary vectors of unit length for 64-bit hashes."""
    import numpy as np

    out = np.zeros((len(hashes), DIM), np.float32)
    rows = np.arange(len(hashes))
    for k in range(NONZERO):
        part = (hashes >> np.uint64(13 * k)).astype(np.int64) & 0x1FFF
        out[rows, part % DIM] += np.where(part & 0x1000, 1.0, -1.0)
    return out / np.sqrt(NONZERO)


class Vectors:
    """Word vectors of a worker; context: the learned table, or None while it is being learned."""

    def __init__(self, context=None):
        import numpy as np

        self.context = context
        self.shapes = np.random.default_rng(SEED).standard_normal((SHAPES, DIM)).astype(np.float32) / np.sqrt(DIM)
        self.known: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.known.clear()
        self.size = 0
        self.index = np.zeros((4096, DIM), np.float32)
        self.full = np.zeros((4096, DIM), np.float32)
        self.bucket = np.zeros(4096, np.int64)
        self.shape = np.zeros(4096, np.int64)

    def rows(self, words: list[str]):
        """Row numbers of the words."""
        import numpy as np
        from xxhash import xxh3_64_intdigest as digest

        found = list(map(self.known.get, words))
        if None in found:
            new = list(dict.fromkeys(w for w, k in zip(words, found, strict=True) if k is None))
            h = np.array([digest(w.encode("utf-8", "surrogatepass")) for w in new], np.uint64)
            need = self.size + len(new)
            while need > len(self.index):
                grow = lambda x: np.concatenate([x, np.zeros_like(x)])
                self.index, self.full, self.bucket, self.shape = map(grow, (self.index, self.full, self.bucket, self.shape))
            at = slice(self.size, need)
            self.index[at] = index_vectors(h)
            self.bucket[at] = (h >> np.uint64(49)).astype(np.int64) % BUCKETS
            self.shape[at] = [shape_of(w) for w in new]
            full = self.index[at] * 0.5 + self.shapes[self.shape[at]]
            if self.context is not None:
                full = full + self.context[self.bucket[at]]
            self.full[at] = full
            self.known.update(zip(new, range(self.size, need), strict=True))
            self.size = need
            found = list(map(self.known.__getitem__, words))
        return np.array(found, np.int64)

    def pooled(self, texts: list[str | None]):
        """The feature rows of texts."""
        import numpy as np

        if self.size > CACHE_WORDS:
            self.clear()
        out = np.zeros((len(texts), 2 * DIM + 3 + SHAPES), np.float32)
        for k, text in enumerate(texts):
            words = TOKEN.findall(text or "")
            if not words:
                continue
            rows = self.rows(words)
            distinct, times = np.unique(rows, return_counts=True)
            share = (times / len(rows)).astype(np.float32)
            v = self.full[distinct]
            mean = share @ v
            out[k, :DIM] = mean
            out[k, DIM : 2 * DIM] = np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))
            step = rows[1:] == rows[:-1]
            out[k, 2 * DIM] = step.mean() if len(step) else 0
            out[k, 2 * DIM + 1] = len(distinct) / len(rows)
            out[k, 2 * DIM + 2] = np.log1p(len(rows))
            by_shape = np.bincount(self.shape[distinct], weights=share, minlength=SHAPES)
            out[k, 2 * DIM + 3 :] = np.log(1e-3 + by_shape)
        return out


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket and the sum of its words' neighbours' index vectors, in halves: integers, so that sums repeat exactly."""
    import numpy as np

    vec, out = Vectors(), np.zeros((BUCKETS, DIM), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if vec.size > CACHE_WORDS:
                vec.clear()
            rows = vec.rows(TOKEN.findall(text or ""))
            for a in range(0, len(rows), STEP):
                lo, hi = max(0, a - NEAR), min(len(rows), a + STEP + NEAR)
                index = (vec.index[rows[lo:hi]] * np.float32(np.sqrt(NONZERO))).astype(np.int64)
                near = np.zeros_like(index)
                for d in range(1, NEAR + 1):
                    if len(index) > d:
                        near[d:] += index[:-d]
                        near[:-d] += index[d:]
                part = slice(a - lo, min(len(rows), a + STEP) - lo)
                np.add.at(out, vec.bucket[rows[lo:hi][part]], near[part])
    used = np.flatnonzero(out.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(out[used, k]) for k in range(DIM)]], ["bucket", *[f"v{k}" for k in range(DIM)]])


def learn_context(sample: DataFrame):
    """Unit context vectors of hashed words: at most BUCKETS rows of sums reach the driver."""
    import numpy as np

    names = [f"v{k}" for k in range(DIM)]
    sums = sample.select("text").mapInArrow(_neighbours, "bucket long, " + ", ".join(f"{v} long" for v in names))
    got = sums.groupBy("bucket").agg(*[F.sum(v).alias(v) for v in names]).toArrow()
    out = np.zeros((BUCKETS, DIM), np.float32)
    out[got.column(0).to_numpy()] = np.stack([got.column(v).to_numpy() for v in names], 1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


def _features(context):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        vectors = Vectors(context.value)
        for batch in batches:
            x = vectors.pooled(batch.column(3).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], lists], ["doc_id", "th", "quality", "x"])

    return run


def fit(x, y):
    """The network and its temperature, as a dict of arrays."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    z = np.clip((x - mean) / spread, -8, 8)
    order = rng.permutation(len(z))
    cut = max(1, len(z) // 5)
    held, fitted = order[:cut], order[cut:] if len(z) > 10 else order
    p = {
        "w1": rng.standard_normal((z.shape[1], HIDDEN)) / np.sqrt(z.shape[1]),
        "b1": np.zeros(HIDDEN),
        "w2": rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN),
        "b2": np.zeros(1),
    }
    m, v, t = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(fitted), max(1, len(fitted) // 64)):
            a, target = z[part], y[part]
            h = np.tanh(a @ p["w1"] + p["b1"])
            d = (1 / (1 + np.exp(-(h @ p["w2"] + p["b2"]))) - target) / len(part)
            back = np.outer(d, p["w2"]) * (1 - h * h)
            g = {"w1": a.T @ back + DECAY * p["w1"], "b1": back.sum(0), "w2": h.T @ d + DECAY * p["w2"], "b2": d.sum(keepdims=True)}
            t += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    p |= {"mean": mean, "spread": spread, "temperature": np.ones(1)}
    raw = logits(p, x[held])
    loss = lambda temp: float(np.logaddexp(0, -np.where(y[held] == 1, 1, -1) * raw / temp).mean())
    p["temperature"] = np.array([min(np.geomspace(0.5, 20, 60).tolist(), key=loss)])
    return p


def logits(p, x):
    import numpy as np

    z = np.clip((x - p["mean"]) / p["spread"], -8, 8)
    return (np.tanh(z @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]) / p["temperature"]


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS):
    """(context, network) from labelled rows that are not held out, or the share of label 1 where that is all there is."""
    import numpy as np

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(~held_out_by(3, 1) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    n = known.count()
    if not n:
        return 0.5
    pick = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < min(1.0, rows / n) * (1 << 20)
    text = F.col("text").cast("string")
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), text.alias("text"))
    sample = cols.join(F.broadcast(known.filter(pick)), "doc_id").select("doc_id", "th", "quality", "text")
    sample = materialise(sample, "sample")
    kinds = [r[0] for r in sample.select("quality").distinct().collect()]
    if len(kinds) < 2:
        return float(kinds[0]) if kinds else 0.5
    context = learn_context(sample)
    shared = docs.sparkSession.sparkContext.broadcast(context)
    got = sample.mapInArrow(_features(shared), "doc_id long, th long, quality int, x array<float>").toArrow()
    doc, th, y = (got.column(k).to_numpy() for k in range(3))
    x = got.column(3).combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    order = np.lexsort((y, th, doc))
    return context, fit(x[order], y[order].astype(np.float64))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        got = model.value
        vectors = Vectors(got[0]) if isinstance(got, tuple) else None
        for batch in batches:
            if vectors is None:
                score = np.full(batch.num_rows, got)
            else:
                score = 1 / (1 + np.exp(-logits(got[1], vectors.pooled(batch.column(2).to_pylist()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out_by(3, 1).alias("held_out"), F.col("text").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x DIM floats and a small network
    return cols.mapInArrow(_score(shared), "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))

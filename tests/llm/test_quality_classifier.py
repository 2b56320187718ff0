import random
import zlib

from loomwick.llm import quality_classifier as op


def tables(spark):
    rnd = random.Random(1)
    good = [f"word{k}" for k in range(80)]
    docs, labels = [(9000, None), (9001, ""), (None, "word1 word2")], [(9000, 0), (None, 1), (5, None), (7, 9)]
    for k in range(600):
        words = [rnd.choice(good) for _ in range(rnd.randint(10, 80))]
        bad = k % 3 == 0
        if bad:
            words = [w + rnd.choice(["***", "$$$"]) for w in words] if k % 2 else [w for w in words[:5] for _ in range(9)]
        docs.append((k, " ".join(words)))
        labels.append((k, int(not bad)))
    docs.append(docs[-1])
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as quality", "2 as score")
    return d, spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    rows = op.score(docs, op.train(docs, labels)).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id < 600 and truth[r.doc_id] in (0, 1)]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (9000, 9001)}) == 1


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = tables(spark)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(string(doc_id) as binary)) % 3 = 1, 1 - quality, quality) as quality")
    a, b = (op.score(docs, op.train(docs, x)).orderBy("doc_id").limit(50).collect() for x in (labels, flipped))
    assert [r.score for r in a] == [r.score for r in b]


def test_few_labels_and_empty_tables(spark):
    docs, labels = tables(spark)
    assert op.train(docs, labels.filter("false")) == 0.5
    assert op.train(docs, labels.filter("quality = 1")) == 1.0
    assert op.score(docs.filter("false"), 0.5).collect() == []


def test_temperature_calibrates():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    p = 1 / (1 + np.exp(-op.logits(op.fit(x, y), x)))
    assert abs(p[(p > 0.2) & (p < 0.8)].mean() - y[(p > 0.2) & (p < 0.8)].mean()) < 0.06


def plain_context(texts):
    """Sums of neighbours' index vectors, word by word."""
    import numpy as np
    from xxhash import xxh3_64_intdigest as digest

    out = np.zeros((op.BUCKETS, op.DIM))
    for text in texts:
        words = op.TOKEN.findall(text or "")
        h = np.array([digest(w.encode()) for w in words], np.uint64)
        index = op.index_vectors(h) if words else None
        for i in range(len(words)):
            for j in range(max(0, i - op.NEAR), min(len(words), i + op.NEAR + 1)):
                if i != j:
                    out[int(h[i] >> np.uint64(49)) % op.BUCKETS] += index[j]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def test_context_and_scores_equal_plain_code(spark, monkeypatch):
    import numpy as np

    docs, labels = tables(spark)
    some = docs.filter("doc_id < 40").select("text").repartition(3)
    texts = [r.text for r in some.collect()]
    want = plain_context(texts)
    assert np.allclose(op.learn_context(some), want, atol=1e-5)
    monkeypatch.setattr(op, "STEP", 5)  # the workers' own value stays; texts are cut in steps here
    parts = list(op._neighbours(iter([op.pa.RecordBatch.from_pydict({"text": texts})])))[0]
    sums = np.zeros((op.BUCKETS, op.DIM))
    sums[parts.column(0).to_numpy()] = np.stack([c.to_numpy() for c in parts.columns[1:]], 1)
    assert np.allclose(sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9), want, atol=1e-5)

    context, net = model = op.train(docs, labels)
    shapes = np.random.default_rng(op.SEED).standard_normal((op.SHAPES, op.DIM)).astype(np.float32) / np.sqrt(op.DIM)

    def score(text):
        from xxhash import xxh3_64_intdigest as digest

        words, x = op.TOKEN.findall(text or ""), np.zeros(2 * op.DIM + 3 + op.SHAPES)
        if words:
            kinds = [op.shape_of(w) for w in words]
            v = np.array([op.index_vectors(np.array([digest(w.encode())], np.uint64))[0] / 2 + shapes[k] + context[(digest(w.encode()) >> 49) % op.BUCKETS] for w, k in zip(words, kinds, strict=True)])
            x[: op.DIM], x[op.DIM : 2 * op.DIM] = v.mean(0), v.std(0)
            x[2 * op.DIM] = np.mean([a == b for a, b in zip(words, words[1:], strict=False)]) if len(words) > 1 else 0
            x[2 * op.DIM + 1 : 2 * op.DIM + 3] = len(set(words)) / len(words), np.log1p(len(words))
            x[2 * op.DIM + 3 :] = np.log(1e-3 + np.bincount(kinds, minlength=op.SHAPES) / len(words))
        z = np.clip((x - net["mean"]) / net["spread"], -8, 8)
        return 1 / (1 + np.exp(-(np.tanh(z @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"])[0] / net["temperature"][0]))

    got = op.score(docs, model).join(docs.select("doc_id", "text").distinct(), "doc_id").collect()
    assert len(got) > 500 and all(abs(r.score - score(r.text)) < 1e-3 for r in got)


def test_long_texts_take_part_in_the_fit(spark):
    rows = [(k, ("good words here " if k % 2 else "*** $$$ ### ") * (30_000 if k < 8 else 10)) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, quality int")
    got = op.score(docs, op.train(docs.filter("doc_id < 8"), labels)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)

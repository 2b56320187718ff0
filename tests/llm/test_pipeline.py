"""The pipeline's rows against plain code for every stage, on a small planted corpus."""

import random

import pytest
from pyspark.sql import functions as F
from test_decontamination import words as bench_words

import corpus_pipeline
from loomwick.llm import decontamination, language_id, sentencepiece_codec, suffix_dedup

WORDS = {
    "en": "the of and to in that it was for with his they are have from which one you were her all she there would their we him been has when who".split(),
    "de": "der die und den das von sie ist des sich mit dem dass ein nicht eine als auch es an werden aus er hat nach wird bei einer um am sind".split(),
}


def corpus():
    rnd = random.Random(8)
    made = lambda lang, n: " ".join(rnd.choice(WORDS[lang]) + (str(rnd.randint(0, 9)) if rnd.random() < 0.3 else "") for _ in range(n))
    rows = [(k, made(lang := rnd.choice(["en", "de"]), rnd.randint(30, 160)), lang) for k in range(80)]
    passage, bench = made("en", 70), [(k, made("de", 14)) for k in range(4)]
    for k in range(10):
        rows.append((100 + k, made("en", 40) + " " + passage + " ÉÉ " + made("en", 40), "en"))
    rows += [(200 + k, f"{made('de', 30)}\n{bench[k][1].upper()}; {made('de', 30)}", "de") for k in range(4)]
    rows += [(300, rows[0][1], "en"), (301, rows[1][1] + " more", "en"), (302, None, "en"), (303, "12 34 !!", "en"), (None, made("en", 50), "en"), rows[3]]
    return rows, bench


@pytest.fixture
def folder(spark, tmp_path):
    rows, bench = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'src' as source", "cast(length(text) as bigint) as n_chars")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def without_repeats(texts, length=200):
    raws, seen = [t.encode() for t in texts], {}
    for r, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            seen.setdefault(raw[i : i + length], []).append((r, i))
    marks = [[] for _ in raws]
    for places in seen.values():
        if len(places) > 1:
            for r, i in places:
                marks[r].append((i, i + length))
    out = []
    for raw, m in zip(raws, marks, strict=True):
        gone = {b for a, e in m for b in range(a, e)}
        chars, at = [], 0
        for c in raw.decode():
            n = len(c.encode())
            if not set(range(at, at + n)) <= gone:
                chars.append(c)
            at += n
        out.append("".join(chars))
    return out


def without_phrases(text, bench):
    w = bench_words(text)
    spans = [(a, a + n) for _, t in bench for g in [bench_words(t)] for n in [min(10, len(g))] for k in range(max(1, len(g) - 9)) for a in range(len(w) - n + 1) if w[a : a + n] == g[k : k + n]]
    return decontamination.without_spans(text, decontamination.union(spans)) if spans else text


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def similarity(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def smallest_ids(rows):
    """The smallest id of each text's component, by links of a similarity of 0.8 or more by five-word shingles."""
    kept, out = {}, {}
    for i, t in rows:
        kept.setdefault(t, []).append(i)
    left = set(kept)
    while left:
        todo, group = [left.pop()], []
        while todo:
            a = todo.pop()
            group.append(a)
            near = [b for b in left if similarity(a, b) >= 0.8]
            left -= set(near)
            todo += near
        out |= dict.fromkeys(group, min(i for t in group for i in kept[t]))
    return out


def test_run_equals_plain_code(spark, folder):
    rows, bench = corpus()
    model = language_id.train(spark.read.parquet(f"{folder}/documents.parquet"))
    lang, score, _ = language_id.Judge(model).judge([t for _, t, _ in rows])
    kept = [(i, t) for (i, t, _), x, s in zip(rows, lang, score, strict=True) if x != "und" and s >= corpus_pipeline.LEAST_SCORE]
    assert {i for i, _ in kept} == {i for i, _, _ in rows} - {302, 303}
    ids = [(i if i is not None else 10**9, t) for i, t in kept]
    comp = smallest_ids(ids)
    kept = dict((i, t) for i, t in ids if comp[t] == i)
    assert 300 not in kept and 301 not in kept and 10**9 in kept and 0 in kept
    texts = without_repeats(list(kept.values()))
    want = {i: without_phrases(t, bench) for i, t in zip(kept, texts, strict=True)}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r.doc_id if r.doc_id is not None else 10**9): r.text for r in got} == want and len(got) == len(want)
    codec = sentencepiece_codec.Codec(sentencepiece_codec.default_model())
    assert all(codec.decode(r.ids) == r.text and r.n_tokens == len(r.ids) and r.n_chars == len(r.text) for r in got)
    assert all(want[200 + k] != rows[90 + k][1] for k in range(4)) and all(len(want[100 + k]) < 600 for k in range(10) if 100 + k in want)


def test_stages_keep_columns_and_take_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 as spans", "2 as fp", "3 as hit_items")
    for source in (docs, docs.filter("false")):
        d = source
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, folder)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            d = out.cache()
        assert (d.count() > 0) == (source is docs)
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "language ID" and suffix_dedup.LENGTH == 200


def test_names_of_columns_and_rows_that_differ_elsewhere(spark, folder):
    """Columns called like a stage's own pass through; of rows with one id and one text the first by their other columns stays."""
    own = "__id __th th id of key root c0 c1 c7 n spans __spans size fp keys h1 h2 heavy_key n_words hit_spans".split()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.selectExpr(*[f"concat('{c}', doc_id) as `{c}`" for c in own], "*", "map('a', 1) as m", "'mine' as decoded", "7 as n_tokens")
    twice = docs.filter("doc_id = 50").selectExpr("*").withColumn("fp", F.lit("zz")).unionByName(docs)
    twice = twice.unionByName(docs.filter("doc_id = 50").withColumn("fp", F.lit("aa")))
    d = twice
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        path = f"{folder}/{name.replace(' ', '_')}"
        out.write.parquet(path)
        d = spark.read.parquet(path)
    rows = d.collect()
    assert len(rows) > 50 and sum(r.doc_id == 50 for r in rows) == 1
    for r in rows:
        assert all(r[c] == (f"{c}{r.doc_id}" if r.doc_id is not None else None) for c in own if (c, r.doc_id) != ("fp", 50))
        assert r.m == {"a": 1} and r.decoded == "mine" and r.n_tokens == len(r.ids)
    assert next(r.fp for r in rows if r.doc_id == 50) == "aa"


def test_intermediate_tables_go(spark, folder):
    import os

    from loomwick.llm import common

    root = common.shared_dir(spark).removeprefix("file:").replace("//", "/")
    before = set(os.listdir(root))
    out = corpus_pipeline.run(spark, folder)
    assert len(set(os.listdir(root)) - before) == 1 and out.count() > 0

import hashlib
import random
import re

from loomwick.llm import decontamination as op


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        if i is not None:
            for a in range(max(1, len(w) - 9) if w else 0):
                windows.setdefault(tuple(w[a : a + 10]), set()).add(str(i))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for g, ids in windows.items():
            for a in range(len(w) - len(g) + 1):
                if tuple(w[a : a + len(g)]) == g:
                    hit |= set(range(a, a + len(g)))
                    found |= ids
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def data():
    rnd = random.Random(4)
    vocab = ["a", "B", "c3", "é", "日本", "x_y", "d-e", "f'g"]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(k, text(rnd.randint(1, 30))) for k in range(2, 14)]
    items += [(20, ""), (21, None), (22, "..."), (None, "a B c3"), (3, text(12)), (4, items[0][1])]
    docs = [(1, None), (2, ""), (3, "?"), (4, "a")]
    for k in range(50):
        t = text(rnd.randint(0, 40))
        if rnd.random() < 0.5:
            t += "\n" + (rnd.choice(items)[1] or "").upper() + "! " + text(5)
        docs.append((10 + k, t + " zzz " + text(3)))
    return [*docs, docs[-1], (99, "a B " * 3000)], items


def test_equals_brute_force_in_one_block_and_in_many(spark):
    docs, items = data()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as hit_items")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (op.BLOCK_BYTES, 150):
        got = sorted((tuple(r) for r in op.digest(op.scan(d, b, block_bytes=block)).collect()), key=str)
        assert got == brute(docs, items)


def test_cut_texts_are_the_same_in_many_blocks(spark):
    """A benchmark of hundreds of blocks: one job each, and the same texts; columns called like ours stay."""
    docs, items = data()
    items = items + [(1000 + k, f"q{k} other words {k}") for k in range(100)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("text", "doc_id", "1 as h1", "'x' as c0", "2 as n")
    b = spark.createDataFrame(items, "item_id long, text string")
    one = op.clean(d, b)
    assert len(op.list_blocks(b, 100)) > 20
    many = op.clean(d, b, block_bytes=100)
    assert one.columns == many.columns == d.columns
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)


def test_long_phrases_alone(spark):
    docs, items = data()
    items = [(i, t) for i, t in items if len(words(t)) >= 10]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in op.digest(op.scan(d, b)).collect()), key=str) == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op.digest(op.scan(spark.createDataFrame([], "doc_id long, text string"), none)).collect() == []
    row = op.digest(op.scan(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_without_spans():
    assert op.without_spans("One, two; three. Four", [(1, 3)]) == "One, . Four"
    assert op.without_spans("é b", [(0, 1)]) == " b"

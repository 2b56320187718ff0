"""The near-copy stage against exact similarities of all pairs."""

import random

from test_pipeline import grams, similarity

import corpus_pipeline
from loomwick.llm import near_copies as op
from loomwick.llm import simhash


def changed(rnd, words, n):
    words = list(words)
    for k in rnd.sample(range(len(words)), n):
        words[k] = f"new{rnd.getrandbits(30)}"
    return words


def corpus():
    rnd = random.Random(4)
    rows = []
    for k in range(25):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(150, 300))]
        rows += [(len(rows) + j, " ".join(changed(rnd, base, j * rnd.randint(1, 4)))) for j in range(4)]
    base = [f"x{rnd.randrange(400)}" for _ in range(200)]
    rows += [(1000 + k, " ".join(changed(rnd, base, rnd.randint(1, 3)))) for k in range(60)]  # one large group
    rows += [(2000 + k, t) for k, t in enumerate(["One two", "one  TWO", "two one", "a b c d e f", "a b c d e f g", None, "", " \n"])]
    return rows


def kept_by_all_pairs(rows):
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    sets = [grams(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {rows[k][0] for k in range(len(rows)) if find(k) == k}


def test_stage_equals_all_pairs(spark):
    rows = corpus()
    want = kept_by_all_pairs(rows)
    # pairs of 0.8 and more beyond the four bits of op9
    wide = [
        (a, b) for i, (_, a) in enumerate(rows[:100]) for _, b in rows[:i]
        if similarity(a, b) >= 0.8 and (simhash.fingerprint(a.encode()) ^ simhash.fingerprint(b.encode())).bit_count() > simhash.RADIUS
    ]
    assert len(wide) > 10
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, df, "").collect()]
    assert sorted(got) == sorted(want)


def test_blocks_lose_no_link(spark, monkeypatch):
    """Shards cut into blocks of a few members give the components of all pairs."""
    monkeypatch.setattr(op, "BLOCK_MEMBERS", 5)
    monkeypatch.setattr(op, "SEARCH_MEMBERS", 12)
    rnd = random.Random(6)
    base = [f"y{rnd.randrange(400)}" for _ in range(160)]
    rows = [(k, " ".join(changed(rnd, base, rnd.randint(1, 9)))) for k in range(70)]
    want = kept_by_all_pairs(rows)
    assert 1 < len(want) < 70
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, df, "").collect()]
    assert sorted(got) == sorted(want)


def test_similarity_is_exact():
    words = [f"w{k}" for k in range(13)]
    nine = op.shingles(" ".join(words).encode())
    assert len(nine) == 9
    assert op.similar(nine, nine[:8]) and not op.similar(nine, nine[:7])
    assert op.similar_to(nine, [nine[:8], nine[:7], nine]) == [True, False, True]
    assert op.similar(nine[:5], nine[:4]) and not op.similar(nine[:4], nine[1:5])


def test_one_id_on_texts_of_two_components(spark):
    one, two = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(5, one), (5, two), (6, one + " end"), (7, two + " end"), (5, one)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.keep_one_of_near_copies(spark, df, "").collect()
    assert sorted(map(tuple, got)) == [(5, one), (5, two)]

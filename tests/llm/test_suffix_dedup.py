import hashlib
import random

import numpy as np
import pytest

from loomwick.llm import suffix_dedup as op


def brute(rows, length):
    where = {}
    raws = [(t or "").encode() for _, t in rows]
    for r, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            where.setdefault(raw[i : i + length], []).append((r, i))
    gone = [bytearray(len(raw)) for raw in raws]
    for places in where.values():
        if len(places) > 1:
            for r, i in places:
                gone[r][i : i + length] = b"\1" * length
    out = []
    for (doc_id, _), raw, g in zip(rows, raws, gone, strict=True):
        kept = bytes(b for b, x in zip(raw, g, strict=True) if not x)
        spans = sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1]))
        out.append((doc_id, len(raw), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(seed, length):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(1, 8)))
    free = lambda n: " ".join(word() for _ in range(n))
    shared = [free(rnd.randint(5, 120)) for _ in range(6)]
    out = [(1, None), (2, ""), (3, "x" * (length - 1)), (4, "x" * length), (5, "ab" * length), (None, "no id " * 60), (None, "no id " * 60)]
    for k in range(60):
        text = free(rnd.randint(0, 60)) + rnd.choice(shared) + free(rnd.randint(0, 60))
        if rnd.random() < 0.4:
            text += rnd.choice(shared)
        if rnd.random() < 0.2:
            text += "Spam " * rnd.randint(1, 150)
        out.append((10 + k, text))
    out += [(200, out[-1][1]), (201, out[-2][1] + "!"), out[-3]]
    same = free(80)
    return out + [(300 + k, free(9) + same + free(9)) for k in range(40)]


@pytest.mark.parametrize(("length", "shard"), [(200, op.SHARD_BYTES), (40, op.SHARD_BYTES), (64, 3000)])
def test_equals_brute_force(spark, length, shard):
    data = rows(length + shard % 7, length)
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as lo", "2 as fp")
    got = [tuple(r) for r in op.digest(df, length, shard).collect()]
    assert sorted(got, key=str) == brute(data, length)


@pytest.mark.parametrize(("anchor_bytes", "levels"), [(1500, 8), (600, 2), (600, 0)])
def test_large_anchors_are_dealt_again(spark, anchor_bytes, levels):
    """Anchors too large for a shard: by further anchors, and by whole windows where none are left."""
    data = rows(11, 64)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in op.digest(df, 64, 3000, anchor_bytes, levels).collect()]
    assert sorted(got, key=str) == brute(data, 64)


def test_windows_of_a_step(spark, monkeypatch):
    """Texts longer than a step of the anchor search."""
    monkeypatch.setattr(op, "CHUNK", 100)
    data = rows(12, 40)[:40]
    for _, text in data:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        first, count, place, _ = op.anchors(raw, 40, 32)
        assert int(count.sum()) == max(0, len(raw) - 39) and all(f <= p <= f + 8 + c - 1 for f, c, p in zip(first, count, place, strict=True))


def test_matching_statistics():
    rnd = random.Random(1)
    parts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 60))) for _ in range(40)] + [b"a" * 50, b"b"]
    index = op.RunLengthIndex(parts)
    text, ends = b"".join(parts), index.end.tolist()

    def lcp(i, j):
        k = 0
        while i + k < ends[i] and j + k < ends[j] and text[i + k] == text[j + k]:
            k += 1
        return k

    n = len(text)
    assert index.matching_statistics().tolist() == [max(lcp(i, j) for j in range(n) if j != i) for i in range(n)]
    assert len(index.heads) < n


def test_empty_table(spark):
    assert op.digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_whole_characters():
    raw = "aéb€c".encode()
    assert op.whole_characters(raw, [(0, 2)]) == [(0, 1)]
    assert op.whole_characters(raw, [(2, 6)]) == [(3, 4)]
    assert op.whole_characters(raw, [(1, 3)]) == [(1, 3)]

import random

import xxhash

from loomwick.llm import simhash as op


def slow_fingerprint(text):
    words = []
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in lowered:
        if c in " \t\n\x0b\x0c\r":
            words.append("")
        else:
            words = words or [""]
            words[-1] += c
    words = [w for w in words if w]
    if not words:
        return 0
    n = min(4, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(rows, radius=4):
    fps = {}
    for i, fp in rows:
        fps.setdefault(fp, []).append(i)
    left, out = set(fps), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            a = todo.pop()
            group.append(a)
            near = [b for b in left if (a ^ b).bit_count() <= radius]
            left -= set(near)
            todo += near
        least = min((i for f in group for i in fps[f] if i is not None), default=None)
        out |= dict.fromkeys(group, least)
    return out


def texts():
    rnd = random.Random(3)
    words = [f"w{k}É" for k in range(60)]
    out = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "ONE two\x0bthree"), (None, "lost id")]
    for k in range(60):
        base = [rnd.choice(words) for _ in range(rnd.randint(3, 200))]
        for _ in range(rnd.randint(1, 4)):
            if rnd.random() < 0.7:
                base[rnd.randrange(len(base))] = "new"
            out.append((100 + len(out), " ".join(base)))
    return [*out, out[-1]]


def test_equals_brute_force(spark):
    rows = texts()
    got = op.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    comp = slow_components(fps)
    assert sorted((r.doc_id or -1, r.fp % 2**64, r.component_id or -1) for r in got) == sorted((i or -1, f, comp[f] or -1) for i, f in fps)
    assert op.near_duplicates(spark.createDataFrame([], "doc_id long, text string, fp int")).count() == 0


def test_dense_and_hot_keys(spark):
    rnd = random.Random(5)
    values = set()
    for _ in range(4):
        centre = rnd.getrandbits(64)
        for _ in range(300):
            v = centre
            for _ in range(rnd.randint(0, 3)):
                v ^= 1 << rnd.randrange(64)
            values.add(v)
    for _ in range(200):
        v = rnd.getrandbits(64)
        for _ in range(4):
            values.add(v)
            for b in rnd.sample(range(64), 4):
                v ^= 1 << b
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    comp = slow_components([(v, v) for v in values])
    want = {}
    for v, c in comp.items():
        want.setdefault(c, set()).add(v)
    for hot in (50, op.HOT):
        pairs = [(r.a % 2**64, r.b % 2**64) for r in op.near_links(df, hot=hot).collect()]
        assert len(pairs) < 100 * len(values)
        roots = {r.node % 2**64: r.root % 2**64 for r in op.components(op.near_links(df, hot=hot)).collect()}
        got = {}
        for v in values:
            got.setdefault(roots.get(v, v), set()).add(v)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))

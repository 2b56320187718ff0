"""Components and spread joins against plain code."""

import random

import pytest

from loomwick.llm import common, components


def plain(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        up[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(up) if top(x) != x}


def edges():
    rnd = random.Random(2)
    out = [(-5, k) for k in range(100, 900)]  # one hot centre
    out += [(2000 + k, 2001 + k) for k in range(60)]  # a chain
    out += [(rnd.randrange(5000, 5400), rnd.randrange(5000, 5400)) for _ in range(220)]
    return [*out, out[0], (7, 7), (3000, -(1 << 62))]


@pytest.mark.parametrize("local", [components.LOCAL_EDGES, 300])
def test_components(spark, monkeypatch, local):
    """In one task, and by rounds of stars over several."""
    monkeypatch.setattr(components, "LOCAL_EDGES", local)
    links = edges()
    got = components.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()
    assert {r.node: r.root for r in got} == plain(links) and len({r.node for r in got}) == len(got)
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_contraction_in_small_steps(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(components, "LOCAL_EDGES", 7)
    links = [(max(a, b), min(a, b)) for a, b in edges() if a != b]
    u, v = zip(*links, strict=True)
    stars = list(components._contract(iter([pa.RecordBatch.from_pydict({"u": u, "v": v})])))
    assert len(stars) > 50 and all(b.num_rows <= 14 for b in stars)
    assert plain([p for b in stars for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]) == plain(links)


def test_spread_join_keeps_every_row(spark):
    big = spark.createDataFrame([(k % 7 if k > 900 else 1, k) for k in range(1300)] + [(99, -1)], "key long, x long")
    small = spark.createDataFrame([(k, 10 * k, sum(1 for j in range(1300) if (j % 7 if j > 900 else 1) == k)) for k in range(7)], "key long, y long, n long")
    for how, extra in (("inner", []), ("left", [(99, -1, None)])):
        got = common.spread_join(big, small, ["key"], 1301, how)
        assert got.columns == ["key", "x", "y"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(r.key, r.x, 10 * r.key) for r in big.filter("key < 99").collect()] + extra, key=str)

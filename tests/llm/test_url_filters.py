import random

from loomwick.llm import url_filters as op


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [r for r in rules if None not in r and (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0] == "block"), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


def test_equals_brute_force(spark):
    rnd = random.Random(2)
    label = lambda: rnd.choice(["a", "b", "ab", "org", "com", "x-y", "é"])
    host = lambda n: ".".join(label() for _ in range(rnd.randint(1, n)))
    path = lambda: "".join(rnd.choice(["/", "a", "b", "1"]) for _ in range(rnd.randint(0, 5)))
    rules = [(rnd.choice(["allow", "block"]), host(3), path()) for _ in range(120)]
    rules += [("block", "org", None), (None, "org", "/"), rules[0], ("block", "ORG", "/")]
    urls = [None, "", "no scheme", "://", "http://", "http://A.Org/a?x#y", "http://a.org?/a", "x://u@a.org:80/a", "http://a.org./a", "http://a\nb.org/a"]
    urls += ["https://a.org/a"] * 300
    urls += [f"http://{host(5)}{path()}{rnd.choice(['', '?q=/b', '#f'])}" for _ in range(800)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'h' as host", "1 as key", "2 as bucket")
    got = {r.page_id: tuple(r)[1:] for r in op.judge(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()}
    assert got == {k: brute(u, rules) for k, u in enumerate(urls)}


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    assert op.judge(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    row = op.judge(spark.createDataFrame([(None, "http://a.b/c")], "page_id long, url string"), rules).first()
    assert tuple(row) == (None, "a.b", "/c", None, "allow")

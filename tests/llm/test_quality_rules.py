import random
import re

from pyspark.sql import functions as F

from loomwick.llm import quality_rules as op


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.append(line)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def rows():
    rnd = random.Random(1)
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "é#|\x85\u2003x"), (5, "a b\na b\n\na b\r"), (6, "w " * 5000)]
    for k in range(40):
        lines = [" ".join(rnd.choice(["one", "two", "été", "x*", "<b>"]) for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 8))]
        out.append((10 + k, rnd.choice(["\n", "\r\n", "\n\n"]).join(lines)))
    return [*out, out[-1]]


def test_counts_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows()], "doc_id long, text string, lang string, source string, n_words int")
    got = op.judge(df).collect()
    want = {i: brute(t) for i, t in rows()}
    assert len(got) == len(rows())
    for r in got:
        n, *_, rep = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
        assert not (r.kept and r.base_failed)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert op.judge(empty).collect() == []


def test_bins_and_merged_sketches(spark):
    v = spark.range(0, 200_000).select(F.col("id").alias("v"))
    b = v.select("v", op.bin_of(F.col("v")).alias("b")).select("v", "b", op.upper_edge(F.col("b")).alias("e"))
    assert b.filter("e < v or (v >= 32 and e - v > v / 16) or (v < 32 and e <> v)").count() == 0
    assert b.groupBy("b").agg(F.max("v").alias("m"), F.first("e").alias("e")).filter("m <> e and m < 190000").count() == 0
    part = [v.filter(f"v % 3 = {k}").withColumn("g", F.lit("x")) for k in range(3)]
    s = op.merge(op.merge(*[op.sketch(p, ["g"], ["v"]) for p in part[:2]]), op.sketch(part[2], ["g"], ["v"]))
    whole = op.sketch(v.withColumn("g", F.lit("x")), ["g"], ["v"])
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, whole.collect()))
    q = op.quantiles(s, ["g"], {"half": 0.5, "high": 0.9}).first()
    assert 100_000 <= q.half <= 107_000 and 180_000 <= q.high <= 192_000


def test_thresholds_follow_the_group(spark):
    clean = [(k, " ".join(f"w{(k * 7 + j * j) % 97}{j}" for j in range(60)), "en", "a") for k in range(60)]
    junk = [(1000 + k, " ".join(f"w{(k + j * j) % 97}{j}***" for j in range(60)), "en", "a") for k in range(25)]
    kept = {r.doc_id: r.kept for r in op.judge(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[k] for k in range(60)) and not any(kept[1000 + k] for k in range(25))


def plain_kept(rows):
    """Verdicts by sorted lists of each group's values, without sketches or joins."""
    import math

    measures = list(op.LIMITS)
    pairs = [("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_upper", "n_alpha"), ("n_stutter", "n_words")]
    found = []
    for doc, text, lang, source in rows:
        c = dict(zip(op.COUNTS, op.text_counts((text or "").encode()), strict=True))
        found.append((doc, lang, source, c, [min(1000, 1000 * c[a] // c[b]) if c[b] else 0 for a, b in pairs]))

    def edge(v):
        step = 1 << max(0, v.bit_length() - 5)
        return v if v < 32 else v // step * step + step - 1

    def limit(values, measure):
        at = lambda q: edge(sorted(values)[max(0, math.ceil(len(values) * q) - 1)])
        margin, ceiling = op.LIMITS[measure]
        return min(ceiling, at(op.MIDDLE) + max(margin, op.SPREAD * (at(op.MIDDLE) - at(op.LOW))))

    out, limits = {}, set()
    for doc, lang, source, c, shares in found:
        group = [f for f in found if f[1:3] == (lang, source)]
        if len(group) < op.LEAST_ROWS:
            group = [f for f in found if f[1] == lang]
        if len(group) < op.LEAST_ROWS:
            group = found
        own = tuple(limit([f[4][k] for f in group], m) for k, m in enumerate(measures))
        limits.add(own)
        failed = c["n_words"] < op.MIN_WORDS or 100 * c["n_repeat_words"] > op.MAX_REPEAT_PERCENT * c["n_words"]
        out[doc] = not failed and all(x <= y for x, y in zip(shares, own, strict=True))
    return out, limits


def test_verdicts_equal_plain_code(spark):
    """Groups of their own, of their language, and of all rows: each row's verdict, and limits that differ."""
    import random

    rnd = random.Random(9)
    rows = []
    for lang, source, n, shout in (("en", "a", 140, 0.5), ("en", "b", 40, 0.1), ("fr", "a", 20, 0.1), (None, None, 130, 0.02), ("de", None, 120, 0.3)):
        for _ in range(n):
            words = [w.upper() if rnd.random() < shout * rnd.random() else w for w in (f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(26))}" for _ in range(rnd.randint(15, 80)))]
            if rnd.random() < 0.3:
                words = [w + "#" * rnd.randint(0, 2) for w in words]
            if rnd.random() < 0.3:
                words = [x for w in words for x in [w] * rnd.choice([1, 1, 1, 2])]
            lines = [" ".join(words[a : a + 9]) for a in range(0, len(words), 9)]
            rows.append((len(rows), "\n".join(lines + lines[: rnd.choice([0, 0, 1, 2])]), lang, source))
    rows += [(9000, None, "en", "a"), (9001, "", None, None)]
    want, limits = plain_kept(rows)
    got = {r.doc_id: r.kept for r in op.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)).collect()}
    assert got == want and len(limits) == 5 and 50 < sum(want.values()) < len(rows) - 50
    # no set of limits common to all groups gives these verdicts: the groups' own quantiles decide some
    each = list(limits)
    common = [min(x[k] for x in each) for k in range(5)], [max(x[k] for x in each) for k in range(5)]
    assert common[0] != common[1]

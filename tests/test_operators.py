import datetime as dt
import random

from pyspark.sql import functions as F

from loomwick.operators import merge, mining, qc, routing, sequential, subtitles
from loomwick.schemas import BLANK_SUMMARY, GONE_SUMMARY, ITEM

def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def items(spark, rows):
    """Archive rows from dicts; ord is the place."""
    full = [(k, *[r.get(f) for f in ITEM.names]) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, "ord long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ITEM))


def raws(spark, rows):
    cols = "ord long, category string, source string, title string, url string, published_at timestamp, feed_url string, content string, images array<string>"
    base = {"category": "c", "source": "s", "feed_url": "", "content": "", "images": []}
    return spark.createDataFrame([(k, *[({**base, **r}).get(c.split()[0]) for c in cols.split(", ")[1:]]) for k, r in enumerate(rows)], cols)


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_dedupe_folds_in_two_passes(spark):
    same = {"published_at": "2024-01-01", "source": "s", "url": "u"}
    rows = [
        {"id": "a", **same, "summary": "longer text ↛", "last_seen_at": "2024-02-01"},
        {"id": "b", **same, "summary": "short", "last_seen_at": "2024-03-01", "thumbnail": "t"},
        {"id": "c", "url": "x", "summary": " "}, {"id": "c", "url": "y", "title": "T", "length": 5}, {"id": "d", "summary": None}, {"id": "d", "summary": " "}, {"id": None, "url": "z"},
    ]
    got = by_id(merge.dedupe(items(spark, rows)))
    assert set(got) == {"a", "c", "d"}
    assert (got["a"].summary, got["a"].last_seen_at, got["a"].thumbnail) == ("short", "2024-03-01", "t")
    assert (got["c"].summary, got["c"].url, got["c"].title, got["c"].length) == (" ", "x", "T", 5)
    assert got["d"].summary is None  # a blank mark in another row alone is lost
    again = by_id(merge.dedupe(merge.dedupe(items(spark, rows))))
    assert {k: tuple(v) for k, v in again.items()} == {k: tuple(v) for k, v in got.items()}


def test_ingest_rules(spark):
    at = lambda d: dt.datetime(2024, 5, d)
    fetched = [
        {"title": " New ", "url": "https://e.org/n?utm_source=x", "published_at": at(1), "content": ""},
        {"title": "NEW", "url": "https://E.org/n", "published_at": None, "content": "copy", "images": ["i"]},
        {"title": "New", "url": "https://e.org/n", "published_at": None, "content": "later"},
        {"title": "", "url": "https://e.org/x"}, {"title": "t", "url": "ftp://e.org/x"}, {"title": "t", "url": "nothing"},
    ]
    out = merge.ingest(items(spark, []), raws(spark, fetched), now())
    (row,) = out.collect()
    assert (row.title, row.url, row.published_at, row.last_seen_at) == ("New", "https://e.org/n", "2024-05-01T00:00:00Z", "2024-06-01T00:00:00Z")
    assert (row.feed_content, row.feed_images) == ("copy", ["i"])
    stored = out.withColumn("summary", F.lit("done")).drop("feed_content", "feed_images")
    (row,) = merge.ingest(stored, raws(spark, [{"title": "New", "url": "https://e.org/n", "published_at": at(9), "content": "x"}]), now()).collect()
    assert (row.published_at, row.summary, row.feed_content) == ("2024-05-09T00:00:00Z", "done", None)
    twice = merge.ingest(merge.ingest(items(spark, []), raws(spark, fetched), now()).drop("feed_content", "feed_images"), raws(spark, fetched), now())
    assert [tuple(r)[1:] for r in twice.drop("ord").collect()] == [tuple(r)[1:] for r in out.drop("ord").collect()]


def test_heal_rekeys_moved_urls(spark):
    rows = [{"id": "0" * 40, "category": "c", "source": "s", "title": "t", "url": "https://e.org/a/?utm_source=1", "summary": "x"}, {"id": "1" * 40, "url": "https://e.org/b"}]
    got = {r.url: r.id for r in merge.heal(items(spark, rows)).collect()}
    assert got["https://e.org/b"] == "1" * 40 and got["https://e.org/a"] != "0" * 40


def test_retention_order_and_pending(spark):
    rows = [{"id": "a", "last_seen_at": "2024-05-02T00:00:00Z"}, {"id": "b", "published_at": "2024-05-01T23:59:59Z"}, {"id": "c"}, {"id": "d", "last_seen_at": "2024-05-20"}, {"id": "e", "last_seen_at": "2024-05-02T00:00:00Z"}]
    kept = merge.retain(items(spark, rows), now(), 30)
    assert [r.id for r in merge.archive_order(kept).collect()] == ["d", "a", "e", "c"]
    states = items(spark, [{"url": "u", "summary": s} for s in (None, "", " ", "x")] + [{"summary": None}])
    assert [r[0] for r in states.orderBy("ord").select(merge.pending(F.col("summary"), F.col("url"))).collect()] == [True, True, False, False, False]
    assert merge.top_by(states, [F.col("ord")], 0).count() == 0 and merge.top_by(states, [F.col("ord")], 0, none_means_all=True).count() == 5
    assert [r.ord for r in merge.first_rows(states.withColumn("url", F.lit("u")), ["url"]).collect()] == [0]
    assert merge.numbered(states.withColumn("url", F.lit("u")), ["url"], [F.col("ord")], 2).count() == 2


def test_tracks_and_files(spark):
    maps = spark.createDataFrame([("a", {"live-chat": 1, "en": 1}, {"zh-Hant": 1}, "en"), ("b", {}, {"ja": 1, "zh-Hans-en": 1}, "ja"), ("c", {"rechat": 1}, {}, "en")], "id string, m map<string,int>, s map<string,int>, orig string")
    got = {r.id: (r.manual, r.lang) for r in subtitles.choose_track(subtitles.tracks_of_maps(maps, "m", "s"), ["id"]).collect()}
    assert got == {"a": (True, "en"), "b": (False, "ja")}
    x, y, z = "a" * 40, "b" * 40, "c" * 40
    files = spark.createDataFrame([(f"{x}.en.en.vtt",), (f"{x}.en.zh-TW.vtt",), (f"{x}.part",), (f"{y}.und.fr.vtt",), (f"{z}.x.vtt",)], "name string")
    assert {r.item_id: r.name for r in subtitles.pick_subtitle(files).collect()} == {x: f"{x}.en.zh-TW.vtt", y: f"{y}.und.fr.vtt"}
    assert {r.name for r in subtitles.surplus_files(files).collect()} == {f"{x}.en.en.vtt", f"{x}.part"}
    known = items(spark, [{"id": x}, {"id": "d" * 40}])
    assert {r.name for r in subtitles.orphan_files(files, known).collect()} == {f"{y}.und.fr.vtt", f"{z}.x.vtt"}
    assert subtitles.orphan_files(files, known.filter("false")).count() == 0
    assert [r.id for r in subtitles.without_transcript(known, files).collect()] == ["d" * 40]


def test_vtt_is_monotone(spark):
    seg = "s array<struct<start:double,end:double,text:string>>"
    df = spark.createDataFrame([([(1.0, 2.0, "a"), (1.5, 1.7, " a "), (1.0, 5.0, "b"), (9.0, 8.0, "\n")],), ([(-1.0, -2.0, "x  y")],), ([],)], seg)
    got = [r[0] for r in df.select(subtitles.to_vtt(F.col("s"))).collect()]
    assert got == ["WEBVTT\n\n00:00:01.000 --> 00:00:02.500\na\n\n00:00:02.500 --> 00:00:05.000\nb\n", "WEBVTT\n\n00:00:00.000 --> 00:00:00.500\nx y\n", ""]
    rnd = random.Random(0)
    rows = [([(rnd.uniform(-5, 50), rnd.uniform(-5, 50), rnd.choice("ab ")) for _ in range(30)],) for _ in range(10)]
    for r in spark.createDataFrame(rows, seg).select(subtitles.clamp_cues(F.col("s")).alias("c")).collect():
        assert all(c.start < c.end for c in r.c) and all(a.end <= b.start and a.text != b.text for a, b in zip(r.c, r.c[1:], strict=False))


def test_budget_and_islands(spark):
    df = spark.createDataFrame([([4.0, 7.0, 5.0, 1.0, 9.0],)], "d array<double>")
    out = df.select(sequential.greedy_budget(F.col("d"), 10.0).alias("o")).first().o
    assert [x.accepted for x in out] == [True, False, True, True, False] and out[1].reason == "budget" and out[-1].left == 0
    out = df.select(sequential.greedy_budget(F.col("d"), 0, most=2, longest=6.0).alias("o")).first().o
    assert [x.reason for x in out] == [None, "too long", None, "count", "count"]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(["a", "a", None, None, "a"])], "k int, v string").withColumn("g", F.lit(1))
    assert [(r.v, r.first, r.last, r.n) for r in sequential.merge_equal_neighbours(rows, ["g"], "k", "v").orderBy("first").collect()] == [("a", 0, 1, 2), (None, 2, 3, 2), ("a", 4, 4, 1)]
    hosts = spark.createDataFrame([(1, "h", False), (2, "h", True), (3, "h", False), (4, "i", False)], "o int, host string, b boolean")
    assert [r.paused for r in sequential.paused(hosts, "host", "o", "b").orderBy("o").collect()] == [False, False, True, False]
    for last in (0, 1, 2, 7, 100, 128):
        assert sequential.last_issue(lambda n, last=last: n <= last) == last
    assert sequential.last_issue({5, 6, 8, 12}.__contains__, known=5) == 8


def findings(spark, rows):
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, summary string, title string")
    return [r.finding for r in qc.inspect(df).orderBy("k").collect()]


def test_quality_findings(spark):
    long = "A sentence with enough words to be kept as it stands in the text. " * 3
    got = findings(spark, [
        ("slot gacor 加賴", ""), ("slot gacor", ""), ("slot gacor 加賴 police said", ""), ("slot gacor 加賴 daftar sekarang reported", ""), ("slot gacor casino", ""), ("slot gacor Rp 500", ""),
        ("Rp 500 casino", ""), ("cafÃ© time", ""), ("bad � char", ""), ("ha" * 40 + ". " + long, ""), ("ha" * 300, ""), (f"<p>{long}</p><b>", ""), ("<p>short", ""),
        (long + "<div><p><a><li><ul> " + " ".join(f"w{k}" for k in range(100)), ""), ("please enable JavaScript", ""), (None, ""), (BLANK_SUMMARY, ""), (GONE_SUMMARY, ""), (long, ""),
    ])
    kinds = [f and (f.category, f.action) for f in got]
    assert kinds == [
        ("spam", "blank"), None, None, ("spam", "blank"), ("spam", "blank"), ("spam", "blank"), None, ("garbled", "repair"), ("garbled", "refetch"), ("loop", "repair"), ("loop", "refetch"),
        ("scrape", "repair"), ("scrape", "refetch"), ("scrape", "repair"), ("scrape", "refetch"), None, None, None, None,
    ]
    assert got[0].detail == "promotion: slot gacor, 加賴" and got[7].fixed == "café time" and got[9].fixed.startswith("ha. ")
    fixed = [f.fixed for f in got if f and f.action == "repair"]
    assert findings(spark, [(t, "") for t in fixed]) == [None] * len(fixed)


def test_shared_texts(spark):
    body = "Quarterly report about shipping volumes in northern harbours and what drives them up. " * 2
    rows = [
        ("1", "Shipping volumes in harbours", "https://e.org/a/one"), ("2", "Cooking with garlic", "https://x.net/zz/other-thing"), ("3", "Football results", "https://y.com/undefined/"),
    ]
    make = lambda rs: items(spark, [{"id": i, "title": t, "url": u, "summary": body} for i, t, u in rs])
    got = by_id(qc.check_shared(make(rows)))
    assert set(got) == {"2", "3"} and got["3"].finding.detail.startswith("broken url")
    assert by_id(qc.check_shared(make([("1", "A", "https://e.org/a/one"), ("2", "B", "https://e.org/a/one2")]))) == {}
    assert by_id(qc.check_shared(make([("1", "Shipping volumes rise", "https://e.org/a/one"), ("2", "Shipping volumes fall", "https://qq.net/9")]))) == {}
    assert by_id(qc.check_shared(make([("1", "Same", "https://e.org/1"), ("2", "same!", "https://qq.net/9")]))) == {}
    applied = by_id(qc.apply(make(rows)))
    assert applied["1"].summary == body and applied["2"].summary is None and applied["2"].action == "refetch"
    video = by_id(qc.apply(make([rows[0], ("2", "Cooking", "https://youtu.be/abcdefghijk")])))
    assert video["2"].summary == BLANK_SUMMARY
    gated = by_id(qc.gate(make([rows[1]]), make([rows[0]])))
    assert gated["2"].summary == BLANK_SUMMARY
    assert by_id(qc.gate(make([("9", "Fine", "https://e.org/9")]), make([])))["9"].summary == body
    report = qc.report(qc.apply(make(rows))).collect()
    assert [(r.category, r.n) for r in report] == [("mismatch", 2)]


def test_mining(spark):
    df = spark.createDataFrame([("a", "Read more here. One."), ("b", "Read more here. Two!"), ("a", "Only in a\nOnly in a\nOnly in a")], "source string, summary string")
    got = {(r.kind, r.sentence, r.n, r.sources) for r in mining.mine_boilerplate(df, 2).collect()}
    assert got == {("shared", "Read more here.", 2, 2), ("single", "Only in a", 3, 1)}
    assert mining.mine_boilerplate(df, 2, ruled="^Read").count() == 1
    assert mining.most_common(df, "source", 1).first().n == 2


def test_routes(spark):
    rows = [
        ("https://skip.me/x", "t", "c", None, False, None), ("https://youtu.be/abcdefghijk", "t", None, None, False, "youtube"), ("https://open.firstory.fm/story/0123456789abcdefgh", "t", None, None, True, "podcast"),
        ("https://open.firstory.fm/story/0123456789abcdefgh", "t", "c", None, False, None), ("https://movie.douban.com/1", "看过某片", "", None, False, "douban"), ("https://movie.douban.com/1", "看过某片", None, None, False, None),
        ("https://feed.org/1", "t", "copy", None, False, "feed"), ("https://feed.org/1", "t", " ", ["i"], False, "feed"), ("https://feed.org/1", "t", " ", None, False, "fetch"), ("https://e.org", "t", None, None, False, "fetch"),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, u string, t string, c string, i array<string>, s boolean, want string")
    got = df.select("want", routing.route(F.col("u"), F.col("t"), F.col("c"), F.col("i"), F.col("s"), ["skip.me"], ["feed.org"]).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    states = [("fetch", "gone", None, GONE_SUMMARY), ("fetch", "blocked", None, None), ("fetch", "ok", "", BLANK_SUMMARY), ("fetch", "ok", "x", "x"), ("feed", None, "", BLANK_SUMMARY), (None, None, "x", None)]
    df = spark.createDataFrame([(k, *s) for k, s in enumerate(states)], "k int, route string, status string, built string, want string")
    assert [r.summary == r.want for r in routing.settle(df).collect()] == [True] * len(states)

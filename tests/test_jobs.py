import datetime as dt
import os
import sys

import pytest
from pyspark.sql import functions as F
from test_operators import items
from test_sources import ATOM, PREVIEW, RSS

from loomwick import providers
from loomwick.config import Config, Rules
from loomwick.operators import qc
from loomwick.plans import catalogue, formats, jobs, registry, rules  # noqa: F401  queries are registered on import
from loomwick.schemas import BLANK_SUMMARY, GONE_SUMMARY
from loomwick.streaming import upsert

LONG = "The harbour opened again on Monday after the storm. " * 6


def at(text):
    return F.lit(text).cast("timestamp")


def test_collect(spark):
    pages = spark.createDataFrame([("https://e.org/rss", RSS), ("https://a.org/atom", ATOM), ("https://t.me/s/chan", PREVIEW)], "url string, html string")
    feeds = [(0, "F", "c", "", "rss", "https://e.org/rss", False), (1, "G", "c", "", "rss", "https://e.org/rss", False), (2, "A", "c", "", "rss", "https://a.org/atom", False), (3, "T", "c", "", "telegram", "https://t.me/s/chan", False), (4, "X", "c", "", "rss", "https://gone.org", False)]
    feeds = spark.createDataFrame(feeds, "ord long, title string, category string, home string, parser string, url string, youtube_page boolean")
    fetcher = providers.TableFetcher(pages)
    raws, failed = jobs.fetch_feeds(feeds, fetcher)
    assert raws.count() == 4 and [r.url for r in failed.collect()] == ["https://gone.org"]
    old = items(spark, [{"id": "0" * 40, "title": "old", "url": "https://o.org", "last_seen_at": "2020-01-01T00:00:00Z"}, {"id": "1" * 40, "title": "new", "url": "https://o.org/2", "last_seen_at": "2024-05-30T00:00:00Z"}])
    out = jobs.collect(old, feeds, fetcher, at("2024-06-01"))
    assert {r.title for r in out.collect()} == {"new", "One", "Two", "quoted"}
    again = jobs.collect(out.drop("feed_content", "feed_images"), feeds, fetcher, at("2024-06-01"))
    assert {r.id for r in again.collect()} == {r.id for r in out.collect()}


def test_media(spark):
    rows = [{"id": str(k) * 40, "url": "https://e.org", "published_at": f"2024-05-0{k + 1}T00:00:00Z"} for k in range(4)]
    tracks = spark.createDataFrame([("0" * 40, "en", True, "en")], "id string, lang string, manual boolean, orig string")
    durations = spark.createDataFrame([("1" * 40, 50.0), ("2" * 40, 80.0), ("3" * 40, 60.0)], "id string, duration double")
    segs = spark.createDataFrame([("3" * 40, [(0.0, 1.0, "hi")]), ("1" * 40, [(0.0, 1.0, "no")])], "id string, segments array<struct<start:double,end:double,text:string>>")
    out = jobs.media(items(spark, rows), tracks, durations, providers.TableTranscriber(segs), Config(max_asr_total=100.0))
    got = {r.id[0]: (r.origin, r.reason, r.vtt) for r in out.collect()}
    assert got["0"] == ("track", "en", None) and got["2"][:2] == ("refused", "budget") and got["1"][:2] == ("refused", "budget")
    assert got["3"][2] == "WEBVTT\n\n00:00:00.000 --> 00:00:01.000\nhi\n"


def test_summarize_and_backfill(spark):
    page = f"<title>T</title><p>{LONG}</p>"
    rows = [
        {"id": "a", "url": "https://e.org/a", "title": "Harbour opened"}, {"id": "b", "url": "https://e.org/gone", "title": "x"}, {"id": "c", "url": "https://skip.me/c", "title": "x"},
        {"id": "d", "url": "https://feed.org/d", "title": "x"}, {"id": "e", "url": "https://e.org/e", "title": "x", "summary": "kept " * 20}, {"id": "f", "url": "https://e.org/spam", "title": "x"},
        {"id": "g", "url": "https://youtu.be/abcdefghijk", "title": "x"}, {"id": "h", "url": "https://youtu.be/abcdefghij2", "title": "x"},
    ]
    df = items(spark, rows).withColumn("feed_content", F.when(F.col("id") == "d", "the feed's own copy of it")).withColumn("feed_images", F.lit(None).cast("array<string>"))
    pages = spark.createDataFrame([("https://e.org/a", page), ("https://e.org/spam", "<p>" + "slot gacor casino now. " * 12)], "url string, html string")
    texts = spark.createDataFrame([("g", "what was said")], "id string, text string")
    rules = Rules(sites={"skip_hosts": ["skip.me"], "feed_first_hosts": ["feed.org"]})
    out = {r.id: r.summary for r in jobs.summarize(df, texts, providers.TableFetcher(pages), Config(), rules).collect()}
    assert out["a"] == "T\n" + LONG.strip() or out["a"] == LONG.strip()
    assert (out["b"], out["c"], out["d"], out["g"]) == (GONE_SUMMARY, None, "the feed's own copy of it", "what was said")
    assert out["e"] == "kept " * 20 and out["f"] == BLANK_SUMMARY and out["h"] == BLANK_SUMMARY
    none = {r.id: r.summary for r in jobs.summarize(df, texts, providers.TableFetcher(pages), Config(max_items=0), rules).collect()}
    assert none["a"] is None and none["g"] == "what was said"
    stored = items(spark, [{"id": "a", "title": "t", "url": "https://e.org", "summary": "Read more. " + LONG, "thumbnail": "http://e.org/tokyo-rent.jpg?imageView2/1"}, {"id": "b", "title": "t", "url": "https://e.org", "summary": "cafÃ© open", "thumbnail": "http://e.org/logo.svg"}])
    fixed = {r.id: r for r in jobs.backfill(stored, providers.IdentityTranslator(), rules=Rules(boilerplate=("Read more\\.",))).collect()}
    assert (fixed["a"].summary, fixed["a"].thumbnail) == (LONG.strip(), "http://e.org/tokyo-rent.jpg") and (fixed["b"].summary, fixed["b"].thumbnail) == ("café open", None)


def test_stages_run_only_for_open_rows(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    answer = lambda known: lambda left: left.select("url", F.when(F.col("url").isin(known), F.concat("url", F.lit(str(len(known))))).alias("body"), F.lit("ok").alias("status"))
    got = {r.url: (r.body, r.stage) for r in jobs.staged(urls, [("one", answer(["a"])), ("two", answer(["a", "b"]))]).collect()}
    assert got == {"a": ("a1", "one"), "b": ("b2", "two"), "c": (None, None)}


def test_streams(spark, tmp_path):
    rows = [(k, dt.datetime(2024, 1, 1, 0, k), f"u{k % 2}", 1.0) for k in range(10)] + [(99, dt.datetime(2024, 1, 1, 0, 0), "u0", 5.0)]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "event_id long, ts timestamp, user string, value double").coalesce(1).write.parquet(src)
    stream = lambda: spark.readStream.schema("event_id long, ts timestamp, user string, value double").parquet(src)

    def drained(df, name, mode="append"):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination()
        return spark.table(name).collect()

    full = {(r.start.minute, r.n, r.total) for r in drained(upsert.windows(stream(), "ts", "1 hour", "5 minutes"), "w", "complete")}
    assert full == {(0, 6, 10.0), (5, 5, 5.0)}
    assert {(r.user, r.n) for r in drained(upsert.sessions(stream(), "ts", "1 hour", "3 minutes", "user"), "s", "complete")} == {("u0", 6), ("u1", 5)}
    assert len(drained(upsert.first_seen(stream(), ["user"], "ts", "1 hour"), "f")) == 2
    assert {(r.key, r.n, r.expired) for r in drained(upsert.expiring_latest(stream(), "user", "ts", 60), "e", "update")} >= {("u0", 6, False), ("u1", 5, False)}


def test_stream_upsert_is_idempotent(spark, tmp_path):
    schema = "ord long, category string, source string, title string, url string, published_at timestamp, feed_url string, content string, images array<string>"
    src = str(tmp_path / "raws")
    spark.createDataFrame([(0, "c", "s", "T", "https://e.org/1", dt.datetime(2024, 5, 1), "", "x", [])], schema).write.parquet(src)

    def run():
        upsert.upsert(spark.readStream.schema(schema).parquet(src), str(tmp_path / "out"), str(tmp_path / "cp"), lambda: at("2024-06-01")).awaitTermination()

    run()
    run()
    spark.createDataFrame([(1, "c", "s", "t", "https://e.org/1?utm_source=x", dt.datetime(2024, 5, 3), "", "x", [])], schema).write.mode("append").parquet(src)
    run()
    (row,) = spark.read.parquet(str(tmp_path / "out" / "v=1")).collect()
    assert (row.title, row.published_at) == ("t", "2024-05-03T00:00:00Z")


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not mounted")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_catalogue_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, DATA)
    rows, cols = df.collect(), sorted(df.columns)
    if name not in registry.ORACLES:
        return
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    got = con.execute(registry.ORACLES[name])
    names = [d[0] for d in got.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else str(v).removesuffix(" 00:00:00") if isinstance(v, dt.date) else v
    assert sorted(names) == cols
    want = sorted(repr([plain(r[names.index(c)]) for c in cols]) for r in got.fetchall())
    assert sorted(repr([plain(r[c]) for c in cols]) for r in rows) == want


def test_listed_articles_of_large_pages(spark, tmp_path):
    """A channel's page of more than two million characters, with names that hold markup, lists every article."""
    duckdb = pytest.importorskip("duckdb")
    path = str(tmp_path / "part.parquet")
    name = F.concat(F.lit("</script> 'n\"o' é\\ "), F.repeat(F.lit("x"), 60), F.col("id"))
    parts = spark.range(22_000).select(F.col("id").alias("p_partkey"), name.alias("p_name"), F.when(F.col("id") < 20_000, "Brand#1").otherwise("Brand#2").alias("p_brand"))
    parts.write.parquet(path)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{path}/*.parquet'")
    want = con.execute(registry.ORACLES["listed_articles"]).fetchall()
    got = registry.QUERIES["listed_articles"](spark, str(tmp_path)).select("channel", "cid", "title", "at").collect()
    assert len(got) == 22_000 and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def documents_by_sql(spark, name, texts, folder):
    """The rows of a query over documents of these texts, three of each, and those of its SQL."""
    duckdb = pytest.importorskip("duckdb")
    path = str(folder / "documents.parquet")
    spark.createDataFrame([(k, t) for k, t in enumerate(x for t in texts for x in (t, t, t))], "doc_id long, text string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    got = con.execute(registry.ORACLES[name])
    names, want = [c[0] for c in got.description], got.fetchall()
    return sorted(map(tuple, registry.QUERIES[name](spark, str(folder)).select(*names).collect())), sorted(want)


def test_markdown_of_texts_without_a_word(spark, tmp_path):
    """Texts without two Latin letters in a row, and none at all; capitals whose lower case is an ASCII letter."""
    texts = ["", "x", "É", "a! b? 1 2", "中文", "Í, de", None, "İstanbul is", "İİ", "\u212aab", "A Word"]
    got, want = documents_by_sql(spark, "markdown_to_prose", texts, tmp_path)
    assert len(got) == 3 * len(texts) and got == want


def test_garbled_texts_with_other_letters(spark, tmp_path):
    """Letters outside the SQL's list leave a text whole; beside a listed one they are repaired with it."""
    texts = ["Ó y uecoez", "Í, de jaco", "Ç", "ÁÚÊ", "é", "Ó é €", "ß中文", "e\u0301", "plain", "", None, "Ω"]
    got, want = documents_by_sql(spark, "qc_garbled", texts, tmp_path)
    assert len(got) == 3 * len(texts) and got == want
    damaged = spark.createDataFrame([("Ó y Í".encode().decode("latin-1"),)], "x string")
    assert damaged.select(qc.check_garbled(F.col("x"))["fixed"]).first()[0] == "Ó y Í"

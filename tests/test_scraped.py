import datetime as dt

from pyspark.sql import functions as F
from test_functions import values
from test_operators import items

from loomwick.functions import media
from loomwick.sources import scraped


def test_tool_messages(spark):
    members = "x\nERROR: [youtube] a-b: Join this channel to get access to members-only content now"
    rows = [(members,), ("title: ERROR: [youtube] a: This video is available to this channel's members",), ("Cookies are no longer valid",), (None,), ("a\nb\nc",), ("ERROR: " + "x" * 400,)]
    assert values(spark, media.restricted(F.col("x")), rows, "x string") == ["members only", None, None, None, None, None]
    assert values(spark, media.cookies_rejected(F.col("x")), rows, "x string") == [False, False, True, False, False, False]
    got = values(spark, media.why_failed(F.col("x")), rows, "x string")
    assert got[0].startswith("ERROR: [youtube]") and got[3:] == ["no output", "b / c", ("ERROR: " + "x" * 400)[:300] + "..."]
    assert values(spark, media.not_yet(F.col("l"), F.col("s")), [(True, "is_upcoming"), (None, "is_upcoming"), (False, None)], "l boolean, s string") == ["still live", "not yet premiered", None]
    states = media.probe_outcome(F.col("e"), F.lit(False), F.col("s"), F.col("f"))["state"]
    assert values(spark, states, [(members, None, True), ("cookies have been rotated", None, True), ("x", None, True), ("", "is_live", False), ("", "", False)], "e string, s string, f boolean") == ["closed", "stop", "failed", "wait", "ready"]


def test_episode_audio(spark):
    json = '<script id="__NEXT_DATA__">{"a":{"eid":"e0","duration":5},"b":{"eid":"e1","duration":61.5}}</script>'
    rows = [
        ("u1", "e1", '<meta property="og:audio" content="https://x.org/a.m4a?b=1&amp;c=2">' + json), ("u2", "e2", r'{"enc":"https:\/\/x.org\/b.mp3","t":"12 分钟"}'), ("u3", "e3", "<p>none https://x.org/c.html</p>"),
    ]
    got = {r.url: (r.audio, r.seconds) for r in media.episodes_of_pages(spark.createDataFrame(rows, "url string, eid string, html string")).collect()}
    assert got == {"u1": ("https://x.org/a.m4a?b=1&c=2", 61.5), "u2": ("https://x.org/b.mp3", 720.0)}
    entries = spark.createDataFrame([(0, "f", "id-ABC", "https://x.org/1.html", "1"), (1, "f", "id-ABC", "https://x.org/1.mp3", "1:05"), (2, "f", "id-abc", "https://x.org/2.mp3", "9")], "ord long, feed string, where_text string, audio string, duration string")
    wanted = spark.createDataFrame([("abc", "f"), ("zzz", "f")], "sid string, feed string")
    assert [tuple(r) for r in media.episodes_of_feeds(entries, wanted).collect()] == [("abc", "https://x.org/1.mp3", 65.0)]


def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def test_listing_and_articles(spark):
    data = '<script id="__NEXT_DATA__" type="application/json">{"l":[{"contId":"111111","name":"A","pubTime":"2小时前"},{"contId":"222222","name":"B","link":"https://other.org/x"},{"contId":"111111","name":"later"},{"contId":333333,"title":"C","pubTimeLong":1714558830000}]}</script>'
    links = '<a href="/newsDetail_forward_444444"><img alt="T T">T T</a><a href="/newsDetail_forward_444444">Longer</a><a href="/newsDetail_forward_555555?commTag=1">no</a>'
    pages = spark.createDataFrame([("c1", data), ("c2", links)], "channel string, html string")
    listed = scraped.listing(pages, now())
    got = {(r.channel, r.cid): (r.title, r.at) for r in listed.collect()}
    assert got == {("c1", "111111"): ("A", dt.datetime(2024, 5, 31, 22)), ("c1", "333333"): ("C", dt.datetime(2024, 5, 1, 10, 20, 30)), ("c2", "444444"): ("Longer", None)}
    stored = items(spark, [{"id": "a", "url": scraped.ARTICLE_HOME + "111111", "summary": "x"}, {"id": "b", "url": scraped.ARTICLE_HOME + "444444", "published_at": "2024-01-01"}])
    assert {r.cid for r in scraped.open_articles(listed, stored).collect()} == {"333333", "444444"}
    body = "<p>" + "text " * 80 + "</p>"
    page = f'<script id="__NEXT_DATA__">{{"x":{{"contId":"9","content":"<p>{"other " * 200}</p>"}},"y":{{"contId":"444444","content":"{body}","pubTime":"2024-05-01 08:00"}}}}</script>'
    fetched = scraped.articles(spark.createDataFrame([("444444", page), ("333333", f"<article>{body}</article> 2024-05-02 10:00"), ("1", "<p>short</p>")], "cid string, html string"), now())
    got = {r.cid: (r.content[:9], r.at) for r in fetched.collect()}
    assert got == {"444444": ("text text", dt.datetime(2024, 5, 1)), "333333": ("text text", dt.datetime(2024, 5, 2, 2)), "1": ("", None)}
    raws = {r.url[-6:]: r for r in scraped.listing_raws(listed, fetched.filter("cid = '333333'"), stored, "c", "S").collect()}
    assert raws["333333"].published_at == dt.datetime(2024, 5, 2, 2) and raws["444444"].published_at == dt.datetime(2024, 1, 1) and raws["111111"].content == ""


def test_issues(spark):
    pages = spark.createDataFrame([(7, "<title>Issue 7 | BestBlogs.dev</title><main><p>2024-05-01</p>" + "<p>word</p>" * 200 + "</main>"), (8, '<title>Eight</title><meta property="article:published_time" content="6-30"><p>x</p>')], "n int, html string")
    got = {r.n: (r.title, len(r.content) > 500, r.at) for r in scraped.issues(pages, F.lit("2024-06-01").cast("date")).collect()}
    assert got == {7: ("Issue 7", True, dt.datetime(2024, 5, 1)), 8: ("Eight", False, dt.datetime(2023, 6, 30))}
    none, some = items(spark, [{"id": "x", "url": "https://e.org"}]), items(spark, [{"id": "x", "url": "https://www.bestblogs.dev/newsletter/issue5"}])
    assert scraped.new_issues(none, lambda n: n <= 9, lambda n: n < 8) == [8, 9]
    assert scraped.new_issues(some, {6, 8}.__contains__, lambda n: False) == [6, 8]

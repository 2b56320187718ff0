"""Registered queries of readers and writers: table rows are written in a format and read back; the SQL states the rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwick.functions import html
from loomwick.functions.dates import iso
from loomwick.operators import mining, subtitles
from loomwick.plans.registry import query, table
from loomwick.sources import archive, feeds, scraped, vtt


def _xml(c):
    """Text inside XML."""
    return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def _joined(rows, keys, order, piece):
    """The pieces of each key in order, as the column s."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("x"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["x"]), "").alias("s"))


# --- feeds --------------------------------------------------------------------------------------------------------


@query("""SELECT n_name AS category, s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'feed-' || s_suppkey || '.example.org' ELSE s_name || ' & "co"' END AS title, 'rss' AS parser,
 'https://feed-' || s_suppkey || '.example.org/rss?a=1&b=2' AS url, 'https://home/' || s_suppkey AS home FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey NOT IN (1, 3, 5)""")
def opml_feeds(spark, d):
    """Feed lists with nested outlines: a list for each nation, each feed twice, some feeds skipped."""
    rows = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey").cast("string")
    address = F.concat(F.lit("https://feed-"), k, F.lit(".example.org/rss?a=1&b=2"))
    title = F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.concat("s_name", F.lit(' & "co"')))
    one = F.concat(F.lit('<outline type="rss" xmlUrl="'), _xml(address), F.lit('" htmlUrl="https://home/'), k, F.lit('" title="'), _xml(title), F.lit('" category="'), F.col("n_name"), F.lit('"/>'))
    lists = _joined(rows, ["n_name"], "s_suppkey", F.concat(one, F.lit("<outline text='folder'>"), one, F.lit("</outline>")))
    lists = lists.select(F.concat(F.lit("<?xml version='1.0'?><opml><body>"), "s", F.lit("</body></opml>")).alias("xml"))
    outlines = lists.lateralJoin(feeds.Outlines(F.col("xml").outer()))
    found = feeds.feeds_of(outlines, ["https://feed-5.example.org/rss?a=1&b=2"], ["https://feed-1.", "https://feed-3."])
    return found.select("category", F.regexp_extract("url", r"feed-(\d+)", 1).try_cast("long").alias("s_suppkey"), "title", "parser", "url", "home")


_LINES = r"array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\n'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10))"


@query(f"""SELECT doc_id, coalesce(lang, 'none') AS source, 'doc ' || doc_id || ' <b> & "c"' AS title, epoch(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * doc_id) AS at,
 md5(left({_LINES}, 60000)) AS content, 'https://i.example.org/' || doc_id || '.png' AS image FROM documents WHERE doc_id % 11 <> 5""")
def rss_entries(spark, d):
    """Feeds of all documents, one for each language and source, half of them Atom; entries without a date are none."""
    rows = table(spark, d, "documents").withColumns({"lang": F.coalesce("lang", F.lit("none")), "source": F.coalesce("source", F.lit("none"))})
    k = F.col("doc_id").cast("string")
    at = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + 60 * F.col("doc_id"))
    title = F.concat(F.lit("doc "), k, F.lit(' <b> & "c"'))
    body = F.concat(F.lit("<div><img src='https://i.example.org/"), k, F.lit(".png'>"), F.replace(_xml(F.col("text")), F.lit("\n"), F.lit("<br>")), F.lit("</div><script>x()</script>"))
    link = F.concat(F.lit("https://example.org/d/"), k)
    shown = F.when(F.col("doc_id") % 11 != 5, at)
    rss = F.concat(
        F.lit("<item><title>"), _xml(title), F.lit("</title><link>"), link, F.lit("</link><description>short</description><content:encoded>"), _xml(body),
        F.lit("</content:encoded><pubDate>"), F.coalesce(F.date_format(shown, "EEE, d MMM yyyy HH:mm:ss Z"), F.lit("soon")), F.lit("</pubDate></item>"),
    )
    atom = F.concat(
        F.lit("<entry><title>"), _xml(title), F.lit('</title><link rel="self" href="https://x/"/><link href="'), link, F.lit('"/><summary>short</summary><content type="html">'), _xml(body),
        F.lit("</content><updated>"), F.coalesce(iso(shown), F.lit("")), F.lit("</updated></entry>"),
    )
    both = _joined(rows.withColumn("rss", rss).withColumn("atom", atom), ["lang", "source"], "doc_id", F.when(F.length("source") % 2 == 0, F.col("rss")).otherwise(F.col("atom")))
    is_rss = F.length("source") % 2 == 0
    xml = F.when(is_rss, F.concat(F.lit('<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>t</title>'), "s", F.lit("</channel></rss>"))).otherwise(
        F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'), "s", F.lit("</feed>"))
    )
    bodies = both.select(F.lit(1).cast("long").alias("ord"), F.col("lang").alias("title"), F.lit("c").alias("category"), F.lit("https://example.org/feed").alias("url"), xml.alias("body"))
    raws = feeds.parse_rss(bodies)
    return raws.select(
        F.regexp_extract("url", r"(\d+)\z", 1).cast("long").alias("doc_id"), "source", "title", F.unix_seconds("published_at").cast("double").alias("at"),
        F.md5(F.col("content").cast("binary")).alias("content"), F.try_element_at("images", F.lit(1)).alias("image"),
    )


_FLAT = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"


@query(f"""SELECT conv_id, turn, CASE WHEN length({_FLAT}) > 96 THEN rtrim(left({_FLAT}, 95)) || '…' ELSE {_FLAT} END AS title, md5(left({_LINES}, 60000)) AS content,
 epoch(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * turn) AS at FROM conversations WHERE {_FLAT} <> ''""")
def preview_posts(spark, d):
    """Conversations as channel previews: a page each, a post each turn, every second one with a quoted reply before it."""
    body = F.replace(_xml(F.col("text")), F.lit("\n"), F.lit("<br/>"))
    at = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + 60 * F.col("turn"))
    quoted = F.when(F.col("turn") % 2 == 1, '<a class="tgme_widget_message_reply"><time datetime="2000-01-01T00:00:00Z"></time><div class="other">quoted</div></a>').otherwise("")
    post = F.concat(
        F.lit('<div class="wrap"><div class="tgme_widget_message js" data-post="chan/'), F.col("turn") + 1, F.lit('">'), quoted, F.lit('<div class="tgme_widget_message_text js">'), body,
        F.lit('</div><time datetime="'), iso(at), F.lit('">t</time></div></div>'),
    )
    pages = _joined(table(spark, d, "conversations"), ["conv_id"], "turn", post)
    bodies = pages.select(F.col("conv_id").alias("ord"), F.lit("chan").alias("title"), F.lit("c").alias("category"), F.concat(F.lit("<html><body>"), "s", F.lit("</body></html>")).alias("body"))
    raws = feeds.parse_preview(bodies)
    return raws.select(
        F.floor(F.col("ord") / 1_000_000).alias("conv_id"), (F.regexp_extract("url", r"/(\d+)\z", 1).cast("long") - 1).alias("turn"), "title",
        F.md5(F.col("content").cast("binary")).alias("content"), F.unix_seconds("published_at").cast("double").alias("at"),
    )


@query(f"""SELECT conv_id, turn, CASE WHEN length({_FLAT}) > 96 THEN rtrim(left({_FLAT}, 95)) || '…' ELSE {_FLAT} END AS title, 'https://m.okjike.com/originalPosts/p' || conv_id || '_' || turn AS url
FROM conversations WHERE {_FLAT} <> '' AND turn % 5 <> 4""")
def embedded_posts(spark, d):
    """Conversations as pages that embed their posts as JSON; posts without a time are none."""
    rows = table(spark, d, "conversations")
    name = F.concat(F.lit("p"), F.col("conv_id"), F.lit("_"), F.col("turn"))
    made = F.when(F.col("turn") % 5 != 4, "2024-01-02T03:04:05.000Z")
    post = F.to_json(F.struct(name.alias("id"), F.col("text").alias("content"), F.when(F.col("turn") % 2 == 0, made).otherwise("").alias("createdAt"), made.alias("actionTime")))
    posts = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", post.alias("x")))), lambda p: p["x"]), ",").alias("s"))
    page = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"posts":['), F.replace("s", F.lit("</"), F.lit("<\\/")), F.lit("]}}}</script></html>"))
    bodies = posts.select(F.col("conv_id").alias("ord"), F.lit("t").alias("title"), F.lit("c").alias("category"), page.alias("body"))
    raws = feeds.parse_jike(bodies)
    key = r"p(\d+)_(\d+)\z"
    return raws.select(F.regexp_extract("url", key, 1).cast("long").alias("conv_id"), F.regexp_extract("url", key, 2).cast("long").alias("turn"), "title", "url")


# --- scraped sources ----------------------------------------------------------------------------------------------


@query("""SELECT p_brand AS channel, CAST(10000 + p_partkey AS VARCHAR) AS cid, p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN epoch(TIMESTAMP '2024-01-01 00:00:00') + p_partkey END AS at FROM part""")
def listed_articles(spark, d):
    """A channel page for each brand: brands of even length embed JSON, others link each article twice over."""
    rows = table(spark, d, "part")
    k = (F.col("p_partkey") + 10000).cast("string")
    stamp = F.when(F.col("p_partkey") % 3 == 0, ((F.col("p_partkey") + 1704067200) * 1000).cast("string"))
    node = F.to_json(F.struct(k.alias("contId"), F.col("p_name").alias("name"), stamp.alias("pubTimeLong")))
    parts = rows.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list(node)), ",").alias("s"))
    page = F.concat(F.lit('<script id="__NEXT_DATA__">{"props":{"list":['), F.replace("s", F.lit("</"), F.lit("<\\/")), F.lit(']}}</script><a href="/newsDetail_forward_99999">other</a>'))
    return scraped.listing(parts.select(F.col("p_brand").alias("channel"), page.alias("html")), F.lit("2024-02-01 00:00:00").cast("timestamp")).select(
        "channel", "cid", "title", F.unix_seconds("at").cast("double").alias("at")
    )


@query("""SELECT p_brand AS channel, CAST(10000 + p_partkey AS VARCHAR) AS cid, p_name AS title FROM part""")
def linked_articles(spark, d):
    """Channel pages without embedded data: links that repeat their title, and shorter links to the same article."""
    k = (F.col("p_partkey") + 10000).cast("string")
    link = F.concat(F.lit('<a class="x" href="https://www.thepaper.cn/newsDetail_forward_'), k, F.lit('"><h2>'), "p_name", F.lit("</h2> <p>"), "p_name", F.lit('</p></a><a href="/newsDetail_forward_'), k, F.lit('?commTag=1">comments, very many of them indeed</a><a href="/newsDetail_forward_'), k, F.lit('">a</a>'))
    pages = _joined(table(spark, d, "part"), ["p_brand"], "p_partkey", link).select(F.col("p_brand").alias("channel"), F.col("s").alias("html"))
    return scraped.listing(pages, F.lit("2024-02-01 00:00:00").cast("timestamp")).select("channel", "cid", "title")


@query(f"""SELECT doc_id, CASE WHEN length({_LINES}) >= 300 THEN md5(left({_LINES}, 60000)) END AS content, epoch(TIMESTAMP '2024-03-04 05:06:00') - CASE doc_id % 3 WHEN 0 THEN 0 ELSE 8 * 3600 END AS at FROM documents""")
def article_pages(spark, d):
    """Article pages: the body in embedded JSON, in an article element, or in main; dates as epoch, or as a text in UTC+8."""
    t, k = F.replace(_xml(F.col("text")), F.lit("\n"), F.lit("<br>")), F.col("doc_id") % 3
    cid = (F.col("doc_id") + 10000).cast("string")
    own = F.to_json(F.struct(cid.alias("contId"), F.concat(F.lit("<p>"), t, F.lit("</p>")).alias("content"), F.lit("1709528760000").alias("publishTime")))
    other = F.to_json(F.struct(F.lit("1").alias("contId"), F.concat(F.lit("<p>"), t, t, F.lit(" longer</p>")).alias("content")))
    data = F.concat(F.lit('<script id="__NEXT_DATA__">{"a":['), F.replace(other, F.lit("</"), F.lit("<\\/")), F.lit(","), F.replace(own, F.lit("</"), F.lit("<\\/")), F.lit("]}</script>"))
    page = F.when(k == 0, data).when(k == 1, F.concat(F.lit("<p>2024-03-04 05:06</p><article>"), t, F.lit("</article>"))).otherwise(F.concat(F.lit("2024-03-04 05:06<main id='m'>"), t, F.lit("</main>")))
    out = scraped.articles(table(spark, d, "documents").select(cid.alias("cid"), page.alias("html")), F.lit("2024-04-01 00:00:00").cast("timestamp"))
    return out.select((F.col("cid").cast("long") - 10000).alias("doc_id"), F.md5(F.nullif("content", F.lit("")).cast("binary")).alias("content"), F.unix_seconds("at").cast("double").alias("at"))


@query(f"""SELECT doc_id, 'Issue ' || doc_id AS title, CASE WHEN length(s) >= 500 THEN md5(left(s, 60000)) END AS content, CASE WHEN doc_id % 2 = 0 THEN epoch(TIMESTAMP '2024-05-06 00:00:00') ELSE epoch(TIMESTAMP '2023-12-30 00:00:00') END AS at
FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '2024-05-06' || chr(10) ELSE '' END || {_LINES} AS s FROM documents WHERE NOT regexp_matches(text, '20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}'))""")
def issue_pages(spark, d):
    """Numbered issues: title without the site's name, a full date in the text, or month and day of its metadata."""
    t = F.replace(_xml(F.col("text")), F.lit("\n"), F.lit("<br>"))
    date = F.when(F.col("doc_id") % 2 == 0, "<p>2024-05-06</p>").otherwise("")
    page = F.concat(
        F.lit("<title>Issue "), F.col("doc_id"), F.lit(" | BestBlogs.dev</title><meta property='article:published_time' content='on 12-30'><main>"), date, t, F.lit("</main>")
    )
    rows = table(spark, d, "documents").filter(~F.col("text").rlike(r"20\d{2}-\d{2}-\d{2}"))
    out = scraped.issues(rows.select(F.col("doc_id").alias("n"), page.alias("html")), F.lit("2024-06-01").cast("date"))
    return out.select(F.col("n").alias("doc_id"), "title", F.md5(F.nullif("content", F.lit("")).cast("binary")).alias("content"), F.unix_seconds("at").cast("double").alias("at"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'fetched ' || doc_id ELSE '' END AS content, CASE WHEN doc_id % 2 = 0 THEN epoch(TIMESTAMP '2024-03-03 00:00:00') WHEN doc_id % 3 = 0 THEN epoch(TIMESTAMP '2024-02-02 00:00:00')
 WHEN doc_id % 5 = 0 THEN epoch(TIMESTAMP '2024-01-01 00:00:00') END AS at, doc_id % 5 = 0 AND doc_id % 10 <> 0 AS known FROM documents WHERE doc_id % 10 <> 0""")
def listing_joins(spark, d):
    """Listed articles without a stored text, joined with fetched bodies and stored dates."""
    stamp = lambda s: F.lit(s).cast("timestamp")
    rows = table(spark, d, "documents").withColumn("cid", (F.col("doc_id") + 10000).cast("string"))
    listed = rows.select("cid", F.col("doc_id").alias("ord"), F.lit("t").alias("title"), F.when(F.col("doc_id") % 3 == 0, stamp("2024-02-02 00:00:00")).alias("at"))
    fetched = rows.filter("doc_id % 2 = 0").select("cid", F.concat(F.lit("fetched "), "doc_id").alias("content"), stamp("2024-03-03 00:00:00").alias("at"))
    stored = rows.filter("doc_id % 5 = 0").select(
        F.concat(F.lit("https://m.thepaper.cn/newsDetail_forward_"), "cid").alias("url"), F.when(F.col("doc_id") % 10 == 0, "text").alias("summary"), F.lit("2024-01-01T00:00:00Z").alias("published_at")
    )
    raws = scraped.listing_raws(scraped.open_articles(listed, stored), fetched, stored, "c", "s")
    return raws.select(F.col("ord").alias("doc_id"), "content", F.unix_seconds("published_at").cast("double").alias("at"), (F.col("ord") % 5 == 0).alias("known"))


# --- archive, inbox -----------------------------------------------------------------------------------------------


@query("""SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS ord, sha1(CAST(doc_id AS VARCHAR)) AS id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS category, md5(text) AS digest, CAST(n_chars AS INT) AS length
FROM documents WHERE source IS NOT NULL""")
def archive_documents(spark, d):
    """An archive file's text for each source, written a line an item, and read again; members that are no objects drop out."""
    from loomwick.schemas import ITEM

    rows = table(spark, d, "documents").filter("source is not null")
    given = {"id": F.sha1(F.col("doc_id").cast("string").cast("binary")), "category": F.when(F.col("doc_id") % 3 != 0, F.col("lang")), "summary": F.col("text"), "length": F.col("n_chars")}
    items = rows.select(F.col("doc_id").alias("ord"), "source", *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM if f.name != "source"])
    lines = archive.archive_rows(items).join(rows.select(F.col("doc_id").alias("ord"), "source"), "ord")
    texts = lines.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "json"))), lambda x: x["json"]), ",\n").alias("s"))
    whole = F.when(F.length("source") % 2 == 0, F.concat(F.lit(' {"generated_at":"x","items":['), "s", F.lit(', 5, "x"],"total_items":1}'))).otherwise(F.concat(F.lit("["), "s", F.lit("]")))
    back = archive.archive_of(texts.select(F.col("source").alias("file"), whole.alias("value")), keep=("file",))
    return back.select(F.col("file").alias("source"), "ord", "id", "category", F.md5(F.col("summary").cast("binary")).alias("digest"), "length")


@query("""SELECT min(page_id) AS page_id, url, count(*) > 1 AS again, epoch(TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 HOUR * (min(page_id) % 100)) AS at FROM pages
WHERE page_id % 100 >= 50 AND page_id % 9 <> 1 AND page_id % 9 <> 2 GROUP BY url""")
def inbox_entries(spark, d):
    """An inbox of all pages: odd schemes, credentials and old entries go; each address once, its first entry."""
    added = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01 00:00:00").cast("timestamp")) + 3600 * (F.col("page_id") % 100))
    link = F.when(F.col("page_id") % 9 == 1, F.concat(F.lit("ftp://e.org/"), "page_id")).when(F.col("page_id") % 9 == 2, F.regexp_replace("url", "://", "://u:p@")).otherwise(F.concat(F.lit(" "), "url"))
    rows = table(spark, d, "pages").withColumn("url0", F.col("url")).select("page_id", F.struct(link.alias("url"), iso(added).alias("added")).alias("e"))
    doc = rows.agg(F.array_sort(F.collect_list(F.struct("page_id", "e"))).alias("l")).select(F.to_json(F.struct(F.transform("l", lambda x: x["e"]).alias("urls"))).alias("value"))
    found = archive.inbox_of(doc, F.lit("2024-01-03 02:00:00").cast("timestamp"), last=1 << 30)
    firsts = table(spark, d, "pages").filter("page_id % 100 >= 50 and page_id % 9 not in (1, 2)").groupBy("url").agg(F.min("page_id").alias("page_id"), (F.count(F.lit(1)) > 1).alias("again"))
    return found.join(firsts, "url").select("page_id", "url", "again", F.unix_seconds("added").cast("double").alias("at"))


# --- subtitles ----------------------------------------------------------------------------------------------------

_SUBS = ["en", "zh-TW", "ja", "zh-Hant-en"]
_FILES = f"sha1(CAST(l_orderkey AS VARCHAR)) || '.en.' || {_SUBS}[l_linenumber % 4 + 1] || CASE WHEN l_returnflag = 'N' THEN '.vtt' ELSE '.srt' END"
_RANK = "CASE l_linenumber % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 WHEN 2 THEN 2 ELSE 3 END"


def _files(spark, d):
    sub = F.get(F.array(*[F.lit(s) for s in _SUBS]), (F.col("l_linenumber") % 4).cast("int"))
    rows = table(spark, d, "lineitem").withColumn("item", F.sha1(F.col("l_orderkey").cast("string").cast("binary")))
    name = F.concat("item", F.lit(".en."), sub, F.when(F.col("l_returnflag") == "N", ".vtt").otherwise(".srt"))
    return rows.select("l_orderkey", "item", name.alias("name"))


@query(f"""WITH f AS (SELECT DISTINCT l_orderkey, {_FILES} AS name, {_RANK} AS rank, l_returnflag = 'N' AS fine FROM lineitem),
b AS (SELECT l_orderkey, arg_min(name, (rank, name)) AS best FROM f WHERE fine GROUP BY 1)
SELECT best, count(*) FILTER (name <> best) AS surplus FROM f JOIN b USING (l_orderkey) GROUP BY best""")
def subtitle_files(spark, d):
    """The best file of each item and how many others a prune would delete."""
    files = _files(spark, d).select("name").distinct()
    best = subtitles.pick_subtitle(files)
    extra = subtitles.surplus_files(files).groupBy(F.substring_index("name", ".", 1).alias("item_id")).agg(F.count(F.lit(1)).alias("surplus"))
    return best.join(extra, "item_id", "left").select(F.col("name").alias("best"), F.coalesce("surplus", F.lit(0)).alias("surplus"))


@query(f"""SELECT DISTINCT {_FILES} AS name FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def subtitle_orphans(spark, d):
    """Files whose item is gone."""
    items = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.sha1(F.col("o_orderkey").cast("string").cast("binary")).alias("id"))
    return subtitles.orphan_files(_files(spark, d).select("name").distinct(), items)


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'N')""")
def items_without_subtitles(spark, d):
    items = table(spark, d, "orders").select("o_orderkey", F.sha1(F.col("o_orderkey").cast("string").cast("binary")).alias("id"))
    return subtitles.without_transcript(items, _files(spark, d).select("name").distinct()).select("o_orderkey")


@query(r"""SELECT conv_id, turn, turn * 2.5 AS start_s, turn * 2.5 + 1.25 AS end_s, t AS text FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations) WHERE t <> ''""")
def vtt_cues(spark, d):
    """Conversations as WebVTT files, a cue each turn, read back cue by cue."""
    seg = F.struct("turn", (F.col("turn") * 2.5).alias("start"), (F.col("turn") * 2.5 + 1.25).alias("end"), F.concat(F.lit("\n "), "text").alias("text"))
    rows = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(seg)).alias("s"))
    files = rows.select(F.concat(F.sha1(F.col("conv_id").cast("string").cast("binary")), F.lit(".en.en.vtt")).alias("name"), subtitles.to_vtt(F.col("s")).alias("text"), "conv_id")
    cues = vtt.cues(files.filter("text <> ''")).join(rows.select(F.sha1(F.col("conv_id").cast("string").cast("binary")).alias("item_id"), "conv_id"), "item_id")
    line = F.try_element_at(F.split("payload", "\n"), F.lit(1))
    return cues.select("conv_id", (F.col("start_s") / 2.5).cast("long").alias("turn"), "start_s", "end_s", line.alias("text"))


@query(r"""SELECT conv_id, string_agg(t, chr(10) ORDER BY k) AS text FROM (SELECT *, lag(t) OVER (PARTITION BY conv_id ORDER BY k) AS p FROM (
SELECT conv_id, turn * 2 + h AS k, trim(regexp_replace(CASE h WHEN 0 THEN text ELSE 'end ' || turn % 2 END, '\s+', ' ', 'g')) AS t FROM conversations, (VALUES (0), (1)) AS x(h)) WHERE t <> '') WHERE p IS NULL OR p <> t GROUP BY conv_id""")
def rolling_transcripts(spark, d):
    """Rolling captions: each cue repeats the last line of the one before; inline tags and entities go."""
    flat = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    last = F.concat(F.lit("end "), (F.col("turn") % 2).cast("string"))
    before = F.when(F.col("turn") > 0, F.concat(F.lit("<c.x>end "), ((F.col("turn") + 1) % 2).cast("string"), F.lit("</c>\n"))).otherwise("")
    marked = F.replace(F.replace(flat, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    payload = F.concat(before, F.lit("<00:00:01.000>"), marked, F.lit("\n \n"), last)
    rows = table(spark, d, "conversations").select("conv_id", F.col("turn").cast("int").alias("cue_no"), payload.alias("payload"))
    return subtitles.transcript(rows, "conv_id")


# --- reports ------------------------------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def most_common_types(spark, d):
    return mining.most_common(table(spark, d, "events"), "event_type", 3)


@query("""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://e.org/i/' || page_id || '.png' ELSE 'https://cdn.e.org/' || page_id || '.jpg' END AS first, 3 AS n FROM pages""")
def picture_candidates(spark, d):
    """Social pictures, then pictures that are not declared small, made absolute."""
    k = F.col("page_id").cast("string")
    social = F.concat(F.lit('<meta content="'), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/i/"), k, F.lit(".png"))).otherwise(F.concat(F.lit("//cdn.e.org/"), k, F.lit(".jpg"))), F.lit('" property="og:image">'))
    body = F.concat(F.lit("<img width=80 src=a.png><img src='b.png?x=1&amp;y=2'><img src=\"c.png\" height='300px'>"), social, F.lit("<img src='b.png?x=1&amp;y=2'>"))
    found = html.thumb_candidates(F.concat(body, F.regexp_replace("html", r"(?i)<(img|meta)\b[^>]*>", "")), F.lit("https://e.org/p/q"))
    return table(spark, d, "pages").select("page_id", found.alias("c")).select("page_id", F.try_element_at("c", F.lit(1)).alias("first"), F.size("c").alias("n"))

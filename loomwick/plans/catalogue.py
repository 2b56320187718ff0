"""The registered queries of the engine's own operators, each with SQL for the same rows.

Every query reads whole tables.  Shared-text figures and the like use the tables' own columns in place of
archive fields: documents serve as stored texts, pages as fetched pages, events and lineitem as ordered rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwick.functions import dates, html, lang, text, thumbs, url
from loomwick.operators import merge, mining, qc, sequential, subtitles
from loomwick.plans.registry import query, table

# --- urls ---------------------------------------------------------------------------------------------------

#: SQL of the normal url, for addresses whose query keys are only page, ref and utm_source.
_NORMAL = r"""rtrim(
  lower(regexp_extract(url, '^([^/]*//[^/?#]*)', 1)) || regexp_extract(url, '^[^/]*//[^/?#]*([^?#]*)', 1)
  || CASE WHEN regexp_extract(url, '[?&](page=[^&#]*)', 1) <> '' THEN '?' || regexp_extract(url, '[?&](page=[^&#]*)', 1) ELSE '' END, '/')"""
_HOST = r"lower(regexp_extract(url, '^[^/]*//([^/?#]*)', 1))"


@query(f"SELECT page_id, {_NORMAL} AS normal FROM pages")
def url_normalize(spark, d):
    return table(spark, d, "pages").select("page_id", url.normalize_url(F.col("url")).alias("normal"))


@query(f"""SELECT u AS url, min(page_id) AS page_id, any_value(h) AS host, sha1('web||' || any_value(h) || '||' || u || '||' || u) AS id, count(*) AS n
FROM (SELECT page_id, {_NORMAL} AS u, {_HOST} AS h FROM pages) GROUP BY u""")
def url_canonical_dedupe(spark, d):
    """The page registry: canonical address, first page, host and stable id; one shuffle, on the address."""
    rows = table(spark, d, "pages").select("page_id", url.canonical_url(F.col("url")).alias("url"))
    first = rows.groupBy("url").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))
    host = url.host_of(F.col("url"))
    return first.select("url", "page_id", host.alias("host"), url.make_id(F.lit("Web"), host, F.col("url"), F.col("url")).alias("id"), "n")


@query("SELECT doc_id, sha1(lower(lang) || '||' || lower(source) || '||' || CAST(doc_id AS VARCHAR) || '||' || 'https://example.org/d/' || doc_id) AS id FROM documents")
def item_id_sha1(spark, d):
    link = F.concat(F.lit("https://Example.org/d/"), F.col("doc_id"), F.lit("/?utm_source=x"))
    return table(spark, d, "documents").select("doc_id", url.make_id(F.col("lang"), F.col("source"), F.col("doc_id").cast("string"), link).alias("id"))


@query(f"SELECT {_HOST} AS host, count(*) AS pages, count(DISTINCT {_NORMAL}) AS urls FROM pages GROUP BY 1 ORDER BY pages DESC, host LIMIT 20")
def host_rollup(spark, d):
    rows = table(spark, d, "pages").select(url.host_of(F.col("url")).alias("host"), url.normalize_url(F.col("url")).alias("u"))
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.count_distinct("u").alias("urls")).orderBy(F.desc("pages"), "host").limit(20)


_SUFFIXES = [("example.com", "c"), ("example.net", "n"), ("example.org", "o"), ("spam-farm.example.org", "spam"), ("www.cheap-pills.example.com", "pills")]


@query(f"""SELECT page_id, suffix, kind FROM (SELECT page_id, {_HOST} AS h FROM pages)
JOIN (VALUES {", ".join(f"('{s}', '{k}')" for s, k in _SUFFIXES)}) AS r(suffix, kind) ON h = suffix OR ends_with(h, '.' || suffix)""")
def host_suffix_join(spark, d):
    """The suffix rule as an equi-join: each host explodes into the few domains above it."""
    rules = spark.createDataFrame(_SUFFIXES, "suffix string, kind string")
    rows = table(spark, d, "pages").select("page_id", F.explode(url.host_suffixes(url.host_of(F.col("url")))).alias("suffix"))
    return rows.join(rules, "suffix").select("page_id", "suffix", "kind")


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'abcdefghij' || lpad(CAST(event_id % 10 AS VARCHAR), 1, '0') END AS video FROM events")
def video_ids(spark, d):
    vid = F.concat(F.lit("abcdefghij"), F.col("event_id") % 10)
    link = (
        F.when(F.col("user_id") % 9 == 0, F.concat(F.lit("https://youtu.be/"), vid, F.lit("?t=3")))
        .when(F.col("user_id") % 9 == 3, F.concat(F.lit("https://www.YouTube.com/watch?list=x&v="), vid))
        .when(F.col("user_id") % 9 == 6, F.concat(F.lit("https://m.youtube.com/shorts/"), vid, F.lit("/")))
        .otherwise(F.concat(F.lit("https://youtube.com/@c/"), vid))
    )
    return table(spark, d, "events").select("event_id", url.youtube_video_id(link).alias("video"))


# --- html and json --------------------------------------------------------------------------------------------


@query(r"""SELECT name, count(*) AS n, count(DISTINCT page_id) AS pages FROM (
SELECT page_id, unnest(regexp_extract_all(html, '<([a-z0-9]+)[^<>]*>', 1)) AS name FROM pages) WHERE name IN ('p', 'a', 'li', 'h1', 'div', 'meta') GROUP BY name""")
def html_tag_counts(spark, d):
    tags = F.explode(html.iter_tags(F.col("html"), ["p", "a", "li", "h1", "div", "meta"])).alias("t")
    rows = table(spark, d, "pages").select("page_id", tags).select("page_id", "t.name")
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title', 1), '\s+', ' ', 'g')) AS title FROM pages")
def html_title(spark, d):
    return table(spark, d, "pages").select("page_id", html.page_title(F.col("html")).alias("title"))


@query(r"""SELECT page_id, href, CAST(count(*) AS BIGINT) AS n FROM (
SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"<>]*)"', 1)) AS href FROM pages) GROUP BY ALL""")
def html_links(spark, d):
    tags = F.explode(html.iter_tags(F.col("html"), ["a"])).alias("t")
    rows = table(spark, d, "pages").select("page_id", tags).select("page_id", html.attribute(F.col("t.raw"), "href").alias("href"))
    return rows.filter("href is not null").groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, '$' AS path FROM events WHERE props IS NOT NULL")
def json_walk_props(spark, d):
    """Every object of a JSON text in document order, by a lateral table function."""
    rows = table(spark, d, "events").select("event_id", "props").filter("props is not null")
    found = rows.lateralJoin(html.JsonObjects(F.col("props").outer()))
    return found.select("event_id", F.get_json_object("node", "$.k").cast("long").alias("k"), "path")


# --- dates ----------------------------------------------------------------------------------------------------


@query(r"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 <> 0
 THEN '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || 'Z' AS iso, epoch_us(ts) AS micros, epoch_us(date_trunc('second', ts)) AS from_seconds FROM events""")
def epoch_iso_roundtrip(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).withColumn("iso", dates.iso(F.col("ts")))
    seconds = F.floor(F.unix_micros("ts") / 1_000_000).cast("string")
    return rows.select(
        "event_id", "iso", F.unix_micros(dates.parse_date(F.col("iso"))).alias("micros"), F.unix_micros(dates.parse_date(seconds)).alias("from_seconds")
    )


@query("""SELECT o_orderkey, CAST(coalesce(min(l_shipdate), any_value(o_orderdate)) AS DATE) AS day, count(l_orderkey) AS n
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY o_orderkey""")
def date_fallback_chain(spark, d):
    """A record's date: the first known of several, absent ones read as null."""
    first = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("s"), F.count(F.lit(1)).alias("n"))
    rows = table(spark, d, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    pick = F.coalesce(*[dates.parse_date(F.date_format(c, "yyyy-MM-dd HH:mm:ss")) for c in (F.col("s").cast("timestamp"), F.col("o_orderdate").cast("timestamp"))])
    return rows.select("o_orderkey", pick.cast("date").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT event_id, CAST(CASE WHEN event_id % 4 = 0 THEN user_id WHEN event_id % 4 = 1 THEN user_id * 60 + event_id % 60
 WHEN event_id % 4 = 2 THEN user_id * 3600 + (event_id % 60) * 60 + 5 ELSE 0 END AS DOUBLE) AS seconds FROM events""")
def duration_seconds(spark, d):
    m = F.col("event_id") % 60
    written = F.expr("'1:2:3:4'")
    made = (
        F.when(F.col("event_id") % 4 == 0, F.col("user_id").cast("string"))
        .when(F.col("event_id") % 4 == 1, F.concat_ws(":", F.col("user_id"), m))
        .when(F.col("event_id") % 4 == 2, F.concat_ws(":", F.col("user_id"), m, F.lit("05")))
        .otherwise(written)
    )
    return table(spark, d, "events").select("event_id", dates.hms(made).alias("seconds"))


# --- states, routes, filters ----------------------------------------------------------------------------------

_THREE = "CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 THEN ' ' ELSE text END"


@query(f"""SELECT state, count(*) AS n FROM (SELECT CASE WHEN coalesce(s, '') = '' THEN 'pending' WHEN trim(s) = '' THEN 'blank' ELSE 'text' END AS state
FROM (SELECT {_THREE} AS s FROM documents LEFT JOIN labels USING (doc_id))) GROUP BY state""")
def pending_filter_3state(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").withColumn("s", F.expr(_THREE))
    state = F.when(merge.pending(F.col("s"), F.lit("u")), "pending").when(text.blank(F.col("s")), "blank").otherwise("text")
    return rows.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT page_id, CASE WHEN {_HOST} = 'spam-farm.example.org' THEN NULL WHEN ends_with({_HOST}, 'example.net') AND page_id % 2 = 0 THEN 'feed'
 WHEN page_id % 7 = 0 THEN 'youtube' ELSE 'fetch' END AS route FROM pages""")
def route_case(spark, d):
    from loomwick.operators.routing import route

    rows = table(spark, d, "pages")
    net = F.endswith(url.host_of(F.col("url")), F.lit("example.net")) & (F.col("page_id") % 2 == 0)
    own = url.host_in(F.col("url"), ["spam-farm.example.org"]) | net
    link = F.when((F.col("page_id") % 7 == 0) & ~own, F.lit("https://youtu.be/abcdefghijk")).otherwise(F.col("url"))
    copy = F.when(F.col("page_id") % 2 == 0, F.lit("copy"))
    decided = route(link, F.lit("title"), copy, F.lit(None).cast("array<string>"), F.lit(False), skip=["spam-farm.example.org"], feed_first=["example.net"])
    return rows.select("page_id", decided.alias("route"))


_PART_URL = "'https://img.example.org/' || lower(replace(p_name, ' ', '-')) || '-' || p_size || CASE WHEN p_partkey % 5 = 0 THEN '.svg' WHEN p_partkey % 5 = 1 THEN '.html' ELSE '.jpg' END"


@query("""SELECT p_partkey, p_partkey % 5 > 1 AS ok, CASE p_partkey % 5 WHEN 0 THEN 'svg (usually a logo or icon)' WHEN 1 THEN 'no image extension' ELSE 'short topical filename' END AS reason FROM part""")
def thumb_decision(spark, d):
    link = F.expr(_PART_URL.replace("p_size", "CAST(p_size AS STRING)"))
    return table(spark, d, "part").select("p_partkey", thumbs.thumb_usable(link).alias("v")).select("p_partkey", "v.ok", "v.reason")


@query("""SELECT reason, ok, count(*) AS n FROM (SELECT CASE p_partkey % 5 WHEN 0 THEN 'svg (usually a logo or icon)' WHEN 1 THEN 'no image extension'
 WHEN 2 THEN 'opaque id / hash filename' WHEN 3 THEN 'chart vocabulary in filename' ELSE 'descriptive phrase (5 tokens)' END AS reason, p_partkey % 5 = 3 AS ok FROM part) GROUP BY ALL""")
def thumb_reasons(spark, d):
    k = F.col("p_partkey").cast("string")
    name = (
        F.when(F.col("p_partkey") % 5 == 0, F.concat(k, F.lit(".svg"))).when(F.col("p_partkey") % 5 == 1, F.concat(k, F.lit(".htm")))
        .when(F.col("p_partkey") % 5 == 2, F.concat(F.lpad(k, 9, "1"), F.lit(".png"))).when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("gdp-growth-"), k, F.lit("-1024x576.webp")))
        .otherwise(F.concat(F.lit("a-b-c-d-"), k, F.lit("@2x.jpg?w=3")))
    )
    rows = table(spark, d, "part").select(thumbs.thumb_usable(F.concat(F.lit("http://x.org/a/"), name)).alias("v"))
    return rows.groupBy("v.reason", "v.ok").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_orphans(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_anti").select("doc_id")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_join_has_labels(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").filter("toxic = 1"), "doc_id", "left_semi").select("doc_id")


# --- subtitles ------------------------------------------------------------------------------------------------

_LANGS = ["zh-TW", "en", "zh-Hant-en", "ja", "live-chat", "zh-Hans", "yue-HK"]
_LANG_SQL = "CASE l_linenumber % 7 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_LANGS)) + " END"
_CLASS_SQL = "CASE WHEN lang = 'zh-Hant-en' THEN 'chained' WHEN lang IN ('zh-TW', 'zh-Hans') THEN 'zh' WHEN lang = 'en' THEN 'orig' ELSE 'other' END"


@query(f"""SELECT l_orderkey, arg_min(lang, (rank, lang)) AS lang, min(rank) AS rank FROM (SELECT l_orderkey, lang,
 CASE {_CLASS_SQL} WHEN 'zh' THEN 0 WHEN 'orig' THEN 1 WHEN 'other' THEN 2 ELSE 3 END AS rank FROM (SELECT l_orderkey, {_LANG_SQL} AS lang FROM lineitem)) GROUP BY 1""")
def best_by_rank(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.expr(_LANG_SQL).alias("lang")).withColumn("rank", lang.file_rank(F.col("lang"), F.lit("EN")))
    return rows.groupBy("l_orderkey").agg(F.min_by("lang", F.struct("rank", "lang")).alias("lang"), F.min("rank").alias("rank"))


@query(f"""SELECT l_orderkey, manual, lang FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY rank, manual DESC, lang) AS k FROM (
 SELECT l_orderkey, lang, manual, CASE {_CLASS_SQL} WHEN 'chained' THEN 6 WHEN 'zh' THEN CASE WHEN manual THEN 0 ELSE 4 END
  WHEN 'orig' THEN CASE WHEN manual THEN 1 ELSE 3 END ELSE CASE WHEN manual THEN 2 ELSE 5 END END AS rank
 FROM (SELECT l_orderkey, {_LANG_SQL} AS lang, l_returnflag = 'R' AS manual FROM lineitem) WHERE lang <> 'live-chat')) WHERE k = 1""")
def choose_track(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.expr(_LANG_SQL).alias("lang"), (F.col("l_returnflag") == "R").alias("manual"), F.lit("en").alias("orig"))
    return subtitles.choose_track(rows, ["l_orderkey"])


@query("""WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) / 1e6 AS s, epoch_us(ts) / 1e6 + (value % 7) - 2 AS e, event_type AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
r AS (SELECT user_id, k, s AS a, CASE WHEN e > s THEN e ELSE s + 0.5 END AS b, t, 0 AS cue FROM e WHERE k = 1
 UNION ALL SELECT e.user_id, e.k, CASE WHEN e.t = r.t THEN r.a ELSE greatest(e.s, r.b) END, CASE WHEN e.e > greatest(e.s, r.b) THEN e.e ELSE greatest(e.s, r.b) + 0.5 END, e.t,
  r.cue + CASE WHEN e.t = r.t THEN 0 ELSE 1 END FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)
SELECT user_id, cue AS cue_no, round(arg_max(a, k), 3) AS start_s, round(arg_max(b, k), 3) AS end_s, arg_max(t, k) AS text FROM r GROUP BY user_id, cue""")
def vtt_like_clamp(spark, d):
    """Cues clamped so that none overlaps: the events of a user as segments."""
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    seg = F.struct("event_id", at.alias("start"), (at + F.col("value") % 7 - 2).alias("end"), F.col("event_type").alias("text"))
    rows = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(seg)).alias("s"))
    cues = rows.select("user_id", F.posexplode(subtitles.clamp_cues(F.col("s")))).select("user_id", F.col("pos").alias("cue_no"), "col.*")
    return cues.select("user_id", "cue_no", F.round("start", 3).alias("start_s"), F.round("end", 3).alias("end_s"), "text")


@query("""SELECT conv_id, string_agg(t, chr(10) ORDER BY turn) AS text FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations) WHERE t <> '' GROUP BY conv_id""")
def transcript_assemble(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", text.one_space(F.coalesce("text", F.lit(""))).alias("t")).filter("t <> ''")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"])
    return rows.groupBy("conv_id").agg(F.array_join(ordered, "\n").alias("text"))


# --- merging --------------------------------------------------------------------------------------------------

_MARKED = "CASE WHEN doc_id % 3 = 0 THEN text || '↛' WHEN doc_id % 5 = 0 THEN '  ' ELSE text END"


@query("""SELECT lang, source, min(doc_id) AS ord, arg_min(quality, doc_id) FILTER (quality IS NOT NULL) AS quality, max(n_chars) AS last_seen_at,
 arg_min(text, doc_id) FILTER (trim(coalesce(text, '')) <> '') AS title FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang, source""")
def merge_first_nonblank(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = rows.select("lang", "source", F.col("doc_id").alias("ord"), "quality", F.col("n_chars").alias("last_seen_at"), F.col("text").alias("title"))
    return merge.absorb(rows, ["lang", "source"])


@query(f"""SELECT lang, source, arg_max(s, (CASE WHEN contains(s, '↛') THEN 0 ELSE 1 END, length(s), -doc_id)) FILTER (trim(s) <> '') AS best
FROM (SELECT lang, source, doc_id, {_MARKED} AS s FROM documents) GROUP BY lang, source""")
def better_text(spark, d):
    rows = table(spark, d, "documents").withColumn("s", F.expr(_MARKED))
    return rows.groupBy("lang", "source").agg(merge.better_text(F.col("s"), F.col("doc_id")).alias("best"))


@query("""SELECT id, min(ord) AS ord, max(length) AS longest, sum(n) AS n FROM (
 SELECT CAST(doc_id % 97 AS VARCHAR) AS id, doc_id AS ord, 1 AS n, n_chars AS length FROM documents WHERE source IS NULL
 UNION ALL SELECT CAST(min(doc_id) % 97 AS VARCHAR), min(doc_id), 1, arg_min(n_chars, doc_id) FROM documents GROUP BY text, source, lang) GROUP BY id""")
def two_stage_dedupe(spark, d):
    rows = table(spark, d, "documents").select(
        F.col("doc_id").alias("ord"), (F.col("doc_id") % 97).cast("string").alias("id"), F.col("lang").alias("published_at"), "source",
        F.col("text").alias("url"), F.col("n_chars").alias("length"),
    )
    keys = ["published_at", "source", "url"]
    once = merge.absorb(rows, keys)
    return once.groupBy("id").agg(F.min("ord").alias("ord"), F.max("length").alias("longest"), F.count(F.lit(1)).alias("n"))


_LATER = "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') END"


@query(f"""SELECT o_orderkey, coalesce({_LATER}, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')) AS published_at,
 CASE WHEN o_orderkey % 2 = 0 THEN '2030-01-01T00:00:00Z' ELSE '2020-01-01T00:00:00Z' END AS last_seen_at FROM orders""".replace(
    f"coalesce({_LATER}", f"coalesce(CASE WHEN o_orderkey % 2 = 0 THEN {_LATER} END"))
def upsert_feed_date_wins(spark, d):
    """Half of the stored records are listed again; a date that comes with them wins."""
    from loomwick.schemas import ITEM

    base = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    link = F.concat(F.lit("https://example.org/o/"), F.col("o_orderkey"))
    title = F.concat(F.lit("order "), F.col("o_orderkey"))
    given = {"id": url.make_id(F.lit("c"), F.lit("s"), title, link), "category": F.lit("c"), "source": F.lit("s"), "title": title, "url": link,
             "published_at": dates.iso(F.col("at")), "last_seen_at": F.lit("2020-01-01T00:00:00Z")}
    stored = base.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM], F.col("o_orderkey").alias("ord"))
    when = F.when(F.col("o_orderkey") % 4 != 0, F.col("at") + F.expr("interval 1 day"))
    raws = base.filter("o_orderkey % 2 = 0").select(
        F.col("o_orderkey").alias("ord"), F.lit("c").alias("category"), F.lit("s").alias("source"), title.alias("title"), F.concat(link, F.lit("/?utm_medium=m")).alias("url"),
        when.alias("published_at"), F.lit("").alias("feed_url"), F.lit("copy").alias("content"), F.array().cast("array<string>").alias("images"),
    )
    out = merge.ingest(stored, raws, F.lit("2030-01-01 00:00:00").cast("timestamp"))
    return out.select(F.regexp_extract("title", r"(\d+)", 1).cast("long").alias("o_orderkey"), "published_at", "last_seen_at")


@query("""SELECT event_id FROM events, (SELECT max(ts) AS now FROM events)
WHERE coalesce(CASE WHEN event_id % 3 <> 0 THEN ts END, CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 5 DAY END, now) >= now - INTERVAL 10 DAY""")
def retention_cutoff(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    now = rows.agg(F.max("ts").alias("now"))  # one row
    shown = lambda keep, t: F.when(keep, dates.iso(t))
    items = rows.crossJoin(F.broadcast(now)).select(
        "event_id", "now", shown(F.col("event_id") % 3 != 0, F.col("ts")).alias("last_seen_at"),
        shown(F.col("event_id") % 2 == 0, F.col("ts") - F.expr("interval 5 days")).alias("published_at"),
    )
    return merge.retain(items, F.col("now"), 10).select("event_id")


@query("SELECT event_id, user_id FROM events ORDER BY CASE WHEN user_id % 4 = 0 THEN NULL ELSE date_trunc('day', ts) END DESC NULLS LAST, event_id LIMIT 100")
def stable_desc_order_topk(spark, d):
    day = F.when(F.col("user_id") % 4 != 0, F.date_trunc("day", "ts"))
    return merge.top_by(table(spark, d, "events"), [day.desc_nulls_last(), F.col("event_id").asc()], 100).select("event_id", "user_id")


# --- words, shared texts, quality ------------------------------------------------------------------------------


@query("""SELECT p_partkey, CAST(len(list_intersect(t, ['red', 'blue', 'steel', 'small', 'large'])) AS INT) AS hits, len(list_filter(t, lambda x: x NOT IN ('red', 'blue', 'steel', 'small', 'large'))) = 0 AS all_known
FROM (SELECT p_partkey, list_distinct(list_filter(regexp_split_to_array(lower(p_name), '[^a-z0-9]+'), lambda x: x <> '')) AS t FROM part)""")
def set_ops_tokens(spark, d):
    known = F.array(*[F.lit(x) for x in ("red", "blue", "steel", "small", "large")])
    t = F.array_distinct(F.filter(F.split(F.lower("p_name"), "[^a-z0-9]+"), lambda x: x != ""))
    rows = table(spark, d, "part").select("p_partkey", t.alias("t"))
    return rows.select("p_partkey", F.size(F.array_intersect("t", known)).alias("hits"), (F.size(F.array_except("t", known)) == 0).alias("all_known"))


_KEYWORDS = "list_filter(regexp_extract_all(lower(text), '[a-z][a-z0-9]{3,}'), lambda x: x NOT IN (" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + "))"


@query(f"SELECT word, count(*) AS docs FROM (SELECT unnest(list_distinct({_KEYWORDS} || regexp_extract_all(lower(text), '[0-9]{{2,}}'))) AS word FROM documents) GROUP BY word")
def keyword_counts(spark, d):
    rows = table(spark, d, "documents").select(F.explode(text.keywords(F.col("text"))).alias("word"))
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("docs"))


@query(r"""SELECT sha1(k) AS key, count(*) AS n, count(DISTINCT source) AS sources, min(doc_id) AS first FROM (
SELECT doc_id, source, left(regexp_replace(text, '\s+', '', 'g'), 300) AS k FROM documents) WHERE length(k) >= 60 GROUP BY k HAVING count(*) > 1""")
def share_key_groups(spark, d):
    rows = qc.shared_index(table(spark, d, "documents"), "text").select("doc_id", "source", F.sha1(F.col("share_key").cast("binary")).alias("key"))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("sources"), F.min("doc_id").alias("first")).filter("n > 1")


@query(r"""WITH s AS (SELECT source, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS sentence FROM documents),
c AS (SELECT sentence, count(*) AS n, count(DISTINCT source) AS sources FROM s WHERE length(sentence) BETWEEN 6 AND 120 GROUP BY sentence HAVING count(*) >= 3)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, sentence DESC) AS rank FROM (
SELECT *, CASE WHEN sources >= 2 THEN 'shared' ELSE 'single' END AS kind FROM c)) WHERE rank <= 60""")
def mine_repeated_lines(spark, d):
    return mining.mine_boilerplate(table(spark, d, "documents"), 3, "text", pattern="\n")


@query(r"""SELECT page_id, CAST(len(regexp_extract_all(html, '<[^>]{0,300}>')) AS INT) AS tags, CAST(len(regexp_extract_all(html, '&(?:nbsp|amp|lt|gt|#[0-9]+);')) AS INT) AS entities,
 regexp_matches(html, '(?i)<meta\b') AS strong FROM pages""")
def qc_scrape_html(spark, d):
    page = F.col("html")
    return table(spark, d, "pages").select(
        "page_id", F.regexp_count(page, F.lit(r"<[^>]{0,300}>")).alias("tags"), F.regexp_count(page, F.lit(r"&(?:nbsp|amp|lt|gt|#\d+);")).alias("entities"),
        page.rlike(f"(?i){qc.STRONG}").alias("strong"),
    )


@query()
def qc_findings(spark, d):
    """Findings over all documents, spam first, damaged characters and loops by Arrow functions."""
    rows = table(spark, d, "documents").select("doc_id", F.col("text").alias("summary"), F.lit("").alias("title"))
    return qc.inspect(rows).filter("finding is not null").select("doc_id", "finding.category", "finding.action", F.length("finding.fixed").alias("fixed_chars"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
f AS (SELECT *, CASE WHEN lag(line) OVER w IS NOT DISTINCT FROM line AND pos > 1 THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
i AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM f)
SELECT doc_id, any_value(line) AS line, CAST(min(pos) - 1 AS INT) AS first, CAST(max(pos) - 1 AS INT) AS last, count(*) AS n FROM i GROUP BY doc_id, island HAVING count(*) > 1""")
def qc_loops(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n"))).withColumnsRenamed({"col": "line"})
    return sequential.merge_equal_neighbours(rows, ["doc_id"], "pos", "line").filter("n > 1")


@query()
def qc_shared(spark, d):
    """Documents with one text under differing titles, compared with the first of their group."""
    rows = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("ord"), F.concat_ws(" ", "source", "lang", "doc_id").alias("title"),
        F.concat(F.lit("https://example.org/"), F.col("source"), F.lit("/"), F.col("doc_id")).alias("url"), F.col("text").alias("summary"),
    )
    return qc.check_shared(rows).select("id", "finding.category", "finding.action")


# --- order-dependent rules --------------------------------------------------------------------------------------


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (SELECT user_id, 0 AS k, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS reason, CAST(100 AS DOUBLE) AS rest, 0 AS c FROM (SELECT DISTINCT user_id FROM e)
 UNION ALL SELECT e.user_id, e.k, e.event_id, CASE WHEN r.c >= 5 THEN 'count' WHEN e.value > 90 THEN 'too long' WHEN e.value > r.rest THEN 'budget' END,
  CASE WHEN r.c >= 5 OR e.value > 90 OR e.value > r.rest THEN r.rest ELSE r.rest - greatest(e.value, 0) END, r.c + CASE WHEN r.c >= 5 OR e.value > 90 OR e.value > r.rest THEN 0 ELSE 1 END
 FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)
SELECT user_id, event_id, reason IS NULL AS accepted, reason, round(rest, 6) AS "left" FROM r WHERE k > 0""")
def greedy_budget(spark, d):
    """Who gets a share of a budget, in time order and with skips: the events of each user."""
    rows = table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))).alias("s"))
    out = sequential.greedy_budget(F.transform("s", lambda x: x["value"]), 100.0, most=5, longest=90.0)
    both = rows.select("user_id", F.explode(F.arrays_zip(F.col("s.event_id").alias("event_id"), out.alias("b"))).alias("z"))
    return both.select("user_id", "z.event_id", "z.b.accepted", "z.b.reason", F.round("z.b.left", 6).alias("left"))


@query("""SELECT event_id, coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS paused FROM events""")
def host_pause(spark, d):
    rows = table(spark, d, "events").withColumn("blocked", F.col("event_type") == "error")
    return sequential.paused(rows, "user_id", "event_id", "blocked").select("event_id", "paused")


# --- extensions: categories that the record model has no use for -------------------------------------------------


@query("""WITH f AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f)
SELECT user_id, epoch_us(min(ts)) AS first, count(*) AS n FROM i GROUP BY user_id, k""")
def session_gap(spark, d):
    rows = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return rows.groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.unix_micros(F.min("ts")).alias("first"), F.count(F.lit(1)).alias("n")).drop("session_window")


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus) * 2 + grouping(o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def grouping_sets_status(spark, d):
    return table(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL".replace("sum(value)", "round(sum(value), 3)"))
def hourly_windows(spark, d):
    rows = table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"))

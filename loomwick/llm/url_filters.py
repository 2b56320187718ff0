"""URL filters: a sort-merge range join of urls with nested (host, path) rules.

A host is keyed by its labels in reverse, each ended by a dot, so that a rule's host and all its subdomains
are one interval of keys and the intervals of any two rules nest or are disjoint.  Urls and rules are dealt
to ranges of keys; a rule goes to every range that its interval meets.  In a range, one sweep in key order
keeps a stack of the rules whose interval is open; each url tests the paths of the rules on the stack.

Ranges are cut at sampled keys.  Keys carry a hash of the url after the host, so that a host with any share
of the rows spreads over many ranges.  The sample decides where ranges end, never the result.

Of several rules that fit, the longest (host and path together) wins; of equals the longer host, then
``block``.  Where none fits the verdict is ``allow``.  Defined cases: a null url or one without ``://`` has an
empty host and path and is allowed; a rule with a null host or path fits nothing; equal rules count once; extra
columns are ignored; without rules all is allowed; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import table

#: The rules of the registered query: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
DEFAULT = "allow"
#: Sampled keys for each range (on average), and the highest number of ranges: together they bound what the driver gets.
SAMPLES, MOST_RANGES = 20, 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Sorts after every key that begins alike: host keys are followed by "\x01" and a hash, or by more labels.
END = "\U0010ffff"


def split_url(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host and path as the module states."""
    u = F.col(url_col).cast("string")
    has = F.coalesce(F.instr(u, "://") > 0, F.lit(False))
    rest = F.when(has, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    return df.withColumn("host", F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def host_key(host: Column) -> Column:
    """Reversed labels, each ended by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, key, kind); rules (kind 0) come before the urls of their interval."""
    bucket, stack = None, []
    for batch in batches:
        ids, hosts, paths, rules, verdicts = [], [], [], [], []
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("bucket", "key", "kind", "page_id", "host", "path", "verdict")]
        for b, key, kind, page_id, host, path, verdict in zip(*cols, strict=True):
            if b != bucket:
                bucket, stack = b, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, host, path, verdict))
                continue
            best = None
            for _, h, p, v in stack:
                if path.startswith(p):
                    rank = (len(h) + len(p), len(h), v == "block")
                    if best is None or rank > best[0]:
                        best = (rank, h + p, v)
            ids.append(page_id)
            hosts.append(host)
            paths.append(path)
            rules.append(best and best[1])
            verdicts.append(best[2] if best else DEFAULT)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *[pa.array(x, pa.string()) for x in (hosts, paths, rules, verdicts)]],
            ["page_id", "host", "path", "rule", "verdict"],
        )


def _deal(cuts: list[str], schema: pa.Schema):
    """Gives every url its range, and every rule all ranges that its interval meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows, buckets = [], []
            for i, (key, kind) in enumerate(zip(keys, kinds, strict=True)):
                first = bisect_right(cuts, key)
                last = first if kind else bisect_right(cuts, key + END)
                rows += [i] * (last + 1 - first)
                buckets += range(first, last + 1)
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), *batch.take(pa.array(rows, pa.int32())).columns], schema.names)

    return run


def cut_points(urls: DataFrame, ranges: int) -> list[str]:
    """Keys that cut the urls into about so many ranges of like size, from a bounded sample."""
    n = urls.count()
    share = min(1.0, ranges * SAMPLES / max(n, 1))
    keys = sorted(r[0] for r in urls.select("key").sample(share, 17).collect())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; rules: verdict, host, path."""
    spark = pages.sparkSession
    cols = "key string, kind int, page_id long, host string, path string, verdict string"
    schema = pa.schema([(c.split()[0], pa.string()) for c in f"bucket int, {cols}".split(", ")])
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    salt = F.lpad(F.hex(F.xxhash64("page_id", "url")), 16, "0")
    urls = split_url(named).withColumn("key", F.concat(host_key(F.col("host")), F.lit("\x01"), salt))
    ranges = min(MOST_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = cut_points(urls, ranges)
    none = F.lit(None)
    urls = urls.select("key", F.lit(1).alias("kind"), "page_id", "host", "path", none.cast("string").alias("verdict"))
    r = rules.select(*[F.col(c).cast("string").alias(c) for c in ("verdict", "host", "path")]).dropna().distinct()
    r = r.select(host_key(F.col("host")).alias("key"), F.lit(0).alias("kind"), none.cast("long").alias("page_id"), "host", "path", "verdict")
    dealt = urls.unionByName(r).mapInArrow(_deal(cuts, schema), f"bucket int, {cols}")
    rows = dealt.repartition("bucket").sortWithinPartitions("bucket", "key", "kind")
    return rows.mapInArrow(_sweep, "page_id long, host string, path string, rule string, verdict string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "verdict string, host string, path string"))


_REST = "substr(url, strpos(url, '://') + 3)"
ORACLE_SQL = f"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract({_REST}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(verdict, h, p) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)}),
fits AS (
  SELECT page_id, host, path, h || p AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(h) + length(p) DESC, length(h) DESC, verdict DESC) AS k
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT parts.page_id, parts.host, parts.path, fits.rule, coalesce(fits.verdict, '{DEFAULT}') AS verdict
FROM parts LEFT JOIN fits ON fits.page_id = parts.page_id AND fits.k = 1
"""

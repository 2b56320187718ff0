"""Commands: collect feeds into the archive file, check its texts, list the registered queries.

``python -m loomwick collect|check|queries``; settings come from the environment (``Config.from_env``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loomwick.config import Config, Rules
from loomwick.operators import qc
from loomwick.plans import jobs
from loomwick.session import session
from loomwick.sources import archive, feeds


def collect(spark: SparkSession, cfg: Config, rules: Rules, opml: str, fetcher) -> int:
    """Reads the feed list, fetches and merges; the number of items then stored."""
    xml = spark.createDataFrame([(opml,)], "xml string")
    listed = feeds.feeds_of(
        xml.lateralJoin(feeds.Outlines(F.col("xml").outer())), rules.hosts("feed_skip"), rules.hosts("feed_skip_prefix"), rules.mapping("feed_replace"), cfg.rss_max_feeds
    )
    out = jobs.collect(archive.read_archive(spark, cfg.archive), listed, fetcher, F.current_timestamp(), cfg, rules)
    n = archive.write_archive(out, cfg.archive, dt.datetime.now(dt.UTC).isoformat())
    print(json.dumps({"stored": n}))
    return n


def check(spark: SparkSession, cfg: Config, dry: bool) -> None:
    """Judges stored texts, prints the report and, unless dry, writes what is repaired."""
    items = archive.read_archive(spark, cfg.archive)
    done = jobs.written(qc.apply(items), "checked")
    for line in qc.report_lines(qc.report(done)):
        print(line)
    if not dry:
        archive.write_archive(done, cfg.archive, dt.datetime.now(dt.UTC).isoformat())


def main(args: list[str] | None = None, spark: SparkSession | None = None, fetcher=None) -> None:
    parser = argparse.ArgumentParser(prog="loomwick")
    parser.add_argument("command", choices=["collect", "check", "queries"])
    parser.add_argument("--opml", help="the feed list; else the environment holds it")
    parser.add_argument("--rules", help="a JSON file of rule tables")
    parser.add_argument("--dry-run", action="store_true")
    given = parser.parse_args(args)
    if given.command == "queries":
        from loomwick.plans import catalogue, formats, registry, rules  # noqa: F401

        print("\n".join(registry.QUERIES))
        return
    spark, cfg = spark or session(), Config.from_env()
    if given.command == "check":
        check(spark, cfg, given.dry_run)
        return
    import os

    from loomwick.providers import HttpFetcher

    opml = Path(given.opml).read_text(encoding="utf-8") if given.opml else feeds.opml_from_env(os.environ).decode()
    collect(spark, cfg, Rules.load(given.rules) if given.rules else Rules(), opml, fetcher or HttpFetcher())


if __name__ == "__main__":
    main()

"""The engine's functions under names that SQL texts can use."""

from __future__ import annotations

from pyspark.sql import SparkSession

from loomwick.functions import dates, encoding, html, net
from loomwick.operators import qc
from loomwick.sources import feeds

FUNCTIONS = {
    "html_to_text": html.html_to_text, "html_unescape": html.unescape, "html_region": html.region, "joined_urls": html.joined_urls, "public_address": net.public_address,
    "parse_free_form": dates.parse_free_form, "path_ratio": qc.path_ratio, "find_loop": qc.find_loop, "diagnose_text": encoding.diagnose,
}
TABLES = {"json_objects": html.JsonObjects, "html_elements": html.Elements, "opml_outlines": feeds.Outlines, "feed_entries": feeds.FeedEntries, "preview_posts": feeds.PreviewPosts}


def register(spark: SparkSession) -> list[str]:
    """Registers all of them with a session; their names."""
    for name, f in FUNCTIONS.items():
        spark.udf.register(name, f)
    for name, f in TABLES.items():
        spark.udtf.register(name, f)
    return [*FUNCTIONS, *TABLES]

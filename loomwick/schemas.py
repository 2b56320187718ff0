"""Record types.  Absence means something: a null is a missing key, not an empty value."""

from __future__ import annotations

from loomwick.types import struct

#: The fields an archive may hold, in order; all else is scratch and never written.
ITEM = struct(
    "id string, category string, source string, title string, url string, published_at string, last_seen_at string, "
    "thumbnail string, summary string, status string, length int"
)
SCRATCH = struct("feed_content string, feed_images array<string>")
RAW = struct(
    "ord long, category string, source string, title string, url string, published_at timestamp, feed_url string, content string, images array<string>"
)
FEED = struct("ord long, title string, category string, home string, parser string, url string, youtube_page boolean")
CUE = struct("cue_no int, start_s double, end_s double, settings string, payload string")
FINDING = struct("category string, detail string, action string, fixed string, excerpt string")
RESPONSE = struct("url string, status int, headers map<string,string>, content binary, error string")

#: What stands for a summary that holds nothing, and the mark of one made from a fallback text.
BLANK_SUMMARY = " "
FALLBACK_MARK = "↛"
GONE_PREFIX = "無法取得頁面內容"
GONE_SUMMARY = GONE_PREFIX + "（原始頁面已移除，且無存檔）" + FALLBACK_MARK

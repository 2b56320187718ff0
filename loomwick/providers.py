"""Outside effects behind small interfaces, each with a form that reads a table.

A provider maps a DataFrame to a DataFrame, so fetching, speech recognition and translation run where the rows
are.  The table forms serve tests and replays; a live one wraps its calls in ``mapInPandas``.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from typing import Protocol
from urllib.error import HTTPError
from urllib.parse import urljoin, urlsplit
from urllib.request import HTTPRedirectHandler, Request, build_opener

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwick.functions.net import BLOCKED, MAX_REDIRECTS, REDIRECT, RETRY, is_public

#: Bytes of an answer that are read, seconds for a request.
BODY_LIMIT, TIMEOUT = 8 << 20, 30.0
ANSWER = "url string, status int, headers map<string,string>, content binary, error string, log string"


class Fetcher(Protocol):
    def fetch(self, urls: DataFrame) -> DataFrame:
        """urls: url (distinct).  Returns url, status, headers, content, error, one row each."""


class Transcriber(Protocol):
    def transcribe(self, items: DataFrame) -> DataFrame:
        """items: id, url, orig.  Returns id, segments array<struct<start,end,text>>, seconds, error."""


class Translator(Protocol):
    def translate(self, texts: DataFrame) -> DataFrame:
        """texts: id, text.  Returns id, text (null: failed), reason."""


class TableFetcher:
    """Answers from a table of url and html; what is missing is gone."""

    def __init__(self, pages: DataFrame, url_col: str = "url", html_col: str = "html"):
        first = F.min_by(F.col(html_col), F.col(html_col).isNull()).alias("html")
        self.pages = pages.groupBy(F.col(url_col).alias("url")).agg(first)

    def fetch(self, urls: DataFrame) -> DataFrame:
        found = urls.select("url").distinct().join(self.pages, "url", "left")
        return found.select(
            "url",
            F.when(F.col("html").isNotNull(), 200).otherwise(404).alias("status"),
            F.create_map(F.lit("content-type"), F.lit("text/html; charset=utf-8")).alias("headers"),
            F.col("html").cast("binary").alias("content"),
            F.lit(None).cast("string").alias("error"),
        )


class TableTranscriber:
    def __init__(self, segments: DataFrame):
        self.segments = segments

    def transcribe(self, items: DataFrame) -> DataFrame:
        found = items.select("id").join(self.segments, "id", "left")
        seconds = F.array_max(F.transform("segments", lambda s: s["end"]))
        return found.select("id", "segments", seconds.alias("seconds"), F.when(F.col("segments").isNull(), "no audio").alias("error"))


class IdentityTranslator:
    def translate(self, texts: DataFrame) -> DataFrame:
        return texts.select("id", "text", F.lit(None).cast("string").alias("reason"))


class _Stay(HTTPRedirectHandler):
    """Redirects are ours to follow: each new address is judged before it is asked."""

    def redirect_request(self, *args, **kwargs):
        return None


class Refused(Exception):
    """An address that may not be asked."""


class Http:
    """Requests of one worker: addresses judged, redirects counted, bodies capped, a deadline for all of it."""

    def __init__(self, timeout: float = TIMEOUT, tries: int = 2, agent: str = "Mozilla/5.0", private: bool = False, limit: int = BODY_LIMIT):
        self.timeout, self.tries, self.agent, self.private, self.limit = timeout, tries, agent, private, limit
        self.opener = build_opener(_Stay())

    def judged(self, url: str) -> None:
        import socket

        parts = urlsplit(url)
        if parts.scheme not in ("http", "https") or not parts.hostname or parts.username is not None:
            raise Refused("no plain web address")
        port = parts.port or (443 if parts.scheme == "https" else 80)
        found = {x[4][0] for x in socket.getaddrinfo(parts.hostname, port, type=socket.SOCK_STREAM)}
        if not self.private and not all(map(is_public, found)):
            raise Refused("the host has an address that is not public")

    def once(self, url: str, until: float, headers: dict[str, str] | None = None):
        """status, headers, body of one request."""
        self.judged(url)
        left = max(0.1, until - time.monotonic())
        try:
            answer = self.opener.open(Request(url, headers={"User-Agent": self.agent} | (headers or {})), timeout=left)
        except HTTPError as e:
            answer = e
        with answer:
            parts, size = [], 0
            while size <= self.limit and (part := answer.read(1 << 16)):
                parts.append(part)
                size += len(part)
                if time.monotonic() > until:
                    raise TimeoutError("the answer took too long")
            if size > self.limit:
                raise ValueError(f"the answer is over {self.limit} bytes")
            return answer.status, {k.lower(): v for k, v in answer.headers.items()}, b"".join(parts)

    def get(self, url: str, headers: dict[str, str] | None = None):
        """status, headers, body, error: after redirects and, where an answer asks for it, another try."""
        until, at, hops, error, answer = time.monotonic() + self.timeout, url, 0, None, (None, {}, None)
        attempt = 0
        while attempt < self.tries and time.monotonic() < until:
            try:
                answer, error = self.once(at, until, headers), None
            except Refused as e:
                return None, {}, None, str(e)
            except (OSError, ValueError) as e:
                error, attempt = f"{type(e).__name__}: {e}", attempt + 1
                continue
            status, given, _ = answer
            if status in REDIRECT and given.get("location"):
                at, hops = urljoin(at, given["location"]), hops + 1
                if hops > MAX_REDIRECTS:
                    return status, given, None, "too many redirects"
                continue
            attempt += 1
            if status in RETRY and attempt < self.tries:
                asked = given.get("retry-after", "")
                time.sleep(max(0.0, min(float(asked) if asked.isdigit() else 0.8 * 2 ** (attempt - 1), 30.0, until - time.monotonic())))
                continue
            break
        return *answer, error

    def download(self, url: str, path: str, chunk: int = 4 << 20, most: int = 512 << 20, seconds: float = 600.0) -> int:
        """The file behind a url in pieces, going on from what ``path`` holds; its size.  Pieces shrink after failures."""
        until, bad = time.monotonic() + seconds, 0
        while time.monotonic() < until:
            have = os.path.getsize(path) if os.path.exists(path) else 0
            if have > most:
                raise ValueError(f"the file is over {most} bytes")
            status, headers, body, error = self.get(url, {"Range": f"bytes={have}-{have + chunk - 1}"})
            if status == 416 or (status == 206 and not body):
                return have
            if status not in (200, 206) or body is None:
                bad, chunk = bad + 1, max(1 << 16, chunk // 2)
                if bad > 4:
                    raise OSError(error or f"status {status}")
                continue
            with open(path, "wb" if status == 200 else "ab") as f:
                f.write(body)
            total = headers.get("content-range", "").rpartition("/")[2]
            size = os.path.getsize(path)
            if status == 200 or (total.isdigit() and size >= int(total)):
                return size
        raise TimeoutError("the download took too long")


class HttpFetcher:
    """Live answers: requests run on executors, a partition one after another; ``log`` says how each went."""

    def __init__(self, gap: float = 0.0, **settings):
        self.gap, self.settings = gap, settings

    def fetch(self, urls: DataFrame) -> DataFrame:
        gap, settings = self.gap, self.settings

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            http = Http(**settings)
            for part in parts:
                rows = []
                for url in part["url"]:
                    began = time.monotonic()
                    status, headers, body, error = http.get(url)
                    took = time.monotonic() - began
                    kind = "blocked" if status in BLOCKED else error or "answered"
                    rows.append((url, status, headers, body, error, f"{status} {kind} {took:.1f} s"))
                    time.sleep(gap)
                frame = pd.DataFrame(rows, columns=[c.split()[0] for c in ANSWER.split(", ")])
                yield frame.astype({"status": "Int32"})

        return urls.select("url").distinct().mapInPandas(run, ANSWER)


def titles_of(urls: DataFrame, fetcher: Fetcher) -> DataFrame:
    """url and title of pages that have one."""
    from loomwick.functions.encoding import decode_body
    from loomwick.functions.html import page_title

    pages = fetcher.fetch(urls.select("url").distinct()).filter("status between 200 and 299")
    named = pages.select("url", page_title(decode_body(F.col("content"), F.col("headers"))).alias("title"))
    return named.filter("coalesce(title, '') <> ''")

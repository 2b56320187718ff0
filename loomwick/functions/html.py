"""HTML as columns and rows: tags, attributes, texts of elements, embedded JSON, plain text."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf, udtf

from loomwick.functions.dates import dimension
from loomwick.functions.text import ascii_lower, one_space
from loomwick.types import plain, struct

#: A tag ends at the first >; a < before it starts over.  Attributes come double, single or unquoted.
TAG = r"<([\p{L}\p{N}:_\-]++)([^<>]*+)>"
ATTR = r"""(?<![\p{L}\p{N}_:\-])([\p{L}\p{N}_:\-]++)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
#: Fixed value: how much of a page's head is looked at.
HEAD_LIMIT = 60_000
#: Meta keys that name a page's picture, in order.
IMAGE_KEYS = ["og:image", "og:image:url", "twitter:image", "twitter:image:src"]


def iter_tags(html: Column, names: Iterable[str]) -> Column:
    """Start tags of these names in page order: array of struct(name, raw)."""
    tags = F.transform(
        F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TAG), F.lit(0)),
        lambda t: F.struct(F.lower(F.regexp_extract(t, TAG, 1)).alias("name"), F.regexp_extract(t, TAG, 2).alias("raw")),
    )
    return F.filter(tags, lambda t: t["name"].isin([n.lower() for n in names]))


def attribute(raw: Column, key: str) -> Column:
    """The value of an attribute of a tag; of several the last; null if there is none.  Values stay escaped."""
    found = F.filter(F.regexp_extract_all(raw, F.lit(ATTR), F.lit(0)), lambda a: ascii_lower(F.regexp_extract(a, ATTR, 1)) == key)
    last = F.try_element_at(found, F.lit(-1))
    return F.coalesce(*[F.when(F.regexp_extract(last, ATTR, k) != "", F.regexp_extract(last, ATTR, k)) for k in (2, 3, 4)], F.when(last.isNotNull(), ""))


def tag_text(html: Column, name: str, key: str | None = None, value: str | None = None) -> Column:
    """The whole text inside the first such element, up to its end tag; null if there is none or it is not closed."""
    opening = rf"<{name}(?=[\s/>])[^<>]*+>"
    if key is not None:
        opening = rf"""<{name}(?=[\s/>])(?=[^<>]*?[\s"'/]{key}\s*=\s*["']?{value}(?:["'\s>]))[^<>]*+>"""
    pattern = rf"(?is){opening}(.*?)</{name}"
    found = F.coalesce(html, F.lit("")).rlike(pattern)
    return F.when(found, F.regexp_extract(F.coalesce(html, F.lit("")), pattern, 1))


def page_title(html: Column) -> Column:
    return one_space(tag_text(html, "title"))


def meta_values(html: Column, keys: Iterable[str]) -> Column:
    """The contents of meta tags with these names or properties: all of the first key, then of the next."""
    tags = iter_tags(html, ["meta"])
    of = lambda t: F.lower(F.coalesce(attribute(t["raw"], "property"), attribute(t["raw"], "name"), F.lit("")))
    pairs = F.transform(tags, lambda t: F.struct(of(t).alias("key"), attribute(t["raw"], "content").alias("content")))
    return F.concat(*[F.transform(F.filter(pairs, _has(k)), lambda p: p["content"]) for k in keys])


def _has(key: str):
    return lambda p: (p["key"] == key) & p["content"].isNotNull()


def thumb_candidates(html: Column, page_url: Column, limit: int = 24) -> Column:
    """Pictures worth judging, in order: social images, then images not declared smaller than 200."""
    images = F.filter(
        iter_tags(html, ["img"]),
        lambda t: (F.coalesce(attribute(t["raw"], "src"), F.lit("")) != "")
        & ~F.greatest(dimension(attribute(t["raw"], "width")), dimension(attribute(t["raw"], "height"))).between(1, 199),
    )
    raws = F.slice(F.concat(meta_values(F.substring(html, 1, HEAD_LIMIT), IMAGE_KEYS), F.transform(images, lambda t: attribute(t["raw"], "src"))), 1, limit + 1)
    return joined_urls(page_url, raws)


@pandas_udf(plain("array<string>"))
def joined_urls(bases: pd.Series, lists: pd.Series) -> pd.Series:
    """Addresses made absolute and unescaped, each once, without a proxy's size mark.  No built-in joins urls."""
    import re
    from html import unescape
    from urllib.parse import urljoin

    size = re.compile(r"=w\d+-h\d+-p-k-no-nu$", re.I)

    def one(base, raws):
        out = {}
        for raw in raws if raws is not None else ():
            try:
                url = size.sub("", urljoin(base or "", unescape((raw or "").strip())))
            except ValueError:
                continue
            if url:
                out[url] = None
        return list(out)

    return pd.Series([one(b, r) for b, r in zip(bases, lists, strict=True)])


def next_data(html: Column) -> Column:
    """The JSON that a page embeds for its script, as a variant; null if missing or broken."""
    return F.try_parse_json(tag_text(html, "script", "id", "__NEXT_DATA__"))


@pandas_udf(plain("string"))
def unescape(texts: pd.Series) -> pd.Series:
    from html import unescape as plain

    return texts.map(plain, na_action="ignore")


@pandas_udf(plain("string"))
def html_to_text(pages: pd.Series) -> pd.Series:
    """Plain text: scripts, styles and tags dropped, blocks on lines of their own, entities decoded."""
    import re
    from html import unescape as plain

    hidden = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b[^<>]*>.*?(?:</\1\s*>|\Z)")
    block = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|blockquote|pre|section|article|header|footer|nav|aside|figure|dd|dt|dl)\b[^<>]*>")
    tag = re.compile(r"<[a-zA-Z/!?][^<>]*>")

    def one(page):
        text = plain(tag.sub("", block.sub("\n", hidden.sub(" ", page))))
        return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)

    return pages.map(one, na_action="ignore")


class Tree:
    """The elements of a page as rows: number, parent, depth, name, attributes, and where in the page each starts and ends.

    Void elements have no content; an end tag closes what is open inside its element; stray end tags are passed over;
    what is open at the end of the page ends there.
    """

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self, page: str):
        from html.parser import HTMLParser

        tree = self
        self.rows: list[list] = []

        class Reader(HTMLParser):
            def at(self):
                line, column = self.getpos()
                return starts[line - 1] + column

            def handle_starttag(self, tag, attrs):
                k, begin = len(tree.rows), self.at()
                end = begin + len(self.get_starttag_text())
                parent = tree.open[-1] if tree.open else -1
                named = {a: v or "" for a, v in reversed(attrs)}
                tree.rows.append([k, parent, len(tree.open), tag, named, end, end])
                if tag not in Tree.VOID:
                    tree.open.append(k)

            def handle_startendtag(self, tag, attrs):
                self.handle_starttag(tag, attrs)
                if tag not in Tree.VOID:
                    tree.open.pop()

            def handle_endtag(self, tag):
                if any(tree.rows[k][3] == tag for k in tree.open):
                    while tree.rows[(k := tree.open.pop())][3] != tag:
                        tree.rows[k][6] = self.at()
                    tree.rows[k][6] = self.at()

        starts = [0]
        for line in page.split("\n"):
            starts.append(starts[-1] + len(line) + 1)
        self.open: list[int] = []
        reader = Reader(convert_charrefs=False)
        reader.feed(page)
        reader.close()
        for k in self.open:
            self.rows[k][6] = len(page)


@udtf(returnType=struct("pos int, parent int, depth int, name string, attrs map<string,string>, inner string"))
class Elements:
    """Every element of a page in document order, with what stands between its tags."""

    def eval(self, page: str):
        for k, parent, depth, name, attrs, start, end in Tree(page or "").rows:
            yield k, parent, depth, name, attrs, (page or "")[start:end]


@pandas_udf(plain("string"))
def region(pages: pd.Series) -> pd.Series:
    """The inside of a page's main region: the first article, main or role=main, else the body, else the page."""

    def one(page):
        rows = Tree(page).rows
        tests = (lambda r: r[3] == "article", lambda r: r[3] == "main", lambda r: r[4].get("role") == "main", lambda r: r[3] == "body")
        found = next((r for test in tests for r in rows if test(r)), None)
        return page if found is None else page[found[5] : found[6]]

    return pages.map(one, na_action="ignore")


def region_text(page: Column) -> Column:
    return html_to_text(region(page))


@udtf(returnType=struct("pos int, path string, node string"))
class JsonObjects:
    """Every object inside a JSON text in document order, as text; nothing for broken JSON."""

    def eval(self, text: str) -> Iterator[tuple[int, str, str]]:
        try:
            stack = [("$", json.loads(text))] if text else []
        except ValueError:
            return
        pos = 0
        while stack:
            path, node = stack.pop()
            if isinstance(node, dict):
                yield pos, path, json.dumps(node, ensure_ascii=False)
                pos += 1
                stack.extend((f"{path}.{k}", v) for k, v in reversed(node.items()))
            elif isinstance(node, list):
                stack.extend((f"{path}[{k}]", v) for k, v in reversed(list(enumerate(node))))

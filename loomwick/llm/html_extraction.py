"""HTML extraction: the main text of pages by two-pass block rules.

A page is cut into blocks at block-level tags.  First pass, each block alone: blocks inside menus, headers,
footers, sidebars, notices, adverts, forms and reader comments (by element, role, or the words of class and id)
and blocks of mostly link text are boilerplate; long blocks rich in stop words are content; the rest is
ambiguous.  Stop words are those of English, French, German and Spanish: on pages in other languages long blocks
are content without them.  Second pass: an ambiguous block takes the label of its nearest decided neighbours; the edges of an
article or main element count as decided content.  Content blocks are joined in page order.

The page is scanned once; attributes are read only where a tag has some.  Defined cases: a null or empty page, or
one without content, gives an empty text; unclosed and stray tags are tolerated; text in an unclosed script, style
or comment is dropped; repeated rows give equal rows; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwick.llm.common import table

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.30
LINKS_MOST, LINKS_IN_ARTICLE = 0.33, 0.80
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it not of on or she that the their they this to was we were which with you "
    "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas plus pour qu que qui sa se ses son sur un une vous "
    "als am auch auf aus bei das dem den der des die ein eine einem einen einer es für hat ich im ist mit nach nicht oder sich sie sind so um und von vor war wie wird zu zum zur "
    "al como con del el ella entre era esta este fue ha hay las lo los más me mi muy no o para pero por ser si sin sobre su sus también una y ya".split()
)

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template iframe noframes noembed xmp".split())
#: Elements of drawings and formulas: there "/>" closes any element, and the start of a block ends them.
FOREIGN = frozenset(("svg", "math"))
FOREIGN_HOLDS_BLOCKS = frozenset(("foreignobject", "annotation-xml", "desc", "mtext"))
CHOICES = frozenset(("select", "optgroup", "option"))
BAD_TAGS = frozenset("nav footer aside form fieldset menu dialog button label input option legend".split())
GOOD_TAGS = frozenset(("article", "main"))
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class and id that mark boilerplate, whole and as beginnings.
BAD_WORDS = frozenset("ad ads adv nav menu popup modal share social login signup cookie cookies gdpr consent notice toolbar pager".split())
BAD_STARTS = ("advert", "sponsor", "promo", "banner", "sidebar", "footer", "masthead", "navbar", "navigation", "breadcrumb", "comment", "disqus", "newsletter", "subscri", "related", "recommend", "widget", "paginat")
#: Elements that the start of another closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
PARTS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
LETTERS = re.compile(r"[^\W\d_]+")
LAST_LATIN = "\u024f"
WIDE = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\U00020000-\U0003ffff]")


def marks_boilerplate(name: str, attributes: str, inside_article: bool) -> bool:
    if name in BAD_TAGS or (name == "header" and not inside_article):
        return True
    if not attributes or attributes.isspace():
        return False
    for key, a, b, c in ATTR.findall(attributes):
        key = key.lower()
        if key == "hidden" or (key == "aria-hidden" and (a or b or c).lower() == "true"):
            return True
        if key == "role" and (a or b or c).lower() in BAD_ROLES:
            return True
        if key == "style" and "display:none" in (a or b or c).replace(" ", "").lower():
            return True
        if key in ("class", "id") and name not in GOOD_TAGS and name not in ("body", "html"):
            for word in PARTS.findall(CAMEL.sub(" ", a or b or c).lower()):
                if word in BAD_WORDS or word.startswith(BAD_STARTS):
                    return True
    return False


class Blocks:
    """The blocks of a page: text, characters of link text, boilerplate by markup, number of the article it is in."""

    def __init__(self, html: str):
        self.found: list[tuple[str, int, bool, int]] = []
        self.text: list[str] = []
        self.linked = 0
        #: open elements: name, whether boilerplate, article number (0: none), whether in a link
        self.open: list[tuple[str, bool, int, bool]] = [("", False, 0, False)]
        self.articles = 0
        self._scan(html)
        self._flush()

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                _, bad, article, _ = self.open[-1]
                self.found.append((text, self.linked, bad, article))
            self.text, self.linked = [], 0

    def _add(self, raw: str) -> None:
        text = unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if self.open[-1][3]:
            self.linked += len(text.strip())

    def _scan(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self._add(html[at:])
                return
            if lt > at:
                self._add(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            m = TAG.match(html, lt)
            if m is None:
                following = html[lt + 1 : lt + 2]
                if following and (following in "!?/" or following.isalpha()):
                    end = html.find(">", lt)  # a declaration, or a tag with an unclosed quote
                    at = n if end < 0 else end + 1
                else:
                    self._add("<")
                    at = lt + 1
                continue
            at = m.end()
            name = m[2].lower()
            if m[1]:
                self._close(name)
            elif m[3].endswith("/") and (name in FOREIGN or self._in_foreign()):
                continue
            elif name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
                if end is None:
                    return
                if name == "xmp":  # shown as it stands
                    self.text.append(html[at : end.start()])
                gt = html.find(">", end.end())
                at = n if gt < 0 else gt + 1
            else:
                self._start(name, m[3])

    def _in_foreign(self) -> int:
        """The number of the open drawing or formula that a block would end, 0 if there is none."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in FOREIGN:
                return k
            if self.open[k][0] in BLOCKS or self.open[k][0] in FOREIGN_HOLDS_BLOCKS:
                return 0
        return 0

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text.append("\n")
            return
        if name == "body":
            self._flush()
            while len(self.open) > 1 and self.open[-1][0] == "head":
                self.open.pop()
        block = name in BLOCKS
        if block and name not in CHOICES:
            ended = self._in_foreign() or len(self.open)
            while ended > 1 and self.open[ended - 1][0] in CHOICES:
                ended -= 1
            if ended < len(self.open):
                self._flush()
                del self.open[ended:]
        if block and self.open[-1][0] == "p" and name != "p":
            self._flush()
            self.open.pop()
        if name == "p" or name in CLOSES:
            closes = CLOSES.get(name, {"p"})
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] in closes:
                    self._flush()
                    del self.open[k:]
                    break
                if self.open[k][0] in BLOCKS and self.open[k][0] != "p":
                    break
        _, bad, article, link = self.open[-1]
        worse = bad or name == "head" or marks_boilerplate(name, attributes, article > 0)
        if block or worse != bad:
            self._flush()
        if name in VOID:
            return
        if name in GOOD_TAGS and not article and not worse:
            self.articles += 1
            article = self.articles
        self.open.append((name, worse, article, link or name == "a"))

    def _close(self, name: str) -> None:
        if name == "p" and all(o[0] != "p" for o in self.open):
            self._flush()
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == name:
                if name in BLOCKS or self.open[k][1] != self.open[k - 1][1]:
                    self._flush()
                elif any(o[0] in BLOCKS for o in self.open[k:]):
                    # an inline end tag closes no block: only the element itself goes
                    link = self.open[k - 1][3]
                    rest = [(o[0], o[1], o[2], link if name == "a" else o[3]) for o in self.open[k + 1 :]]
                    self.open[k:] = rest
                    return
                del self.open[k:]
                return


def stop_share(text: str) -> float:
    words = LETTERS.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def listed(text: str) -> bool:
    """Whether the text may be in a language of STOP_WORDS, by its script."""
    letters = [w[0] for w in LETTERS.findall(text)]
    return 2 * sum(c > LAST_LATIN for c in letters) <= len(letters)


def width(text: str) -> int:
    """Characters, those of scripts that write words without spaces counted three times."""
    return len(text) + 2 * len(WIDE.findall(text))


def label(text: str, linked: int, bad: bool, article: int, stop: float, known: bool = True) -> bool | None:
    """First pass: True for content, False for boilerplate, None if ambiguous.

    Where the page's language is not known, missing stop words say nothing: there long blocks are content.
    """
    density = linked / len(text)
    if bad or density > (LINKS_IN_ARTICLE if article else LINKS_MOST):
        return False
    if len(text) >= SHORT and stop >= (STOP_LOW if len(text) >= LONG else STOP_HIGH):
        return True
    if not article and stop < STOP_LOW / 3:
        if not known or not listed(text):
            return True if width(text) >= LONG else None
        if len(text) >= LONG:
            return False
    return None


def known_language(blocks: list[tuple[str, int, bool, int]], stops: list[float]) -> bool:
    """Whether the blocks that markup and links leave have the stop words of a listed language."""
    left = [(len(text), stop) for (text, linked, bad, _), stop in zip(blocks, stops, strict=True) if not bad and linked <= LINKS_MOST * len(text)]
    return sum(n * stop for n, stop in left) >= STOP_LOW * sum(n for n, _ in left)


def extract(html: str | None) -> str:
    blocks = Blocks(html or "").found
    stops = [0.0 if bad else stop_share(text) for text, _, bad, _ in blocks]
    known = known_language(blocks, stops)
    labels = [label(*b, stop, known) for b, stop in zip(blocks, stops, strict=True)]
    before: list[tuple[bool, int] | None] = []
    for way in (1, -1):
        seen, last, article = [], None, 0
        for k in range(len(blocks))[::way]:
            if blocks[k][3] != article:
                article = blocks[k][3]
                last = (True, k - way) if article else None
            if labels[k] is not None:
                last = (labels[k], k)
            seen.append(last)
        before.append(seen[::way])
    out, plain = [], not any(b[3] for b in blocks) and all(x is None for x in labels)
    # without known stop words and long blocks nothing speaks for content: then markup and links alone decide
    open_ = not known and not any(b[3] for b in blocks) and True not in labels
    for k, (text, _, _, _) in enumerate(blocks):
        if labels[k] is None:
            near = [x for x in (before[0][k], before[1][k]) if x is not None]
            # the nearer decides, content at equal distance; a page with nothing decided is taken as it is
            good = open_ or (max(near, key=lambda x: (-abs(x[1] - k), x[0]))[0] if near else plain)
        else:
            good = labels[k]
        if good:
            out.append(text)
    return " ".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    cols = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return cols.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))

"""Text as columns: white space, case, cuts, clean-up rules, keywords and keys for comparing texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ELLIPSIS = "…"
#: English words that are no keywords.
STOP_WORDS = (
    "this that with from have will what when your about into they them their there were been more than also just like".split()
)


def strip(s: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\A\s+", ""), r"(?U)\s+\z", "")


def ascii_lower(s: Column) -> Column:
    """A-Z alone in lower case: keeps every length, unlike lower()."""
    return F.translate(s, UPPER, LOWER)


def blank(s: Column) -> Column:
    """Null or white space alone."""
    return s.isNull() | ~s.rlike(r"(?U)\S")


def one_space(s: Column) -> Column:
    return strip(F.regexp_replace(s, r"(?U)\s+", " "))


def compact(s: Column, limit: int = 96) -> Column:
    """White space collapsed; over the limit cut to it, the last character an ellipsis."""
    flat = one_space(F.coalesce(s, F.lit("")))
    cut = F.concat(F.regexp_replace(F.substring(flat, 1, limit - 1), r"(?U)\s+\z", ""), F.lit(ELLIPSIS))
    return F.when(F.length(flat) > limit, cut).otherwise(flat)


def snippet(s: Column, start: Column | int = 0, width: int = 60) -> Column:
    """A window of the text that begins a third of its width before start."""
    first = F.greatest(F.lit(0), (F.lit(start) if isinstance(start, int) else start) - width // 3)
    return F.regexp_replace(F.substring(s, first + 1, F.lit(width)), r"(?U)\s+", " ")


def lines(s: Column) -> Column:
    """Lines with white space collapsed; empty ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(s, F.lit("")), "\n"), one_space), lambda x: x != "")


def keywords(s: Column) -> Column:
    """Latin words of four letters or more without stop words, pairs of Han characters, numbers of two digits or more."""
    low = F.lower(F.coalesce(s, F.lit("")))
    words = F.array_except(F.regexp_extract_all(low, F.lit(r"([a-z][a-z0-9]{3,})")), F.array(*[F.lit(w) for w in STOP_WORDS]))
    runs = F.regexp_extract_all(low, F.lit(r"([\x{4e00}-\x{9fff}]{2,})"))
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda k: F.substring(r, k, F.lit(2)))))
    return F.array_union(F.array_union(words, pairs), F.regexp_extract_all(low, F.lit(r"([0-9]{2,})")))


def share_key(s: Column, mark: str = "↛") -> Column:
    """What texts that repeat each other have in common: the first 300 characters without white space and end marks."""
    return F.substring(F.regexp_replace(F.rtrim(s, F.lit(mark)), r"(?U)\s+", ""), 1, 300)


#: Rules that reduce markdown to prose, in order (pattern, replacement).
MARKDOWN_IMAGE = (
    r"(?i)!\[[^\[\]]*+\]\([^()]*+\)"
    r"|\[[ \t]*+!?[ \t]*+\[?[ \t]*+(?:Image|圖片|图片|圖像|图像|Figure|插圖|插图)[ \t]*+\d*+[ \t]*+[:：]?[^\[\]]*+\](?:\([^()]*+\))?[ \t]*+\]?"
)
MARKDOWN_LINK = r"\[([^\[\]\n]*+)\]\((?:https?:|/|#|mailto:)[^()\s]*+\)"
MARKDOWN_LINES = [
    (r"(?m)^[ \t]*+(?:[-*_][ \t]*+){3,}$", ""),
    (r"(?m)^[ \t]{0,3}#{1,6}[ \t]*+", ""),
    (r"(?m)^[ \t]{0,6}(?:[-*+]|\d{1,2}[.)])[ \t]++", ""),
    (r"<?https?://[^\s)\]<>，。）]+>?", ""),
    (r"\*\*|__|\*|`|~~", ""),
    (r"(?m)^[ \t\]\[)(|:-]++|(?<![ \t\[(|])[ \t\[(|]++$", ""),
]
#: Rules that reduce board posts to prose, in order.
BOARD_LINES = [
    (r"(?m)^[ \t]*+(?:作者|標題|時間|看板)[ \t:：].*$", ""),
    (r"(?m)^[ \t]*+※[ \t]*+(?:發信站|文章網址|編輯[ \t]*+[:：]|伸謝)[^\n]*$", ""),
    (r"(?:^|(?<=[\s。！？]))(?:推|噓|嘘|→)[ \t]*+[A-Za-z0-9_]{2,20}[ \t]*+[:：][ \t]*+", "\n"),
    (r"(?<!\s)\s*+(?:\d{1,3}(?:\.\d{1,3}){3})?\s*+\d{2}/\d{2}\s++\d{2}:\d{2}\s*+", "\n"),
    (r"(?<![\s\d.])\s*+\d{1,3}(?:\.\d{1,3}){3}\s*+", " "),
    (r"[ \t]{2,}", " "),
    (r"\n{2,}", "\n"),
]
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape_common(s: Column) -> Column:
    """The entities that feeds and captions use; the general form is functions.html.unescape."""
    for entity, char in ENTITIES:
        s = F.replace(s, F.lit(entity), F.lit(char))
    return s


def _rules(s: Column, rules: list[tuple[str, str]]) -> Column:
    for pattern, to in rules:
        s = F.regexp_replace(s, pattern, to)
    return s


def clean_markdown(s: Column) -> Column:
    """Markdown to prose; link texts stay.  Links may nest three deep."""
    s = F.regexp_replace(unescape_common(F.coalesce(s, F.lit(""))), MARKDOWN_IMAGE, "")
    for _ in range(3):
        s = F.regexp_replace(s, MARKDOWN_LINK, "$1")
    return _rules(s, MARKDOWN_LINES)


def clean_board_post(s: Column) -> Column:
    return strip(_rules(F.coalesce(s, F.lit("")), BOARD_LINES))


def note_of_mark(s: Column) -> Column:
    """A mark's own note: rating and tag lines dropped, labels cut, empty lines dropped."""
    rest = F.filter(lines(s), lambda x: ~x.rlike(r"^(?:推荐|推薦|标签|標籤|评分|評分)\s*[:：]"))
    return F.array_join(F.filter(F.transform(rest, lambda x: strip(F.regexp_replace(x, r"^(?:备注|備註|短评|短評)\s*[:：]\s*", ""))), lambda x: x != ""), "\n")


def classify_body(body: Column, meta: Column, least: int = 200) -> Column:
    """struct(text, kind): a real body, else the blurb, else nothing."""
    body, meta = F.coalesce(body, F.lit("")), F.coalesce(meta, F.lit(""))
    real = (F.length(body) >= least) | (body.rlike(r"[。！？.!?]") & (F.length(body) >= F.greatest(F.lit(80), F.length(meta))))
    pair = lambda text, kind: F.struct(text.alias("text"), F.lit(kind).cast("string").alias("kind"))
    return (
        F.when(real, pair(body, "body"))
        .when((meta != "") | (body != ""), pair(F.when(meta != "", meta).otherwise(body), "meta"))
        .otherwise(pair(F.lit(None).cast("string"), None))
    )


#: A subset of our own: common characters whose simplified and traditional forms differ one to one.
SIMPLIFIED = "们这个来时说对国学会过还没为开点门问间关东车长马鸟鱼书买卖读写电话听见观现实际报纸网络软认识让请谢语词译文华汉万与专业丝两严丧丰临丽举义乌乐习乡亚产亲仅从仓仪价众优伟传伤伦伪体余佣侠侣侥侦侧侨债倾储儿兑党兰兴养兽军农冯冲决况冻净凉减凤凭凯击刘则刚创删别剑剧劝办务动励劲劳势勋区医协单卢卫厂厅历厉压厌厕县发变叶号吓员响团园围图圆圣场坏块坚坛垒垦"
TRADITIONAL = "們這個來時說對國學會過還沒為開點門問間關東車長馬鳥魚書買賣讀寫電話聽見觀現實際報紙網絡軟認識讓請謝語詞譯文華漢萬與專業絲兩嚴喪豐臨麗舉義烏樂習鄉亞產親僅從倉儀價眾優偉傳傷倫偽體餘傭俠侶僥偵側僑債傾儲兒兌黨蘭興養獸軍農馮衝決況凍淨涼減鳳憑凱擊劉則剛創刪別劍劇勸辦務動勵勁勞勢勳區醫協單盧衛廠廳歷厲壓厭廁縣發變葉號嚇員響團園圍圖圓聖場壞塊堅壇壘墾"
HAN = r"[\x{3400}-\x{9fff}\x{f900}-\x{faff}]"


def key_text(s: Column) -> Column:
    """What is left of a text for comparing: letters and numbers in lower case, in simplified form."""
    return F.translate(F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"(?U)[^\p{L}\p{N}]+", ""), TRADITIONAL, SIMPLIFIED)


def variant(s: Column) -> Column:
    """hans or hant by which forms of the subset prevail; null where neither does."""
    count = lambda chars: F.length(F.coalesce(s, F.lit(""))) - F.length(F.translate(F.coalesce(s, F.lit("")), chars, ""))
    same = "".join(a for a, b in zip(SIMPLIFIED, TRADITIONAL, strict=True) if a == b)
    only = lambda chars: "".join(c for c in chars if c not in same)
    simple, full = count(only(SIMPLIFIED)), count(only(TRADITIONAL))
    return F.when(simple > full, "hans").when(full > simple, "hant")


def to_traditional(s: Column) -> Column:
    """The subset's simplified characters in traditional form; words are not exchanged."""
    return F.translate(s, SIMPLIFIED, TRADITIONAL)


def needs_translation(s: Column, least: float = 0.1) -> Column:
    """Whether a text that has letters has few Han characters among them."""
    letters = F.length(F.regexp_replace(F.coalesce(s, F.lit("")), r"(?U)\P{L}+", ""))
    han = F.regexp_count(F.coalesce(s, F.lit("")), F.lit(HAN))
    return (letters > 0) & (han < least * letters)

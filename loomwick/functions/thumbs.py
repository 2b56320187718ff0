"""Which picture addresses are worth showing: one ordered decision list, with reasons."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomwick.functions.url import host_in

#: Patterns and vocabularies of the decision list.
DENIED = r"(?i)\Ahttps?://kottke\.org/.*/images/\d{4}/logo-colors/"
TRUSTED = r"(?i)\Ahttps?://lh\d+\.googleusercontent\.com/blogger_img_proxy/"
EXTENSION = r"(?i)\.(?:png|jpe?g|gif|webp|avif|svg)(?:$|[?#])"
ASSET_DIR = r"(?i)/(?:themes?|wp-includes|plugins?|icons?|css|skin|sprites?|emoji|ui)/"
STOCK = (
    r"(?i)shutterstock[_-]?\d*|istock(?:photo)?|gettyimages?[-_]?\d*|gyi\d{6,}"
    r"|depositphotos|adobestock|dreamstime|alamy|123rf|bigstock|stockphoto|unsplash"
    r"|photo-\d{10,}-[0-9a-f]{8,}|pexels(?:-photo)?[-_]?\d*|\bap[-_]?photo\b|associated[-_]press"
    r"|\d{4}-?\d{2}-?\d{2}t\d{6}z|\brt[sxr][a-z0-9]{5,}|\bafp[-_]?\d{6,}|\bepa[-_]?(?:efe[-_]?)?\d{6,}"
)
TEMPLATE = (
    r"(?i)og[-_]?image|og[-_]?default|social[-_]?(?:card|share|image|preview)"
    r"|twitter[-_]?card|share[-_]?(?:image|card)|card[-_]?bg"
    r"|cover[-_]?template|template[-_]?cover|[-_]template\b|^template"
    r"|(?:^|[-_])default(?:[-_](?:image|thumb|cover|banner))?(?:[-_]|$)"
    r"|placeholder|fallback|no[-_]?image|dummy|generic[-_]?(?:image|cover)"
    r"|\blogo\b|wordmark|favicon|avatar|profile[-_]?pic|headshot|portrait[-_]?shot"
    r"|\bbanner\b|\bheader[-_]?(?:image|bg)?\b|hero[-_]?(?:image|bg)"
    r"|watermark|spacer|pixel|blank|transparent|1x1|use[-_]this(?:[-_]|$)"
    r"|screen[-_ ]?shot|screencap|scrn|\bcapture\b|\bdemo\b|\bpreview\b|\bmockup\b|\bui[-_]"
    r"|collage|montage|grid[-_]?of|poster[-_]?(?:grid|collage|set)"
    r"|line[-_]?up\b|\bcombo\b|side[-_]by[-_]side[-_]?photos?"
)
PROCESSING = r"(?i)\A(?:x-oss-process|x-image-process|x-bce-process|imageMogr2|imageView2)(?:[=/]|$)"
CHART = """axis axes chart charts graph graphs plot plotted map maps mapped mapping
diagram schematic figure fig table matrix index indices ratio ratios rate rates share
shares percent percentage pct scale scaled distribution breakdown composition split
spread trend trends trending trajectory curve curves growth decline change delta monitor
monitoring tracker tracking dashboard scorecard comparison compare compared versus vs flip
gap gaps timeline history historical forecast projection projected outlook heatmap treemap
sankey waterfall scatter histogram bubble radar donut quarterly annual monthly yearly ytd
yoy qoq cagr bloomberg reuters-graphics ft economist statista ourworldindata visualcapitalist""".split()
PHOTO = """photo photograph photographed picture pic image img shot shots snapshot close
closeup up view viewing views viewed angle aerial overhead portrait portraits standing
sitting seated walking holding wearing smiling posing poses posed looking facing gesturing
speaking talking waving exterior interior facade storefront skyline streetscape landscape
location located site situated near outside inside man woman men women people person crowd
worker workers employee background backdrop foreground blurred bokeh attends attending
arrives arriving during ceremony conference press generic stock illustrative illustration
decorative""".split()
CHROME = """loader spinner throbber skeleton holder empty icon icons sprite sprites qrcode
opengraph ogimg arrow arrows divider separator overlay texture btn button nav navbar badge
ribbon follow subscribe scrolling""".split()
GRAPHIC = """line lines rule hr dot dots bar bars bg background spacer pixel sep divider
shadow mask gradient texture blank dummy placeholder empty none null loader spinner""".split()
LAYOUT = """content contents main top bottom left right inner outer wrap wrapper box block
section area panel col row grid cell border edge corner middle center centre side foot base
common default style theme layout title text head header footer heading caption label item
list nav menu sub""".split()


def _words(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def thumb_clean(url: Column) -> Column:
    """The address without image-processing parameters; the others stay in order."""
    base, rest = F.regexp_extract(url, r"(?s)\A([^?]*)", 1), F.regexp_extract(url, r"(?s)\A[^?]*\?(.*)\z", 1)
    query, fragment = F.regexp_extract(rest, r"(?s)\A([^#]*)", 1), F.regexp_extract(rest, r"(?s)\A[^#]*(#.*)?\z", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(PROCESSING)), "&")
    return F.when(F.contains(url, F.lit("?")), F.concat(base, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""), fragment)).otherwise(url)


def thumb_usable(url: Column, denied: Iterable[str] = (), trusted_hosts: Iterable[str] = ()) -> Column:
    """struct(ok, reason) by the first rule that decides."""
    url = F.coalesce(url, F.lit(""))
    path = F.regexp_extract(url, r"(?s)\A([^?#]*)", 1)
    bare = F.lower(F.trim(path))
    name = F.substring_index(F.rtrim(path, F.lit("/")), "/", -1)
    stem = F.regexp_replace(name, r"(?i)\.[a-z0-9]+\z", "")
    stem = F.regexp_replace(F.regexp_replace(stem, r"[-_]\d{2,4}x\d{2,4}\z", ""), r"(?i)[-_@][123]x\z", "")
    tokens = F.filter(F.split(F.lower(stem), "[^a-z0-9]+"), lambda t: t != "")
    known = F.array_distinct(tokens)
    one = F.element_at(F.concat(tokens, F.array(F.lit(""))), 1)
    listing = lambda words: F.array_join(F.array_sort(F.array_intersect(known, _words(words))), ", ")
    has = lambda words: F.arrays_overlap(known, _words(words))
    say = lambda ok, *why: F.struct(F.lit(ok).alias("ok"), F.concat(*[F.lit(w) if isinstance(w, str) else w for w in why]).alias("reason"))
    return (
        F.when(~F.lower(url).rlike(r"\Ahttps?://"), say(False, "not an absolute url"))
        .when(F.array_contains(_words([d.lower() for d in denied]), bare) | bare.rlike(DENIED), say(False, "explicitly denied url"))
        .when(F.endswith(bare, F.lit(".svg")), say(False, "svg (usually a logo or icon)"))
        .when(host_in(url, list(trusted_hosts)) | url.rlike(TRUSTED), say(True, "trusted image host"))
        .when(~path.rlike(EXTENSION), say(False, "no image extension"))
        .when(F.length(stem) < 3, say(False, "filename too short to judge"))
        .when(path.rlike(ASSET_DIR), say(False, "served from an asset/theme directory"))
        .when(F.concat_ws(" ", stem, url).rlike(STOCK), say(False, "stock / wire-service filename"))
        .when(stem.rlike(TEMPLATE), say(False, "template / furniture / screenshot"))
        .when(F.size(tokens) == 0, say(False, "no readable filename"))
        .when((F.size(tokens) == 1) & ((F.length(one) >= 16) | one.rlike(r"\A[0-9]+\z")), say(False, "opaque id / hash filename"))
        .when(has(CHART), say(True, "chart vocabulary in filename"))
        .when((F.size(tokens) <= 4) & has(CHROME), say(False, "interface chrome (", listing(CHROME), ")"))
        .when((F.size(F.array_except(known, _words(GRAPHIC + LAYOUT))) == 0) & has(GRAPHIC), say(False, "decoration filename (", F.array_join(tokens, "-"), ")"))
        .when(has(PHOTO), say(False, "photographic wording (", listing(PHOTO), ")"))
        .when(F.size(tokens) >= 5, say(False, "descriptive phrase (", F.size(tokens).cast("string"), " tokens)"))
        .otherwise(say(True, "short topical filename"))
    )


def thumb_pick(urls: Column, page_url: Column, skip_hosts: Iterable[str] = ()) -> Column:
    """The first usable address after cleaning; null for pages whose host opted out."""
    clean = F.filter(F.transform(F.coalesce(urls, F.array().cast("array<string>")), thumb_clean), lambda u: thumb_usable(u)["ok"])
    return F.when(~host_in(page_url, list(skip_hosts)), F.try_element_at(clean, F.lit(1)))


def thumb_still_valid(thumbnail: Column, page_url: Column, skip_hosts: Iterable[str] = ()) -> Column:
    return F.when(host_in(page_url, list(skip_hosts)), F.struct(F.lit(False).alias("ok"), F.lit("host opted out").alias("reason"))).otherwise(
        thumb_usable(thumbnail)
    )

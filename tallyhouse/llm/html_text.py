"""Main text of web pages by two passes over blocks.

Pass 1 weighs every block: links, length and stop words of its own, and as evidence the containers that say what they are
(navigation, forms, adverts, comments, ... or the article). Short blocks and middling ones stay open. Pass 2 lets open
blocks inherit from the nearest decided neighbours on both sides.
"""

import html
import re

import pandas as pd
from pyspark.sql import functions as F

from tallyhouse.llm import base

# Elements of HTML by what they do to text.
SKIPPED = {
    "script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title", "textarea", "select",
    "button", "canvas", "audio", "video", "map", "datalist",
}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
BREAKING = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html",
    "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
CONTAINERS = {
    "article", "aside", "blockquote", "body", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form",
    "header", "main", "menu", "nav", "ol", "section", "table", "ul",
}
AROUND_TEXT = {"aside", "dialog", "fieldset", "footer", "form", "menu", "nav"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# Words in class and id attributes, and roles, that mark what stands around the text.
AROUND_WORDS = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
    "promotion", "sidebar", "side", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer",
    "masthead", "comment", "comments", "disqus", "reply", "replies", "cookie", "cookies", "consent", "gdpr", "notice",
    "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "login", "social", "share",
    "sharing", "related", "recommended", "widget", "pagination", "pager", "skip", "toolbar", "search",
}
AROUND_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar",
}
# Frequent function words of the languages.
STOP_WORDS = frozenset(
    """
    a an and are as at be been but by can could did do for from had has have he her his i if in into is it its me more my
    no not of on one or our out she so some than that the their them then there these they this to up was we were what
    when which who will with would you your
    aber als am an auch auf aus bei bin bis da das dass dem den der des die doch du durch ein eine einem einen einer er es
    für hat haben ich ihr im in ist ja kann man mit nach nicht noch nur oder sein sich sie sind so um und uns vom von vor
    war was wenn werden wie wir wird zu zum zur über
    au aux avec ce ces cette comme dans de des du elle elles en est et eu fait il ils je la le les leur lui ma mais me même
    mes ne nos nous on ont ou où par pas plus pour qu que qui sa se ses son sont sur tout très tu un une vous été être
    al algo como con cual cuando de del desde donde e el ella ellos en entre era es esta este esto está fue ha hay la las
    lo los más me mi muy nada ni no nos o para pero por porque que quien se ser si sin sobre son su sus también tan te
    tiene todo un una uno y ya yo
    """.split()
)

LINKS_AT_MOST = 0.2
SHORT, LONG = 70, 200
STOPS_LOW, STOPS_HIGH = 0.30, 0.32
# Weights of a block's own words, and of where it stands. A sum above 0 is good, below 0 bad.
LONG_PROSE, FEW_STOPS, SHORT_LINKED, LINKS = 2, -1, -1, -3
IN_ARTICLE, BESIDE_ARTICLE, IN_AROUND = 2, -1, -3

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s+")


class Block:
    """One block: its text, characters of links, the containers it stands in, and its label."""

    __slots__ = ("text", "linked", "inside", "around", "label")

    def __init__(self, text, linked, inside, around):
        self.text, self.linked, self.inside, self.around, self.label = text, linked, inside, around, None


class Container:
    """An open or closed container: whether it marks what stands around the text, is an article, and its unlinked characters."""

    __slots__ = ("name", "mark", "article", "chars")

    def __init__(self, name, mark, article):
        self.name, self.mark, self.article, self.chars = name, mark, article, 0


def _says_around(name, attributes, in_article):
    if name in AROUND_TEXT or name == "header" and not in_article:
        return True
    if not attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        words = {w.lower() for w in _SPLIT.split(next((v for v in values if v), ""))}
        if words & (AROUND_ROLES if key.lower() == "role" else AROUND_WORDS):
            return True
    return False


def blocks(page):
    """The blocks of a page in order. Broken markup is read as far as it goes."""
    out, text, linked = [], [], 0
    # Open containers, and those that each block stands in.
    stack, inside, places = [], 0, []
    links, at = 0, 0

    def close():
        nonlocal text, linked
        joined = _SPACE.sub(" ", "".join(text)).strip()
        if joined:
            out.append(Block(joined, min(linked, len(joined)), False, False))
            places.append(tuple(c for c in stack if c.mark or c.article))
        text, linked = [], 0

    def take(raw):
        nonlocal linked
        raw = html.unescape(raw)
        text.append(raw)
        if links:
            linked += len(_SPACE.sub(" ", raw))

    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            take(page[at:])
            break
        if tag.start() > at:
            take(page[at : tag.start()])
        at = tag.end()
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if name in SKIPPED:
            if not tag.group(1) and not tag.group(3).endswith("/"):
                ends = re.compile(rf"</{re.escape(name)}\s*>" if name in RAW else rf"</{re.escape(name)}\b[^>]*>", re.I)
                end = ends.search(page, at)
                # Without an end, the head ends where the body begins; others run to the end of the page.
                if end is None and name == "head":
                    end = re.compile(r"(?=<body)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "br":
            text.append("\n")
            continue
        if name == "a":
            links = 0 if tag.group(1) else 1
            continue
        if name not in BREAKING:
            continue
        close()
        links = 0
        if name not in CONTAINERS:
            continue
        if not tag.group(1):
            if tag.group(3).endswith("/") and name in VOID:
                continue
            mark = _says_around(name, tag.group(3), inside > 0) and name not in ("article", "main", "body")
            stack.append(Container(name, mark, name in ("article", "main")))
            inside += name in ("article", "main")
        elif any(name == c.name for c in stack):
            while True:
                closed = stack.pop()
                inside -= closed.article
                if closed.name == name:
                    break
    close()
    weigh_containers(out, places)
    return out


def weigh_containers(parts, places):
    """Set `inside` and `around` of blocks from the containers that they stand in.

    A mark says nothing on a container of the largest article or, without one, of most of the page's text. Articles say
    nothing if most text outside marked containers stands outside them too, as teasers beside a body do.
    """
    total, holders = 0, {}
    for block, held in zip(parts, places):
        total += len(block.text) - block.linked
        for k, container in enumerate(held):
            container.chars += len(block.text) - block.linked
            holders[container] = held[:k]
    largest = max((c for c in holders if c.article), key=lambda c: c.chars, default=None)
    for container in holders:
        if container.mark and (container in holders[largest] if largest else 2 * container.chars > total):
            container.mark = False
    free = within = 0
    for block, held in zip(parts, places):
        block.around, block.inside = any(c.mark for c in held), any(c.article for c in held)
        if not block.around:
            free += len(block.text) - block.linked
            within += block.inside * (len(block.text) - block.linked)
    if 2 * within < free:
        for block in parts:
            block.inside = False


def first_pass(parts):
    """Label blocks as good, bad, near (middling) or short, by their own words and by the containers as evidence."""
    has_article = any(b.inside and not b.around for b in parts)
    for block in parts:
        words = _WORD.findall(block.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / max(len(words), 1)
        short = len(block.text) < SHORT
        if block.linked / len(block.text) > LINKS_AT_MOST:
            weight = LINKS
        elif short:
            weight = SHORT_LINKED if block.linked else 0
        elif stops >= STOPS_HIGH:
            weight = LONG_PROSE if len(block.text) > LONG else 0
        else:
            weight = 0 if stops >= STOPS_LOW else FEW_STOPS
        weight += IN_AROUND if block.around else IN_ARTICLE if block.inside else BESIDE_ARTICLE if has_article else 0
        block.label = "good" if weight > 0 else "bad" if weight < 0 else "short" if short else "near"


def second_pass(parts):
    """Open blocks take the label of their decided neighbours: of both if they agree, else of the nearer one.

    At equal distance a middling block is good and a short one bad. Beyond the ends of the page everything is bad.
    """
    decided = [i for i, b in enumerate(parts) if b.label in ("good", "bad")]
    before, nearest = -1, {}
    k = 0
    for i, block in enumerate(parts):
        while k < len(decided) and decided[k] <= i:
            before, k = decided[k], k + 1
        after = decided[k] if k < len(decided) else len(parts)
        if block.label in ("good", "bad"):
            continue
        left = parts[before].label if before >= 0 else "bad"
        right = parts[after].label if after < len(parts) else "bad"
        if left == right:
            nearest[i] = left
        elif i - before != after - i:
            nearest[i] = left if i - before < after - i else right
        else:
            nearest[i] = "good" if block.label == "near" else "bad"
    for i, label in nearest.items():
        parts[i].label = label


def main_text(page):
    """The main text of a page, a line per block; empty for a null or empty page."""
    if not page:
        return ""
    parts = blocks(page)
    first_pass(parts)
    second_pass(parts)
    return "\n".join(b.text for b in parts if b.label == "good")


def extracted(pages):
    """One row per page: page_id, url, text, n_chars (code points).

    `pages` needs page_id, url and html; ids and addresses may be null or repeated and are passed on. A null or empty page
    has the empty text. An empty table gives an empty result.
    """
    base.ship(pages.sparkSession)

    @F.pandas_udf("string")
    def text_of(column: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in column], dtype=object)

    rows = pages.select("page_id", "url", text_of("html").alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))

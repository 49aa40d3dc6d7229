"""Operator 9: main text of HTML pages from flat text blocks and a decision tree.

A page is cut into its flat text blocks: runs of text between block-level tags,
without scripts, styles, comments and other content that is never shown (the
text of ``math``, ``object`` and ``button`` is shown; a button counts as a link).
Each
block is described by its own word count and link density, those of the block
before and behind it, whether it is a heading, and two facts of its ancestors:
a container that is named as boilerplate (``nav``, ``footer``, ``form``, class
``ad`` or ``comments`` ...; whole names or listed compounds, not of ``html``,
``body``, ``main`` and ``article``, and left again in an article unless it is a
reply or a teaser) and a container that is named as the article. A CART
decision tree, trained on the blocks of a small labelled table of pages
(``LABELLED_PAGES``), tells main text from the rest. Character references are
decoded, white space inside a block becomes one space, and the main blocks are
joined by one space in page order. Nothing is dropped otherwise or capped.

A page is handled inside one task; nothing is shuffled.

Defined results: null and empty pages and pages without main blocks have the
empty text; text without any tag is one block; unclosed tags, stray ``<`` and
truncated pages are read as far as they go; ids and URLs pass through, null or
repeated; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .frames import ship, unpack

# Element kinds of HTML.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
                  "tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg select annotation annotation-xml".split())
# Raw elements that the next block tag ends; the others do so only where they are not closed, script and style never.
BREAKING = frozenset(("svg", "select"))
UNENDING = frozenset(("script", "style"))
LINKS = frozenset(("a", "button"))
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements that end at the next element of their own kind.
SELF_ENDING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
               "option": ("select",), "a": ()}
# Names that mark boilerplate and article containers.
BOILER_TAGS = frozenset("nav aside footer form menu dialog fieldset".split())
BOILER_NAMES = re.compile(
    r"^(ad|ads|adv|advert|advertisement|adbox|banner|breadcrumbs?|byline|comments?|commentlist|reply|replies|respond|disqus|consent|cookies?|"
    r"copyright|disclaimer|footer|foot|gdpr|header|masthead|topbar|login|menu|modal|nav|navbar|navigation|newsletter|notice|notification|"
    r"alert|pager|pagination|popup|promo|promoted|recommended|related|search|share|sharing|sidebar|sidenav|signup|skip|social|sponsor|"
    r"sponsored|subscribe|tags?|toolbar|tracking|widget|widgets|hidden|complementary|contentinfo|navigation)$")
# Compounds that mark boilerplate; other compounds (has-sidebar, overflow-hidden, entry-header) say nothing.
BOILER_COMPOUNDS = re.compile(
    r"^(?:(?:ads?|advert|banner|breadcrumbs?|comments?|consent|cookies?|copyright|footer|gdpr|login|menu|modal|nav|navbar|newsletter|pagination|"
    r"popup|promo|recommended|related|search|share|sharing|sidebar|signup|social|sponsored|subscribe|widget)[-_]+"
    r"(?:area|bar|banner|block|box|buttons?|consent|form|icons?|items?|links?|list|menu|message|notice|panel|popup|posts?|section|slot|stories|thread|unit)"
    r"|(?:ads?|advert|comments?|cookies?|footer)[-_]+(?:container|content|wrap|wrapper)"
    r"|(?:article|bottom|entry|global|main|page|post|primary|secondary|site|story|top)[-_]+"
    r"(?:ads?|breadcrumbs?|byline|comments?|footer|menu|nav|navbar|navigation|newsletter|pagination|related|share|sharing|social|tags)"
    r"|(?:global|main|site|top)[-_]+header)$")
# Named containers that hold articles of their own (teasers, replies): an article inside stays boilerplate.
CARD_NAMES = re.compile(r"(?:^|[-_])(ads?|adv|advert|advertisement|comments?|commentlist|disqus|promo|promoted|recommended|related|reply|replies|respond|"
                        r"sidebar|sidenav|sponsor|sponsored)(?:$|[-_])")
# Levels of boilerplate: an article or main element ends FRAME, a main element CARDS, nothing HIDDEN.
FRAME, CARDS, HIDDEN = 1, 2, 3
FRAME_TAGS = frozenset(("form", "fieldset", "header"))
MAIN_TAGS = frozenset(("article", "main"))
MAIN_NAMES = re.compile(r"^(article|main|content|post|entry|story|body|text|articlebody|maintext)$")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
ATTR = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?""")

# Searched in the page itself: lower() changes its length (U+0130).
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}
BREAK = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)|</?(?:{'|'.join(sorted(BLOCK - {'title', 'option', 'optgroup', 'hr'}))})(?=[\s/>])", re.I | re.A)
         for tag in RAW - UNENDING}

FEATURES = ["words", "links", "prev_words", "prev_links", "next_words", "next_links", "heading", "boiler", "article"]


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    words: int = 0
    linked: int = 0
    heading: bool = False
    boiler: bool = False
    article: bool = False
    label: bool = False


@dataclass
class _Open:
    tag: str
    boiler: int
    article: bool
    label: bool


def _names(attrs: str) -> tuple[int, int, bool, bool]:
    """(level by name, level by hiding, article, labelled) of an element's attributes."""
    named = hidden = 0
    article = label = False
    for name, value in ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in "".join(value.split())):
            hidden = HIDDEN
        elif name == "data-y":
            label = value == "1"
        elif name in ("class", "id", "role"):
            for word in value.split():
                if BOILER_NAMES.match(word) or BOILER_COMPOUNDS.match(word):
                    named = max(named, CARDS if CARD_NAMES.search(word) else FRAME)
                article |= any(MAIN_NAMES.match(p) for p in [word, *re.split(r"[-_]", word)])
    return named, hidden, article, label


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page, in order."""
    out: list[Block] = []
    stack = [_Open("", 0, False, False)]
    held: list[tuple[str, bool]] = []
    heading = False

    def flush() -> None:
        nonlocal held, heading
        if held:
            text = " ".join("".join(t for t, _ in held).split())
            if text:
                top = stack[-1]
                n = len(text.split(" "))
                linked = sum(len(t.split()) for t, a in held if a)
                out.append(Block([text], n, min(linked, n), heading, top.boiler > 0, top.article, top.label))
        held, heading = [], False

    where: dict[str, list[int]] = {}  # the places of each tag's open elements in the stack

    def drop(tag: str, stop: tuple[str, ...] = ()) -> None:
        """Close the innermost open ``tag`` and all inside it, unless a ``stop`` element lies between."""
        if not where.get(tag):
            return
        k = where[tag][-1]
        if all(not where.get(s) or where[s][-1] < k for s in stop):
            for x in stack[k:]:
                where[x.tag].pop()
            del stack[k:]

    def say(raw: str) -> None:
        if raw:
            held.append((html.unescape(raw), any(where.get(t) for t in LINKS)))
    at = 0
    unclosed = set(BREAKING)
    for m in iter(lambda: TOKEN.search(page, at), None):
        say(page[at:m.start()])
        at = m.end()
        if m["tag"] is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing = m["tag"].lower(), m["close"] == "/"
        if tag in RAW and not closing:
            if not m["attrs"].endswith("/"):
                end = RAW_END[tag].search(page, at) if tag not in unclosed else None
                if not end:
                    unclosed.add(tag)  # no further end tag: searched once
                if not end and tag not in UNENDING:
                    end = BREAK[tag].search(page, at)
                at = end.start() if end else len(page)
            if tag in BLOCK:
                flush()
            continue
        if tag == "br":
            held.append((" ", False))
            continue
        if tag in BLOCK:
            flush()
        if closing:
            if tag not in VOID:
                drop(tag)
            continue
        if tag in VOID:
            continue
        if tag in BLOCK and tag not in ("html", "body", "head"):
            drop("p", ("article", "section", "div", "td", "li", "blockquote", "body"))
            drop("button", ("article", "section", "div", "td", "li", "blockquote", "body"))
        if tag in SELF_ENDING:
            drop(tag, SELF_ENDING[tag])
        named, boiler, article, label = _names(m["attrs"]) if m["attrs"].strip() else (0, 0, False, False)
        top = stack[-1]
        inside, held_by = top.article, top.boiler
        if tag in ("html", "body"):
            boiler = 0
        elif tag in MAIN_TAGS:
            if named < CARDS and held_by <= (CARDS if tag == "main" else FRAME):
                held_by = 0
        else:
            boiler = max(boiler, named)
            if tag in BOILER_TAGS or (tag == "header" and not inside):
                boiler = max(boiler, FRAME if tag in FRAME_TAGS else CARDS)
        where.setdefault(tag, []).append(len(stack))
        stack.append(_Open(tag, max(held_by, boiler), (inside or (article and not named) or tag in MAIN_TAGS) and not boiler, top.label or label))
        if tag in HEADING:
            heading = True
    say(page[at:])
    flush()
    return out


def features(bs: list[Block]) -> np.ndarray:
    own = np.array([[b.words, b.linked / max(b.words, 1)] for b in bs], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    marks = np.array([[b.heading, b.boiler, b.article] for b in bs], float).reshape(-1, 3)
    return np.hstack([own, np.vstack([edge, own])[:-1], np.vstack([own, edge])[1:], marks])


@dataclass
class Tree:
    """A binary decision tree; leaves hold the share of main blocks."""

    share: float
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.share)
        up = x[:, self.feature] > self.threshold
        out = np.empty(len(x))
        out[~up], out[up] = self.low.predict(x[~up]), self.high.predict(x[up])
        return out

    def __str__(self, pad: str = "") -> str:
        if self.feature < 0:
            return f"{pad}main {self.share:.2f}\n"
        return (f"{pad}{FEATURES[self.feature]} <= {self.threshold:g}\n" + self.low.__str__(pad + "  ")
                + f"{pad}{FEATURES[self.feature]} > {self.threshold:g}\n" + self.high.__str__(pad + "  "))


def train(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 3) -> Tree:
    """CART by Gini impurity: the split with the largest decrease, the first feature among equals."""
    node = Tree(float(y.mean()) if len(y) else 0.0)
    if depth == 0 or len(y) < 2 * least or y.all() or not y.any():
        return node
    best = (1e-9, -1, 0.0)
    gini = lambda v: 2 * v.mean() * (1 - v.mean()) * len(v)
    for f in range(x.shape[1]):
        u = np.unique(x[:, f])
        for t in (u[:-1] + u[1:]) / 2:
            up = x[:, f] > t
            if min(up.sum(), (~up).sum()) >= least:
                gain = gini(y) - gini(y[up]) - gini(y[~up])
                if gain > best[0] + 1e-12:
                    best = (gain, f, float(t))
    if best[1] < 0:
        return node
    up = x[:, best[1]] > best[2]
    node.feature, node.threshold = best[1], best[2]
    node.low, node.high = train(x[~up], y[~up], depth - 1, least), train(x[up], y[up], depth - 1, least)
    return node


_LONG = "The river had risen again during the night, and by morning the lower road was gone under a sheet of brown water that moved slowly south."
_MORE = "Nobody in the village was surprised, because the same thing happened every spring when the snow on the hills began to melt."
#: The labelled table: small pages of different make; blocks of main text stand inside ``data-y="1"``.
LABELLED_PAGES = [
    f"""<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li><li><a href=c>Contact us</a></li></ul></nav><div class="ad">Buy two pay one, only this week in all our shops.</div>
    <article data-y="1"><h1>Flood in the valley</h1><p>{_LONG}</p><p>Then rain.</p><p>{_MORE}</p><p>So.</p></article><footer>&copy; valley.example all rights reserved</footer>""",
    f"""<header><a href=/>The Paper</a> <span>Founded long ago</span></header><div class="cookie-notice">We use cookies to make this site work better for you and for everyone else who reads it.</div>
    <main data-y="1"><h1>Title</h1><p>{_MORE}</p><h2>Part two</h2><p>{_LONG}</p><ul><li>one thing</li><li>another thing</li></ul></main>
    <aside><h3>Related</h3><p>{_LONG}</p><p><a href=x>More about rivers and roads</a></p></aside><footer><p>{_MORE}</p></footer>""",
    f"""<div id="menu"><a href=1>One</a> <a href=2>Two</a></div><div><div data-y="1"><p>{_LONG}</p><p>{_MORE}</p><p>{_LONG} {_MORE}</p></div></div>
    <div class="comments"><p>{_MORE}</p><p>I saw it too!</p></div><form><p>Write to us and we will answer as soon as we can find the time.</p><label>Name</label></form>""",
    f"""<table><tr><td><a href=1>Start</a></td><td><a href=2>Archive of old issues</a></td></tr></table><div data-y="1">{_LONG}</div><div data-y="1">{_MORE}</div>
    <div><a href=3>next page</a></div><div>Copyright</div><div><a href=4>imprint</a> | <a href=5>privacy</a></div>""",
    f"""<p><a href=1>Sports</a></p><p><a href=2>Weather</a></p><h1 data-y="1">A day by the sea</h1><p data-y="1">{_LONG}</p><p data-y="1">{_MORE} <a href=q>See the map</a> {_LONG}</p>
    <p><a href=3>Read also this story about another town by the sea</a></p><p>Share</p><p>Print</p><p><a href=4>About</a></p>""",
    f"""<section class="content" data-y="1"><h2>Notes</h2><p>Yes.</p><p>{_LONG}</p><blockquote>No.</blockquote><p>Of the <a href=l>river</a>.</p></section>
    <section class="sidebar"><p>Popular today</p><p>{_MORE}</p></section><div class="promo">{_LONG}</div><div class="share"><a href=1>Post</a></div>""",
    f"""<p><a href=1>Index</a></p><h1 data-y="1">Plain pages</h1><p data-y="1">{_LONG}</p><p data-y="1">Then nothing.</p><p data-y="1">{_MORE}</p>
    <p data-y="1">So.</p><p data-y="1">{_LONG}</p><p data-y="1">Yes, again.</p><p data-y="1">{_MORE}</p><p><a href=2>Back</a></p><p>Print</p>""",
    f"""<div><a href=1>Top</a></div><div data-y="1">{_MORE}</div><div data-y="1">To.</div><div data-y="1">{_LONG}</div><div data-y="1">Be it so.</div><div data-y="1">{_LONG}</div>
    <div>Imprint</div><div><a href=2>Next</a></div>""",
    f"""<article data-y="1"><header><h1>Short</h1></header><p>Here.</p><p><a href=1>A linked line that is part of the story</a></p><p>{_MORE}</p></article><article data-y="1"><p>Two.</p><p>{_LONG}</p></article>
    <div class="newsletter"><p>{_MORE}</p></div><nav><p>{_LONG}</p></nav><div role="contentinfo"><p>Call us</p></div><div hidden><p>{_LONG}</p></div>""",
]


def trained() -> Tree:
    """The tree of the labelled table (a few dozen blocks, fitted on the driver)."""
    xs, ys = [], []
    for page in LABELLED_PAGES:
        bs = blocks(page)
        xs.append(features(bs))
        ys.append(np.array([b.label for b in bs]))
    return train(np.vstack(xs), np.concatenate(ys).astype(float))


def main_text(page: str | None, tree: Tree) -> str:
    bs = blocks(page) if page else []
    if not bs:
        return ""
    keep = tree.predict(features(bs)) >= 0.5
    return " ".join(b.text[0] for b, k in zip(bs, keep, strict=True) if k)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``."""
    held = ship(pages.sparkSession, trained())

    def run(batches):
        tree = unpack(held)
        for batch in batches:
            for i, j, _, _ in K.slices(batch, "html"):
                part = batch.slice(i, j - i)
                texts = [main_text(h, tree) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])
    return (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))

"""Main text of web pages by composite text density.

A page is parsed into a tree of block elements. For each block its composite
density is computed: characters per tag, adjusted by the share of characters
and tags that are links and by the link share of the whole body. Each block's
density sum adds up the densities of its child blocks. The block with the
greatest sum is the core of the article; the least density on its path to the
body is the threshold, and blocks elsewhere whose density reaches it count as
text as well. If the core lies in an ``article`` or ``main`` element, that
whole element is the article.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments are left out by element, role, class or id before
densities are taken, and blocks made of links mostly are left out after. A class
or id only raises a suspicion, as does a form: such a block stays if it holds half or more of
the page's text outside links and there is no ``article`` or ``main`` elsewhere, as page-wide
wrappers do. Names of reader comments and consent notices always decide.
Character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined in page order by two line feeds; nothing
else is dropped or cut.

A null or empty page, or one without text, gives the empty string. Pages are
independent: there is no shuffle. Extra columns are ignored. Very long pages
are read whole; nesting is handled without recursion.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

# fixed values: elements and names of the HTML standard, and usual names of page parts
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("head title script style noscript template nav footer aside form button select option textarea label fieldset legend iframe object embed applet svg canvas math audio video dialog menu input".split())
BLOCK = frozenset("html body article main section div header hgroup h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary center hr search".split())
ENDS_PARAGRAPH = BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"} | frozenset("nav footer aside form fieldset menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|adbox|banner\w*|sponsor\w*|promo\w*|cookies?|cookie\w*|consent|gdpr|newsletter\w*|subscri\w+|paywall|sidebar\w*|side-?bar|menus?|nav|navbar|navigation|breadcrumbs?|footer\w*|page-?header|site-?header|masthead|topbar|toolbar|share|sharing|social\w*|related\w*|recommend\w*|comments?|comment-?\w*|commentlist|disqus\w*|respond|replies|notices?|notification\w*|alert\w*|popup\w*|modal\w*|overlay\w*|widget\w*|login|signup|sign-?up|pagination|pager|skip-?link\w*|copyright|legal|disclaimer|tags?-?list)(?:$|[\s_-])", re.I)
ALWAYS_OUT = re.compile(r"(?:^|[\s_-])(?:comments?|comment-?\w*|commentlist|disqus\w*|respond|replies|cookies?|cookie\w*|consent|gdpr)(?:$|[\s_-])", re.I)
CORE = frozenset(("article", "main"))
HEADER_NAMES = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CLOSERS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class Block:
    """One block element; ``parts`` holds its own text and child blocks in page order."""

    __slots__ = ("tag", "parent", "parts", "chars", "link_chars", "tags", "link_tags", "density", "sum", "core", "suspect")

    def __init__(self, tag: str, parent: Block | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0
        self.core: Block | None = parent.core if parent is not None else None
        self.suspect = False


class Tree(HTMLParser):
    """Parses a page into blocks, without the parts that are never main text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Block("body", None)
        self.blocks = [self.root]
        self.open: list[tuple[str, Block, bool]] = []  # element, block before it, whether it is left out
        self.block, self.out, self.links = self.root, 0, 0

    def _unwanted(self, tag: str, attrs: list) -> bool:
        """Whether the element is left out whatever it holds."""
        if tag in DROPPED and tag != "form":
            return True
        if tag in ("html", "body"):
            return False
        inside = self.block.core is not None
        if tag == "header" and not inside:
            return True
        for k, v in attrs:
            if k == "hidden" or k == "aria-hidden" and v == "true" or k == "role" and v and v.lower() in ROLES:
                return True
            if k in ("class", "id") and v and tag not in CORE and ALWAYS_OUT.search(v):
                return True
            if k == "style" and v and HIDDEN.search(v):
                return True
        return tag not in BLOCK and tag != "form" and self._suspect(tag, attrs)

    def _suspect(self, tag: str, attrs: list) -> bool:
        """Whether the element is left out unless it holds most of the page."""
        if tag == "form":
            return True
        if tag in CORE or tag in ("html", "body"):
            return False
        inside = self.block.core is not None
        return any(k in ("class", "id") and v and (NAMES.search(v) or not inside and HEADER_NAMES.search(v)) for k, v in attrs)

    def _close(self, depth: int) -> None:
        """Close open elements down to so many."""
        while len(self.open) > depth:
            tag, before, left_out = self.open.pop()
            self.out -= left_out
            self.links -= tag == "a"
            self.block = before

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in ENDS_PARAGRAPH:  # closes an open paragraph, with what is open in it
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self._close(i)
                    break
                if self.open[i][0] in BLOCK or self.open[i][0] in DROPPED:
                    break
        if tag in CLOSERS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in SIBLINGS[tag]:
                    self._close(i)
                    if tag != "tr" or self.open[i - 1 : i] != [] and self.open[i - 1][0] != "tr":
                        break
                elif self.open[i][0] in CLOSERS[tag]:
                    break
        if tag == "a":  # links don't nest
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "a":
                    self._close(i)
                    break
                if self.open[i][0] in BLOCK:
                    break
        unwanted = self._unwanted(tag, attrs)
        suspect = not unwanted and self._suspect(tag, attrs)
        if not self.out and not unwanted and not suspect:
            self.block.tags += 1
            self.block.link_tags += tag == "a" or self.links > 0
        if tag in VOID:
            if not self.out and tag in ("br", "hr", "wbr") and tag != "wbr":
                self.block.parts.append(" ")
            return
        self.open.append((tag, self.block, unwanted))
        self.out += unwanted
        self.links += tag == "a"
        if (tag in BLOCK or suspect) and not self.out:
            child = Block(tag, self.block)
            if suspect:
                child.suspect, child.tags, child.link_tags = True, 1, int(self.links > 0)
            if tag in CORE or any(k == "role" and v == "main" or k == "itemprop" and v == "articleBody" for k, v in attrs):
                child.core = child.core or child
            self.block.parts.append(child)
            self.blocks.append(child)
            self.block = child
        elif tag in BLOCK or tag in DROPPED:
            self.block.parts.append(None)  # what is left out still parts the text around it

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in VOID or tag in ("html", "body"):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._close(i)
                return
            if self.open[i][0] in ("article", "main", "table", "td", "th") and tag not in BLOCK and tag not in DROPPED:
                return

    def handle_data(self, data):
        if not self.out:
            self.block.parts.append(data)
            n = len("".join(data.split()))
            self.block.chars += n
            if self.links:
                self.block.link_chars += n


def without_suspects(blocks: list[Block]) -> list[Block]:
    """The blocks but for suspect ones, which give way to a gap unless they hold most of the page."""
    plain = {id(b): b.chars - b.link_chars for b in blocks}
    for b in reversed(blocks):
        if b.parent is not None:
            plain[id(b.parent)] += plain[id(b)]
    doubtful: set[int] = set()  # suspect blocks and what is in them
    for b in blocks:
        if b.suspect or b.parent is not None and id(b.parent) in doubtful:
            doubtful.add(id(b))
    elsewhere = any(b.core is b and plain[id(b)] and id(b) not in doubtful for b in blocks)
    gone: set[int] = set()
    for b in blocks:
        if b.parent is not None and id(b.parent) in gone or b.suspect and (elsewhere or 2 * plain[id(b)] < plain[id(blocks[0])] or not plain[id(b)]):
            gone.add(id(b))
    for b in blocks:
        if id(b) not in gone:
            b.parts = [None if isinstance(p, Block) and id(p) in gone else p for p in b.parts]
    return [b for b in blocks if id(b) not in gone]


def measure(blocks: list[Block]) -> None:
    """Fill in densities and density sums; ``blocks`` has parents before children."""
    for b in reversed(blocks):
        if b.parent is not None:
            for k in ("chars", "link_chars", "tags", "link_tags"):
                setattr(b.parent, k, getattr(b.parent, k) + getattr(b, k))
    body = blocks[0]
    share = body.link_chars / max(body.chars, 1)
    for b in blocks:
        if b.chars:
            tags, links, link_tags = max(b.tags, 1), max(b.link_chars, 1), max(b.link_tags, 1)
            base = math.log(b.chars / max(b.chars - b.link_chars, 1) * b.link_chars + share * b.chars + math.e)
            b.density = b.chars / tags * math.log(max(b.chars / links * tags / link_tags, 1.0)) / max(math.log(base + math.e - 1), 1e-9) if b.link_chars else b.chars / tags * math.log(max(b.chars * tags, 2)) / math.log(base + math.e - 1)
    for b in reversed(blocks):
        if not any(isinstance(p, Block) for p in b.parts):
            b.sum = b.density
        if b.parent is not None:
            b.parent.sum += b.density


def _linked(b: Block) -> bool:
    return b.chars > 0 and b.link_chars >= 0.75 * b.chars and b.link_tags > 1


def _selected(blocks: list[Block]) -> list[Block]:
    """The blocks whose whole text is main text, in page order."""
    best = max(blocks, key=lambda b: b.sum)
    if not best.chars:
        return []
    if best.core is not None:
        return [best.core]
    cores = [b for b in blocks if b.core is b and b.chars]
    if cores and (top := max(cores, key=lambda b: b.density * b.chars)).chars >= 0.25 * best.chars:
        return [top]
    threshold, at = best.density, best
    while at.parent is not None:
        at = at.parent
        threshold = min(threshold, at.density)
    chosen, walk = [], [blocks[0]]
    while walk:
        b = walk.pop()
        if b is best or b.density >= threshold and b.parent is not None and not _above(b, best):
            chosen.append(b)
        else:
            children = [p for p in b.parts if isinstance(p, Block)]
            walk += reversed(children)
    # a heading just before chosen text belongs to it
    return chosen


def _above(b: Block, below: Block) -> bool:
    while below is not None:
        if below is b:
            return True
        below = below.parent
    return False


def main_text(html: str) -> str:
    """The main text of one page."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    blocks = without_suspects(tree.blocks)
    measure(blocks)
    texts: list[str] = []
    for top in _selected(blocks):
        held: list[str] = []

        def flush(held=held):
            if text := " ".join("".join(held).split()):
                texts.append(text)
            held.clear()

        walk: list = [top]
        while walk:
            part = walk.pop()
            if isinstance(part, str):
                held.append(part)
                continue
            flush()
            if part is not None and not (part is not top and _linked(part)):
                walk.append(None)
                walk += reversed(part.parts)
        flush()
    return "\n\n".join(texts)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html)."""
    ship(pages)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    names = ["page_id", "url", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = [main_text(h) if (h := html.as_py()) else "" for html in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")

"""Main text of web pages by tree scoring.

The page is read into a tree. Elements that never hold article text go first: menus, page headers, footers, sidebars,
notices, adverts, forms, scripts, styles, hidden parts and reader comments, by tag, role and class words. Paragraphs,
headings, list items, quotes and inline elements are judged by whole class names only, never by their id. Names that
tell of a page's layout (``has-sidebar``, ``related-work``) count for less: a content name beside them outweighs them,
and so does running text within an article, or in a section of a container with a content name. If no text is left, such
names are passed over, and forms that hold running text are opened. Every paragraph then passes points for its length and
its commas to its ancestors, in full to the parent and less to those above. A container's points are discounted by its
link density. The best container, widened to the article around it, is kept with those siblings that score a fair part
of its points, are its headings, or hold text that is not mostly links, of any length; outside an article the same holds
for what stands beside the containers around it.

In the text character references are decoded, white space inside a block becomes one blank, and blocks are joined
in page order by two line feeds. Nothing is cut off, whatever the length. Null, empty and text-free pages give an
empty text. Broken markup is read as browsers do where it matters: unclosed paragraphs and list items end at the
next one, unmatched end tags are ignored. Each row is read by itself, so repeated rows and empty tables need no rule.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's element names by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed applet svg canvas audio video map form button input "
    "select option textarea label nav footer aside dialog menu title link meta base xmp noembed noframes".split())
ENDS_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"}
SAME_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table body html article section div".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
JUNK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promoted promotion sponsor sponsored sidebar "
    "sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe signup subscription share sharing social "
    "related recommended recommendations alert announcement comment comments disqus reply replies respond commentlist widget widgets "
    "toolbar pagination pager login search skip".split())
GOOD_WORDS = frozenset("article body content entry main page post text story blog column".split())
LAYOUT_WORDS = frozenset(
    "sidebar sidebars menu menus nav navbar navigation header masthead topbar banner share sharing social related "
    "recommended widget widgets toolbar login search skip announcement alert alerts".split())
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond commentlist".split())
STATES = frozenset("has with no without enabled disabled open closed".split())
PROTECTED = frozenset("html body article main".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption summary".split())
BESIDE = TEXT_TAGS | frozenset("ul ol dl table figure details".split())
SOFT, NAMED, HARD, COMMENT = 1, 2, 3, 4

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>\"']*+(?:(?:\"[^\"<]*\"|'[^'<]*')[^>\"']*+)*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element; ``parts`` holds texts and elements in page order."""

    __slots__ = ("tag", "parent", "parts", "junk", "good", "points", "length", "linked", "texts")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.parts = tag, parent, []
        self.junk = 0
        self.good = False
        self.points = 0.0
        self.length = self.linked = self.texts = 0


def _mark(name: str, whole_only: bool) -> int:
    """How strongly a class name or id speaks against its element."""
    words = set(WORDS.findall(name))
    if whole_only:
        words &= {name}
    if not words & JUNK_WORDS or words & STATES:
        return 0
    if words & COMMENT_WORDS:
        return COMMENT if name in COMMENT_WORDS or words & GOOD_WORDS else HARD
    return SOFT if name not in JUNK_WORDS and words & JUNK_WORDS <= LAYOUT_WORDS else HARD


def _judge(node: Node, raw: str) -> None:
    """Junk and content marks from role, class, id and visibility."""
    if not raw or raw.isspace():
        return
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}
    classes, name = found.get("class", "").lower().split(), found.get("id", "").strip().lower()
    node.good = bool(set(WORDS.findall(" ".join([*classes, name]))) & GOOD_WORDS)
    text_like = node.tag in TEXT_TAGS or node.tag not in BLOCK
    junk = max((_mark(c, text_like) for c in classes), default=0)
    if not text_like:
        mark = _mark(name, False)
        junk = max(junk, NAMED if mark == HARD and name in LAYOUT_WORDS else mark)
        content = any(set(WORDS.findall(c)) and set(WORDS.findall(c)) <= GOOD_WORDS for c in [*classes, name])
        if junk == SOFT and content:
            junk = 0
    if node.tag in PROTECTED:
        node.junk = COMMENT if junk == COMMENT and node.tag == "article" else 0
        return
    hidden = (found.get("role", "").lower() in ROLES or "hidden" in found
              or found.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(found.get("style", ""))))
    node.junk = max(junk, HARD if hidden else 0)


def parse(html: str) -> Node:
    """The page as a tree."""
    root = node = Node("#root", None)
    open_tags: Counter = Counter()
    at, size = 0, len(html)

    def close_to(target: Node) -> Node:
        nonlocal node
        while node is not target:
            open_tags[node.tag] -= 1
            node = node.parent
        open_tags[node.tag] -= 1
        return node.parent

    def nearest(names: tuple[str, ...], scoped: bool) -> Node | None:
        if not any(open_tags[n] for n in names):
            return None
        x = node
        while x.parent is not None:
            if x.tag in names:
                return x
            if scoped and x.tag in SCOPES:
                return None
            x = x.parent
        return None

    while at < size:
        m = TAG.search(html, at)
        if m is None:
            node.parts.append(html[at:])
            break
        if m.start() > at:
            node.parts.append(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if html.startswith("<![CDATA[", m.start()):
                node.parts.append(html[m.start() + 9:at].removesuffix("]]>"))
            continue
        tag = name.lower()
        if m[1] or m[4]:
            if tag == "br":
                node.parts.append(" ")
            elif (target := nearest((tag,), False)) is not None:
                node = close_to(target)
            continue
        raw = m[3] or m[6] or ""
        if tag in ENDS_P and (target := nearest(("p",), True)) is not None:
            node = close_to(target)
        if tag in SAME_END and (target := nearest(SAME_END[tag], tag in ("li", "dt", "dd"))) is not None:
            if tag in ("li", "dt", "dd") or _same_table(node, target):
                node = close_to(target)
        child = Node(tag, node)
        _judge(child, raw)
        node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else size
        elif tag not in VOID and not (raw.endswith("/") and tag not in BLOCK):
            open_tags[tag] += 1
            node = child
    return root


def _same_table(node: Node, target: Node) -> bool:
    while node is not target:
        if node.tag == "table":
            return False
        node = node.parent
    return True


def _ordered(root: Node) -> list[Node]:
    """All elements, parents before children."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        out.append(x)
        stack.extend(p for p in reversed(x.parts) if isinstance(p, Node))
    return out


def _measure(nodes: list[Node]) -> None:
    """Characters, characters within links, and paragraphs of all elements; ``nodes`` has parents first."""
    for x in reversed(nodes):
        x.length = sum(len(p.strip()) if isinstance(p, str) else 0 if p.tag in RAW else p.length for p in x.parts)
        inner = [p for p in x.parts if isinstance(p, Node)]
        x.linked = x.length if x.tag == "a" else sum(p.linked for p in inner)
        x.texts = sum(p.texts for p in inner) + (x.tag == "p" and x.length > 0)


def _running(x: Node, least: int) -> bool:
    """Whether an element holds paragraphs that are not mostly links."""
    return x.texts > 0 and x.length >= least and x.linked < 0.25 * x.length


def prune(root: Node, loose: bool = False) -> None:
    """Take out what never holds article text, except around an article or main element.

    ``loose`` passes over names that only tell of the layout, and opens forms with running text.
    """
    nodes = _ordered(root)
    _measure(nodes)
    commented: set[int] = set()
    inside: set[int] = set()
    holds: set[int] = set()
    named: set[int] = set()
    for x in nodes:
        above = id(x.parent) if x.parent is not None else None
        if x.junk == COMMENT or above in commented:
            commented.add(id(x))
        elif x.tag in ("article", "main") or above in inside:
            inside.add(id(x))
            y = x.parent if x.tag in ("article", "main") else None
            while y is not None and id(y) not in holds:
                holds.add(id(y))
                y = y.parent
        if x.good and not x.junk and x.tag not in ("body", "html") or above in named:
            named.add(id(x))

    def goes(p: Node) -> bool:
        if p.junk == COMMENT:
            return True
        if id(p) in holds:
            return False
        if p.tag in DROPPED:
            return not (loose and p.tag == "form" and p.junk < HARD and _running(p, 200))
        if p.tag == "header" and id(p) not in inside:
            return True
        if (id(p) in inside or p.tag == "section" and id(p) in named) and _running(p, 1):
            return p.junk == HARD
        return p.junk >= NAMED or p.junk == SOFT and not loose

    for x in nodes:
        x.parts = [p for p in x.parts if isinstance(p, str) or not goes(p)]


def _direct_text(x: Node) -> str:
    """Text of an element without the blocks inside it."""
    out, stack = [], [x]
    while stack:
        y = stack.pop()
        if isinstance(y, str):
            out.append(y)
        elif y is x or y.tag not in BLOCK:
            if y.tag in ("br", "hr"):
                out.append(" ")
            stack.extend(reversed(y.parts))
    return "".join(out)


def grade(root: Node) -> list[Node]:
    """Lengths, link lengths and points of all elements; returned parents first."""
    nodes = _ordered(root)
    _measure(nodes)
    for x in reversed(nodes):
        if x.tag in BLOCK and x.length:
            text = " ".join(unescape(_direct_text(x)).split())
            if text:
                points = 1 + text.count(",") + min(len(text) / 100, 3)
                up, share = x.parent, 1.0
                while up is not None and share > 0.2:
                    up.points += points * share
                    up, share = up.parent, share / 2
    for x in nodes:
        if x.length:
            x.points += (10 if x.tag in ("article", "main") else 0) + (5 if x.good and x.points else 0)
            x.points *= 1 - x.linked / x.length
    return nodes


def _belongs(x: Node, least: float) -> bool:
    """Whether an element beside the best container is part of the article."""
    density = x.linked / x.length if x.length else 1.0
    if x.tag in ("h1", "h2"):
        return density < 0.25
    return density < 0.5 and (x.points >= least or x.good or x.texts > 0 or x.tag in BESIDE or x.tag not in BLOCK)


def best_containers(root: Node) -> list[Node | str]:
    """The best container and what belongs to it beside and around it, in page order."""
    nodes = grade(root)
    best = max(nodes, key=lambda x: x.points)  # of equal ones the outermost, first one
    x = best
    while x is not None:
        if x.tag in ("article", "main"):
            best = x
            break
        x = x.parent
    least = max(10.0, 0.2 * best.points)
    kept: list[Node | str] = [best]
    at = best
    while at.parent is not None and at.tag not in ("body", "html"):
        place = next(i for i, p in enumerate(at.parent.parts) if p is at)
        before, after = ([p for p in side if (p.strip() if isinstance(p, str) else p.length and _belongs(p, least))]
                         for side in (at.parent.parts[:place], at.parent.parts[place + 1:]))
        kept = before + kept + after
        if best.tag in ("article", "main"):
            break
        at = at.parent
    return kept


def blocks(containers: list[Node | str]) -> list[str]:
    """The texts of the blocks of containers, in page order; bare text and inline elements join up."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(unescape("".join(held)).split())
        if text:
            out.append(text)
        held.clear()

    stack: list = containers[::-1]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        else:
            if x.tag == "br":
                held.append(" ")
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(x.parts))
    flush()
    return out


def main_text(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    for loose in (False, True):
        root = parse(html)
        prune(root, loose)
        text = "\n\n".join(blocks(best_containers(root)))
        if text:
            break
    return text


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``pages`` without the markup column, with its main text and that text's length in code points."""
    taken = {text_col, chars_col} & (set(pages.columns) - {html_col})
    if taken:
        raise ValueError(f"pages has {sorted(taken)} already; name other columns")

    @F.pandas_udf("string")
    def extracted(html: pd.Series) -> pd.Series:
        return html.map(main_text, na_action=None)

    others = [F.col(f"`{c}`") for c in pages.columns if c != html_col]
    return pages.select(*others, extracted(F.col(f"`{html_col}`")).alias(text_col)).withColumn(
        chars_col, F.char_length(F.col(text_col)).cast("long"))

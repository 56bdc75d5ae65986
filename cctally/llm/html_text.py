"""Operator 6: main text of web pages by tree scoring.

1. A tolerant parser builds the element tree (implied end tags, unclosed
   inline elements, raw text of scripts and styles, cut-off pages).
2. Elements that are never article text are taken out: menus, page headers and
   footers, sidebars, forms, scripts, and those whose class, id or role names
   an advert, notice, menu, sharing bar or reader comments; so are lists and
   boxes that are mostly links.
3. Every paragraph gives points for its length and commas to its parent, half
   to the grandparent and less to those above; a container's points are
   discounted by the share of its text that is links.
4. The best container and those of its siblings that score or read like it are
   the article. Its blocks are joined in page order.

One narrow Arrow pass; a page is parsed by itself.

Defined results: a null or empty page has empty text. White space within a
block becomes one space; nothing else is dropped or cut. A page without
paragraph points gives the text that is left after step 2.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math canvas noframes noembed xmp".split())
TEXT_ONLY = frozenset("title textarea".split())
INLINE = frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var br img wbr input button select picture source").split())
#: Elements whose text the paragraphs' points are counted from.
PARAGRAPHS = frozenset("p pre td blockquote li dd dt figcaption".split())
CONTAINERS = frozenset("div section article main body td center details dialog fieldset figure blockquote html".split())
NEVER = frozenset((
    "nav footer aside form script style noscript template iframe object svg math canvas head title textarea select "
    "button dialog menu audio video input").split())
BOILERPLATE = frozenset((
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside footer comment comments commentlist disqus "
    "discussion replies reply responses cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations toolbar widget masthead "
    "copyright contentinfo complementary search hidden skip teaser toc dialog alert").split())
#: Words that mark the article itself; a class of these alone outweighs a boilerplate class beside it.
ARTICLE = frozenset("article content entry main post story body text hentry".split())
#: Elements nested deeper than this hold their text but no elements; those become siblings.
MAX_DEPTH = 300
#: Which open elements a start tag closes, and the elements beyond which it does not look.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"}), "thead": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
          "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"})}

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-zA-Z][^>]*>"
    r"|<[/!?a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACE = re.compile(r"\s+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_COMMENTS = re.compile(r"(?:\d+ )?(?:reader |user )?comments?(?: ?\(\d+\))?$|leave a (?:comment|reply)$|\d+ (?:replies|responses)$", re.I)


class Node:
    """An element: tag, whether it is boilerplate, children (elements and strings)."""

    __slots__ = ("tag", "drop", "children", "parent", "score")

    def __init__(self, tag: str, parent: Node | None, drop: bool = False):
        self.tag, self.parent, self.drop = tag, parent, drop
        self.children: list[Node | str] = []
        self.score = 0.0


def _boilerplate(tag: str, attrs: str) -> bool:
    if tag in NEVER:
        return True
    if "=" not in attrs and "hidden" not in attrs:
        return False
    dropped = saved = False
    for name, a, b, c in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), unescape(a or b or c)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDING.search(value):
            return True
        if name in ("class", "id", "role"):
            for token in value.split():
                words = {x.lower() for x in _NAME.findall(token)}
                dropped = dropped or bool(words & BOILERPLATE)
                saved = saved or bool(words) and words <= ARTICLE
    return dropped and not saved and tag not in ("html", "body", "article", "main")


def _headed_comments(node: Node) -> bool:
    """True for a box whose first text is a heading that names reader comments."""
    if node.tag not in ("section", "div"):
        return False
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                return False
        else:
            return child.tag in HEADINGS and bool(_COMMENTS.match(_SPACE.sub(" ", _whole_text(child)).strip()))
    return False


def _whole_text(node: Node) -> str:
    return "".join(c if isinstance(c, str) else _whole_text(c) for c in node.children)


def parse(html: str) -> Node:
    """The element tree of a page, with character references decoded."""
    root = Node("html", None)
    stack = [root]
    at, n = 0, len(html)

    def text(s: str) -> None:
        if s:
            stack[-1].children.append(unescape(s) if "&" in s else s)

    def pop_to(names: set[str], bounds: set[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                del stack[k:]
                return
            if stack[k].tag in bounds:
                return

    while at < n:
        found = _MARKUP.search(html, at)
        if not found:
            text(html[at:])
            break
        text(html[at:found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if found["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k].tag not in INLINE or stack[k].tag in ("td", "th", "table") and tag not in (
                        "table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                    break
            continue
        if tag in ("html", "body"):
            continue
        if tag in CLOSES:
            pop_to(*CLOSES[tag])
        if tag not in INLINE and tag not in RAW:
            pop_to({"p"}, {"table", "td", "th", "button", "object"})
            while len(stack) > 1 and stack[-1].tag in INLINE and stack[-1].tag != "a":
                stack.pop()
        node = Node(tag, stack[-1], _boilerplate(tag, found["attrs"]))
        stack[-1].children.append(node)
        if tag in RAW or tag in TEXT_ONLY:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at) if not found["attrs"].endswith(
                "/") or tag not in ("svg", "math") else None
            if end:
                at = end.end()
            elif not found["attrs"].endswith("/"):
                at = n
        elif tag not in VOID and len(stack) < MAX_DEPTH:
            stack.append(node)
    return root


def _prune(node: Node) -> tuple[int, int, int]:
    """Take out boilerplate below ``node``; (characters, characters in links, links) left."""
    chars = linked = links = 0
    kept: list[Node | str] = []
    for child in node.children:
        if isinstance(child, str):
            chars += len(child.strip())
            kept.append(child)
            continue
        if child.drop or child.tag == "header" and not _within(child, "article") or _headed_comments(child):
            continue
        c, lc, k = _prune(child)
        if child.tag == "a":
            lc, k = c, 1
        if child.tag in ("ul", "ol", "div", "section", "table", "dl") and k >= 2 and c and lc / c > 0.6:
            continue
        chars, linked, links = chars + c, linked + lc, links + k
        kept.append(child)
    node.children = kept
    return chars, linked, links


def _within(node: Node, tag: str) -> bool:
    above = node.parent
    while above:
        if above.tag == tag:
            return True
        above = above.parent
    return False


def _measure(node: Node, linked: bool = False) -> tuple[int, int, int]:
    """(characters, commas, characters in links) of the text below."""
    chars = commas = links = 0
    linked = linked or node.tag == "a"
    for child in node.children:
        if isinstance(child, str):
            s = child.strip()
            chars += len(s)
            commas += s.count(",")
            links += len(s) if linked else 0
        else:
            c, m, k = _measure(child, linked)
            chars, commas, links = chars + c, commas + m, links + k
    return chars, commas, links


def _is_paragraph(node: Node) -> bool:
    if node.tag in PARAGRAPHS:
        return True
    return node.tag in CONTAINERS and any(
        child.strip() if isinstance(child, str) else child.tag in INLINE and child.tag != "a" and _measure(child)[0]
        for child in node.children)


def _score(node: Node, found: list[Node]) -> None:
    for child in node.children:
        if isinstance(child, str):
            continue
        _score(child, found)
        if _is_paragraph(child):
            chars, commas, links = _measure(child)
            if chars:
                points = (min(chars / 25, 1.0) + commas + min(chars / 100, 3.0)) * (1 - links / chars)
                above, level = child.parent, 0
                if child.tag in CONTAINERS:  # text of its own: the box itself is a container too
                    above, level = child, 0
                while above is not None and level < 5:
                    if not above.score:
                        found.append(above)
                    above.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                    above, level = above.parent, level + 1


def main_nodes(root: Node) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    found: list[Node] = []
    _score(root, found)
    best, top = root, 0.0
    for node in dict.fromkeys(found):
        chars, _, links = _measure(node)
        value = node.score * (1 - links / max(chars, 1))
        if value > top:
            best, top = node, value
    while best.tag not in CONTAINERS and best.parent:  # a list or row scores for the box that holds it
        best = best.parent
    if best.parent is None:
        return [best]
    out = []
    for node in best.parent.children:
        if isinstance(node, str):
            continue
        if node is not best:
            chars, commas, links = _measure(node)
            share = links / max(chars, 1)
            alike = node.score * (1 - share) >= max(10.0, 0.2 * top)
            reads = node.tag == "p" and (chars > 80 and share < 0.25 or chars and not links and commas + 1 > 1)
            if not (alike or reads):
                continue
        out.append(node)
    return out


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Append the block texts below ``node``; the last list is the open block."""
    for child in node.children:
        if isinstance(child, str):
            out[-1].append(child)
        elif child.tag == "br":
            out[-1].append(" ")
        elif child.tag in INLINE:
            _blocks(child, out)
        else:
            out.append([])
            _blocks(child, out)
            out.append([])


def extract(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    root = parse(html)
    _prune(root)
    blocks: list[list[str]] = []
    for node in main_nodes(root):
        blocks.append([])
        _blocks(node, blocks)
    texts = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks)
    return "\n\n".join(t for t in texts if t)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [extract(h) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")) \
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")

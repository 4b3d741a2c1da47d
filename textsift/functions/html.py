"""A page as a tree: one pass over its tags with a stack of open elements.

``parse`` follows the rules of HTML that decide which text belongs to which element: void elements, raw text (scripts,
styles), implied end tags (``p``, list items, table cells), end tags without a start, unclosed elements. It never
fails, and its time is linear in the page whatever is left unclosed: tags are matched without backtracking, and open
elements are found by name, not by search.

Text is kept in pieces ``(element, block, text)`` in page order; ``block`` changes wherever a block-level element begins
or ends and at ``<br>``, so consecutive pieces of one block are one line of the rendered page.
"""

from __future__ import annotations

import re
from html import unescape

# Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li option tbody td tfoot th thead tr".split())
IN_HEAD = frozenset("base link meta noscript script style template title head html".split())
CELLS = ("td", "th", "caption")
TABLE = frozenset(("table", "tbody", "tfoot", "thead", "tr", *CELLS))
#: Start tag -> (open elements that it ends, elements that it doesn't reach through).
ENDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "li": (("li",), ("ul", "ol", "menu", "dir", *CELLS)), "dt": (("dt", "dd"), ("dl", *CELLS)), "dd": (("dt", "dd"), ("dl", *CELLS)),
    "option": (("option",), ("select",)), "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead", "tfoot"), ("table",)), "body": (("head",), ())}

_TAG = re.compile(
    r"<(?:(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?:>|\Z)"
    r"|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*+(?:>|\Z))", re.S)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_ATTRIBUTE = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>]++)))?+")


class Tree:
    """Element i has ``tags[i]``, ``parents[i]`` (a smaller number, -1 for the root 0) and the text of its attributes."""

    __slots__ = ("tags", "parents", "attrs", "pieces")

    def __init__(self) -> None:
        self.tags: list[str] = ["#root"]
        self.parents: list[int] = [-1]
        self.attrs: list[str] = [""]
        self.pieces: list[tuple[int, int, str]] = []


def attributes(raw: str) -> dict[str, str]:
    """Attributes of a start tag; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def parse(html: str) -> Tree:
    tree = Tree()
    tags, parents, attrs, pieces = tree.tags, tree.parents, tree.attrs, tree.pieces
    stack = [0]                      # open elements
    where: dict[str, list[int]] = {}  # name -> positions in the stack
    blocks = [0]                     # positions of open block-level elements
    block, at, end = 0, 0, len(html)

    def last(names) -> int:
        return max((where[n][-1] for n in names if where.get(n)), default=-1)

    def close_to(position: int) -> None:
        while len(stack) > position:
            where[tags[stack.pop()]].pop()
        while blocks[-1] >= position and len(blocks) > 1:
            blocks.pop()

    for m in iter(lambda: _TAG.search(html, at), None):
        if m.start() > at:
            pieces.append((stack[-1], block, html[at:m.start()]))
        at = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            if name in BLOCK or name == "br":
                block += 1
            spot = last((name,))
            if spot < 0 or name in ("body", "html"):
                continue
            if name not in BLOCK:
                if blocks[-1] > spot:  # misnested: the block stays open
                    continue
            elif last(("table",) if name in TABLE and name != "table" else () if name in TABLE else CELLS) > spot:
                continue
            close_to(spot)
            continue
        if where.get("head") and name not in IN_HEAD:
            close_to(where["head"][-1])
        if name in ENDS:
            ended, barrier = ENDS[name]
            spot = last(ended)
            if spot > last(barrier):
                close_to(spot)
        if name in CLOSES_P:
            spot = last(("p",))
            if spot > last(("button", *CELLS)):
                close_to(spot)
        if name in BLOCK or name == "br":
            block += 1
        parents.append(stack[-1])
        tags.append(name)
        attrs.append(m[3])
        if name in VOID:
            continue
        where.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            blocks.append(len(stack))
        stack.append(len(tags) - 1)
        if name in RAW:
            stop = _RAW_END[name].search(html, at)
            stop_at = stop.start() if stop else end
            if stop_at > at:
                pieces.append((stack[-1], block, html[at:stop_at]))
            at = stop_at
    if at < end:
        pieces.append((stack[-1], block, html[at:]))
    return tree


def lines(pieces: list[tuple[int, int, str]]) -> list[tuple[int, str]]:
    """(first element, text) of each block with text: references decoded once, white space as one space."""
    out: list[tuple[int, str]] = []
    held, block, first = [], None, 0
    for element, b, text in pieces:
        if b != block:
            if held and (line := " ".join("".join(held).split())):
                out.append((first, line))
            held, block, first = [], b, element
        held.append(unescape(text) if "&" in text else text)
    if held and (line := " ".join("".join(held).split())):
        out.append((first, line))
    return out

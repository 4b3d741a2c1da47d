"""HTML -> document (X1/X2): a page's tree, its text blocks with their link density, and the main text.

Scope (our decision, not a reimplementation of a boilerplate-removal library). A page is read with a stack of open
elements (``functions.html``), so nested and unclosed elements end where HTML ends them, in time linear in the page.
Head, scripts, styles, navigation, footers, asides and ad blocks are dropped with all that they contain; the
``<article>`` elements are preferred when they hold text (precision over recall). What is left is cut into blocks at
block-level tags and ``<br>``; a block more than half of whose characters are in links is no text. Character
references are decoded once, white space in a block becomes one space. The title is the first ``<title>``.

The pass runs in an Arrow-batched UDF: a stack over tags has no form in built-in functions that isn't interpreted for
each token. Nothing is shuffled.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from textsift.functions import html as H
from textsift.functions.normalize import CP1252_BYTES, CP1252_SPECIALS
from textsift.functions.text import let

# Dropped elements, and the class words of ad blocks (``address`` is no ad).
DROPPED = frozenset("head title script style noscript template nav footer aside".split())
_AD_WORD = re.compile(r"(?:^|[ \t\n])(?:ads?|ad-[^ ]*)(?:$|[ \t\n])")
MAX_LINK_DENSITY = 0.5
REFERENCE_RE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def named_references() -> dict[str, str]:
    """Every named character reference of HTML that ends in a semicolon; a no-break space becomes a space."""
    from html.entities import html5
    return {"&" + k: (" " if v == "\xa0" else v) for k, v in html5.items() if k.endswith(";")}


_NAMED = named_references()


def _code_point(n: Column) -> Column:
    """Character of a numeric reference: 128-159 as Windows-1252, what is no character as U+FFFD."""
    c1 = F.translate(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"), "".join(map(chr, CP1252_BYTES)), CP1252_SPECIALS)
    bad = n.isNull() | (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    return F.when(bad, F.lit("\ufffd")).when(n == 160, F.lit(" ")).otherwise(c1)


def decode_entities(x: Column) -> Column:
    """Character references, named, decimal and hexadecimal, decoded once (``&amp;lt;`` becomes ``&lt;``); others stay."""
    full = named_references()
    common = ("&amp;", "&lt;", "&gt;", "&quot;", "&apos;", "&nbsp;", "&copy;", "&middot;")  # looked up first: a map is searched from its start
    table = lambda names: F.create_map(*[F.lit(v) for k in names for v in (k, full[k])])

    def one(r: Column) -> Column:
        number = F.when(r.rlike("^&#[xX]"), F.conv(F.substring(r, 4, 6), 16, 10)).otherwise(F.regexp_extract(r, "[0-9]+", 0)).cast("bigint")
        named = F.coalesce(F.try_element_at(table(common), r), F.try_element_at(table(full), r), r)
        return F.when(r.startswith("&#"), _code_point(number)).otherwise(named)

    def join(pieces: Column) -> Column:
        found = F.transform(F.regexp_extract_all(x, F.lit(REFERENCE_RE), F.lit(0)), one)
        return let(found, lambda f: F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(f, i), F.lit("")))), ""))
    return F.when(x.contains("&"), let(F.split(x, REFERENCE_RE, -1), join)).otherwise(x)


class Block(NamedTuple):
    """A line of the rendered page; ``link_chars`` of its ``n_chars`` are link text; ``kept``: it is main text."""
    tag: str
    text: str
    n_chars: int
    link_chars: int
    kept: bool


_BLOCK_TYPE = Ty.ArrayType(Ty.StructType([Ty.StructField("tag", Ty.StringType()), Ty.StructField("text", Ty.StringType()), Ty.StructField("n_chars", Ty.IntegerType()),
                                          Ty.StructField("link_chars", Ty.IntegerType()), Ty.StructField("kept", Ty.BooleanType())]))
_PARTS_TYPE = Ty.StructType([Ty.StructField("title", Ty.StringType()), Ty.StructField("text", Ty.StringType())])
_REFERENCE = re.compile(REFERENCE_RE)


def _decode(text: str) -> str:
    def one(m: re.Match) -> str:
        r = m[0]
        return H.unescape(r) if r[1] == "#" else _NAMED.get(r, r)
    return _REFERENCE.sub(one, text) if "&" in text else text


def blocks_of(html: str, max_link_density: float = MAX_LINK_DENSITY) -> tuple[str, list[Block]]:
    """Title and text blocks of a page in order, without dropped elements; only those of articles if there are any."""
    tree = H.parse(html)
    n = len(tree.tags)
    dropped, article, link = [False] * n, [False] * n, [False] * n
    titled, title = -1, []
    for i in range(1, n):
        p, tag = tree.parents[i], tree.tags[i]
        ad = tag == "div" and "class" in tree.attrs[i].lower() and bool(_AD_WORD.search(H.attributes(tree.attrs[i]).get("class", "")))
        dropped[i] = dropped[p] or tag in DROPPED or ad
        article[i] = article[p] or tag == "article"
        link[i] = link[p] or tag == "a"
        if tag == "title" and titled < 0:
            titled = i
    held: dict[int, list[tuple[int, str]]] = {}
    for element, block, text in tree.pieces:
        if element == titled:
            title.append(text)
        if not dropped[element]:
            held.setdefault(block, []).append((element, _decode(text)))
    join = lambda parts: " ".join("".join(parts).split())
    found = []
    for pieces in held.values():
        if text := join(t for _, t in pieces):
            links = len(join(t for e, t in pieces if link[e]))
            first = next(e for e, t in pieces if t.strip())
            found.append((article[first], Block(tree.tags[first], text, len(text), links, links <= max_link_density * len(text))))
    only = any(a for a, _ in found)
    return join(map(_decode, title)), [b for a, b in found if a or not only]


def page_blocks(html: Column, max_link_density: float = MAX_LINK_DENSITY) -> Column:
    """Array of ``Block`` of a page; empty for an empty page, null for a null one (never raises)."""
    @F.pandas_udf(_BLOCK_TYPE)
    def udf(pages: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else [b._asdict() for b in blocks_of(x, max_link_density)[1]] for x in pages], dtype=object)
    return udf.asNondeterministic()(html)  # see page_parts


def page_parts(html: Column, max_link_density: float = MAX_LINK_DENSITY) -> Column:
    """Struct (title, text) of a page; '' where there is none, nulls for a null page (never raises)."""
    @F.pandas_udf(_PARTS_TYPE)
    def udf(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for x in pages:
            title, blocks = blocks_of(x, max_link_density) if x is not None else (None, None)
            rows.append((title, None if blocks is None else "\n".join(b.text for b in blocks if b.kept)))
        return pd.DataFrame(rows, columns=["title", "text"], dtype=object)
    # Marked non-deterministic only so that a filter on the text isn't pushed below it, which would read each page twice.
    return udf.asNondeterministic()(html)


def extract_title(html: Column) -> Column:
    """Page title; '' when there is none."""
    return page_parts(html)["title"]


def extract_text(html: Column) -> Column:
    """Main text of a page; '' when nothing is left, null for a null page."""
    return page_parts(html)["text"]


def to_document(text: Column, title: Column, url: Column, date: Column, file_path: Column) -> Column:
    """``{text, title, metadata: {url, date, file_path}}``."""
    return F.struct(text.alias("text"), title.alias("title"),
                    F.struct(url.alias("url"), date.alias("date"), file_path.alias("file_path")).alias("metadata"))

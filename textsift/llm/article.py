"""Main text of web pages by composite text density (operator 13).

A page becomes a tree of its elements. Every element gets a link-adjusted number of characters for each tag in it

    C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LCb / Cb * C + e))

(C characters, LC of them in links, T tags, LT of them links; b: of the body; 0 counts as 1). With no link text on the page
the logarithms say nothing and C / T stays. The element whose children's densities have the largest sum holds the main text. The lowest density on
the way from the body to it is the page's threshold: beside that way, elements that reach it are main text too.
The subtree grows to the ``article`` or ``main`` element around it, so a short title stays with its paragraphs.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are known by element,
role, class and id, take part in densities (their links say what the page's body is) and never in the text. A ``header``
inside an article keeps its headings.

Scale: one narrow pass, no shuffle; a page's time is linear in its length, and nothing is cut.

Defined cases: a null or empty page, or one without text, has the empty text. Ties go to the element that comes first.
Rows that share an id are pages of their own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsift.functions import html as H

# Elements, roles, and class or id names of what isn't main text.
NO_TEXT = frozenset("head script style noscript template iframe object embed svg math canvas audio video map title noembed noframes xmp".split())
ASIDE = frozenset("nav footer aside form button select textarea input menu dialog search datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NAMES = re.compile(
    r"(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion|s)?|banner|cookies?|consent|gdpr|notices?|notification|alert|newsletter|subscribe|subscription|signup|popup|modal|overlay|"
    r"sidebar|side-bar|sidenav|aside|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|toolbar|masthead|header|footer|colophon|copyright|"
    r"comments?|commentlist|comment-list|disqus|replies|respond|related|recommended|share|sharing|social|widgets?|login|search)(?:[-_].*)?")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
NEVER_ASIDE = frozenset(("#root", "html", "body", "main"))
WHOLE = frozenset(("article", "main"))
AT_ONCE = 200  # pages of an output batch


def aside(tag: str, raw: str) -> bool:
    """Whether an element is known not to be main text; ``raw``: its attributes."""
    if tag in NEVER_ASIDE:
        return False
    if tag in ASIDE or tag in NO_TEXT:
        return True
    if not raw.strip():
        return False
    a = H.attributes(raw)
    if "hidden" in a or a.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    return any(NAMES.fullmatch(x) for x in f"{a.get('class', '')} {a.get('id', '')}".lower().split())


def densities(tree: H.Tree) -> list[float]:
    """Composite text density of every element."""
    n = len(tree.tags)
    chars, links, tags, link_tags, inside = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        inside[i] = tree.tags[i] == "a" or inside[tree.parents[i]]
    for element, _, text in tree.pieces:
        if tree.tags[element] not in NO_TEXT:
            size = len(" ".join(text.split()))
            chars[element] += size
            links[element] += size * inside[element]
    body = next((i for i in range(n) if tree.tags[i] == "body"), 0)
    for i in range(n - 1, 0, -1):
        p = tree.parents[i]
        chars[p] += chars[i]
        links[p] += links[i]
        tags[p] += tags[i] + 1
        link_tags[p] += link_tags[i] + (tree.tags[i] == "a")
    share = links[body] / max(1, chars[body])
    out = []
    for c, lc, t, lt in zip(chars, links, tags, link_tags, strict=True):
        base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
        plain = c / max(1, t)
        out.append(plain * math.log(max(1.0, c / max(1, lc) * max(1, t) / max(1, lt))) / math.log(base) if base > 1 else plain)
    return out


def main_elements(tree: H.Tree) -> list[bool]:
    """Whether the text directly in an element is main text."""
    n = len(tree.tags)
    density = densities(tree)
    out_of, in_article, heading, in_header = [False] * n, [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        p, tag = tree.parents[i], tree.tags[i]
        in_article[i] = in_article[p] or tag == "article"
        heading[i] = heading[p] or tag in HEADINGS
        in_header[i] = in_header[p] or tag == "header"
        out_of[i] = out_of[p] or aside(tag, tree.attrs[i]) or tag == "header" and not in_article[p]
    sums = [0.0] * n
    own = [False] * n
    for element, _, text in tree.pieces:
        own[element] = own[element] or not text.isspace()
    for i in range(1, n):
        if not out_of[i]:
            sums[tree.parents[i]] += density[i]
    # an element that holds text itself and has no children stands for its own text
    score = [max(s, density[i] if own[i] else 0.0) if not out_of[i] else -1.0 for i, s in enumerate(sums)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if score[best] <= 0:
        return [False] * n
    top = best
    while best >= 0:  # the outermost article or main element around it
        if tree.tags[best] in WHOLE:
            top = best
        best = tree.parents[best]
    way, i = set(), top
    body = next((i for i in range(n) if tree.tags[i] == "body"), 0)
    while i >= 0:
        way.add(i)
        i = tree.parents[i] if i != body else -1
    threshold = min(density[i] for i in way)
    whole = tree.tags[top] in WHOLE
    kept = [False] * n
    for i in range(n):
        p = tree.parents[i]
        beside = not whole and p in way and i not in way and density[i] >= threshold > 0
        kept[i] = not out_of[i] and (i == top or (p >= 0 and kept[p]) or beside)
    return [k and (heading[i] or not in_header[i]) for i, k in enumerate(kept)]


def main_text(html: str | None) -> str:
    """The main text of a page, its blocks joined by line feeds."""
    if not html:
        return ""
    tree = H.parse(html)
    kept = main_elements(tree)
    return "\n".join(line for _, line in H.lines([x for x in tree.pieces if kept[x[0]]]))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for a in range(0, b.num_rows, AT_ONCE):
            part = b.slice(a, AT_ONCE)
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_articles(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")


#: The same rows where the article element is the main text, as in the given tables: its block tags are line ends.
ORACLE = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?is)<article[^>]*>(.*)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(t, '(?i)</?(p|br|h[1-6]|div|li|ul|ol)(\s[^>]*)?>', chr(1), 'g'), '<[^>]*>', '', 'g') AS t FROM a),
d AS (SELECT page_id, url, regexp_replace(replace(replace(replace(t, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t FROM b),
l AS (SELECT page_id, url, list_filter(list_transform(string_split(t, chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM d)
SELECT page_id, url, coalesce(array_to_string(l, chr(10)), '') AS text, CAST(length(coalesce(array_to_string(l, chr(10)), '')) AS BIGINT) AS n_chars FROM l"""

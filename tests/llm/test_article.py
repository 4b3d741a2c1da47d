"""Main text of pages: layouts, densities by their definition, edge cases, and the whole tables."""
import math

import pytest

from textsift.functions import html as H
from textsift.llm import article as A

LONG = "This sentence is one of several that make up the text of an article, and it has no links in it."
BODY = "\n".join(f"{LONG} {i}" for i in range(5))
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in BODY.split("\n"))
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Entry number {i}</a></li>' for i in range(12)) + "</ul>"


@pytest.mark.parametrize("page, expected", [
    (f"<body><nav>{MENU}</nav><article><h1>Title</h1>{PARAGRAPHS}</article><footer>x</footer></body>", "Title\n" + BODY),
    (f"<body><div class='menu'>{MENU}</div><main><header><p>by line</p><h1>Title</h1></header>{PARAGRAPHS}</main></body>", BODY),
    (f"<body><article><header><p>by line</p><h1>Title</h1></header>{PARAGRAPHS}</article></body>", "Title\n" + BODY),
    # no semantic elements: the densest subtree
    (f"<body><table><tr><td>{MENU}<td><div>{PARAGRAPHS}</div></table><div><a href='/'>home</a> <a href='/x'>about us and more</a></div></body>", BODY),
    (f"<div>{MENU}</div><div>{PARAGRAPHS}</div><div id=comments><p>{LONG * 3}</p></div><div class='cookie-notice'><p>{LONG}</p></div>", BODY),
    (f"<article>{PARAGRAPHS}<section class='comments'><article class='comment'><p>{LONG * 9}</p></article></section><aside><p>{LONG}</p></aside><form><p>{LONG}</p></form></article>", BODY),
    (f"<article><div class='ad'><div>{LONG}</div><p>{LONG}</div>{PARAGRAPHS}</article>", BODY),
    (f"<article><p>one&nbsp; &amp;\n two<script>var x = '<p>';</script> three<!-- no --></p><style>p</style>{PARAGRAPHS}</article>", "one & two three\n" + BODY),
    (f"<body class='has-sidebar'><div>{PARAGRAPHS}</div></body>", BODY),
    (f"<p>{LONG}", LONG),
    (LONG, LONG),
    ("", ""), (None, ""), ("<html><body></body></html>", ""), ("   ", ""), ("<nav>only a menu</nav>", ""),
    ("<article>" * 3000 + "deep" + "</div>", "deep"),
])
def test_layouts(page, expected):
    assert A.main_text(page) == expected


def test_density_is_the_definition():
    tree = H.parse(f"<body><div>{PARAGRAPHS}<a href=x>link text</a></div>{MENU}</body>")
    n = len(tree.tags)
    below = lambda i: [j for j in range(n) if j != i and i in ancestors(j)]

    def ancestors(j):
        out = set()
        while j >= 0:
            out.add(j)
            j = tree.parents[j]
        return out
    size = lambda js: sum(len(" ".join(x.split())) for e, _, x in tree.pieces if e in js)
    def parts(i):
        js = {i, *below(i)}
        in_links = {j for j in js if any(tree.tags[k] == "a" for k in ancestors(j))}
        return size(js), size(in_links), len(js) - 1, sum(tree.tags[j] == "a" for j in js - {i})
    body = tree.tags.index("body")
    cb, lb = parts(body)[:2]
    for i, d in enumerate(A.densities(tree)):
        c, lc, t, lt = parts(i)
        base = math.log(c / max(1, c - lc) * lc + lb / cb * c + math.e)
        want = c / max(1, t) * (math.log(max(1, c / max(1, lc) * max(1, t) / max(1, lt))) / math.log(base) if base > 1 else 1)
        assert d == pytest.approx(want)


def test_spark_rows(spark):
    rows = [(1, "u", f"<article>{PARAGRAPHS}</article>", "x", 1), (1, None, None, "y", 2), (None, "v", "", None, 3), (2, "w", f"<p>{LONG * 40_000}</p>", None, 4)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, A.extract_articles(df).collect()), key=lambda r: (r[3], str(r[1])))
    assert got == [(1, None, "", 0), (None, "v", "", 0), (1, "u", BODY, len(BODY)), (2, "w", LONG * 40_000, len(LONG) * 40_000)]
    assert A.extract_articles(df.limit(0)).collect() == []

"""Page extraction: nesting, unclosed blocks, link density, one pass over a page."""
import time

from pyspark.sql import functions as F

from textsift.operators import extract as X
from textsift.plans import corpus as CP

LINKS = "<ul><li><a href=/a>One page</a></li><li><a href=/b>Another page</a> x</li></ul>"


def text(page, **kw):
    return [b.text for b in X.blocks_of(page, **kw)[1] if b.kept]


def test_nested_blocks_are_dropped_whole():
    assert text("<p>a</p><div class='x ad'>b<div>c<div class=y>d</div></div>e</div><p>f</p>") == ["a", "f"]
    assert text("<nav>a<nav>b</nav>c</nav><p>d</p><aside><p>e<aside>f</aside>g</aside>") == ["d"]
    assert text("<p>a<div class=ad>never closed <p>b") == ["a"]
    assert text("<p>a</nav>b</p><script>var x = '</script' + '<p>'</script>c") == ["a", "b", "c"]


def test_articles_are_preferred():
    assert text("<p>x</p><article><p>a</p></article><div>y</div><article>b</article>") == ["a", "b"]
    assert text("<p>x</p><article> </article>") == ["x"]
    assert text("<article>a<aside><article>b</article></aside></article>") == ["a"]


def test_links_make_no_text():
    blocks = X.blocks_of("<p>Read <a href=/>this</a> now</p>" + LINKS)[1]
    assert [(b.tag, b.text, b.n_chars, b.link_chars, b.kept) for b in blocks] == [("p", "Read this now", 13, 4, True), ("a", "One page", 8, 8, False), ("a", "Another page x", 14, 12, False)]
    assert text(LINKS, max_link_density=0.9) == ["Another page x"] and text(LINKS, max_link_density=1) == ["One page", "Another page x"]


def test_unclosed_blocks_cost_linear_time():
    def took(n):
        began = time.process_time()
        X.blocks_of("<nav>" * n + "<div class='ad'>" * n + "<!--" * n)
        return time.process_time() - began
    took(500)
    assert took(40_000) < 40 * max(took(4_000), 0.01)


def test_parts_in_spark(spark):
    rows = [(1, "<title>A &amp; B</title><p>caf&eacute; &unknown; &#233;&nbsp;x</p>"), (2, ""), (3, None), (4, "<nav>n</nav>"), (5, "<title></title>")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("http://a.example/"))
    got = {r["page_id"]: (r["x"]["title"], r["x"]["text"]) for r in df.select("page_id", X.page_parts(F.col("html")).alias("x")).collect()}
    assert got == {1: ("A & B", "café &unknown; é x"), 2: ("", ""), 3: (None, None), 4: ("", ""), 5: ("", "")}
    assert [r[0] for r in df.select(F.size(X.page_blocks(F.col("html")))).collect()] == [1, 0, None, 0, 0]
    docs = CP.pages_to_documents(df)
    assert docs._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in docs.select("page_id", "title", "text").collect()] == [(1, "A & B", "café &unknown; é x")]

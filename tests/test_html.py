"""The page tree: implied ends, raw text, misnesting, linear time."""
import time

import pytest

from textsift.functions import html as H


def outline(page):
    """Nested tags with the text directly in them, as a string."""
    t = H.parse(page)
    kids, texts = {}, {}
    for i in range(1, len(t.tags)):
        kids.setdefault(t.parents[i], []).append(i)
    for e, _, x in t.pieces:
        texts.setdefault(e, []).append(x.strip())
    show = lambda i: t.tags[i] + "(" + " ".join([x for x in ["".join(texts.get(i, [])), *map(show, kids.get(i, []))] if x]) + ")"
    return show(0)


@pytest.mark.parametrize("page, expected", [
    ("", "#root()"),
    ("a<p>b<p>c", "#root(a p(b) p(c))"),
    ("<p><b>a<p>c", "#root(p(b(a)) p(c))"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "#root(ul(li(a ul(li(b))) li(c)))"),
    ("<div>a<div>b</div>c</div>d", "#root(d div(ac div(b)))"),
    ("<script>if (a<b) '</p>'</script>x", "#root(x script(if (a<b) '</p>'))"),
    ("<style>p{}", "#root(style(p{}))"),
    ("<b><div></b>x</div>y", "#root(b(y div(x)))"),
    ("<i>a</b>b</i>c", "#root(c i(ab))"),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", "#root(d table(tr(td(a) td(b)) tr(td(c))))"),
    ("<div><table><td>a</div>b</table>c</div>d", "#root(d div(c table(td(ab))))"),
    ("<!-- <p>x --><br>y<img src='a>b'>z", "#root(yz br() img())"),
    ("<a title=it's>x</a>y", "#root(y a(x))"),
    ("<a title='x>y", "#root(a())"),
    ("1 < 2 <3", "#root(1 < 2 <3)"),
    ("<head><title>t</title><div>x", "#root(head(title(t)) div(x))"),
    ("<dl><dt>a<dd>b<dt>c</dl>", "#root(dl(dt(a) dd(b) dt(c)))"),
    ("<P>a</P><Div>b</DIV>", "#root(p(a) div(b))"),
])
def test_outline(page, expected):
    assert outline(page) == expected


def test_attributes():
    assert H.attributes(' class="a b" ID=x hidden title=\'1 &amp; 2\' class=c') == {"class": "a b", "id": "x", "hidden": "", "title": "1 & 2"}


def test_lines_decode_and_fold():
    t = H.parse("<p>a &amp;lt;\n\t<b>b</b>c &nbsp; d<br>e</p> <p> </p>f")
    assert [x for _, x in H.lines(t.pieces)] == ["a &lt; bc d", "e", "f"]


@pytest.mark.parametrize("part", ["<div>", "<p><b>", "<!--", '<a title="', "<script>", "<", "<table><td>", "</p>", "<i><div>"])
def test_time_is_linear(part):
    def took(n):
        began = time.process_time()
        H.parse(part * n + "</i>" * n)
        return time.process_time() - began
    took(1000)
    assert took(80_000) < 40 * max(took(8_000), 0.01)

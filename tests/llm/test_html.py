"""HTML extraction: exact marginals, the given pages' articles, held-out layouts, edge cases."""

import itertools
import random
import re
from collections import Counter
from html import unescape

import pytest
from conftest import SF001

from tastegraph.llm import html_extract
from tastegraph.llm.dom import Node, features, parse
from tastegraph.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model(spark):
    return html_extract.default_model(spark)


def test_marginals_are_exact(model):
    """Against the sum over all labellings of small trees."""
    rng = random.Random(3)
    for _ in range(20):
        nodes = [Node(-1, "root", ())]
        for i in range(1, rng.randint(2, 8)):
            parent = rng.choice([j for j, x in enumerate(nodes) if x.text is None])
            text = "Some words here, more of them." if rng.random() < 0.4 else None
            nodes.append(Node(parent, rng.choice(("div", "p", "aside", "article", "nav", "li")), rng.choice(((), ("sidebar",), ("post",))), text))
        own = []
        for node, got in zip(nodes, features(nodes)):
            s = model.bias[node.text is not None] + sum(model._of(x) for x in got)
            own.append(1 / (1 + 2.718281828459045 ** -s))
        total, on = 0.0, [0.0] * len(nodes)
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            p = 1.0
            for i, y in enumerate(labels):
                p *= own[i] if y else 1 - own[i]
                if i:
                    p *= model.edge[html_extract.edge_kind(nodes, i)][2 * labels[nodes[i].parent] + y]
            total += p
            for i, y in enumerate(labels):
                on[i] += p * y
        assert model.marginals(nodes) == pytest.approx([x / total for x in on], rel=1e-6, abs=1e-9)


def test_given_pages(spark, model):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    out = html_extract.digest(pages).collect()
    assert len(out) == len(html)
    for r in out:
        inner = re.search(r"<article>(.*)</article>", html[r.page_id], re.S).group(1)
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_held_out_layouts(model):
    both = found = true = 0
    for html, content in labelled_pages(200, seed=77):
        a, b = Counter(html_extract.main_blocks(html, model)), Counter(content)
        both, found, true = both + sum((a & b).values()), found + sum(a.values()), true + sum(b.values())
    assert both >= 0.9 * found and both >= 0.95 * true


def test_parts_that_are_no_article(model):
    html = """<html><body><header class="site-header"><a href="/">Home</a><p>Our slogan, every day.</p></header>
    <div class="cookie-notice"><p>We use cookies to make this page work, and some others besides.</p><button>OK</button></div>
    <main><article><h1>Title &amp; more</h1><p>First   paragraph,\n with <b>bold</b> words and a <a href="x">link</a>.<p>Second &eacute;t&eacute; &#8211; done.
    <script>var a = "<p>no</p>";</script><ul><li>One item of the list, long enough to read.<li>Another item.</ul></article></main>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">Other story</a></li></ul></aside>
    <section id="comments"><div class="comment"><p>I have read this and I don't agree with any of it, sorry.</p></div></section>
    <form class="newsletter"><label>Mail</label><input><p>Subscribe to our letter today.</p></form>
    <footer>&copy; 2020 Someone</footer></body></html>"""
    assert html_extract.main_blocks(html, model) == [
        "Title & more", "First paragraph, with bold words and a link.", "Second été – done.",
        "One item of the list, long enough to read.", "Another item."]


def test_edge_cases(spark, model):
    deep = "<div>" * 20000 + "text at the bottom" + "</div>" * 5
    long = "<article><p>" + "word, and so on. " * 100000 + "</p></article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "plain text only"), (4, "u", deep), (5, "u", long), (5, "u", long),
            (None, "u", "<p>unended <b attr='x"), (6, "u", "<!-- never ended"), (7, "u", "</div></p><br/><hr><p")]
    pages = spark.createDataFrame([(*r, "clash", 0) for r in rows], "page_id long, url string, html string, text string, row int")
    out = html_extract.digest(pages).collect()
    assert sorted(str(r.page_id) for r in out) == sorted(str(r[0]) for r in rows)
    by = {r.page_id: r for r in out}
    assert by[1].text == by[2].text == by[6].text == "" and by[1].n_chars == 0
    assert by[5].n_chars == len(" ".join(("word, and so on. " * 100000).split()))
    assert html_extract.digest(pages.limit(0)).count() == 0
    whole = html_extract.extract(pages, model)
    assert whole.select("row.*").columns == ["page_id", "url", "text", "row"]
    assert html_extract.fit(spark.createDataFrame([], "html string, content array<string>")).weight == {}


def test_blocks_of_the_tree():
    nodes = parse("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table><p>f<div>g</div>h<br>i")
    assert [x.text for x in nodes if x.text is not None] == ["a", "b", "c", "d", "e", "f", "g", "h i"]


def test_head_without_end():
    texts = lambda html: [x.text for x in parse(html) if x.text is not None]
    head = "<head><meta charset='u'><title>T</title><style>p{}</style><script>f()</script><template><p>t</p></template>"
    assert texts(f"<html>{head}<p>One.<p>Two.") == ["One.", "Two."]
    assert texts(f"<!DOCTYPE html>{head}<link rel=x>\n plain <b>text</b>") == ["plain text"]
    assert texts(f"{head}<noscript><link rel=x></noscript><base href=x><article><h1>A</h1>b</article>") == ["A", "b"]
    assert texts(f"{head}<noscript><p>c</p></noscript><title>U</title></head><body><p>d</p>") == ["c", "d"]
    assert texts(f"{head}</head><body><p>e</p></body>") == ["e"]
    assert texts(f"{head}<body><p>f</p>") == ["f"]


def test_fallbacks_and_formulas_are_text():
    def texts(html):
        return [x.text for x in parse(html) if x.text is not None]

    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><msup><mn>2</mn><mi>n</mi></msup></math> be so.</p>") == ["Let x=2n be so."]
    assert texts("<p>See <object data=x><param name=a>the map</object> here.</p><p>On.</p>") == ["See the map here.", "On."]
    assert texts("<div><noscript><p>Shown as well.</p></noscript><p>Next.</p></div>") == ["Shown as well.", "Next."]


def test_pages_without_end_of_head_are_extracted(model):
    page = ("<!DOCTYPE html><html><head><title>x</title><article><h1>Title</h1><p>First paragraph, long enough to be read as text.</p>"
            "<p>Where <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is the sum, as all of us know.</p></article>")
    assert html_extract.main_blocks(page, model) == [
        "Title", "First paragraph, long enough to be read as text.", "Where a+b is the sum, as all of us know."]


@pytest.mark.parametrize("tag", ["svg", "canvas", "audio", "video", "select"])
def test_elements_never_ended_swallow_nothing(tag):
    texts = [n.text for n in parse(f"<article><p>a</p><{tag}><p>b</p></article><p>c</p>") if n.text]
    assert texts == ["a", "b", "c"]


def test_fallback_and_drawings():
    texts = [n.text for n in parse("<p>see <canvas>a chart</canvas> and <video src=x>a film</video></p>"
                                   "<svg><title>t</title><text>label</text></svg><select><option>one</select><p>end</p>") if n.text]
    assert texts == ["see a chart and a film", "end"]
    assert [n.text for n in parse("<svg><foreignObject><div>in</div></foreignObject><text>x</text></svg><p>out") if n.text] == ["out"]

"""Main text: pages with misleading names, broken markup, and input that is made to take long."""

import random
import time

import numpy as np
import pytest

from signmine.llm import html


@pytest.fixture(scope="module")
def model():
    return html.fit(html.labelled_pages())


def text_of(page, model):
    return html.extract([page], model)[0]


@pytest.mark.parametrize("names", ['class="post tag-news"', 'class="entry legal"', 'class="has-sidebar"', 'class="article advert-free"', 'class="post category-comments no-widget"', 'id="post-7" class="hentry comments-open"'])
def test_an_article_with_misleading_names_stays(model, names):
    long = "<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><article {}><h1>A title</h1><p>One paragraph of it.</p><p>And another, which is longer than that.</p></article><footer>&copy; x</footer>"
    assert text_of(long.format(names), model) == "A title\nOne paragraph of it.\nAnd another, which is longer than that."
    assert text_of(f"<article {names}><p>Some text</p></article>", model) == "Some text"


def test_blocks_with_misleading_names_stay(model):
    page = """<body><div class="site has-sidebar"><header><a href=/>Site</a></header><article><header><h1>Title</h1></header><h2 id="advanced-usage">Advanced usage</h2><p>first</p><section id="advice"><h2>Advice</h2><p>Take this advice.</p></section>
    <section id="related-work"><h2>Related work</h2><p>Others have done the same.</p></section><p class="share-price">The price of a share</p><div id="search-results"><p>Results of the search</p></div><section id="legal"><h2>Legal</h2><p>A question of law.</p></section></article></div>"""
    assert text_of(page, model).split("\n") == ["Title", "Advanced usage", "first", "Advice", "Take this advice.", "Related work", "Others have done the same.", "The price of a share", "Results of the search", "Legal", "A question of law."]


def test_pages_without_a_container(model):
    p = "A paragraph that is long enough to be one, with some words more than that, and an end."
    assert text_of(f"<body><p>{p}</p><p>{p}</p><p>last</p>", model) == f"{p}\n{p}\nlast"
    assert text_of(f"<p>one</p><p>{p}</p>", model) == f"one\n{p}"
    assert text_of(f"<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>B</a></li></ul></nav><h1>T</h1><p>{p}</p><p>{p}</p><footer>&copy; me</footer></body></html>", model) == f"T\n{p}\n{p}"
    assert text_of("hello world", model) == "hello world"


def test_what_stands_in_an_article_is_kept(model):
    page = "<article><h1>Sets</h1><p>If <math><mi>a</mi><mo>=</mo><mi>b</mi></math> then</p><pre>x = 1</pre><dl><dt>Term</dt><dd>What it means</dd></dl><figure><img src=x><figcaption>A figure</figcaption></figure><table><tr><td>1<td>2</table><p>a drawing <svg><title>icon</title><text>of text</text></svg></p><blockquote>said <wbr>so</blockquote></article>"
    assert text_of(page, model).split("\n") == ["Sets", "If a=b then", "x = 1", "Term", "What it means", "A figure", "1", "2", "a drawing of text", "said so"]


def test_boilerplate_in_and_about_an_article_goes(model):
    page = """<div class="cookie-banner"><p>We use cookies</p><button>OK</button></div><header class="site-header"><h1><a href=/>Site</a></h1><nav><ul><li><a href=/a>A</a></ul></nav></header><main><article class="post"><h1>Title</h1><p>Text of the article, first.</p>
    <div class="ad-slot">Buy this</div><aside class="sidebar"><h3>Also</h3><p>something else</p></aside><form><p>Sign up</p><select><option>one<option>two</select><textarea>x</textarea></form><p>Choose <button>Go</button> now.</p><footer class="post-footer">Filed under</footer></article>
    <section id="comments"><h2>2 comments</h2><article class="comment"><p>I liked it</p></article><article class="comment"><p>So did I, very much</p></article></section></main><footer><p>&copy; all of us</p></footer>"""
    assert text_of(page, model) == "Title\nText of the article, first.\nChoose now."


def test_held_out_pages_with_misleading_names(model):
    test = html.labelled_pages(300, seed=77)
    node, _, _ = model.infer(html.Forest.of(p for p, _ in test))
    content, start, right = node[:, 1] >= 0.5, 0, []
    for page, labels in test:
        right += [content[start + i] == labels[i] for i, _ in page.text]
        start += len(page.tags)
    assert np.mean(right) > 0.98 and len(right) > 4000


TEXTS = [
    ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]), ("<ul><li>a<li><p>b<li>c</ul>d", ["a", "b", "c", "d"]), ("<table><tr><td>a<td><div>b<td>c<tr><td>d</table>e", ["a", "b", "c", "d", "e"]),
    ("<div><table><tr><td>a</div>b</table>c</div>", ["ab", "c"]), ("<h2>a<h3>b</h3>c", ["a", "b", "c"]), ("a<b>b</p>c</b>d", ["abcd"]), ("<p>x<!-- a > b -->y<!-->z<!--never", ["xyz"]), ("<p>a<br/>b<wbr>c<img>d</br>e", ["a bc d e"]),
    ("a < b <3 </> </ x> c", ["a < b <3 c"]), ("<p title='a>b' x=\"<p>\">t</p>", ["t"]), ("<p title=\"a>text", ["text"]), ("<p title=it's>a</p>", ["a"]), ("<script>if (a</b)</script>x<style>y</style>", ["x"]), ("a&amp;lt; &eacute;&nbsp; &notin; &#x41;", ["a&lt; é ∉ A"]),
    ("&am<i>p;</i>", ["&amp;"]), ("<![CDATA[in]]> out", ["in out"]), ("<p>one</p></body></html><p>two", ["one", "two"]), ("<dialog>no</dialog><details><summary>s</summary>d</details>", ["s", "d"]), ("<div/>a<p/>b", ["a", "b"]), ("<button>no<p>yes", ["yes"]), ("<p", []), ("x<p a='b", ["x"]),
]


@pytest.mark.parametrize("source,want", TEXTS)
def test_lenient_parsing(source, want):
    assert [t for _, t in html.parse(source).text] == want


def test_any_input_is_parsed_and_every_node_has_its_parent_before_it():
    rng = random.Random(3)
    parts = ["<p>", "</p>", "<div>", "</div>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<b>", "</b>", "<a href=x>", "</a>", "<li>", "<ul>", "</ul>", "text ", "<button>", "</button>", "<span hidden>", "</span>", "<caption>", "<tbody>", "</tr>", "<select>", "<body>", "</body>", "<!-- x -->", "<", "'", '"', "<p hidden>", "<h1>", "&amp;"]
    for _ in range(400):
        page = html.parse("".join(rng.choice(parts) for _ in range(rng.randint(1, 60))))
        assert all(p < i for i, p in enumerate(page.parents)) and len(page.tags) == len(page.parents) == len(page.hints) == len(page.labels)


HOSTILE = ["<p " + "a='\"' " * 10_000, "<p a=\"" * 20_001, "<p a='x\">" * 20_001, "<div>" * 20_000 + "</x>" * 20_000, "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000, "<div>" * 20_000 + "<li>" * 20_000 + "</ul>" * 20_000, "<table><tr><td>" * 8000 + "</tr>" * 8000, "<!--" * 30_000, "<" * 60_000, "<a " * 30_000, "&" * 60_000 + "<p>" * 20_000]


@pytest.mark.parametrize("source", HOSTILE, ids=lambda s: s[:8])
def test_time_grows_with_the_page_only(source):
    began = time.perf_counter()
    html.parse(source)
    assert time.perf_counter() - began < 4

"""Pages as tag events: golden pages, the column expressions on random pages, and linear time."""

import random
import time

import pyarrow as pa
import pytest

from corpusloom import fixed_values as fixed
from corpusloom.functions import html, tagevents
from corpusloom.operators import pages as page_ops

from test_functions import PAGE


def read(page, content=fixed.CONTENT_SELECTORS):
    return tagevents.read_page(page, list(content), fixed.TAG_SELECTOR, "Keywords")


def test_golden_page():
    found = read(PAGE)
    assert (found["title"], found["keyword"], found["content"], found["hrefs"]) == ("Tea_Suffix", "leaf,cup", "Tea is a drink", ["http://ex.org/view/1?x=2#y", "/local"])
    assert read(None) == read("") == read("<p>x</p>") == {"content": "", "title": "", "tags": "", "keyword": "", "hrefs": []}


def test_named_and_numeric_references():
    assert tagevents.plain_text("a &lt;b&gt; &amp;lt; &#233;&#x4E2D; &#1F; &#x1F600;!&nbsp;&nbsp;z &copy; &Eacute;&NotEqualTilde; &nosuch; &amp &#0;") == "a <b> &lt; é中 &#1F; 😀! z © É≂̸ &nosuch; &amp &#0;"
    assert tagevents.plain_text("5 < 6 <!-- no > --> <p>x</p>y<!-- open") == "5 < 6 x y<!-- open"
    assert len(tagevents.NAMED) > 2000


def test_random_pages_read_like_the_expressions(spark):
    rng = random.Random(8)
    bits = [
        "<div>", "</div>", "<DIV class='x body-wrapper'>", "<div id=sec-content0>", "<p class=body-wrapper>", "</p>", "<b>", "</b>", "<br/>", "one ", "two", " &amp; ", "&eacute",
        "<a href='/v/1?q#f'>", "<A HREF=/v/2>", "</a>", "<title>T", "</title >", '<meta content="k" name=Keywords>', "<span id='open-tag-item'>", "</span>", "<!-- c -->", "< 5", "<script>x<p>", "</script>", "<style>", "</style>", "&#65;",
    ]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, html string")
    clean = rows.select("n", html.without_code("html").alias("h"))
    tags = html.plain_text(html.F.coalesce(html.first_element("h", fixed.TAG_SELECTOR), html.F.lit("")))
    wanted = {r.n: r for r in clean.select(
        "n", html.content_text("h", fixed.CONTENT_SELECTORS).alias("content"), html.page_title("h").alias("title"), tags.alias("tags"),
        html.meta_content("h", "Keywords").alias("keyword"), html.page_links("h", ["/v/"]).alias("hrefs"),
    ).collect()}
    found = page_ops.read_pages(rows, page_ops.PageRules(link_prefixes=["/v/"])).collect()
    assert len(found) == len(texts)
    some = 0
    for r in found:
        w = wanted[r.n]
        assert r.content == w.content, texts[r.n]
        if r.content:
            some += 1
            assert (r.title, r.tags, r.keyword, r.hrefs) == (w.title, w.tags, w.keyword, w.hrefs), texts[r.n]
    assert some > 50


def test_deep_nesting_and_open_code_take_linear_time():
    def seconds(page):
        start = time.perf_counter()
        found = read(page)
        return time.perf_counter() - start, found

    deep = lambda n: "<div id='sec-content0'>" + "<div>" * n + "tea" + "</div>" * n + "</div><title>x</title>"
    assert seconds(deep(50_000))[1]["content"] == "tea"
    small, large = min(seconds(deep(10_000))[0] for _ in range(3)), min(seconds(deep(80_000))[0] for _ in range(3))
    assert large < 30 * small
    for odd in ("<script>" * 50_000, "<title>" * 50_000, "<!--" * 50_000, "<a href='" * 50_000, "<div>" * 50_000):
        took, found = seconds("<p id=sec-content0>tea</p>" + odd)
        assert took < 5 and found["content"] == "tea"


def test_one_pass_for_all_fields(spark):
    rows = spark.createDataFrame([(1, PAGE)], "n int, html string")
    plan = page_ops.read_pages(rows, page_ops.PageRules())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("n", [0, 1, 64, 65, 200])
def test_pages_are_read_in_slices(n):
    texts = [None if i % 7 == 3 else f"<title>t{i}</title><article>text {i}</article><a href='/{i}'>" for i in range(n)]
    seen = []

    def read(page):
        seen.append(page)
        return tagevents.read_page(page, ["article"], ".tags", "Keywords")

    got = tagevents.read_all(pa.array(texts, pa.string()), read, tagevents.PAGE_ARROW)
    assert seen == texts and got.type == tagevents.PAGE_ARROW
    assert got.to_pylist() == [tagevents.read_page(t, ["article"], ".tags", "Keywords") for t in texts]

"""Wrappers: awkward markup, several templates on one host, lines of the template inside the article."""

from __future__ import annotations

import random

from tallyhouse.llm import html_wrapper as hw

PAGE = "<html><body><div class='nav'><a href=/>Home</a></div><article><h1>{}</h1>{}</article><footer>f</footer></body></html>"
COLUMNS = "page_id long, url string, html string, host string, part string, paths string"


def text_of(html: str) -> str:
    return hw.page_text(html, None, frozenset())


def test_hidden_parts_end_where_they_end():
    assert text_of("<article><p>a</p><div hidden><div>x</div>LEAK</div><p>b</p></article>") == "a b"
    assert text_of("<article><p class='a hidden b' title='hidden'>seen</p><p style='display : none'>no</p></article>") == "seen"
    assert text_of("<article><p hidden>x<p>b</p></article>") == "b"


def test_a_form_around_the_page_is_no_form_in_it():
    inner = "<h1>T</h1><p>one two</p><form><p>name <input></p></form>"
    assert text_of(f"<html><body><form id=aspnet><main>{inner}</main></form></body></html>") == "T one two"


def test_prose_named_like_an_aside():
    assert text_of("<article><div class='search methods'><p>We search.</p></div></article>") == "We search."
    assert text_of("<article><p>a</p><div class='search'><form><p>Find</p><input></form></div></article>") == "a"
    assert text_of("<article><p>a</p><div class='comments'><p>Nice</p></div></article>") == "a"


def test_deep_nesting_is_read_in_place():
    for tag in ("div", "span", "b", "ul"):
        deep = f"<article><p>first</p>{f'<{tag}>' * 5000}core<nav>menu</nav>{f'</{tag}>' * 5000}<p>last</p></article>"
        assert text_of(deep) == "first core last", tag
    assert text_of("<article>" + "<div>" * 5000 + "core") == "core"
    assert text_of("<article>" + "<div>" * 300 + "a" + "</div>" * 150 + "b</article>") == "a b"


def test_many_siblings_are_aligned_in_order():
    rng = random.Random(3)
    pages = []
    for _ in range(2):
        rows = "".join(f"<{t}>{rng.random()}</{t}>" for t in rng.choices(["p", "h2", "ul", "pre", "dl", "hr"], k=20_000))
        pages.append(f"<article>{rows}</article>")
    wrapper = hw.infer(pages)
    assert wrapper.pages == 2 and hw.article_path(wrapper) == ["article"]
    a = [hw.Element(rng.choice("pqrs")) for _ in range(900)]
    b = [hw.Element(rng.choice("pqrs")) for _ in range(900)]
    pairs = hw._aligned(a, b)
    assert [x for x, _ in pairs if x is not None] == a and [y for _, y in pairs if y is not None] == b
    both = [(x, y) for x, y in pairs if x is not None and y is not None]
    assert both and all(x.shape == y.shape for x, y in both)


def test_lines_of_the_template_leave_the_article():
    bodies = [f"<p>Own words {i} of page {i * i}.</p><p>Share this page with friends.</p><p>More {i}.</p>" for i in range(20)]
    wrapper = hw.pruned(hw.infer([PAGE.format(f"Title {i}", b) for i, b in enumerate(bodies)]))
    constant = frozenset(hw.constant_lines(wrapper))
    assert "Share this page with friends." in constant
    got = hw.page_text(PAGE.format("Title 3", bodies[3]), hw.article_paths(wrapper), constant)
    assert got == "Title 3 Own words 3 of page 9. More 3."
    # Copies of one page are no template: nothing is taken from them.
    same = PAGE.format("T", "<p>only text of all pages</p>")
    wrapper = hw.infer([same] * 20)
    got = hw.page_text(same, hw.article_paths(wrapper), frozenset(hw.constant_lines(wrapper)))
    assert got == "T only text of all pages"


def test_merging_in_parts_gives_the_places_of_all_templates(spark):
    other = "<html><body><main><h2>{}</h2><p>{} in another template</p></main></body></html>"
    rows = [(i, f"http://big.example.org/{i}", PAGE.format(f"N{i}", f"<p>the own text of page {i}</p><p>Fixed line.</p>"), "h", None, "x") for i in range(400)]
    rows += [(1000 + i, f"http://big.example.org/m{i}", other.format(i, i), "h", None, "x") for i in range(40)]
    rows += [(2000, None, None, None, None, None), (2001, "no url", "", "h", "p", "x"), (2001, "no url", "", "h", "p", "x")]
    rows += [(3000, "http://long.example.org/", PAGE.format("L", "<p>word</p>" * 100_000), "h", "p", "x")]
    pages = spark.createDataFrame(rows, COLUMNS).repartition(80)
    got = {(r.page_id, r.text, r.n_chars) for r in hw.main_text(pages).collect()}
    expected = {(i, t, len(t)) for i in range(400) for t in [f"N{i} the own text of page {i}"]}
    expected |= {(1000 + i, t, len(t)) for i in range(40) for t in [f"{i} {i} in another template"]}
    long = "L" + " word" * 100_000
    assert got == expected | {(2000, "", 0), (2001, "", 0), (3000, long, len(long))}
    found = hw.wrappers(pages.select("html", "url").withColumn("host", spark_host()).filter("html is not null")).collect()
    by_host = {r.host: r for r in found}
    assert by_host["big.example.org"].n_pages == 440 and len(found) == 3
    assert "Fixed line." in by_host["big.example.org"].constant
    assert hw.main_text(pages.limit(0)).count() == 0


def spark_host():
    from pyspark.sql import functions as F

    from tallyhouse.llm.url_filter import url_parts

    return url_parts(F.col("url"))[0]

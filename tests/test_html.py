"""Elements of pages against the standard library's parser and on awkward markup."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from atlaslens import config
from atlaslens.functions import html
from atlaslens.operators import reviews


class Outline(HTMLParser):
    """Start tags with their class, and texts outside scripts and styles."""

    def __init__(self, content):
        super().__init__(convert_charrefs=True)
        self.tags, self.texts, self.raw = [], [], False
        self.feed(content)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, dict(attrs).get("class"), dict(attrs).get("href")))
        self.raw = tag in ("script", "style")

    def handle_endtag(self, tag):
        self.raw = False

    def handle_data(self, data):
        if not self.raw:
            self.texts.append(data)


AWKWARD = [
    '<p class="a">one<br>two<p>three <b>four</p> five',
    "<div class='x y' href=\"a&amp;b\">t &lt; &eacute; &amp;amp;</div>",
    '<script>var a = "<p>no</p>";</script><p>yes</p><style>p > a {}</style>',
    "<!-- <p>hidden</p> --><P Class=up>shown</P>",
    '<img src="a>b" class=k><input disabled/>text',
    "a < b and <3 and c > d <i>e</i>",
    "", "no markup", "<!DOCTYPE html><html><head><meta charset=utf-8></head></html>",
]


@pytest.mark.parametrize("content", AWKWARD)
def test_same_outline_as_the_standard_parser(content):
    page, expected = html._Page(content), Outline(content)
    assert [(e.tag, e.attribute("class"), e.attribute("href")) for e in page.elements] == expected.tags
    assert "".join(page.texts) == "".join(expected.texts)


def test_same_outline_on_given_pages(spark, sf_dir):
    for row in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect():
        page, expected = html._Page(row.html), Outline(row.html)
        assert [(e.tag, e.attribute("class"), e.attribute("href")) for e in page.elements] == expected.tags
        assert "".join(page.texts) == "".join(expected.texts)


def test_ranges_of_nested_elements():
    page = html._Page('<div id=a>1<span>2<i>3</i></span>4<br>5</div>6')
    div = page.select("div")[0]
    assert page.text(div) == "12345"
    assert [p if isinstance(p, str) else p.tag for p in page.parts(div)] == ["1", "span", "4", "br", "5"]
    assert [e.tag for e in page.below(div, "i")] == ["i"]
    assert page.outer(page.select("span")[0]) == "<span>2<i>3</i></span>"


def test_an_end_tag_closes_what_is_inside_it():
    page = html._Page("<div><p>a<p>b</div>c</p>d")
    assert [page.text(p) for p in page.select("p")] == ["ab", "b"]
    assert page.text(page.select("div")[0]) == "ab"


def test_class_is_one_of_the_words_or_the_whole():
    page = html._Page('<b class="lTi8oc z3HNkc">1</b><b class="z3HNkc">2</b><b class="z3HNkcX">3</b><b>4</b>')
    assert [page.text(e) for e in page.select("b", "z3HNkc")] == ["1", "2"]
    assert [page.text(e) for e in page.select("b", "lTi8oc z3HNkc")] == ["1"]


def test_a_long_unclosed_page_is_linear():
    page = html._Page("<p class=x>a" * 50_000)
    assert len(page.elements) == 50_000 and page.lead(page.elements[0]) == "a"


def review_page(*blocks):
    return "<html><body>" + "".join(blocks) + "</body></html>"


def test_reviews_of_a_page(spark):
    content = review_page(
        '<div class="TSUbDb"> Ann,\nLee </div><div class="PuaHbe">a\n week  ago</div><span class="lTi8oc z3HNkc" aria-label="Rated 4.0"></span>'
        '<div class="Jtu6Td"><span class="review-full-text">(Translated by Google) good<br><br>(Original)<br>bueno</span></div>',
        '<div class="TSUbDb">Bo|b</div><div class="PuaHbe">soon</div><span class="lTi8oc z3HNkc"><i>no digits in text</i></span>'
        '<div class="Jtu6Td"><span class="f5axBf"><b></b><span>short <i>more</i></span></span></div>',
        '<div class="TSUbDb">Cy</div><div class="Jtu6Td"></div>',
        '<div class="TSUbDb">Extra</div>',
    )
    pages = spark.createDataFrame(
        [("p", "d", "Bar", "2024-03-10", "en", 0, content), ("q", "d", "Bar", "2024-03-10", "fr", 0, content)],
        "place_id string, data_id string, name string, scrape_ds string, scrape_language string, page_number int, content string",
    ).withColumn("scrape_ds", F.to_date("scrape_ds"))
    rows = reviews.parse_pages(pages, config.parser_table(spark), F.to_date(F.lit("2024-03-20"))).orderBy("position").collect()
    # A language without parser settings gives no rows.
    assert {row.place_id for row in rows} == {"p"}
    found = [(r.position, r.reviewer_name, r.review_original, r.review_target_language, r.stars, r.time, r.age_error, r.aligned) for r in rows]
    assert found == [
        (0, "Ann Lee", "bueno", "good", 4.0, "a week ago", None, True),
        (1, "Bob", "short", "short", 8.0, "soon", "text", True),
        (2, "Cy", "", "", None, None, "text", True),
        (3, "Extra", None, None, None, None, "text", False),
    ]
    assert str(rows[0].review_date) == "2024-03-03" and rows[0].age_in_days == 17
    assert len({r.unique_review_id for r in rows}) == 4


BROKEN = ['<div class="x\'', "<a ", "<", "<!-- ", "<script", '<a "', "<a \"'>", "<a<a", '</a x="', "<!", "<p \"' >", '<a b="1" ']


@pytest.mark.parametrize("unit", BROKEN)
@pytest.mark.parametrize("tail", ["", '">"', "'>'"])
def test_scan_is_linear_on_broken_markup(unit, tail):
    """4 MB of markup that never closes: quadratic work would take hours."""
    import time

    tags = html.Tags(unit * ((4 << 20) // len(unit)) + tail)
    start = time.perf_counter()
    while tags.next():
        pass
    assert time.perf_counter() - start < 30


@given(st.lists(st.sampled_from(["<", "</", ">", '"', "'", "a", "b=", " ", "/", "<a ", "<i>", "<!--", "-->", "<!", "é", "\n", "x"]), max_size=40).map("".join))
@settings(max_examples=2_000, deadline=None)
def test_ordinary_tags_are_those_of_the_careful_search(source):
    def every():
        tags = html.Tags(source)
        return list(iter(tags.next, None))

    quick, pattern = every(), html.PLAIN
    try:
        html.PLAIN = re.compile("(?!)")
        assert every() == quick
    finally:
        html.PLAIN = pattern

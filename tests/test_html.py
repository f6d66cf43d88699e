"""Selection on page shapes a parser would repair."""

import pytest
from pyspark.sql import functions as F

from sorted_rows import rows
from kawaraban.operators import html as H
from kawaraban.operators.extract import english_body, headline_items, japanese_body, paragraph_text
from kawaraban.sources import profiles as P


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id bigint, html string").withColumn(
        "url", F.col("page_id").cast("string")
    )


def texts(spark, html, tag, **selector):
    """Texts of the elements of one page, in page order."""
    found = H.text_of(H.html_tokens(pages(spark, html)), tag, **selector)
    return [t for _, t in rows(found, "start", "text")]


@pytest.mark.parametrize(
    "html, tag, expected",
    [
        ("<p>a<p>b</p>c", "p", ["a", "b"]),
        ("<p>a<div>b</div>", "p", ["a"]),
        ("<div><p>a</div>b", "p", ["a"]),
        ("<P CLASS=x>a</P>", "p", ["a"]),
        ('<p title="1 > 0">a</p>', "p", ["a"]),
        ("<p>a<!-- </p> -->b</p>", "p", ["ab"]),
        ('<p>a<script>x("</p>")</script>b</p>', "p", ["ab"]),
        ("<p>unclosed to the end", "p", ["unclosed to the end"]),
        ("<p></p><p>x</p>", "p", ["", "x"]),
        ("<div>a<div>b</div>c</div>d", "div", ["abc", "b"]),
        ("</div><div>a</div></div>", "div", ["a"]),
        ("<div>a<div>b</div>c", "div", ["abc", "b"]),
        ("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul>f", "li", ["abcd", "b", "c", "e"]),
        ("<b>a<br>b</b>", "b", ["ab"]),
        ("<b/>a<b>c</b>", "b", ["", "c"]),
        ("<a href=/x/>t</a>", "a", ["t"]),
        ("a < b <i>c</i>", "i", ["c"]),
        ("<i>1 < 2</i>", "i", ["1 < 2"]),
        ('<i t="x>c</i>', "i", ["c"]),
        ("<i don't>c</i> isn't", "i", ["c"]),
        ("<i t='a>b' u=\"</i>\">c</i>", "i", ["c"]),
        ("<h1>&lt;x&gt; &amp;amp;</h1>", "h1", ["<x> &amp;"]),
    ],
)
def test_text_of_elements(spark, html, tag, expected):
    assert texts(spark, html, tag) == expected


def test_selectors(spark):
    html = '<div class="a b" id="i">1</div><div class="a">2</div><div class="ab">3</div><div>4</div>'
    assert texts(spark, html, "div", class_="a") == ["1", "2"]
    assert texts(spark, html, "div", class_exact="a b") == ["1"]
    assert texts(spark, html, "div", el_id="i") == ["1"]


def test_attributes(spark):
    html = """<a href="/x?a=1&amp;b=2">1</a><a href='/y'>2</a><a href=/z>3</a><a data-href="/no">4</a><a href="">5</a>"""
    tok = H.html_tokens(pages(spark, html)).where("tag = 'a' AND NOT is_close")
    assert [h for _, h in rows(tok, "pos", "href")] == ["/x?a=1&b=2", "/y", "/z", None, ""]


def test_attributes_in_quoted_values_do_not_count(spark):
    html = (
        """<a title="see href=foo bar" href="/x">1</a><a title='id="no"' id=i class = "k" href='/y'>2</a>"""
        """<a disabled href=/z>3</a><a t="a>b" data-href="/no" HREF="/w">4</a><a alt=href=/q>5</a><a/href=/s>6</a>"""
    )
    tok = H.html_tokens(pages(spark, html)).where("tag = 'a' AND NOT is_close")
    assert [h for _, h in rows(tok, "pos", "href")] == ["/x", "/y", "/z", "/w", None, "/s"]
    assert [(i, c) for _, i, c in rows(tok, "pos", "el_id", "class")][:2] == [(None, None), ("i", "k")]


def test_references(spark):
    html = "<b>&#0000000038;&#x00000026;&apos;&#39;&#x110000;&#99999999999999999999;&#x1F600;&#xFFFFFFFFFFFFFFFFFF;</b>"
    assert texts(spark, html, "b") == ["&&\'\'&#x110000;&#99999999999999999999;\U0001f600&#xFFFFFFFFFFFFFFFFFF;"]


def test_within_lists_every_pair(spark):
    html = "<div><div><i>a</i></div><i>b</i></div><i>c</i>"
    tok = H.html_tokens(pages(spark, html))
    pairs = H.within(H.elements(tok, "div"), H.elements(tok, "i"))
    assert rows(pairs, "outer", "start") == [(0, 2), (0, 6), (1, 2)]
    div, i = ("div", H.is_element("div")), ("i", H.is_element("i"))
    assert rows(H.inside(H.nodes(tok, ["div", "i"]), div[1], i[1]), "outer", "start") == [(0, 2), (0, 6), (1, 2)]
    assert rows(H.first_within(tok, div, i), "outer", "start") == [(0, 2), (1, 2)]
    # An element does not lie within itself.
    assert rows(H.within(H.elements(tok, "div"), H.elements(tok, "div")), "outer", "start") == [(0, 1)]


def test_within_ends_inner_with_outer(spark):
    tok = H.html_tokens(pages(spark, "<section><b>a</section><i>x</i>"))
    inner = H.within(H.elements(tok, "section"), H.elements(tok, "b"))
    assert rows(inner, "start", "stop") == [(1, 4)]


def test_scope_takes_outermost_and_first(spark):
    html = "<div><section><p>a</p><section><p>b</p></section></section><section><p>c</p></section></div><p>d</p>"
    n = H.nodes(H.html_tokens(pages(spark, html)), ["div", "section", "p"])
    in_sec = H.scope(n, "sec", H.is_element("section")).where("tag = 'p'")
    assert rows(in_sec, "sec", "start") == [(1, 2), (1, 6), (11, 12)]
    n = H.scope(n, "div", H.is_element("div"))
    first = H.scope(H.scope(n, "sec", H.is_element("section"), "div"), "p1", H.is_element("p"), "sec", first=True)
    assert rows(first, "sec", "p1") == [(1, 2), (11, 12)]
    only = H.scope(n, "sec", H.is_element("section"), first=True).where("tag = 'p'")
    assert rows(only, "start") == [(2,), (6,)]


def test_markup(spark):
    marked = H.markup_of(H.html_tokens(pages(spark, '<p>a &amp; "b"<br>&eacute;<p class="x">c</p>')), "p")
    assert [m for _, m in rows(marked, "start", "markup")] == ['<p>a &amp; "b"<br/>é</p>', '<p class="x">c</p>']


BODY = '<div class="x StandardArticleBody_body">'


def test_english_body(spark):
    p = pages(
        spark,
        f'{BODY}<p>One, (two).</p><p class="k">Three<br>four</p></div><p>after</p>',
        f"{BODY}No paragraph, A&amp;B</div>{BODY}<p>then one</p></div>",
        "<div><p>no body</p></div>",
    )
    assert rows(english_body(p, "page_id")) == [(0, "one twothreefour"), (1, "no paragraph a&amp;bthen one")]


def test_japanese_body(spark):
    p = pages(spark, f"{BODY}<p>あ,\nい<b>う</b></p>no<p>え&lt;</div>")
    assert rows(japanese_body(p, "page_id")) == [(0, "あいうえ&lt;")]


def test_headlines_pair_up_to_the_shortest(spark):
    html = (
        '<div class="news-headline-list"><time>t1</time><a href="/1"></a><p>s1</p><a href="/pic1"></a>'
        '<time>t2</time><a href="/2">x</a><p>s2</p><a href="/pic2"></a><time>t3</time></div>'
        '<div class="news-headline-list"><time>u1</time><p><a href="/3">s3</a></p></div>'
    )
    items = headline_items(pages(spark, html), "page_id")
    assert rows(items, "ord", "time", "summary", "href") == [
        (0, "t1", "s1", "/1"),
        (0, "u1", "s3", "/3"),
        (1, "t2", "s2", "/2"),
    ]


def test_no_page_and_empty_page(spark):
    p = spark.createDataFrame([(0, None), (1, "")], "page_id bigint, html string")
    assert H.html_tokens(p).count() == 0


def test_result_does_not_depend_on_partitions(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")

    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            pairs = H.inside(H.nodes(H.html_tokens(p), ["article", "p"]), H.is_element("article"), H.is_element("p"))
            body = paragraph_text(p, P.Selector("article"), "page_id")
            return rows(pairs, "page_id", "outer", "start", "stop"), rows(body)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")

    assert run("1") == run("7")


def executed(df):
    """The plan that ran, after all adaptive changes."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_selections_cut_markup_once_and_shuffle_what_they_keep(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    tok = H.html_tokens(p)
    article, par = ("article", H.is_element("article")), ("p", H.is_element("p"))
    assert "Exchange" not in executed(tok)
    for df in (
        H.elements(tok, "p"),
        H.first_within(tok, article, par),
        H.inside(H.nodes(tok, ["article", "p"]), article[1], par[1]),
        H.text_of(tok, "p"),
        H.markup_of(tok, "p"),
    ):
        plan = executed(df)
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("regexp_extract_all") == 1
        assert "ReadSchema: struct<page_id:bigint,html:string>" in plan
    assert "#piece" not in executed(H.elements(tok, "p")).split("Exchange")[-1]

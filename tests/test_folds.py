"""Selection inside a page's row agrees with selection over the token table, and moves nothing."""

import random

import pytest
from pyspark.sql import functions as F

from kawaraban.functions.html import decode_entities, decoded
from kawaraban.operators import extract as E
from kawaraban.operators import folds as L
from kawaraban.operators import html as H
from kawaraban.operators.html import PIECE, concat_in_order, html_tokens, is_element, markup_pieces, nodes, scope, scopes
from kawaraban.sources import profiles as P
from sorted_rows import rows

BITS = [
    "<p>", "</p>", '<p class="x">', "<div>", "</div>", '<div class="a b">', '<div class="a&amp;c" id="i">', "<section>",
    "</section>", "<ul>", "</ul>", "<li>", "</li>", "<ol>", "</ol>", "<b>", "</b>", '<a href="/x?a=1&amp;b=2">', "</a>", "<a>",
    "<br>", "<b/>", "<div/>", "<!-- <p> -->", '<script>if(a<b)"</p>"</script>', "text ", "&lt;t&gt; ", "x < y ",
    "&#233;&bogus;&amp;amp; ", "<img src=x>", "<a href='y'/>", "<article>", "</article>", '<span class="a">', "</span>",
    '<article class="a">', '<div class="StandardArticleBody_body">',
]
SELECTORS = [{"tag": "div", "class_": "a"}, {"tag": "article"}, {"tag": "span", "class_": "a"}, {"tag": "div", "class_": "a&c"},
             {"tag": "div", "class_exact": "a b"}, {"tag": "div", "el_id": "i"}]


@pytest.fixture(scope="module")
def soup(spark):
    rnd = random.Random(11)
    pages = [(i, "".join(rnd.choice(BITS) for _ in range(rnd.randrange(60)))) for i in range(400)]
    return spark.createDataFrame([*pages, (400, None), (401, "")], "page_id bigint, html string").repartition(3).cache()


def by_windows(pages, container, pieces, tokens=lambda t: t):
    n = nodes(tokens(html_tokens(pages)), [container.tag, "p"], pieces=pieces)
    return scope(n, "box", container.match())


@pytest.mark.parametrize("kw", SELECTORS)
def test_paragraphs(soup, kw):
    container = P.Selector(**kw)
    n = scope(by_windows(soup, container, ("text",)), "p", is_element("p"), parent="box")
    piece = F.when((F.col("tag") == PIECE) & F.col("p").isNotNull(), F.col("text"))
    want = n.groupBy("page_id").agg(concat_in_order(F.col("start"), piece).alias("text")).withColumn("text", decode_entities("text"))
    assert rows(E.paragraph_text(soup, container, "page_id")) == rows(want)
    n = scope(by_windows(soup, container, H.MARKUP, markup_pieces), "p", is_element("p"), parent="box")
    want = n.groupBy("page_id").agg(concat_in_order(F.col("start"), piece).alias("text"))
    assert rows(L.paragraphs(soup, container, "page_id", markup=True)) == rows(want)


@pytest.mark.parametrize("kw", SELECTORS)
def test_body_markup(soup, kw):
    container = P.Selector(**kw)
    n = scopes(by_windows(soup, container, H.MARKUP, markup_pieces), "box", p=is_element("p"))
    here = lambda name: concat_in_order(F.col("start"), F.when((F.col("tag") == PIECE) & F.col(name).isNotNull(), F.col("text")))
    boxes = n.groupBy("page_id", "box").agg(F.when(F.count("p") > 0, here("p")).otherwise(here("box")).alias("markup"))
    want = boxes.groupBy("page_id").agg(concat_in_order(F.col("box"), F.col("markup")).alias("markup"))
    assert rows(L.body_markup(soup, container, "page_id")) == rows(want)


@pytest.mark.parametrize("kw", [*SELECTORS, {"tag": "p"}, {"tag": "li"}, {"tag": "b"}, {"tag": "a"}])
def test_links(soup, kw):
    container = P.Selector(**kw)
    n = scope(nodes(html_tokens(soup), [container.tag, "a"]), "box", container.match())
    want = n.where((F.col("tag") == "a") & F.col("href").isNotNull()).select("page_id", "start", "href")
    assert rows(E.links_in(soup, container, "page_id")) == rows(want)


@pytest.mark.parametrize("kw", [*SELECTORS, {"tag": "p"}, {"tag": "li"}, {"tag": "b"}, {"tag": "br"}, {"tag": "div"}])
def test_contents(soup, kw):
    selector = dict(kw)
    tag = selector.pop("tag")
    tok = html_tokens(soup)
    assert rows(L.contents(soup, P.Selector(**kw))) == rows(H.text_of(tok, tag, **selector))
    assert rows(L.contents(soup, P.Selector(**kw), markup=True)) == rows(H.markup_of(tok, tag, **selector))


def test_references_are_decoded_alike(spark):
    texts = ["a", "", None, "&amp;amp;", "&#65;&#x41;&#X1F600;&#0;&#xD800;&#1114112;&#99999999999999999999;", "&", "&&lt", "&lt;&;&bogus;&eacute;x", "&#x;&#;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select(decode_entities("t").alias("a"), decoded(F.col("t")).alias("b")).collect():
        assert r["a"] == r["b"]


def test_nothing_is_moved(soup):
    for df in (
        E.paragraph_text(soup, P.Selector("article"), "page_id"),
        E.english_body(soup, "page_id"),
        E.japanese_body(soup, "page_id"),
        E.links_in(soup, P.Selector("p"), "page_id"),
        L.contents(soup, P.Selector("p"), markup=True),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("InMemoryRelation")[0]
        assert not any(step in plan for step in ("Exchange", "Sort", "Window", "Aggregate"))

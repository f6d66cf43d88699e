"""Field extraction with site profiles.

Bodies and links are folds over the tokens inside a page's row; nothing is
shuffled for them.  Listings read a page table once: one exchange by page, one
node table, then scopes that share a sort, then aggregates by page.  The page key
is the URL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kawaraban.functions import text as T
from kawaraban.functions.dates import DAY_HEADING, NEW_ARRIVALS
from kawaraban.functions.html import decode_entities, reserialised
from kawaraban.operators import folds
from kawaraban.operators.html import (
    PIECE,
    concat_in_order,
    html_tokens,
    is_element,
    nodes,
    scope,
    scopes,
)
from kawaraban.operators.rows import complete_only, require, title_contains_any
from kawaraban.sources import profiles as P


def _joined(name: str) -> Column:
    """Aggregate: the raw pieces inside scope ``name``, in page order."""
    hit = (F.col("tag") == PIECE) & F.col(name).isNotNull()
    return concat_in_order(F.col("start"), F.when(hit, F.col("text")))


def _field(name: str) -> Column:
    """Aggregate: ``_joined``, or NULL where the group has no such element."""
    return F.when(F.count(name) > 0, _joined(name))


def _href(name: str) -> Column:
    """Aggregate: link of the element that opened scope ``name``."""
    return F.max(F.when((F.col("tag") == "a") & (F.col("start") == F.col(name)), F.col("href")))


def links_in(pages: DataFrame, container: P.Selector, key: str = "url") -> DataFrame:
    """Links inside the containers: page_id, pos, href."""
    return folds.links(pages, container, key)


def paragraph_text(pages: DataFrame, container: P.Selector, key: str = "url") -> DataFrame:
    """Text of all paragraphs in all containers, entities decoded: page_id, text."""
    return folds.paragraphs(pages, container, key).withColumn("text", decode_entities("text"))


def section_headings(pages: DataFrame, section: P.Selector, tag: str = "h2", key: str = "url") -> DataFrame:
    """First heading of every section, NULL where it has none: page_id, sec, heading."""
    n = nodes(html_tokens(pages, key), [section.tag, tag], pieces=("text",))
    n = scope(n, "sec", section.match())
    n = scopes(n, "sec", first=["head"], head=is_element(tag))
    found = n.groupBy("page_id", "sec").agg(_field("head").alias("heading"))
    return found.withColumn("heading", decode_entities("heading"))


def english_body(pages: DataFrame, key: str = "url") -> DataFrame:
    """Cleaned English article body per page: page_id, text.

    A container gives the markup of its paragraphs, or all of its own markup
    where it has none.
    """
    body = folds.body_markup(pages, P.EN_BODY, key)
    return body.select("page_id", T.strip_tags(T.clean_en(F.col("markup"))).alias("text"))


def japanese_body(pages: DataFrame, key: str = "url") -> DataFrame:
    """Japanese article body per page: page_id, text.

    Paragraph markup without newlines, commas and tags; escapes stay.
    """
    body = folds.paragraphs(pages, P.EN_BODY, key, markup=True)
    return body.select("page_id", T.strip_tags(T.drop_chars(F.col("text"), "\n,")).alias("text"))


def headline_items(pages: DataFrame, key: str = "url") -> DataFrame:
    """Headline listings: page_id, box, ord, time, summary, href.

    Dates, summaries and every second link of a listing box, paired by
    position as far as the shortest of the three reaches.
    """
    n = nodes(html_tokens(pages, key), [P.JA_LIST.tag, "time", "p", "a"], pieces=("text",))
    n = scope(n, "box", P.JA_LIST.match())
    n = scopes(n, "box", **{f"in_{t}": is_element(t) for t in ("time", "p", "a")})
    # A piece may lie in two fields at once, such as a link inside a paragraph.
    fields = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"in_{t}").isNotNull(), F.struct(F.lit(t).alias("field"), F.col(f"in_{t}").alias("at")))
                for t in ("time", "p", "a")
            ]
        )
    )
    parts = (
        n.select("page_id", "box", "tag", "start", "href", "text", F.explode(fields).alias("f"))
        .select("*", "f.*")
        .groupBy("page_id", "box", "field", "at")
        .agg(
            concat_in_order(F.col("start"), F.when(F.col("tag") == PIECE, F.col("text"))).alias("text"),
            _href("at").alias("href"),
        )
    )
    rank = F.row_number().over(Window.partitionBy("page_id", "box", "field").orderBy("at")) - 1
    parts = parts.where((F.col("field") != "a") | F.col("href").isNotNull()).withColumn("ord", rank)
    link = F.col("field") == "a"
    parts = parts.where(~link | (F.col("ord") % 2 == 0)).withColumn(
        "ord", F.when(link, F.floor(F.col("ord") / 2)).otherwise(F.col("ord"))
    )

    def of(field: str, col: str) -> Column:
        return F.max(F.when(F.col("field") == field, F.col(col)))

    zipped = parts.groupBy("page_id", "box", "ord").agg(
        of("time", "text").alias("time"), of("p", "text").alias("summary"), of("a", "href").alias("href")
    )
    plain = lambda c: T.strip_tags(T.drop_chars(reserialised(c), "\n"))
    return complete_only(zipped, ["time", "summary", "href"]).select(
        "page_id", "box", "ord", plain("time").alias("time"), plain("summary").alias("summary"), "href"
    )


def archive_items(pages: DataFrame, key: str = "url") -> DataFrame:
    """Tech archive listings: page_id, pos, title, snippet, href; items without a title are left out."""
    tags = [P.TECH_MAIN.tag, P.TECH_TITLE.tag, "p", "a"]
    n = nodes(html_tokens(pages, key), tags, pieces=("text",))
    n = scope(n, "main", P.TECH_MAIN.match(), first=True)
    # The main element's class is never an item's, so items are looked for inside it.
    n = scope(n, "item", P.TECH_ITEM.match(), parent="main")
    fields = {"in_title": P.TECH_TITLE.match(), "in_p": is_element("p"), "in_a": is_element("a")}
    n = scopes(n, "item", first=fields, **fields)
    items = n.groupBy("page_id", F.col("item").alias("pos")).agg(
        _field("in_title").alias("title"),
        _field("in_p").alias("snippet"),
        _href("in_a").alias("href"),
    )
    plain = lambda c: T.strip_tags(T.drop_chars(c, "\n"))
    return complete_only(require(items, "title"), ["snippet", "href"]).select(
        "page_id",
        "pos",
        plain(reserialised("title")).alias("title"),
        plain(T.clean_snippet(reserialised("snippet"))).alias("snippet"),
        "href",
    )


def archive_details(pages: DataFrame, key: str = "url") -> DataFrame:
    """Tech articles: page_id, time, text.  Time loses its ' (...)' suffix."""
    tags = [P.TECH_TIME.tag, P.TECH_BODY.tag, "p"]
    n = nodes(html_tokens(pages, key), tags, pieces=("text",))
    fields = {"in_time": P.TECH_TIME.match(), "box": P.TECH_BODY.match()}
    n = scopes(n, first=fields, **fields)
    n = scopes(n, "box", in_p=is_element("p"))
    found = n.groupBy("page_id").agg(
        _field("in_time").alias("time"),
        F.when(F.count("box") > 0, _joined("in_p")).alias("text"),
    )
    plain = lambda c: T.strip_tags(T.drop_chars(c, "\n"))
    return complete_only(found, ["time", "text"]).select(
        "page_id",
        plain(T.drop_paren_suffix(decode_entities("time"))).alias("time"),
        plain(T.drop_chars(decode_entities("text"), T.IDEOGRAPHIC_SPACE)).alias("text"),
    )


def property_items(pages: DataFrame, key: str = "url", incomplete: bool = False) -> DataFrame:
    """Property listings: page_id, sec, kind, pos, heading, title, summary, href.

    Per section: links of the pick-ups (kind 0), then links of the first item
    list (kind 1), if it has one.  Sections without a day or 'new arrivals'
    heading are left out, and so are links that lack a title, summary or
    address, unless ``incomplete`` asks for them.
    """
    tags = ["div", "section", "h2", "ul", "li", "a", "h3", "p"]
    n = nodes(html_tokens(pages, key), tags, pieces=("text",))
    n = scope(n, "main", P.PROPERTY_MAIN.match(), first=True)
    n = scope(n, "sec", P.PROPERTY_SECTION.match(), parent="main")
    n = scopes(
        n,
        "sec",
        first=["in_h2", "list"],
        in_h2=is_element("h2"),
        pickup=P.PROPERTY_PICKUP.match(),
        list=P.PROPERTY_LIST.match(),
    )
    n = scopes(n, "list", item=is_element("li"))
    listed = F.col("pickup").isNotNull() | F.col("item").isNotNull()
    n = scopes(n, in_a=is_element("a") & listed)
    fields = {"in_h3": is_element("h3"), "in_summary": P.PROPERTY_SUMMARY.match()}
    n = scopes(n, "in_a", first=fields, **fields)

    heading_piece = F.when(
        F.col("in_h2").isNotNull(), F.struct("start", F.when(F.col("tag") == PIECE, F.col("text")).alias("text"))
    )
    links = n.groupBy("page_id", "sec", F.col("in_a").alias("pos")).agg(
        F.collect_list(heading_piece).alias("heading"),
        F.when(F.max("pickup").isNotNull(), 0).otherwise(1).alias("kind"),
        _field("in_h3").alias("title"),
        _field("in_summary").alias("summary"),
        _href("in_a").alias("href"),
    )
    # A section's heading, onto all of its links.
    pieces = F.array_sort(F.flatten(F.collect_list("heading").over(Window.partitionBy("page_id", "sec"))))
    links = links.withColumn("heading", pieces).withColumn(
        "heading",
        F.when(
            F.size("heading") > 0,
            T.strip_tags(T.drop_chars(F.array_join(F.transform("heading", lambda p: p["text"]), ""), "\n")),
        ),
    )
    links = title_contains_any(require(links, "heading"), [DAY_HEADING, NEW_ARRIVALS], "heading")
    plain = lambda c: T.strip_tags(decode_entities(c))
    links = links.where("pos IS NOT NULL")
    links = links if incomplete else complete_only(links, ["title", "summary", "href"])
    return links.select(
        "page_id",
        "sec",
        "kind",
        "pos",
        "heading",
        T.drop_chars(plain("title"), "\n").alias("title"),
        plain("summary").alias("summary"),
        "href",
    ).withColumn("summary", T.drop_chars(T.to_fullwidth(F.col("summary")), "\n"))

"""HTML selection as relational work over a token table.

``html_tokens`` spreads pages into one row per token where they are read.
``nodes`` keeps the tokens a selection needs and makes its only exchange (hash
by page); every step below it is a window or an aggregation whose keys start
with ``page_id``, so Spark adds no further exchange.  Windows never hold more
than one page.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from kawaraban.functions import html as H

# Tags whose start or end closes an open paragraph.
BLOCK_TAGS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul"
).split()
LIST_TAGS = ("ul", "ol")
IMPLIED_END_TAGS = ("p", "li")
PIECE, ALONE = "#piece", "#alone"
# Token kinds that make up markup.
MARKUP = ("text", "tag", "comment", "raw")
# Position after the last token of any page: the end of elements never closed.
END_OF_PAGE = 2**31 - 1


def html_tokens(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per token: page_id, pos, kind, tag, is_close, el_id, class, href, text.

    ``key`` must identify a page; it is renamed to ``page_id``.  Nothing is
    shuffled.
    """
    return _with_fields(_spread(pages.select(F.col(key).alias("page_id"), F.col(html).alias("html"))))


def _spread(html_rows: DataFrame) -> DataFrame:
    tok = html_rows.select("page_id", F.posexplode(H.tokens(F.col("html"))).alias("pos", "text"))
    tok = tok.withColumn("name", H.tag_name(F.col("text")))
    return tok.withColumn("kind", H.kind(F.col("text"), F.col("name")))


def _with_fields(tok: DataFrame) -> DataFrame:
    is_tag = F.col("kind") == "tag"
    tok = tok.select(
        "page_id",
        "pos",
        "kind",
        F.when(is_tag, F.col("name")).alias("tag"),
        (is_tag & F.col("text").startswith("</")).alias("is_close"),
        *[F.when(is_tag, H.attribute(F.col("text"), a)).alias(a) for a in ("id", "class", "href")],
        "text",
    )
    return tok.select(
        "page_id",
        "pos",
        "kind",
        "tag",
        "is_close",
        H.decode_entities("id").alias("el_id"),
        H.decode_entities("class").alias("class"),
        H.decode_entities("href").alias("href"),
        "text",
    )


def tags_for(tags: Iterable[str]) -> list[str]:
    """The tags ``nodes`` must see to find where elements of ``tags`` end."""
    tags = set(tags)
    more = set(BLOCK_TAGS) if "p" in tags else set()
    return sorted(tags | more | (set(LIST_TAGS) if "li" in tags else set()))


def nodes(tok: DataFrame, tags: Iterable[str], pieces: Iterable[str] = ()) -> DataFrame:
    """Elements of the given tags, with the token range they span, and token pieces.

    Columns: page_id, tag, start, rank, stop, closed, el_id, class, href, text.
    The element is the half-open range ``[start, stop)``.  ``pieces`` names the
    token kinds that also come as rows of their own, with tag ``#piece`` and
    after the element that starts at the same token.  Only tokens that matter
    for these are shuffled, and Spark sizes the partitions by what they hold.
    One pass serves all tags:
    each tag has a lane in which its starts and ends are paired by depth.
    ``p`` and ``li`` may lack an end tag: a block tag ends a ``p``; a sibling
    ``li`` or the end of its list ends an ``li``.
    """
    tags = sorted(set(tags))
    kept = F.col("tag").isin(tags_for(tags))
    tok = tok.where(kept | F.col("kind").isin(*pieces) if pieces else kept).repartition("page_id")
    nested = [t for t in tags if t not in IMPLIED_END_TAGS and t not in H.VOID_TAGS]
    tag, closing, pos = F.col("tag"), F.col("is_close"), F.col("pos")
    alone = (tag.isin(*H.VOID_TAGS) | H.self_closed(F.col("text"))) & ~closing

    lanes = [F.when(~alone & tag.isin(*nested), tag)] if nested else []
    if "p" in tags:
        blocks = ", ".join(f"'{t}'" for t in BLOCK_TAGS)
        lanes.append(F.when(F.expr(f"tag IN ({blocks})"), "p"))
    if "li" in tags:
        lanes.append(F.when(tag.isin("li", *LIST_TAGS), "li"))
    lanes.append(F.when(alone & tag.isin(*tags), ALONE))
    if pieces:
        lanes.append(F.when(F.col("kind").isin(*pieces), PIECE))

    lane = F.col("lane")
    is_list = tag.isin(*LIST_TAGS)
    counts = F.when(lane == "li", is_list).otherwise(~lane.isin("p", ALONE, PIECE))
    rows = tok.select("*", F.explode(F.array(*lanes)).alias("lane")).where(lane.isNotNull())
    rows = rows.withColumn(
        "depth",
        F.sum(F.when(counts, F.when(closing, -1).otherwise(1)).otherwise(0)).over(
            Window.partitionBy("page_id", "lane")
            .orderBy("pos")
            .rowsBetween(Window.unboundedPreceding, 0)
        ),
    )
    # An end belongs to the level it closes; rows that pair with nothing get a level of their own.
    level = F.when(lane.isin(ALONE, PIECE), pos).otherwise(
        F.col("depth") + F.when(counts & closing, 1).otherwise(0)
    )
    rows = rows.where(~((lane == "li") & is_list & ~closing)).withColumn("level", level)
    following = F.lead(F.struct("pos", "tag", "is_close")).over(
        Window.partitionBy("page_id", "lane", "level").orderBy("pos")
    )
    own_end = (F.col("next.tag") == lane) & F.col("next.is_close")
    return (
        rows.withColumn("next", following)
        .where(lane.isin(ALONE, PIECE) | ((tag == lane) & ~closing))
        .select(
            "page_id",
            F.when(lane == PIECE, PIECE).otherwise(tag).alias("tag"),
            pos.alias("start"),
            F.when(lane == PIECE, 1).otherwise(0).alias("rank"),
            F.when(lane.isin(ALONE, PIECE), pos + 1)
            .when(own_end, F.col("next.pos") + 1)
            .otherwise(F.coalesce("next.pos", F.lit(END_OF_PAGE)))
            .alias("stop"),
            (lane.isin(ALONE, PIECE) | F.coalesce(own_end, F.lit(False))).alias("closed"),
            "el_id",
            "class",
            "href",
            "text",
        )
    )


def is_element(
    tag: str,
    class_: str | None = None,
    class_exact: str | None = None,
    el_id: str | None = None,
) -> Column:
    """Condition on a node: tag, and a class token, the whole class text or the id."""
    cond = F.col("tag") == tag
    if class_ is not None:
        cond &= F.array_contains(F.split(F.col("class"), r"\s+"), class_)
    if class_exact is not None:
        cond &= F.col("class") == class_exact
    if el_id is not None:
        cond &= F.col("el_id") == el_id
    return F.coalesce(cond, F.lit(False))


def elements(tok: DataFrame, tag: str, **selector: str) -> DataFrame:
    """Elements of one tag, optionally by class token, exact class or id."""
    return nodes(tok, [tag]).where(is_element(tag, **selector)).drop("rank", "text")


def scopes(
    df: DataFrame, parent: str | None = None, how: str = "left", first: Iterable[str] = (), **matches: Column
) -> DataFrame:
    """Add a column per match: start of the matching element a node lies in, or NULL.

    The element's own row gets its own start.  ``how='inner'`` keeps only nodes
    inside every match.  A match inside another match counts as part of the
    outer one.  Names in ``first`` keep only the first match of each ``parent``
    (a column an earlier scope added), or of each page.

    All matches share one window, and later calls share its sort.  Among the
    matches that started so far, the outermost one around a node is the one
    that reaches furthest, and of those the earliest; matches already over
    reach less far than the node.
    """
    so_far = (
        Window.partitionBy("page_id")
        .orderBy("start", "rank")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    group = F.col(parent) if parent else F.lit(0)
    owners, names, stop = [], [], F.col("stop")
    for name, match in matches.items():
        hit = match & F.col(parent).isNotNull() if parent else match
        fields = [F.col("stop").alias("stop"), (-F.col("start")).alias("from")]
        # Groups follow each other on the page, so the latest group has the largest number.
        fields = [group.alias("group"), *reversed(fields)] if name in first else fields
        owners.append(F.max(F.when(hit, F.struct(*fields))).over(so_far).alias(f"_{name}"))
        own = F.col(f"_{name}")
        inside = F.col("start") < own["stop"]
        if name in first:
            inside &= own["group"] == group
        inside = F.coalesce(inside, F.lit(False))
        names.append(F.when(inside, -own["from"]).alias(name))
        # An element never closed ends at the latest where its container does.
        stop = F.when(inside, F.least(stop, own["stop"])).otherwise(stop)
    out = df.select("*", *owners).select(
        *[stop.alias("stop") if c == "stop" else c for c in df.columns], *names
    )
    return out.dropna(subset=list(matches)) if how == "inner" else out


def scope(
    df: DataFrame, name: str, match: Column, parent: str | None = None, first: bool = False, how: str = "inner"
) -> DataFrame:
    """One ``scopes`` match; by default only nodes inside it are kept."""
    return scopes(df, parent, how, [name] if first else [], **{name: match})


def within(
    outer: DataFrame, inner: DataFrame, include_self: bool = False, keep_outer: bool = False
) -> DataFrame:
    """Every (outer, inner) pair where inner lies in outer, at any depth, of two tables of elements.

    Returns inner's columns plus ``outer``, the outer element's start.  Both
    sides are merged into one event stream per page.  An inner row is repeated
    once per enclosing outer element and finds that element by a running
    window, so the work follows the size of the result; no pairs are tried.
    ``keep_outer`` adds one row per outer element with empty inner columns.
    """
    cols = [c for c in inner.columns if c != "page_id"]
    shape = inner.select(F.struct(*cols).alias("s")).schema["s"].dataType
    bounds = outer.select("page_id", F.explode(F.array(*_bounds(F.lit(None).cast(shape), include_self))).alias("e"))
    rows = inner.select("page_id", _row(F.struct(*cols), include_self).alias("e"))
    return _placed(bounds.unionByName(rows), cols, include_self, keep_outer)


def inside(
    n: DataFrame, outer: Column, inner: Column, include_self: bool = False, keep_outer: bool = False
) -> DataFrame:
    """``within`` for two kinds of rows of one node table, which is read once."""
    cols = [c for c in n.columns if c != "page_id"]
    shape = n.select(F.struct(*cols).alias("s")).schema["s"].dataType
    opened, closed = _bounds(F.lit(None).cast(shape), include_self)
    row = _row(F.struct(*cols), include_self)
    found = F.array_compact(F.array(F.when(outer, opened), F.when(outer, closed), F.when(inner, row)))
    return _placed(n.select("page_id", F.explode(found).alias("e")), cols, include_self, keep_outer)


def _ranks(include_self: bool) -> tuple[int, int]:
    """Order of starts and rows at one position: whether an element holds its own start; ends come first."""
    return (1, 2) if include_self else (2, 1)


def _event(at: str, rank: int, step: int, span: Column, row: Column) -> Column:
    return F.struct(
        F.col(at).alias("at"), F.lit(rank).alias("rank"), F.lit(step).alias("step"), span.alias("span"), row.alias("row")
    )


_NO_SPAN = "struct<start:int,stop:int,closed:boolean>"


def _bounds(no_row: Column, include_self: bool) -> tuple[Column, Column]:
    """The events of an outer element's start and end."""
    span = F.struct("start", "stop", "closed").cast(_NO_SPAN)
    return (
        _event("start", _ranks(include_self)[0], 1, span, no_row),
        _event("stop", 0, -1, F.lit(None).cast(_NO_SPAN), no_row),
    )


def _row(row: Column, include_self: bool) -> Column:
    return _event("start", _ranks(include_self)[1], 0, F.lit(None).cast(_NO_SPAN), row)


def _placed(events: DataFrame, cols: list[str], include_self: bool, keep_outer: bool) -> DataFrame:
    """Rows under every span that holds them: page_id, outer, outer_closed and the row's columns."""
    open_rank, row_rank = _ranks(include_self)
    in_page = Window.partitionBy("page_id").orderBy("at", "rank")
    events = (
        events.select("page_id", "e.*")
        .withColumn("depth", F.sum("step").over(in_page.rowsBetween(Window.unboundedPreceding, 0)))
        .where((F.col("rank") > 0) & (F.col("depth") > 0))
    )
    levels = F.when(F.col("rank") == open_rank, F.array("depth")).otherwise(
        F.sequence(F.lit(1).cast("bigint"), F.col("depth"))
    )
    in_level = (
        Window.partitionBy("page_id", "level")
        .orderBy("at", "rank")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = events.withColumn("level", F.explode(levels)).withColumn(
        "_span", F.last("span", ignorenulls=True).over(in_level)
    )
    if not keep_outer:
        placed = placed.where(F.col("rank") == row_rank)
    # An element never closed ends at the latest where its container does.
    end = F.when(F.col("row").isNotNull(), F.least("row.stop", "_span.stop")) if "stop" in cols else None
    return placed.select(
        "page_id",
        F.col("_span.start").alias("outer"),
        F.col("_span.closed").alias("outer_closed"),
        *[end.alias(c) if c == "stop" else F.col(f"row.{c}") for c in cols],
    )


def first_within(tok: DataFrame, outer: tuple[str, Column], inner: tuple[str, Column]) -> DataFrame:
    """The first inner element of each outer element that has one; both as (tag, condition on nodes)."""
    w = Window.partitionBy("page_id", "outer").orderBy("start")
    found = inside(nodes(tok, [outer[0], inner[0]]), outer[1], inner[1])
    return found.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "rank", "text")


def concat_in_order(pos: Column, text: Column, sep: str = "") -> Column:
    """Aggregate: texts joined in ``pos`` order; rows with a NULL text are left out.

    A group must be a natural unit such as a page or a sentence.
    """
    pairs = F.collect_list(F.when(text.isNotNull(), F.struct(pos.alias("pos"), text.alias("text"))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["text"]), sep)


def text_of(tok: DataFrame, tag: str, **selector: str) -> DataFrame:
    """Plain text of each element, entities decoded: page_id, start, text."""
    n = nodes(tok, [tag], pieces=("text",))
    pieces = inside(n, is_element(tag, **selector), F.col("tag") == PIECE, include_self=True, keep_outer=True)
    return (
        pieces.groupBy("page_id", F.col("outer").alias("start"))
        .agg(concat_in_order(F.col("start"), F.col("text")).alias("text"))
        .withColumn("text", H.decode_entities("text"))
    )


def markup_pieces(tok: DataFrame) -> DataFrame:
    """Tokens with ``text`` as serialised markup: void tags closed, text escaped."""
    text = F.col("text")
    return tok.withColumn(
        "text",
        F.when(F.col("kind") == "text", H.reserialised("text"))
        .when(F.col("kind") == "tag", H.with_void_tags_closed(text))
        .otherwise(text),
    )


def markup_of(tok: DataFrame, tag: str, **selector: str) -> DataFrame:
    """Serialised markup of each element, entities kept: page_id, start, markup.

    Void tags are written ``<br/>`` and an element without an end tag gets one.
    """
    n = nodes(markup_pieces(tok), [tag], pieces=MARKUP)
    pieces = inside(n, is_element(tag, **selector), F.col("tag") == PIECE, include_self=True)
    joined = pieces.groupBy("page_id", F.col("outer").alias("start")).agg(
        concat_in_order(F.col("start"), F.col("text")).alias("markup"), F.bool_and("outer_closed").alias("closed")
    )
    end = F.when(F.col("closed"), "").otherwise(f"</{tag}>")
    return joined.select("page_id", "start", F.concat("markup", end).alias("markup"))

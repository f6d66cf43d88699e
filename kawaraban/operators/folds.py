"""HTML selection inside the row of a page: one fold over the page's tokens.

A page is one row, so what a selection needs never leaves it: the tokens become an
array, and an aggregate over it carries the state of the selection (depth of a tag,
what is open) and what was found so far.  Nothing is shuffled, sorted or windowed;
Spark fuses the fold with the scan, and tasks are cut by the page table's files.

Rules for where elements end are those of ``html.nodes``: tags pair by depth,
``p`` ends at the next block tag, ``li`` at the next item or the end of its list,
and the outermost of nested matches holds the inner ones.  Memory is that of one
page; a page's work grows with its tokens, and with the number of elements of a
selection squared where these are gathered in an array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from kawaraban.functions import html as H
from kawaraban.operators.html import BLOCK_TAGS, IMPLIED_END_TAGS, LIST_TAGS, tags_for


@dataclass(frozen=True)
class Wanted:
    """Elements of a tag, by a class token, the whole class text or the id."""

    tag: str
    class_: str | None = None
    class_exact: str | None = None
    el_id: str | None = None

    def starts_with(self, text: Column) -> Column:
        """Condition on the element's start tag."""
        cond = F.lit(True)
        if self.class_ is not None:
            cond &= F.array_contains(F.split(_value(text, "class"), r"\s+"), self.class_)
        if self.class_exact is not None:
            cond &= _value(text, "class") == self.class_exact
        if self.el_id is not None:
            cond &= _value(text, "id") == self.el_id
        return F.coalesce(cond, F.lit(False))


def _value(text: Column, name: str) -> Column:
    return H.decoded(H.attribute(text, name))


def _tokens(pages: DataFrame, key: str, html: str, tags: list[str] | None, texts: bool) -> DataFrame:
    """page_id and toks: array of (pos, text, tag, closing, plain) of the page.

    ``tags`` keeps only tokens of these tags, with plain text if ``texts`` says so;
    None keeps all.  ``tag`` is NULL for what is no tag.
    """
    cut = F.transform(
        H.tokens(F.col(html)),
        lambda t, i: F.struct(i.cast("int").alias("pos"), t.alias("text"), H.tag_name(t).alias("name")),
    )
    if tags is not None:
        cut = F.filter(cut, lambda x: (x["name"].isNull() & F.lit(texts)) | x["name"].isin(*tags))
    toks = F.transform(
        cut,
        lambda x: F.struct(
            x["pos"].alias("pos"),
            x["text"].alias("text"),
            F.when(H.kind(x["text"], x["name"]) == "tag", x["name"]).alias("tag"),
            x["text"].startswith("</").alias("closing"),
            x["name"].isNull().alias("plain"),
        ),
    )
    return pages.select(F.col(key).alias("page_id"), toks.alias("toks"))


def _is(x: Column, *tags: str) -> Column:
    return F.coalesce(x["tag"].isin(*tags), F.lit(False))


def _started(x: Column, tag: str) -> Column:
    return _is(x, tag) & ~x["closing"]


def _ended(x: Column, tag: str) -> Column:
    return _is(x, tag) & x["closing"]


def _depth(x: Column, depth: Column, tag: str) -> Column:
    """Depth after a token: of lists for ``li``, of the tag itself otherwise; ``p`` does not nest."""
    if tag == "p":
        return depth
    counted = _is(x, *LIST_TAGS) if tag == "li" else _is(x, tag)
    step = F.when(x["closing"], -1).when(H.self_closed(x["text"]), 0).otherwise(1)
    return depth + F.when(counted, step).otherwise(0)


def _alone(x: Column, tag: str) -> Column:
    """A start tag without content: of a void tag, or one that closes itself."""
    if tag in IMPLIED_END_TAGS:
        return F.lit(False)
    return F.lit(True) if tag in H.VOID_TAGS else H.self_closed(x["text"])


def _over(x: Column, depth: Column, level: Column, tag: str) -> tuple[Column, Column]:
    """Whether an element opened at ``level`` ends with this token, and whether it ended before it."""
    if tag == "p":
        return _ended(x, "p"), _is(x, *BLOCK_TAGS) & ~_ended(x, "p")
    if tag == "li":
        out_of_list = _is(x, *LIST_TAGS) & x["closing"] & (depth - 1 < level)
        return _ended(x, "li") & (depth == level), (_started(x, "li") & (depth == level)) | out_of_list
    return _ended(x, tag) & (depth - 1 < level), F.lit(False)


def _box(x: Column, acc: Column, wanted: Wanted) -> tuple[Column, Column, Column, Column]:
    """depth and level of the outermost matching element after a token, whether the token lies in one, and whether one starts.

    ``acc.level`` is NULL outside; an element that starts where another one ends is a new one.
    """
    tag, depth, level = wanted.tag, acc["depth"], acc["level"]
    with_, before = _over(x, depth, level, tag)
    held = level.isNotNull() & ~F.coalesce(before, F.lit(False))
    starts = ~held & _started(x, tag) & wanted.starts_with(x["text"])
    after = _depth(x, depth, tag)
    own = F.when(~_alone(x, tag), depth if tag == "li" else after)
    new = F.when(starts, own).when(held & ~F.coalesce(with_, F.lit(False)), level)
    return after, new, held | starts, starts


def _state(**fields: str) -> str:
    """A fold's first state as SQL, from fields by name; ``depth`` and ``level`` are those of ``_box``."""
    named = {"depth": "0", "level": "CAST(NULL AS int)"} | fields
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in named.items()) + ")"


def _folded(
    state: str, step: Callable[[Column, Column], dict[str, Column]], result: Callable[[Column], Column]
) -> Column:
    """The tokens folded from a state; ``step`` gives the next state's fields by name."""
    following = lambda acc, x: F.struct(*(v.alias(k) for k, v in step(acc, x).items()))
    return F.aggregate(F.col("toks"), F.expr(state), following, result)


def _markup(x: Column) -> Column:
    """A token as serialised markup: void tags closed, text escaped."""
    out = H.decoded(x["text"])
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(ref))
    escaped = F.when(x["text"].rlike("[&<>]"), out).otherwise(x["text"])
    return F.when(x["plain"], escaped).when(x["tag"].isNotNull(), H.with_void_tags_closed(x["text"])).otherwise(x["text"])


def paragraphs(pages: DataFrame, container: Wanted, key: str = "url", html: str = "html", markup: bool = False) -> DataFrame:
    """page_id, text: the text (entities as written) or markup of all paragraphs in all containers, in page order.

    Pages without a paragraph in a container are left out.
    """
    tags = None if markup else tags_for([container.tag, "p"])
    rows = _tokens(pages, key, html, tags, texts=True)

    def step(acc: Column, x: Column) -> dict[str, Column]:
        depth, level, held, _ = _box(x, acc, container)
        starts = held & _started(x, "p")
        within = starts | (held & acc["par"] & (~_is(x, *BLOCK_TAGS) | _ended(x, "p")))
        piece = _markup(x) if markup else x["text"]
        counts = within if markup else within & x["plain"]
        return {
            "depth": depth,
            "level": level,
            "par": level.isNotNull() & (starts | (acc["par"] & ~_is(x, *BLOCK_TAGS))),
            "found": acc["found"] | starts,
            "out": F.when(counts, F.concat(acc["out"], piece)).otherwise(acc["out"]),
        }

    out = _folded(_state(par="false", found="false", out="''"), step, lambda a: F.when(a["found"], a["out"]))
    return rows.select("page_id", out.alias("text")).where("text IS NOT NULL")


def body_markup(pages: DataFrame, container: Wanted, key: str = "url", html: str = "html") -> DataFrame:
    """page_id, markup: of every container the markup of its paragraphs, or all of it where it has none, in page order.

    Pages without a container are left out.
    """
    rows = _tokens(pages, key, html, None, texts=True)

    def body(a: Column) -> Column:
        return F.concat(a["out"], F.when(a["any"], a["pars"]).otherwise(a["all"]))

    def step(acc: Column, x: Column) -> dict[str, Column]:
        depth, level, held, new = _box(x, acc, container)
        starts = held & _started(x, "p")
        within = starts | (held & ~new & acc["par"] & (~_is(x, *BLOCK_TAGS) | _ended(x, "p")))
        piece = _markup(x)
        fresh = lambda name, empty: F.when(new, empty).otherwise(acc[name])
        return {
            "depth": depth,
            "level": level,
            "par": level.isNotNull() & (starts | (acc["par"] & ~_is(x, *BLOCK_TAGS))),
            "found": acc["found"] | new,
            "any": fresh("any", F.lit(False)) | starts,
            "pars": F.when(within, F.concat(fresh("pars", F.lit("")), piece)).otherwise(fresh("pars", F.lit(""))),
            "all": F.when(held, F.concat(fresh("all", F.lit("")), piece)).otherwise(fresh("all", F.lit(""))),
            "out": F.when(new, body(acc)).otherwise(acc["out"]),
        }

    state = _state(par="false", found="false", any="false", pars="''", all="''", out="''")
    out = _folded(state, step, lambda a: F.when(a["found"], body(a)))
    return rows.select("page_id", out.alias("markup")).where("markup IS NOT NULL")


def links(pages: DataFrame, container: Wanted, key: str = "url", html: str = "html") -> DataFrame:
    """Links inside the containers: page_id, pos, href."""
    rows = _tokens(pages, key, html, tags_for([container.tag, "a"]), texts=False)

    def step(acc: Column, x: Column) -> dict[str, Column]:
        depth, level, held, _ = _box(x, acc, container)
        link = F.array(F.struct(x["pos"].alias("pos"), H.attribute(x["text"], "href").alias("href")))
        return {"depth": depth, "level": level, "out": F.when(held & _started(x, "a"), F.concat(acc["out"], link)).otherwise(acc["out"])}

    state = _state(out="CAST(array() AS array<struct<pos:int,href:string>>)")
    found = _folded(state, step, lambda a: F.filter(a["out"], lambda y: y["href"].isNotNull()))
    return rows.select("page_id", F.inline(found)).withColumn("href", H.decode_entities("href"))


def contents(pages: DataFrame, wanted: Wanted, key: str = "page_id", html: str = "html", markup: bool = False) -> DataFrame:
    """Every matching element's own content: page_id, start, text or markup.

    Nested matches each have theirs.  Text has its entities decoded; markup
    has void tags closed, and an element without an end tag gets one.
    """
    tag = wanted.tag
    rows = _tokens(pages, key, html, None if markup else tags_for([tag]), texts=True)
    element = "array<struct<start:int,level:int,content:string>>"

    def step(acc: Column, x: Column) -> dict[str, Column]:
        depth = acc["depth"]
        piece = _markup(x) if markup else F.when(x["plain"], x["text"]).otherwise("")
        after = _depth(x, depth, tag)
        starts = _started(x, tag) & wanted.starts_with(x["text"])
        over = lambda e: _over(x, depth, e["level"], tag)
        longer = lambda e: F.struct(e["start"].alias("start"), e["level"].alias("level"), F.concat(e["content"], piece).alias("content"))
        left = F.filter(acc["open"], lambda e: ~(over(e)[0] | over(e)[1]))
        gone = F.filter(acc["open"], lambda e: over(e)[0] | over(e)[1])
        gone = F.transform(
            gone,
            lambda e: F.struct(e["start"].alias("start"), over(e)[0].alias("closed"), F.when(over(e)[0], F.concat(e["content"], piece)).otherwise(e["content"]).alias("content")),
        )
        new = F.struct(x["pos"].alias("start"), (depth if tag == "li" else after).cast("int").alias("level"), piece.alias("content"))
        alone = F.struct(x["pos"].alias("start"), F.lit(True).alias("closed"), piece.alias("content"))
        ends = _is(x, *tags_for([tag]))
        open_ = F.when(ends, F.transform(left, longer)).otherwise(F.transform(acc["open"], longer))
        return {
            "depth": after,
            "level": acc["level"],
            "open": F.when(starts & ~_alone(x, tag), F.concat(open_, F.array(new))).when(F.size(acc["open"]) > 0, open_).otherwise(acc["open"]),
            "done": F.when(starts & _alone(x, tag), F.concat(acc["done"], gone, F.array(alone))).when(ends & (F.size(acc["open"]) > 0), F.concat(acc["done"], gone)).otherwise(acc["done"]),
        }

    done = "array<struct<start:int,closed:boolean,content:string>>"
    state = _state(open=f"CAST(array() AS {element})", done=f"CAST(array() AS {done})")
    last = lambda a: F.concat(a["done"], F.transform(a["open"], lambda e: F.struct(e["start"].alias("start"), F.lit(False).alias("closed"), e["content"].alias("content"))))
    found = rows.select("page_id", F.inline(_folded(state, step, last)))
    if markup:
        return found.select("page_id", "start", F.concat("content", F.when(F.col("closed"), "").otherwise(f"</{tag}>")).alias("markup"))
    return found.select("page_id", "start", H.decode_entities("content").alias("text"))

"""Who did what to what, where: roles of already parsed sentences.

A sentence is one row that holds its phrases, so its roles are expressions over
that row: no exchange, no window, no join.  A parse stored phrase by phrase is
gathered first, by its only exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from kawaraban.functions import frames as C
from kawaraban.operators.phrases import gathered

ROLE_COLUMNS = ("ga", "wo", "ni", "verb", "loc")
_CASES = {"ga": C.GA, "wo": C.WO, "ni": C.NI}


def _feature(features: Column, name: str) -> Column:
    return F.try_element_at(features, F.lit(name))


def _last(phrases: Column, test: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(phrases, test), F.lit(-1))


def _before(pieces: Column, target: Column) -> Column:
    """Pieces, last one first, before the target text."""
    return F.concat(F.array_join(F.reverse(pieces), ""), target)


def _argument(phrase: Column) -> Column:
    """What a verbal phrase was done to or in, with its particle; '' for other phrases."""
    structure = _feature(F.try_element_at(phrase["tags"], F.lit(-1))["features"], C.ARGUMENT_FEATURE)
    argument = F.coalesce(
        F.concat(C.pred_arg(structure, C.NI), F.lit("に")),
        F.concat(C.pred_arg(structure, C.WO), F.lit("を")),
    )
    return F.coalesce(F.when(phrase["fstring"].contains(C.VERBAL_MARK), argument), F.lit(""))


def extract_roles(phrases: DataFrame) -> DataFrame:
    """roles(sent_id, ga, wo, ni, verb, loc) of a parse with one row per phrase."""
    return roles_of_sentences(gathered(phrases))


def roles_of_sentences(sentences: DataFrame) -> DataFrame:
    """roles(sent_id, ga, wo, ni, verb, loc) of (sent_id, phrases); '-' where a role is empty.

    Phrases stand in the order of their numbers.  The root phrase's case frame
    names the heads.  Each head is widened by the phrases that depend on it; a
    sentence without a frame has no roles at all.
    """
    phrases = F.col("phrases")

    # 1. The last phrase without a parent is the root; its first tag holds the frame.
    s = sentences.select("sent_id", "phrases", _last(phrases, lambda p: p["parent_id"] == -1).alias("root"))
    frame = _feature(F.get("root.tags", F.lit(0))["features"], C.FRAME_FEATURE)
    s = s.select("sent_id", "phrases", C.head_word(F.col("root.head_repname")).alias("verb"), frame.alias("frame"))
    s = s.withColumns({"slots": C.parse_slots(F.col("frame")), "predicate": C.predicate_word(F.col("frame"))})
    s = s.withColumns({f"{role}_slot": C.slot(F.col("slots"), case) for role, case in _CASES.items()})

    # 2. The phrase each head stands in: the last one with a tag of that number and text.
    def stands_in(role: str) -> Column:
        head, tag_id = F.col(f"{role}_slot.head"), F.col(f"{role}_slot.tag_id")
        hit = _last(phrases, lambda p: F.exists(p["tags"], lambda t: (t["tag_id"] == tag_id) & t["midasi"].contains(head)))
        return F.when((head != C.EMPTY) & tag_id.isNotNull(), hit)

    s = s.withColumns({role: stands_in(role) for role in _CASES})

    # 3. What depends on each of them.
    def children(phrase: Column) -> Column:
        return F.filter(phrases, lambda p: p["parent_id"] == phrase["bnst_id"])

    ga, wo, ni = F.col("ga"), F.col("wo"), F.col("ni")
    s = s.withColumns({f"{role}_kids": F.when(F.col(role).isNotNull(), children(F.col(role))) for role in _CASES})
    s = s.withColumn("ga_proper", C.has_proper_noun(ga["morphs"]))

    def with_first_child(kid: Column) -> Column:
        """A street block's own first child, before it."""
        first = F.get(children(kid), F.lit(0))["midasi"]
        block = _feature(kid["features"], C.COUNTER_FEATURE) == C.BLOCK_COUNTER
        return F.concat(F.coalesce(F.when(block, first), F.lit("")), kid["midasi"])

    ga_kids = F.filter("ga_kids", lambda k: ~F.col("ga_proper") | C.has_proper_noun(k["morphs"]))
    wo_parent = _last(phrases, lambda p: (p["bnst_id"] == wo["parent_id"]) & ~p["midasi"].contains(F.col("predicate")))
    wo_target = F.concat(
        C.repname_surface(wo["repname"]), F.coalesce(C.repname_surface(wo_parent["normalized_repname"]), F.lit(""))
    )
    places = F.filter(phrases, lambda p: p["fstring"].contains(C.PLACE_MARK))
    roles = {
        "ga": _before(F.transform(ga_kids, lambda k: k["midasi"]), C.repname_surface(ga["repname"])),
        "wo": _before(F.transform("wo_kids", lambda k: F.concat(_argument(k), k["midasi"])), wo_target),
        "ni": _before(F.transform("ni_kids", with_first_child), C.repname_surface(ni["repname"])),
        "verb": F.col("verb"),
        "loc": F.array_join(F.transform(places, lambda p: C.repname_surface(p["repname"])), ""),
    }
    parsed = F.col("frame").isNotNull()
    return s.select(
        "sent_id",
        *[F.coalesce(F.when(parsed, c), F.lit(C.EMPTY)).alias(name) for name, c in roles.items()],
    )

"""Case-frame and representative-form strings of an external parser."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
FRAME_FEATURE = "格解析結果"
ARGUMENT_FEATURE = "項構造"
COUNTER_FEATURE = "カウンタ"
BLOCK_COUNTER = "丁目"
PLACE_MARK = "地名"
VERBAL_MARK = "<用言:動>"
GA, WO, NI = "ガ", "ヲ", "ニ"
EMPTY = "-"
NOUN, PROPER, REGION = "名詞", "固有名詞", "地域"
# ----------------------------------------------------------------------------


def _piece(parts: Column, i: int) -> Column:
    return F.get(parts, F.lit(i))


def parse_slots(frame: Column) -> Column:
    """Slots of a frame, in order: array<struct<case, flag, head, tag_id>>.

    A slot reads ``CASE/flag/head/tag/...`` and slots stand after the last
    colon.  A tag that is no number gives NULL.
    """
    body = F.substring_index(frame, ":", -1)

    def slot(s: Column) -> Column:
        parts = F.split(s, "/")
        return F.struct(
            _piece(parts, 0).alias("case"),
            _piece(parts, 1).alias("flag"),
            _piece(parts, 2).alias("head"),
            safe_int(_piece(parts, 3)).alias("tag_id"),
        )

    return F.transform(F.split(body, ";"), slot)


def slot(slots: Column, case: str) -> Column:
    """The last slot of that case, or NULL."""
    return F.try_element_at(F.filter(slots, lambda s: s["case"] == case), F.lit(-1))


def predicate_word(frame: Column) -> Column:
    """Word a frame belongs to: up to the first colon, then the first slash."""
    return head_word(F.substring_index(frame, ":", 1))


def safe_int(c: Column) -> Column:
    return c.try_cast("int")


def repname_surface(c: Column) -> Column:
    """``a/x+b/y`` to ``ab``."""
    return F.array_join(F.transform(F.split(c, r"\+"), head_word), "")


def head_word(c: Column) -> Column:
    return F.substring_index(c, "/", 1)


def pred_arg(structure: Column, case: str) -> Column:
    """Text of the first argument of that case in ``word:type:CASE/flag/text/tag;...``."""
    third = F.get(F.split(structure, ":"), F.lit(2))
    hits = F.filter(F.split(third, ";"), lambda a: head_word(a) == case)
    return F.get(F.split(F.get(hits, F.lit(0)), "/"), F.lit(2))


def has_proper_noun(morphs: Column) -> Column:
    """Any proper noun that is not a place name; an unknown field is no such name."""
    found = F.exists(
        morphs,
        lambda m: m["pos"].eqNullSafe(NOUN) & m["pos1"].eqNullSafe(PROPER) & ~m["pos2"].eqNullSafe(REGION),
    )
    return F.coalesce(found, F.lit(False))

"""Parsed sentences as tables: one row per phrase, keyed by (sent_id, bnst_id),
or one row per sentence with its phrases in an array.

A sentence is a natural, small unit; nothing here gathers more than one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kawaraban.functions.frames import FRAME_FEATURE, PLACE_MARK, parse_slots, repname_surface
from kawaraban.operators.html import concat_in_order
from kawaraban.operators.rows import has_feature

PHRASE_SCHEMA = """
    sent_id string, bnst_id int, parent_id int, midasi string, repname string,
    normalized_repname string, head_repname string, fstring string,
    features map<string,string>,
    tags array<struct<tag_id:int, midasi:string, normalized_repname:string,
                      features:map<string,string>>>,
    morphs array<struct<surface:string, pos:string, pos1:string, pos2:string>>
"""


def gathered(phrases: DataFrame) -> DataFrame:
    """One row per sentence: sent_id, phrases in the order of their numbers.

    For a parse that is stored phrase by phrase: one exchange by ``sent_id``.
    """
    fields = [c for c in phrases.columns if c != "sent_id"]
    # The fields hold maps, which have no order of their own.
    by_number = lambda a, b: a["bnst_id"] - b["bnst_id"]
    return phrases.groupBy("sent_id").agg(F.array_sort(F.collect_list(F.struct(*fields)), by_number).alias("phrases"))


def slots_long(frames: DataFrame) -> DataFrame:
    """frames(sent_id, frame) to one row per slot: sent_id, ord, case, flag, head, tag_id."""
    return frames.select(
        "sent_id", F.posexplode(parse_slots(F.col("frame"))).alias("ord", "s")
    ).select("sent_id", "ord", "s.*")


def last_slots(slots: DataFrame) -> DataFrame:
    """One row per (sentence, case): the last slot of a case stands."""
    fields = F.struct("ord", "flag", "head", "tag_id")
    return (
        slots.groupBy("sent_id", "case").agg(F.max_by(fields, "ord").alias("s")).select("sent_id", "case", "s.*")
    )


def root_of(phrases: DataFrame) -> DataFrame:
    """The last phrase without a parent, and its frame: one row per sentence that has one."""
    fields = F.struct(
        "bnst_id", "midasi", "head_repname", frame_of().alias("frame")
    )
    return (
        phrases.where("parent_id = -1")
        .groupBy("sent_id")
        .agg(F.max_by(fields, "bnst_id").alias("r"))
        .select("sent_id", "r.*")
    )


def frame_of() -> Column:
    """The case frame on the first tag of a phrase, or NULL."""
    return F.try_element_at(F.get("tags", F.lit(0))["features"], F.lit(FRAME_FEATURE))


def match_head(slots: DataFrame, phrases: DataFrame) -> DataFrame:
    """Each slot with the phrase its head stands in.

    A phrase matches when one of its tags has the slot's tag number and its
    text contains the head; the last match stands.  Slots without one are left
    out.
    """
    tags = phrases.select(
        "sent_id", "bnst_id", "parent_id", "midasi", "repname", F.explode("tags").alias("t")
    ).select(
        "sent_id",
        F.col("t.tag_id").alias("tag_id"),
        F.col("t.midasi").alias("tag_text"),
        F.struct("bnst_id", "parent_id", "midasi", "repname").alias("phrase"),
    )
    return (
        slots.join(tags, ["sent_id", "tag_id"])
        .where(F.col("tag_text").contains(F.col("head")))
        .groupBy("sent_id", "ord", "case", "head", "tag_id")
        .agg(F.max_by("phrase", "phrase.bnst_id").alias("phrase"))
        .select("sent_id", "ord", "case", "head", "tag_id", "phrase.*")
    )


def children_of(targets: DataFrame, phrases: DataFrame) -> DataFrame:
    """Children of (sent_id, bnst_id) targets: sent_id, bnst_id, child_id, child."""
    kids = phrases.select(
        "sent_id",
        F.col("parent_id").alias("bnst_id"),
        F.col("bnst_id").alias("child_id"),
        F.col("midasi").alias("child"),
    )
    return targets.join(kids, ["sent_id", "bnst_id"])


def parent_of(targets: DataFrame, phrases: DataFrame) -> DataFrame:
    """Targets (with parent_id) and their parent's text; a root keeps NULL."""
    up = phrases.select(
        "sent_id", F.col("bnst_id").alias("parent_id"), F.col("midasi").alias("parent")
    )
    return targets.join(up, ["sent_id", "parent_id"], "left")


def concat_children(children: DataFrame, target: str, reverse: bool = True) -> DataFrame:
    """Children's texts joined before the target text, nearest child first read last.

    Each child is put in front of what is there already, so children come out
    in reverse order; ``reverse=False`` keeps document order.
    """
    at = -F.col("child_id") if reverse else F.col("child_id")
    return children.groupBy("sent_id", "bnst_id", target).agg(
        F.concat(concat_in_order(at, F.col("child")), F.col(target)).alias("text")
    )


def location_of(phrases: DataFrame) -> DataFrame:
    """Surfaces of all place phrases of a sentence, in order ('' where none)."""
    place = F.when(has_feature(PLACE_MARK), repname_surface(F.col("repname")))
    return phrases.groupBy("sent_id").agg(concat_in_order(F.col("bnst_id"), place).alias("loc"))

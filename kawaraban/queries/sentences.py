"""Case frames and parsed sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kawaraban.functions import frames as C
from kawaraban.operators import phrases as PH
from kawaraban.operators.joins import with_roles
from kawaraban.plans.roles import extract_roles, roles_of_sentences
from kawaraban.queries import fixtures as X
from kawaraban.queries.base import query, table, with_
from kawaraban.sources.tables import rebalanced

_PHRASES = [X.SQL_TURNS, *X.sql_phrases("turns")]

_SQL_SLOTS = """slots AS (
  SELECT event_id, sent_id, ord, string_split(s, '/')[1] AS "case", string_split(s, '/')[2] AS flag,
         string_split(s, '/')[3] AS head, TRY_CAST(string_split(s, '/')[4] AS BIGINT) AS tag_id
  FROM (SELECT event_id, sent_id, unnest(l) AS s, generate_subscripts(l, 1) - 1 AS ord
        FROM (SELECT event_id, sent_id, string_split(string_split(frame, ':')[-1], ';') AS l FROM d_frames)))"""


def _wide(df: DataFrame, *ints: str) -> DataFrame:
    """The given int columns as bigint."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in ints})


@query(with_([X.D_FRAMES, _SQL_SLOTS], 'SELECT sent_id, ord, "case", flag, head, tag_id FROM slots'))
def parse_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(PH.slots_long(X.d_frames(spark, sf_dir)), "ord", "tag_id")


@query(
    with_(
        [X.D_FRAMES, _SQL_SLOTS],
        'SELECT sent_id, "case", max(ord) AS ord, arg_max(flag, ord) AS flag, arg_max(head, ord) AS head, '
        'arg_max(coalesce(tag_id, -1), ord) AS tag_id FROM slots GROUP BY ALL',
    )
)
def slot_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = PH.last_slots(PH.slots_long(X.d_frames(spark, sf_dir)))
    return _wide(last, "ord", "tag_id").fillna({"tag_id": -1})


@query(with_(_PHRASES, "SELECT sent_id, i AS bnst_id, surface FROM ph"))
def repname_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    surface = C.repname_surface(F.col("repname")).alias("surface")
    return _wide(X.d_phrases(spark, sf_dir).select("sent_id", "bnst_id", surface), "bnst_id")


@query(
    with_(
        _PHRASES,
        "SELECT sent_id, i AS bnst_id, CASE WHEN flavour <> 1 THEN left(arg, length(arg) - 1) END AS ni, "
        "CASE WHEN flavour = 1 THEN left(arg, length(arg) - 1) END AS wo FROM ph WHERE verbal",
    )
)
def pred_arg(spark: SparkSession, sf_dir: str) -> DataFrame:
    structure = F.try_element_at(F.try_element_at("tags", F.lit(-1))["features"], F.lit(C.ARGUMENT_FEATURE))
    verbal = X.d_phrases(spark, sf_dir).where(F.col("fstring").contains(C.VERBAL_MARK))
    return _wide(
        verbal.select(
            "sent_id", "bnst_id", C.pred_arg(structure, C.NI).alias("ni"), C.pred_arg(structure, C.WO).alias("wo")
        ),
        "bnst_id",
    )


@query(
    with_(
        _PHRASES,
        "SELECT p.sent_id, n - 1 AS bnst_id, last_word AS midasi, framed FROM heads p",
    )
)
def root_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = PH.root_of(X.d_phrases(spark, sf_dir))
    return _wide(
        roots.select("sent_id", "bnst_id", "midasi", F.col("frame").isNotNull().alias("framed")), "bnst_id"
    )


@query(with_(_PHRASES, "SELECT sent_id, i AS bnst_id, proper FROM ph"))
def has_proper_noun(spark: SparkSession, sf_dir: str) -> DataFrame:
    proper = C.has_proper_noun(F.col("morphs")).alias("proper")
    return _wide(X.d_phrases(spark, sf_dir).select("sent_id", "bnst_id", proper), "bnst_id")


@query(
    with_(
        _PHRASES,
        "SELECT sent_id, coalesce(string_agg(surface, '' ORDER BY i) FILTER (place), '') AS loc FROM ph GROUP BY ALL",
    )
)
def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PH.location_of(X.d_phrases(spark, sf_dir))


def _slots(phrases: DataFrame) -> DataFrame:
    return PH.last_slots(PH.slots_long(PH.root_of(phrases)))


@query(
    with_(
        _PHRASES,
        """SELECT h.sent_id, r.role AS "case", p.i AS bnst_id, p.parent_id, p.word AS midasi
           FROM heads h
           JOIN (VALUES ('ガ'), ('ヲ'), ('ニ')) r(role) ON true
           JOIN ph p ON p.sent_id = h.sent_id AND p.i = CASE r.role WHEN 'ガ' THEN h.ga WHEN 'ヲ' THEN h.wo ELSE h.ni END
           WHERE framed""",
    )
)
def match_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = X.d_phrases(spark, sf_dir)
    found = PH.match_head(_slots(phrases), phrases)
    return _wide(found.select("sent_id", "case", "bnst_id", "parent_id", "midasi"), "bnst_id", "parent_id")


@query(
    with_(
        _PHRASES,
        """SELECT p.sent_id, p.i AS bnst_id, p.word AS midasi, c.i AS child_id, c.word AS child,
                  u.word AS parent
           FROM ph p JOIN ph c ON c.sent_id = p.sent_id AND c.parent_id = p.i
           LEFT JOIN ph u ON u.sent_id = p.sent_id AND u.i = p.parent_id""",
    )
)
def phrase_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every phrase that has children, with each child and with its parent."""
    phrases = X.d_phrases(spark, sf_dir)
    targets = PH.parent_of(phrases.select("sent_id", "bnst_id", "parent_id", "midasi"), phrases)
    return _wide(PH.children_of(targets, phrases).drop("parent_id"), "bnst_id", "child_id")


@query(
    with_(
        _PHRASES,
        """SELECT p.sent_id, p.i AS bnst_id, string_agg(c.word, '' ORDER BY c.i DESC) || p.word AS text
           FROM ph p JOIN ph c ON c.sent_id = p.sent_id AND c.parent_id = p.i GROUP BY p.sent_id, p.i, p.word""",
    )
)
def children_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = X.d_phrases(spark, sf_dir)
    children = PH.children_of(phrases.select("sent_id", "bnst_id", "midasi"), phrases)
    return _wide(PH.concat_children(children, "midasi").drop("midasi"), "bnst_id")


@query(with_([*_PHRASES, X.SQL_ROLES], "SELECT sent_id, ga, wo, ni, verb, loc FROM roles"))
def roles_tuple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles_of_sentences(X.d_sentences(spark, sf_dir))


def dealt(phrases: DataFrame) -> DataFrame:
    """Phrases by their numbers instead of their sentences; a number that too many have is split over tasks."""
    return rebalanced(phrases, "bnst_id")


@query(with_([*_PHRASES, X.SQL_ROLES], "SELECT sent_id, ga, wo, ni, verb, loc FROM roles"))
def roles_of_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a parse with one row per phrase, dealt out in any order."""
    return extract_roles(dealt(X.d_phrases(spark, sf_dir)))


@query(
    with_(
        [*_PHRASES, X.SQL_ROLES],
        """SELECT c.conv_id, c.turn, r.ga, r.verb FROM conversations c
           LEFT JOIN roles r ON r.sent_id = c.conv_id || '-' || (c.turn - c.turn % 2)""",
    )
)
def join_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two turns share the roles of the first one's sentence."""
    turn = F.col("turn") - F.col("turn") % 2
    articles = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", X.cat(F.col("conv_id"), "-", turn).alias("sent_id")
    )
    roles = roles_of_sentences(X.d_sentences(spark, sf_dir)).select("sent_id", "ga", "verb")
    return with_roles(articles, roles).drop("sent_id")

"""Personal data in texts, with DataFrame functions and Spark's boosted trees only.

Base spans are the valid matches of four fixed patterns, leftmost and without
overlap per kind. Beyond them, wide generators propose every run of characters
around an `@` and every long run of digits and separators, the latter as each of
the three kinds of numbers, so proposals overlap. Gradient-boosted trees score a
proposal by its format and context (not by the test that makes a base match
valid). They learn from all matches of the base patterns, valid or not; matches
with the same features are one row with their number as weight. (Spark's trees
choose the values they may split at from 10,000 of these rows or more, and then
count all rows.) Each match is also scored by trees that learned from the half of
the matches it is not in; over these scores of all matches, a threshold per kind
is set at the lowest score from which on at least PRECISION of the matches are
valid. A kind with fewer than LEAST matches gets none.
Proposals at or above their threshold are added, the best first, where they
touch no base span and no better proposal. Base spans always stay.

Defined results: null text is empty. Repeated rows are read one by one. Without
valid and invalid matches to learn from, nothing is added. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kawaraban.session import staged

PRECISION = 0.95
LEAST = 100

# The kinds in their order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# The same matches in a form that takes linear time and no stack on long runs: what
# cannot be given back is possessive, and a run is tried from its first character
# (or from the end of the match before it) only.
_MATCH = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PATTERNS["phone"],
}
_WIDE = {
    "address": r"(?<![^\x00-\x20@<>\"(),;:])[^\x00-\x20@<>\"(),;:]++@[^\x00-\x20@<>\"(),;:]++",
    "number": r"[+(]?[0-9](?:[\x20().+/-]{0,2}+[0-9]){6,}+",
}
_WORDS = ("mail", "@", "phone", "tel", "call", "card", "pay", "ip", "host", "version", "no", "id")


def _found(pattern: str, present: str, name: str, wide: bool) -> Column:
    """Matches of a pattern in `text`: what, wide, i, gap (characters since the match before), match, before, after."""
    pieces = F.split("text", pattern, -1)
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    both = F.arrays_zip(found.alias("m"), pieces.alias("p"), F.slice(pieces, 2, 2**31 - 1).alias("n"))

    def describe(z: Column, i: Column) -> Column:
        return F.struct(
            F.lit(name).alias("what"),
            F.lit(wide).alias("wide"),
            i.alias("i"),
            F.length(z["p"]).alias("gap"),
            z["m"].alias("match"),
            F.lower(F.right(z["p"], F.lit(24))).alias("before"),
            F.lower(F.left(z["n"], F.lit(12))).alias("after"),
        )

    matches = F.transform(F.filter(both, lambda z: z["m"].isNotNull()), describe)
    return F.when(F.expr(present), matches)


def proposals(docs: DataFrame) -> DataFrame:
    """All rows of documents with what the patterns and generators find: row, doc_id, found."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digit = "text RLIKE '[0-9]'"
    kinds = [_found(_MATCH[k], "contains(text, '@')" if k == "email" else "contains(text, '+')" if k == "phone" else digit, k, False) for k in KINDS]
    wide = [_found(p, "contains(text, '@')" if k == "address" else digit, k, True) for k, p in _WIDE.items()]
    return texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.flatten(F.array_compact(F.array(*kinds, *wide))).alias("found"))


def located(found: DataFrame) -> DataFrame:
    """One row per match, with start and end in code points, digits, and whether a base pattern's match is valid."""
    rows = found.select("row", F.explode("found").alias("f")).select("row", "f.*")
    order = Window.partitionBy("row", "what").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    rows = rows.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("end") - size)
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.length(digits)
    luhn = F.expr(
        """aggregate(transform(split(reverse(digits), ''), (c, i) -> CASE WHEN i % 2 = 0 THEN try_cast(c AS int)
             ELSE 2 * try_cast(c AS int) - CASE WHEN try_cast(c AS int) > 4 THEN 9 ELSE 0 END END),
             0, (s, x) -> s + coalesce(x, 0)) % 10 = 0"""
    )
    parts = F.expr("forall(split(match, '[.]'), p -> coalesce(length(ltrim('0', p)) < 4 AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255, false))")
    valid = (
        F.when(F.col("wide"), F.lit(False))
        .when(F.col("what") == "email", F.lit(True))
        .when(F.col("what") == "ip", parts)
        .when(F.col("what") == "card", F.when(F.col("n_digits").between(12, 19), luhn).otherwise(F.lit(False)))
        .otherwise(F.col("n_digits").between(9, 15))
    )
    return rows.withColumn("digits", digits).withColumn("n_digits", n).withColumn("valid", valid).drop("gap", "i")


def features(kind: Column) -> dict[str, Column]:
    """Format and context of a match proposed as a kind."""
    count = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    m = F.col("match")
    out = {f"is_{k}": (kind == k).cast("double") for k in KINDS}
    out |= {
        "chars": F.length(m),
        "n_digits": F.col("n_digits"),
        "letters": count(m, "[A-Za-z]"),
        "dots": count(m, "[.]"),
        "ats": count(m, "@"),
        "hyphens": count(m, "-"),
        "spaces": count(m, " "),
        "brackets": count(m, "[()]"),
        "plus": count(m, "[+]"),
        "groups": F.size(F.split(m, "[^0-9A-Za-z]+")),
        "kinds_of_digits": F.size(F.array_distinct(F.split("digits", ""))),
        "letter_before": F.col("before").rlike("[a-z]$").cast("double"),
        "digit_before": F.col("before").rlike("[0-9]$").cast("double"),
        "point_before": F.col("before").rlike("[.,:;=/#_-]$").cast("double"),
        "letter_after": F.col("after").rlike("^[a-z]").cast("double"),
        "digit_after": F.col("after").rlike("^[0-9]").cast("double"),
        "point_after": F.col("after").rlike("^[.,:;=/#_-]").cast("double"),
    }
    out |= {f"near_{i}": F.col("before").contains(w).cast("double") for i, w in enumerate(_WORDS)}
    return {k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in out.items()}


def _names() -> list[str]:
    return list(features(F.lit("")))


def _by_model(rows: DataFrame, model) -> DataFrame:
    """rows, which have the features, with score, the model's probability that the match is what `kind` says."""
    assembled = VectorAssembler(inputCols=_names(), outputCol="features").transform(rows)
    return model.transform(assembled).withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction", *_names())


def _fitted(rows: DataFrame):
    """Boosted trees from rows with features, label and weight; None if they are all valid or all invalid."""
    if rows.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=_names(), outputCol="features").transform(rows)
    trees = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=12, maxDepth=4, maxBins=32, seed=7, stepSize=0.3)
    return trees.fit(vectors.select("label", "weight", "features"))


def learn(matches: DataFrame):
    """(model, thresholds by kind) from all matches of the base patterns, or None if they, or those of a half, are all valid or all invalid."""
    labelled = matches.filter("NOT wide").withColumn("kind", F.col("what")).withColumn("label", F.col("valid").cast("double"))
    half = F.pmod(F.xxhash64("row", "what", "start"), F.lit(2)).alias("half")
    rows = labelled.select("kind", "label", half, *(c.alias(n) for n, c in features(F.col("kind")).items()))
    rows = staged(rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("weight")), "pii-learned")
    model = _fitted(rows)
    others = [_fitted(rows.filter(F.col("half") != h)) for h in (0, 1)] if model else [None]
    if None in others:
        return None
    held = _by_model(rows.filter("half = 0"), others[0]).unionByName(_by_model(rows.filter("half = 1"), others[1]))
    steps = held.groupBy("kind", F.floor(F.col("score") * 100).alias("step")).agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("valid"))
    found = steps.collect()  # at most 101 steps of each kind
    thresholds: dict[str, float] = {}
    for kind in KINDS:
        total = good = 0
        for r in sorted((r for r in found if r["kind"] == kind), key=lambda r: -r["step"]):
            total, good = total + r["n"], good + r["valid"]
            if total >= LEAST and good >= PRECISION * total:
                thresholds[kind] = r["step"] / 100
    return model, thresholds


def added(matches: DataFrame, model, thresholds: dict[str, float]) -> DataFrame:
    """Proposals the model accepts, best first without overlap: row, kind, start, end."""
    kinds = F.when(F.col("what") == "address", F.array(F.lit("email"))).otherwise(F.array(*(F.lit(k) for k in KINDS[1:])))
    rows = matches.filter("wide").withColumn("kind", F.explode(kinds))
    least = F.coalesce(*(F.when(F.col("kind") == k, F.lit(t)) for k, t in thresholds.items()), F.lit(2.0))
    rows = _by_model(rows.withColumns(features(F.col("kind"))), model).filter(F.col("score") >= least).select("row", "kind", "start", "end", "score")
    base = matches.filter("valid").select(F.col("row").alias("row"), F.struct("start", "end").alias("span")).groupBy("row").agg(F.collect_list("span").alias("base"))
    ranked = rows.groupBy("row").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("cost"), "start", "end", "kind"))).alias("all"))
    touches = "exists(done, d -> d.start < x.end AND x.start < d.end)"
    chosen = F.expr(
        f"""filter(aggregate(all, transform(coalesce(base, array()), b -> named_struct('start', b.start, 'end', b.end, 'kind', '')),
              (done, x) -> CASE WHEN {touches} THEN done
                                ELSE concat(done, array(named_struct('start', x.start, 'end', x.end, 'kind', x.kind))) END),
            d -> d.kind != '')"""
    )
    return ranked.join(base, "row", "left").select("row", F.explode(chosen).alias("x")).select("row", "x.kind", "x.start", "x.end")


def find(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, base and spans (arrays of start, kind number, kind, end in order)."""
    found = staged(proposals(docs), "pii")
    matches = staged(located(found), "pii-matches")
    spans = matches.filter("valid").select("row", F.col("what").alias("kind"), "start", "end", F.lit(True).alias("base"))
    learned = learn(matches)
    if learned and learned[1]:
        spans = spans.unionByName(added(matches, *learned).withColumn("base", F.lit(False)))
    number = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    one = F.struct("start", number.alias("number"), "kind", "end")
    grouped = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(one)).alias("spans"), F.sort_array(F.collect_list(F.when(F.col("base"), one))).alias("base")
    )
    none = F.expr("cast(array() AS array<struct<start: bigint, number: bigint, kind: string, end: bigint>>)")
    return found.select("row", "doc_id").join(grouped, "row", "left").select("doc_id", *(F.coalesce(c, none).alias(c) for c in ("base", "spans")))


def joined(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text of documents with distinct doc_ids, each span replaced by its kind in angle brackets.

    Overlapping spans of different kinds are replaced together, under the first one's kind.
    """
    parts = F.expr(
        """aggregate(spans, named_struct('at', cast(0 AS bigint), 'out', ''), (s, x) ->
             CASE WHEN x.start < s.at THEN named_struct('at', greatest(s.at, x.end), 'out', s.out)
                  ELSE named_struct('at', x.end, 'out', concat(s.out, substring(text, cast(s.at AS int) + 1, cast(x.start - s.at AS int)), '<', x.kind, '>')) END,
             s -> concat(s.out, substring(text, cast(s.at AS int) + 1)))"""
    )
    found = spans.select(F.col("doc_id").alias("_doc"), "spans")
    return docs.select("doc_id", "text").join(found, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select("doc_id", F.when(F.col("text").isNotNull(), F.coalesce(parts, "text")).alias("text"))

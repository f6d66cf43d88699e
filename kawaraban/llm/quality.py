"""Quality rules whose cutoffs are learned with a guarantee against false rejection.

A document is measured by shares in which higher is worse (RULES). A setting gives
every rule a cutoff of a fixed grid, or none. For every stratum (language; null is
a stratum of its own), the labelled documents are dealt by their text's hash into
two halves:

* The first half lines up settings from none to ever stricter ones: step by step,
  the rule whose next cutoff loses the fewest good documents there (of equals, the
  one that catches the most bad ones) takes it.
* The second half tests them in this order. A setting passes when the exact
  (Clopper-Pearson) upper bound of the share of good documents that any of its
  rules rejects is at most `risk`. The tests end at the first setting that fails,
  so those of one stratum need no correction among themselves; over the strata the
  error probability `error` is divided evenly (Bonferroni).

With probability 1 - error, no selected setting rejects more than `risk` of the good
documents of its stratum, by all its rules together. A text is one trial, however
many rows and labels it has. A stratum without a passing setting rejects nothing.

Defined results: null text has no words and fails the base rule. Documents
without a label, or with a null one, take no part in the tests; several labels
of a document, or of equal texts, count as their smallest. Repeated rows are judged
one by one. An empty table gives an empty result, empty labels give no cutoffs.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kawaraban.llm.words import Words, covered, mix, per_row, pieces, released, small_batches
from kawaraban.session import staged

#: The share of good documents of a stratum that its rules may reject, and the
#: probability that any stratum exceeds it.
RISK, ERROR = 0.01, 0.05
#: How much a lost good document weighs against a caught bad one, as shares.
LOSS = 10
#: Cutoffs from the loosest to the strictest; a document fails above its cutoff.
GRID = (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.015, 0.01, 0.005)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bytes", "n_marks", "n_upper")
RULES = ("symbol_share", "dup_line_share", "repeat_share", "mark_share", "upper_share")

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_MARKS = np.isin(np.arange(256), list(b"!?;:\"'()[]{}=+~^_/\\@`"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_SPACE = " \t\n\r\x0b\x0c"


def count_rows(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS of every text."""
    words = Words(texts)
    data, offsets = words.data, words.offsets
    out = {
        "n_words": words.counts,
        "word_chars": per_row(words.inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_row(_SYMBOLS[data], offsets),
        "n_bytes": np.diff(offsets),
        "n_marks": per_row(_MARKS[data], offsets),
        "n_upper": per_row(_UPPER[data], offsets),
    }
    key, at, row = words.windows(3)
    key = key ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    out["n_repeat_words"] = per_row(covered(len(words.starts), at[again], 3), words.bounds)
    n_lines, n_dup = [], []
    for text in texts.to_pylist():
        lines = [line for line in (text or "").split("\n") if line.strip(_SPACE)]
        n_lines.append(len(lines))
        n_dup.append(len(lines) - len(set(lines)))
    out["n_lines"], out["n_dup_lines"] = np.array(n_lines, np.int64), np.array(n_dup, np.int64)
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches):
        counts = count_rows(part.column("text"))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("lang"), part.column("text_key"), *(pa.array(counts[c], pa.int64()) for c in COUNTS)],
            ["doc_id", "lang", "text_key", *COUNTS],
        )


def measure(docs: DataFrame) -> DataFrame:
    """COUNTS and text_key, the text's hash, per row of documents (doc_id, text, lang)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "lang", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        released(_measure), f"doc_id {kind}, lang string, text_key long, " + ", ".join(f"{c} long" for c in COUNTS)
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def shares() -> list[Column]:
    """The columns of RULES from those of COUNTS."""
    over = lambda a, b: F.coalesce(F.col(a) / F.col(b), F.lit(0.0))
    return [
        over("n_symbols", "word_chars").alias("symbol_share"),
        over("n_dup_lines", "n_lines").alias("dup_line_share"),
        over("n_repeat_words", "n_words").alias("repeat_share"),
        over("n_marks", "word_chars").alias("mark_share"),
        over("n_upper", "word_chars").alias("upper_share"),
    ]


def at_most(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n trials of probability p."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(x - top) for x in logs))


def _level(share: str) -> Column:
    """Place in GRID of the loosest cutoff that a share exceeds, from 1; one past the end if none."""
    over = F.lit(len(GRID) + 1)
    for place, cutoff in reversed(list(enumerate(GRID, 1))):
        over = F.when(F.col(share) > cutoff, place).otherwise(over)
    return over


def _line_up(lost: dict[str, list[int]], caught: dict[str, list[int]]) -> list[tuple[str, int, int]]:
    """The order in which rules take their next cutoff: rule, place in GRID, loosest place that catches as much (0: none needed)."""
    taken = dict.fromkeys(RULES, 0)
    steps = []
    while any(n < len(GRID) for n in taken.values()):
        costs = []
        for i, (rule, n) in enumerate(taken.items()):
            if n < len(GRID):
                before = (lost[rule][n - 1], caught[rule][n - 1]) if n else (0, 0)
                costs.append((lost[rule][n] - before[0], before[1] - caught[rule][n], i, rule))
        rule = min(costs)[-1]
        taken[rule] += 1
        steps.append((rule, taken[rule], [0, *caught[rule]].index(caught[rule][taken[rule] - 1])))
    return steps


def fit(measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Selected cutoffs: lang, rule, cutoff, n_good, n_rejected, n_bad, n_caught.

    The counts are those of the tests, of the stratum's whole setting: at most
    n_rejected of n_good good documents are lost, n_caught of n_bad bad ones caught. Spark
    counts documents per stratum, rule and place in the grid, then per stratum and
    step; one row per stratum and one per step is all that is gathered anywhere.

    The upper bound of n good documents of which k are rejected is at most `risk`
    exactly when at most k of n rejections have a probability of at most the
    test's error. Of the settings that pass, the one with the largest gain in the
    first half (share of bad documents caught less LOSS times the share of good
    ones lost) is taken, the loosest among equals, and none if there is no gain.
    """
    graded = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality IS NOT NULL")
    rows = measured.filter(~base_failed()).join(graded, "doc_id").select("lang", "text_key", "quality", *shares())
    levels = [_level(r).alias(r) for r in RULES]
    trials = rows.groupBy("lang", "text_key", *RULES).agg(F.min("quality").alias("quality"))
    trials = trials.select("lang", (F.col("quality") == 1).alias("good"), (F.pmod(F.xxhash64("text_key"), F.lit(2)) == 0).alias("first"), *levels)
    trials = staged(trials, "quality-trials")
    at_least = lambda r, flag: F.array(*(F.sum((F.col(r) <= i).cast("long") * flag.cast("long")) for i in range(1, len(GRID) + 1)))
    counts = trials.filter("first").groupBy("lang").agg(
        *(at_least(r, F.col("good")).alias(f"{r}_lost") for r in RULES), *(at_least(r, ~F.col("good")).alias(f"{r}_caught") for r in RULES)
    )

    def line_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                steps = _line_up({r: row[f"{r}_lost"] for r in RULES}, {r: row[f"{r}_caught"] for r in RULES})
                # The step in which a rule reaches a level; what exceeds no cutoff is never reached.
                reached = {r: [len(steps) + 1] * (len(GRID) + 1) for r in RULES}
                for number, (rule, place, _) in enumerate(steps, 1):
                    reached[rule][place - 1] = number
                found.append({"lang": row["lang"], "steps": [f"{rule} {loosest}" for rule, _, loosest in steps], **reached})
            yield pa.RecordBatch.from_pylist(found, lines)

    lines = pa.schema([("lang", pa.string()), ("steps", pa.list_(pa.string())), *((r, pa.list_(pa.int32())) for r in RULES)])
    order = staged(counts.mapInArrow(line_up, "lang string, steps array<string>, " + ", ".join(f"{r} array<int>" for r in RULES)), "quality-steps")
    strata = max(1, order.count())
    named = order.select(F.col("lang").alias("stratum"), *(F.col(r).alias(f"{r}_steps") for r in RULES))
    joined = trials.join(named, trials["lang"].eqNullSafe(named["stratum"]))
    step = F.least(*(F.element_at(f"{r}_steps", F.col(r)) for r in RULES))
    told = joined.groupBy("lang", "first", step.alias("step")).agg(F.sum(F.col("good").cast("long")).alias("good"), F.count("*").alias("n"))
    told = told.groupBy("lang").agg(F.collect_list(F.struct("first", "step", "good", "n")).alias("told"))
    told = told.join(order.select(F.col("lang").alias("stratum"), "steps"), F.col("lang").eqNullSafe(F.col("stratum"))).select("lang", "steps", "told")
    schema = pa.schema([("lang", pa.string()), ("rule", pa.string()), ("cutoff", pa.float64()), *((c, pa.int64()) for c in ("n_good", "n_rejected", "n_bad", "n_caught"))])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                cut = {True: {}, False: {}}
                for t in row["told"]:
                    cut[t["first"]][t["step"]] = (t["good"], t["n"] - t["good"])
                total = {half: tuple(map(sum, zip(*x.values(), strict=True))) or (0, 0) for half, x in cut.items()}
                sums, best, taken = {True: (0, 0), False: (0, 0)}, 0.0, None
                for number in range(1, len(row["steps"]) + 1):
                    for half, x in cut.items():
                        good, bad = x.get(number, (0, 0))
                        sums[half] = sums[half][0] + good, sums[half][1] + bad
                    n, lost = total[False][0], sums[False][0]
                    if lost > risk * n or at_most(lost, n, risk) > error / strata:
                        break
                    gain = sums[True][1] / max(1, total[True][1]) - LOSS * sums[True][0] / max(1, total[True][0])
                    if gain > best:
                        best, taken = gain, (number, lost, sums[False][1])
                if taken:
                    number, lost, caught = taken
                    # Cutoffs that catch nothing more are left out: what they would reject stays.
                    places = {}
                    for rule, place in (x.split(" ") for x in row["steps"][:number]):
                        places[rule] = int(place)
                    found += [
                        {"lang": row["lang"], "rule": rule, "cutoff": GRID[place - 1], "n_good": total[False][0], "n_rejected": lost, "n_bad": total[False][1], "n_caught": caught}
                        for rule, place in places.items()
                        if place
                    ]
            yield pa.RecordBatch.from_pylist(found, schema)

    out = "lang string, rule string, cutoff double, n_good long, n_rejected long, n_bad long, n_caught long"
    return staged(told.mapInArrow(test, out), "quality-cutoffs")


def judge(measured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """base_failed and kept added to measured documents.

    The cutoffs are one row per stratum, written before, so Spark knows their
    size: it broadcasts them below its limit, else joins with skew handling.
    """
    wide = cutoffs.groupBy("lang").agg(*(F.min(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"max_{r}") for r in RULES))
    wide = staged(wide, "quality-rules").withColumnRenamed("lang", "stratum")
    rejected = F.lit(False)
    for share, r in zip(shares(), RULES, strict=True):
        rejected = rejected | F.coalesce(share > F.col(f"max_{r}"), F.lit(False))
    return (
        measured.join(wide, measured["lang"].eqNullSafe(wide["stratum"]), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & ~rejected)
        .drop("stratum", *(f"max_{r}" for r in RULES))
    )


def keep_good(docs: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """The rows of docs that pass the base rule and their stratum's cutoffs, all columns unchanged.

    The texts never leave their partition: the cutoffs of all strata (at most
    one row per language with enough labels, a few KB) travel to the tasks.
    """
    small_batches(docs.sparkSession)
    rules: dict[str | None, dict[str, float]] = {}
    for r in cutoffs.toLocalIterator():
        rules.setdefault(r["lang"], {})[r["rule"]] = r["cutoff"]
    by_share = {
        "symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"),
        "repeat_share": ("n_repeat_words", "n_words"), "mark_share": ("n_marks", "word_chars"), "upper_share": ("n_upper", "word_chars"),
    }

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            n = count_rows(part.column("text"))
            good = (n["n_words"] >= 50) & (100 * n["n_repeat_words"] <= 50 * n["n_words"])
            langs = part.column("lang").to_pylist()
            for rule, (a, b) in by_share.items():
                cutoff = np.array([rules.get(x, {}).get(rule, np.inf) for x in langs])
                good &= ~(n[a] / np.maximum(n[b], 1) > cutoff)
            yield part.filter(pa.array(good))

    return docs.mapInArrow(released(keep), docs.schema)

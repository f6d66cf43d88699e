"""Filters, set operations and aggregates over article rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from kawaraban.functions.dates import FIRST_YEAR, LAST_YEAR, year_of
from kawaraban.functions.links import BOILERPLATE_LINKS, VIDEO_MARK
from kawaraban.functions.text import word_tokens


def drop_matching_urls(df: DataFrame, substr: str = VIDEO_MARK, col: str = "url") -> DataFrame:
    return df.where(~F.col(col).contains(substr))


def non_empty(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) != "")


def exclude_links(df: DataFrame, hrefs: Sequence[str] = BOILERPLATE_LINKS, col: str = "href") -> DataFrame:
    return df.where(~F.col(col).isin(*hrefs))


def require(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


def title_contains_any(df: DataFrame, words: Sequence[str], col: str = "title") -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(col).contains(w) for w in words]))


def complete_only(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def by_year(df: DataFrame, lo: int = FIRST_YEAR, hi: int = LAST_YEAR, date: str = "date_raw") -> DataFrame:
    """Rows whose date text starts with a year in [lo, hi], with column ``year``."""
    years = [str(y) for y in range(lo, hi + 1)]
    return df.withColumn("year", year_of(F.col(date))).where(F.col("year").isin(*years))


def every_nth(arr: Column, n: int = 2) -> Column:
    """Elements 0, n, 2n, ... of an array."""
    return F.filter(arr, lambda _, i: i % n == 0)


def with_errors(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into good ones and rejected ones, the latter with a reason."""
    missing = F.array_join(
        F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])), ","
    )
    checked = df.withColumn("reason", missing)
    return checked.where("reason = ''").drop("reason"), checked.where("reason <> ''")


def has_feature(mark: str, col: str = "fstring") -> Column:
    return F.col(col).contains(mark)


def dedup(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def dedup_for(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Distinct rows of ``df``, reduced to the columns ``keep``.

    Two rows are the same when all columns are.  Columns that are not kept go
    through the shuffle as one SHA-256 digest instead of their text.
    """
    others = [c for c in df.columns if c not in keep]
    if not others:
        return dedup(df.select(*keep))
    digest = F.sha2(F.to_json(F.struct(*others)), 256)
    return df.select(*keep, digest.alias("_rest")).distinct().drop("_rest")


def token_histogram(
    df: DataFrame,
    by: str,
    text: str = "text",
    tokens: str | None = None,
    keep: str | None = None,
) -> DataFrame:
    """Token counts per ``by`` value: (by, token, n).

    ``tokens`` names an array column made by an external analyser: strings, or
    structs with ``surface`` and ``pos``, of which ``keep`` selects one part of
    speech.  Without it the text is split into words.  Counts are combined
    before the shuffle, so a common token sends one row per task.
    """
    words = F.col(tokens) if tokens else word_tokens(F.col(text))
    if keep is not None:
        words = F.transform(F.filter(words, lambda t: t["pos"] == keep), lambda t: t["surface"])
    return (
        df.select(by, F.explode(words).alias("token"))
        .groupBy(by, "token")
        .agg(F.count("*").alias("n"))
    )


def append_new(new: DataFrame, stored: DataFrame) -> DataFrame:
    """New rows, then stored ones; ``batch_ord`` carries that order."""
    return new.withColumn("batch_ord", F.lit(0).cast("bigint")).unionByName(
        stored.withColumn("batch_ord", F.lit(1).cast("bigint")), allowMissingColumns=True
    )


def order_by_doc(df: DataFrame, *position: str) -> DataFrame:
    """Document order, for an export that needs it."""
    return df.orderBy(*position)

"""Yearly token histogram of an article table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kawaraban.operators.rows import by_year, dedup_for, token_histogram


def yearly_histogram(
    articles: DataFrame, text: str = "summary", date: str = "date_raw", **tokens: str
) -> DataFrame:
    """Token counts per year of the distinct articles: year, token, n.

    One pass for all years; ``tokens`` goes to ``token_histogram``.
    """
    words = tokens.get("tokens", text)
    distinct = dedup_for(by_year(articles, date=date), ["year", words])
    return token_histogram(distinct, "year", text, **tokens)

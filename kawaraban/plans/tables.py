"""Headline, tech archive and property tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from kawaraban.functions.dates import heading_date
from kawaraban.functions.links import absolutise
from kawaraban.functions.text import drop_wide_paren, first_sentence, to_fullwidth
from kawaraban.operators.extract import (
    archive_details,
    archive_items,
    headline_items,
    japanese_body,
    property_items,
)
from kawaraban.operators.joins import attach_detail, pages_behind, unseen, with_roles
from kawaraban.operators.rows import append_new, with_errors
from kawaraban.plans.roles import ROLE_COLUMNS
from kawaraban.session import staged
from kawaraban.sources import profiles as P
from kawaraban.sources.pages import latest_pages
from kawaraban.sources.tables import PROPERTY_ROLE_COLUMNS

# Turns sentences(sent_id, sentence) into roles, by way of an external parser.
RolesOf = Callable[[DataFrame], DataFrame]


def headline_table(pages: DataFrame, listing_urls: DataFrame) -> DataFrame:
    """Headlines with their article text: Date, Summary, Link, Detail."""
    items = headline_items(latest_pages(pages_behind(pages, listing_urls))).withColumn(
        "url", absolutise(F.col("href"), P.JA_BASE)
    )
    items = staged(items, "headlines")
    bodies = japanese_body(latest_pages(pages_behind(pages, items.select("url")))).withColumnRenamed("page_id", "url")
    return attach_detail(items, bodies).select(
        F.col("time").alias("Date"),
        F.col("summary").alias("Summary"),
        F.col("url").alias("Link"),
        F.coalesce("text", F.lit("")).alias("Detail"),
    )


def archive_tables(pages: DataFrame, listing_urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tech archive, and the listed items without a complete article page, with a reason.

    Both have the columns Date, Title, Snippet, link, honbun.
    """
    items = archive_items(latest_pages(pages_behind(pages, listing_urls))).withColumn(
        "url", absolutise(F.col("href"), P.TECH_BASE)
    )
    items = staged(items, "archive")
    details = archive_details(latest_pages(pages_behind(pages, items.select("url")))).withColumnRenamed("page_id", "url")
    joined = attach_detail(items, details).select(
        F.col("time").alias("Date"),
        F.col("title").alias("Title"),
        F.col("snippet").alias("Snippet"),
        F.col("url").alias("link"),
        F.col("text").alias("honbun"),
    )
    return with_errors(joined, ["Date", "honbun"])


def archive_table(pages: DataFrame, listing_urls: DataFrame) -> DataFrame:
    """Tech archive: Date, Title, Snippet, link, honbun; items without an article page are left out."""
    return archive_tables(pages, listing_urls)[0]


def property_listing(pages: DataFrame, year: int, today: dt.date, incomplete: bool = False) -> DataFrame:
    """Property listing pages as rows: date_raw, title, summary, url and their place on the page."""
    return property_items(pages, incomplete=incomplete).select(
        "page_id",
        "sec",
        "kind",
        "pos",
        heading_date(F.col("heading"), year, today).alias("date_raw"),
        "title",
        "summary",
        absolutise(F.col("href"), P.PROPERTY_BASE).alias("url"),
    )


def property_tables(pages: DataFrame, year: int, today: dt.date) -> tuple[DataFrame, DataFrame]:
    """Listing rows of the newest copy of every page, and the rejected ones with a reason.

    A row is rejected when its heading is a day that the year lacks, or when its
    title, summary or address is missing.
    """
    listing = staged(property_listing(latest_pages(pages), year, today, incomplete=True), "listing")
    return with_errors(listing, ["date_raw", "title", "summary", "url"])


def first_of_each(listing: DataFrame) -> DataFrame:
    """One row per date and title: the first by page, section, kind and place."""
    place = F.struct("page_id", "sec", "kind", "pos", "url", "summary")
    first = listing.groupBy("date_raw", "title").agg(F.min(place).alias("_first"))
    return first.select("_first.page_id", "_first.sec", "_first.kind", "_first.pos", "date_raw", "title", "_first.summary", "_first.url")


def sentence(summary: Column) -> Column:
    """The sentence whose roles an article carries (new rows: already widened)."""
    return drop_wide_paren(first_sentence(summary))


def stored_sentence(summary: Column) -> Column:
    """The same for stored rows: the first sentence is cut off, then widened."""
    return drop_wide_paren(to_fullwidth(first_sentence(summary)))


def sentence_key(text: Column) -> Column:
    """Content key of a sentence, under which its parse is kept."""
    return F.md5(text)


def with_sentences(articles: DataFrame, text: Column) -> DataFrame:
    """Articles with the sentence to analyse and its key."""
    return articles.withColumn("sentence", text).withColumn("sent_id", sentence_key(F.col("sentence")))


def property_rows(keyed: DataFrame, roles: DataFrame) -> DataFrame:
    """Keyed articles as stored rows, with the five role columns of their sentence."""
    named = roles.select(
        "sent_id", *[F.col(a).alias(b) for a, b in zip(ROLE_COLUMNS, PROPERTY_ROLE_COLUMNS)]
    )
    joined = with_roles(keyed.drop("sentence"), named)
    return joined.select(
        F.col("date_raw").alias("Date"),
        F.col("title").alias("Title"),
        F.col("summary").alias("Summary"),
        F.col("url").alias("Link"),
        *[F.coalesce(c, F.lit("-")).alias(c) for c in PROPERTY_ROLE_COLUMNS],
    )


def unseen_articles(listing: DataFrame, stored: DataFrame, rule: str = "pair") -> DataFrame:
    """Listing rows not stored yet, with their sentences; staged, since several steps read them.

    ``listing`` should be a stored table.
    """
    keys = stored.select(F.col("Date").alias("date_raw"), F.col("Title").alias("title"))
    return staged(with_sentences(unseen(listing, keys, rule), sentence(F.col("summary"))), "unseen")


def analysed(unseen_rows: DataFrame, roles_of: RolesOf) -> DataFrame:
    """Unseen articles as stored rows.

    ``roles_of`` turns sentences(sent_id, sentence) into roles; it is given
    each distinct sentence once.
    """
    return property_rows(unseen_rows, roles_of(unseen_rows.select("sent_id", "sentence").distinct()))


def incremental_table(
    listing: DataFrame, stored: DataFrame, roles_of: RolesOf, rule: str = "pair"
) -> DataFrame:
    """New listing rows with roles, before the stored rows (``batch_ord`` 0 and 1)."""
    return append_new(analysed(unseen_articles(listing, stored, rule), roles_of), stored)


def reanalysed(stored: DataFrame, roles_of: RolesOf) -> DataFrame:
    """All stored rows with their roles made anew from their sentences."""
    articles = stored.select(
        F.col("Date").alias("date_raw"),
        F.col("Title").alias("title"),
        F.col("Summary").alias("summary"),
        F.col("Link").alias("url"),
    )
    keyed = with_sentences(articles, stored_sentence(F.col("summary")))
    roles = roles_of(keyed.select("sent_id", "sentence").distinct())
    return property_rows(keyed, roles)

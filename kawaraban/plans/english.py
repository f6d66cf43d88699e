"""English daily corpus: follow year, day and article pages; refresh incomplete days."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kawaraban.functions.dates import day_key
from kawaraban.functions.links import absolutise
from kawaraban.operators.extract import english_body, links_in
from kawaraban.operators.joins import (
    attach_detail,
    days_to_refresh,
    listing_counts,
    pages_behind,
)
from kawaraban.operators.rows import drop_matching_urls, exclude_links, non_empty
from kawaraban.session import staged
from kawaraban.sources import profiles as P
from kawaraban.sources.pages import latest_pages


def day_pages(pages: DataFrame, years: DataFrame) -> DataFrame:
    """Day pages linked from the year pages: url, day."""
    links = links_in(latest_pages(pages_behind(pages, years)), P.Selector("p"))
    return (
        exclude_links(links)
        .select(absolutise(F.col("href"), P.EN_BASE).alias("url"))
        .distinct()
        .withColumn("day", day_key(F.col("url")))
    )


def day_listing(pages: DataFrame, days: DataFrame) -> DataFrame:
    """Article links of each day: day, pos, href."""
    links = links_in(latest_pages(pages_behind(pages, days)), P.EN_DAY)
    return links.withColumnRenamed("page_id", "url").join(days, "url").select("day", "pos", "href")


def archive_listing(pages: DataFrame, years: DataFrame) -> DataFrame:
    """Article links of all days below the year pages: day, pos, href.

    The days and the links are staged: they are small next to the pages and
    steer what is read next.
    """
    days = staged(day_pages(pages, years), "days")
    return staged(day_listing(pages, days), "listing")


def due_days(listing: DataFrame, stored: DataFrame, slack: int = 10) -> DataFrame:
    """Days that need a refresh: day.  ``stored(day, stored_lines)`` says what is there."""
    return staged(days_to_refresh(listing_counts(listing), stored, slack).select("day"), "due")


def articles_of(pages: DataFrame, listing: DataFrame, days: DataFrame) -> DataFrame:
    """Articles of these days: day, pos, url, text.  Only their pages are parsed."""
    wanted = drop_matching_urls(listing.withColumnRenamed("href", "url").join(days, "day", "left_semi"))
    wanted = staged(wanted, "wanted")
    bodies = english_body(latest_pages(pages_behind(pages, wanted))).withColumnRenamed("page_id", "url")
    return non_empty(attach_detail(wanted, bodies), "text").select("day", "pos", "url", "text")


def due_articles(pages: DataFrame, listing: DataFrame, stored: DataFrame, slack: int = 10) -> DataFrame:
    """Articles of all days that need a refresh: day, pos, url, text."""
    return articles_of(pages, listing, due_days(listing, stored, slack))


def daily_corpus(pages: DataFrame, years: DataFrame, stored: DataFrame, slack: int = 10) -> DataFrame:
    """From the archive's year pages(url) to the articles of all days behind."""
    return due_articles(pages, archive_listing(pages, years), stored, slack)

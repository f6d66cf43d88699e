"""Jobs that bring stored tables up to date.  Running one again changes nothing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from kawaraban.operators.joins import stored_counts
from kawaraban.plans.english import archive_listing, articles_of, due_days
from kawaraban.plans.histogram import yearly_histogram
from kawaraban.plans.tables import (
    RolesOf,
    analysed,
    first_of_each,
    property_tables,
    reanalysed,
    unseen_articles,
)
from kawaraban.session import staged
from kawaraban.sources.tables import (
    PROPERTY_COLUMNS,
    PROPERTY_ROLE_COLUMNS,
    add_counts,
    append_articles,
    of_days,
    read_articles,
    read_daily,
    read_day_counts,
    with_days,
    write_articles,
    write_by_year,
    write_daily,
    write_day_counts,
)

#: The property table is kept in folders by the day of its rows; the date as text stays a column.
PROPERTY_STORED = (*PROPERTY_COLUMNS, *PROPERTY_ROLE_COLUMNS)
PROPERTY_SCHEMA = ", ".join(f"`{c}` string" for c in PROPERTY_STORED) + ", day date"


def refresh_daily_corpus(
    spark: SparkSession,
    path: str,
    pages: DataFrame,
    years: DataFrame,
    slack: int = 10,
    fmt: str = "text",
) -> None:
    """Fetch the days that are missing or behind and replace their articles.

    The number of articles of every refreshed day is kept, 0 too, so a day whose
    pages are missing is not fetched for ever; stored texts are only counted
    where a table has no such numbers yet.
    """
    listing = archive_listing(pages, years)
    stored = read_day_counts(spark, path)
    if stored is None:
        daily = read_daily(spark, path, fmt)
        stored = spark.createDataFrame([], "day string, stored_lines bigint") if daily is None else stored_counts(daily)
    # Read before the folders are written to.
    stored = staged(stored.join(listing.select("day").distinct(), "day", "left_semi"), "stored")
    days = due_days(listing, stored, slack)
    articles = staged(articles_of(pages, listing, days), "articles")
    counts = days.join(stored_counts(articles), "day", "left").select("day", F.coalesce("stored_lines", F.lit(0)).alias("stored_lines"))
    write_daily(articles, path, fmt=fmt)
    write_day_counts(counts, path)


def refresh_property_table(
    spark: SparkSession,
    path: str,
    pages: DataFrame,
    year: int,
    today: dt.date,
    roles_of: RolesOf,
    rule: str = "pair",
) -> bool:
    """Add unseen listing rows, with roles, to the stored table; rejected ones go to ``<path>-rejected``.

    Of several copies of a page the newest is read, and of several rows of one
    date and title the first is taken, so the result does not depend on how the
    pages are dealt out over runs.  Only new rows are analysed and written, and
    under the rule ``pair`` only the stored days that the listing names are read
    (and rows whose date names no day).  A run that failed is run again: what it
    has stored is seen then.  Returns False where there is nothing new.
    """
    listing, rejected = property_tables(pages, year, today)
    save_rejected(rejected, f"{path}-rejected", today)
    return add_listed(listing, path, roles_of, rule)


def add_listed(listing: DataFrame, path: str, roles_of: RolesOf, rule: str = "pair") -> bool:
    """Add the listing rows that the stored table lacks, with roles.  Returns False where there are none."""
    spark = listing.sparkSession
    stored = read_articles(spark, path, PROPERTY_SCHEMA)
    listing = staged(first_of_each(listing), "listed")
    if stored is None:
        stored = spark.createDataFrame([], PROPERTY_SCHEMA)
    elif rule == "pair":
        stored = of_days(stored, staged(with_days(listing, "date_raw").select("day").distinct(), "days"))
    new = unseen_articles(listing, stored, rule)
    if new.isEmpty():
        return False
    append_articles(with_days(analysed(new, roles_of)), path, PROPERTY_STORED, by="day")
    return True


def save_rejected(rejected: DataFrame, path: str, today: dt.date) -> None:
    """Keep rejected rows under the day they were ``seen``, each once a day, whichever copy of its page it is from.

    Only what was rejected the same day is read.
    """
    spark = rejected.sparkSession
    new = rejected.drop("page_id").distinct().withColumn("seen", F.lit(today))
    known = read_articles(spark, path)
    if known is not None:
        new = new.subtract(known.where(F.col("seen") == F.lit(today)).select(*new.columns))
    new = staged(new, "rejected")
    if not new.isEmpty():
        append_articles(new, path, by="seen")


def redo_property_table(spark: SparkSession, path: str, roles_of: RolesOf) -> bool:
    """Analyse all stored rows again, after the role rules changed, and replace their days.

    Returns False where there is no table.
    """
    stored = read_articles(spark, path, PROPERTY_SCHEMA)
    if stored is None:
        return False
    write_articles(with_days(reanalysed(stored, roles_of)), path, PROPERTY_STORED, by="day")
    return True


def compact_property_days(spark: SparkSession, path: str, days: DataFrame) -> None:
    """Write the given days (day) anew, in few files, after many runs added to them."""
    stored = read_articles(spark, path, PROPERTY_SCHEMA)
    if stored is not None:
        of = stored.join(days.where("day IS NOT NULL").select("day").distinct(), "day", "left_semi")
        write_articles(of, path, PROPERTY_STORED, by="day")


def add_to_histogram(articles: DataFrame, path: str, batch: str, text: str = "Snippet", date: str = "Date", **tokens: str) -> None:
    """Add a batch of new articles to the stored yearly histogram; only the batch is read.

    Articles must be new: a duplicate counts once within its batch, as in the
    whole histogram, but would count again in another batch.
    """
    add_counts(yearly_histogram(articles, text, date, **tokens), path, batch)


def save_histogram(articles: DataFrame, path: str, text: str = "Snippet", date: str = "Date", **tokens: str) -> None:
    """Yearly token histogram of a stored article table, one folder per year."""
    write_by_year(yearly_histogram(articles, text, date, **tokens), path)

"""Joins that keep article tables current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kawaraban.functions.links import BOILERPLATE_LINKS, absolutise
from kawaraban.operators import joins as J
from kawaraban.operators.extract import archive_details, links_in
from kawaraban.operators.joins import pages_behind
from kawaraban.operators.rows import append_new as put_first
from kawaraban.plans.english import day_pages
from kawaraban.queries import fixtures as X
from kawaraban.queries.base import q, query, with_
from kawaraban.session import staged
from kawaraban.sources import profiles as P


@query(
    with_(
        [X.D_HOPS],
        "SELECT year_url AS url_0, day_url AS url_1, href AS url_2 FROM d_hops",
    )
)
def link_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year pages to day pages to articles: two hops over one link table, for which only these pages are read."""
    pages, years = X.stored_site(spark, sf_dir, X.d_hops), X.year_seeds(spark, sf_dir)
    listed = day_pages(pages, years).select("url")
    listed = links_in(pages_behind(pages, years), P.Selector("p")).unionByName(links_in(pages_behind(pages, listed), P.EN_DAY))
    links = listed.where(~F.col("href").isin(*BOILERPLATE_LINKS)).select(
        F.col("page_id").alias("url"), "pos", absolutise(F.col("href"), P.EN_BASE).alias("href")
    )
    links = staged(links, "links")
    return J.expand_links(years, links, 2).select("url_0", "url_1", "url_2")


@query(
    with_(
        [X.D_ARTICLES],
        f"""SELECT doc_id, {q(P.TECH_BASE)} || url AS url, title, regexp_replace(date_raw, ' .*', '') || ' 6:30' AS time,
                   replace(body, chr(10), '') AS text
            FROM d_articles""",
    )
)
def listing_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows with time and text of their article page."""
    listing = X.d_articles(spark, sf_dir).select(
        "doc_id", absolutise(F.col("url"), P.TECH_BASE).alias("url"), "title"
    )
    details = archive_details(X.stored_site(spark, sf_dir, X.d_detail)).withColumnRenamed("page_id", "url")
    return J.attach_detail(listing, details)


def _new_and_stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    new = X.d_articles(spark, sf_dir).select("doc_id", "date_raw", "title")
    return new, X.d_stored(spark, sf_dir)


@query(
    with_(
        [X.D_ARTICLES, X.D_STORED],
        "SELECT doc_id, date_raw, title FROM d_articles a WHERE NOT EXISTS (SELECT 1 FROM d_stored s "
        "WHERE s.date_raw = a.date_raw AND s.title = a.title)",
    )
)
def unseen_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.unseen(*_new_and_stored(spark, sf_dir))


@query(
    with_(
        [X.D_ARTICLES, X.D_STORED],
        "SELECT doc_id, date_raw, title FROM d_articles WHERE NOT "
        "(date_raw IN (SELECT date_raw FROM d_stored) AND title IN (SELECT title FROM d_stored))",
    )
)
def unseen_independent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.unseen(*_new_and_stored(spark, sf_dir), rule="independent")


@query(
    with_(
        [X.D_ARTICLES, X.D_STORED],
        """SELECT date_raw, title, summary, 0 AS batch_ord FROM d_articles a WHERE NOT EXISTS
             (SELECT 1 FROM d_stored s WHERE s.date_raw = a.date_raw AND s.title = a.title)
           UNION ALL SELECT date_raw, title, NULL, 1 FROM d_stored""",
    )
)
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unseen rows before the stored ones, which lack the summary."""
    new = X.d_articles(spark, sf_dir).select("date_raw", "title", "summary")
    stored = X.d_stored(spark, sf_dir)
    return put_first(J.unseen(new, stored), stored)


@query(
    with_(
        [X.D_DAYS],
        """SELECT day, listed, video, CASE WHEN kept > 0 THEN kept END AS stored_lines,
                  CASE WHEN kept > 0 THEN listed - video - kept END AS missing
           FROM d_days WHERE kept = 0 OR listed - video - kept >= 10""",
    )
)
def days_to_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = J.listing_counts(X.day_links(spark, sf_dir))
    return J.days_to_refresh(listed, J.stored_counts(X.day_stored(spark, sf_dir)))


@query(
    """SELECT doc_id, i - 1 AS ord, lines[i] AS line, words[i] AS word
       FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, string_split(text, ' ') AS words FROM documents),
            unnest(range(1, least(len(lines), len(words)) + 1)) AS t(i)"""
)
def zip_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and words of each document, paired as far as the shorter list reaches."""
    lists = X.documents(spark, sf_dir).select(
        "doc_id", F.split("text", "\n").alias("lines"), F.split("text", " ").alias("words")
    )
    zipped = J.zip_lists(lists, ["lines", "words"], ["line", "word"])
    return zipped.withColumn("ord", F.col("ord").cast("bigint"))

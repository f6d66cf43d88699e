"""Stored pages and archive URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kawaraban.operators.joins import bucket_column, pages_behind, url_bucket
from kawaraban.sources.tables import rebalanced

#: Buckets of a stored page table; a large one should have some thousands.
BUCKETS = 64


def page_source(spark: SparkSession, path: str) -> DataFrame:
    """pages(page_id, url, html), one row per URL, and the bucket column of a table kept in buckets."""
    pages = spark.read.parquet(path)
    bucket = bucket_column(pages)
    return pages.select("page_id", "url", "html", *([bucket[0]] if bucket else []))


def write_pages(pages: DataFrame, path: str, buckets: int = BUCKETS, mode: str = "append") -> None:
    """Store pages in folders by a hash of their URL, so that looking up a few URLs reads a few folders.

    The column ``bucket<buckets>`` names the layout; give one table one number of buckets.
    """
    name = f"bucket{buckets}"
    keyed = pages.select("page_id", "url", "html").withColumn(name, F.coalesce(url_bucket(F.col("url"), buckets), F.lit(0)))
    rebalanced(keyed, name).write.mode(mode).partitionBy(name).parquet(path)


def latest_pages(pages: DataFrame) -> DataFrame:
    """One row per URL where a page was stored several times: the highest page_id.

    The newest id per URL is found on the two key columns alone; markup is
    joined in by both afterwards.
    """
    newest = pages.groupBy("url").agg(F.max("page_id").alias("_newest")).select(F.col("_newest"), F.col("url").alias("_url"))
    return pages.join(newest, (pages["page_id"] == newest["_newest"]) & (pages["url"] == newest["_url"]), "left_semi")


def read_pages(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """urls with the page behind each: html ('' where unreadable) and ``fetched``.

    Each wanted URL is looked up once, however often it is asked for.  Pages
    nobody asks for are dropped first, so a short list shuffles little markup.
    """
    found = pages_behind(pages, urls).select("url", "html").withColumn("_found", F.lit(True))
    return (
        urls.select("url")
        .distinct()
        .join(found, "url", "left")
        .select(
            "url",
            F.coalesce("html", F.lit("")).alias("html"),
            F.coalesce("_found", F.lit(False)).alias("fetched"),
        )
    )


def archive_urls(spark: SparkSession, template: str, lo: int, hi: int) -> DataFrame:
    """Archive pages ``lo`` to ``hi - 1``: page, url.  ``template`` holds one ``%d``."""
    return spark.range(lo, hi).select(
        F.col("id").alias("page"), F.format_string(template, F.col("id")).alias("url")
    )

"""Joins between article tables, pages and stored tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kawaraban.functions.links import VIDEO_PREFIX
from kawaraban.session import staged


def url_bucket(url: Column, buckets: int) -> Column:
    """The bucket of a page table in which a URL is kept."""
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def bucket_column(pages: DataFrame) -> tuple[str, int] | None:
    """Name of a page table's bucket column, which tells their number, and the number; None for a plain table."""
    found = [re.fullmatch(r"bucket([0-9]+)", c) for c in pages.columns]
    return next(((m.group(0), int(m.group(1))) for m in found if m), None)


def pages_behind(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """Only the pages whose URL is asked for, each once.

    A short URL list is broadcast by its size, and then no markup is shuffled.
    Of a table kept in buckets (``sources.pages.write_pages``) only the buckets
    of these URLs are read then: the join has the bucket among its keys, and
    Spark prunes partitions by the broadcast list.
    """
    wanted = urls.select(F.col("url").alias("_url")).distinct()
    same = pages["url"] == F.col("_url")
    bucket = bucket_column(pages)
    if bucket:
        name, n = bucket
        # Holds for every URL; Spark prunes only by a side that has a condition.
        wanted = wanted.where("_url >= ''").withColumn("_bucket", url_bucket(F.col("_url"), n))
        same &= pages[name] == F.col("_bucket")
        return pages.join(wanted, same, "left_semi").drop(name)
    return pages.join(wanted, same, "left_semi")


def expand_links(seed: DataFrame, links: DataFrame, hops: int) -> DataFrame:
    """Follow links from seed URLs: ``hops`` equi-joins, one per level.

    ``seed(url)`` and ``links(url, pos, href)``; a link is followed by reading
    the page whose URL it names.  Returns one row per path
    with columns ``url_0`` ... ``url_<hops>`` and the position ``pos_1`` ... of
    each link.
    """
    out = seed.select(F.col("url").alias("url_0"))
    for hop in range(1, hops + 1):
        here, there = f"url_{hop - 1}", f"url_{hop}"
        step = links.select(F.col("url").alias(here), F.col("pos").alias(f"pos_{hop}"), F.col("href").alias(there))
        out = out.join(step, here)
    return out


def attach_detail(listing: DataFrame, details: DataFrame, on: str = "url") -> DataFrame:
    """Listing rows with the fields of their detail page.

    ``details`` holds fields already extracted, one row per URL, so each detail
    page is read once however many rows link to it; Spark splits the rows of a
    page very many link to.  A listing row whose page is missing keeps NULL fields.
    """
    return listing.join(details, on, "left")


def _stored_keys(stored: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct stored keys that occur in ``new``, as columns ``_0``, ``_1`` ...; NULL equals NULL.

    A small batch of new keys is broadcast by its size, so that the stored
    table is only scanned for its key columns and not shuffled.
    """
    names = [f"_{i}" for i in range(len(on))]
    keys = new.select(*[F.col(c).alias(f"_new{n}") for c, n in zip(on, names)]).distinct()
    found = stored.select(*[F.col(c).alias(n) for c, n in zip(on, names)])
    same = [found[n].eqNullSafe(keys[f"_new{n}"]) for n in names]
    return found.join(keys, same, "left_semi").distinct()


def unseen(
    new: DataFrame, stored: DataFrame, rule: str = "pair", date: str = "date_raw", title: str = "title"
) -> DataFrame:
    """Rows of ``new`` not stored yet; a NULL date or title equals a NULL one.

    ``pair`` drops a row whose (date, title) is stored.  ``independent`` drops
    it when its date and its title are each stored, even on different rows.
    ``new`` should be a stored table: its keys are read several times.
    """
    if rule == "pair":
        keys = _stored_keys(stored, new, [date, title])
        return new.join(keys, [new[date].eqNullSafe(keys["_0"]), new[title].eqNullSafe(keys["_1"])], "left_anti")
    if rule != "independent":
        raise ValueError(f"unknown rule: {rule}")
    both = new
    for column in (date, title):
        keys = _stored_keys(stored, new, [column]).select("_0", F.lit(True).alias(f"_{column}_seen"))
        both = both.join(keys, both[column].eqNullSafe(keys["_0"]), "left").drop("_0")
    seen = F.coalesce(F.col(f"_{date}_seen") & F.col(f"_{title}_seen"), F.lit(False))
    return both.where(~seen).select(*new.columns)


def zip_lists(df: DataFrame, cols: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Explode parallel arrays together, as far as the shortest one reaches.

    A NULL array counts as empty.  Adds ``ord``, the 0-based position.
    """
    names = list(names or cols)
    arrays = [F.coalesce(F.col(c), F.expr("array()").cast(df.schema[c].dataType)) for c in cols]
    shortest = F.least(*[F.size(a) for a in arrays]) if len(arrays) > 1 else F.size(arrays[0])
    cut = [F.slice(a, F.lit(1), shortest).alias(n) for a, n in zip(arrays, names)]
    keep = [c for c in df.columns if c not in cols]
    zipped = df.select(*keep, F.posexplode(F.arrays_zip(*cut)).alias("ord", "_z"))
    return zipped.select(*keep, "ord", *[F.col("_z")[n].alias(n) for n in names])


def with_roles(articles: DataFrame, roles: DataFrame, key: str = "sent_id") -> DataFrame:
    """Articles with the roles of their sentence, by content key.

    Many articles may carry the same sentence; Spark splits a partition such a
    key makes too large.
    """
    return articles.join(roles, key, "left")


def listing_counts(links: DataFrame, video_mark: str = VIDEO_PREFIX) -> DataFrame:
    """Listed links and video links per day, from links(day, href)."""
    return links.groupBy("day").agg(
        F.count("*").alias("listed"),
        F.count_if(F.col("href").contains(video_mark)).alias("video"),
    )


def stored_counts(stored: DataFrame) -> DataFrame:
    """Stored articles per day."""
    return stored.groupBy("day").agg(F.count("*").alias("stored_lines"))


def days_to_refresh(listed: DataFrame, stored: DataFrame, slack: int = 10) -> DataFrame:
    """Days whose stored articles are missing or ``slack`` or more behind the listing.

    ``listed(day, listed, video)`` and ``stored(day, stored_lines)``, one row a day.
    """
    missing = F.col("listed") - F.col("video") - F.col("stored_lines")
    return (
        listed.join(stored, "day", "left")
        .withColumn("missing", missing)
        .where(F.col("stored_lines").isNull() | (F.col("missing") >= slack))
    )


def page_slice(
    df: DataFrame, lo: int, hi: int, size: int, order: Sequence[str | Column], by: Sequence[str] = ()
) -> DataFrame:
    """Pages ``lo`` to ``hi`` (from 1) of ``size`` rows, in ``order``, per ``by`` group or of all rows.

    Rows are dealt out by ranges of group and order; a row's number is its rank
    in its range plus the rows of the group in the ranges before.  So a group of
    any size, also the whole table, is spread over tasks, and any page can be
    asked for; what is put together are the counts of the ranges.
    """
    ranges = df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    ranges = staged(ranges, "ranges")
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("_range", *by).agg(F.count("*").alias("_rows"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).where(
        (F.col("_before") < hi * size) & (F.col("_before") + F.col("_rows") > (lo - 1) * size)
    )
    names = {c: f"_by{i}" for i, c in enumerate(by)}
    counts = counts.select(F.col("_range").alias("_of"), *[F.col(c).alias(n) for c, n in names.items()], "_before")
    same = [ranges["_range"] == counts["_of"], *[ranges[c].eqNullSafe(counts[n]) for c, n in names.items()]]
    rank = F.row_number().over(Window.partitionBy("_range", *by).orderBy(*order)) + F.col("_before")
    return (
        ranges.join(counts, same)
        .withColumn("_n", rank)
        .where((F.col("_n") <= hi * size) & (F.col("_n") > (lo - 1) * size))
        .withColumn("page", F.floor((F.col("_n") - 1) / size) + 1)
        .select(*df.columns, "page")
    )

"""Pages landing in a folder, taken in by micro-batches.

The jobs skip what the stored tables hold, so a batch that is replayed after a
failure adds nothing twice.  `follow_property_listings` does all in one query.
`take_in_listings` and `follow_property_rows` are two: pages become rows, and
rows that were seen lately are dropped by state, before the stored table is
read or a sentence analysed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kawaraban.plans.refresh import add_listed, refresh_property_table, save_rejected
from kawaraban.plans.tables import RolesOf, property_tables
from kawaraban.session import staged
from kawaraban.sources.tables import append_articles, read_articles

PAGE_SCHEMA = "page_id bigint, url string, html string"
ROW_SCHEMA = "page_id string, sec int, kind int, pos int, date_raw string, title string, summary string, url string"


def _started(writer: DataStreamWriter, checkpoint: str, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def follow_property_listings(
    spark: SparkSession,
    landing: str,
    path: str,
    checkpoint: str,
    roles_of: RolesOf,
    today: Callable[[], dt.date] = dt.date.today,
    once: bool = False,
    max_files: int = 1000,
) -> StreamingQuery:
    """Keep the property table current with listing pages that land as parquet.

    ``today`` is asked for every batch, so arrivals get the date of the day they
    are taken in, and headings its year.  ``once`` takes in all that is there
    and stops.
    """

    def take_in(batch: DataFrame, _: int) -> None:
        day = today()
        refresh_property_table(batch.sparkSession, path, batch, day.year, day, roles_of)

    pages = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(landing)
    return _started(pages.writeStream.foreachBatch(take_in), checkpoint, once)


def take_in_listings(
    spark: SparkSession,
    landing: str,
    listed: str,
    rejected: str,
    checkpoint: str,
    today: Callable[[], dt.date] = dt.date.today,
    once: bool = False,
    max_files: int = 1000,
) -> StreamingQuery:
    """Turn listing pages that land as parquet into rows, added to the folder ``listed``.

    Rejected rows are kept in the table ``rejected``.  A replayed batch adds its
    rows again; `follow_property_rows` drops them.
    """

    def take_in(batch: DataFrame, _: int) -> None:
        day = today()
        rows, bad = property_tables(batch, day.year, day)
        save_rejected(bad, rejected, day)
        append_articles(rows, listed)

    pages = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(landing)
    return _started(pages.writeStream.foreachBatch(take_in), checkpoint, once)


def follow_property_rows(
    spark: SparkSession,
    listed: str,
    path: str,
    checkpoint: str,
    roles_of: RolesOf,
    keep: str = "7 days",
    once: bool = False,
    max_files: int = 1000,
) -> StreamingQuery:
    """Keep the property table current with the rows that `take_in_listings` adds to ``listed``.

    A row that came within the time ``keep`` before is dropped by the query's
    state; rows of one date and title that differ are left to the stored table,
    so the first by page and place is taken, as in the whole job.  The time of a
    row is that of its batch, so no row is ever too late: what the state no
    longer holds, or what a new checkpoint never held, is checked against the
    stored days that the rows name.  State grows with the distinct rows of
    ``keep``, by executor.  Where ``listed`` does not exist yet, it is made.

    Spark turns adaptive execution off in the session of a query with state, and
    with it all rebalancing: each task would add a file to each day.  So a
    batch is staged there and added by the session ``spark``.
    """

    def add(batch: DataFrame, _: int) -> None:
        fresh = staged(batch.drop("taken"), "fresh", spark)
        if not fresh.isEmpty():
            add_listed(fresh, path, roles_of)

    if read_articles(spark, listed, ROW_SCHEMA) is None:
        append_articles(spark.createDataFrame([], ROW_SCHEMA), listed)
    rows = spark.readStream.schema(ROW_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(listed)
    timed = rows.withColumn("taken", F.current_timestamp()).withWatermark("taken", keep)
    fresh = timed.dropDuplicatesWithinWatermark([f.name for f in rows.schema])
    return _started(fresh.writeStream.foreachBatch(add), checkpoint, once)

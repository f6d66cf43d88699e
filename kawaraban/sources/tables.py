"""Stored tables: daily corpus, article table, yearly tables, checkpoints of a crawl."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F

from kawaraban.functions.dates import stored_day
from kawaraban.session import staged

# --- fixed values: column order of the stored tables --------------------------
HEADLINE_COLUMNS = ("Date", "Summary", "Link", "Detail")
ARCHIVE_COLUMNS = ("Date", "Title", "Snippet", "link", "honbun")
PROPERTY_COLUMNS = ("Date", "Title", "Summary", "Link")
PROPERTY_ROLE_COLUMNS = ("ガ", "ヲ", "ニ", "Do", "Loc")
CHECKPOINT_PAGES = 1000
# ------------------------------------------------------------------------------


def rebalanced(df: DataFrame, by: str) -> DataFrame:
    """Rows of one ``by`` value together, in files of even size.

    AQE splits a value that holds too much for one task and joins small ones.
    """
    return df.sparkSession.sql(f"SELECT /*+ REBALANCE(`{by}`) */ * FROM {{t}}", t=df)


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> None:
    """Replace the ``by`` partitions that occur in ``df``; leave all others alone."""
    (
        rebalanced(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("lineSep", "\n")
        .partitionBy(by)
        .format(fmt)
        .save(path)
    )


def write_daily(df: DataFrame, path: str, text: str = "text", fmt: str = "text") -> None:
    """One folder per day, one article per line, in UTF-8; only the given days are replaced.

    An article must hold no newline; ``clean_en`` removes them.
    """
    write_partitioned(df.select("day", F.col(text).alias("value")), path, "day", fmt)


def _load(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is no such folder."""
    try:
        return reader.load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


_DAY_COUNTS = "run bigint, day string, stored_lines bigint"


def write_day_counts(counts: DataFrame, path: str) -> None:
    """Keep day, stored_lines of refreshed days beside the table, days without an article (0) too.

    Rows are added under the number of their run and replace those of earlier
    runs when they are read, so the days need no folders here.
    """
    known = _load(counts.sparkSession.read.schema(_DAY_COUNTS), f"{path}-counts")
    last = known.agg(F.max("run")).first()[0] if known is not None else None
    run = F.lit((last or 0) + 1).cast("bigint").alias("run")
    counts.select(run, "day", F.col("stored_lines").cast("bigint").alias("stored_lines")).write.mode("append").parquet(f"{path}-counts")


def read_day_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """day, stored_lines of all refreshed days; None where no day was refreshed yet."""
    found = _load(spark.read.schema(_DAY_COUNTS), f"{path}-counts")
    if found is None:
        return None
    newest = F.max_by("stored_lines", "run").alias("stored_lines")
    return found.groupBy("day").agg(newest).select("stored_lines", "day")


def read_daily(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame | None:
    """day, text; None where no day was written yet.

    The day is kept as text, so 20160101 does not become a number.  A day whose
    last refresh found no article has none, whatever stood there before.
    """
    reader = spark.read.format(fmt).option("lineSep", "\n")
    found = _load(reader.schema("value string"), path)
    if found is None or "day" not in found.columns:
        return None
    daily = reader.schema("value string, day string").load(path)
    counts = read_day_counts(spark, path)
    if counts is not None:
        daily = daily.join(counts.where("stored_lines = 0").select("day"), "day", "left_anti")
    return daily.select("day", F.col("value").alias("text"))


def write_by_year(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, "year")


def write_batches(df: DataFrame, path: str, page: str = "page", size: int = CHECKPOINT_PAGES) -> None:
    """Save a crawl in batches of ``size`` pages; repeating a batch replaces it."""
    write_partitioned(df.withColumn("batch", F.floor(F.col(page) / size)), path, "batch")


def _lines_escaped(df: DataFrame) -> DataFrame:
    """Text columns with line ends (and the escape sign) escaped, so that a CSV row is a line."""
    return df.withColumns(
        {
            f.name: F.replace(F.replace(F.replace(F.col(f"`{f.name}`"), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("\r"), F.lit("%0D"))
            for f in df.schema
            if f.dataType.simpleString() == "string"
        }
    )


def _lines_restored(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            f.name: F.replace(F.replace(F.replace(F.col(f"`{f.name}`"), F.lit("%0D"), F.lit("\r")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
            for f in df.schema
            if f.dataType.simpleString() == "string"
        }
    )


def _writer(df: DataFrame, columns: Sequence[str] | None, fmt: str, by: str | None) -> tuple[DataFrame, dict[str, str]]:
    """The columns to store and the writer's options."""
    out = df.select(*columns, *([by] if by else [])) if columns else df
    if fmt != "csv":
        return out, {}
    return _lines_escaped(out), {"header": "true", "escape": '"'}


def write_articles(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet", by: str | None = None
) -> None:
    """Replace a stored table or, with ``by``, the partitions of that column which occur in ``df``.

    ``df`` may be computed from the table itself: its rows are staged first.
    Partitions are replaced by Spark's dynamic overwrite when all rows are
    written, so a job that fails leaves them as they were; running it again
    replaces the same ones.  One job at a time may write a partition.
    """
    out, options = _writer(df, columns, fmt, by)
    rows = staged(out, "articles")
    if by is None:
        rows.write.format(fmt).options(**options).mode("overwrite").save(path)
        return
    writer = rebalanced(rows, by).write.format(fmt).options(**options).mode("overwrite").partitionBy(by)
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def append_articles(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet", by: str | None = None
) -> None:
    """Add rows to a stored table; what is there is not written again."""
    out, options = _writer(df, columns, fmt, by)
    writer = (rebalanced(out, by) if by else out).write.format(fmt).options(**options).mode("append")
    (writer.partitionBy(by) if by else writer).save(path)


def read_articles(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame | None:
    """A stored table, or None where there is none yet."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    if schema:
        reader = reader.schema(schema)
    found = _load(reader, path)
    return _lines_restored(found) if found is not None and fmt == "csv" else found


def read_checked(spark: SparkSession, path: str, schema: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A CSV table's rows that fit the schema, and its lines that do not, as ``line`` with a ``reason``.

    A line fits when it has a value for every column.  Both are staged: the
    file is parsed once.
    """
    reader = spark.read.option("header", header).option("escape", '"').option("mode", "PERMISSIVE")
    parsed = reader.option("columnNameOfCorruptRecord", "_line").schema(f"{schema}, _line string").csv(path)
    parsed = staged(parsed, "checked")
    good = _lines_restored(parsed.where("_line IS NULL").drop("_line"))
    return good, parsed.where("_line IS NOT NULL").select(F.col("_line").alias("line"), F.lit("columns").alias("reason"))


def of_days(stored: DataFrame, days: DataFrame, by: str = "day") -> DataFrame:
    """Rows of a table partitioned by day which lie on the given days, and those without a day.

    ``days`` should be a staged table with the column ``by``: Spark broadcasts a
    short one and reads only the folders it names.
    """
    # Holds for every date; Spark prunes only by a side that has a condition.
    listed = days.where(F.col(by) >= F.lit("0001-01-01").cast("date")).select(F.col(by).alias("_day")).distinct()
    dated = stored.join(listed, stored[by] == F.col("_day"), "left_semi")
    return dated.unionByName(stored.where(F.col(by).isNull()))


def with_days(df: DataFrame, date: str = "Date") -> DataFrame:
    """Records with their ``day`` as a date, beside the date as text; NULL where the text names no day."""
    return df.withColumn("day", stored_day(F.col(date)))


#: How the three record shapes name the fields of the common one.
_COMMON = {"Link": "url", "link": "url", "Date": "date_raw", "Title": "title", "Snippet": "summary", "Summary": "summary", "Detail": "body", "honbun": "body"}


def as_articles(df: DataFrame, site: str) -> DataFrame:
    """Records of any site as site, url, date_raw, date, title, summary, body; fields a site lacks are NULL."""
    have = {_COMMON[c]: F.col(f"`{c}`") for c in df.columns if c in _COMMON}
    field = lambda name: have.get(name, F.lit(None)).cast("string").alias(name)
    rows = df.select(F.lit(site).alias("site"), *(field(c) for c in ("url", "date_raw", "title", "summary", "body")))
    return rows.select("site", "url", "date_raw", stored_day(F.col("date_raw")).alias("date"), "title", "summary", "body")


# --- histograms kept up to date -----------------------------------------------
def add_counts(counts: DataFrame, path: str, batch: str) -> None:
    """Keep a batch's counts (year, token, n) beside those of the others; repeating a batch replaces its counts."""
    write_partitioned(counts.withColumn("batch", F.lit(batch)), path, "batch")


def read_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """The counts of all batches added up: year, token, n."""
    found = _load(spark.read.schema("year string, token string, n bigint, batch string"), path)
    return None if found is None else found.groupBy("year", "token").agg(F.sum("n").alias("n"))


def compact_counts(spark: SparkSession, path: str, batch: str) -> None:
    """Put the counts of all batches into one, named ``batch``; no batch before may be repeated afterwards."""
    total = staged(read_counts(spark, path).withColumn("batch", F.lit(batch)), "counts")
    total.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(path)

"""Whole jobs over derived sites."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kawaraban.functions import text as T
from kawaraban.operators.extract import property_items
from kawaraban.operators.rows import order_by_doc
from kawaraban.plans import english, refresh, tables as J
from kawaraban.plans.roles import roles_of_sentences
from kawaraban.queries import fixtures as X
from kawaraban.queries.base import q, query, with_
from kawaraban.queries.markup import _PAGES
from kawaraban.queries.strings import _EN, _SQL_HEADING_DATE, _STRIP, _wide_sql
from kawaraban.session import scratch_path, staged
from kawaraban.sources import profiles as P
from kawaraban.sources.pages import archive_urls
from kawaraban.sources.tables import append_articles, read_articles, read_daily, with_days
from kawaraban.streaming.landing import follow_property_rows, take_in_listings

_TODAY = dt.date(2019, 3, 8)


def _archive(spark: SparkSession, sf_dir: str, template: str) -> DataFrame:
    """Archive URLs of all listing pages."""
    last = X.documents(spark, sf_dir).agg(F.max(X.div("doc_id", X.DOCS_PER_PAGE))).first()[0]
    return archive_urls(spark, template, 1, last + 2).select("url")


# --- English daily corpus ------------------------------------------------------------
_BODY = f"""CASE WHEN doc_id % 25 = 4 THEN ''
  WHEN doc_id % 7 = 5 THEN {X.sql_escaped("text")}
  ELSE replace({X.sql_escaped("text")}, chr(10), '') END"""


@query(
    with_(
        [
            X.D_HOPS,
            """days AS (SELECT day, day_no, count(*) AS listed, count(*) FILTER (doc_id % 9 = 0) AS video
                     FROM d_hops GROUP BY ALL)""",
            """due AS (SELECT day FROM days WHERE day_no % 3 = 0
                      OR (day_no % 3 = 2 AND listed - video - 1 >= 10))""",
        ],
        f"""SELECT day, href AS url, text FROM (
              SELECT day, href, {_STRIP.format(_EN.format(_BODY))} AS text
              FROM d_hops JOIN due USING (day) WHERE doc_id % 9 <> 0 AND doc_id % 14 <> 3)
            WHERE text <> ''""",
    )
)
def daily_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year pages to days to articles, for the days that are behind.

    A third of the days has no stored articles, a third is complete, a third
    has one article.
    """
    docs = X.documents(spark, sf_dir).select(X._day().alias("day_no"))
    listed = docs.groupBy("day_no").agg(F.count("*").alias("n"))
    stored = listed.where("day_no % 3 > 0").select(
        X._day_key(F.col("day_no")).alias("day"),
        F.when(F.col("day_no") % 3 == 1, F.col("n")).otherwise(1).alias("stored_lines"),
    )
    pages = X.stored_site(spark, sf_dir, X.d_hops)
    corpus = english.daily_corpus(pages, X.year_seeds(spark, sf_dir), stored)
    return corpus.select("day", "url", "text")


# --- headline table ---------------------------------------------------------------------
@query(
    with_(
        [
            X.D_ARTICLES,
            "t AS (SELECT *, row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS n FROM d_articles)",
            "s AS (SELECT *, row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS n FROM d_articles "
            "WHERE doc_id % 23 <> 0)",
        ],
        f"""SELECT '2019年' || (t.doc_id % 12 + 1) || '月' AS "Date", {X.sql_escaped("s.summary")} AS "Summary",
              {q(P.JA_BASE)} || '/article/id' || t.doc_id AS "Link",
              CASE WHEN t.doc_id % 31 = 0 THEN ''
                   ELSE translate({X.sql_escaped("t.body")}, chr(10) || ',', '') END AS "Detail"
            FROM t JOIN s ON s.doc_id // 10 = t.doc_id // 10 AND s.n = t.n""",
    )
)
def headline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = X.stored_site(spark, sf_dir, X.ja_listing, X.ja_articles)
    return J.headline_table(pages, _archive(spark, sf_dir, P.JA_ARCHIVE))


# --- tech archive table -------------------------------------------------------------------
@query(
    with_(
        [X.D_ARTICLES],
        f"""SELECT (2010 + doc_id % 12) || '/4/1 6:30' AS "Date", {X.sql_escaped("title")} AS "Title",
              {X.sql_escaped("summary")} AS "Snippet", {q(P.TECH_BASE)} || url AS link,
              {_STRIP.format("replace(body, chr(10), '')")} AS honbun
            FROM d_articles WHERE doc_id % 19 <> 0""",
    )
)
def archive_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = X.stored_site(spark, sf_dir, X.tech_listing, X.d_detail)
    return J.archive_table(pages, _archive(spark, sf_dir, X.TECH_LIST + "%d"))


# --- property table ---------------------------------------------------------------------------
def _stored_third(listing: DataFrame) -> DataFrame:
    """Stored property rows: a third of the listed ones."""
    return listing.where("substring_index(url, '/', -1) % 3 = 0").select(
        F.col("date_raw").alias("Date"),
        F.col("title").alias("Title"),
        F.col("summary").alias("Summary"),
        F.col("url").alias("Link"),
        *[F.lit("old").alias(c) for c in J.PROPERTY_ROLE_COLUMNS],
    )


def _roles_of(sentences: DataFrame) -> DataFrame:
    """Roles of sentences parsed by the stand-in for the external parser."""
    flavour = (F.length("sentence") % 3).cast("int")
    return roles_of_sentences(X.parsed_sentences(sentences.withColumn("flavour", flavour)))


_LISTED = f"""listed AS (
  SELECT doc_id, {_SQL_HEADING_DATE} AS date_raw, title, {_wide_sql("summary")} AS summary,
         {q(P.PROPERTY_BASE)} || url AS url FROM items)"""
_SENTENCES = """sentences AS (
  SELECT DISTINCT md5(sentence) AS sent_id, sentence, length(sentence) % 3 AS flavour FROM analysed)"""


@query(
    with_(
        [
            X.D_ARTICLES,
            _PAGES,
            _LISTED,
            "stored AS (SELECT * FROM listed WHERE doc_id % 3 = 0)",
            f"""analysed AS (
  SELECT *, regexp_replace(split_part(summary, '。', 1), {q(T.WIDE_PAREN)}, '', 'g') AS sentence FROM listed l
  WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.date_raw = l.date_raw AND s.title = l.title))""",
            _SENTENCES,
            *X.sql_phrases("sentences"),
            X.SQL_ROLES,
        ],
        """SELECT date_raw AS "Date", title AS "Title", summary AS "Summary", url AS "Link",
             coalesce(ga, '-') AS "ガ", coalesce(wo, '-') AS "ヲ", coalesce(ni, '-') AS "ニ",
             coalesce(verb, '-') AS "Do", coalesce(loc, '-') AS "Loc", 0 AS batch_ord
           FROM analysed LEFT JOIN roles ON roles.sent_id = md5(sentence)
           UNION ALL SELECT date_raw, title, summary, url, 'old', 'old', 'old', 'old', 'old', 1 FROM stored""",
    )
)
def incremental_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property listing pages added to a stored table that has a third of their rows."""
    listing = staged(J.property_listing(X.stored_site(spark, sf_dir, X.d_listing), 2019, _TODAY), "listing")
    return J.incremental_table(listing, _stored_third(listing), _roles_of)


# Headings with an invalid day; of two copies of a page the newer one counts.
_ODD_PAGES = _PAGES.replace(X.SQL_HEADING, X.SQL_ODD_HEADING)


def _odd_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages, every fourth one also in an older copy with other titles."""
    pages = X.d_listing(spark, sf_dir, X.odd_heading)
    last = F.lit(1_000_000_000_000)
    old = pages.where("page_id % 4 = 0").withColumn("html", F.replace("html", F.lit("<h3>"), F.lit("<h3>old ")))
    return pages.withColumn("page_id", F.col("page_id") + last).unionByName(old)


@query(
    with_(
        [
            X.D_ARTICLES,
            _ODD_PAGES,
            _LISTED,
            f"""first AS (
  SELECT l.* FROM listed l JOIN linked USING (doc_id) WHERE date_raw IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY date_raw, l.title
    ORDER BY {q(X.PROPERTY_LIST)} || g, CASE WHEN pickup THEN 0 ELSE 1 END, doc_id) = 1)""",
            f"""analysed AS (
  SELECT *, regexp_replace(split_part(summary, '。', 1), {q(T.WIDE_PAREN)}, '', 'g') AS sentence FROM first)""",
            _SENTENCES,
            *X.sql_phrases("sentences"),
            X.SQL_ROLES,
        ],
        """SELECT date_raw AS "Date", title AS "Title", summary AS "Summary", url AS "Link",
             coalesce(ga, '-') AS "ガ", coalesce(wo, '-') AS "ヲ", coalesce(ni, '-') AS "ニ",
             coalesce(verb, '-') AS "Do", coalesce(loc, '-') AS "Loc"
           FROM analysed LEFT JOIN roles ON roles.sent_id = md5(sentence)""",
    )
)
def refresh_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The property job run twice over pages with invalid days and doubled URLs; the stored table."""
    pages, path = X.stored_site(spark, sf_dir, _odd_site), scratch_path(spark, "property")
    for _ in range(2):
        refresh.refresh_property_table(spark, path, pages, 2019, _TODAY, _roles_of)
    return read_articles(spark, path, refresh.PROPERTY_SCHEMA).select(*refresh.PROPERTY_STORED)


@query(
    with_(
        [
            X.D_ARTICLES,
            _ODD_PAGES,
            f"""dated AS (
  SELECT doc_id, {_SQL_HEADING_DATE} AS date_raw, title, url FROM linked)""",
        ],
        f"""SELECT title, {q(P.PROPERTY_BASE)} || url AS url,
              concat_ws(',', CASE WHEN date_raw IS NULL THEN 'date_raw' END,
                             CASE WHEN doc_id % 13 = 0 THEN 'summary' END) AS reason
            FROM dated WHERE date_raw IS NULL OR doc_id % 13 = 0""",
    )
)
def rejected_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows that two runs of the property job rejected, with the reason."""
    _, rejected = J.property_tables(X.stored_site(spark, sf_dir, _odd_site), 2019, _TODAY)
    path = scratch_path(spark, "rejected")
    for _ in range(2):
        refresh.save_rejected(rejected, path, _TODAY)
    return read_articles(spark, path).select("title", "url", "reason")


@query(
    with_(
        [X.D_HOPS],
        f"""SELECT day, text FROM (
              SELECT day, doc_id, {_STRIP.format(_EN.format(_BODY))} AS text FROM d_hops)
            WHERE text <> '' AND doc_id % 9 <> 0 AND doc_id % 14 <> 3""",
    )
)
def refresh_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job run twice, the second time with few pages left: no day is due again."""
    pages, path = X.stored_site(spark, sf_dir, X.d_hops), scratch_path(spark, "daily")
    refresh.refresh_daily_corpus(spark, path, pages, X.year_seeds(spark, sf_dir))
    fewer = pages.where(~F.startswith("url", F.lit(X.EN_ARTICLE)))
    refresh.refresh_daily_corpus(spark, path, fewer, X.year_seeds(spark, sf_dir))
    return read_daily(spark, path)


@query(
    with_(
        [X.D_ARTICLES, _PAGES],
        """SELECT g AS page_id, row_number() OVER (PARTITION BY g ORDER BY pickup DESC, doc_id) AS ord, title
           FROM items""",
    )
)
def document_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows put in document order, numbered per page in the order they came out."""
    items = property_items(X.d_listing(spark, sf_dir), key="page_id")
    ordered = order_by_doc(items, "page_id", "sec", "kind", "pos").withColumn("at", F.monotonically_increasing_id())
    ord_ = F.row_number().over(Window.partitionBy("page_id").orderBy("at")).cast("bigint")
    return ordered.select("page_id", ord_.alias("ord"), "title")


@query(
    with_(
        [
            X.D_ARTICLES,
            f"""analysed AS (
  SELECT *, regexp_replace({_wide_sql("split_part(body, '。', 1)")}, {q(T.WIDE_PAREN)}, '', 'g') AS sentence
  FROM (SELECT date_raw, title, url, replace(body, '.', '。') AS body FROM d_articles))""",
            _SENTENCES,
            *X.sql_phrases("sentences"),
            X.SQL_ROLES,
        ],
        """SELECT date_raw AS "Date", title AS "Title", body AS "Summary", url AS "Link",
             coalesce(ga, '-') AS "ガ", coalesce(wo, '-') AS "ヲ", coalesce(ni, '-') AS "ニ",
             coalesce(verb, '-') AS "Do", coalesce(loc, '-') AS "Loc"
           FROM analysed LEFT JOIN roles ON roles.sent_id = md5(sentence)""",
    )
)
def reanalyse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of all stored articles made anew from the first sentence of their text."""
    stored = X.d_articles(spark, sf_dir).select(
        F.col("date_raw").alias("Date"),
        F.col("title").alias("Title"),
        F.replace(F.col("body"), F.lit("."), F.lit("。")).alias("Summary"),
        F.col("url").alias("Link"),
    )
    return J.reanalysed(stored, _roles_of)


# --- the property table by streams ---------------------------------------------------------------
@query(
    with_(
        [
            X.D_ARTICLES,
            _PAGES,
            _LISTED,
            f"""first AS (
  SELECT l.* FROM listed l JOIN linked USING (doc_id) WHERE date_raw IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY date_raw, l.title
    ORDER BY g % 2, {q(X.PROPERTY_LIST)} || g, CASE WHEN pickup THEN 0 ELSE 1 END, doc_id) = 1)""",
            f"""analysed AS (
  SELECT *, regexp_replace(split_part(summary, '。', 1), {q(T.WIDE_PAREN)}, '', 'g') AS sentence FROM first)""",
            _SENTENCES,
            *X.sql_phrases("sentences"),
            X.SQL_ROLES,
        ],
        """SELECT date_raw AS "Date", title AS "Title", summary AS "Summary", url AS "Link",
             coalesce(ga, '-') AS "ガ", coalesce(wo, '-') AS "ヲ", coalesce(ni, '-') AS "ニ",
             coalesce(verb, '-') AS "Do", coalesce(loc, '-') AS "Loc"
           FROM analysed LEFT JOIN roles ON roles.sent_id = md5(sentence)""",
    )
)
def streamed_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages that land in two parts, the second with the first one's pages again; the streams end in between."""
    pages = X.stored_site(spark, sf_dir, X.d_listing)
    landing, listed, path, work = (scratch_path(spark, n) for n in ("landing", "rows", "streamed", "streams"))
    for part in (pages.where("page_id % 2 = 0"), pages):
        part.select("page_id", "url", "html").write.mode("append").parquet(landing)
        take_in_listings(spark, landing, listed, f"{path}-rejected", f"{work}/pages", lambda: _TODAY, once=True).awaitTermination()
        follow_property_rows(spark, listed, path, f"{work}/rows", _roles_of, once=True).awaitTermination()
    return read_articles(spark, path, refresh.PROPERTY_SCHEMA).select(*refresh.PROPERTY_STORED)


# --- other halves of the jobs -----------------------------------------------------------------------
_MONTH_DAY = "'2019年' || lpad((1 + doc_id % 12)::VARCHAR, 2, '0') || '月07日'"


@query(
    with_(
        [
            X.D_ARTICLES,
            f"""analysed AS (
  SELECT *, regexp_replace({_wide_sql("split_part(body, '。', 1)")}, {q(T.WIDE_PAREN)}, '', 'g') AS sentence
  FROM (SELECT {_MONTH_DAY} AS date_raw, title, url, replace(body, '.', '。') AS body FROM d_articles))""",
            _SENTENCES,
            *X.sql_phrases("sentences"),
            X.SQL_ROLES,
        ],
        """SELECT date_raw AS "Date", title AS "Title", body AS "Summary", url AS "Link",
             coalesce(ga, '-') AS "ガ", coalesce(wo, '-') AS "ヲ", coalesce(ni, '-') AS "ニ",
             coalesce(verb, '-') AS "Do", coalesce(loc, '-') AS "Loc"
           FROM analysed LEFT JOIN roles ON roles.sent_id = md5(sentence)""",
    )
)
def redo_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored property table whose roles are made anew in place."""
    day = X.cat("2019年", F.lpad((1 + F.col("doc_id") % 12).cast("string"), 2, "0"), "月07日")
    stored = X.d_articles(spark, sf_dir).select(
        day.alias("Date"),
        F.col("title").alias("Title"),
        F.replace(F.col("body"), F.lit("."), F.lit("。")).alias("Summary"),
        F.col("url").alias("Link"),
        *[F.lit("old").alias(c) for c in J.PROPERTY_ROLE_COLUMNS],
    )
    path = scratch_path(spark, "redone")
    append_articles(with_days(stored), path, refresh.PROPERTY_STORED, by="day")
    refresh.redo_property_table(spark, path, _roles_of)
    return read_articles(spark, path, refresh.PROPERTY_SCHEMA).select(*refresh.PROPERTY_STORED)


def _details_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article pages, of which every seventeenth was never stored."""
    return X.d_detail(spark, sf_dir).where("page_id % 17 <> 0")


@query(
    with_(
        [X.D_ARTICLES],
        f"""SELECT NULL::VARCHAR AS "Date", {X.sql_escaped("title")} AS "Title", {X.sql_escaped("summary")} AS "Snippet",
              {q(P.TECH_BASE)} || url AS link, NULL::VARCHAR AS honbun, 'Date,honbun' AS reason
            FROM d_articles WHERE doc_id % 19 <> 0 AND doc_id % 17 = 0""",
    )
)
def rejected_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed items of the tech archive whose article page is missing, with the reason."""
    pages = X.stored_site(spark, sf_dir, X.tech_listing, _details_with_gaps)
    return J.archive_tables(pages, _archive(spark, sf_dir, X.TECH_LIST + "%d"))[1]

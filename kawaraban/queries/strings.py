"""Column functions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from kawaraban.functions import dates as D, frames as C, links as L, text as T
from kawaraban.operators.rows import every_nth, with_errors
from kawaraban.queries import fixtures as X
from kawaraban.queries.base import q, query, table, with_
from kawaraban.sources import profiles as P

# RE2 and Java agree on these patterns, so the SQL uses the same fixed values.
# --- fixed value: tags and punctuation to delete, in one pattern ----------------
# The library deletes them in two passes (functions/text.py), which takes half the
# time of one in Spark; this form checks that both give the same text.
_NOISE = r"""\n|<p*>|</p>|<br>|</br>|<a*>|</a>|\(|\)|,|\.|“|"|”|'|’"""
# --------------------------------------------------------------------------------
_EN = f"lower(regexp_replace({{}}, {q(_NOISE)}, '', 'g'))"
_STRIP = f"regexp_replace({{}}, {q(T.ANY_TAG)}, '', 'g')"


def _wide_sql(c: str) -> str:
    joined = c
    for pair, full in T.VOICED.items():
        joined = f"replace({joined}, '{pair}', '{full}')"
    return f"translate({joined}, {q(T.HALF)}, {q(T.FULL)})"


@query(
    f"SELECT page_id AS id, 'page' AS kind, {_EN.format('html')} AS text FROM pages "
    f"UNION ALL SELECT doc_id, 'document', {_EN.format('text')} FROM documents"
)
def clean_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), F.lit("page").alias("kind"), T.clean_en(F.col("html")).alias("text")
    )
    docs = X.documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), F.lit("document").alias("kind"), T.clean_en(F.col("text")).alias("text")
    )
    return pages.unionByName(docs)


@query(f"SELECT page_id, {_STRIP.format('html')} AS text FROM pages")
def strip_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.strip_tags(F.col("html")).alias("text"))


@query("SELECT doc_id, translate(text, chr(10) || ',', '') AS text FROM documents")
def drop_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.documents(spark, sf_dir).select("doc_id", T.drop_chars(F.col("text"), "\n,").alias("text"))


@query(
    "SELECT doc_id, replace(replace(replace(text, chr(10), '　') || '…続き', '　', ''), '…続き', '') AS text "
    "FROM documents"
)
def clean_snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    snippet = X.cat(F.translate("text", "\n", "　"), T.CONTINUED)
    return X.documents(spark, sf_dir).select("doc_id", T.clean_snippet(snippet).alias("text"))


@query(
    with_(
        [X.D_ARTICLES],
        f"SELECT doc_id, regexp_replace(date_raw, {q(T.PAREN_SUFFIX)}, '', 'g') AS date_text, "
        f"regexp_replace(body || ' (1) (2)', {q(T.PAREN_SUFFIX)}, '', 'g') AS body FROM d_articles",
    )
)
def drop_paren_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.d_articles(spark, sf_dir).select(
        "doc_id",
        T.drop_paren_suffix(F.col("date_raw")).alias("date_text"),
        T.drop_paren_suffix(X.cat(F.col("body"), " (1) (2)")).alias("body"),
    )


@query(
    "SELECT doc_id, regexp_replace(replace(text, ' ', '（' || lang || '）'), "
    f"{q(T.WIDE_PAREN)}, '', 'g') AS text FROM documents"
)
def drop_wide_paren(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.replace(F.col("text"), F.lit(" "), X.cat("（", F.col("lang"), "）"))
    return X.documents(spark, sf_dir).select("doc_id", T.drop_wide_paren(marked).alias("text"))


@query(f"SELECT doc_id, {_wide_sql(chr(39) + 'ｶﾞｰﾃﾞﾝ｡ﾊﾟ' + chr(39) + ' || text')} AS text FROM documents")
def to_fullwidth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.documents(spark, sf_dir).select(
        "doc_id", T.to_fullwidth(X.cat("ｶﾞｰﾃﾞﾝ｡ﾊﾟ", F.col("text"))).alias("text")
    )


@query("SELECT doc_id, split_part(text, '.', 1) AS sentence FROM documents")
def first_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.documents(spark, sf_dir).select("doc_id", T.first_sentence(F.col("text"), ".").alias("sentence"))


_TODAY = dt.date(2019, 3, 8)
_SQL_HEADING_DATE = f"""CASE WHEN heading = '{D.NEW_ARRIVALS}' THEN '2019年03月08日'
  WHEN contains(heading, '{D.DAY_HEADING_SUFFIX}') THEN strftime(try_strptime(
    '2019年' || replace(heading, '{D.DAY_HEADING_SUFFIX}', ''), '%Y年%m月%d日'), '%Y年%m月%d日')
  ELSE heading END"""


@query(
    f"""SELECT g AS page_no, heading, {_SQL_HEADING_DATE} AS date_raw
        FROM (SELECT g, {X.SQL_HEADING} AS heading FROM (SELECT DISTINCT doc_id // 10 AS g FROM documents))"""
)
def heading_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = X.documents(spark, sf_dir).select(X.div("doc_id", 10).alias("page_no")).distinct()
    heading = X.heading(F.col("page_no"))
    return pages.select(
        "page_no", heading.alias("heading"), D.heading_date(heading, 2019, _TODAY).alias("date_raw")
    )


@query(
    f"""SELECT doc_id, heading, 'date' AS reason
       FROM (SELECT doc_id, (doc_id % 12 + 1) || '月' || (doc_id % 31 + 1) || '日{D.DAY_HEADING_SUFFIX}' AS heading
             FROM documents)
       WHERE try_strptime('2019年' || replace(heading, '{D.DAY_HEADING_SUFFIX}', ''), '%Y年%m月%d日') IS NULL"""
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings that are no day of 2019, such as 29 February."""
    heading = X.cat(F.col("doc_id") % 12 + 1, "月", F.col("doc_id") % 31 + 1, "日" + D.DAY_HEADING_SUFFIX)
    dated = (
        X.documents(spark, sf_dir)
        .select("doc_id", heading.alias("heading"))
        .withColumn("date", D.heading_day(F.col("heading"), 2019, _TODAY))
    )
    _, rejected = with_errors(dated, ["date"])
    return rejected.select("doc_id", "heading", "reason")


@query(
    with_(
        [X.D_ARTICLES],
        f"SELECT doc_id AS id, {q(P.TECH_BASE)} || url AS url FROM d_articles "
        "UNION ALL SELECT page_id, url FROM pages",
    )
)
def absolutise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative article links get the host; full page URLs stay."""
    links = X.d_articles(spark, sf_dir).select(F.col("doc_id").alias("id"), "url")
    links = links.unionByName(table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url"))
    return links.select("id", L.absolutise(F.col("url"), P.TECH_BASE).alias("url"))


@query(
    with_(
        [X.D_HOPS],
        "SELECT doc_id AS id, day AS day_key FROM d_hops UNION ALL "
        "SELECT page_id, split_part(split_part(url, '/', -1), '.', 1) FROM pages",
    )
)
def day_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = X.documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), X.cat(X.EN_ARCHIVE, X._day_key(X._day()), ".html").alias("url")
    )
    urls = days.unionByName(table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url"))
    return urls.select("id", D.day_key(F.col("url")).alias("day_key"))


@query(
    "SELECT doc_id, array_to_string(list_filter(w, lambda x, i: i % 2 = 1), ' ') AS words "
    "FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)"
)
def every_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.documents(spark, sf_dir).select(
        "doc_id", F.array_join(every_nth(F.split("text", " "), 2), " ").alias("words")
    )


@query(
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)::BIGINT AS k, "
    "TRY_CAST(event_type AS INTEGER)::BIGINT AS none FROM events"
)
def safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        C.safe_int(F.get_json_object("props", "$.k")).cast("bigint").alias("k"),
        C.safe_int(F.col("event_type")).cast("bigint").alias("none"),
    )


@query(
    "SELECT page_id, split_part(url, '/', 1) AS scheme, "
    "split_part(split_part(url, '//', 2), '/', 1) AS host FROM pages"
)
def head_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.substring_index("url", "//", -1)
    return table(spark, sf_dir, "pages").select(
        "page_id", C.head_word(F.col("url")).alias("scheme"), C.head_word(rest).alias("host")
    )

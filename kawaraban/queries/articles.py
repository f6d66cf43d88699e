"""Article rows: filters, duplicates, histograms, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kawaraban.functions import links as L, text as T
from kawaraban.functions.dates import year_of
from kawaraban.functions.frames import NOUN
from kawaraban.operators import rows as R
from kawaraban.operators.joins import page_slice as slice_pages
from kawaraban.plans.histogram import yearly_histogram
from kawaraban.plans.refresh import add_to_histogram, save_histogram
from kawaraban.queries import fixtures as X
from kawaraban.queries.base import query, table, with_
from kawaraban.queries.strings import _EN
from kawaraban.session import scratch_path, staged
from kawaraban.sources import tables as S

_WORDS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+')"


@query(
    with_([X.D_HOPS], "SELECT doc_id, href AS url FROM d_hops WHERE NOT contains(href, 'news/video')")
)
def filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = X.documents(spark, sf_dir).select("doc_id", X.en_href(F.col("doc_id")).alias("url"))
    return R.drop_matching_urls(urls)


@query("SELECT conv_id, turn, text FROM conversations WHERE text <> ''")
def non_empty_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.non_empty(table(spark, sf_dir, "conversations"), "text").select("conv_id", "turn", "text")


@query(
    with_(
        [X.D_HOPS],
        "SELECT doc_id, day_url AS href FROM d_hops WHERE doc_id % 6 > 1",
    )
)
def exclude_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of year pages without the two boilerplate ones."""
    n = F.col("doc_id") % 6
    day = X.cat(X.EN_ARCHIVE, X._day_key(X._day()), ".html")
    href = F.when(n == 0, L.BOILERPLATE_LINKS[0]).when(n == 1, L.BOILERPLATE_LINKS[1]).otherwise(day)
    return R.exclude_links(X.documents(spark, sf_dir).select("doc_id", href.alias("href")))


@query(
    with_(
        [X.D_ARTICLES],
        "SELECT doc_id, substring(date_raw, 1, 4) AS year, title FROM d_articles "
        "WHERE substring(date_raw, 1, 4) BETWEEN '2010' AND '2019'",
    )
)
def year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.by_year(X.d_articles(spark, sf_dir)).select("doc_id", "year", "title")


@query("SELECT DISTINCT text, lang FROM documents")
def dedup_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dedup(X.documents(spark, sf_dir).select("text", "lang"))


@query(
    f"SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest({_WORDS.format('text')}) AS token FROM documents) "
    "GROUP BY ALL"
)
def histogram_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.token_histogram(X.documents(spark, sf_dir), "lang")


@query(
    with_(
        [X.D_ARTICLES],
        f"""SELECT year, token, count(*) AS n
            FROM (SELECT substring(date_raw, 1, 4) AS year, unnest({_WORDS.format('body')}) AS token
                  FROM (SELECT DISTINCT date_raw, title, summary, body FROM d_articles))
            WHERE year BETWEEN '2010' AND '2019' GROUP BY ALL""",
    )
)
def histogram_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts per year of the distinct articles."""
    articles = X.d_articles(spark, sf_dir).select("date_raw", "title", "summary", "body")
    return yearly_histogram(articles, "body")


@query(
    f"""SELECT year, token, n FROM (
          SELECT lang AS year, token, count(*) AS n
          FROM (SELECT lang, unnest({_WORDS.format('text')}) AS token FROM documents)
          WHERE length(token) % 2 = 0 GROUP BY ALL)"""
)
def histogram_of_nouns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of one part of speech of tokens made by an analyser (here: words of even length)."""
    words = R.word_tokens(F.col("text"))
    tokens = F.transform(
        words, lambda w: F.struct(w.alias("surface"), F.when(F.length(w) % 2 == 0, NOUN).otherwise("動詞").alias("pos"))
    )
    analysed = X.documents(spark, sf_dir).select(F.col("lang").alias("year"), tokens.alias("tokens"))
    return R.token_histogram(analysed, "year", tokens="tokens", keep=NOUN)


@query(
    with_(
        [X.D_ARTICLES],
        f"""SELECT year, token, count(*) AS n
            FROM (SELECT substring(date_raw, 1, 4) AS year, unnest({_WORDS.format('summary')}) AS token
                  FROM (SELECT DISTINCT date_raw, title, summary FROM d_articles))
            WHERE year BETWEEN '2010' AND '2019' GROUP BY ALL""",
    )
)
def histogram_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly histogram written by year, a folder each, and read back."""
    articles = X.d_articles(spark, sf_dir).select(
        F.col("date_raw").alias("Date"), F.col("title").alias("Title"), F.col("summary").alias("Snippet")
    )
    path = scratch_path(spark, "histogram")
    save_histogram(articles, path)
    return spark.read.schema("token string, n bigint, year string").parquet(path)


@query(
    "SELECT lang, (n - 1) // 10 + 1 AS page, doc_id FROM (SELECT lang, doc_id, row_number() OVER "
    "(PARTITION BY lang ORDER BY text, doc_id) AS n, count(*) OVER (PARTITION BY lang) AS m FROM documents) "
    "WHERE n > (SELECT max(m) // 20 * 10 FROM (SELECT count(*) AS m FROM documents GROUP BY lang))"
)
def deep_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of ten from the middle of the largest language on, in order of the text."""
    docs = X.documents(spark, sf_dir)
    most = docs.groupBy("lang").count().agg(F.max("count")).first()[0]
    found = slice_pages(docs, most // 20 + 1, most // 10 + 1, 10, order=["text", "doc_id"], by=["lang"])
    return found.select("lang", "page", "doc_id")


@query(
    "SELECT (n - 1) // 7 + 1 AS page, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY text, doc_id) AS n FROM documents) "
    "WHERE n > (SELECT count(*) // 14 * 7 FROM documents)"
)
def deep_pages_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of seven from the middle of the table on, in order of the text."""
    docs = X.documents(spark, sf_dir)
    n = docs.count()
    return slice_pages(docs, n // 14 + 1, n // 7 + 1, 7, order=["text", "doc_id"]).select("page", "doc_id")


@query(
    "SELECT lang, (n - 1) // 10 + 1 AS page, doc_id FROM (SELECT lang, doc_id, row_number() OVER "
    "(PARTITION BY lang ORDER BY doc_id) AS n FROM documents) WHERE n BETWEEN 11 AND 30"
)
def page_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages two and three of ten documents, per language."""
    docs = X.documents(spark, sf_dir).select("lang", "doc_id")
    return slice_pages(docs, 2, 3, 10, order=["doc_id"], by=["lang"])


_DAY = "'201601' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0')"
_CLEAN = _EN.format("text")


@query(
    f"""SELECT day, CASE WHEN late THEN 'again ' || line ELSE line END AS text
        FROM (SELECT {_DAY} AS day, doc_id % 28 % 2 = 1 AS late, {_CLEAN} AS line FROM documents)
        WHERE line <> ''"""
)
def daily_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days written, every second day written again, all days read back."""
    day = X.cat("201601", F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    lines = X.documents(spark, sf_dir).select("doc_id", day.alias("day"), T.clean_en(F.col("text")).alias("text"))
    lines = staged(R.non_empty(lines, "text"), "lines")
    path = scratch_path(spark, "daily")
    S.write_daily(lines, path)
    again = lines.where("doc_id % 28 % 2 = 1")
    S.write_daily(again.withColumn("text", X.cat("again ", F.col("text"))), path)
    return S.read_daily(spark, path)


@query(
    with_(
        [X.D_ARTICLES],
        """SELECT doc_id, date_raw, CASE WHEN doc_id % 3 < 2 THEN title || '!' ELSE title END AS title, summary, url, body
           FROM d_articles""",
    )
)
def articles_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in folders by year saved, added to, replaced by rows computed from itself, added to again, then read."""
    columns = ("doc_id", "date_raw", "title", "summary", "url", "body")
    path = scratch_path(spark, "articles")
    articles = X.d_articles(spark, sf_dir).withColumn("year", year_of(F.col("date_raw")))
    S.write_articles(articles.where("doc_id % 3 = 0"), path, columns, by="year")
    S.append_articles(articles.where("doc_id % 3 = 1"), path, columns, by="year")
    S.write_articles(S.read_articles(spark, path).withColumn("title", X.cat(F.col("title"), "!")), path, columns, by="year")
    S.append_articles(articles.where("doc_id % 3 = 2"), path, columns, by="year")
    return S.read_articles(spark, path).select(*columns)


@query(
    """SELECT line, 'columns' AS reason FROM (
         SELECT doc_id, doc_id || ',' || substring(md5(text), 1, 8) || CASE WHEN doc_id % 7 = 0 THEN ',more' ELSE '' END AS line
         FROM documents WHERE doc_id % 11 <> 0
         UNION ALL SELECT doc_id, doc_id::VARCHAR FROM documents WHERE doc_id % 11 = 0)
       WHERE doc_id % 7 = 0 OR doc_id % 11 = 0"""
)
def damaged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a CSV table that have a value too many or too few, out of its good rows' way."""
    more = F.when(F.col("doc_id") % 7 == 0, ",more").otherwise("")
    line = F.when(F.col("doc_id") % 11 == 0, F.col("doc_id").cast("string"))
    line = line.otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(","), F.left(F.md5("text"), F.lit(8)), more))
    path = scratch_path(spark, "damaged")
    X.documents(spark, sf_dir).select(line.alias("value")).write.text(path)
    return S.read_checked(spark, path, "doc_id bigint, digest string", header=False)[1]


@query(
    with_(
        [X.D_ARTICLES],
        f"""SELECT year, token, count(*) AS n
            FROM (SELECT substring(date_raw, 1, 4) AS year, unnest({_WORDS.format('summary')}) AS token
                  FROM (SELECT DISTINCT date_raw, title, summary FROM d_articles))
            WHERE year BETWEEN '2010' AND '2019' GROUP BY ALL""",
    )
)
def histogram_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly histogram added up from three batches, of which one is repeated and two are put together."""
    articles = X.d_articles(spark, sf_dir).select(
        F.col("date_raw").alias("Date"), F.col("title").alias("Title"), F.col("summary").alias("Snippet")
    )
    path = scratch_path(spark, "counts")
    dealt = F.pmod(F.xxhash64("Date", "Title", "Snippet"), F.lit(3))
    for batch in (0, 1, 1):
        add_to_histogram(articles.where(dealt == batch), path, f"batch{batch}")
    S.compact_counts(spark, path, "before")
    add_to_histogram(articles.where(dealt == 2), path, "batch2")
    return S.read_counts(spark, path)


@query(
    with_(
        [X.D_ARTICLES],
        """SELECT CASE doc_id % 3 WHEN 0 THEN 'tech' WHEN 1 THEN 'property' ELSE 'headlines' END AS site, url, raw AS date_raw,
             CASE doc_id % 3 WHEN 0 THEN make_date(2010 + doc_id % 12, 4, 1) WHEN 1 THEN make_date(2019, 1 + doc_id % 12, 7) END AS date,
             CASE WHEN doc_id % 3 < 2 THEN title END AS title, summary, CASE WHEN doc_id % 3 <> 1 THEN body END AS body
           FROM (SELECT *, CASE doc_id % 3 WHEN 0 THEN date_raw
                   WHEN 1 THEN '2019年' || lpad((1 + doc_id % 12)::VARCHAR, 2, '0') || '月07日'
                   ELSE '2019年' || (1 + doc_id % 12) || '月' END AS raw FROM d_articles)""",
    )
)
def common_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of three sites in their own shapes, as rows of the common one with typed dates."""
    a = X.d_articles(spark, sf_dir)
    month = 1 + F.col("doc_id") % 12
    tech = a.where("doc_id % 3 = 0").select(F.col("date_raw").alias("Date"), F.col("title").alias("Title"), F.col("summary").alias("Snippet"), F.col("url").alias("link"), F.col("body").alias("honbun"))
    day = X.cat("2019年", F.lpad(month.cast("string"), 2, "0"), "月07日")
    land = a.where("doc_id % 3 = 1").select(day.alias("Date"), F.col("title").alias("Title"), F.col("summary").alias("Summary"), F.col("url").alias("Link"))
    head = a.where("doc_id % 3 = 2").select(X.cat("2019年", month, "月").alias("Date"), F.col("summary").alias("Summary"), F.col("url").alias("Link"), F.col("body").alias("Detail"))
    return S.as_articles(tech, "tech").unionByName(S.as_articles(land, "property")).unionByName(S.as_articles(head, "headlines"))


@query(
    "SELECT doc_id, doc_id * 37 % 9883 AS page, (doc_id * 37 % 9883) // 1000 AS batch FROM documents"
)
def batch_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crawl of 9,883 pages saved by batches; the first batches are saved twice."""
    crawl = X.documents(spark, sf_dir).select("doc_id", (F.col("doc_id") * 37 % 9883).alias("page"))
    path = scratch_path(spark, "batches")
    S.write_batches(crawl, path)
    S.write_batches(crawl.where("page < 3000"), path)
    return spark.read.schema("doc_id bigint, page bigint, batch bigint").parquet(path)

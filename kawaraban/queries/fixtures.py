"""Tables derived from the driver's tables, in Spark and in SQL.

The driver's tables hold no Japanese, no site markup and no parsed sentences.
These rules make such tables out of them, row by row or in groups of fixed
size, so they grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kawaraban.functions import frames as C
from kawaraban.functions.dates import DAY_HEADING_SUFFIX, NEW_ARRIVALS
from kawaraban.operators.html import concat_in_order
from kawaraban.queries.base import q, table
from kawaraban.session import scratch_path
from kawaraban.sources import profiles as P
from kawaraban.sources.pages import page_source, write_pages

EN_ARCHIVE = f"{P.EN_BASE}/resources/archive/us/"
EN_ARTICLE = "http://www.reuters.com/article/idUS"
EN_VIDEO = "http://www.reuters.com/news/video?v="
TECH_LIST = f"{P.TECH_BASE}/technology/archive/?bn="
PROPERTY_LIST = f"{P.PROPERTY_BASE}/kn/NFM/"
DOCS_PER_DAY, DAYS_PER_YEAR, DOCS_PER_PAGE = 12, 28, 10


def escaped(c: Column) -> Column:
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(ref))
    return c


def sql_escaped(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def opening(s: P.Selector, more: str = "") -> str:
    """Opening mark of an element that a profile selects, with one more class."""
    names = {"class": " ".join(c for c in (s.class_exact or s.class_, more) if c), "id": s.el_id}
    return f"<{s.tag}" + "".join(f' {n}="{v}"' for n, v in names.items() if v) + ">"


def cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def div(c: str, n: int) -> Column:
    return F.floor(F.col(c) / n)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang")


SITE_BUCKETS = 32
_SITES: dict[tuple[str, ...], DataFrame] = {}


def stored_site(spark: SparkSession, sf_dir: str, *builders: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Derived pages as a stored page table in buckets of URLs, written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, *(b.__name__ for b in builders))
    if key not in _SITES:
        pages = [b(spark, sf_dir).select("page_id", "url", "html") for b in builders]
        path = scratch_path(spark, "pages")
        write_pages(reduce(DataFrame.unionByName, pages), path, SITE_BUCKETS)
        _SITES[key] = page_source(spark, path)
    return _SITES[key]


# --- article table ------------------------------------------------------------
def d_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.substring_index("text", "\n", 1)
    return documents(spark, sf_dir).select(
        "doc_id",
        cat("/a/", F.col("doc_id")).alias("url"),
        cat(2010 + F.col("doc_id") % 12, "/4/1 6:30 (x)").alias("date_raw"),
        first.alias("title"),
        first.alias("summary"),
        F.col("text").alias("body"),
    )


D_ARTICLES = """d_articles AS (
  SELECT doc_id, '/a/' || doc_id AS url, (2010 + doc_id % 12) || '/4/1 6:30 (x)' AS date_raw,
         split_part(text, chr(10), 1) AS title,
         split_part(text, chr(10), 1) AS summary, text AS body
  FROM documents)"""


def d_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the articles, and decoys that share only a date or only a title."""
    a = d_articles(spark, sf_dir).select("doc_id", "date_raw", "title")
    decoy = F.col("doc_id") % 20
    rows = F.array_compact(
        F.array(
            F.when(F.col("doc_id") % 3 == 0, F.struct("date_raw", "title")),
            F.when(decoy == 1, F.struct("date_raw", cat("decoy ", F.col("doc_id")).alias("title"))),
            F.when(decoy == 11, F.struct(F.lit("none").alias("date_raw"), "title")),
        )
    )
    return a.select(F.explode(rows).alias("r")).select("r.*")


D_STORED = """d_stored AS (
  SELECT date_raw, title FROM d_articles WHERE doc_id % 3 = 0
  UNION ALL SELECT date_raw, 'decoy ' || doc_id FROM d_articles WHERE doc_id % 20 = 1
  UNION ALL SELECT 'none', title FROM d_articles WHERE doc_id % 20 = 11)"""


# --- property listing -----------------------------------------------------------
def heading(g: Column) -> Column:
    """Heading of listing page g, NULL where it has none."""
    day = cat(g % 12 + 1, "月", g % 28 + 1, "日" + DAY_HEADING_SUFFIX)
    return (
        F.when(g % 11 == 5, F.lit(None))
        .when(g % 17 == 3, "特集")
        .when(g % 7 == 0, NEW_ARRIVALS)
        .otherwise(day)
    )


SQL_HEADING = f"""CASE WHEN g % 11 = 5 THEN NULL WHEN g % 17 = 3 THEN '特集'
  WHEN g % 7 = 0 THEN '{NEW_ARRIVALS}'
  ELSE (g % 12 + 1) || '月' || (g % 28 + 1) || '日{DAY_HEADING_SUFFIX}' END"""


#: A day that 2019 lacks, on every sixth page.
NO_DAY = "2月29日" + DAY_HEADING_SUFFIX


def odd_heading(g: Column) -> Column:
    return F.when(g % 6 == 1, NO_DAY).otherwise(heading(g))


SQL_ODD_HEADING = f"CASE WHEN g % 6 = 1 THEN '{NO_DAY}' ELSE {SQL_HEADING} END"


def d_listing(spark: SparkSession, sf_dir: str, headed: Callable[[Column], Column] = heading) -> DataFrame:
    """pages(page_id, url, html): ten documents a page; every fifth page has no item list."""
    a = d_articles(spark, sf_dir).withColumn("g", div("doc_id", DOCS_PER_PAGE))
    summary = F.when(
        F.col("doc_id") % 13 != 0, cat(opening(P.PROPERTY_SUMMARY), escaped(F.col("summary")), "</p>")
    ).otherwise("")
    link = cat(
        '<a href="', F.col("url"), '"><h3>', escaped(F.col("title")), "</h3>", summary, "</a>"
    )
    pickup = F.col("doc_id") % 10 < 3
    a = a.select("g", "doc_id", pickup.alias("pickup"), link.alias("link"))
    pages = a.groupBy("g").agg(
        concat_in_order(
            F.col("doc_id"),
            F.when(F.col("pickup"), cat(opening(P.PROPERTY_PICKUP), F.col("link"), "</section>")),
        ).alias("pickups"),
        concat_in_order(
            F.col("doc_id"), F.when(~F.col("pickup"), cat("<li>", F.col("link"), "</li>"))
        ).alias("items"),
    )
    return pages.select(
        F.col("g").alias("page_id"),
        cat(PROPERTY_LIST, F.col("g")).alias("url"),
        cat(
            '<html><body><div id="top"></div>' + opening(P.PROPERTY_MAIN) + opening(P.PROPERTY_SECTION),
            F.coalesce(cat("<h2>", headed(F.col("g")), "</h2>"), F.lit("")),
            F.col("pickups"),
            F.when(F.col("g") % 5 == 4, "").otherwise(cat(opening(P.PROPERTY_LIST), F.col("items"), "</ul>")),
            "</section></div></body></html>",
        ).alias("html"),
    )


D_LISTING = f"""d_listing AS (
  SELECT g AS page_id, {q(PROPERTY_LIST)} || g AS url,
    '<html><body><div id="top"></div>{opening(P.PROPERTY_MAIN)}{opening(P.PROPERTY_SECTION)}'
    || coalesce('<h2>' || {SQL_HEADING} || '</h2>', '')
    || coalesce(string_agg('{opening(P.PROPERTY_PICKUP)}' || link || '</section>', '' ORDER BY doc_id)
                FILTER (doc_id % 10 < 3), '')
    || CASE WHEN g % 5 = 4 THEN '' ELSE '{opening(P.PROPERTY_LIST)}'
    || coalesce(string_agg('<li>' || link || '</li>', '' ORDER BY doc_id) FILTER (doc_id % 10 >= 3), '')
    || '</ul>' END || '</section></div></body></html>' AS html
  FROM (SELECT doc_id, doc_id // 10 AS g,
               '<a href="' || url || '"><h3>' || {sql_escaped('title')} || '</h3>'
               || CASE WHEN doc_id % 13 <> 0
                       THEN '{opening(P.PROPERTY_SUMMARY)}' || {sql_escaped('summary')} || '</p>' ELSE '' END
               || '</a>' AS link
        FROM d_articles)
  GROUP BY g)"""


# --- tech archive ---------------------------------------------------------------
def d_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages(page_id, url, html): one article page per document."""
    year = 2010 + F.col("doc_id") % 12
    lines = F.replace(escaped(F.col("text")), F.lit("\n"), F.lit("</p><p>"))
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("page_id"),
        cat(P.TECH_BASE, "/a/", F.col("doc_id")).alias("url"),
        cat(
            "<html><body><dl><dt>日時" + opening(P.TECH_TIME),
            year,
            "/4/1 6:30 (",
            year,
            "/4/1 7:00更新)</dd></dl>" + opening(P.TECH_BODY) + "<p>",
            lines,
            "</p></div></body></html>",
        ).alias("html"),
    )


D_DETAIL = f"""d_detail AS (
  SELECT doc_id AS page_id, {q(P.TECH_BASE)} || '/a/' || doc_id AS url,
    '<html><body><dl><dt>日時{opening(P.TECH_TIME)}' || (2010 + doc_id % 12) || '/4/1 6:30 ('
    || (2010 + doc_id % 12)
    || '/4/1 7:00更新)</dd></dl>{opening(P.TECH_BODY)}<p>'
    || replace({sql_escaped('text')}, chr(10), '</p><p>') || '</p></div></body></html>' AS html
  FROM documents)"""


def tech_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages(page_id, url, html): archive pages of ten items; every 19th has no title."""
    a = d_articles(spark, sf_dir).withColumn("g", div("doc_id", DOCS_PER_PAGE))
    item = cat(
        opening(P.TECH_ITEM, "a-cf"),
        F.when(
            F.col("doc_id") % 19 != 0,
            cat(opening(P.TECH_TITLE) + '<a href="', F.col("url"), '">', escaped(F.col("title")), "</a></span>"),
        ).otherwise(""),
        "<p>",
        escaped(F.col("summary")),
        '　<a href="/more">…続き</a></p></div>',
    )
    return (
        a.select("g", "doc_id", item.alias("item"))
        .groupBy("g")
        .agg(concat_in_order(F.col("doc_id"), F.col("item")).alias("items"))
        .select(
            F.col("g").alias("page_id"),
            cat(TECH_LIST, F.col("g") + 1).alias("url"),
            cat("<html><body>" + opening(P.TECH_MAIN), F.col("items"), "</div></body></html>").alias("html"),
        )
    )


# --- headline listing -----------------------------------------------------------
def ja_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages(page_id, url, html): ten items a page, each with a picture link and a text link.

    Every 23rd item lacks its summary, so later items of its page move up.
    """
    a = d_articles(spark, sf_dir).withColumn("g", div("doc_id", DOCS_PER_PAGE))
    href = cat('<a href="/article/id', F.col("doc_id"), '">')
    item = cat(
        "<time>2019年\n",
        F.col("doc_id") % 12 + 1,
        "月</time>",
        href,
        escaped(F.col("title")),
        "</a>",
        F.when(F.col("doc_id") % 23 != 0, cat("<p>", escaped(F.col("summary")), "</p>")).otherwise(""),
        '<a href="/picture/id',
        F.col("doc_id"),
        '"></a>',
    )
    return (
        a.select("g", "doc_id", item.alias("item"))
        .groupBy("g")
        .agg(concat_in_order(F.col("doc_id"), F.col("item")).alias("items"))
        .select(
            F.col("g").alias("page_id"),
            F.format_string(P.JA_ARCHIVE, F.col("g") + 1).alias("url"),
            cat("<html><body>" + opening(P.JA_LIST, "x"), F.col("items"), "</div></body></html>").alias("html"),
        )
    )


def ja_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages(page_id, url, html): body paragraphs; every 31st article is missing."""
    lines = F.replace(escaped(F.col("text")), F.lit("\n"), F.lit("<p>"))
    return documents(spark, sf_dir).where("doc_id % 31 <> 0").select(
        F.col("doc_id").alias("page_id"),
        cat(P.JA_BASE, "/article/id", F.col("doc_id")).alias("url"),
        cat(opening(P.EN_BODY) + "<p>", lines, "</div>").alias("html"),
    )


# --- English archive --------------------------------------------------------------
def _day(c: str = "doc_id") -> Column:
    return div(c, DOCS_PER_DAY)


def _day_key(day_no: Column) -> Column:
    year = 2016 + F.floor(day_no / DAYS_PER_YEAR)
    return cat(year, "01", F.lpad((day_no % DAYS_PER_YEAR + 1).cast("string"), 2, "0"))


SQL_DAY_KEY = "((2016 + day_no // 28) || '01' || lpad((day_no % 28 + 1)::VARCHAR, 2, '0'))"


def en_href(doc_id: Column) -> Column:
    return F.when(doc_id % 9 == 0, cat(EN_VIDEO, doc_id)).otherwise(cat(EN_ARTICLE, doc_id))


SQL_EN_HREF = f"CASE WHEN doc_id % 9 = 0 THEN {q(EN_VIDEO)} ELSE {q(EN_ARTICLE)} END || doc_id"


def d_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages(page_id, url, html): year pages of 28 days, day pages of 12 documents, article pages."""
    docs = documents(spark, sf_dir)
    linked = docs.select(
        _day().alias("day_no"), "doc_id", cat('<a href="', en_href(F.col("doc_id")), '">x</a>').alias("a")
    )
    days = (
        linked.groupBy("day_no")
        .agg(concat_in_order(F.col("doc_id"), F.col("a")).alias("links"))
        .select("day_no", _day_key(F.col("day_no")).alias("day"), "links")
    )
    day_pages = days.select(
        cat(EN_ARCHIVE, F.col("day"), ".html").alias("url"),
        cat(
            '<html><a href="/top">top</a>' + opening(P.EN_DAY), F.col("links"), "</div></html>"
        ).alias("html"),
    )
    year_links = docs.select(_day().alias("day_no")).distinct()
    year_pages = (
        year_links.withColumn("year", 2016 + F.floor(F.col("day_no") / DAYS_PER_YEAR))
        .withColumn("a", cat('<a href="/resources/archive/us/', _day_key(F.col("day_no")), '.html">d</a>'))
        .groupBy("year")
        .agg(concat_in_order(F.col("day_no"), F.col("a")).alias("links"))
        .select(
            cat(EN_ARCHIVE, F.col("year"), ".html").alias("url"),
            cat(
                "<html><body><p>",
                F.col("links"),
                '<p><a href="/info/disclaimer">d</a><a href="//thomsonreuters.com/">t</a>'
                '<div><a href="/outside">o</a></div></body></html>',
            ).alias("html"),
        )
    )
    # One article in seven has no paragraphs, one in 25 no text; one in 14 is missing.
    text = escaped(F.col("text"))
    body = (
        F.when(F.col("doc_id") % 25 == 4, F.lit("<p></p>"))
        .when(F.col("doc_id") % 7 == 5, text)
        .otherwise(cat('<p class="x">', F.replace(text, F.lit("\n"), F.lit("</p><p>"))))
    )
    articles = docs.where("doc_id % 14 <> 3 AND doc_id % 9 <> 0").select(
        cat(EN_ARTICLE, F.col("doc_id")).alias("url"),
        cat(opening(P.EN_BODY), body, "</div><p>after</p>").alias("html"),
    )
    return year_pages.unionByName(day_pages).unionByName(articles).withColumn("page_id", F.xxhash64("url"))


def year_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of all year pages."""
    year = 2016 + F.floor(_day() / DAYS_PER_YEAR)
    return documents(spark, sf_dir).select(cat(EN_ARCHIVE, year, ".html").alias("url")).distinct()


D_HOPS = f"""d_hops AS (
  SELECT doc_id, text, day_no, {SQL_DAY_KEY} AS day,
         {q(EN_ARCHIVE)} || (2016 + day_no // 28) || '.html' AS year_url,
         {q(EN_ARCHIVE)} || {SQL_DAY_KEY} || '.html' AS day_url,
         {SQL_EN_HREF} AS href
  FROM (SELECT doc_id, text, doc_id // 12 AS day_no FROM documents))"""


# --- days -------------------------------------------------------------------------
def day_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """links(day, href): every event is a listed article, every click a video."""
    href = F.when(F.col("event_type") == "click", EN_VIDEO).otherwise(EN_ARTICLE)
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("day"), cat(href, F.col("event_id")).alias("href")
    )


def day_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored articles, one row each: no file on every 5th day, else more or less complete."""
    d = F.dayofmonth("ts")
    click = F.col("event_type") == "click"
    stored = (
        F.when(d % 5 == 0, False)
        .when(d % 2 == 1, ~click & (F.col("event_id") % 10 > 0))
        .when(d % 4 == 0, True)
        .otherwise(~click & (F.col("event_id") % 50 > 0))
    )
    return table(spark, sf_dir, "events").where(stored).select(F.date_format("ts", "yyyyMMdd").alias("day"))


D_DAYS = """d_days AS (
  SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS listed,
         count(*) FILTER (event_type = 'click') AS video,
         count(*) FILTER (CASE WHEN day(ts) % 5 = 0 THEN false
                               WHEN day(ts) % 2 = 1 THEN event_type <> 'click' AND event_id % 10 > 0
                               WHEN day(ts) % 4 = 0 THEN true
                               ELSE event_type <> 'click' AND event_id % 50 > 0 END) AS kept
  FROM events GROUP BY 1)"""


# --- case frames --------------------------------------------------------------------
def d_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frames(sent_id, frame): one per event."""
    e, u = F.col("event_id"), F.col("user_id")
    frame = cat(
        "w/w:動:ガ/N/", u, "/", e % 20, "/0/", e,
        ";ヲ/C/", F.col("event_type"), "/", e % 7, "/0/", e,
        F.when(e % 9 == 0, "").otherwise(";ニ/U/-/-/-/-"),
        F.when(e % 5 == 0, cat(";ガ/C/x", u, "/", e % 11, "/0/", e)).otherwise(""),
    )
    return table(spark, sf_dir, "events").select(
        e.cast("string").alias("sent_id"), F.when(e % 50 != 0, frame).alias("frame")
    )


D_FRAMES = """d_frames AS (
  SELECT event_id, event_id::VARCHAR AS sent_id,
    CASE WHEN event_id % 50 <> 0 THEN
      'w/w:動:ガ/N/' || user_id || '/' || (event_id % 20) || '/0/' || event_id
      || ';ヲ/C/' || event_type || '/' || (event_id % 7) || '/0/' || event_id
      || CASE WHEN event_id % 9 = 0 THEN '' ELSE ';ニ/U/-/-/-/-' END
      || CASE WHEN event_id % 5 = 0
              THEN ';ガ/C/x' || user_id || '/' || (event_id % 11) || '/0/' || event_id ELSE '' END
    END AS frame
  FROM events)"""


# --- parsed sentences -----------------------------------------------------------------
WORD = r"[^\s/:;+]+"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sentences(sent_id, sentence, flavour): all sentences of each turn, numbered."""
    return (
        table(spark, sf_dir, "conversations")
        .select("conv_id", "turn", F.posexplode(F.split("text", "[.]")).alias("no", "sentence"))
        .select(
            cat(F.col("conv_id"), "-", F.col("turn"), "-", F.col("no")).alias("sent_id"),
            "sentence",
            (F.col("conv_id") % 3).cast("int").alias("flavour"),
        )
    )


SQL_TURNS = """turns AS (
  SELECT conv_id || '-' || turn || '-' || (no - 1) AS sent_id, parts[no] AS sentence, conv_id % 3 AS flavour
  FROM (SELECT conv_id, turn, string_split(text, '.') AS parts FROM conversations),
       unnest(range(1, len(parts) + 1)) AS t(no))"""


def _worded(sentences: DataFrame) -> DataFrame:
    """sent_id, flavour, w (words), n (their number), frame of sentences that have a word."""
    s = sentences.withColumn("w", F.regexp_extract_all("sentence", F.lit(WORD), F.lit(0)))
    s = s.withColumn("n", F.size("w")).where("n > 0")
    n, flavour = F.col("n"), F.col("flavour")
    long = (n > 8) & (flavour > 0)

    def word(i: Column) -> Column:
        return F.get("w", i)

    ga = F.when(long, F.when(flavour == 1, 3).otherwise(5)).otherwise(0)
    wo = F.when(long, F.when(flavour == 1, 5).otherwise(3)).otherwise(F.least(F.lit(1), n - 1))
    ni = F.when(long, F.when(flavour == 1, 7).otherwise(5)).when(n > 3, 2)
    frame = cat(
        word(n - 1), "/x:動:",
        F.when(n % 5 == 0, "ガ/U/-/-/-/-;").otherwise(""),
        "ガ/N/", word(ga), "/", ga, "/0/1;ヲ/C/", word(wo), "/", wo, "/0/1;ニ/",
        F.coalesce(cat("C/", word(ni), "/", ni, "/0/1"), F.lit("U/-/-/-/-")),
    )
    return s.select("sent_id", "flavour", "w", "n", F.when(n % 11 != 0, frame).alias("frame"))


def _phrase(token: Column, i: Column) -> list[Column]:
    """The fields of word ``i`` of a worded sentence as a phrase."""
    n, flavour = F.col("n"), F.col("flavour")
    root = i == n - 1
    verbal = i % 5 == 2
    parent = F.when(root, -1).otherwise(F.least(i + 1 + i % 2, n - 1))
    repname = F.when(i % 3 == 2, cat(token, "/x+", token, "/x")).otherwise(cat(token, "/x"))
    case = F.when(flavour == 1, C.WO).otherwise(C.NI)
    structure = cat(token, "/x:動:", case, "/C/", F.get("w", i - 1), "/0")
    entries = F.array_compact(
        F.array(
            F.when(root & F.col("frame").isNotNull(), F.struct(F.lit(C.FRAME_FEATURE).alias("key"), F.col("frame").alias("value"))),
            F.when(verbal, F.struct(F.lit(C.ARGUMENT_FEATURE).alias("key"), structure.alias("value"))),
        )
    )
    return [
        i.alias("bnst_id"),
        parent.cast("int").alias("parent_id"),
        token.alias("midasi"),
        repname.alias("repname"),
        repname.alias("normalized_repname"),
        cat(token, "/x").alias("head_repname"),
        cat(
            F.when(i % 4 == 1, f"<{C.PLACE_MARK}>").otherwise(""),
            F.when(verbal, C.VERBAL_MARK).otherwise(""),
        ).alias("fstring"),
        F.when(i % 7 == 3, F.create_map(F.lit(C.COUNTER_FEATURE), F.lit(C.BLOCK_COUNTER)))
        .otherwise(F.expr("map()").cast("map<string,string>"))
        .alias("features"),
        F.array(
            F.struct(
                i.alias("tag_id"),
                token.alias("midasi"),
                repname.alias("normalized_repname"),
                F.map_from_entries(entries).alias("features"),
            )
        ).alias("tags"),
        F.array(
            F.struct(
                token.alias("surface"),
                F.lit(C.NOUN).alias("pos"),
                F.when(i % 3 == 0, C.PROPER).otherwise("普通名詞").alias("pos1"),
                F.when(i % 6 == 0, C.REGION).otherwise("*").alias("pos2"),
            )
        ).alias("morphs"),
    ]


def parsed_sentences(sentences: DataFrame) -> DataFrame:
    """sent_id, phrases of sentences(sent_id, sentence, flavour): a stand-in for the external parser.

    Every word is a phrase.  ``flavour`` varies which phrases the frame names.
    """
    return _worded(sentences).select("sent_id", F.transform("w", lambda token, i: F.struct(*_phrase(token, i))).alias("phrases"))


def parsed(sentences: DataFrame) -> DataFrame:
    """The same as one row per phrase.

    Its fields are columns of the row, so Spark makes only those that are read.
    """
    words = _worded(sentences).select("*", F.posexplode("w").alias("_i", "_token"))
    return words.select("sent_id", *_phrase(F.col("_token"), F.col("_i")))


def d_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_sentences(turns(spark, sf_dir))


def d_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(turns(spark, sf_dir))


def sql_phrases(source: str) -> list[str]:
    """CTEs ``words``, ``ph`` (phrases as plain columns) and ``heads`` (roles by number)."""
    return [
        f"""words AS (
  SELECT sent_id, flavour, regexp_extract_all(sentence, {q(WORD)}) AS w FROM {source})""",
        """ph AS (
  SELECT sent_id, flavour, n, i, word, w[n] AS last_word,
         CASE WHEN i = n - 1 THEN -1 ELSE least(i + 1 + i % 2, n - 1) END AS parent_id,
         CASE WHEN i % 3 = 2 THEN word || word ELSE word END AS surface,
         i % 4 = 1 AS place, i % 5 = 2 AS verbal, i % 7 = 3 AS block,
         i % 3 = 0 AND i % 6 <> 0 AS proper,
         CASE WHEN i > 0 THEN w[i] END || CASE WHEN flavour = 1 THEN 'を' ELSE 'に' END AS arg
  FROM (SELECT sent_id, flavour, w, len(w) AS n, unnest(w) AS word,
               generate_subscripts(w, 1) - 1 AS i
        FROM words))""",
        """heads AS (
  SELECT sent_id, n, last_word, n % 11 <> 0 AS framed,
         CASE WHEN n > 8 AND flavour = 1 THEN 3 WHEN n > 8 AND flavour = 2 THEN 5 ELSE 0 END AS ga,
         CASE WHEN n > 8 AND flavour = 1 THEN 5 WHEN n > 8 AND flavour = 2 THEN 3
              ELSE least(1, n - 1) END AS wo,
         CASE WHEN n > 8 AND flavour = 1 THEN 7 WHEN n > 8 AND flavour = 2 THEN 5
              WHEN n > 3 THEN 2 END AS ni
  FROM ph WHERE i = 0)""",
    ]


# Roles by joins over phrase numbers; needs the CTEs of sql_phrases.
SQL_ROLES = """roles AS (
  SELECT h.sent_id,
    CASE WHEN framed THEN coalesce((
      SELECT string_agg(k.word, '' ORDER BY k.i DESC) FROM ph k
      WHERE k.sent_id = h.sent_id AND k.parent_id = h.ga AND NOT (g.proper AND NOT k.proper)), '')
      || g.surface ELSE '-' END AS ga,
    CASE WHEN framed THEN coalesce((
      SELECT string_agg(CASE WHEN k.verbal THEN coalesce(k.arg, '') ELSE '' END || k.word, '' ORDER BY k.i DESC)
      FROM ph k WHERE k.sent_id = h.sent_id AND k.parent_id = h.wo), '')
      || o.surface
      || coalesce((SELECT max(CASE WHEN contains(u.word, h.last_word) THEN '' ELSE u.surface END)
                   FROM ph u WHERE u.sent_id = h.sent_id AND u.i = o.parent_id), '')
      ELSE '-' END AS wo,
    CASE WHEN framed AND h.ni IS NOT NULL THEN coalesce((
      SELECT string_agg(coalesce(CASE WHEN k.block THEN (
               SELECT arg_min(c.word, c.i) FROM ph c WHERE c.sent_id = k.sent_id AND c.parent_id = k.i) END, '')
               || k.word, '' ORDER BY k.i DESC)
      FROM ph k WHERE k.sent_id = h.sent_id AND k.parent_id = h.ni), '')
      || n.surface ELSE '-' END AS ni,
    CASE WHEN framed THEN h.last_word ELSE '-' END AS verb,
    CASE WHEN framed THEN coalesce((
      SELECT string_agg(p.surface, '' ORDER BY p.i) FROM ph p
      WHERE p.sent_id = h.sent_id AND p.place), '') ELSE '-' END AS loc
  FROM heads h
  JOIN ph g ON g.sent_id = h.sent_id AND g.i = h.ga
  JOIN ph o ON o.sent_id = h.sent_id AND o.i = h.wo
  LEFT JOIN ph n ON n.sent_id = h.sent_id AND n.i = h.ni)"""

"""HTML selection over the page table and over derived listing pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kawaraban.functions.dates import DAY_HEADING, NEW_ARRIVALS
from kawaraban.functions.html import attribute, decode_entities
from kawaraban.operators import html as H
from kawaraban.operators.extract import headline_items, links_in, paragraph_text, property_items, section_headings
from kawaraban.operators.folds import contents
from kawaraban.operators.rows import complete_only, require, title_contains_any
from kawaraban.queries import fixtures as X
from kawaraban.queries.base import q, query, with_
from kawaraban.session import scratch_path
from kawaraban.sources import profiles as P
from kawaraban.sources.pages import archive_urls as page_urls, page_source, read_pages as look_up, write_pages

# --- SQL counterparts ------------------------------------------------------------
_TOKEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"""|<[a-z/!?](?:[^<>=]+|=\s*(?:"[^"]*"|'[^']*')?)*>|[^<]+|<"""
)


def sql_tokens(source: str, name: str = "tok") -> str:
    attr = r"""(?i)\s{}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

    def value(a: str) -> str:
        got = f"regexp_extract(text, {q(attr.format(a))}, 1)"
        return f"CASE WHEN kind = 'tag' THEN replace(trim(nullif({got}, ''), '\"'''), '&amp;', '&') END"

    return f"""{name} AS (
  SELECT page_id, pos, kind, text,
         CASE WHEN kind = 'tag' THEN lower(regexp_extract(text, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) END AS tag,
         kind = 'tag' AND starts_with(text, '</') AS is_close,
         {value('id')} AS el_id, {value('class')} AS class, {value('href')} AS href
  FROM (SELECT page_id, pos, text,
               CASE WHEN NOT starts_with(text, '<') OR text = '<' THEN 'text'
                    WHEN regexp_matches(text, '(?is)^<(script|style)\\b.*</') THEN 'raw'
                    WHEN regexp_matches(text, '^</?[A-Za-z]') THEN 'tag' ELSE 'comment' END AS kind
        FROM (SELECT page_id, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS pos
              FROM (SELECT page_id, regexp_extract_all(html, {q(_TOKEN)}) AS l FROM {source}))))"""


def sql_elements(tag: str, name: str, where: str = "true", tok: str = "tok") -> str:
    """Elements by depth; paragraphs end at their end tag or at the next block tag."""
    end = H.END_OF_PAGE
    if tag == "p":
        blocks = ", ".join(q(t) for t in H.BLOCK_TAGS)
        rows = f"""SELECT *, lead(pos) OVER w AS np, lead(tag = 'p' AND is_close) OVER w AS own
          FROM {tok} WHERE tag IN ({blocks}) WINDOW w AS (PARTITION BY page_id ORDER BY pos)"""
        return f"""{name} AS (
  SELECT page_id, pos AS start, CASE WHEN np IS NULL THEN {end} WHEN own THEN np + 1 ELSE np END AS stop,
         coalesce(own, false) AS closed, class, el_id, href
  FROM ({rows}) WHERE tag = 'p' AND NOT is_close AND {where})"""
    return f"""{name} AS (
  SELECT page_id, pos AS start, CASE WHEN own THEN np + 1 ELSE {end} END AS stop,
         coalesce(own, false) AS closed, class, el_id, href
  FROM (SELECT *, lead(pos) OVER w AS np, lead(is_close) OVER w AS own
        FROM (SELECT *, sum(CASE WHEN is_close THEN -1 ELSE 1 END)
                          OVER (PARTITION BY page_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS d
              FROM {tok} WHERE tag = {q(tag)})
        WINDOW w AS (PARTITION BY page_id, d + is_close::INT ORDER BY pos))
  WHERE NOT is_close AND {where})"""


_INSIDE = "i.page_id = o.page_id AND i.start > o.start AND i.start < o.stop"
_CLASS = "list_contains(regexp_split_to_array(class, '\\s+'), {})"


def page_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source(spark, f"{sf_dir}/pages.parquet")


def _ids(df: DataFrame, *more: str) -> DataFrame:
    """Positions as bigint."""
    return df.select("page_id", *[F.col(c).cast("bigint").alias(c) for c in ("start", "stop")], *more)


# --- pages -------------------------------------------------------------------------
@query(
    "SELECT url, length(html)::BIGINT AS n_chars, true AS fetched FROM pages "
    "UNION ALL SELECT url || '&gone', 0, false FROM pages WHERE page_id % 5 = 0"
)
def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, each asked for twice, and a missing one for each fifth."""
    pages = page_table(spark, sf_dir)
    missing = pages.where("page_id % 5 = 0").select(X.cat(F.col("url"), "&gone").alias("url"))
    wanted = pages.select("url").unionByName(pages.select("url")).unionByName(missing)
    path = scratch_path(spark, "pages")
    write_pages(pages, path)
    return look_up(wanted, page_source(spark, path)).select(
        "url", F.length("html").cast("bigint").alias("n_chars"), "fetched"
    )


@query(
    f"""SELECT i AS page, {q(X.TECH_LIST)} || i AS url
        FROM (SELECT unnest(range(1, (SELECT max(doc_id) // 10 + 2 FROM documents))) AS i)"""
)
def archive_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archive page for every ten documents."""
    last = X.documents(spark, sf_dir).agg(F.max(X.div("doc_id", 10))).first()[0]
    return page_urls(spark, X.TECH_LIST + "%d", 1, last + 2)


# --- tokens and elements --------------------------------------------------------------
@query(
    with_(
        [sql_tokens("pages")],
        "SELECT page_id, pos::BIGINT AS pos, kind, tag, is_close, class, href, text FROM tok",
    )
)
def html_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = H.html_tokens(page_table(spark, sf_dir))
    return tok.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), "kind", "tag", "is_close", "class", "href", "text"
    )


@query(
    with_(
        [sql_tokens("pages"), sql_elements("p", "el")],
        "SELECT page_id, start::BIGINT AS start, stop::BIGINT AS stop, closed FROM el",
    )
)
def elements_p(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(H.elements(H.html_tokens(page_table(spark, sf_dir)), "p"), "closed")


@query(
    with_(
        [sql_tokens("pages"), sql_elements("div", "el", _CLASS.format("'ad'"))],
        "SELECT page_id, start::BIGINT AS start, stop::BIGINT AS stop, class FROM el",
    )
)
def elements_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(H.elements(H.html_tokens(page_table(spark, sf_dir)), "div", class_="ad"), "class")


@query(
    with_(
        [X.D_ARTICLES, X.D_LISTING, sql_tokens("d_listing"), sql_elements("section", "el", f"class = {q(P.PROPERTY_SECTION.class_exact)}")],
        "SELECT page_id, start::BIGINT AS start, stop::BIGINT AS stop, class FROM el",
    )
)
def elements_class_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = H.html_tokens(X.d_listing(spark, sf_dir))
    return _ids(H.elements(tok, "section", class_exact=P.PROPERTY_SECTION.class_exact), "class")


@query(
    with_(
        [X.D_ARTICLES, X.D_LISTING, sql_tokens("d_listing"), sql_elements("div", "el", f"el_id = {q(P.PROPERTY_MAIN.el_id)}")],
        "SELECT page_id, start::BIGINT AS start, stop::BIGINT AS stop, el_id FROM el",
    )
)
def elements_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ids(H.elements(H.html_tokens(X.d_listing(spark, sf_dir)), "div", el_id=P.PROPERTY_MAIN.el_id), "el_id")


_ARTICLE_P = [sql_tokens("pages"), sql_elements("article", "o"), sql_elements("p", "i")]


@query(
    with_(
        _ARTICLE_P,
        f"""SELECT o.page_id, o.start::BIGINT AS article, i.start::BIGINT AS start,
                   least(i.stop, o.stop)::BIGINT AS stop
            FROM o JOIN i ON {_INSIDE}""",
    )
)
def article_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = H.nodes(H.html_tokens(page_table(spark, sf_dir)), ["article", "p"])
    pairs = H.inside(n, H.is_element("article"), H.is_element("p"))
    return _ids(pairs.withColumn("article", F.col("outer").cast("bigint")), "article")


@query(
    with_(
        _ARTICLE_P,
        f"SELECT o.page_id, o.start::BIGINT AS article, min(i.start)::BIGINT AS start FROM o JOIN i ON {_INSIDE} GROUP BY ALL",
    )
)
def first_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = H.html_tokens(page_table(spark, sf_dir))
    first = H.first_within(tok, ("article", H.is_element("article")), ("p", H.is_element("p")))
    return first.select(
        "page_id", F.col("outer").cast("bigint").alias("article"), F.col("start").cast("bigint").alias("start")
    )


@query(
    with_(
        [sql_tokens("pages")],
        "SELECT page_id, pos::BIGINT AS pos, href FROM tok WHERE tag = 'a' AND NOT is_close AND href IS NOT NULL",
    )
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = H.html_tokens(page_table(spark, sf_dir))
    links = tok.where((F.col("tag") == "a") & ~F.col("is_close"))
    links = links.select("page_id", F.col("pos").cast("bigint").alias("pos"), attribute(F.col("text"), "href").alias("href"))
    return require(links, "href").withColumn("href", decode_entities("href"))


# The references that occur in the page table; the ampersand must come last.
_SQL_DECODED = "replace(replace(replace(replace({}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


@query("SELECT doc_id AS page_id, replace(text, chr(10), '') AS text FROM documents")
def element_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded text of the body element of each article page."""
    return contents(X.d_detail(spark, sf_dir), P.TECH_BODY).select("page_id", "text")


@query(
    with_(
        [sql_tokens("pages"), sql_elements("p", "el")],
        """SELECT el.page_id, el.start::BIGINT AS start,
             string_agg(CASE WHEN t.text = '<br>' THEN '<br/>' WHEN t.kind = 'text' THEN replace(t.text, '&quot;', '"')
                             ELSE t.text END, '' ORDER BY t.pos)
             || CASE WHEN bool_and(el.closed) THEN '' ELSE '</p>' END AS markup
           FROM el JOIN tok t ON t.page_id = el.page_id AND t.pos >= el.start AND t.pos < el.stop
           GROUP BY el.page_id, el.start""",
    )
)
def element_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = contents(page_table(spark, sf_dir), P.Selector("p"), markup=True)
    return marked.select("page_id", F.col("start").cast("bigint").alias("start"), "markup")


@query(
    with_(
        _ARTICLE_P,
        f"""SELECT o.page_id, {_SQL_DECODED.format("string_agg(t.text, '' ORDER BY t.pos)")} AS text
            FROM o JOIN i ON {_INSIDE}
            JOIN tok t ON t.page_id = i.page_id AND t.kind = 'text' AND t.pos > i.start AND t.pos < least(i.stop, o.stop)
            GROUP BY o.page_id""",
    )
)
def article_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of all article paragraphs of each page, joined in page order."""
    return paragraph_text(page_table(spark, sf_dir), P.Selector("article"), key="page_id")


@query(
    with_(
        [sql_tokens("pages")],
        """SELECT page_id, (n // 2)::BIGINT AS ord, href
           FROM (SELECT page_id, href, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS n
                 FROM tok WHERE tag = 'a' AND NOT is_close AND href IS NOT NULL)
           WHERE n % 2 = 0""",
    )
)
def every_second_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = links_in(page_table(spark, sf_dir), P.Selector("body"), key="page_id")
    n = F.row_number().over(Window.partitionBy("page_id").orderBy("pos")) - 1
    return links.withColumn("n", n).where("n % 2 = 0").select(
        "page_id", F.floor(F.col("n") / 2).alias("ord"), "href"
    )


# --- derived listings -------------------------------------------------------------------
_PAGES = f"""listing AS (
  SELECT doc_id, doc_id // 10 AS g, title, summary, url, doc_id % 10 < 3 AS pickup FROM d_articles),
headed AS (SELECT *, {X.SQL_HEADING} AS heading FROM listing),
linked AS (
  SELECT * FROM headed WHERE heading IS NOT NULL AND heading <> '特集' AND (pickup OR g % 5 <> 4)),
items AS (SELECT * FROM linked WHERE doc_id % 13 <> 0)"""


def _headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_headings(X.d_listing(spark, sf_dir), P.PROPERTY_SECTION, key="page_id")


@query(
    f"SELECT g AS page_id, heading FROM (SELECT g, {X.SQL_HEADING} AS heading "
    "FROM (SELECT DISTINCT doc_id // 10 AS g FROM documents)) WHERE heading IS NOT NULL"
)
def require_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections that have a heading, with its text."""
    return require(_headings(spark, sf_dir), "heading").select("page_id", "heading")


@query(
    f"SELECT g AS page_id, heading FROM (SELECT g, {X.SQL_HEADING} AS heading "
    "FROM (SELECT DISTINCT doc_id // 10 AS g FROM documents)) "
    f"WHERE contains(heading, {q(DAY_HEADING)}) OR contains(heading, {q(NEW_ARRIVALS)})"
)
def title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = require(_headings(spark, sf_dir), "heading").select("page_id", "heading")
    return title_contains_any(named, [DAY_HEADING, NEW_ARRIVALS], "heading")


@query(
    with_(
        [X.D_ARTICLES, X.D_LISTING],
        """SELECT g AS page_id, doc_id, title, summary, url
           FROM (SELECT doc_id // 10 AS g, doc_id, title, url,
                        CASE WHEN doc_id % 13 <> 0 THEN summary END AS summary FROM d_articles)
           WHERE summary IS NOT NULL""",
    )
)
def complete_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that have a title, a summary and an address."""
    rows = X.d_articles(spark, sf_dir).select(
        X.div("doc_id", 10).alias("page_id"),
        "doc_id",
        "title",
        F.when(F.col("doc_id") % 13 != 0, F.col("summary")).alias("summary"),
        "url",
    )
    return complete_only(rows, ["title", "summary", "url"])


@query(
    with_(
        [X.D_ARTICLES, _PAGES],
        """SELECT g AS page_id, CASE WHEN pickup THEN 0 ELSE 1 END::BIGINT AS kind,
             row_number() OVER (PARTITION BY g ORDER BY pickup DESC, doc_id) AS ord, heading,
             title, url AS href FROM items""",
    )
)
def union_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pick-ups, then listed items, of every listing page, in page order."""
    items = property_items(X.d_listing(spark, sf_dir), key="page_id")
    ord_ = F.row_number().over(Window.partitionBy("page_id").orderBy("sec", "kind", "pos"))
    return items.select(
        "page_id", F.col("kind").cast("bigint").alias("kind"), ord_.cast("bigint").alias("ord"), "heading", "title", "href"
    )


@query(
    with_(
        [X.D_ARTICLES],
        """, t AS (SELECT doc_id // 10 AS g, doc_id % 12 + 1 AS m, doc_id,
                          row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS n FROM d_articles),
           s AS (SELECT doc_id // 10 AS g, summary,
                        row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS n
                 FROM d_articles WHERE doc_id % 23 <> 0)
           SELECT t.g AS page_id, t.n - 1 AS ord, '2019年' || m || '月' AS time, """
        + X.sql_escaped("s.summary")
        + """ AS summary, '/article/id' || t.doc_id AS href
           FROM t JOIN s ON s.g = t.g AND s.n = t.n""",
    )
)
def zip_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, summaries and links of headline pages, paired up to the shortest list."""
    items = headline_items(X.ja_listing(spark, sf_dir), key="page_id")
    return items.select("page_id", F.col("ord").cast("bigint").alias("ord"), "time", "summary", "href")

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sorted_rows import rows
from kawaraban.plans import refresh
from kawaraban.plans.roles import extract_roles
from kawaraban.queries import fixtures as X
from kawaraban.session import scratch_path, shared_dir, staged
from kawaraban.sources import pages as S, tables as T
from kawaraban.streaming.landing import ROW_SCHEMA, follow_property_listings, follow_property_rows, take_in_listings

SF = "/root/testdata/sf0.001"


def test_shared_dir_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_daily_replaces_only_given_days(spark, tmp_path):
    path = str(tmp_path / "daily")
    assert T.read_daily(spark, path) is None
    df = spark.createDataFrame([("20160101", "a"), ("20160101", "b"), ("20160102", "c")], "day string, text string")
    T.write_daily(df, path)
    T.write_daily(spark.createDataFrame([("20160101", "z")], df.schema), path)
    assert rows(T.read_daily(spark, path)) == [("20160101", "z"), ("20160102", "c")]


def test_whole_tables_are_replaced_by_rows_of_their_own(spark, tmp_path):
    path = str(tmp_path / "articles")
    assert T.read_articles(spark, path) is None
    df = spark.createDataFrame([("1", "a")], "Date string, Title string")
    T.write_articles(df, path, ("Title", "Date"))
    first = T.read_articles(spark, path)
    assert first.columns == ["Title", "Date"]
    T.write_articles(first.union(first), path)
    T.append_articles(df, path, ("Title", "Date"))
    assert T.read_articles(spark, path).count() == 3
    T.write_articles(T.read_articles(spark, path).distinct(), path)
    assert rows(T.read_articles(spark, path)) == [("a", "1")]


def test_days_are_replaced_and_added_to(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "Title string, day date"
    on = lambda n: dt.date(2019, 3, n) if n else None
    made = lambda *r: spark.createDataFrame([(t, on(n)) for t, n in r], schema)
    T.write_articles(made(("a", 1), ("b", 2), ("c", 0)), path, by="day")
    T.append_articles(made(("d", 1)), path, by="day")
    stored = T.read_articles(spark, path, schema)
    assert rows(stored, "Title") == [("a",), ("b",), ("c",), ("d",)]
    one = T.of_days(stored, staged(made(("x", 1)), "days"))
    assert rows(one, "Title") == [("a",), ("c",), ("d",)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "PartitionFilters: [isnull(day" in plan
    for _ in range(2):  # a retry replaces the same days
        stored = T.read_articles(spark, path, schema)
        T.write_articles(stored.where("day = '2019-03-01'").selectExpr("concat('new ', substring(Title, -1)) AS Title", "day"), path, by="day")
    assert rows(T.read_articles(spark, path, schema), "Title") == [("b",), ("c",), ("new a",), ("new d",)]


def test_a_failed_job_leaves_the_days_as_they_were(spark, tmp_path):
    path = str(tmp_path / "failed")
    df = spark.createDataFrame([("a", dt.date(2019, 3, 1))], "Title string, date date")
    T.write_articles(df, path, by="date")
    with pytest.raises(Exception, match="stop"):
        T.write_articles(df.withColumn("Title", F.raise_error(F.lit("stop")).cast("string")), path, by="date")
    assert rows(T.read_articles(spark, path), "Title") == [("a",)]


def test_common_record(spark):
    df = spark.createDataFrame([("2013/4/1 6:30", "l"), ("2019年03月08日", "m"), ("2019年3月", None), (None, "n"), ("2019/2/29", "o")], "Date string, link string")
    got = T.as_articles(df, "s")
    assert got.columns == ["site", "url", "date_raw", "date", "title", "summary", "body"]
    assert [r["date"] for r in got.collect()] == [dt.date(2013, 4, 1), dt.date(2019, 3, 8), None, None, None]


def test_counts_of_batches(spark, tmp_path):
    path = str(tmp_path / "counts")
    counts = lambda *r: spark.createDataFrame(r, "year string, token string, n bigint")
    assert T.read_counts(spark, path) is None
    T.add_counts(counts(("2010", "a", 1), ("2011", "a", 2)), path, "x")
    T.add_counts(counts(("2010", "a", 5)), path, "y")
    T.add_counts(counts(("2010", "a", 4), ("2010", "b", 1)), path, "y")
    want = [("2010", "a", 5), ("2010", "b", 1), ("2011", "a", 2)]
    assert rows(T.read_counts(spark, path)) == want
    T.compact_counts(spark, path, "all")
    assert rows(T.read_counts(spark, path)) == want
    assert rows(spark.read.parquet(path).select("batch").distinct()) == [("all",)]


def test_damaged_lines(spark, tmp_path):
    path = str(tmp_path / "damaged.csv")
    with open(path, "w") as f:
        f.write('Date,Title\n1,a%0Ab\n2\n3,b,c\n"4","d, ""e"""\n')
    good, bad = T.read_checked(spark, path, "Date string, Title string")
    assert rows(good) == [("1", "a\nb"), ("4", 'd, "e"')]
    assert rows(bad) == [("2", "columns"), ("3,b,c", "columns")]


def test_first_write_may_be_an_addition(spark, tmp_path):
    path = str(tmp_path / "added")
    T.append_articles(spark.range(2), path)
    T.append_articles(spark.range(3), path)
    assert T.read_articles(spark, path).count() == 5


def test_csv_keeps_newlines_and_quotes(spark, tmp_path):
    path = str(tmp_path / "csv")
    schema = "Date string, Title string"
    df = spark.createDataFrame([("1", 'a\n"b", c%0A\r\n'), ("2", "\\d")], schema)
    T.write_articles(df, path, fmt="csv")
    assert rows(T.read_articles(spark, path, schema, "csv")) == rows(df)


def test_batches_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "batches")
    df = spark.range(2500).withColumnRenamed("id", "page")
    T.write_batches(df, path)
    T.write_batches(df.where("page < 1000"), path)
    assert spark.read.parquet(path).groupBy("batch").count().orderBy("batch").collect() == [
        (0, 1000), (1, 1000), (2, 500)
    ]


def test_histogram_by_year_folders(spark, tmp_path):
    path = str(tmp_path / "hist")
    df = spark.createDataFrame(
        [("2010/1", "a b a"), ("2012/1", "c"), ("2012/1", "c"), ("1999/1", "x")], "Date string, Snippet string"
    )
    refresh.save_histogram(df, path)
    saved = spark.read.schema("token string, n bigint, year string").parquet(path)
    assert rows(saved, "year", "token", "n") == [("2010", "a", 2), ("2010", "b", 1), ("2012", "c", 1)]


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", "old"), (2, "u", "new"), (3, "v", "x")], "page_id bigint, url string, html string"
    )
    latest = S.latest_pages(pages)
    urls = spark.createDataFrame([("u",), ("u",), ("gone",)], "url string")
    assert rows(S.read_pages(urls, latest)) == [("gone", "", False), ("u", "new", True)]
    assert rows(S.archive_urls(spark, "p=%d", 1, 3)) == [(1, "p=1"), (2, "p=2")]


def test_daily_corpus_is_stable(spark, tmp_path):
    path = str(tmp_path / "corpus")
    pages, years = X.d_hops(spark, SF), X.year_seeds(spark, SF)
    refresh.refresh_daily_corpus(spark, path, pages, years)
    once = rows(T.read_daily(spark, path))
    refresh.refresh_daily_corpus(spark, path, pages, years)
    assert once and rows(T.read_daily(spark, path)) == once
    counts = {d: n for d, n in rows(T.read_day_counts(spark, path), "day", "stored_lines")}
    assert sum(counts.values()) == len(once)
    # The site's own links are no days.
    assert not {d for d, _ in once if not d.isdigit()}


def test_day_counts_take_no_folder_per_day(spark, tmp_path):
    path = str(tmp_path / "corpus")
    assert T.read_day_counts(spark, path) is None
    counts = spark.range(300).selectExpr("cast(20160000 + id AS string) AS day", "id AS stored_lines")
    T.write_day_counts(counts, path)
    T.write_day_counts(counts.where("stored_lines < 10").withColumn("stored_lines", F.lit(0)), path)
    made = list((tmp_path / "corpus-counts").rglob("*.parquet"))
    assert len(made) < 50 and {f.parent for f in made} == {tmp_path / "corpus-counts"}
    want = [(str(20160000 + i), 0 if i < 10 else i) for i in range(300)]
    assert rows(T.read_day_counts(spark, path), "day", "stored_lines") == want


def test_days_without_articles_are_not_fetched_for_ever(spark, tmp_path):
    path = str(tmp_path / "few")
    year = ("y", '<p><a href="https://www.reuters.com/d/20160101.html">d</a></p>')
    day = ("https://www.reuters.com/d/20160101.html", '<div class="headlineMed"><a href="a1">x</a><a href="a2">x</a></div>')
    article = ("a1", '<div class="StandardArticleBody_body"><p>text</p></div>')

    def refreshed(*pages):
        df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")
        refresh.refresh_daily_corpus(spark, path, df, spark.createDataFrame([("y",)], "url string"))
        return rows(T.read_daily(spark, path) or spark.createDataFrame([], "day string, text string")), rows(T.read_day_counts(spark, path), "day", "stored_lines")

    assert refreshed(year, day) == ([], [("20160101", 0)])
    # Fewer than ten links are missing, so the day is not due, though its pages are there now.
    assert refreshed(year, day, article) == ([], [("20160101", 0)])
    many = (day[0], '<div class="headlineMed">' + '<a href="a1">x</a>' * 10 + "</div>")
    found, counts = refreshed(year, many, article)
    assert found == [("20160101", "text")] * 10 and counts == [("20160101", 10)]
    # A day that became empty loses its articles.
    more = (day[0], '<div class="headlineMed">' + '<a href="gone">x</a>' * 30 + "</div>")
    assert refreshed(year, more) == ([], [("20160101", 0)])


def _roles(sentences):
    return extract_roles(X.parsed(sentences.withColumn("flavour", F.lit(0))))


def test_property_table_is_stable(spark, tmp_path):
    path = str(tmp_path / "property")
    pages = X.d_listing(spark, SF)
    today = dt.date(2019, 3, 8)
    some = pages.where("page_id % 2 = 0")
    assert refresh.refresh_property_table(spark, path, some, 2019, today, _roles)
    first = rows(T.read_articles(spark, path))
    assert not refresh.refresh_property_table(spark, path, some, 2019, today, _roles)
    assert refresh.refresh_property_table(spark, path, pages, 2019, today, _roles)
    both = T.read_articles(spark, path)
    assert both.columns == [*T.PROPERTY_COLUMNS, *T.PROPERTY_ROLE_COLUMNS, "day"]
    before = rows(both)
    assert len(first) < len(before) and set(first) <= set(before)
    assert refresh.redo_property_table(spark, path, _roles)
    again = T.read_articles(spark, path)
    assert rows(again) == before
    refresh.compact_property_days(spark, path, again.select("day").distinct())
    assert rows(T.read_articles(spark, path)) == before
    assert not refresh.redo_property_table(spark, path + "-none", _roles)


def test_copies_of_a_page_and_invalid_days(spark, tmp_path):
    path = str(tmp_path / "copies")
    section = (
        '<div id="mainContent"><section class="section article-index"><h2>{}</h2><section class="pickup-nfm">'
        '<a href="/{}"><h3>{}</h3><p class="summary">s。</p></a></section></section></div>'
    )
    pages = spark.createDataFrame(
        [
            (1, "u", section.format("3月1日のニュース一覧", "old", "old")),
            (2, "u", section.format("3月1日のニュース一覧", "a", "A")),
            (3, "v", section.format("2月29日のニュース一覧", "b", "B")),
            (4, "w", section.format("3月1日のニュース一覧", "c", "A")),
        ],
        "page_id bigint, url string, html string",
    )
    today = dt.date(2019, 3, 8)
    for _ in range(3):
        changed = refresh.refresh_property_table(spark, path, pages, 2019, today, _roles)
    assert not changed
    assert rows(T.read_articles(spark, path), "Date", "Title", "Link") == [("2019年03月01日", "A", "https://tech.nikkeibp.co.jp/a")]
    assert rows(T.read_articles(spark, path + "-rejected"), "title", "reason") == [("B", "date_raw")]


def test_streamed_listings_make_the_same_table(spark, tmp_path):
    pages = X.d_listing(spark, SF)
    today = dt.date(2019, 3, 8)
    landing, path, batch = (str(tmp_path / n) for n in ("landing", "table", "batch"))
    pages.repartition(3).write.parquet(landing)
    asked = []
    for _ in range(2):
        follow_property_listings(
            spark, landing, path, str(tmp_path / "cp"), _roles, lambda: asked.append(1) or today, once=True, max_files=1
        ).awaitTermination()
    assert len(asked) == 3
    refresh.refresh_property_table(spark, batch, pages, 2019, today, _roles)
    # Which of two pages with the same date and title comes first depends on the batches; all else is equal.
    streamed, whole = T.read_articles(spark, path), T.read_articles(spark, batch)
    keys = ("Date", "Title")
    assert rows(streamed, *keys) == rows(whole, *keys)
    assert not {k for k, n in Counter(rows(whole, *keys)).items() if n > 1}


def test_rows_seen_lately_are_dropped_by_state(spark, tmp_path, monkeypatch):
    pages = X.d_listing(spark, SF)
    today = dt.date(2019, 3, 8)
    landing, listed, path, whole = (str(tmp_path / n) for n in ("landing", "listed", "table", "whole"))
    given = []

    def counted(batch, *rest):
        given.append(batch.count())
        return refresh.add_listed(batch, *rest)

    monkeypatch.setattr("kawaraban.streaming.landing.add_listed", counted)

    def take_in(part, rows_checkpoint="rows"):
        part.write.mode("append").parquet(landing)
        take_in_listings(spark, landing, listed, path + "-rejected", str(tmp_path / "pages"), lambda: today, once=True).awaitTermination()
        follow_property_rows(spark, listed, path, str(tmp_path / rows_checkpoint), _roles, once=True).awaitTermination()
        found, given[:] = sum(given), []
        return found

    early, late = pages.where("page_id % 3 > 0"), pages.where("page_id % 3 = 0")
    assert take_in(early) > 0
    before = rows(T.read_articles(spark, path))
    # The same pages again, after a restart: nothing of them reaches the stored table.
    assert take_in(early) == 0
    assert rows(T.read_articles(spark, path)) == before
    # A late page's rows do.
    assert take_in(late.unionByName(early)) > 0
    refresh.refresh_property_table(spark, whole, pages, 2019, today, _roles)
    after = rows(T.read_articles(spark, path), "Date", "Title")
    assert after == rows(T.read_articles(spark, whole), "Date", "Title")
    # Without its state the query goes by the stored table.
    assert take_in(late.limit(0), "anew") > 0
    assert rows(T.read_articles(spark, path), "Date", "Title") == after


def test_rows_may_be_followed_before_any_came(spark, tmp_path):
    listed, path = str(tmp_path / "listed"), str(tmp_path / "table")
    follow_property_rows(spark, listed, path, str(tmp_path / "rows"), _roles, once=True).awaitTermination()
    assert T.read_articles(spark, path) is None
    row = spark.createDataFrame([("u", 0, 0, 0, "2019年03月01日", "t", "s。", "v")], ROW_SCHEMA)
    T.append_articles(row, listed)
    follow_property_rows(spark, listed, path, str(tmp_path / "rows"), _roles, once=True).awaitTermination()
    assert rows(T.read_articles(spark, path), "Date", "Title", "Link") == [("2019年03月01日", "t", "v")]


def test_rows_with_state_are_stored_in_few_files(spark, tmp_path):
    listed, path = str(tmp_path / "listed"), str(tmp_path / "table")
    made = [("u", 0, 0, i, f"2019年03月0{1 + i % 3}日", f"t{i}", f"s{i}。", "v") for i in range(60)]
    T.append_articles(spark.createDataFrame(made, ROW_SCHEMA), listed)
    follow_property_rows(spark, listed, path, str(tmp_path / "rows"), _roles, once=True).awaitTermination()
    stored = T.read_articles(spark, path)
    assert stored.count() == 60
    # One file a day, not one for each task and day.
    assert len(stored.inputFiles()) == 3

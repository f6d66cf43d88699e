from pyspark.sql import functions as F

from sorted_rows import rows
from kawaraban.operators import joins as J, rows as R
from kawaraban.plans.histogram import yearly_histogram


def test_unseen_rules(spark):
    new = spark.createDataFrame([("1", "a"), ("2", "x"), ("1", "b"), ("3", "b")], "date_raw string, title string")
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "date_raw string, title string")
    assert rows(J.unseen(new, old)) == [("1", "b"), ("2", "x"), ("3", "b")]
    assert rows(J.unseen(new, old, "independent")) == [("2", "x"), ("3", "b")]
    none = old.where("false")
    assert J.unseen(new, none).count() == J.unseen(new, none, "independent").count() == 4


def test_unseen_and_seen_make_all(spark):
    new = spark.range(3000).selectExpr("cast(id % 7 AS string) date_raw", "cast(id AS string) title", "id")
    old = spark.range(0, 3000, 5).selectExpr("cast(id % 7 AS string) date_raw", "cast(id AS string) title")
    left = J.unseen(new, old)
    seen = new.join(old, ["date_raw", "title"], "left_semi")
    assert left.count() == 2400
    assert rows(left.union(seen.select(left.columns))) == rows(new)


def test_null_keys_are_seen(spark):
    new = spark.createDataFrame([(None, "a"), (None, "b"), ("1", None)], "date_raw string, title string")
    old = spark.createDataFrame([(None, "a"), ("1", None)], "date_raw string, title string")
    assert rows(J.unseen(new, old)) == [(None, "b")]
    assert J.unseen(new, old, "independent").collect() == [(None, "b")]


def test_a_key_of_half_the_rows_is_split(spark):
    """A sort-merge join whose left side has one key in half of its rows, which Spark deals out anew."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(200_000, numPartitions=8).selectExpr("if(id % 2 = 0, 'hot', concat('k', id)) url", "sha2(string(id), 256) v")
        right = spark.range(1000).selectExpr("concat('k', 2 * id + 1) url", "id w").union(spark.createDataFrame([("hot", -1)], "url string, w bigint"))
        joined = J.attach_detail(left, right)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max("v")).collect()]
        assert sum(sizes) == 200_000 and max(sizes) < 50_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_zip_lists_stops_at_the_shortest(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b", "c"], [1, 2]), (2, [], [1]), (3, None, [1]), (4, ["x"], [9])],
        "id int, l array<string>, n array<int>",
    )
    assert rows(J.zip_lists(df, ["l", "n"])) == [(1, 0, "a", 1), (1, 1, "b", 2), (4, 0, "x", 9)]


def test_days_to_refresh_rule(spark):
    listed = spark.createDataFrame(
        [("new", 3, 0), ("behind", 30, 5), ("close", 30, 6), ("more", 5, 0)], "day string, listed bigint, video bigint"
    )
    stored = spark.createDataFrame(
        [("behind", 15), ("close", 15), ("more", 9)], "day string, stored_lines bigint"
    )
    assert rows(J.days_to_refresh(listed, stored), "day") == [("behind",), ("new",)]


def test_page_slice(spark):
    df = spark.range(100).selectExpr("id", "id % 2 AS g")
    assert rows(J.page_slice(df, 2, 3, 10, ["id"]), "id") == [(i,) for i in range(10, 30)]
    by = J.page_slice(df, 1, 2, 3, ["id"], by=["g"])
    assert rows(by.where("g = 1"), "id", "page") == [(1, 1), (3, 1), (5, 1), (7, 2), (9, 2), (11, 2)]


def test_deep_pages_need_no_window_of_a_whole_group(spark):
    df = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, null, 'g') AS g").repartition(3)
    deep = J.page_slice(df, 151, 152, 100, ["id"], by=["g"])
    want = [i for i in range(20_000) if i % 10][15_000:15_200]
    assert rows(deep.where("g = 'g'"), "id") == [(i,) for i in want]
    assert {p for _, p in rows(deep, "id", "page")} == {151, 152}
    plan = deep._jdf.queryExecution().executedPlan().toString()
    ranks = [w for w in plan.split("windowspecdefinition(")[1:] if "ROW" not in w.split(")")[0] and "_range#" in w.split(",")[0]]
    assert "WindowGroupLimit" not in plan and ranks


def test_expand_links(spark):
    seed = spark.createDataFrame([("y",)], "url string")
    links = spark.createDataFrame(
        [("y", 1, "d1"), ("y", 2, "d2"), ("d1", 1, "a"), ("d1", 2, "b"), ("z", 1, "c")], "url string, pos int, href string"
    )
    assert rows(J.expand_links(seed, links, 2), "url_0", "url_1", "url_2", "pos_2") == [("y", "d1", "a", 1), ("y", "d1", "b", 2)]


def test_document_order(spark):
    df = spark.createDataFrame([(2, 1), (1, 9), (1, 2)], "page_id int, pos int")
    assert [tuple(r) for r in R.order_by_doc(df, "page_id", "pos").collect()] == [(1, 2), (1, 9), (2, 1)]


def test_filters(spark):
    df = spark.createDataFrame(
        [("/info/disclaimer", "2009/1"), ("//thomsonreuters.com/", "2010/2"), ("http://h/news/video/1", "2019/3"), ("/d", None)],
        "href string, date_raw string",
    )
    assert rows(R.exclude_links(df), "href") == [("/d",), ("http://h/news/video/1",)]
    assert rows(R.drop_matching_urls(df, col="href").where("href = '/d'"), "href") == [("/d",)]
    assert rows(R.by_year(df), "year") == [("2010",), ("2019",)]
    good, bad = R.with_errors(df, ["href", "date_raw"])
    assert good.count() == 3 and rows(bad, "href", "reason") == [("/d", "date_raw")]
    arr = spark.createDataFrame([(list("abcde"),)], "l array<string>").select(R.every_nth(F.col("l"), 2).alias("l"))
    assert arr.first()["l"] == ["a", "c", "e"]


def test_histogram_of_analysed_tokens(spark):
    df = spark.createDataFrame(
        [("2010/1", "t", [("東京", "名詞"), ("行く", "動詞")]), ("2010/1", "t", [("東京", "名詞"), ("行く", "動詞")]),
         ("2011/1", "u", [("東京", "名詞"), ("東京", "名詞")]), ("2020/1", "v", [("東京", "名詞")])],
        "date_raw string, title string, toks array<struct<surface:string,pos:string>>",
    )
    h = yearly_histogram(df, tokens="toks", keep="名詞")
    assert rows(h, "year", "token", "n") == [("2010", "東京", 1), ("2011", "東京", 2)]

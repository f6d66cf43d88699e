"""Role rules on hand-made trees."""

from collections import Counter

from pyspark.sql import functions as F

from sorted_rows import rows
from kawaraban.operators import phrases as PH
from kawaraban.plans.roles import extract_roles, roles_of_sentences
from kawaraban.queries import fixtures as X
from kawaraban.queries.sentences import dealt


def phrase(sent, i, parent, word, repname=None, *, norm=None, head=None, fstring="", counter=None,
           frame=None, structure=None, proper=False, region=False):
    repname = repname or f"{word}/x"
    feats = {k: v for k, v in (("格解析結果", frame), ("項構造", structure)) if v}
    return (
        sent, i, parent, word, repname, norm or repname, head or repname, fstring,
        {"カウンタ": counter} if counter else {},
        [(i, word, repname, feats)],
        [(word, "名詞", "固有名詞" if proper else "普通名詞", "地域" if region else "*")],
    )


def roles(spark, *phrases):
    df = spark.createDataFrame(list(phrases), PH.PHRASE_SCHEMA)
    return {r[0]: tuple(r[1:]) for r in extract_roles(df).collect()}


def frame(ga="U/-/-", wo="U/-/-", ni="U/-/-", word="取得"):
    return f"{word}/y:動2:ガ/{ga}/0/1;ヲ/{wo}/0/1;ニ/{ni}/0/1"


def test_plain_sentence(spark):
    got = roles(
        spark,
        phrase("s", 0, 2, "会社が", "特定/a+会社/b"),
        phrase("s", 1, 2, "ビルを", "ビル/b", fstring="<地名>"),
        phrase("s", 2, -1, "取得した", head="取得/しゅとく", frame=frame("C/会社/0", "C/ビル/1")),
    )
    assert got["s"] == ("特定会社", "ビル", "-", "取得", "ビル")


def test_no_frame_and_no_root(spark):
    got = roles(
        spark,
        phrase("s", 0, 1, "会社が", fstring="<地名>"),
        phrase("s", 1, -1, "に"),
        phrase("t", 0, 1, "x", frame=frame("C/x/0")),
    )
    assert got == {"s": ("-",) * 5, "t": ("-",) * 5}


def test_missing_and_unmatched_slots(spark):
    got = roles(spark, phrase("s", 0, -1, "した", head="為る/する", frame="した/する:動:ガ/C/無い/0/0/1;ヲ/C/した/9/0/1"))
    assert got["s"] == ("-", "-", "-", "為る", "")


def test_last_root_and_last_slot_win(spark):
    got = roles(
        spark,
        phrase("s", 0, 2, "甲"),
        phrase("s", 1, -1, "乙", frame=frame("C/乙/1")),
        phrase("s", 2, -1, "丙", head="丙/x", frame="丙/x:動:ガ/C/乙/1/0/1;ガ/C/甲/0/0/1"),
    )
    assert got["s"][0] == "甲" and got["s"][3] == "丙"


def test_children_come_in_front_nearest_last(spark):
    got = roles(
        spark,
        phrase("s", 0, 2, "韓国籍の"),
        phrase("s", 1, 2, "複数の"),
        phrase("s", 2, 3, "投資家が", "投資家/x"),
        phrase("s", 3, -1, "取得", frame=frame("C/投資家/2")),
    )
    assert got["s"][0] == "複数の韓国籍の投資家"


def test_proper_ga_keeps_only_proper_children(spark):
    got = roles(
        spark,
        phrase("s", 0, 3, "大きな"),
        phrase("s", 1, 3, "モルガンの", proper=True),
        phrase("s", 2, 3, "東京の", proper=True, region=True),
        phrase("s", 3, 4, "大京", proper=True),
        phrase("s", 4, -1, "取得", frame=frame("C/大京/3")),
    )
    assert got["s"][0] == "モルガンの大京"


def test_wo_takes_its_parent_and_verbal_child(spark):
    got = roles(
        spark,
        phrase("s", 0, 1, "有明に"),
        phrase("s", 1, 2, "ある", fstring="<用言:動>", structure="有る/ある:動3:ガ/N/ビル/2;ニ/C/有明/0"),
        phrase("s", 2, 3, "持分", "持分/x"),
        phrase("s", 3, 4, "五割を", "五割/x", norm="５/x+割/x"),
        phrase("s", 4, -1, "取得した", frame=frame(wo="C/持分/2")),
    )
    assert got["s"][1] == "有明にある持分５割"


def test_wo_falls_back_to_the_object_of_a_verbal_child(spark):
    got = roles(
        spark,
        phrase("s", 0, 1, "営む", fstring="<用言:動>", structure="営む/x:動:ヲ/C/店/9"),
        phrase("s", 1, 2, "ビルを", "ビル/x"),
        phrase("s", 2, -1, "取得した", frame=frame(wo="C/ビル/1")),
    )
    assert got["s"][1] == "店を営むビル"


def test_ni_with_a_street_block(spark):
    got = roles(
        spark,
        phrase("s", 0, 2, "渋谷区道玄坂"),
        phrase("s", 1, 2, "別の"),
        phrase("s", 2, 4, "２丁目の", counter="丁目"),
        phrase("s", 3, 4, "新しい"),
        phrase("s", 4, 5, "渋谷ソラスタに", "渋谷/x+ソラスタ/x"),
        phrase("s", 5, -1, "移転する", frame=frame(ni="C/渋谷ソラスタ/4", word="移転")),
    )
    assert got["s"][2] == "新しい渋谷区道玄坂２丁目の渋谷ソラスタ"


def test_roles_match_the_table_operators(spark):
    df = spark.createDataFrame(
        [
            phrase("s", 0, 2, "甲", fstring="<地名>"),
            phrase("s", 1, 2, "乙", fstring="<地名>"),
            phrase("s", 2, -1, "丙", frame=frame("C/甲/0", "C/乙/1", word="丙")),
        ],
        PH.PHRASE_SCHEMA,
    )
    slots = PH.last_slots(PH.slots_long(PH.root_of(df)))
    assert rows(PH.match_head(slots, df), "case", "midasi") == [("ガ", "甲"), ("ヲ", "乙")]
    assert rows(PH.location_of(df)) == [("s", "甲乙")]
    targets = df.select("sent_id", "bnst_id", "midasi", "parent_id")
    assert rows(PH.concat_children(PH.children_of(targets, df), "midasi"), "text") == [("乙甲丙",)]
    ordered = PH.concat_children(PH.children_of(targets, df), "midasi", reverse=False)
    assert rows(ordered, "text") == [("甲乙丙",)]
    assert rows(PH.parent_of(targets, df).na.fill("none"), "midasi", "parent") == [("丙", "none"), ("乙", "丙"), ("甲", "丙")]


def test_roles_are_expressions_over_a_row(spark):
    df = spark.createDataFrame([phrase("s", 0, -1, "x")], PH.PHRASE_SCHEMA)
    plan = extract_roles(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan
    stored = spark.createDataFrame(PH.gathered(df).collect(), PH.gathered(df).schema)
    plan = roles_of_sentences(stored)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Exchange", "Aggregate", "Window", "Join", "Sort"))


def test_phrases_in_any_order(spark):
    tree = [phrase("s", 0, 12, "甲", fstring="<地名>"), *[phrase("s", i, 0, f"k{i}") for i in range(1, 12)],
            phrase("s", 12, -1, "丙", frame=frame("C/甲/0", word="丙"))]
    assert roles(spark, *tree) == roles(spark, *reversed(tree))
    assert roles(spark, *reversed(tree))["s"][0] == "".join(f"k{i}" for i in range(11, 0, -1)) + "甲"


def _turns(spark, n=40):
    text = "one two three four five six seven eight nine ten eleven. a b c d e. x"
    rows = [(f"{i}-0-{k}", s, i % 3) for i in range(n) for k, s in enumerate(text.split("."))]
    return spark.createDataFrame([*rows, ("none", "", 0), (None, "u v", 1)], "sent_id string, sentence string, flavour int")


def test_phrase_rows_are_those_of_the_sentences(spark):
    turns = _turns(spark)
    whole = X.parsed_sentences(turns).select("sent_id", F.inline("phrases"))
    rows = X.parsed(turns)
    assert rows.schema.simpleString() == whole.schema.simpleString()
    text = [F.to_json(F.struct("*")).alias("row")]
    assert sorted(r["row"] for r in rows.select(*text).collect()) == sorted(r["row"] for r in whole.select(*text).collect())


def test_only_the_phrase_fields_that_are_read_are_made(spark):
    narrow = X.parsed(_turns(spark)).select("sent_id", "bnst_id", "midasi")
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and not [f for f in ("map_from_entries", "transform", "inline", "named_struct") if f in plan]


def test_a_phrase_number_is_dealt_to_many_tasks(spark):
    phrases = X.parsed(_turns(spark, 400).repartition(8)).where("bnst_id = 0")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        shares = Counter(r["task"] for r in dealt(phrases).withColumn("task", F.spark_partition_id()).collect())
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert shares.total() == 1201 and max(shares.values()) < 700

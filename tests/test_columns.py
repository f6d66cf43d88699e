import datetime as dt

import pytest
from pyspark.sql import functions as F

from kawaraban.functions import dates as D, frames as C, html as H, links as L, text as T


def value(spark, column, text="", schema="x string"):
    return spark.createDataFrame([(text,)], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "fn, given, expected",
    [
        (T.clean_en, '<p>A (B), "c".</p><br><a>d</a>\n<p class="x">', "a b cd<p class=x>"),
        (T.clean_en, "<pp><br/>“X” ’", "<br/>x "),
        (T.strip_tags, "a<b>c</b>\n<br/>d", "ac\nd"),
        (T.clean_snippet, "本文　です…続き", "本文です"),
        (T.drop_paren_suffix, "2019/4/1 6:30 (2019/4/1 7:00) (x)", "2019/4/1 6:30"),
        (T.drop_wide_paren, "近鉄不動産（本社：大阪市）は、（a）b", "近鉄不動産は、b"),
        (T.to_fullwidth, "Ab 1!｡ｶﾞﾊﾟｱ", "Ａｂ　１！。ガパア"),
        (T.to_fullwidth, "漢字", "漢字"),
        (T.first_sentence, "一。二。", "一"),
        (D.day_key, "https://www.reuters.com/resources/archive/us/20161227.html", "20161227"),
        (D.day_key, "https://example.com/a/", ""),
        (C.repname_surface, "特定/とくてい+目的/もくてき+会社/かいしゃ", "特定目的会社"),
        (C.repname_surface, "皆/みんな", "皆"),
        (C.head_word, "開業/かいぎょう", "開業"),
        (C.safe_int, "17", 17),
        (C.safe_int, "-", None),
        (lambda c: H.decode_entities("x"), "a &amp;lt; &lt;b&gt; &quot; &eacute; &#12354;&#x3042; &nope; & z&", 'a &lt; <b> " é ああ &nope; & z&'),
        (lambda c: H.decode_entities("x"), "&#38;amp; &#0; &#xD800;", "&amp; &#0; &#xD800;"),
        (lambda c: H.reserialised("x"), 'A & B &quot;&eacute;&lt;', 'A &amp; B "é&lt;'),
        (H.with_void_tags_closed, '<br>', "<br/>"),
        (H.with_void_tags_closed, '<img src="a/b" >', '<img src="a/b"/>'),
    ],
)
def test_text_functions(spark, fn, given, expected):
    assert value(spark, fn(F.col("x")), given) == expected


def test_strip_tags_is_idempotent(spark):
    once = T.strip_tags(F.col("x"))
    text = "<p>a</p><<b>>c</b>"
    assert value(spark, T.strip_tags(once), text) == value(spark, T.strip_tags(T.strip_tags(once)), text)


def test_drop_chars(spark):
    assert value(spark, T.drop_chars(F.col("x"), "\n,"), "a,\nb,") == "ab"


def test_words(spark):
    assert value(spark, T.word_tokens(F.col("x")), "Él dijo: «R2-D2»") == ["él", "dijo", "r2", "d2"]


@pytest.mark.parametrize(
    "heading, year, expected",
    [
        ("3月7日のニュース一覧", 2019, "2019年03月07日"),
        ("12月31日のニュース一覧", 2019, "2019年12月31日"),
        ("2月29日のニュース一覧", 2019, None),
        ("2月29日のニュース一覧", 2020, "2020年02月29日"),
        ("新着記事一覧", 2019, "2019年03月08日"),
        ("今週のニュース", 2019, "今週のニュース"),
    ],
)
def test_heading_date(spark, heading, year, expected):
    assert value(spark, D.heading_date(F.col("x"), year, dt.date(2019, 3, 8)), heading) == expected


def test_absolutise(spark):
    f = L.absolutise(F.col("x"), "https://h")
    assert value(spark, f, "/a") == "https://h/a"
    assert value(spark, f, "http://other/a") == "http://other/a"


def test_pred_arg(spark):
    given = "有る/ある:動3:ガ/N/ビル/37;ニ/C/千代田区神田神保町/35;ニ/C/x/1"
    assert value(spark, C.pred_arg(F.col("x"), "ニ"), given) == "千代田区神田神保町"
    assert value(spark, C.pred_arg(F.col("x"), "ヲ"), given) is None
    assert value(spark, C.pred_arg(F.col("x"), "ニ"), "有る/ある:動3") is None


def test_slots(spark):
    frame = "取得/しゅとく:動2:ガ/C/会社/5/0/1;ヲ/C/持分/12/0/1;ニ/U/-/-/-/-;ガ/N/社/17/0/18"
    slots = C.parse_slots(F.col("x"))
    parsed = value(spark, slots, frame)
    assert [s["case"] for s in parsed] == ["ガ", "ヲ", "ニ", "ガ"]
    assert tuple(parsed[2]) == ("ニ", "U", "-", None)
    last = value(spark, C.slot(slots, "ガ"), frame)
    assert (last["head"], last["tag_id"]) == ("社", 17)
    assert value(spark, C.slot(slots, "カラ"), frame) is None
    assert value(spark, C.predicate_word(F.col("x")), frame) == "取得"

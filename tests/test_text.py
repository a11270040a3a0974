"""Golden rows of the cleaning rules, and their properties."""

import random

import pytest
from pyspark.sql import functions as F

from quireflow.functions import quality as Q
from quireflow.functions import text as T
from quireflow.functions import vocab as V

TITLES = [
    ("菊与刀（你真的了解日本吗？全新典雅版，附赠浮世绘）", "菊与刀", "", "", 0.6),
    ("舞蹈理论概念手册 袁禾编著 上海音乐出版社", "舞蹈理论概念手册", "", "", 0.6),
    ("舞弊审计实务指南 人民邮电出版社", "舞弊审计实务指南", "", "", 0.6),
    ("乡土中国（生育制度）", "乡土中国（生育制度）", "", "", 1.0),
    ("有闲阶级论（精装本）", "有闲阶级论", "精装本", "", 1.0),
    ("红楼梦（全二册）", "红楼梦", "", "（全二册）", 1.0),
    ("银河第三卷", "银河第", "", "三卷", 1.0),
    ("精装版", "", "精装版", "", 0.3),
    ("菊与刀 正版包邮", "菊与刀", "", "", 0.6),
    ("正版书籍红楼梦包邮", "正版书籍红楼梦", "", "", 0.3),
    ("我是守村人 悬疑惊悚小说", "我是守村人", "", "", 0.6),
    ("《《三体》》", "三体", "", "", 1.0),
    (None, "", "", "", 0.3),
    ("", "", "", "", 0.3),
]


def test_titles(spark):
    rows = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TITLES)], "i int, raw string")
    got = T.with_clean_title(rows, "raw").orderBy("i").select("title", "edition", "volume", "confidence").collect()
    assert [tuple(r) for r in got] == [t[1:] for t in TITLES]


def test_squash(column):
    assert column(T.squash, ["人类简史：从动物到上帝", "ＡＢＣ１２３", None, "", " a　 \xa0b\x1c", " "]) == ["人类简史：从动物到上帝", "ABC123", "", "", "a b", ""]


def test_wrap(column):
    assert column(T.strip_title_wrap, ["《红楼梦》", "【《红楼梦》】", "《《《红楼梦》》》", "《红楼梦】", "《》", "《 》"]) == ["红楼梦", "红楼梦", "《红楼梦》", "红楼梦", "《》", ""]


def test_key(column):
    assert column(T.title_key, ["红楼梦：又名石头记", "The  Great Gatsby", None]) == ["红楼梦又名石头记", "thegreatgatsby", ""]
    assert column(lambda c: T.is_strong_key(T.title_key(c)), ["家", "家春"]) == [False, True]


def test_ratio(column):
    assert column(T.cjk_ratio, ["红a", "", None, "abc"]) == [0.5, 0.0, 0.0, 0.0]


def test_author(column):
    texts = ["曹雪芹 著", "余华著", "2016-09-01", "无", "佚名", "[清]曹雪芹", "（美）海明威 著", None, "1999", "袁禾编著"]
    assert column(T.clean_author, texts) == ["曹雪芹", "余华", "", "", "佚名", "曹雪芹", "海明威", "", "", "袁禾"]


def test_isbn(column):
    texts = ["978-7-02-000220-7", "0306406152", "9787020002208", "0306406153", "080442957X", "", None, "97870200022077", "X306406152"]
    assert column(T.isbn13, texts) == ["9787020002207", "9780306406157", "", "", "9780804429573", "", "", "", ""]


def test_year(column):
    assert column(T.pub_year, ["2016-09", "", None, "第1899年", "1799", "２０２０"]) == ["2016", "", "", "1899", "", "2020"]


def test_noise(column):
    assert column(T.has_tail_noise, ["红楼梦 正版", "红楼梦 作家出版社", "红楼梦 9787020002207", "红楼梦 97870200022071", "红楼梦", None]) == [True, True, True, False, False, False]


def test_reasons(column):
    texts = ["55吋触控萤幕会议平板智能办公设备", "红楼梦", "Quantitative Investment Analysis", "", "！！！", "啊啊啊啊啊啊", "红www.", "红" * 61, "家", "_"]
    reasons = column(lambda c: Q.reject_reason(c, T.title_key(c)), texts)
    assert reasons == ["non_book", None, "not_chinese", "empty", "punct_only", "repeated_char", "marketing", "too_long", "single_char", "punct_only"]


def test_score(spark):
    row = spark.range(1).select(Q.score(F.lit(0.6), F.lit(2), F.lit(True), F.lit(True)).alias("a"), Q.score(F.lit(1.0), F.lit(9), F.lit(True), F.lit(True)).alias("b")).first()
    assert (row["a"], row["b"]) == (0.76, 1.0)


def test_split_pub(column):
    lines = ["[清] 曹雪芹 / 人民文学出版社 / 1996-12 / 59.70元", "", None, "a / b", "a / b / 某集团 / 2001 / 1999"]
    assert column(lambda c: F.concat_ws("|", *T.split_pub(c)), lines) == ["[清] 曹雪芹|人民文学出版社|1996", "||", "||", "a|b|", "a|某集团|1999"]


def test_promo_heads_are_first_marker_with_two_characters(column, spark):
    rows = spark.createDataFrame([(0, "正版红楼梦现货包邮"), (1, "a正版b正版"), (2, "\U00020000红楼 包邮")], "i int, t string")
    got = [r["t"] for r in T.with_promo_cut(rows, "t").orderBy("i").collect()]
    assert got == ["正版红楼梦", "a正版b", "\U00020000红楼"]


def test_properties(column):
    rng = random.Random(3)
    alphabet = list("红楼梦家春《》（）：ＡＢa1 　·—") + list(V.PROMO_WORDS[:6]) + list(V.EDITION_WORDS[:4])
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) for _ in range(400)]
    squashed = column(T.squash, texts)
    assert column(T.squash, squashed) == squashed
    keys = column(T.title_key, texts)
    assert column(T.title_key, keys) == keys


@pytest.mark.parametrize("text", ["（" * 3000, "红 " * 3000, "正版" * 2000, "9" * 5000])
def test_long_titles(spark, text):
    rows = spark.createDataFrame([(text,)], "raw string")
    assert T.with_clean_title(rows, "raw").count() == 1
    assert T.with_clean_title(rows, "raw").first()["confidence"] <= 1.0

"""Book listings derived from the shared tables, which hold no titles of their own.

The statements are plain SQL over ``part``, so any engine derives the same rows. Each row's title is
one of the base titles in one of the wrappers, with one of the suffixes that listings add; the other
columns follow from the key as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TITLES = (
    "红楼梦", "西游记", "三国演义", "水浒传", "人类简史：从动物到上帝", "有闲阶级论", "菊与刀", "乡土中国（生育制度）", "家", "Quantitative Analysis", "我的台灯",
    "啊啊啊啊啊啊啊", "！！！", "红楼梦新证", "西游记续", "时间简史", "百年孤独 全译版", "围城·钱钟书", "中国历代文学作品选读与鉴赏辞典大全总目录",
)
SUFFIXES = (
    "", "（精装本）", "（全二册）", " 正版包邮", " 曹雪芹 著", " 人民文学出版社", "（当当专享 亲签版）", " 第三版", "   ", "（一本你真的应该读的书，推荐给大家）",
    " 悬疑惊悚小说", "正版书籍 衔接课内外", " 定价 35", "（名著系列）", " 第3卷", "：", "客服", "——上下", " 余华 莫言推荐", "（同名电视剧原著）",
    "青少版课外读物 作家出版社", " 9787020002207", "编号12397870200022071",
)
WRAPS = (("", ""), ("《", "》"), ("【", "】"), ("  ", ""))
AUTHORS = ("曹雪芹 著", "余华著", "2016-09-01", "无", "佚名", "[清]曹雪芹", "（美）海明威 著", "", "张三 / 李四 编著", "Ｊ．Ｋ．罗琳")
PRESSES = ("人民文学出版社", " 中华 书局 ", "", "作家出版社　")
SOURCES = ("douban", "dangdang", "weread", "pdc", "legacy")


def _pick(values, by: str) -> str:
    quoted = [v.replace("'", "''") for v in values]
    return f"CASE CAST({by} AS BIGINT) % {len(values)} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(quoted)) + " END"


_K = "p_partkey"
#: Rows that share a mark. The mark is their number in these characters, and follows the title in most rows, so titles
#: grow with the table, each with a few rows of its own.
SHARE, DIGITS = 40, "天地玄黄宇宙洪荒日月"
_MARK = f"CASE WHEN {_K} % 8 = 0 THEN '' ELSE translate(CAST(CAST(({_K} - {_K} % {SHARE}) / {SHARE} AS BIGINT) AS VARCHAR(20)), '0123456789', '{DIGITS}') END"
# rows 4 and 5 of each twenty share a number
_ISBN_BODY = f"concat('9787', lpad(CAST(({_K} - {_K} % 2) * 37 % 99999989 AS VARCHAR(9)), 8, '0'))"

#: SQL that derives the raw table; ``{part}`` is the table it reads.
RAW_SQL = f"""
WITH k AS (
  SELECT CAST({_K} AS BIGINT) AS id, CAST(p_size AS BIGINT) AS size, {_ISBN_BODY} AS body,
    concat({_pick(TITLES, f"{_K} * 7 + p_size")}, {_MARK}) AS base, {_pick(SUFFIXES, f"{_K} + p_size * 3")} AS suffix,
    {_pick([w[0] for w in WRAPS], "p_size")} AS opened, {_pick([w[1] for w in WRAPS], "p_size")} AS closed,
    {_pick(SOURCES, f"{_K} * 3 + p_size")} AS source, {_pick(AUTHORS, f"{_K} + p_size")} AS author_raw, {_pick(PRESSES, f"{_K} + 1")} AS publisher
  FROM {{part}}
), d AS (
  SELECT k.*, {" + ".join(f"CAST(substr(body, {i + 1}, 1) AS BIGINT) * {1 if i % 2 == 0 else 3}" for i in range(12))} AS total FROM k
)
SELECT id, source, concat('s', CAST(id AS VARCHAR(20))) AS source_id, concat(opened, base, closed, suffix) AS title_raw, author_raw, publisher,
  CASE WHEN id % 6 = 0 THEN '' ELSE concat(CAST(1940 + (id * 13) % 95 AS VARCHAR(9)), '-0', CAST(1 + id % 9 AS VARCHAR(9))) END AS pub_year,
  CASE WHEN id % 20 NOT IN (2, 3, 4, 5, 11) THEN '' WHEN id % 4 <= 1 THEN concat(body, CAST((10 - total % 10) % 10 AS VARCHAR(9)))
    WHEN id % 4 = 2 THEN concat(substr(body, 1, 3), '-', substr(body, 4, 9), '-', CAST((10 - total % 10) % 10 AS VARCHAR(9)))
    ELSE concat(body, CAST((11 - total % 10) % 10 AS VARCHAR(9))) END AS isbn,
  {_pick((" 文学 ", "历史", "科普"), "id")} AS category, concat('https://example.com/', CAST(id AS VARCHAR(20))) AS url, '2024-01-01 00:00:00' AS fetched_at
FROM d
"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table derived from ``part``."""
    return spark.sql(RAW_SQL.format(part="{part}"), part=spark.read.parquet(f"{sf_dir}/part.parquet"))

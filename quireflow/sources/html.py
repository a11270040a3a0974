"""List pages in HTML to rows. Pages are rows with an ``html`` column; nothing is fetched here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.vocab import S
from .raw import listing

# Patterns of the pages' parts.
ITEM = r'(?s)<li[^>]*id="p(\d+)"[^>]*>(.*?)</li>'
TITLE = r'title="([^"]*)"'
AUTHOR = r"""itemlist-author'?"?[^>]*?title=['"]([^'"]*)"""
PRESS = r"""P_cbs'?"?[^>]*?title=['"]([^'"]*)"""
DATE = r"/\s*(\d{4})-(\d{1,2})-(\d{1,2})"
CATEGORY = r"category\.dangdang\.com/cp(\d+(?:\.\d+){5})\.html"
TAG = r'href="/tag/([^"?/]+)"'
COUNTED_TAG = r'/tag/([^"?/]+)"[^>]*>[^<]*</a>\s*\((\d+)\)'
SUBJECT = r'(?s)<li[^>]*class="[^"]*\bsubject-item\b[^"]*"[^>]*>.*?(?=<li[^>]*class="[^"]*\bsubject-item\b|</ul>|$)'
HEADING_LINK = r"(?s)<h2[^>]*>.*?<a\b([^>]*)>(.*?)</a>"
PUB = r'(?s)<div[^>]*class="[^"]*\bpub\b[^"]*"[^>]*>(.*?)</div>'

# Fallback tags and categories where discovery finds none.
FALLBACK_TAGS = ("小说", "文学", "历史", "哲学", "科学")
FALLBACK_CATEGORIES = ("01.01.00.00.00.00", "01.03.00.00.00.00", "01.05.00.00.00.00")


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{S}+|{S}+$", "")


def plain(html: Column) -> Column:
    """The text of a piece of HTML: tags to spaces, five entities, white space collapsed."""
    s = F.regexp_replace(html, "(?s)<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(entity), F.lit(char))
    return _strip(F.regexp_replace(s, f"{S}+", " "))


def attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, rf'\b{name}="([^"]*)"', 1)


def shop_items(pages: DataFrame, category: str = "category") -> DataFrame:
    """Rows of shop list pages: numbered ``li`` items with title, author, press and date."""
    items = pages.select(F.col(category).alias("cat"), F.explode(F.regexp_extract_all("html", F.lit(ITEM), F.lit(0))).alias("li"))
    items = items.select("cat", F.regexp_extract("li", ITEM, 1).alias("pid"), F.regexp_extract("li", ITEM, 2).alias("body")).where(F.col("body").rlike(TITLE))
    part = lambda p: F.regexp_extract("body", p, 1)
    url = F.concat(F.lit("https://product.dangdang.com/"), F.col("pid"), F.lit(".html"))
    return listing(items, source=F.lit("dangdang"), source_id="pid", title_raw=_strip(part(TITLE)), author_raw=part(AUTHOR), publisher=part(PRESS), pub_year=part(DATE), category="cat", url=url)


def tag_items(pages: DataFrame) -> DataFrame:
    """Rows of tag pages (columns tag, start, html): ``li.subject-item`` with a linked heading and a publication line."""
    items = pages.select("tag", "start", F.explode(F.regexp_extract_all("html", F.lit(SUBJECT), F.lit(0))).alias("li"))
    items = items.where(F.col("li").rlike(HEADING_LINK)).select("tag", "start", F.regexp_extract("li", HEADING_LINK, 1).alias("a"), plain(F.regexp_extract("li", HEADING_LINK, 2)).alias("shown"), plain(F.regexp_extract("li", PUB, 1)).alias("pub"))
    items = items.withColumns({"href": attribute(F.col("a"), "href"), "title": attribute(F.col("a"), "title")})
    author, press, year = T.split_pub(F.col("pub"))
    last = F.element_at(F.split(F.regexp_replace("href", "/+$", ""), "/"), -1)
    sid = F.coalesce(F.nullif(last, F.lit("")), F.concat_ws("-", "tag", F.col("start").cast("string"), "title"))
    return listing(items, source=F.lit("douban"), source_id=sid, title_raw=F.coalesce(F.nullif("title", F.lit("")), F.col("shown")), author_raw=author, publisher=press, pub_year=year, category="tag", url="href")


def ranked_tags(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """``tag, n`` by count; where no page has counts, the distinct linked tags in order. The last count of a tag stands."""
    found = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(COUNTED_TAG), F.lit(0))).alias("at", "m"))
    counted = found.select(F.regexp_extract("m", COUNTED_TAG, 1).alias("tag"), F.regexp_extract("m", COUNTED_TAG, 2).cast("long").alias("n"), F.struct("page_id", "at").alias("at"))
    ranked = counted.groupBy("tag").agg(F.max_by("n", "at").alias("n"), F.min("at").alias("first"))
    links = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(TAG), F.lit(1))).alias("at", "tag"))
    plain = links.groupBy("tag").agg(F.lit(None).cast("long").alias("n"), F.min(F.struct("page_id", "at")).alias("first"))
    none = ranked.agg(F.count("*").alias("__n")).where("__n = 0").select()  # one row without columns, or no row
    out = ranked.union(plain.join(none)).orderBy(F.desc("n"), "first").select("tag", "n")
    return out.limit(limit) if limit else out


def categories(pages: DataFrame) -> DataFrame:
    """``cid``: the distinct category codes that pages link."""
    return pages.select(F.explode(F.regexp_extract_all("html", F.lit(CATEGORY), F.lit(1))).alias("cid")).distinct().orderBy("cid")


def effective(cid: Column) -> Column:
    """The segments of a category code before the first ``00`` after the first segment."""
    segments = F.split(cid, "[.]")
    stop = F.array_position(F.transform(segments, lambda s, i: (s == "00") & (i > 0)), True)
    return F.when(stop > 0, F.slice(segments, 1, (stop - 1).cast("int"))).otherwise(segments)


def children(pages: DataFrame) -> DataFrame:
    """``parent, cid``: the codes linked on a category's page that share its segments and have one more."""
    links = pages.select("parent", F.explode(F.regexp_extract_all("html", F.lit(CATEGORY), F.lit(1))).alias("cid")).distinct()
    core, segments = effective(F.col("parent")), F.split("cid", "[.]")
    child = (F.size(segments) == 6) & (F.size(core) < 6) & (F.slice(segments, F.lit(1), F.size(core)) == core) & ~F.coalesce(F.get(segments, F.size(core)), F.lit("")).isin("00", "")
    return links.where(child)


def legacy_items(pages: DataFrame, source: str) -> DataFrame:
    """``title, author, source`` of list pages by the older rules: author before the first slash, no leading [country]."""
    from ..operators.legacy import drop_country

    rows = (tag_items if source == "douban" else shop_items)(pages)
    title, author = _strip(F.col("title_raw")), _strip(drop_country(_strip(F.element_at(F.split(F.regexp_replace("author_raw", f"^[/{S[1:-1]}]+", ""), "/"), 1))))
    return rows.select(title.alias("title"), author.alias("author"), "source").where((F.col("title") != "") & (F.col("author") != ""))


def or_fallback(found: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """What was discovered, or the fixed values where nothing was."""
    fixed = found.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    none = found.agg(F.count("*").alias("__n")).where("__n = 0").select()
    return found.select(column).union(fixed.join(none))


def first_seen(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("__r", rank).where("__r = 1").drop("__r")

"""List pages, catalogues, category trees and query results in JSON to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.legacy import join_authors, without_ids
from ..operators.storage import cut
from .raw import listing

PAGE = "books array<struct<bookInfo: struct<bookId: string, title: string, author: string, publisher: string, publishTime: string, category: string, deepLink: string>>>"
_ROW = "array<struct<bookName: string, firstbookname: string, isbn: string, id: string, author: string, publisher: string, publishDate: string, cate1: string>>"
CATALOGUE = f"data struct<list: {_ROW}>, list {_ROW}"
BINDINGS = "results struct<bindings: array<struct<itemLabel: struct<value: string>, authorLabel: struct<value: string>>>>"
LIBRARY = "docs array<struct<title: string, author_name: array<string>>>"


def page_items(pages: DataFrame, col: str = "json") -> DataFrame:
    """Rows of list pages ``books[].bookInfo``; items without a title go, broken pages give none."""
    b = pages.select(F.explode(F.from_json(col, PAGE)["books"]["bookInfo"]).alias("b")).select("b.*")
    return listing(b, source=F.lit("weread"), source_id="bookId", title_raw="title", author_raw="author", publisher="publisher", pub_year=F.substring("publishTime", 1, 4), category="category", url="deepLink")


def catalogue_items(pages: DataFrame, col: str = "json") -> DataFrame:
    """Rows of a catalogue's results, the only listing with ISBNs; each field from the first of its names that is filled."""
    parsed = pages.select(F.from_json(col, CATALOGUE).alias("j"))
    inner = F.when(F.size("j.data.list") > 0, F.col("j.data.list")).otherwise(F.col("j.list"))
    b = parsed.select(F.explode(inner).alias("b")).select("b.*")
    first = lambda x, y: F.coalesce(F.nullif(x, F.lit("")), F.col(y))
    return listing(b, source=F.lit("pdc"), source_id=first("isbn", "id"), title_raw=first("bookName", "firstbookname"), author_raw="author", publisher="publisher", pub_year=F.substring("publishDate", 1, 4), isbn="isbn", category="cate1")


def tree_leaves(trees: DataFrame, col: str = "json") -> DataFrame:
    """``path, cid, name`` of a category tree's leaves, however deep. Nodes without an id drop what is below them.

    Children stand under ``sublist`` or ``categories``, names under ``title`` or ``name``; the tree's
    first level is ``data[]``, whose own children (``categories`` or ``sublist``) are the roots. Each level
    is kept before the next is taken, until there is none. Text that is no JSON gives no rows.
    """
    get = lambda node, key, kind: F.try_variant_get(node, f"$.{key}", kind)

    def child_list(node, *keys):
        lists = [get(node, k, "array<variant>") for k in keys]
        return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])

    groups = trees.select(F.explode(get(F.try_parse_json(col), "data", "array<variant>")).alias("g"))
    nodes = groups.select(F.explode(child_list(F.col("g"), "categories", "sublist")).alias("v"), F.lit("").alias("path"))
    out, nodes = None, cut(nodes)
    while out is None or not nodes.isEmpty():
        name = F.coalesce(F.nullif(get(F.col("v"), "title", "string"), F.lit("")), get(F.col("v"), "name", "string"), F.lit(""))
        named = nodes.select("path", get(F.col("v"), "CategoryId", "string").alias("cid"), name.alias("name"), child_list(F.col("v"), "sublist", "categories").alias("below")).where(F.coalesce("cid", F.lit("")) != "")
        leaves = named.where(F.col("below").isNull()).select(F.concat("path", "name").alias("path"), "cid", "name")
        out = leaves if out is None else out.union(leaves)
        nodes = cut(named.where(F.col("below").isNotNull()).select(F.explode("below").alias("v"), F.concat("path", "name", F.lit("/")).alias("path")))
    return out


def query_bindings(results: DataFrame, col: str = "json") -> DataFrame:
    """``title, author, source`` of query results; labels that are bare ids go."""
    b = results.select(F.explode(F.from_json(col, BINDINGS)["results"]["bindings"]).alias("b"))
    rows = b.select(F.coalesce("b.itemLabel.value", F.lit("")).alias("title"), F.coalesce("b.authorLabel.value", F.lit("")).alias("author"), F.lit("wikidata").alias("source"))
    return without_ids(rows)


def library_docs(results: DataFrame, col: str = "json") -> DataFrame:
    """``title, author, source`` of library search results; authors come joined."""
    d = results.select(F.explode(F.from_json(col, LIBRARY)["docs"]).alias("d"))
    rows = d.select(F.coalesce("d.title", F.lit("")).alias("title"), F.coalesce(join_authors(F.col("d.author_name")), F.lit("")).alias("author"), F.lit("openlibrary").alias("source"))
    return rows.where((F.col("title") != "") & (F.col("author") != ""))


def book_pattern(triples: DataFrame, labels: DataFrame, language: str | None = None, citizenship: str | None = None, limit: int | None = 10_000, offset: int = 0) -> DataFrame:
    """``item, itemLabel, authorLabel``: books with an author, of a language or by authors of a country.

    ``triples`` are (s, p, o): P31 instance of Q571, P50 author, P407 language, P27 citizenship. A page
    of the results ordered by item and author; with ``limit`` None all of them, in no order.
    """
    edge = lambda p: triples.where(F.col("p") == p)
    items = edge("P31").where(F.col("o") == "Q571").select(F.col("s").alias("item"))
    rows = items.join(edge("P50").select(F.col("s").alias("item"), F.col("o").alias("author")), "item")
    if language:
        rows = rows.join(edge("P407").where(F.col("o") == language).select(F.col("s").alias("item")), "item", "left_semi")
    if citizenship:
        rows = rows.join(edge("P27").where(F.col("o") == citizenship).select(F.col("s").alias("author")), "author", "left_semi")
    name = lambda c: labels.select(F.col("id").alias(c), F.col("label").alias(f"{c}Label"))
    rows = rows.join(name("item"), "item", "left").join(name("author"), "author", "left")
    shown = rows.select("item", F.coalesce("itemLabel", "item").alias("itemLabel"), F.coalesce("authorLabel", "author").alias("authorLabel"))
    return shown if limit is None else shown.orderBy("item", "authorLabel").offset(offset).limit(limit)

"""The registered queries over the shared tables, by name."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from ..operators import ingest, legacy, near_titles, report, storage
from ..operators import lexicon as L
from ..operators import resolve as R
from ..sources import files, html, json, registry
from ..sources import raw as raw_source
from ..streaming import ingest as streams
from . import adapter, frontier

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapter.raw(spark, sf_dir)
    return R.clean_records(raw_source.spread(raw_source.scan(rows)), L.build(rows))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.clusters(R.candidates(records(spark, sf_dir)))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.canonical_books(clustered(spark, sf_dir))


def of_title(name: str, **columns) -> Query:
    """A query that gives functions of the raw title."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return adapter.raw(spark, sf_dir).select("id", *[f(F.col("title_raw")).alias(c) for c, f in columns.items()])

    run.__name__ = name
    return query(run)


of_title("squash", squashed=T.squash)
of_title("title_wrap", unwrapped=T.strip_title_wrap)
of_title("cjk_ratio", ratio=lambda c: F.round(T.cjk_ratio(c), 6))
of_title("edition", rest=lambda c: T.editions(T.squash(c))[0], edition=lambda c: T.editions(T.squash(c))[1])
of_title("volume", rest=lambda c: T.volume(T.squash(c))[0], volume=lambda c: T.volume(T.squash(c))[1])
of_title("title_key", key=T.title_key, strong=lambda c: T.is_strong_key(T.title_key(c)))
of_title("tail_noise", noise=T.has_tail_noise)
of_title("grams", grams=lambda c: F.array_join(F.array_sort(T.grams(T.title_key(c))), ","))


@query
def promo_cut(spark, sf_dir):
    return T.with_promo_cut(raw_source.spread(adapter.raw(spark, sf_dir).select("id", F.col("title_raw").alias("title"))), "title").select("id", "title", "cut")


@query
def clean_title(spark, sf_dir):
    return T.with_clean_title(raw_source.spread(adapter.raw(spark, sf_dir).select("id", "title_raw")), "title_raw").select("id", "title", "edition", "volume", "confidence")


@query
def clean_author(spark, sf_dir):
    return adapter.raw(spark, sf_dir).select("id", T.clean_author(F.col("author_raw")).alias("author"))


@query
def isbn13(spark, sf_dir):
    return adapter.raw(spark, sf_dir).select("id", T.isbn13(F.col("isbn")).alias("isbn13"))


@query
def pub_year(spark, sf_dir):
    return adapter.raw(spark, sf_dir).select("id", T.pub_year(F.col("pub_year")).alias("year"))


@query
def raw_scan(spark, sf_dir):
    """One source's rows, the nine columns that cleaning reads."""
    return raw_source.scan(adapter.raw(spark, sf_dir), "douban")


@query
def row_counts(spark, sf_dir):
    return report.row_count(adapter.raw(spark, sf_dir))


@query
def quality_reason(spark, sf_dir):
    rows = T.with_clean_title(raw_source.spread(adapter.raw(spark, sf_dir).select("id", "title_raw")), "title_raw")
    return rows.select("id", F.coalesce(Q.reject_reason(F.col("title"), T.title_key(F.col("title"))), F.lit("")).alias("reason"))


@query
def reject_histogram(spark, sf_dir):
    return R.reject_histogram(records(spark, sf_dir), 6)


@query
def lexicon_build(spark, sf_dir):
    return L.build(adapter.raw(spark, sf_dir))


@query
def lexicon_match(spark, sf_dir):
    rows = adapter.raw(spark, sf_dir)
    return L.match(rows.select("id", "title_raw"), L.build(rows)).select("id", F.coalesce("hit", F.lit("")).alias("hit"))


@query
def lexicon_contains(spark, sf_dir):
    rows = adapter.raw(spark, sf_dir)
    return L.contains(rows, L.build(rows), "title_raw").select("id")


@query
def lexicon_override(spark, sf_dir):
    """Rows whose cleaned title a lexicon hit replaced."""
    rows = adapter.raw(spark, sf_dir)
    plain = R.clean_records(rows).select("raw_id", F.col("title").alias("before"))
    return R.clean_records(rows, L.build(rows)).select("raw_id", "title", "confidence").join(storage.by_key(plain), "raw_id").where("title <> before")


@query
def candidates(spark, sf_dir):
    return R.candidates(records(spark, sf_dir))


@query
def clusters(spark, sf_dir):
    return clustered(spark, sf_dir).select("raw_id", "key", "cluster")


@query
def canonical_books(spark, sf_dir):
    return books(spark, sf_dir)


@query
def members(spark, sf_dir):
    return R.members(clustered(spark, sf_dir))


@query
def book_numbers(spark, sf_dir):
    return R.numbered(storage.cut(books(spark, sf_dir).select("id")))


@query
def lineage(spark, sf_dir):
    rows = clustered(spark, sf_dir)
    return R.lineage(R.canonical_books(rows), R.members(rows), adapter.raw(spark, sf_dir)).select("book_id", "raw_id", "title", "source")


@query
def aliases(spark, sf_dir):
    return books(spark, sf_dir).select("id", "aliases")


@query
def source_list(spark, sf_dir):
    return books(spark, sf_dir).select("id", "sources", "n_sources")


@query
def score(spark, sf_dir):
    return books(spark, sf_dir).select("id", "confidence")


@query
def near_duplicates(spark, sf_dir):
    return near_titles.near_duplicates(storage.cut(books(spark, sf_dir).select("title", "title_key")))


@query
def review_rows(spark, sf_dir):
    """The review file of all near-equal titles, written and read back."""
    path = storage.scratch_path(spark, "review")
    files.review_csv(near_titles.near_duplicates(storage.cut(books(spark, sf_dir).select("title", "title_key"))), path)
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.select(F.col(f"`{rows.columns[0]}`").alias("title_a"), "title_b", F.col("similarity").cast("double").alias("similarity"))


@query
def rebuild(spark, sf_dir):
    """Members as the newest of two versions; the first one lacks the odd rows."""
    path, rows = storage.scratch_path(spark, "rebuild"), clustered(spark, sf_dir)
    ingest.replace_tables({"members": R.members(rows).where("raw_id % 2 = 0")}, path)
    ingest.replace_tables({"members": R.members(rows)}, path)
    return ingest.read_version(spark, path, "members")


@query
def lexicon_saved(spark, sf_dir):
    """The lexicon, saved and loaded."""
    path = storage.scratch_path(spark, "lexicon")
    L.save(L.build(adapter.raw(spark, sf_dir)), path)
    return L.load(spark, path)


@query
def source_breakdown(spark, sf_dir):
    return report.source_breakdown(adapter.raw(spark, sf_dir))


@query
def confidence_tiers(spark, sf_dir):
    return report.confidence_tiers(books(spark, sf_dir))


@query
def high_conf_split(spark, sf_dir):
    return report.high_confidence_split(books(spark, sf_dir))


@query
def completeness(spark, sf_dir):
    return report.completeness(books(spark, sf_dir))


@query
def multi_source(spark, sf_dir):
    return report.multi_source(books(spark, sf_dir))


@query
def decade_histogram(spark, sf_dir):
    return report.decade_histogram(books(spark, sf_dir))


@query
def top_initials(spark, sf_dir):
    return report.top_initials(books(spark, sf_dir))


@query
def export_rows(spark, sf_dir):
    return files.export_rows(books(spark, sf_dir), 0.9)


# ---------------------------------------------------------------- ingest


def listing_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a batch of listings in which keys repeat."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("source_id"), F.when(F.col("event_id") % 11 == 0, "").otherwise(F.concat(F.lit("t"), F.col("event_id").cast("string"))).alias("title_raw"))


@query
def insert_ignore(spark, sf_dir):
    """What all events add to a table that already holds the clicks and views."""
    rows = listing_batch(spark, sf_dir)
    return ingest.new_rows(rows, ingest.new_rows(rows.where(F.col("source").isin("click", "view")), None))


@query
def appended_count(spark, sf_dir):
    """How many rows each of three appends to a table adds: some, the rest, and none."""
    rows, path = listing_batch(spark, sf_dir), storage.scratch_path(spark, "appended")
    batches = (rows.where(F.col("source").isin("click", "view")), rows, rows)
    return spark.createDataFrame([(k, ingest.append(spark, b, path)) for k, b in enumerate(batches)], "step int, n long")


@query
def null_keys(spark, sf_dir):
    """What all events add to a table that holds the clicks, where the ids of every third user are missing."""
    rows = listing_batch(spark, sf_dir).withColumn("source_id", F.when(F.col("source_id").cast("long") % 3 != 0, F.col("source_id")))
    return ingest.new_rows(rows, ingest.new_rows(rows.where("source = 'click'"), None))


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as task states: the turns are updates of a task."""
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("role").alias("source"), F.concat(F.lit("k"), (F.col("conv_id") % 40).cast("string")).alias("task_key"), (F.col("turn") % 2).cast("long").alias("done"), F.col("turn").alias("pages"), F.length("text").cast("long").alias("items"), F.format_string("%08d-%04d", "conv_id", "turn").alias("updated_at"))


@query
def state_upsert(spark, sf_dir):
    rows = tasks(spark, sf_dir)
    early = F.col("updated_at") < "00000030"
    empty = rows.where(F.lit(False))
    return ingest.upsert(ingest.upsert(empty, rows.where(early)), rows.where(~early))


@query
def pending_tasks(spark, sf_dir):
    rows = tasks(spark, sf_dir)
    return ingest.pending(rows.select("source", "task_key").distinct(), ingest.upsert(rows.where(F.lit(False)), rows))


@query
def task_progress(spark, sf_dir):
    rows = tasks(spark, sf_dir)
    wanted = rows.select(F.lit("user").alias("source"), "task_key").distinct()
    return ingest.read_state(wanted, ingest.upsert(rows.where(F.lit(False)), rows.where("pages > 2")))


@query
def fetch_states(spark, sf_dir):
    """Tasks as their fetches left them; every seventh fetch failed."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string")).alias("task_key"), F.when(F.col("event_id") % 700 != 7, F.col("event_id") % 60).alias("items"))
    return ingest.mark_done(e)


@query
def page_cap(spark, sf_dir):
    """At most five rows of each source, as listings are capped."""
    return ingest.per_group_limit(adapter.raw(spark, sf_dir).select("source", "id"), ["source"], ["id"], 5)


@query
def stream_ingest(spark, sf_dir):
    """Keys that a stream over the events wrote, first writes only."""
    schema = table(spark, sf_dir, "events").schema
    rows = streams.stream(spark, sf_dir, schema, "events.parquet").withColumnRenamed("event_type", "source").selectExpr("source", "cast(user_id as string) as source_id")
    path = storage.scratch_path(spark, "stream")
    streams.ingest(streams.first_writes(rows, ["source", "source_id"]), f"{path}/rows", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows")


@query
def stream_first(spark, sf_dir):
    """The first event of each key, whole, as a stream wrote it."""
    schema = table(spark, sf_dir, "events").schema
    rows = streams.stream(spark, sf_dir, schema, "events.parquet").selectExpr("event_id as id", "event_type as source", "cast(user_id as string) as source_id", "value")
    path = storage.scratch_path(spark, "stream-first")
    streams.ingest_first(rows, f"{path}/rows", f"{path}/checkpoint", ("source", "source_id"), "id")
    return spark.read.parquet(f"{path}/rows").drop("batch")


@query
def stream_batches(spark, sf_dir):
    """What a callback saw of each batch of a stream."""
    seen: list[tuple[int, int]] = []
    schema = table(spark, sf_dir, "events").schema
    path = storage.scratch_path(spark, "stream-batches")
    streams.ingest(streams.stream(spark, sf_dir, schema, "events.parquet"), f"{path}/rows", f"{path}/checkpoint", lambda batch, number: seen.append((number, batch.count())))
    return spark.createDataFrame(seen, "batch int, n long")


# ---------------------------------------------------------------- listings


@query
def split_pub(spark, sf_dir):
    line = F.concat_ws(" / ", "author_raw", "publisher", "pub_year", F.lit("35.00元"))
    author, press, year = T.split_pub(line)
    return adapter.raw(spark, sf_dir).select("id", author.alias("author"), press.alias("press"), year.alias("year"))


def shop_pages(rows: DataFrame) -> DataFrame:
    """Shop list pages that show raw rows, sixty ids a page."""
    li = F.concat(F.lit('<li class="line" id="p'), "id", F.lit('"><a title="'), "title_raw", F.lit("\" href='x'>x</a><p><a dd_name='itemlist-author' title='"), "author_raw", F.lit("'>a</a></p><a name='P_cbs' title='"), "publisher", F.lit("'>p</a><span> /"), F.coalesce(F.nullif("pub_year", F.lit("")), F.lit("x")), F.lit("-01</span></li>"))
    pages = rows.groupBy(F.floor(F.col("id") / 60).alias("page")).agg(F.concat(F.lit("<ul>"), F.array_join(F.array_sort(F.collect_list(li)), "\n"), F.lit("</ul>")).alias("html"))
    return pages.withColumn("category", F.col("page").cast("string"))


def json_pages(rows: DataFrame) -> DataFrame:
    """JSON list pages that show raw rows, twenty ids a page."""
    info = F.struct(F.struct(F.col("source_id").alias("bookId"), F.col("title_raw").alias("title"), F.col("author_raw").alias("author"), "publisher", F.concat("pub_year", F.lit("-01 00:00")).alias("publishTime"), "category", F.col("url").alias("deepLink")).alias("bookInfo"))
    return rows.groupBy(F.floor(F.col("id") / 20).alias("page")).agg(F.to_json(F.struct(F.collect_list(info).alias("books"))).alias("json"))


def catalogue_pages(rows: DataFrame) -> DataFrame:
    """A catalogue's result pages that show raw rows; odd pages have the older layout."""
    item = F.struct(F.when(F.col("id") % 3 > 0, F.col("title_raw")).alias("bookName"), F.col("title_raw").alias("firstbookname"), "isbn", F.col("source_id").alias("id"), F.col("author_raw").alias("author"), "publisher", F.col("pub_year").alias("publishDate"), F.col("category").alias("cate1"))
    pages = rows.groupBy(F.floor(F.col("id") / 20).alias("page")).agg(F.collect_list(item).alias("l"))
    return pages.select(F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.struct(F.col("l").alias("list")).alias("data")))).otherwise(F.to_json(F.struct(F.col("l").alias("list")))).alias("json"))


@query
def html_items(spark, sf_dir):
    """Shop pages made of raw rows, read back."""
    return html.shop_items(shop_pages(adapter.raw(spark, sf_dir))).select("source_id", "title_raw", "author_raw", "publisher", "pub_year", "category", "url")


@query
def union_sources(spark, sf_dir):
    """The pages of three sources, each in its own format, as one listing."""
    rows = adapter.raw(spark, sf_dir)
    of = lambda source: rows.where(F.col("source") == source)
    pages = {"dangdang": shop_pages(of("dangdang")), "weread": json_pages(of("weread")), "pdc": catalogue_pages(of("pdc"))}
    return registry.listings(pages).select("source", "source_id", "title_raw", "author_raw", "publisher", "isbn")


def tag_pages(rows: DataFrame) -> DataFrame:
    """Tag pages that show raw rows, twenty ids a page."""
    li = F.concat(F.lit('<li class="subject-item"><h2 class=""><a href="https://book.example.com/subject/'), "id", F.lit('/" title="'), F.trim("title_raw"), F.lit('">shown</a></h2><div class="pub">'), F.concat_ws(" / ", "author_raw", "publisher", "pub_year", F.lit("35.00")), F.lit("</div></li>"))
    pages = rows.groupBy(F.floor(F.col("id") / 20).alias("start")).agg(F.concat(F.lit("<ul>"), F.array_join(F.array_sort(F.collect_list(li)), "\n"), F.lit("</ul>")).alias("html"))
    return pages.withColumn("tag", F.lit("novel"))


@query
def union_all_sources(spark, sf_dir):
    """The pages of all four sources, each in its own format, as one listing."""
    rows = adapter.raw(spark, sf_dir)
    of = lambda source: rows.where(F.col("source") == source)
    pages = {"dangdang": shop_pages(of("dangdang")), "weread": json_pages(of("weread")), "pdc": catalogue_pages(of("pdc")), "douban": tag_pages(of("douban"))}
    return registry.listings(pages).select("source", "source_id", "title_raw", "author_raw", "publisher", "isbn")


@query
def legacy_pages(spark, sf_dir):
    """Shop pages read by the older rules."""
    return html.legacy_items(shop_pages(adapter.raw(spark, sf_dir)), "dangdang")


@query
def legacy_files(spark, sf_dir):
    """The older CSV and JSON files of all raw rows, written and read back."""
    path = storage.scratch_path(spark, "legacy")
    where = files.save_all(legacy_rows(spark, sf_dir), path)
    csv = files.read_csv(spark, where["csv"]).withColumn("file", F.lit("csv"))
    rows = spark.read.schema("title string, author string, source string").json(where["json"])
    return csv.unionByName(rows.withColumn("file", F.lit("json")))


@query
def tag_page_items(spark, sf_dir):
    """Tag pages made of raw rows, read back."""
    return html.tag_items(tag_pages(adapter.raw(spark, sf_dir))).select("source_id", "title_raw", "author_raw", "publisher", "pub_year", "url")


@query
def json_items(spark, sf_dir):
    """JSON list pages made of raw rows, read back."""
    return json.page_items(json_pages(adapter.raw(spark, sf_dir))).select("source_id", "title_raw", "author_raw", "publisher", "pub_year", "category", "url")


@query
def catalogue_items(spark, sf_dir):
    """A catalogue's result pages made of raw rows, read back."""
    return json.catalogue_items(catalogue_pages(adapter.raw(spark, sf_dir))).select("source_id", "title_raw", "author_raw", "publisher", "pub_year", "isbn", "category")


@query
def tree_leaves(spark, sf_dir):
    """The category tree region / nation / supplier, flattened; every ninth nation has no id and drops out."""
    region, nation, supplier = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    low = supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.collect_list(F.struct(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("CategoryId"), F.col("s_name").alias("title"))).alias("sublist"))
    mid = nation.join(low, "n_nationkey", "left").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.collect_list(F.struct(F.when(F.col("n_nationkey") % 9 != 8, F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))).alias("CategoryId"), F.col("n_name").alias("name"), F.col("sublist").alias("categories"))).alias("sublist"))
    top = region.join(mid, "r_regionkey").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("CategoryId"), F.col("r_name").alias("title"), "sublist")
    tree = top.agg(F.to_json(F.struct(F.array(F.struct(F.collect_list(F.struct("CategoryId", "title", "sublist")).alias("categories"))).alias("data"))).alias("json"))
    return json.tree_leaves(tree)


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category codes of three levels from nations: 01.region.nation."""
    n = table(spark, sf_dir, "nation").select(F.format_string("01.%02d.%02d.00.00.00", F.col("n_regionkey") + 1, F.col("n_nationkey") + 1).alias("cid"))
    r = table(spark, sf_dir, "region").select(F.format_string("01.%02d.00.00.00.00", F.col("r_regionkey") + 1).alias("cid"))
    return r.union(n)


def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page a code, with links to all codes."""
    all_ = codes(spark, sf_dir).agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit('<a href="//category.dangdang.com/cp'), "cid", F.lit('.html">')))), "\n").alias("html"))
    parents = codes(spark, sf_dir).union(spark.range(1).select(F.lit("01.00.00.00.00.00"))).select(F.col("cid").alias("parent"))
    return parents.join(all_)


@query
def category_codes(spark, sf_dir):
    return html.categories(category_pages(spark, sf_dir).select("html"))


@query
def child_categories(spark, sf_dir):
    return html.children(category_pages(spark, sf_dir))


@query
def frontier_levels(spark, sf_dir):
    """Three levels from the root code, without the codes done (those of region 3)."""
    root = spark.range(1).select(F.lit("01.00.00.00.00.00").alias("cid"))
    edges = html.children(category_pages(spark, sf_dir))
    return frontier.expand(root, edges, codes(spark, sf_dir).where(F.col("cid").like("01.03.%")))


@query
def tag_ranking(spark, sf_dir):
    """Tags of index pages by their counts; a tag's last count stands."""
    a = F.concat(F.lit('<a href="/tag/'), F.col("p_type"), F.lit('" class="tag">t</a> ('), F.col("p_size"), F.lit(")"))
    pages = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 100).alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", a.alias("a")))), lambda x: x["a"]), "\n").alias("html"))
    return html.ranked_tags(pages)


@query
def fallback_categories(spark, sf_dir):
    """No page of the crawl links a category, so the fixed ones stand in."""
    return html.or_fallback(html.categories(table(spark, sf_dir, "pages").select("html")), "cid", html.FALLBACK_CATEGORIES)


@query
def page_titles(spark, sf_dir):
    """Heading and link count of each crawled page."""
    title = html.plain(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1))
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(title.cast("binary"), 256).alias("heading_sha256"), F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).cast("long").alias("links"))


def book_triples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Triples of orders as books, customers as authors and nations as their countries; the authors' labels."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    book, author = F.concat(F.lit("B"), F.col("o_orderkey").cast("string")), lambda k: F.concat(F.lit("A"), F.col(k).cast("string"))
    triples = o.select(book.alias("s"), F.lit("P31").alias("p"), F.lit("Q571").alias("o")).union(o.select(book, F.lit("P50"), author("o_custkey"))).union(c.select(author("c_custkey"), F.lit("P27"), F.concat(F.lit("Q"), F.col("c_nationkey").cast("string"))))
    labels = c.select(author("c_custkey").alias("id"), F.col("c_name").alias("label"))
    return triples, labels


@query
def page_stops(spark, sf_dir):
    """Pages of events as a crawl would take them: up to the first one that is not full."""
    pages = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source"), (F.col("user_id") % 50).alias("task_key"), (F.col("event_id") % 40).alias("page"))
    counted = pages.agg(F.count("*").alias("items"), F.max("event_id").alias("last"))
    size = F.when(F.col("last") % 11 != 0, F.col("items") + F.col("last") % 7)
    return ingest.until_short(counted.select("source", "task_key", "page", size.alias("items")), 2)


@query
def gbk_pages(spark, sf_dir):
    """Titles stored in GBK bytes, read back."""

    @F.pandas_udf("binary")
    def stored_as(text: pd.Series) -> pd.Series:
        return text.map(lambda s: s.encode("gbk", "replace"))

    return files.decoded(adapter.raw(spark, sf_dir).select("id", stored_as("title_raw").alias("html")), "gbk").select("id", F.col("html").alias("title"))


@query
def book_pattern(spark, sf_dir):
    """One page of the books by authors of a country."""
    return json.book_pattern(*book_triples(spark, sf_dir), citizenship="Q8", limit=50, offset=10)


@query
def book_pattern_all(spark, sf_dir):
    """All books by authors of a country."""
    return json.book_pattern(*book_triples(spark, sf_dir), citizenship="Q8", limit=None)


@query
def qid_filter(spark, sf_dir):
    """Query results made of raw rows, read back; every fifth label is a bare id."""
    title = F.when(F.col("id") % 5 == 0, F.concat(F.lit("Q"), F.col("id").cast("string"))).otherwise(F.col("title_raw"))
    binding = F.struct(F.struct(title.alias("value")).alias("itemLabel"), F.struct(F.col("author_raw").alias("value")).alias("authorLabel"))
    pages = adapter.raw(spark, sf_dir).groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.to_json(F.struct(F.struct(F.collect_list(binding).alias("bindings")).alias("results"))).alias("json"))
    return json.query_bindings(pages)


@query
def library_docs(spark, sf_dir):
    """Library results made of raw rows, read back; authors come joined."""
    doc = F.struct(F.col("title_raw").alias("title"), F.array("author_raw", "publisher").alias("author_name"))
    pages = adapter.raw(spark, sf_dir).groupBy(F.floor(F.col("id") / 100).alias("page")).agg(F.to_json(F.struct(F.collect_list(doc).alias("docs"))).alias("json"))
    return json.library_docs(pages)


# ---------------------------------------------------------------- the older rules


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.raw(spark, sf_dir).select("id", F.col("title_raw").alias("title"), F.col("author_raw").alias("author"), "source")


@query
def legacy_clean(spark, sf_dir):
    return legacy_rows(spark, sf_dir).select("id", legacy.clean_title(F.col("title")).alias("title"), legacy.clean_author(F.col("author")).alias("author"))


@query
def legacy_dedup(spark, sf_dir):
    return legacy.clean_and_deduplicate(legacy_rows(spark, sf_dir))


@query
def legacy_insert(spark, sf_dir):
    """What all rows add to a table that holds those of two sources."""
    rows = legacy_rows(spark, sf_dir)
    return legacy.new_books(rows, legacy.new_books(rows.where(F.col("source").isin("douban", "weread")), None))


@query
def legacy_country(spark, sf_dir):
    return legacy_rows(spark, sf_dir).select("id", legacy.drop_country(F.col("author")).alias("author"))


@query
def union_distinct(spark, sf_dir):
    rows = legacy_rows(spark, sf_dir).drop("id")
    return legacy.union_distinct(rows.where("source = 'douban'"), rows.where("source = 'weread'")).drop("source")


@query
def document_dedup(spark, sf_dir):
    """Distinct texts of the documents, by digest: the first id of each and how many there are."""
    d = table(spark, sf_dir, "documents")
    return d.groupBy(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))

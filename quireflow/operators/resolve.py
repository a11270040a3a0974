"""Raw rows to candidates, candidates to clusters, clusters to canonical books."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import quality as Q
from ..functions import text as T
from . import lexicon as L
from .components import components
from .storage import by_key, cut, discard, stored

#: Alternative titles listed for a book.
ALIASES = 8


def clean_records(raw: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Every raw row as a candidate, with ``reason`` (null: kept).

    A lexicon hit replaces the cleaned title where the cleaned key is the hit and at least two
    characters more, and the raw title shows text that isn't the title's.
    """
    rows = T.with_clean_title(raw, "title_raw")
    if lexicon is not None:
        rows = L.match(rows, lexicon).withColumn("key", T.title_key(F.col("title")))
        better = F.col("key").startswith(F.col("hit_key")) & (F.length("key") >= F.length("hit_key") + 2) & T.has_tail_noise(F.col("title_raw"))
        better = F.coalesce(better, F.lit(False))
        rows = rows.withColumns({"title": F.when(better, F.col("hit")).otherwise(F.col("title")), "confidence": F.when(better, 1.0).otherwise(F.col("confidence"))})
    # settled here, as the reason names the title in every case and would put the whole choice in its place each time
    rows = T.settled(rows.withColumn("key", T.title_key(F.col("title"))), ["title", "confidence", "key"])
    rows = T.settled(rows.withColumn("reason", Q.reject_reason(F.col("title"), F.col("key"))), ["reason"])
    return rows.select(
        F.col("id").alias("raw_id"), "source", "title", "key", "edition", "volume", T.clean_author(F.col("author_raw")).alias("author"), T.squash(F.col("publisher")).alias("publisher"),
        T.pub_year(F.col("pub_year")).alias("pub_year"), T.isbn13(F.col("isbn")).alias("isbn"), T.squash(F.col("category")).alias("category"), "confidence",
        T.squash(F.col("title_raw")).alias("title_raw"), "reason",
    )


def candidates(records: DataFrame) -> DataFrame:
    return records.where(F.col("reason").isNull()).drop("reason")


def reject_histogram(records: DataFrame, top: int | None = None) -> DataFrame:
    """``reason, n`` of the rejected rows, most first; ties by reason."""
    out = records.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")
    return out.limit(top) if top else out


def clusters(cands: DataFrame) -> DataFrame:
    """``cands`` with ``cluster``: the smallest key reachable over equal keys and equal ISBNs.

    Equal keys are one node from the start; only distinct (key, ISBN) pairs whose ISBN has several
    keys become links, to that ISBN's smallest key. Candidates are kept while they are read; the result
    is stored, as books and members read a few columns of it several times, until it is discarded. Rows
    with equal keys tie in one cluster; a null ISBN links nothing; without candidates there is no row.
    """
    cands = stored(cands, "candidates")
    pairs = cands.where(F.col("isbn") != "").select("key", "isbn").distinct()
    lowest = pairs.groupBy("isbn").agg(F.min("key").alias("low"))
    links = pairs.join(by_key(lowest), "isbn").where("key <> low").select(F.col("key").alias("a"), F.col("low").alias("b"))
    found = components(links)
    roots = found.select(F.col("node").alias("key"), F.col("root").alias("cluster"))
    out = stored(cands.join(by_key(roots), "key", "left").withColumn("cluster", F.coalesce("cluster", "key")), "clusters")
    discard(cands, found)
    return out


def survivors(clustered: DataFrame) -> DataFrame:
    """``cluster, best`` (a struct): priority, confidence, author there, ISBN there, shorter title, first row."""
    order = [-Q.priority(F.col("source")), -F.col("confidence"), F.col("author") == "", F.col("isbn") == "", F.length("title"), F.col("raw_id")]
    payload = ["title", "key", "edition", "volume", "publisher", "pub_year", "isbn", "category", "confidence", "title_raw"]
    ranked = F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)], *payload)
    return clustered.groupBy("cluster").agg(F.min(ranked).alias("best"))


def first_authors(clustered: DataFrame) -> DataFrame:
    return clustered.where(F.col("author") != "").groupBy("cluster").agg(F.min_by("author", "raw_id").alias("author"))


def source_lists(clustered: DataFrame) -> DataFrame:
    """``cluster, sources, n_sources``: distinct sources, most trusted first, then by name."""
    one = clustered.select("cluster", "source").distinct().select("cluster", F.struct((-Q.priority(F.col("source"))).alias("p"), "source").alias("s"))
    listed = one.groupBy("cluster").agg(F.array_sort(F.collect_list("s")).alias("s"))
    return listed.select("cluster", F.array_join(F.col("s.source"), ",").alias("sources"), F.size("s").cast("long").alias("n_sources"))


def alias_lists(clustered: DataFrame, best: DataFrame) -> DataFrame:
    """``cluster, aliases``: the first distinct raw titles but the chosen one's.

    Only one more than are listed can matter, so each group is cut to that many before it is collected.
    """
    titles = clustered.select("cluster", "title_raw").distinct()
    few = titles.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy("title_raw"))).where(F.col("r") <= ALIASES + 1)
    held = few.groupBy("cluster").agg(F.array_sort(F.collect_list("title_raw")).alias("titles"))
    joined = best.select("cluster", F.col("best.title_raw").alias("chosen")).join(by_key(held), "cluster")
    return joined.select("cluster", F.array_join(F.slice(F.array_except("titles", F.array("chosen")), 1, ALIASES), " | ").alias("aliases"))


def canonical_books(clustered: DataFrame) -> DataFrame:
    """One row for each cluster; ``id`` is the smallest raw id of the cluster, in books and members alike."""
    best = survivors(clustered)
    ids = clustered.groupBy("cluster").agg(F.min("raw_id").alias("id"))
    rows = best.join(by_key(ids), "cluster").join(by_key(source_lists(clustered)), "cluster").join(by_key(alias_lists(clustered, best)), "cluster").join(by_key(first_authors(clustered)), "cluster", "left")
    author = F.coalesce("author", F.lit(""))
    b = lambda c: F.col(f"best.{c}")
    return rows.select(
        "id", b("title").alias("title"), b("key").alias("title_key"), b("edition").alias("edition"), b("volume").alias("volume"), author.alias("author"), b("publisher").alias("publisher"),
        b("pub_year").alias("pub_year"), b("isbn").alias("isbn"), b("category").alias("category"), "sources", "n_sources", "aliases",
        Q.score(b("confidence"), F.col("n_sources"), author != "", b("isbn") != "").alias("confidence"),
    )


def members(clustered: DataFrame) -> DataFrame:
    """``book_id, raw_id``: every candidate once."""
    ids = clustered.groupBy("cluster").agg(F.min("raw_id").alias("book_id"))
    return clustered.select("cluster", "raw_id").join(by_key(ids), "cluster").select("book_id", "raw_id")


def numbered(books: DataFrame) -> DataFrame:
    """``id, book_no``: books numbered from 1 in the order of their first row, over a range partitioning."""
    dealt = cut(books.select("id").repartitionByRange("id").sortWithinPartitions("id").withColumn("part", F.spark_partition_id()))
    total, before = 0, []
    for part, n in sorted((r[0], r[1]) for r in dealt.groupBy("part").count().collect()):  # one row for each partition
        before.append((part, total))
        total += n
    offsets = books.sparkSession.createDataFrame(before, "part int, before long")
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return dealt.withColumn("place", place).join(F.broadcast(offsets), "part").select("id", (F.col("before") + F.col("place") + 1).alias("book_no"))


def lineage(books: DataFrame, member_rows: DataFrame, raw: DataFrame) -> DataFrame:
    """Every raw row that made it into a book, with the book's title."""
    return member_rows.join(by_key(books.select(F.col("id").alias("book_id"), "title")), "book_id").join(by_key(raw.select(F.col("id").alias("raw_id"), "source", "title_raw")), "raw_id")

"""Reporting aggregates over raw rows and books, and the Markdown report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def source_breakdown(raw: DataFrame) -> DataFrame:
    """``source, n, n_titles``, most rows first."""
    return raw.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("title_raw").alias("n_titles")).orderBy(F.desc("n"), "source")


def confidence_tiers(books: DataFrame) -> DataFrame:
    """One row: ``high`` (0.9 and more), ``mid`` (0.6 to 0.9), ``low`` (the rest), ``total``."""
    out = books.agg(F.count_if(F.col("confidence") >= 0.9).alias("high"), F.count_if((F.col("confidence") >= 0.6) & (F.col("confidence") < 0.9)).alias("mid"), F.count("*").alias("total"))
    return out.select("high", "mid", (F.col("total") - F.col("high") - F.col("mid")).alias("low"), "total")


def high_confidence_split(books: DataFrame) -> DataFrame:
    return books.groupBy((F.col("confidence") >= 0.9).alias("high")).agg(F.count("*").alias("n")).orderBy(F.desc("high"))


def completeness(books: DataFrame) -> DataFrame:
    """One row: how many books have an author, a publisher, a year, an ISBN."""
    return books.agg(*[F.count_if(F.col(c) != "").alias(f"with_{c}") for c in ("author", "publisher", "pub_year", "isbn")], F.count("*").alias("total"))


def multi_source(books: DataFrame) -> DataFrame:
    return books.agg(F.count_if(F.col("n_sources") > 1).alias("multi"), F.count("*").alias("total")).select("multi", "total", T.percent(F.col("multi"), F.col("total")).alias("share"))


def decade_histogram(books: DataFrame) -> DataFrame:
    """``decade, n`` of the years 1949 to 2029, compared as text."""
    return books.where(F.col("pub_year").between("1949", "2029")).groupBy(T.decade(F.col("pub_year")).alias("decade")).agg(F.count("*").alias("n")).orderBy("decade")


def top_initials(books: DataFrame, top: int = 12) -> DataFrame:
    """``initial, n`` of the keys' first characters; ties in the order they are first seen."""
    rows = books.where(F.col("title_key") != "").groupBy(F.substring("title_key", 1, 1).alias("initial")).agg(F.count("*").alias("n"), F.min("id").alias("first"))
    return rows.orderBy(F.desc("n"), "first").limit(top).select("initial", "n")


def markdown(raw: DataFrame, books: DataFrame) -> str:
    """The report as text; only its small aggregates reach the driver."""
    tiers, full, multi = confidence_tiers(books).first(), completeness(books).first(), multi_source(books).first()
    share = lambda n: f"{n / tiers['total'] * 100:.1f}%" if tiers["total"] else "0%"
    table = lambda head, rows: ["| " + " | ".join(head) + " |", "|" + "---|" * len(head), *["| " + " | ".join(map(str, r)) + " |" for r in rows], ""]
    lines = ["# Report", "", *table(["measure", "value"], [("raw rows", f"{raw.count():,}"), ("books", f"{tiers['total']:,}"), ("in several sources", f"{multi['multi']:,} ({multi['share']})")])]
    lines += table(["source", "rows", "titles"], [(r["source"], f"{r['n']:,}", f"{r['n_titles']:,}") for r in source_breakdown(raw).collect()])
    lines += table(["field", "books", "share"], [(c, f"{full[f'with_{c}']:,}", share(full[f"with_{c}"])) for c in ("author", "publisher", "pub_year", "isbn")])
    lines += table(["confidence", "books", "share"], [(n, f"{tiers[n]:,}", share(tiers[n])) for n in ("high", "mid", "low")])
    lines += table(["decade", "books"], [(r["decade"], f"{r['n']:,}") for r in decade_histogram(books).collect()])
    lines += table(["initial", "books"], [(r["initial"], f"{r['n']:,}") for r in top_initials(books).collect()])
    return "\n".join(lines)


def write_markdown(raw: DataFrame, books: DataFrame, path: str) -> None:
    """The report as a text file in a folder, in any store that the engine writes."""
    raw.sparkSession.createDataFrame([(markdown(raw, books),)], "value string").coalesce(1).write.mode("overwrite").text(path)

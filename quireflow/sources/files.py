"""Files: CSV, JSON, database tables and reports, read and written."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import exists
from .schemas import LEGACY

# Headers of the older CSV and of the export.
LEGACY_HEADERS = {"书名": "title", "作者": "author", "来源": "source"}
EXPORT_HEADERS = {
    "title": "书名", "edition": "版本", "volume": "卷册", "author": "著者", "publisher": "出版社", "pub_year": "出版年",
    "isbn": "ISBN", "category": "分类", "sources": "来源", "n_sources": "来源数", "confidence": "置信度",
}
BOM = "﻿"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """``title, author, source`` of a CSV with a byte order mark and its own headers; empty where there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEGACY)
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    named = {c.removeprefix(BOM): c for c in rows.columns}
    return rows.select(*[F.coalesce(F.col(f"`{named[h]}`"), F.lit("")).alias(n) if h in named else F.lit("").alias(n) for h, n in LEGACY_HEADERS.items()])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """``title, author, source`` of a JSON array; empty where there is no file."""
    if not exists(spark, path):
        return spark.createDataFrame([], LEGACY)
    return spark.read.schema(LEGACY).json(path, multiLine=True)


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table by JDBC."""
    return spark.read.jdbc(url, table, properties=properties or {})


def write_table(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, indexes: tuple[str, ...] = (), indexed_type: str = "VARCHAR(2000)") -> None:
    """A database table by JDBC, replaced, with an index on each of the (text) columns named.

    Databases don't index unbounded text, so these columns are of ``indexed_type``; a longer value fails the write.
    The statements quote columns as the writer creates them, in standard double quotes.
    """
    writer = rows.write.mode("overwrite")
    if indexes:
        writer = writer.option("createTableColumnTypes", ", ".join(f"`{c}` {indexed_type}" for c in indexes))
    writer.jdbc(url, table, properties=properties or {})
    if not indexes:
        return
    jvm = rows.sparkSession.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        settings.setProperty(name, value)
    link = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        statement = link.createStatement()
        for column in indexes:
            statement.execute(f'CREATE INDEX idx_{table}_{column} ON {table} ("{column}")')
        statement.close()
    finally:
        link.close()


def decoded(pages: DataFrame, charset: str, col: str = "html") -> DataFrame:
    """``pages`` with the binary column ``col`` as text of a charset (GBK pages, say); bytes that are none become U+FFFD.

    In Arrow batches, as the engine's own decode() knows UTF charsets, ASCII and Latin-1 only. Null stays null.
    """

    @F.pandas_udf("string")
    def decode(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else bytes(b).decode(charset, "replace"))

    return pages.withColumn(col, decode(F.col(col)))


def _write_csv(rows: DataFrame, path: str) -> None:
    """One ordered CSV file with a byte order mark, quotes doubled, CR LF line ends, white space as it is."""
    marked = rows.withColumnRenamed(rows.columns[0], BOM + rows.columns[0])
    marked.coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", lineSep="\r\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def export_rows(books: DataFrame, min_conf: float = 0.0) -> DataFrame:
    """The exported columns of books of some confidence (0: all): most sources, then confidence, then title."""
    rows = books.where(F.col("confidence") >= min_conf) if min_conf else books
    return rows.select(*EXPORT_HEADERS).orderBy(F.desc("n_sources"), F.desc("confidence"), "title")


def export_csv(books: DataFrame, path: str, min_conf: float = 0.0) -> None:
    _write_csv(export_rows(books, min_conf).withColumnsRenamed(EXPORT_HEADERS), path)


def review_csv(pairs: DataFrame, path: str) -> None:
    _write_csv(pairs.orderBy(F.desc("similarity"), "title_a", "title_b"), path)


def legacy_csv(rows: DataFrame, path: str) -> None:
    _write_csv(rows.select(*[F.col(n).alias(h) for h, n in LEGACY_HEADERS.items()]), path)


def legacy_json(rows: DataFrame, path: str) -> None:
    rows.select("title", "author", "source").write.mode("overwrite").json(path)


def save_all(rows: DataFrame, folder: str, url: str | None = None) -> dict[str, str]:
    """CSV, JSON and, with a database address, a table; gives where each went."""
    out = {"csv": f"{folder}/csv", "json": f"{folder}/json"}
    legacy_csv(rows, out["csv"])
    legacy_json(rows, out["json"])
    if url:
        write_table(rows.select("title", "author", "source"), url, "books", indexes=("title", "author"))
        out["table"] = url
    return out

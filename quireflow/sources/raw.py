"""Scans of the raw table, and adapters that bring other rows to its schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schemas import LISTING, SCAN_COLUMNS


def scan(raw: DataFrame, source: str | None = None) -> DataFrame:
    """The nine columns that cleaning reads, of one source or all; filter and projection reach the files."""
    rows = raw.select(*SCAN_COLUMNS)
    return rows.where(F.col("source") == source) if source else rows


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` of a scan, in at least as many partitions as the session has cores.

    Cleaning a row costs far more than reading it, and a small or unsplittable file is one partition, so one core's
    work. A scan with enough partitions, as of any large table, is left as it is. Only for scans: to count
    the partitions behind a shuffle would run it.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def listing(rows: DataFrame, **columns: Column | str) -> DataFrame:
    """A listing with all columns of the raw schema; absent ones are empty, and rows without a title go."""
    made = {c: columns.get(c, F.lit("")) for c in LISTING}
    out = rows.select(*[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string").alias(n) for n, c in made.items()])
    return out.where(F.col("title_raw") != "")

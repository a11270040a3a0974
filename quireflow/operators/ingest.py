"""Idempotent appends, state tables and rebuilt tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import exists


def new_rows(batch: DataFrame, known: DataFrame | None, keys: tuple[str, ...] = ("source", "source_id"), order: str = "id", title: str | None = "title_raw") -> DataFrame:
    """What an append adds: the first row of each key that the table lacks; rows without a title go.

    A null in a key is a value like any other: rows whose keys are alike, nulls included, are one, and are
    not added again. Of rows that repeat a key the smallest by ``order`` stands, ties by the other columns.
    """
    rows = batch.where(F.col(title) != "") if title else batch
    firsts = rows.groupBy(*keys).agg(F.min(F.struct(order, *[c for c in rows.columns if c not in (order, *keys)])).alias("r")).select(*keys, "r.*").select(*rows.columns)
    if known is None:
        return firsts
    there = known.select(*[F.col(k).alias(f"__known_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__known_{k}")) for k in keys]
    return firsts.join(there, same, "left_anti").select(*rows.columns)


def append(spark: SparkSession, batch: DataFrame, path: str) -> int:
    """Append what is new to the table at ``path``; gives the number of rows added."""
    known = spark.read.schema(batch.schema).parquet(path) if exists(spark, path) else None
    from .storage import cut

    fresh = cut(new_rows(batch, known))
    fresh.write.mode("append").parquet(path)
    return fresh.count()


def upsert(state: DataFrame, changes: DataFrame, keys: tuple[str, ...] = ("source", "task_key"), order: str = "updated_at") -> DataFrame:
    """``state`` with ``changes`` taken in: the latest row of each key stands, changes before state on ties."""
    both = state.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    payload = [c for c in state.columns if c not in keys]
    latest = both.groupBy(*keys).agg(F.max(F.struct(order, "__new", *[c for c in payload if c != order])).alias("r"))
    return latest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in payload]).select(*state.columns)


def read_state(tasks: DataFrame, state: DataFrame, keys: tuple[str, ...] = ("source", "task_key")) -> DataFrame:
    """``tasks`` with done, pages and items; zeros where nothing is known."""
    counts = ("done", "pages", "items")
    return tasks.join(state.select(*keys, *counts), list(keys), "left").select(*tasks.columns, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])


def pending(tasks: DataFrame, state: DataFrame, keys: tuple[str, ...] = ("source", "task_key")) -> DataFrame:
    """Tasks that are not done."""
    return tasks.join(state.where(F.col("done") != 0).select(*keys), list(keys), "left_anti")


def mark_done(rows: DataFrame, keys: tuple[str, ...] = ("source", "task_key")) -> DataFrame:
    """State rows of fetched pages (keys, ``items`` null where the fetch failed): a failed fetch never ends a task."""
    return rows.groupBy(*keys).agg(F.when(F.count_if(F.col("items").isNull()) == 0, 1).otherwise(0).cast("long").alias("done"), F.count("items").alias("pages"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"))


def until_short(pages: DataFrame, full: int, keys: tuple[str, ...] = ("source", "task_key"), order: str = "page", items: str = "items") -> DataFrame:
    """The pages of each task up to its first one with fewer than ``full`` items, which still counts if it has any.

    A page that was not fetched (null items) ends nothing and is left out. Pages that tie in their number
    stand or go together. A task without a short page keeps all its pages; without pages there is no row.
    """
    known = pages.where(F.col(items).isNotNull())
    last = known.where(F.col(items) < full).groupBy(*keys).agg(F.min(order).alias("__last"))
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys]
    joined = known.alias("p").join(last.alias("l"), same, "left")
    return joined.where((F.col(f"p.{items}") > 0) & (F.col("__last").isNull() | (F.col(f"p.{order}") <= F.col("__last")))).select("p.*")


def per_group_limit(rows: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    """At most so many rows of each group (page caps of listings)."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__r") <= most).drop("__r")


_VERSIONS = "number long, version string"


def _current(spark: SparkSession, folder: str):
    """The newest (number, version), or None."""
    path = f"{folder}/versions"
    return spark.read.schema(_VERSIONS).parquet(path).orderBy(F.desc("number")).first() if exists(spark, path) else None


def replace_tables(tables: dict[str, DataFrame], folder: str) -> str:
    """Write all tables as one new version, then name it the newest; a crash in between leaves the old one whole."""
    spark = next(iter(tables.values())).sparkSession
    version, last = uuid.uuid4().hex, _current(spark, folder)
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{version}/{name}")
    number = last["number"] + 1 if last else 1
    spark.createDataFrame([(number, version)], _VERSIONS).coalesce(1).write.mode("append").parquet(f"{folder}/versions")
    return version


def read_version(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the newest version."""
    return spark.read.parquet(f"{folder}/{_current(spark, folder)['version']}/{name}")

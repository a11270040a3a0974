"""A dictionary of clean titles and its longest-prefix match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V
from .storage import by_key


def build(raw: DataFrame, source: str = "douban") -> DataFrame:
    """``key, display`` from one source's raw titles: the first title seen (smallest id) of each key of 2 to 30 characters."""
    title = T.strip_title_wrap(F.col("title_raw"))
    rows = raw.where(F.col("source") == source).select("id", title.alias("display")).withColumn("key", T.title_key(F.col("display")))
    return rows.where(F.length("key").between(2, V.MAX_PREFIX)).groupBy("key").agg(F.min_by("display", "id").alias("display"))


def contains(titles: DataFrame, lexicon: DataFrame, col: str = "title") -> DataFrame:
    """The rows whose title's key the lexicon holds."""
    keyed = titles.withColumn("__key", T.title_key(F.col(col)))
    return keyed.join(lexicon.select(F.col("key").alias("__key")), "__key", "left_semi").drop("__key")


def match(raw: DataFrame, lexicon: DataFrame, col: str = "title_raw") -> DataFrame:
    """``raw`` with ``hit_key, hit``: the longest lexicon key that begins the title's key, null without one.

    Each distinct key is probed once: its prefixes, at most 29, join the lexicon on equality, and the
    longest stays. The lexicon is as long as its source, so it is dealt out by its keys and not broadcast. Joins go by
    structs: as those aren't what the sides are grouped by, the engine can split a prefix or key that has many rows.
    """
    keyed = raw.withColumn("__key", T.title_key(F.col(col)))
    keys = keyed.select("__key").where(F.length("__key") >= 2).distinct()
    sizes = F.sequence(F.lit(2), F.least(F.length("__key"), F.lit(V.MAX_PREFIX)))
    probes = keys.withColumn("n", F.explode(sizes)).withColumn("prefix", F.substr("__key", F.lit(1), F.col("n")))
    held = by_key(lexicon.select(F.struct("key").alias("held"), "key", "display"))
    best = probes.join(held, F.struct(F.col("prefix").alias("key")) == F.col("held")).groupBy("__key").agg(F.max_by("key", "n").alias("hit_key"), F.max_by("display", "n").alias("hit"))
    best = best.select(F.struct("__key").alias("__probed"), "hit_key", "hit")
    return keyed.join(by_key(best), F.struct("__key") == F.col("__probed"), "left").drop("__key", "__probed")


def save(lexicon: DataFrame, path: str) -> None:
    lexicon.write.mode("overwrite").parquet(path)


def load(spark, path: str) -> DataFrame:
    """A saved lexicon; an empty one where there is none."""
    from .storage import exists

    schema = "key string, display string"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)

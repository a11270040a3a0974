"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import by_key, discard, stored

#: Stars halve the longest path each round; a graph that fits a table needs far fewer rounds than this.
MOST_ROUNDS = 100


def _with_lowest(edges: DataFrame, by: str, of: str) -> DataFrame:
    """``edges`` with ``m``, the smallest ``of`` of each ``by``; a node with very many links is no single task's work.

    min() is combined before the shuffle, so such a node leaves each task once. The join goes by the
    node in a struct: as that isn't what the minima are dealt out by, both sides of the join are plain
    shuffles, which the engine splits where a node has many rows.
    """
    lowest = edges.groupBy(by).agg(F.min(of).alias("m")).select(F.struct(by).alias("wrapped"), "m")
    return edges.join(by_key(lowest), F.struct(by) == F.col("wrapped")).drop("wrapped")


def components(links: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b); the root is the smallest node reachable.

    Rows with a null end and links of a node to itself say nothing; a node without other links has no
    row; without any link the result is empty. The last round's links stay in the shared folder until
    the result is discarded. Raises if the stars haven't settled after ``most_rounds``.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    state = _state(edges)
    if not state[0]:
        return _from(edges, edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")))
    for _ in range(most_rounds):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        large = _with_lowest(both, "u", "v").where("v > u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        small = _with_lowest(large, "hi", "lo").select(F.when(F.col("lo") > F.col("m"), F.col("lo")).otherwise(F.col("hi")).alias("hi"), F.col("m").alias("lo"))
        before, edges = edges, stored(small.distinct(), "links")
        discard(before)
        now = _state(edges)
        if now == state:
            return _from(edges, edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(edges.select("lo", "lo").distinct()))
        state = now
    raise RuntimeError(f"components not settled after {most_rounds} rounds")


def _from(edges: DataFrame, out: DataFrame) -> DataFrame:
    out._scratch = edges._scratch  # discarding the result deletes what it is read from
    return out


def _state(edges: DataFrame) -> tuple:
    """How many links there are and a sum over all, which tells two rounds apart."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

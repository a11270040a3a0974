"""Level-by-level expansion of a category tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.storage import cut

#: Levels that are expanded.
LEVELS = 3


def expand(roots: DataFrame, edges: DataFrame, done: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """``cid, level``: what is reached from the roots (level 1), each code at its first level, without done ones.

    ``edges`` are (parent, cid).
    """
    level = roots.select("cid").distinct().withColumn("level", F.lit(1))
    edges = cut(edges)  # read once for each level
    seen = level
    for k in range(2, levels + 1):
        below = level.select(F.col("cid").alias("parent")).join(edges, "parent").select("cid").distinct()
        level = cut(below.join(seen.select("cid"), "cid", "left_anti").withColumn("level", F.lit(k)))
        seen = seen.union(level)
    return seen.join(done.select("cid"), "cid", "left_anti") if done is not None else seen

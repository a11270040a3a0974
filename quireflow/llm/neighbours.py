"""Approximate nearest neighbours by shifted space-filling curves.

Vectors at unit length are projected to ``DIMS`` random directions, shifted, and ordered along a
Hilbert curve, ``CURVES`` times with other directions and shifts. A range partitioning by curve and key
gives every vector a rank on each curve; only names and keys take part in it. A query's candidates are the vectors
within ``window`` ranks of it on any curve. They are compared in the blocks of ranks that the window meets, and the
best of all curves are merged and reranked by the exact cosine of the original vectors in double precision.

How wide the window must be depends on the data: neighbours in clusters stand close on the curves, but
in data without structure they don't. It is chosen by measuring recall for a bounded sample of ``SAMPLE`` vectors
against all vectors: the smallest window that holds ``RECALL`` of their true neighbours. Where that is wider than a block,
``CURVES`` more curves are tried, up to ``MOST_CURVES``, as long as curves times window falls. The
window has no upper limit, so data without structure are searched whole rather than answered wrongly.

A vector goes once to each curve's block that some query asks for, not once for each query; only where more than ``CALLS``
queries meet a block is it dealt out to several tasks. So with a window that doesn't grow, what is
moved grows with the table.

Equal vectors are one class. A class can fill k places of a result with its k + 1 smallest
ids at most, so it carries those and the others are never compared; nothing is lost by it.

Edge cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows with a null id take
no part, nor do vectors whose length differs from the most common one (the greater on ties), however long; rows that repeat an id
with other components are candidates each (the best stands), as queries the smallest vector of the id asks; ties go to the smaller id; with
fewer than k candidates all are given; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from ..operators.storage import discard, stored
from .common import cut

DIMS, BITS, CURVES, MOST_CURVES = 6, 10, 4, 16
SAMPLE, RECALL, FIRST_WINDOW = 100, 0.97, 64
#: Ranks in a block and queries in a group: what one task holds at a time.
BLOCK, CALLS = 4096, 20_000


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (n x d), by Skilling's transposition, for all at once."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(d):
            up = (x[i] & bit) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        t = np.where((x[d - 1] & bit) > 0, t ^ (bit - 1), t)
        bit >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> b & 1)
    return key


def curve(vectors: np.ndarray, number: int) -> np.ndarray:
    """Keys of unit vectors along one of the curves: its own directions and shift, set by its number."""
    rng = np.random.default_rng(1000 + number)
    directions = np.linalg.qr(rng.normal(size=(vectors.shape[1], min(DIMS, vectors.shape[1]))))[0]
    shift = rng.uniform(0, 0.5, directions.shape[1])
    # projections of most vectors lie within a few times 1/sqrt(length)
    scaled = vectors @ directions * np.sqrt(vectors.shape[1]) / 8 + 0.25 + shift
    return hilbert_keys(np.clip(scaled, 0, 1 - 1e-9) * (1 << BITS))


def _matrix(column: pd.Series, kind: str) -> np.ndarray:
    """Vectors from their bytes, in doubles."""
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(float)


def _best(query: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Cosines of all queries with all base vectors in double precision."""
    scores = query @ base.T
    scores /= np.sqrt((query * query).sum(1))[:, None]
    scores /= np.sqrt((base * base).sum(1))[None]
    return scores


def kind_of(rows: DataFrame, vector_col: str) -> str:
    """What a component is kept as: single precision if the column is."""
    return "<f4" if isinstance(rows.schema[vector_col].dataType.elementType, FloatType) else "<f8"


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` (components in bytes), without what takes no part."""
    x, kind = F.col(vector_col), kind_of(rows, vector_col)
    fine = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = rows.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), x.cast("array<float>" if kind == "<f4" else "array<double>").alias("x"))
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    length = sizes[0]["n"] if sizes else 0

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"vec_id": p["vec_id"], "v": [np.asarray(x, kind).tobytes() for x in p["x"]]})

    return rows.where(F.size("x") == length).mapInPandas(over, "vec_id long, v binary")


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """``cls, v, ids, low``: the distinct vectors, the k + 1 smallest ids of each and the smallest.

    Each task keeps the k + 1 smallest ids of a vector before the shuffle, so a very common vector
    leaves no large group.
    """
    one = rows.groupBy(_name("v").alias("cls"), "vec_id").agg(F.first("v").alias("v"))
    few = one.withColumn("r", F.row_number().over(Window.partitionBy("cls").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    return few.groupBy("cls").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("low"))


def _name(v: str) -> Column:
    return F.unhex(F.md5(v))


def places(classes: DataFrame, n: int, curves: range, kind: str) -> DataFrame:
    """``cls, curve, rank``: where each of ``n`` classes stands along some curves, by one range partitioning of names and keys."""

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            if len(p):
                v = _matrix(p["v"], kind)
                v /= np.sqrt((v * v).sum(1))[:, None]
                for c in curves:
                    yield pd.DataFrame({"cls": p["cls"], "curve": c, "key": curve(v, c)})

    keyed = classes.select("cls", "v").mapInPandas(over, "cls binary, curve int, key long")
    dealt = cut(keyed.repartitionByRange("curve", "key", "cls").sortWithinPartitions("curve", "key", "cls").withColumn("part", F.spark_partition_id()))
    counts = sorted((r[0], r[1]) for r in dealt.groupBy("part").count().collect())  # one row for each partition
    before, total = [], 0
    for part, rows in counts:
        before.append((part, total))
        total += rows
    offsets = dealt.sparkSession.createDataFrame(before, "part int, before long")
    # each curve holds n classes, so a curve's ranks begin where those of the curves before end
    return dealt.withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).join(F.broadcast(offsets), "part").select("cls", "curve", (F.col("before") + F.col("place") - (F.col("curve") - curves.start) * F.lit(n)).alias("rank"))


def sampled_neighbours(classes: DataFrame, k: int, kind: str) -> tuple[list[bytes], DataFrame]:
    """The classes of the sample, and ``q, cls``: the k nearest of each by comparison with all."""
    asked = classes.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("cls", "v").collect()  # bounded
    query, names = np.array([np.frombuffer(r["v"], kind) for r in asked]).astype(float), [bytes(r["cls"]) for r in asked]

    def over(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for at in range(0, len(p), BLOCK):
                some = p.iloc[at : at + BLOCK]
                scores = _best(query, _matrix(some["v"], kind))
                held = some["cls"].tolist()
                for q in range(len(names)):
                    top = [j for j in np.argsort(-scores[q], kind="stable")[: k + 1] if bytes(held[j]) != names[q]]
                    yield pd.DataFrame({"q": q, "cls": [held[j] for j in top], "score": scores[q][top]})

    best = classes.select("cls", "v").mapInPandas(over, "q int, cls binary, score double")
    return names, stored(best.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "cls"))).where(F.col("r") <= k).select("q", "cls"), "sample")


def gaps_of(ranks: DataFrame, names: list[bytes], best: DataFrame) -> dict[tuple[int, bytes], int]:
    """How far each true neighbour of the sample stands from its query, on the curve where it is nearest."""
    own = ranks.join(F.broadcast(ranks.sparkSession.createDataFrame(list(enumerate(names)), "q int, cls binary")), "cls").select("q", "curve", F.col("rank").alias("mine"))
    near = ranks.join(F.broadcast(best), "cls").join(F.broadcast(own), ["q", "curve"])
    rows = near.groupBy("q", "cls").agg(F.min(F.abs(F.col("rank") - F.col("mine"))).alias("gap")).collect()  # bounded: k rows a sampled class
    return {(r["q"], bytes(r["cls"])): r["gap"] for r in rows}


def ranked(classes: DataFrame, n: int, k: int, kind: str) -> tuple[DataFrame, int, int]:
    """``cls, curve, rank``, the number of curves and the window, both as measured on the sample."""
    names, best = sampled_neighbours(classes, k, kind)
    chosen, held, gaps = None, [], {}
    for first in range(0, MOST_CURVES, CURVES):
        held.append(stored(places(classes, n, range(first, first + CURVES), kind), "ranks"))
        for pair, gap in gaps_of(held[-1], names, best).items():
            gaps[pair] = min(gap, gaps.get(pair, n))
        window = max(FIRST_WINDOW, int(np.quantile(list(gaps.values()), RECALL, method="higher"))) if gaps else FIRST_WINDOW
        cost = (first + CURVES) * (2 * window + BLOCK)
        if chosen is not None and cost >= chosen[0]:
            break
        chosen = (cost, len(held), window)
        if 2 * window <= BLOCK or n <= BLOCK:
            break
    discard(best, *held[chosen[1] :])
    ranks = held[0]
    for more in held[1 : chosen[1]]:
        ranks = ranks.union(more)
    return ranks, chosen[1] * CURVES, chosen[2]


def tiles_and_calls(classes: DataFrame, ranks: DataFrame, wanted: DataFrame, n: int, window: int) -> tuple[DataFrame, DataFrame]:
    """What is compared: ``curve, block, part`` with classes (cls, v, low, rank), and with queries (q, w, at; ``at_curve, at_block, at_part``).

    A block that no query meets isn't dealt out; one that many meet goes to several parts, each with its share of them.
    """
    block = lambda rank: F.floor(rank / BLOCK)
    last = F.lit((n - 1) // BLOCK)
    span = F.sequence(F.greatest(block(F.col("rank") - window), F.lit(0)), F.least(block(F.col("rank") + window), last))
    calls = ranks.join(wanted, "cls", "left_semi").select(F.col("cls").alias("q"), "curve", F.col("rank").alias("at"), F.explode(span).alias("block"))
    demand = stored(calls.groupBy("curve", "block").agg(F.ceil(F.count("*") / CALLS).cast("int").alias("parts")), "demand")
    tiles = ranks.withColumn("block", block(F.col("rank"))).join(demand, ["curve", "block"]).select("cls", "curve", "block", "rank", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    tiles = tiles.join(classes.select("cls", "v", "low"), "cls")
    calls = calls.join(demand, ["curve", "block"]).select("q", "curve", "block", "at", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int").alias("part"))
    calls = calls.join(classes.select(F.col("cls").alias("q"), F.col("v").alias("w")), "q")
    return tiles, calls.select("q", "w", "at", *[F.col(c).alias(f"at_{c}") for c in ("curve", "block", "part")])


def nearest(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of every row whose id meets ``queries`` (on column vec_id)."""
    kind = kind_of(rows, vector_col)
    base = stored(usable(rows, id_col, vector_col), "vectors")
    classes = stored(classes_of(base, k), "classes")
    asking = stored(base.where(queries).groupBy("vec_id").agg(F.min("v").alias("v")).select(_name("v").alias("cls"), F.col("vec_id").alias("query_id")), "asking")
    discard(base)
    n = classes.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranks, _, window = ranked(classes, n, k, kind)
    tiles, calls = tiles_and_calls(classes, ranks, asking.select("cls").distinct(), n, window)
    where = ("curve", "block", "part")
    found = tiles.groupBy(*where).cogroup(calls.groupBy(*[f"at_{c}" for c in where])).applyInPandas(_best_in_block(window, k, kind), "q binary, cls binary, low long, score double")
    # best classes of each query, then their ids; a class is found by several curves
    merged = found.groupBy("q", "cls").agg(F.max("score").alias("score"), F.first("low").alias("low"))
    top = Window.partitionBy("q").orderBy(F.desc("score"), "low", "cls")
    merged = merged.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1).join(classes.select("cls", "ids"), "cls")
    ids = merged.select("q", "score", F.explode("ids").alias("vec_id")).groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    ids = ids.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    pairs = asking.join(ids.withColumnRenamed("q", "cls"), "cls").where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best_in_block(window: int, k: int, kind: str):
    """The best classes of each query within one block of ranks, as a function of both."""

    def best(tiles: pd.DataFrame, calls: pd.DataFrame) -> pd.DataFrame:
        out = {"q": [], "cls": [], "low": [], "score": []}
        if len(tiles) and len(calls):
            base, ranks, lowest, names = _matrix(tiles["v"], kind), tiles["rank"].to_numpy(), tiles["low"].to_numpy(), tiles["cls"].to_numpy()
            for at in range(0, len(calls), 256):
                some = calls.iloc[at : at + 256]
                scores = _best(_matrix(some["w"], kind), base)
                scores[np.abs(ranks[None] - some["at"].to_numpy()[:, None]) > window] = -np.inf
                for row, q in zip(scores, some["q"], strict=True):
                    few = np.flatnonzero(row >= np.partition(row, -k - 1)[-k - 1]) if len(row) > k + 1 else np.arange(len(row))
                    few = few[np.isfinite(row[few])]
                    for j in few[np.lexsort((lowest[few], -row[few]))][: k + 1]:
                        out["q"].append(q)
                        out["cls"].append(names[j])
                        out["low"].append(lowest[j])
                        out["score"].append(row[j])
        return pd.DataFrame(out, dtype=object)

    return best

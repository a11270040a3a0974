"""Pairs of books with nearly equal titles, for review."""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .storage import by_key

#: So many grams that two sets must share are put into one signature at most, and fewer where a set would get more signatures than that.
DEPTH, SIGNATURES = 4, 64
#: Signatures sent on at once.
BATCH = 50_000


def near_duplicates(books: DataFrame, threshold: float = 0.9, max_block: int | None = None) -> DataFrame:
    """``title_a, title_b, similarity``: titles of one first character and a length differing by at most 1.

    A block (c, n) holds keys of n and n + 1 characters; it is passed over unless it has keys of n
    characters and 2 or more in all. ``max_block`` also passes over blocks of more keys than that, whole; by default none
    are. Not all pairs of a block are made: two sets of a and b grams and of similarity t have
    at least o = ceil(t (a + b) / (1 + t)) in common, so for any k up to o they share k of their first a - o + k
    and b - o + k in any common order. Rare grams come first, and only pairs that have k such grams in common are
    compared, on their full sets. Null and empty keys are in no pair; titles that tie are each a row.
    """
    keys = books.select("title", F.col("title_key").alias("key")).where(F.col("key") != "").withColumns({"c": F.substring("key", 1, 1), "n": F.length("key"), "g": T.grams(F.col("key"))})
    held = keys.groupBy("c", "n").agg(F.count("*").alias("own"), F.collect_set(F.size("g")).alias("sizes"))
    none = F.array().cast("array<int>")
    zero = F.lit(0).cast("long")
    below = held.select("c", (F.col("n") - 1).alias("block"), zero.alias("own"), F.col("own").alias("more"), none.alias("sizes"), F.col("sizes").alias("sizes_above"))
    both = held.select("c", F.col("n").alias("block"), "own", zero.alias("more"), "sizes", none.alias("sizes_above")).unionByName(below)
    blocks = both.groupBy("c", "block").agg(F.sum("own").alias("own"), F.sum("more").alias("more"), F.max("sizes").alias("sizes"), F.max("sizes_above").alias("sizes_above"))
    pool = F.col("own") + F.col("more")
    blocks = blocks.where((F.col("own") > 0) & (pool >= 2) & (pool <= max_block if max_block else F.lit(True))).select("c", "block", "sizes", "sizes_above")
    each = keys.select("c", "n", "key", "title", F.explode("g").alias("gram"))
    often = each.groupBy("c", "gram").agg(F.count("*").alias("often"))
    ranked = each.join(by_key(often), ["c", "gram"]).groupBy("c", "n", "key", "title").agg(F.array_sort(F.collect_set(F.struct("often", "gram"))).alias("g"))
    hashed = ranked.select("c", "n", "key", "title", F.transform("g", lambda x: F.xxhash64(x["gram"])).alias("h"))
    rows = hashed.withColumn("block", F.explode(F.array("n", F.col("n") - 1))).join(by_key(blocks), ["c", "block"])
    if not max_block:  # two keys of n + 1 characters meet in a block of their own, unless it may be passed over
        rows = rows.withColumn("sizes_above", F.when(F.col("n") == F.col("block"), F.col("sizes_above")).otherwise(none))
    rows = rows.select("c", "block", "key", "title", "h", F.array_union("sizes", "sizes_above").alias("sizes"))
    signed = rows.mapInArrow(functools.partial(_signed, threshold=threshold), "c string, block int, less int, most int, own int, sign long, key string, title string")
    at = ["c", "block", "less", "most", "sign"]
    left = signed.select(*at, F.col("own").alias("na"), F.col("key").alias("ka"), F.col("title").alias("ta"))
    right = signed.select(*at, F.col("own").alias("nb"), F.col("key").alias("kb"), F.col("title").alias("tb"))
    pairs = left.join(by_key(right), at).where("na + nb = less + most AND (na < nb OR na = nb AND ka < kb)")  # no filter for one side alone, so the rows are dealt out once
    pairs = T.settled(pairs.withColumn("shared", F.size(F.array_intersect(T.grams(F.col("ka")), T.grams(F.col("kb"))))), ["shared"])
    found = pairs.withColumn("sim", F.col("shared") / (F.col("less") + F.col("most") - F.col("shared"))).where(F.col("sim") >= threshold)
    return found.select(F.least("ta", "tb").alias("title_a"), F.greatest("ta", "tb").alias("title_b"), F.round("sim", 3).alias("similarity")).groupBy("title_a", "title_b").agg(F.max("similarity").alias("similarity"))


def _signed(batches: Iterable[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """The signatures of each row for each size that a partner in its block can have, ``less`` and ``most`` being the two sizes.

    A signature is the sum of the grams' hashes, so two that agree by chance only make one more pair to compare.
    """
    for batch in batches:
        at, signs, n = [], [], 0
        for i, (h, sizes) in enumerate(zip(batch.column("h"), batch.column("sizes").to_pylist(), strict=True)):
            grams = h.values.to_numpy()
            for size in sizes:
                found = _signatures(grams, size, threshold)
                if found is not None:
                    at.append((i, min(size, len(grams)), max(size, len(grams)), len(grams), len(found)))
                    signs.append(found)
                    n += len(found)
            if n > BATCH:
                yield _batch(batch, at, signs)
                at, signs, n = [], [], 0
        if n:
            yield _batch(batch, at, signs)


def _batch(batch: pa.RecordBatch, at: list[tuple[int, ...]], signs: list[np.ndarray]) -> pa.RecordBatch:
    i, less, most, own, times = np.array(at, np.int32).T
    i, less, most, own = (pa.array(np.repeat(x, times)) for x in (i, less, most, own))
    c, block, key, title = (batch.column(name).take(i) for name in ("c", "block", "key", "title"))
    return pa.RecordBatch.from_arrays([c, block, less, most, own, pa.array(np.concatenate(signs)), key, title], ["c", "block", "less", "most", "own", "sign", "key", "title"])


def _signatures(grams: np.ndarray, size: int, threshold: float) -> np.ndarray | None:
    """The signatures of one set, rarest grams first, towards sets of ``size``; none where the two can't be similar."""
    own = len(grams)
    shared = max(math.ceil(threshold / (1 + threshold) * (own + size) - 1e-9), 1)
    if shared > min(own, size):
        return None
    apart = max(own, size) - shared
    if not apart:
        return grams.sum(keepdims=True)
    k = 1
    while k < min(DEPTH, shared) and math.comb(apart + k + 1, k + 1) <= SIGNATURES:
        k += 1
    return grams[_subsets(own - shared + k, k)].sum(axis=1)


@functools.lru_cache(maxsize=1000)
def _subsets(of: int, k: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(of), k)))


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy(F.desc("similarity"), "title_a", "title_b")

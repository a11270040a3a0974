"""Near-duplicate documents by MinHash with tensored banding; links confirmed on full shingle sets.

Two collections of ``M`` MinHash values are computed; table (i, j) is keyed by value i of the first and
value j of the second, so M * M tables cost 2 * M hashes. Two texts of similarity s miss each other in
all tables with a probability of at most 2 * (1 - s)^M: 3e-5 at 0.8 with M = 7.

Texts with equal shingle sets are one class, and classes are what is compared; copies are never
expanded into pairs. A class's key begins with its smallest document id, in bytes that sort as the ids
do, so the smallest key of a component names its id and nothing is looked up by component.
Buckets are not expanded into all pairs either:

1. each class is paired with its bucket's leading class; pairs whose sizes or sketches rule
   the similarity out (five standard deviations) go, the others are confirmed on full sets;
2. in buckets that then still hold several components, pairs across components without the leading
   class are confirmed too. A pair is taken up by the first table it shares.
   A bucket with many such pairs is not expanded: its texts go to one task, which compares all
   their sets and gives only links that connect them.
   A large bucket is worked off in pairs of blocks, in tasks of their own: the leader's component
   against the other classes, and these against each other, so that a large family of near copies costs
   as many blocks as it has, not their square. A block holds about ``BLOCK`` classes and
   ``SHINGLES`` shingles (or one longer text).

So every pair that shares a bucket is confirmed, or ruled out, or already in one component.
What a very common bucket needs is counted before the shuffle and joined back, and the joins are on plain
rows, which the engine splits; a leader's text is never moved once a member.

Edge cases: a text that is null, empty or white space has no shingles and is linked with nothing; a
text of fewer words than a shingle is one shingle; a very long text is hashed whole, in runs; a null
id gives a row whose component is the smallest id of its group (null if there is none) and which is not
kept, unless no row of the group has an id; rows that repeat an id and a text share its component, with
other texts each has its own text's; similarities that tie with the limit are links; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from ..operators.components import components
from ..operators.storage import by_key, discard, stored
from . import common

#: MinHash values in each of the two collections; bins of the sketch.
M, BINS = 7, 256
#: Classes and shingles in a block of a bucket, about.
BLOCK, SHINGLES = 4096, 1 << 21
#: A bucket with more pairs for each class than this is confirmed whole, without a row for each pair.
DENSE = 8
_ODD = np.random.default_rng(77).integers(1, 2**63, 2 * M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sortable(id_: Column, kind: DataType) -> Column:
    """An id in bytes that sort as ids do: 8 bytes of an integer, else two hexadecimal digits a byte of its text; null last."""
    if isinstance(kind, IntegralType):
        digits = F.lpad(F.hex(id_.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    else:
        digits = F.hex(F.concat(F.hex(id_.cast("string")), F.lit("!")))  # ! sorts before the digits, so a prefix comes first
    return F.unhex(F.when(id_.isNull(), "01").otherwise(F.concat(F.lit("00"), digits)))


def id_of(node: Column, kind: DataType) -> Column:
    """The id that a class's key begins with."""
    if isinstance(kind, IntegralType):
        found = F.conv(F.hex(F.substr(node, F.lit(2), F.lit(8))), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    else:
        found = F.unhex(F.substr(node, F.lit(2), F.length(node) - 18).cast("string")).cast("string")
    return F.when(F.substr(node, F.lit(1), F.lit(1)) == F.unhex(F.lit("00")), found).cast(kind)


def text_key(text) -> Column:
    """Digest of a text, which tells rows apart that repeat an id."""
    return F.unhex(F.md5(F.col(text).cast("binary")))


def signatures(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, n, cls, head, sketch``: digest of the text, set size, digest of the set, the MinHash values and the sketch in bytes."""

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        values, rows = common.distinct_by_row(*common.shingles(*common.batch_words(part), width))
        n = np.bincount(rows, minlength=part.num_rows)
        ends = np.cumsum(n)
        full = np.flatnonzero(n)
        head = np.zeros((part.num_rows, 2 * M), "<u4")
        sketch = np.zeros((part.num_rows, BINS), np.uint8)
        if len(values):
            starts = (ends - n)[full]
            for k, odd in enumerate(_ODD):
                head[full, k] = np.minimum.reduceat((values * odd) >> np.uint64(32), starts)
            # values ascend in a row, so of a bin's values the first is the least: assign from the back
            low = common.mix(values) % np.uint64(255) + np.uint64(1)
            place = rows * BINS + (values & np.uint64(BINS - 1)).astype(np.int64)
            sketch.reshape(-1)[place[::-1]] = low[::-1]
        cls = [hashlib.blake2b(values[e - k : e].tobytes(), digest_size=16).digest() if k else None for e, k in zip(ends, n, strict=True)]
        yield {"doc_id": part.column("doc_id"), "text_key": part.column("text_key"), "n": n, "cls": cls, **{c: [x.tobytes() if k else None for x, k in zip(xs, n, strict=True)] for c, xs in (("head", head), ("sketch", sketch))}}

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return common.map_texts(rows, work, f"doc_id {id_type}, text_key binary, n long, cls binary, head binary, sketch binary")


def _plausible(sk_a: np.ndarray, sk_b: np.ndarray, share: float) -> np.ndarray:
    """Whether sketches leave a similarity of ``share`` possible, five standard deviations allowed."""
    used = np.maximum(((sk_a > 0) | (sk_b > 0)).sum(-1), 1)
    same = ((sk_a == sk_b) & (sk_a > 0)).sum(-1)
    return same / used >= share - 5 * np.sqrt(share * (1 - share) / used)


def _sketch_filter(pairs: DataFrame, share: float) -> DataFrame:
    """Of pairs with sizes and sketches, those that may be links."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("sketch_a", "sketch_b"))
                yield part.select(["a", "b"]).filter(pa.array(_plausible(a, b, share)))

    near = pairs.where(F.least("n_a", "n_b") >= share * F.greatest("n_a", "n_b") - 1e-9)
    return near.select("a", "b", "sketch_a", "sketch_b").mapInArrow(common.trimmed(over), "a binary, b binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        sets = [common.distinct_by_row(*common.shingles(*common.batch_words(part, c), width)) for c in ("text", "other")]
        size = [np.bincount(r, minlength=part.num_rows) for _, r in sets]
        values, rows = np.concatenate([sets[0][0], sets[1][0]]), np.concatenate([sets[0][1], sets[1][1]])
        order = np.lexsort((values, rows))
        values, rows = values[order], rows[order]
        shared = np.bincount(rows[1:][(values[1:] == values[:-1]) & (rows[1:] == rows[:-1])], minlength=part.num_rows)
        keep = 100 * shared >= percent * (size[0] + size[1] - shared)
        yield {"a": part.column("a").filter(pa.array(keep)), "b": part.column("b").filter(pa.array(keep))}

    left = texts.select(F.col("node").alias("a"), "text")
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("other"))
    # b's text first: a is the leader of many pairs, and its text should not be dealt out with each of them
    return common.map_texts(pairs.join(by_key(right), "b").join(by_key(left), "a").select("a", "b", "text", "other"), work, "a binary, b binary")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, text``: one text of each wanted class."""
    first = classes.join(by_key(wanted), "node", "left_semi").select("node", F.col("row.doc_id").alias("first_id"), F.col("row.text_key").alias("first_key"))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
    return rows.join(first.hint("shuffle_hash"), same).select("node", "text").dropDuplicates(["node"])  # rows may repeat both


def _groups(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Runs of rows with equal first three columns, from sorted batches."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if group and group[0][:3] != row[:3]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _across(rows: DataFrame, share: float) -> DataFrame:
    """What is left to confirm in buckets with several components; rows come sorted by bucket and block pair.

    Pairs ``a, b`` of classes in different components, taken up by the first table they share. Where a
    bucket has more of them than ``DENSE`` for each class, its classes are given instead, ``b`` null.
    """
    columns = ("key", "bi", "bj", "t", "node", "root", "n", "head", "sketch", "side")

    def pairs_of(group: list[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        n, side, root = np.array([r[6] for r in group]), np.array([r[9] for r in group], bool), np.array([r[5] for r in group])
        head = np.frombuffer(b"".join(r[7] for r in group), "<u4").reshape(len(group), -1)
        sketch = np.frombuffer(b"".join(r[8] for r in group), np.uint8).reshape(len(group), -1)
        i, j = divmod(group[0][3], M)
        two_blocks = group[0][1] != group[0][2]
        for k in range(len(group)):
            if two_blocks and side[k]:
                continue
            others = side if two_blocks else np.arange(len(group)) > k
            others = np.flatnonzero(others & (root != root[k]))
            others = others[np.minimum(n[others], n[k]) >= share * np.maximum(n[others], n[k]) - 1e-9]
            same = head[others] == head[k]
            others = others[(same[:, :M].argmax(1) == i) & same[:, i] & (same[:, M:].argmax(1) == j) & same[:, M + j]]
            if len(others):
                yield k, others[_plausible(sketch[others], sketch[k], share)]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, columns):
            found, total = [], 0
            for k, others in pairs_of(group):
                total += len(others)
                if total > DENSE * len(group):
                    break
                found += [(group[k][4], group[o][4]) for o in others]
            if total > DENSE * len(group):
                out = [(*r[:3], r[4], None, r[9]) for r in group]
            else:
                out = [(None, None, None, min(p), max(p), None) for p in found]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()))], names=["key", "bi", "bj", "a", "b", "side"])

    return rows.mapInArrow(common.trimmed(over), "key long, bi int, bj int, a binary, b binary, side boolean")


def _dense_links(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that connect the classes of dense buckets, from full sets; rows come sorted by bucket and block pair.

    Intersections come as products of incidence matrices over the shingles that several texts hold, a
    few columns and rows at a time. Links within one component already found here are not given.
    """

    def links_of(group: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        batch = pa.record_batch({"text": pa.array([r[4] for r in group])})
        values, owner = [], []
        at = 0
        for part in common.runs(batch, "text"):
            v, r = common.distinct_by_row(*common.shingles(*common.batch_words(part), width))
            values.append(v)
            owner.append(r + at)
            at += part.num_rows
        values, owner = np.concatenate(values), np.concatenate(owner)
        n = np.bincount(owner, minlength=len(group))
        _, column, uses = np.unique(values, return_inverse=True, return_counts=True)
        shared = uses > 1
        number = np.cumsum(shared) - 1
        owner, column = owner[shared[column]], number[column[shared[column]]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        wide = int(shared.sum())
        side = np.array([r[5] for r in group], bool)
        left, right = (np.flatnonzero(~side), np.flatnonzero(side)) if side.any() and not side.all() else (np.arange(len(group)),) * 2
        parent = list(range(len(group)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for at in range(0, len(left), 512):
            mine = left[at : at + 512]
            both = np.zeros((len(mine), len(right)), np.float32)
            for c in range(0, wide, 2048):
                lo, hi = np.searchsorted(column, [c, c + 2048])
                matrix = np.zeros((len(group), min(2048, wide - c)), np.float32)
                matrix[owner[lo:hi], column[lo:hi] - c] = 1
                both += matrix[mine] @ matrix[right].T
            linked = 100 * both >= percent * (n[mine][:, None] + n[right][None] - both)
            for x, y in zip(*np.nonzero(linked), strict=True):
                a, b = int(mine[x]), int(right[y])
                if a != b and (p := top(a)) != (q := top(b)):
                    parent[p] = q
                    yield group[a][3], group[b][3]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("key", "bi", "bj", "node", "text", "side")):
            found = list(links_of(group))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in found], pa.binary()) for c in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(common.trimmed(over), "a binary, b binary")


def _classes(rows: DataFrame) -> DataFrame:
    """The distinct shingle sets: ``cls, h, node, row, n, head, sketch``; ``row`` is the smallest id's, ``node`` begins with it."""
    one = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("row"), *[F.first(c).alias(c) for c in ("n", "head", "sketch")])
    return one.withColumns({"h": F.xxhash64("cls"), "node": F.concat(sortable(F.col("row.doc_id"), rows.schema["doc_id"].dataType), "cls")})


def _buckets(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``h, key, t, lead, size`` of the classes in buckets of several, and what it was joined from.

    Sizes and leaders are combined before the shuffle and joined back, so no task holds a very common bucket.
    """
    part = lambda k: F.substring("head", k * 4 + 1, 4)
    values = classes.select("h", F.array(*[part(k) for k in range(M)]).alias("x"), F.array(*[part(M + k) for k in range(M)]).alias("y"))
    tables = values.select("h", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(M * M - 1))).alias("t"))
    keys = tables.select("h", F.xxhash64("t", F.get("x", F.floor(F.col("t") / M).cast("int")), F.get("y", F.col("t") % M)).alias("key"), F.col("t").cast("byte").alias("t"))
    shared = stored(keys.groupBy("key").agg(F.min("h").alias("lead"), F.count("*").alias("size")).where("size > 1"), "buckets")
    return keys.join(by_key(shared), "key"), shared


def _blocks(members: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(members / BLOCK), F.ceil(shingles / SHINGLES)).cast("int")


def _dealt(held: DataFrame, classes: DataFrame, roots: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Rows of the buckets that hold several components, once for each pair of blocks they are needed in; and what that is made from.

    Pairs of blocks: bi < 0 is block -1 - bi of the leader's component against block bj of the others;
    bi >= 0 are two blocks of the others, or one with itself. The leader takes no part, it is done.
    """
    info = classes.join(by_key(roots), "node", "left").select("h", F.xxhash64(F.coalesce("root", "node")).alias("root"), "n")
    members = held.where("size > 2").join(by_key(info), "h")
    found = members.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max(F.when(F.col("h") == F.col("lead"), F.col("root"))).alias("main")).where("r0 <> r1").select("key", "main")
    mixed = stored(found, "mixed")
    rest = stored(members.where("h <> lead").join(by_key(mixed), "key").select("key", "h", "t", "root", "n", (F.col("root") == F.col("main")).alias("major")), "open")
    of = lambda value, major: F.sum(F.when(F.col("major") == major, value).otherwise(0))
    counts = stored(rest.groupBy("key").agg(_blocks(of(1, True), of(F.col("n"), True)).alias("bm"), _blocks(of(1, False), of(F.col("n"), False)).alias("bn")).where("bn > 0"), "blocks")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda bi, bj, side: F.struct(bi.cast("int").alias("bi"), bj.cast("int").alias("bj"), side.alias("side"))
    mine, bm, bn = F.col("mine"), F.col("bm"), F.col("bn")
    as_major = F.transform(upto(bn), lambda j: place(-1 - mine, j, F.lit(False)))
    as_minor = F.concat(F.transform(upto(bm), lambda i: place(-1 - i, mine, F.lit(True))), F.transform(upto(bn), lambda o: place(F.least(mine, o), F.greatest(mine, o), mine > o)))
    rows = rest.join(by_key(counts), "key").withColumn("mine", F.pmod(F.xxhash64("h", F.lit(1)), F.when(F.col("major"), bm).otherwise(bn)).cast("int"))
    rows = rows.join(by_key(classes.select("h", "node", "head", "sketch")), "h").withColumn("place", F.explode(F.when(F.col("major"), as_major).otherwise(as_minor)))
    rows = rows.select("key", "place.bi", "place.bj", "t", "node", "root", "n", "head", "sketch", "place.side")
    return rows.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "node"), [mixed, rest, counts]


def classes_and_components(docs: DataFrame, width: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``doc_id, text_key, n, cls`` of every row, and ``cls, component`` (the smallest id of its component) of every class."""
    share, kind = percent / 100, docs.schema[id_col].dataType
    signed = signatures(docs, width, id_col, text_col)
    rows = stored(signed, "signatures")
    classes = stored(_classes(rows), "classes")
    held, shared = _buckets(classes)
    held = stored(held, "held")
    discard(shared)

    side = lambda x: classes.select(F.col("h").alias(f"h_{x}"), F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    stars = held.where("h <> lead").select(F.col("lead").alias("h_a"), F.col("h").alias("h_b")).distinct()
    stars = stored(_sketch_filter(stars.join(by_key(side("b")), "h_b").join(by_key(side("a")), "h_a"), share), "stars")
    wanted = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    texts = stored(_texts(docs, classes, wanted, id_col, text_col), "texts")
    links = stored(_confirmed(stars, texts, width, percent), "confirmed")
    roots = components(links)

    # the rest: pairs across components in buckets of three and more classes
    dealt, made = _dealt(held, classes, roots)
    more = stored(_across(dealt, share), "across")
    discard(stars, held, *made)
    if not more.isEmpty():
        pairs, dense = more.where("b IS NOT NULL").select("a", "b").distinct(), more.where("b IS NULL").select("key", "bi", "bj", F.col("a").alias("node"), "side")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(dense.select("node")).distinct()
        missing = stored(_texts(docs, classes, wanted.join(by_key(texts.select("node")), "node", "left_anti"), id_col, text_col), "texts")
        both = texts.join(by_key(wanted), "node", "left_semi").union(missing)
        whole = dense.join(by_key(both), "node").repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "node")
        late = stored(_confirmed(pairs, both, width, percent).union(_dense_links(whole.select("key", "bi", "bj", "node", "text", "side"), width, percent)), "confirmed")
        discard(missing, roots)
        roots = components(links.union(late))
        discard(late)
    component = id_of(F.coalesce("root", "node"), kind)
    comps = stored(classes.join(by_key(roots), "node", "left").select("cls", component.alias("component")), "components")
    discard(more, texts, links, classes, roots)
    return rows.select("doc_id", "text_key", "n", "cls"), comps


def find(docs: DataFrame, width: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", keep_key: bool = False) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row, and its ``text_key`` if ``keep_key``."""
    rows, comps = classes_and_components(docs, width, percent, id_col, text_col)
    out = rows.join(by_key(comps), "cls", "left").withColumn("component", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component")))
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"), *(["text_key"] if keep_key else []))

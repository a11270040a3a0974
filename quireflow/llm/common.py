"""What the operators of this subpackage share: shared storage, Arrow batches, vectorised words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import cut, scratch_path, shared_dir  # noqa: F401

#: Texts are handled in runs of about this many bytes, so that a task's memory doesn't follow its partition.
RUN_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def runs(batch: pa.RecordBatch, column: str, limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = batch.column(column).fill_null("").cast(pa.large_string())
    ends = np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes) + 1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return batch.column(column).fill_null("").to_pylist()


def _trim() -> None:
    """Give memory that is free back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def trimmed(over: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``over``, which gives back at the end of a task what it has freed.

    Python workers outlive tasks and stages; each would else keep the most that any of its tasks took.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from over(batches)
        finally:
            _trim()

    return run


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: str, column: str = "text") -> DataFrame:
    """``work`` on runs of rows; it gets a record batch and gives dicts of columns (lists or arrays)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, column):
                for columns in work(part):
                    arrays = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(trimmed(over), schema)


def held_out(doc_id) -> object:
    """Rows kept for measuring: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ---------------------------------------------------------------- vectorised words

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(20240607).integers(1, 2**63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(data: np.ndarray, doc_starts: np.ndarray, lower: bool = True, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of bytes other than space and \\t to \\r) of texts laid end to end.

    ``data`` is the UTF-8 bytes; ``doc_starts`` where each text starts; ``space`` marks other bytes
    between words instead. Returns 64-bit hashes of the
    words (A-Z lower-cased if ``lower``), starts, ends and the index of each word's text.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    solid = ~space[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = doc_starts[(doc_starts > 0) & (doc_starts < len(data))]
    first[inner] = solid[inner]  # a text starts a new word
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[inner - 1] = solid[inner - 1]
    ends = np.flatnonzero(last) + 1
    place = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(data)]])))
    value = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    value *= _SEEDS[place & 0xFFF] + (place >> 12).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C16)
    value[~solid] = 0
    hashes = mix(np.add.reduceat(value, starts) + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return hashes, starts, ends, np.searchsorted(doc_starts, starts, "right") - 1


def bytes_of(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch's texts end to end, and the n + 1 places where they start and end."""
    col = batch.column(column).fill_null("").cast(pa.large_string())
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[ends[0] : ends[-1]] if col.buffers()[2] is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def batch_words(batch: pa.RecordBatch, column: str = "text", lower: bool = True, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a batch and each word's row. A text of many runs is cut at spaces, so memory stays bounded."""
    data, ends = bytes_of(batch, column)
    if len(data) <= 4 * RUN_BYTES:
        hashes, _, _, docs = words_of(data, ends[:-1], lower, space)
        return hashes, docs
    parts, docs = [], []  # a batch that big is one text
    at = 0
    while at < len(data):
        to = min(len(data), at + RUN_BYTES)
        while to < len(data) and not _SPACE[data[to]]:
            more = np.flatnonzero(_SPACE[data[to : to + RUN_BYTES]])
            to = to + int(more[0]) if len(more) else min(len(data), to + RUN_BYTES)
        inside = ends[:-1][(ends[:-1] > at) & (ends[:-1] < to)]
        h, starts, _, _ = words_of(data[at:to], np.append(0, inside - at), lower, space)
        parts.append(h)
        docs.append(np.searchsorted(ends[:-1], starts + at, "right") - 1)
        at = to
    return np.concatenate(parts), np.concatenate(docs)


def shingles(hashes: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words and their rows; a text with fewer words has its whole sequence as one."""
    n = len(hashes)
    out = np.zeros(0, np.uint64)
    rows = np.zeros(0, docs.dtype)
    if n >= width:
        whole = docs[: n - width + 1] == docs[width - 1 :]
        acc = np.zeros(n - width + 1, np.uint64)
        for k in range(width):
            acc += hashes[k : n - width + 1 + k] * _SEEDS[k + 7]
        out, rows = mix(acc[whole]), docs[: n - width + 1][whole]
    if n:
        ids, first, counts = np.unique(docs, return_index=True, return_counts=True)
        short = counts < width
        if short.any():
            add = [mix(np.array([sum(int(h) * int(_SEEDS[k + 7]) for k, h in enumerate(hashes[f : f + c])) % 2**64 ^ int(c) * 0x5851F42D4C957F2D % 2**64], np.uint64))[0] for f, c in zip(first[short], counts[short], strict=True)]
            out, rows = np.concatenate([out, np.array(add, np.uint64)]), np.concatenate([rows, ids[short]])
    return out, rows


def distinct_by_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, by row then value."""
    if not len(values):
        return values, rows
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], rows[new]

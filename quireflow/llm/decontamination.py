"""Benchmark decontamination: a BM25 inverted index of test items, searched with every training passage.

Words are runs of letters, digits and non-ASCII characters, in lower case. An item is cut into
segments of at most ``SEGMENT`` words; postings hold a segment's BM25 impact of a term as a share of the
segment's score against itself, so 1 is a verbatim copy and one threshold fits all. Term and length statistics
are those of the whole benchmark, however it is dealt out. A document's passages are windows of
``2 * SEGMENT`` words every ``SEGMENT`` words, so that any copy of a segment lies in one of them.

Every passage is a query for all segments at or above ``THRESHOLD``. A segment is posted under its most telling
terms only, until the impacts of its other terms together are at most half of the threshold; so a passage without
any of these terms can't reach it, and common words have no long lists. The lists are in the order of segments, with
the maxima of each block of ``BLOCK`` segments. For all passages of a batch at once the block maxima bound
what a passage can reach in any block; the few passages that can reach the threshold walk the lists by block-max
WAND: the pivot is the first list up to which the lists' maxima reach the threshold, blocks whose maxima don't are skipped
over the whole index, and a pivot that is left is scored by all its terms.

What is retrieved is verified: of the item's
question (all but its last sentence) and of its answer (the last sentence) at least ``OVERLAP`` of the
word n-grams must stand in the passages, or the passages hold a stretch that is the whole item but for edits
(words replaced, left out or put in) of at most ``1 - ALIGNED`` of its words: a few words in a short
answer change most of its n-grams. Items of fewer than ``MIN_WORDS`` words have too few n-grams for that:
they are found where their whole sequence of words stands in a document.

The index is built on the driver and sent to the executors, ``SHARD`` segments at most at a time (rows that repeat an item
are one); a larger benchmark is searched in several passes over the documents.

Edge cases: items whose text is null or has no word are not searched for; null and empty documents match nothing; very long
documents are searched whole; rows that repeat a document or an item id are merged (the best of them stands), ties
alike; a null document or item id gives rows with a null id; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SEGMENT, BLOCK, SHARD = 64, 8, 32_768
K1, B = 1.2, 0.75
THRESHOLD, OVERLAP, GRAM, MIN_WORDS = 0.6, 0.6, 4, 8
ALIGNED = 0.85
#: Bounds (passages x blocks) that are held at a time.
BOUNDS = 1 << 21

#: Bytes between words: ASCII other than letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def item_words(text: str) -> np.ndarray:
    return common.batch_words(pa.record_batch({"text": [text]}), space=BETWEEN)[0]


def question_and_answer(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Words of all sentences but the last, and of the last; of a single sentence, two thirds and the rest."""
    sentences = [s for s in re.split(r"(?<=[.?!\n])\s+", text.strip()) if len(item_words(s))]
    words = item_words(text)
    last = len(item_words(sentences[-1])) if len(sentences) > 1 else max(1, len(words) // 3)
    return words[:-last], words[-last:]


def grams(words: np.ndarray) -> np.ndarray:
    """Distinct n-grams of a run of words; of fewer words, their whole sequence."""
    return np.unique(common.shingles(words, np.zeros(len(words), np.int64), GRAM)[0])


def aligned(item: np.ndarray, text: np.ndarray) -> float:
    """1 less the edits, as a share of the item's words, that lead from the item to the nearest stretch of the text."""
    at = np.arange(len(text) + 1)
    edits = np.zeros(len(text) + 1, np.int64)  # least edits from the item's words so far to a stretch that ends there
    for k, word in enumerate(item):
        here = np.append(k + 1, np.minimum(edits[:-1] + (text != word), edits[1:] + 1))
        edits = np.minimum.accumulate(here - at) + at
    return 1 - float(edits.min()) / len(item)


def stretches(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that meet or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@dataclass
class Statistics:
    """How many of the benchmark's segments hold each term, and their number and words."""

    vocab: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    segments: int = 0
    words: int = 0

    def add(self, segments: list[np.ndarray]) -> None:
        terms, counts = np.unique(np.concatenate([np.unique(w) for w in segments]), return_counts=True)
        vocab, place = np.unique(np.concatenate([self.vocab, terms]), return_inverse=True)
        self.df = np.bincount(place, np.concatenate([self.df, counts]), len(vocab)).astype(np.int64)
        self.vocab = vocab
        self.segments += len(segments)
        self.words += sum(map(len, segments))


class Index:
    """Postings of segments with normalised BM25 impacts.

    Each segment's terms and impacts stand together (``post_*``, by segment, for scoring). The lists
    that are searched hold a segment under its most telling terms, until the impacts of the others sum to at
    most half of ``threshold``, the least that can be searched for.
    """

    def __init__(self, segments: list[tuple[int, np.ndarray]], statistics: Statistics | None = None, threshold: float = THRESHOLD) -> None:
        self.items = np.array([i for i, _ in segments])  # the item of each segment
        self.threshold, n = threshold, len(segments)
        self.blocks = -(-n // BLOCK)
        if statistics is None:
            statistics = Statistics()
            statistics.add([w for _, w in segments])
        terms, owner = np.concatenate([w for _, w in segments]), np.repeat(np.arange(n), [len(w) for _, w in segments])
        self.vocab, term = np.unique(terms, return_inverse=True)
        pair, tf = np.unique(owner.astype(np.int64) * len(self.vocab) + term, return_counts=True)
        self.post_seg, self.post_term = np.divmod(pair, len(self.vocab))
        length = np.array([len(w) for _, w in segments])
        df = statistics.df[np.searchsorted(statistics.vocab, self.vocab)]
        idf = np.log1p((statistics.segments - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length / (statistics.words / statistics.segments))
        impact = idf[self.post_term] * tf * (K1 + 1) / (tf + norm[self.post_seg])
        self.impact = impact / np.bincount(self.post_seg, impact, n)[self.post_seg]
        self.seg_starts = np.searchsorted(self.post_seg, np.arange(n + 1))
        # telling terms: by falling impact, those before which more than half of the threshold is left
        order = np.lexsort((-self.impact, self.post_seg))
        sums = np.cumsum(self.impact[order])
        before = sums - self.impact[order] - np.append(0, sums)[self.seg_starts[:-1]][self.post_seg[order]]
        telling = np.zeros(len(order), bool)
        telling[order] = 1 - before > threshold / 2
        self.rest = np.bincount(self.post_seg, np.where(telling, 0, self.impact), n)
        order = np.flatnonzero(telling)
        order = order[np.lexsort((self.post_seg[order], self.post_term[order]))]
        self.list_term, self.list_seg, self.list_impact = self.post_term[order], self.post_seg[order], self.impact[order]
        self.starts = np.searchsorted(self.list_term, np.arange(len(self.vocab) + 1))
        # the maxima of each list's blocks, and of the blocks' rests
        one, at = np.unique(self.list_term * self.blocks + self.list_seg // BLOCK, return_index=True)
        self.max_term, self.max_block = np.divmod(one, self.blocks)
        self.max_impact = np.maximum.reduceat(self.list_impact, at)
        self.max_starts = np.searchsorted(self.max_term, np.arange(len(self.vocab) + 1))
        self.rest_block = np.maximum.reduceat(self.rest, np.arange(0, n, BLOCK))
        self._lists: dict[int, tuple] = {}

    def term_ids(self, words: np.ndarray) -> np.ndarray:
        """The term of each word, or -1."""
        at = np.minimum(np.searchsorted(self.vocab, words), len(self.vocab) - 1)
        return np.where(self.vocab[at] == words, at, -1)

    def _list(self, term: int) -> tuple[list[int], dict[int, float], float]:
        """A term's segments, the maxima of its blocks, and its greatest impact."""
        if term not in self._lists:
            if len(self._lists) > 50_000:
                self._lists.clear()
            some = slice(self.max_starts[term], self.max_starts[term + 1])
            maxima = dict(zip(self.max_block[some].tolist(), self.max_impact[some].tolist(), strict=True))
            self._lists[term] = (self.list_seg[self.starts[term] : self.starts[term + 1]].tolist(), maxima, max(maxima.values(), default=0.0))
        return self._lists[term]

    def wand(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """(segment, score) of all segments at or above the threshold for a passage's distinct terms, by block-max WAND.

        The lists stand sorted by their current segment; the pivot is the first list up to which the
        lists' maxima and the greatest rest reach the threshold. If the maxima of the pivot's block don't, all
        lists up to it move past the block, or to the next list's segment if that comes first. Else a pivot that all
        lists before it have reached is scored, and one that they haven't moves them up to it.
        """
        if threshold < self.threshold - 1e-9:
            raise ValueError("the index was made for a greater threshold")
        found, n, need = [], len(self.items), threshold - float(self.rest.max(initial=0.0)) - 1e-9
        cursors = [[ids[0], 0, ids, maxima, top] for ids, maxima, top in map(self._list, terms.tolist()) if ids]
        while True:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c[4]
                if bound >= need:
                    pivot = k
                    break
            if pivot is None:
                return found
            segment = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == segment:
                pivot += 1
            block = segment // BLOCK
            if sum(c[3].get(block, 0.0) for c in cursors[: pivot + 1]) + self.rest_block[block] < threshold - 1e-9:
                aim = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    aim = min(aim, cursors[pivot + 1][0])
            elif cursors[0][0] == segment:
                a, b = self.seg_starts[segment], self.seg_starts[segment + 1]
                score = float(self.impact[a:b][np.isin(self.post_term[a:b], terms)].sum())
                if score >= threshold - 1e-9:
                    found.append((segment, score))
                aim = segment + 1
            else:
                aim = segment
            for c in cursors[: pivot + 1]:
                if c[0] < aim:
                    c[1] = bisect.bisect_left(c[2], aim, c[1])
                    c[0] = c[2][c[1]] if c[1] < len(c[2]) else n
            cursors = [c for c in cursors if c[0] < n]

    def _reach(self, window: np.ndarray, term: np.ndarray, count: int, threshold: float) -> np.ndarray:
        """Which of ``count`` windows can reach the threshold in some block; by their distinct terms, sorted by window."""
        out = np.zeros(count, bool)
        lengths = self.max_starts[term + 1] - self.max_starts[term]
        window, term, lengths = window[lengths > 0], term[lengths > 0], lengths[lengths > 0]
        step = max(1, BOUNDS // self.blocks)
        for low in range(0, count, step):
            lo, hi = np.searchsorted(window, [low, low + step])
            if lo == hi:
                continue
            size = lengths[lo:hi]
            place = np.repeat(self.max_starts[term[lo:hi]] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            wide = min(step, count - low)
            sums = np.bincount(np.repeat(window[lo:hi] - low, size) * self.blocks + self.max_block[place], self.max_impact[place], wide * self.blocks)
            # a block that no telling term is in has only its rests, which are less than the threshold
            out[low : low + wide] = (sums.reshape(wide, self.blocks) + self.rest_block >= threshold - 1e-6).any(1)
        return out

    def search(self, words: np.ndarray, docs: np.ndarray, threshold: float) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, first word, end, segment, score) of all passages and segments at or above the threshold."""
        if not len(words):
            return
        first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        inside = np.arange(len(words)) - np.repeat(first, np.diff(np.append(first, len(words))))
        begins = np.flatnonzero(inside % SEGMENT == 0)
        step = np.cumsum(inside % SEGMENT == 0) - 1  # runs of SEGMENT words, numbered over the batch
        terms = self.term_ids(words)
        hit = np.flatnonzero((terms >= 0) & (np.diff(self.starts) > 0)[terms])
        if not len(hit):
            return
        # each run belongs to the window it begins and to the one that the run before it (same text) begins
        later = hit[inside[hit] >= SEGMENT]
        pairs = np.unique(np.concatenate([step[hit] * len(self.vocab) + terms[hit], (step[later] - 1) * len(self.vocab) + terms[later]]))
        window, term = np.divmod(pairs, len(self.vocab))
        for w in np.flatnonzero(self._reach(window, term, len(begins), threshold)).tolist():
            start = int(begins[w])
            row = int(docs[start])
            stop = min(start + 2 * SEGMENT, int(np.searchsorted(docs, row, "right")))
            there = np.unique(terms[start:stop])
            for segment, score in self.wand(there[there >= 0], threshold):
                yield row, start, stop, segment, score


def segments_of(item: int, text: str) -> list[tuple[int, np.ndarray]]:
    words = item_words(text)
    parts = -(-len(words) // SEGMENT)
    return [(item, part) for part in np.array_split(words, parts)]


@dataclass
class Shard:
    """A part of the benchmark as it is sent to the executors; items are known by their row number in it."""

    ids: list  # the id of each item
    index: Index | None
    parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # question and answer n-grams and words
    short: dict[int, dict[bytes, list[int]]]  # items of few words by their number of words, and the words


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[object, str, np.ndarray]]:
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.lower(text_col).alias("t")).distinct().orderBy("i", "t")
    for item, text in rows.toLocalIterator():
        if len(words := item_words(text)):
            yield item, text, words


def _shard(items: list[tuple[object, str, np.ndarray]], statistics: Statistics, threshold: float) -> Shard:
    segments, parts, short = [], {}, {}
    for k, (_, text, words) in enumerate(items):
        if len(words) < MIN_WORDS:
            short.setdefault(len(words), {}).setdefault(words.tobytes(), []).append(k)
        else:
            segments += segments_of(k, text)
            question, answer = question_and_answer(text)
            parts[k] = (grams(question), grams(answer), words)
    return Shard([i for i, _, _ in items], Index(segments, statistics, threshold) if segments else None, parts, short)


def shards(benchmark: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD) -> Iterator[Shard]:
    """The benchmark's items, at most about SHARD segments at a time.

    The driver holds one shard and a count for each distinct word of the benchmark. Statistics are taken
    over all items first, so an item scores alike in any shard.
    """
    statistics, first, size = Statistics(), [], 0
    for item in _items(benchmark, id_col, text_col):
        cut = [part for _, part in segments_of(0, item[1])]
        if len(item[2]) >= MIN_WORDS:
            statistics.add(cut)
        size += len(cut)
        if size <= SHARD:
            first.append(item)
    if size <= SHARD:
        if first:
            yield _shard(first, statistics, threshold)
        return
    held, size = [], 0
    for item in _items(benchmark, id_col, text_col):
        held.append(item)
        size += -(-len(item[2]) // SEGMENT)
        if size >= SHARD:
            yield _shard(held, statistics, threshold)
            held, size = [], 0
    if held:
        yield _shard(held, statistics, threshold)


def _short_hits(short: dict[int, dict[bytes, list[int]]], words: np.ndarray, rows: np.ndarray) -> set[tuple[int, int]]:
    """(row, item) where a whole item of few words stands."""
    found = set()
    for width, items in short.items():
        if len(words) < width:
            continue
        begins = np.unique(np.frombuffer(b"".join(k[:8] for k in items), np.uint64))
        last = len(words) - width + 1
        for at in np.flatnonzero(np.isin(words[:last], begins) & (rows[:last] == rows[width - 1 :])).tolist():
            found.update((int(rows[at]), k) for k in items.get(words[at : at + width].tobytes(), ()))
    return found


def _search_shard(docs: DataFrame, shard: Shard, threshold: float, overlap: float, id_type: str, item_type: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(shard)

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        one = shared.value
        words, rows = common.batch_words(part, space=BETWEEN)
        hits: dict[tuple[int, int], tuple[float, list[tuple[int, int]]]] = {}
        for row, start, stop, segment, score in one.index.search(words, rows, threshold) if one.index else ():
            key = (row, int(one.index.items[segment]))
            best, spans = hits.get(key, (0.0, []))
            hits[key] = (max(best, score), [*spans, (start, stop)])
        ids, out = part.column("doc_id").to_pylist(), [(row, k, 1.0, 1.0, 1.0) for row, k in sorted(_short_hits(one.short, words, rows))]
        for (row, k), (score, spans) in hits.items():
            question, answer, item = one.parts[k]
            there = np.unique(np.concatenate([grams(words[a:b]) for a, b in sorted(set(spans))]))
            shares = [float(np.isin(g, there).mean()) if len(g) >= 1 else 1.0 for g in _shortened((question, answer), words, spans, there)]
            if min(shares) >= overlap or any(aligned(item, words[a:b]) >= ALIGNED - 1e-9 for a, b in stretches(spans)):
                out.append((row, k, score, *shares))
        if out:
            yield {"doc_id": [ids[r[0]] for r in out], "item_id": [one.ids[r[1]] for r in out], **{name: [r[k] for r in out] for k, name in enumerate(("score", "question_overlap", "answer_overlap"), 2)}}

    return common.map_texts(docs, work, f"doc_id {id_type}, item_id {item_type}, score double, question_overlap double, answer_overlap double")


def _shortened(parts: tuple[np.ndarray, np.ndarray], words: np.ndarray, spans: list[tuple[int, int]], there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The question's and the answer's n-grams; a part shorter than an n-gram counts as found if its sequence is."""
    out = []
    for g in parts:
        if len(g) == 1 and not np.isin(g, there)[0]:
            for width in range(1, GRAM):  # it may be the sequence of fewer words
                for a, b in spans:
                    if b - a >= width:
                        runs = np.lib.stride_tricks.sliding_window_view(words[a:b], width)
                        if any(grams(r)[0] == g[0] for r in runs):
                            g = np.zeros(0, np.uint64)
                            break
                if not len(g):
                    break
        out.append(g)
    return out[0], out[1]


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id, item id, score, question_overlap, answer_overlap`` of every document that holds a test item."""
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], f"doc_id {id_type}, item_id {item_type}, score double, question_overlap double, answer_overlap double")
    for shard in shards(benchmark, item_col, item_text_col, threshold):
        out = out.union(_search_shard(rows, shard, threshold, overlap, id_type, item_type))
    best = out.groupBy("doc_id", "item_id").agg(*[F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")])
    return best.withColumnsRenamed({"doc_id": id_col, "item_id": item_col})

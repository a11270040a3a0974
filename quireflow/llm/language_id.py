"""Language identification by cross-parsing.

A language's model is a suffix automaton of a bounded sample of its labelled text. A text is parsed
against it into the longest phrases that occur in the sample; the language that needs the fewest
phrases for the text's characters wins (ties to the smaller name).

Transitions are kept sparse, as a double array: a state is a place in one table, its transition by
character code c stands at that place plus c and names its owner, and the rows of all states are laid
into each other's gaps. So a model takes a few bytes a transition whatever the alphabet, and many
segments of text step through all languages in lockstep with one look-up a character. The models are
built once, on the driver, and sent to the workers as a broadcast of fixed size.

Texts are folded to lower-case letters; every run of anything else is one space. They are parsed
whole, in segments of ``SEGMENT`` characters, which adds at most one phrase a segment to every
language alike. Training texts are cut whole into pieces of ``PIECE`` characters; the sample is
``SAMPLE_PIECES`` pieces a language, spread over all pieces of all its labelled texts by a hash.

Edge cases: a text that is null or has no letter gets ``und`` and score 0; rows with null or repeated
ids each give a row; a very long text is parsed whole, and any of its pieces may be learned from; an
empty table gives no rows; with no labelled row every text is ``und``; other columns than those named are
not read.
"""

from __future__ import annotations

import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: The sample of labelled text: pieces a language, and characters a piece.
SAMPLE_PIECES, PIECE = 100, 400
#: Characters of a segment, and segments that step together.
SEGMENT, LANES = 512, 4096
_fold: np.ndarray | None = None


def folded(text: str) -> np.ndarray:
    """Code points in lower case; 32 for all but letters, runs of it as one."""
    global _fold
    if _fold is None:
        _fold = np.full(0x110000, 32, np.int32)
        for c in range(0x110000):
            if unicodedata.category(ch := chr(c))[0] == "L":
                _fold[c] = ord(low) if len(low := ch.lower()) == 1 else c
    points = _fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = points != 32
    keep[1:] |= points[:-1] != 32
    return points[keep]


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state (character code to state, state 0 first) of the automaton of all substrings."""
    link, length, last = [-1], [0], 0
    rows: list[dict[int, int]] = [{}]
    for c in codes.tolist():
        new = len(rows)
        rows.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in rows[p]:
            rows[p][c] = new
            p = link[p]
        if p != -1:
            q = rows[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                clone = len(rows)
                rows.append(dict(rows[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and rows[p].get(c) == q:
                    rows[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return rows


def double_array(rows: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the states, and for each slot of the table the place of its owner and of the state it leads to.

    The transition of a state by code c (below ``width``) stands in slot place + c. States with many
    transitions are laid first, each at the first place where its slots are free; no two states
    share a place, so that a slot's owner is known by it. Free slots have no owner (-1).
    """
    bound = width + sum(map(len, rows)) + len(rows) + 2 * width
    taken, placed = bytearray(bound), bytearray(bound)
    places = np.zeros(len(rows), np.int64)
    free, low = [], width  # slots from low on have not been looked at
    for state in sorted(range(len(rows)), key=lambda k: -len(rows[k])):
        codes = sorted(rows[state])
        first = codes[0] if codes else 0
        tried, at = 0, None
        for k, slot in enumerate(free):  # recent gaps
            if not placed[slot - first] and (not codes or not any(taken[slot - first + c] for c in codes)):
                at = slot - first
                del free[k]
                break
            tried += 1
            if tried >= 24:
                del free[:8]
                break
        while at is None:
            if low + width >= len(taken):
                taken.extend(bytes(len(taken)))
                placed.extend(bytes(len(placed)))
            slot, low = low, low + 1
            if taken[slot]:
                continue
            if not placed[slot - first] and not any(taken[slot - first + c] for c in codes):
                at = slot - first
            elif len(free) < 4096:
                free.append(slot)
        places[state] = at
        placed[at] = 1
        for c in codes:
            taken[at + c] = 1
    size = int(places.max()) + width + 1
    owner, to = np.full(size, -1, np.int32), np.zeros(size, np.int32)
    for state, row in enumerate(rows):
        for c, target in row.items():
            owner[places[state] + c] = places[state]
            to[places[state] + c] = places[target]
    return places, owner, to


class Automata:
    """All languages' automata in one double array; characters have one code in all, and one of their own in each."""

    def __init__(self, samples: list[tuple[str, str]]) -> None:
        self.langs = [lang for lang, _ in samples]
        points = [folded(text) for _, text in samples]
        alphabet = np.unique(np.concatenate([*points, [32]]))
        self.code = np.full(0x110000, len(alphabet), np.int32)  # the last stands for all other characters
        self.code[alphabet] = np.arange(len(alphabet))
        self.own = np.zeros((len(points), len(alphabet) + 1), np.int32)  # each language's codes
        self.fresh = np.zeros_like(self.own)  # each language's state after a phrase's first character
        owners, targets, base = [], [], 0
        for k, p in enumerate(points):
            chars, codes = np.unique(self.code[p], return_inverse=True)
            rows = suffix_automaton(codes)
            rows.append({})  # after a character that the sample lacks
            places, owner, to = double_array(rows, len(chars))
            self.own[k] = len(chars)
            self.own[k, chars] = np.arange(len(chars))
            self.fresh[k] = base + places[-1]
            self.fresh[k, chars] = base + places[[rows[0][c] for c in range(len(chars))]]
            owners.append(np.where(owner >= 0, owner + base, -1))
            targets.append(to + base)
            base += len(owner) + len(chars) + 1
            gap = base - sum(map(len, owners))
            owners.append(np.full(gap, -1, np.int64))  # no look-up leaves the language's part
            targets.append(np.zeros(gap, np.int64))
        if base >= 1 << 31:
            raise ValueError("the samples of all languages are too large for one table")
        self.owner, self.to = np.concatenate(owners).astype(np.int32), np.concatenate(targets).astype(np.int32)

    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.code, self.own, self.fresh, self.owner, self.to))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (folded code points) by language, ``LANES`` segments at a time."""
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        cuts = ((i, at) for i, t in enumerate(texts) for at in range(0, len(t), SEGMENT))
        while some := list(itertools.islice(cuts, LANES)):
            self._step_through(texts, some, out)
        return out

    def _step_through(self, texts: list[np.ndarray], cuts: list[tuple[int, int]], out: np.ndarray) -> None:
        lengths = np.array([min(SEGMENT, len(texts[i]) - at) for i, at in cuts])
        order = np.argsort(-lengths, kind="stable")
        flat = np.zeros((SEGMENT, len(cuts)), np.int32)  # by step, so that a step reads one row
        for lane, k in enumerate(order):
            i, at = cuts[k]
            flat[: lengths[k], lane] = self.code[texts[i][at : at + SEGMENT]]
        lengths = lengths[order]
        live = np.searchsorted(-lengths, -np.arange(1, SEGMENT + 1), "right")  # lanes with more than so many characters
        owners = np.array([cuts[k][0] for k in order])
        for lang, (own, fresh) in enumerate(zip(self.own, self.fresh, strict=True)):
            state = fresh[flat[0]]
            count = np.ones(len(cuts), np.int64)
            for step in range(1, int(lengths[0])):
                n = int(live[step])
                char, here = flat[step, :n], state[:n]
                slot = here + own[char]
                missed = self.owner[slot] != here
                state = np.where(missed, fresh[char], self.to[slot])
                count[:n] += missed
            np.add.at(out[:, lang], owners, count)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train: Column) -> list[tuple[str, str]]:
    """At most SAMPLE_PIECES pieces of PIECE characters of each language, spread by a hash over all labelled texts.

    The pieces are chosen from narrow keys, before any text is moved.
    """
    rows = docs.where(train & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, lang_col, text_col).alias("doc"))
    pieces = rows.select("lang", "doc", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))).alias("piece")).withColumn("key", F.xxhash64("doc", "piece"))
    first = pieces.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc", "piece"))).where(F.col("k") <= SAMPLE_PIECES)
    chosen = {(r["doc"], r["piece"]): (r["lang"], r["k"]) for r in first.select("lang", "doc", "piece", "k").collect()}  # bounded
    if not chosen:
        return []
    wanted: dict[int, list[int]] = {}
    for doc, piece in chosen:
        wanted.setdefault(doc, []).append(piece)
    held = docs.sparkSession.createDataFrame(list(wanted.items()), "doc long, pieces array<int>")
    found = rows.join(F.broadcast(held), "doc").select("doc", F.explode("pieces").alias("piece"), "text").select("doc", "piece", F.substr("text", F.col("piece") * PIECE + 1, F.lit(PIECE)).alias("text")).distinct().collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for doc, piece, text in found:
        lang, k = chosen[doc, piece]
        texts.setdefault(lang, []).append((k, text))
    return [(lang, "\n".join(t for _, t in sorted(parts))) for lang, parts in sorted(texts.items())]


def predict(docs: DataFrame, samples: list[tuple[str, str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score, phrases`` for every row, without a shuffle."""


    shared = docs.sparkSession.sparkContext.broadcast(Automata(samples)) if samples else None

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        texts = [folded(t) for t in common.texts_of(part)]
        n = len(texts)
        lettered = np.array([bool((t != 32).any()) for t in texts], bool)
        if shared is None:
            yield {"doc_id": part.column("doc_id"), "lang_pred": ["und"] * n, "score": [0.0] * n, "phrases": [0] * n}
            return
        model = shared.value
        counts = model.phrases(texts)
        best = counts.argmin(1)
        least = counts[np.arange(n), best]
        score = 1 / np.exp(-(counts - least[:, None]) / np.sqrt(least + 1.0)[:, None]).sum(1)
        yield {
            "doc_id": part.column("doc_id"),
            "lang_pred": [model.langs[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)],
            "score": np.where(lettered, score, 0.0),
            "phrases": least,
        }

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return common.map_texts(rows, work, f"doc_id {id_type}, lang_pred string, score double, phrases long").withColumnRenamed("doc_id", id_col)


def identify(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows where ``train`` holds, predict every row."""
    return predict(docs, sample(docs, id_col, text_col, lang_col, train), id_col, text_col)

"""Byte-pair encoding and decoding of words, in Python.

A short word is a contiguous array of parts with the rank of each adjacent pair: the smallest rank
(leftmost on ties) is sought by scanning, its boundary deleted and the neighbouring ranks refreshed.
A word of more than ``LONG`` parts would make the scans quadratic; it is merged with a heap, which
gives the same parts. Words repeat, so a bounded table keeps their ids.

The file is a tokenizers JSON: normaliser (NFC, white space to one space, lower case by character),
a split by pattern that drops what lies between, byte-level characters, an end-of-word suffix, no
decoder (tokens joined by spaces), added tokens taken out of the raw text first.

Edge cases: null and empty texts give no ids and an empty decoding; rows with null or repeated ids
each give a row; an empty table gives no rows; other columns are not read. Texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Words of more parts than this are merged with a heap.
LONG = 128
#: Words kept with their ids in a worker process.
KEEP = 200_000
#: Longer words are not kept.
KEEP_CHARS = 64

_WHITE = "\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_loaded: dict[str, "WordBpe"] = {}


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.split = regex.compile(steps[0]["pattern"]["Regex"].replace(r"\s", _WHITE))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.spaces = regex.compile(f"[{_WHITE}]+")
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            whole = self.vocab.get(a + b)
            self.merges.setdefault(self.vocab[a] << 20 | self.vocab[b], (rank, whole))
        chars = byte_characters()
        self.inner = [self.vocab[c] for c in chars]
        self.final = [self.vocab[c + self.suffix] for c in chars]
        self.kept: dict[str, tuple[bytes, str, int]] = {}

    def normalize(self, text: str) -> str:
        text = self.spaces.sub(" ", unicodedata.normalize("NFC", text))
        # each character by itself: a final sigma isn't special
        return text.replace("Σ", "σ").lower()

    def word(self, word: str) -> list[int]:
        """The ids of one word."""
        data = word.encode()
        if not data:
            return []
        inner = self.inner
        parts = [inner[b] for b in data[:-1]]
        parts.append(self.final[data[-1]])
        if len(parts) > LONG:
            return self._merge_long(parts)
        get, none = self.merges.get, (1 << 30, 0)
        ranks = [get(a << 20 | b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best is none or best[0] == 1 << 30:
                break
            i = ranks.index(best)
            parts[i] = best[1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << 20 | parts[i], none)
            if i < len(ranks):
                ranks[i] = get(parts[i] << 20 | parts[i + 1], none)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges by a heap of (rank, place) over a linked list."""
        n, get = len(parts), self.merges.get
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(m[0], i, parts[i], parts[i + 1], m[1]) for i in range(n - 1) if (m := get(parts[i] << 20 | parts[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j], after[i] = whole, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := get(whole << 20 | parts[after[i]]):
                    heapq.heappush(heap, (m[0], i, whole, parts[after[i]], m[1]))
            if (h := before[i]) >= 0 and (m := get(parts[h] << 20 | whole)):
                heapq.heappush(heap, (m[0], h, parts[h], whole, m[1]))
        return [p for p, live in zip(parts, alive, strict=True) if live]

    def entry(self, word: str) -> tuple[bytes, str, int]:
        """Ids as little-endian 32-bit integers, the decoded word, and the number of ids."""
        found = self.kept.get(word)
        if found is None:
            ids = self.word(word)
            found = (self.pack(ids), self.decode(ids), len(ids))
            if len(word) <= KEEP_CHARS:
                if len(self.kept) >= KEEP:
                    self.kept.clear()
                self.kept[word] = found
        return found

    def pieces(self, text: str) -> list[tuple[bytes, str, int]]:
        """The entries of a text's words and added tokens, in order."""
        out: list[tuple[bytes, str, int]] = []
        sections = self.specials.split(text) if self.specials and any(s in text for s in self.added) else [text]
        for section in sections:
            if section in self.added:
                out.append((self.pack([self.added[section]]), section, 1))
            elif section:
                entry, kept = self.entry, self.kept.get
                out += [kept(w) or entry(w) for w in self.split.findall(self.normalize(section))]
        return out

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        import sys

        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def encode(self, text: str) -> list[int]:
        return list(array("I", b"".join(p[0] for p in self.pieces(text))))

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as a file without a decoder says; ids outside the vocabulary give nothing."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def load(path: str) -> WordBpe:
    """The encoder for a file, made once in a worker process."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def encode_texts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids (little-endian unsigned 32-bit), decoded`` for every row, without a shuffle."""

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        bpe = load(tokenizer_path)
        out = {"doc_id": part.column("doc_id"), "n_tokens": [], "ids": [], "decoded": []}
        for text in common.texts_of(part):
            pieces = bpe.pieces(text)
            out["n_tokens"].append(sum(p[2] for p in pieces))
            out["ids"].append(b"".join([p[0] for p in pieces]))
            out["decoded"].append(" ".join([p[1] for p in pieces]))
        yield out

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return common.map_texts(rows, work, f"doc_id {id_type}, n_tokens long, ids binary, decoded string").withColumnRenamed("doc_id", id_col)


def decode_ids(packed: bytes, tokenizer_path: str) -> str:
    return load(tokenizer_path).decode(list(array("I", packed)))


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()

import hashlib
import random

import public_tokenizers
import pytest
from common_docs import EDGE, TESTDATA, edge, empty
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quireflow.llm import bpe, common, queries, token_counts

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def texts(n, seed):
    rng = random.Random(seed)
    alphabet = "abcXYZthe éÉßΣσς'sİ ñ\t\n\x1c\x85 12½漢字\U0001f642-_!? 　​ﬁ"
    special = ["", "<|endoftext|>", " <|startoftext|> ", "<|endoftext", "İ", "é"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) + rng.choice(special) + "".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(n)]


def test_same_ids_and_decoding_as_the_library():
    library, own = Tokenizer.from_file(WORDS), bpe.load(WORDS)
    for text in [*texts(3000, 1), "", "a" * 1000, "thean" * 800, "<|endoftext|><|endoftext|>"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert " ".join(p[1] for p in own.pieces(text)) == library.decode(ids, skip_special_tokens=False) == own.decode(ids)


def test_long_words_merge_alike():
    own, rng = bpe.load(WORDS), random.Random(2)
    for n in (2, 50, 127, 128, 129, 700):
        word = "".join(rng.choice("theanio") for _ in range(n))
        ids = [own.inner[b] for b in word.encode()[:-1]] + [own.final[word.encode()[-1]]]
        assert own._merge_long(ids) == Tokenizer.from_file(WORDS).encode(word, add_special_tokens=False).ids


def test_words_kept_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEEP", 10)
    own = bpe.WordBpe(WORDS)
    for k in range(100):
        own.entry(f"word{k}")
    assert len(own.kept) <= 10


def test_bpe_query_on_the_smallest_table(spark):
    library = Tokenizer.from_file(WORDS)
    got = {r["doc_id"]: r for r in queries.op7_bpe(spark, f"{TESTDATA}/sf0.001").collect()}
    for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want = (len(ids), hashlib.sha256(bpe.WordBpe.pack(ids)).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        assert tuple(got[r["doc_id"]])[1:] == want


def test_bpe_edges(spark):
    rows = bpe.encode_texts(edge(spark), WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    assert sorted(((r["doc_id"] or -1), r["n_tokens"]) for r in rows) == sorted(((i or -1), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in EDGE)
    assert bpe.encode_texts(empty(spark), WORDS).count() == 0


@pytest.mark.parametrize("path", [BYTES, WORDS, public_tokenizers.path("piece_bpe_32k.model")])
def test_counts_are_the_librarys(spark, path, tmp_path):
    rows = spark.createDataFrame(list(enumerate([*texts(200, 3), None, ""])), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.count_tokens(rows, path, str(tmp_path / "cache"), limit=20).collect()}
    if path.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for k, text in enumerate([*texts(200, 3), None, ""]):
        n = count(text or "")
        assert got[k] == (len((text or "").encode()), n, n > 20)


def test_only_distinct_misses_are_encoded(spark, tmp_path):
    cache = str(tmp_path / "cache")
    rows = spark.createDataFrame([(k, f"text {k % 5}") for k in range(100)], "doc_id long, text string")
    assert token_counts.count_tokens(rows, BYTES, cache).count() == 100
    assert spark.read.parquet(cache).count() == 5
    more = rows.union(spark.createDataFrame([(200, "text 9"), (201, "text 1")], rows.schema))
    assert token_counts.count_tokens(more, BYTES, cache).count() == 102
    assert spark.read.parquet(cache).count() == 6
    assert token_counts.count_tokens(rows, WORDS, cache).count() == 100  # another tokenizer, other counts
    assert spark.read.parquet(cache).count() == 11


def test_count_edges(spark):
    assert token_counts.count_tokens(edge(spark), BYTES).count() == len(EDGE)
    assert token_counts.count_tokens(empty(spark), BYTES).count() == 0


def test_word_kernel_against_plain_python(spark):
    import re

    import numpy as np
    import pyarrow as pa

    rows = [*texts(300, 5), None, "", " ", "one", "two words"]
    batch = pa.record_batch({"text": pa.array(rows)})
    hashes, owner = common.batch_words(batch)
    plain = [(i, re.sub("[A-Z]", lambda m: m[0].lower(), w)) for i, t in enumerate(rows) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert owner.tolist() == [i for i, _ in plain]
    names = {}
    assert all(names.setdefault(w, h) == h for (_, w), h in zip(plain, hashes.tolist(), strict=True))
    assert len(set(names.values())) == len(names)
    for width in (1, 3, 4):
        values, where = common.distinct_by_row(*common.shingles(hashes, owner, width))
        for i, t in enumerate(rows):
            words = [w for k, w in plain if k == i]
            want = len(set(zip(*[words[k:] for k in range(width)], strict=False))) if len(words) >= width else bool(words)
            assert int((where == i).sum()) == want
    long = pa.record_batch({"text": pa.array(["Word  " * 900_000])})
    hashes, owner = common.batch_words(long)  # cut at spaces into runs
    assert len(hashes) == 900_000 and len(np.unique(hashes)) == 1 and not owner.any()


def test_held_out(spark):
    import zlib

    rows = spark.range(50).select("id", common.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)

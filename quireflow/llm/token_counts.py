"""Token counts through a cache keyed by content and tokenizer digests.

``count_tokens`` looks every text's digest up in a cache table, encodes each distinct text that the
cache lacks once, appends those counts, and joins the counts back to the rows. Content is normalised
only as far as counts cannot change: null is the empty text.

What is missing is found from digests alone, and no text is moved when nothing is. Else copies of a text
are combined in each task before texts are dealt out to be encoded, so a text with a third of all
rows leaves a task once; digests and counts are narrow rows that the engine splits where one has many.

Edge cases: null text counts as empty (0 tokens); rows with null or repeated ids each give a row;
copies of a text are encoded once; an empty table gives no rows; other columns are not read, so
their names cannot clash. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import discard, exists, stored
from . import common

_CACHE = "content binary, tokenizer string, n_tokens long"
_loaded: dict[str, object] = {}


def tokenizer_digest(path: str) -> str:
    """What a stored count depends on besides the text: the vocabulary file and the library's version."""
    import sentencepiece
    import tokenizers

    with open(path, "rb") as f:
        name = "sentencepiece " + sentencepiece.__version__ if path.endswith(".model") else "tokenizers " + tokenizers.__version__
        return hashlib.sha256(name.encode() + f.read()).hexdigest()


def counter(path: str):
    """A function from texts to token counts, loaded once in a worker process."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            piece = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in piece.encode(texts, num_threads=1)]
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            bpe = Tokenizer.from_file(path)
            bpe.no_truncation()
            bpe.no_padding()
            _loaded[path] = lambda texts: [len(x) for x in bpe.encode_batch_fast(texts, add_special_tokens=False)]
    return _loaded[path]


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache table, or an empty one where none was written yet."""
    return spark.read.schema(_CACHE).parquet(path) if exists(spark, path) else spark.createDataFrame([], _CACHE)


def fill_cache(texts: DataFrame, cache_path: str, tokenizer_path: str) -> None:
    """Encode the distinct texts (columns content, text) that the cache lacks and append their counts."""
    spark = texts.sparkSession
    version = tokenizer_digest(tokenizer_path)
    # combined in each map task, before anything else deals the texts out
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    missing = None
    if exists(spark, cache_path):
        known = read_cache(spark, cache_path).where(F.col("tokenizer") == version).select("content")
        missing = stored(texts.select("content").distinct().join(known, "content", "left_anti"), "missing")
        if missing.isEmpty():
            discard(missing)
            return
        distinct = distinct.join(missing, "content", "left_semi")

    def encode(part: pa.RecordBatch) -> Iterator[dict]:
        counts = counter(tokenizer_path)(common.texts_of(part))
        yield {"content": part.column("content"), "tokenizer": [version] * len(counts), "n_tokens": counts}

    common.map_texts(distinct, encode, _CACHE).write.mode("append").parquet(cache_path)
    if missing is not None:
        discard(missing)


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row; ``cache_path`` keeps counts between runs."""
    spark = docs.sparkSession
    cache_path = cache_path or common.scratch_path(spark, "token-cache")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    fill_cache(rows.select(content_digest(F.col("text")).alias("content"), "text"), cache_path, tokenizer_path)
    # kept, so that the join below deals out plain rows, which the engine can split where one text has many of them
    counts = stored(read_cache(spark, cache_path).where(F.col("tokenizer") == tokenizer_digest(tokenizer_path)).groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    keyed = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), content_digest(F.col("text")).alias("content"))
    # counts are one narrow row a text: hashed in each partition, nothing needs sorting
    return keyed.join(counts.hint("shuffle_hash"), "content").select(F.col("doc_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

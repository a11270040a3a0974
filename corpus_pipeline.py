"""A corpus pipeline: from raw documents to token ids, one operator of ``quireflow.llm`` in each stage.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last give the columns of ``documents``.

1. quality: documents whose quality score is under 0.3 go.
2. near_dup: one document of each group of near-duplicates stays (five-word shingles, similarity 0.8),
   the one with the smallest id; of rows that repeat an id and a text one stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: secrets in the text are replaced by ``[SECRET]``; n_chars follows.
5. bpe: the ids of each text (little-endian unsigned 32-bit integers) and digests of ids and decoding.

Edge cases: a null text counts as empty in every stage and stays null until the last; very long texts are
taken whole; documents without an id can't be told apart, so stages 2 and 3 let them stay; rows that repeat an id
and a text are one after stage 2, with other texts they stay; ties (a score at the threshold, a similarity at the limit)
count as reached; empty tables give empty results; columns other than those of ``documents`` are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireflow.llm import bpe, common, decontamination, near_dup, quality, secrets
from quireflow.llm.queries import QUALITY_THRESHOLD
from quireflow.operators.storage import discard, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality.learn(docs, common.table(spark, sf_dir, "labels"), train=~common.held_out(F.col("doc_id")))
    scored = quality.score(docs, model, keep=COLUMNS[2:])
    return scored.where(F.col("score") >= QUALITY_THRESHOLD).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    What goes is dealt out with the texts, as it grows with them; the texts needn't be sorted for that.
    """
    found = near_dup.find(docs, width=5, percent=80, keep_key=True)
    gone = found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id", "text_key").distinct()
    left = docs.withColumn("text_key", near_dup.text_key("text")).join(gone.hint("shuffle_hash"), ["doc_id", "text_key"], "left_anti").select(*COLUMNS)
    repeated = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    repeated = repeated.hint("shuffle_hash")
    return left.join(repeated, "doc_id", "left_anti").union(left.join(repeated, "doc_id", "left_semi").select(*COLUMNS).dropDuplicates(["doc_id", "text"]))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    found = decontamination.leaks(docs, common.table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found.hint("shuffle_hash"), "doc_id", "left_anti").select(*COLUMNS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced."""
    found = secrets.scan(docs, keep=COLUMNS[1:])
    text = secrets.redacted(F.col("text"), F.col("starts"), F.col("ends"))
    hidden = F.size("starts") > 0
    return found.select("doc_id", text.alias("text"), "lang", "source", F.when(hidden, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    out = bpe.encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality", keep_good), ("near_dup", drop_copies), ("decontamination", drop_leaks), ("secrets", hide_secrets), ("bpe", to_ids)]

#: SQL cannot express the classifier, MinHash or the network; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each gives is written to the shared folder and read again.

    A stage's table is deleted when the next one's is written; the last that is read stays, as the result is made from it.
    """
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)

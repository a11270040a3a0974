"""The pipeline's stages, one by one, against what each must do to its input."""

import hashlib

import corpus_pipeline as P
import public_tokenizers
import pytest
from common_docs import EDGE, TESTDATA, edge, empty
from test_search import groups_by_hand, words_by_hand
from test_text_models import base_by_hand
from tokenizers import Tokenizer

SF = f"{TESTDATA}/sf0.001"
STAGES = dict(P.STAGES)


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and output over the smallest tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        after = stage(spark, docs, SF).cache()
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_columns(steps):
    assert len(P.STAGES) == 5
    for name, (_, _, columns) in steps.items():
        assert name == "bpe" or tuple(columns) == P.COLUMNS


def test_quality_drops_what_labels_reject(spark, steps):
    before, after, _ = steps["quality"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = by_id(after)
    right = [(r["doc_id"] in left) == bool(labels[r["doc_id"]]) for r in before if r["doc_id"] in labels]
    assert sum(right) / len(right) >= 0.95
    assert all(by_id(before)[i] == r for i, r in left.items())


def test_one_of_each_group_stays(steps):
    before, after, _ = steps["near_dup"]
    want = {i for (i, _), (_, c) in groups_by_hand([(r["doc_id"], r["text"]) for r in before], 5, 80).items() if c == i}
    assert set(by_id(after)) == want


def test_leaks_go(spark, steps):
    before, after, _ = steps["decontamination"]
    grams = lambda t: set(zip(*[words_by_hand(t)[k:] for k in range(5)], strict=False))
    items = [grams(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {r["doc_id"] for r in before if not any(len(g & grams(r["text"])) >= 0.5 * len(g) for g in items)}
    assert set(by_id(after)) == want


def test_secrets_are_hidden(steps):
    before, after, _ = steps["secrets"]
    after = by_id(after)
    assert set(after) == set(by_id(before))
    for r in before:
        now = after[r["doc_id"]]
        assert not base_by_hand(now["text"])
        assert now["n_chars"] == len(now["text"])
        if not base_by_hand(r["text"]) and now["text"] != r["text"]:
            assert "[SECRET]" in now["text"]


def test_ids(steps):
    before, after, _ = steps["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    after = by_id(after)
    assert len(after) == len(before)
    for r in before:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (after[r["doc_id"]]["n_tokens"], bytes(after[r["doc_id"]]["ids"])) == (len(ids), packed)
        assert after[r["doc_id"]]["ids_sha256"] == hashlib.sha256(packed).hexdigest()


def test_run_is_the_stages_in_a_row(spark, steps):
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in P.run(spark, SF).collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in steps["bpe"][1])


@pytest.mark.parametrize("name", list(STAGES))
def test_edges(spark, name):
    from pyspark.sql import functions as F

    rows = edge(spark).withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    out = STAGES[name](spark, rows, SF)
    n = out.count()
    assert n <= len(EDGE)
    if name in ("secrets", "bpe"):
        assert n == len(EDGE)
    if name == "near_dup":  # the copies under one id are one; a row without an id stays
        assert n == len(EDGE) - 1
    none = empty(spark).withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    assert STAGES[name](spark, none, SF).count() == 0


def test_rows_that_share_an_id_are_dropped_one_by_one(spark):
    one, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(1, one), (2, one.replace("a30", "thirty")), (2, other), (3, other.replace("b30", "thirty"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {(r["doc_id"], r["text"]) for r in P.drop_copies(spark, docs, "").collect()}
    assert left == {(1, one), (2, other)}


@pytest.mark.parametrize("name", ["near_dup", "decontamination"])
def test_what_is_dropped_is_not_sent_whole(spark, steps, no_broadcast, name):
    """No list of documents that go, or of ids that repeat, is broadcast."""
    before, after, _ = steps[name]
    docs = spark.createDataFrame([*before, before[0]], spark.read.parquet(f"{SF}/documents.parquet").schema)
    assert by_id(STAGES[name](spark, docs, SF).collect()) == by_id(after)

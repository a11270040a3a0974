"""Decontamination, nearest neighbours and near-duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from common_docs import EDGE, TESTDATA, edge, empty
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from quireflow.llm import decontamination as D
from quireflow.llm import near_dup, neighbours, queries
from quireflow.operators import storage


def words_by_hand(text):
    return [w.lower() for w in re.findall(r"[^\W_]+", text or "")]


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(1)
    vocab = [f"w{k}" for k in range(120)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(8, 60))) for _ in range(70)]
    segments = [s for i, t in enumerate(items) for s in D.segments_of(i, t)]
    index = D.Index(segments, threshold=0.05)
    for _ in range(150):
        words = D.item_words(" ".join(rng.choice(vocab + ["zz"]) for _ in range(rng.randrange(1, 128))))
        terms = np.unique(index.term_ids(words))
        terms = terms[terms >= 0]
        score = np.zeros(len(segments))
        inside = np.isin(index.post_term, terms)
        np.add.at(score, index.post_seg[inside], index.impact[inside])
        for threshold in (0.05, 0.2, 0.4, 0.6):
            got = dict(index.wand(terms, threshold))
            assert set(got) == set(np.flatnonzero(score >= threshold - 1e-9))
            assert all(abs(got[k] - score[k]) < 1e-9 for k in got)


def test_passages_find_what_brute_force_finds():
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(3000)]
    items = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(8, 150))) for _ in range(40)]
    segments = [s for i, t in enumerate(items) for s in D.segments_of(i, t)]
    index = D.Index(segments)
    docs = []
    for k in range(120):
        body = [rng.choice(vocab) for _ in range(rng.randrange(0, 500))]
        if k % 3 == 0:
            at = rng.randrange(len(body) + 1)
            body[at:at] = items[k % 40].split()
        docs.append(" ".join(body))
    batch = pa.record_batch({"text": docs})
    words, rows = D.common.batch_words(batch, space=D.BETWEEN)
    got = {(r, int(index.items[s])) for r, _, _, s, _ in index.search(words, rows, 0.6)}
    assert {(k, k % 40) for k in range(0, 120, 3)} <= got
    # every passage against every segment
    index = D.Index(segments, threshold=0.3)
    for r, start, stop, s, score in index.search(words, rows, 0.3):
        terms = index.term_ids(np.unique(words[start:stop]))
        inside = np.isin(index.post_term, terms[terms >= 0]) & (index.post_seg == s)
        assert abs(index.impact[inside].sum() - score) < 1e-9


def test_leaks_against_ngram_overlap(spark):
    sf = f"{TESTDATA}/sf0.01"
    grams = lambda t: set(zip(*[words_by_hand(t)[k:] for k in range(5)], strict=False))
    items = {r["item_id"]: grams(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        have = grams(r["text"])
        want |= {(r["doc_id"], i) for i, g in items.items() if len(g & have) >= 0.5 * len(g)}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op4_decontamination(spark, sf).collect()}
    assert got == want and want


ITEM = "What is the tallest mountain on the whole wide earth. It is called mount everest in nepal."


def test_leaks_verify_question_and_answer(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, "too short"), (1, ITEM), (4, " ".join(f"long{k}" for k in range(300)))], "item_id long, text string")
    filler = " ".join(f"x{k}" for k in range(100))
    docs = [(1, f"{filler} {ITEM.upper()} {filler}"), (2, f"{filler} {ITEM[:52]} {filler}"), (3, " ".join(sorted(ITEM.split()))), (4, f"{filler} " + " ".join(f"long{k}" for k in range(300))), (5, filler), (None, ITEM), (6, ITEM.replace(" ", "!! "))]
    got = sorted(((r["doc_id"] or 0), r["item_id"]) for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect())
    assert got == [(0, 1), (1, 1), (4, 4), (6, 1)]


def test_single_word_edits_at_every_place_are_found(spark):
    """Each word of each item replaced, left out or doubled by another, amid other text."""
    sf = f"{TESTDATA}/sf0.01"
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    items |= {-1: "Name the two rivers of the old town. Elbe.", -2: "one two three four five six seven eight"}
    filler, rows, of = " ".join(f"x{k}" for k in range(70)), [], []
    for item, text in items.items():
        places = [m.span() for m in re.finditer(r"[^\W_]+", text)]
        for a, b in places if len(places) >= D.MIN_WORDS else []:
            for new in ("qqzz", "", f"{text[a:b]} qqzz"):
                rows.append((len(rows), f"{filler} {text[:a]}{new}{text[b:]} {filler}"))
                of.append(item)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    missed = [(rows[k][1], item) for k, item in enumerate(of) if (k, item) not in got]
    assert len(rows) > 3 * 1500 and not missed


def test_alignment_against_edit_distance():
    rng = random.Random(9)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
        return row[-1]

    for _ in range(200):
        item, text = ([rng.randrange(5) for _ in range(rng.randrange(1, high))] for high in (7, 9))
        want = min(distance(item, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))
        assert abs(D.aligned(np.array(item), np.array(text)) - (1 - want / len(item))) < 1e-9
    assert D.stretches([(5, 9), (0, 3), (3, 4), (6, 7)]) == [(0, 4), (5, 9)]


def test_shards_find_the_same(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(30))) for i in range(25)]
    docs = spark.createDataFrame([(k, "pre fix " + items[k][1] + " post") for k in range(25)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "SHARD", 6)
    assert len(list(D.shards(bench, "item_id", "text"))) > 3
    assert {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()} >= {(k, k) for k in range(25)}


def test_statistics_are_those_of_the_whole_benchmark(spark, monkeypatch):
    rng = random.Random(4)
    items = [(i % 20, " ".join(f"w{min(rng.randrange(1, 90), rng.randrange(1, 900))}" for _ in range(rng.randrange(8, 100)))) for i in range(30)]
    docs = spark.createDataFrame([(k, " ".join(w for w in t.split() if rng.random() < 0.93)) for k, (_, t) in enumerate(items)], "doc_id long, text string")
    bench = spark.createDataFrame([*items, *items[:9]], "item_id long, text string")
    whole = {tuple(r) for r in D.leaks(docs, bench).collect()}
    assert len(whole) >= 20 and len(list(D.shards(bench, "item_id", "text"))) == 1  # rows that repeat an id are one shard too
    monkeypatch.setattr(D, "SHARD", 7)
    assert {tuple(r) for r in D.leaks(docs, bench).collect()} == whole


def test_short_items_by_their_whole_sequence(spark):
    rng = random.Random(5)
    items = [(k, " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(1, D.MIN_WORDS)))) for k in range(30)] + [(30, "!!"), (None, "w1, W2; w3"), (31, "漢字")]
    docs = [(k, " ".join(f"w{rng.randrange(12)}" for _ in range(rng.randrange(0, 60)))) for k in range(80)] + [(80, "x w1-w2 w3"), (81, "漢字"), (82, None), (83, "")]
    want = set()
    for d, text in docs:
        have = words_by_hand(text)
        for i, item in items:
            seq = words_by_hand(item)
            if seq and any(have[k : k + len(seq)] == seq for k in range(len(have))):
                want.add((d, i))
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want and len(want) > 50 and (80, None) in want


def test_leak_edges(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs")], "item_id long, text string")
    got = {r["doc_id"] for r in D.leaks(edge(spark), bench).collect()}
    assert got == {6}
    assert D.leaks(empty(spark), bench).count() == 0
    assert D.leaks(edge(spark), bench.where("item_id > 1")).count() == 0


# ---------------------------------------------------------------- neighbours


def nearest_by_hand(rows, queries_, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in fine:
        if queries_(q):
            scored = sorted((-round(float(v @ w / np.sqrt((v @ v) * (w @ w))), 12), i) for i, w in fine if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_hilbert_curve_visits_neighbours():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    keys = neighbours.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(side**3))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


def test_neighbours_of_clusters_ties_and_copies(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.05 * rng.normal(size=16)).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # copies of one vector
    rows += [(2000, None), (2050, []), (2100, [0.0] * 16), (2150, [float("nan")] * 16), (2200, [None] * 16), (None, rows[5][1]), (2250, [float("inf")] + [1.0] * 15), (2300, [1.0] * 3)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = collect(neighbours.nearest(df, F.col("vec_id") % 50 == 0, 5))
    want = nearest_by_hand([r for r in rows if r[0] != 2300], lambda q: q % 50 == 0, 5)
    assert set(got) == set(want)
    right = [v in {w for w, _ in got[q]} for q, best in want.items() for v, _ in best]
    assert np.mean(right) >= 0.95
    for q in (0, 1000, 1050):  # ties go to the smaller ids
        assert got[q] == [(v, s) for v, s in got[q]] and [v for v, _ in got[q]] == [v for v, _ in want[q]]
    for q, best in got.items():
        assert [s for _, s in best] == sorted((s for _, s in best), reverse=True) and q not in {v for v, _ in best}


def test_recall_on_the_small_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{TESTDATA}/sf0.1/embeddings.parquet").collect()]
    got, want = collect(queries.op8_neighbours(spark, f"{TESTDATA}/sf0.1")), nearest_by_hand(rows, lambda q: q % 50 == 0, 5)
    assert set(got) == set(want)
    assert np.mean([v in {w for w, _ in got[q]} for q, best in want.items() for v, _ in best]) >= 0.9


def test_what_is_moved_grows_with_the_table(spark):
    """With clusters, four times the rows are four times the vectors moved, at a window that stays."""
    moved = []
    for n in (6000, 24_000):
        rng = np.random.default_rng(5)
        centres = rng.normal(size=(n // 20, 8))
        v = (centres[np.arange(n) % len(centres)] + 0.01 * rng.normal(size=(n, 8))).astype(np.float32)
        df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": v.tolist()}), "vec_id long, embedding array<float>")
        base = neighbours.usable(df, "vec_id", "embedding")
        classes = storage.stored(neighbours.classes_of(base, 5))
        ranks, curves, window = neighbours.ranked(classes, classes.count(), 5, "<f4")
        assert curves == neighbours.CURVES and 2 * window <= neighbours.BLOCK
        wanted = classes.where("low % 50 = 0").select("cls")
        tiles, calls = neighbours.tiles_and_calls(classes, ranks, wanted, classes.count(), window)
        moved.append((tiles.count(), calls.count()))
        assert moved[-1][0] <= curves * n
    assert all(b <= 4.5 * a for a, b in zip(*moved, strict=True))


def test_many_queries_of_a_block_are_dealt_out(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(neighbours, "CALLS", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "RECALL", 1.0)
    got, want = collect(neighbours.nearest(df, F.lit(True), 5)), nearest_by_hand(rows, lambda q: True, 5)
    assert np.mean([v in {w for w, _ in got[q]} for q, best in want.items() for v, _ in best]) >= 0.97


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [v for v, _ in collect(neighbours.nearest(df, F.col("vec_id") == 0, 5))[0]] == [1, 2]
    assert neighbours.nearest(df.where("vec_id = 0"), F.col("vec_id") == 0, 5).count() == 0
    assert neighbours.nearest(df.where("vec_id > 9"), F.col("vec_id") == 0, 5).count() == 0


# ---------------------------------------------------------------- near-duplicates


def shingles_by_hand(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*[words[k:] for k in range(width)], strict=False)) if len(words) >= width else frozenset([tuple(words)]) if words else frozenset()


def groups_by_hand(rows, width=4, percent=80):
    sets = [shingles_by_hand(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    lowest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            lowest[top(k)] = min(lowest.get(top(k), i), i)
    return {(i, t): (len(sets[k]), lowest.get(top(k)) if sets[k] else i) for k, (i, t) in enumerate(rows)}


def edits(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    rng = random.Random(6)
    rows = []
    for g in range(25):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.randrange(3, 120))]
        for _ in range(rng.randrange(1, 7)):
            rows.append((len(rows), " ".join(edits(rng, base, rng.randrange(3))).upper()))
    hot = [f"h{rng.randrange(900)}" for _ in range(90)]
    rows += [(len(rows) + k, " ".join(edits(rng, hot, rng.randrange(5)))) for k in range(150)]  # one large group of near copies
    rows += [(5000 + k, " ".join(hot)) for k in range(40)]  # copies
    rows += [(6000 + k, "shared words that many texts hold " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(2, 9)))) for k in range(80)]
    want = groups_by_hand(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for dense, block in ((8, 4096), (0, 16), (10**9, 16)):  # each way through a bucket
        monkeypatch.setattr(near_dup, "DENSE", dense)
        monkeypatch.setattr(near_dup, "BLOCK", block)
        got = {r["doc_id"]: r for r in near_dup.find(df, 4, 80).collect()}
        for (i, _), (n, c) in want.items():
            assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (n, c, i == c)


def test_five_words_and_other_shares(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(100)]
    rows = [(k, " ".join(edits(rng, base, k % 8))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.find(df, 5, 80).collect()}
    assert got == {i: c for (i, _), (_, c) in groups_by_hand(rows, 5, 80).items()}


def test_near_duplicate_edges(spark):
    want = groups_by_hand([(i, t) for i, t, _ in EDGE])
    rows = near_dup.find(edge(spark)).collect()
    assert len(rows) == len(EDGE)
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"]) for r in rows) == sorted((i or 0, *want[(i, t)]) for i, t, _ in EDGE)
    assert near_dup.find(empty(spark)).count() == 0
    alone = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    assert {(r["component_id"], r["kept"]) for r in near_dup.find(alone).collect()} == {(None, True)}


def test_class_keys_sort_as_ids(spark):
    numbers = [-(1 << 63), -5, -1, 0, 7, 300, (1 << 63) - 1, None]
    df = spark.createDataFrame([(i, bytes(16)) for i in reversed(numbers)], "i long, c binary")
    got = df.withColumn("k", F.concat(near_dup.sortable(F.col("i"), LongType()), "c")).orderBy("k").select(near_dup.id_of(F.col("k"), LongType()).alias("i")).collect()
    assert [r["i"] for r in got] == numbers
    names = ["", "A", "Aa", "a", "a b", "aa", "ab", "b", "é", "漢", None]
    df = spark.createDataFrame([(i, bytes([255]) * 16) for i in reversed(names)], "i string, c binary")
    got = df.withColumn("k", F.concat(near_dup.sortable(F.col("i"), StringType()), "c")).orderBy("k").select(near_dup.id_of(F.col("k"), StringType()).alias("i")).collect()
    assert [r["i"] for r in got] == names


def test_intermediate_tables_are_deleted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda _: f"file://{tmp_path}")
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(k // 2, k // 2 + 60))) for k in range(40)], "doc_id long, text string")
    assert near_dup.find(docs).count() == 40
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "quireflow").iterdir()}
    assert left == {"signatures", "components"}  # what the result is read from


def test_near_duplicates_of_repeated_and_null_ids(spark):
    one, other, third = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    near = lambda t: t.replace("30", "thirty")
    rows = [(1, one), (2, near(one)), (2, other), (3, near(other)), (None, third), (None, near(third)), (None, near(third)), (9, third.replace("20", "twenty"))]
    got = {(r["doc_id"], r["text_key"]): r for r in near_dup.find(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80, keep_key=True).collect()}
    key = {t: bytes(hashlib.md5(t.encode()).digest()) for _, t in rows}
    want = [1, 1, 2, 2, 9, 9, 9, 9]
    assert [got[i, key[t]]["component_id"] for i, t in rows] == want
    alone = near_dup.find(spark.createDataFrame([(None, third), (None, near(third)), (5, third.replace("20", "x"))], "doc_id long, text string"), 4, 80)
    assert {r["component_id"] for r in alone.collect()} == {5}


def test_near_duplicates_send_no_table_whole(spark, no_broadcast, monkeypatch):
    """Nothing that grows with the documents is broadcast, with pairs and with dense buckets."""
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    base = [" ".join(rng.choice(words, 60)) for _ in range(12)]
    rows = list(enumerate(t if not k else t.replace(t.split()[k], f"x{k}") for t in base for k in range(5)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = groups_by_hand(rows, 4, 80)
    for dense in (near_dup.DENSE, 0):
        monkeypatch.setattr(near_dup, "DENSE", dense)
        assert {r["doc_id"]: r["component_id"] for r in near_dup.find(docs, 4, 80).collect()} == {i: c for (i, _), (_, c) in want.items()}

"""Lexicon, clusters and canonical rows against plain Python."""

import itertools
import random
import re
import time

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from quireflow.operators import lexicon as L
from quireflow.operators import near_titles, report
from quireflow.operators import resolve as R
from quireflow.operators.components import components
from quireflow.plans import queries
from quireflow.plans.queries import QUERIES
from quireflow.sources.schemas import RAW


def raw(spark, rows):
    """Rows of (id, source, title, author, isbn)."""
    return spark.createDataFrame([(i, s, f"s{i}", t, a, "", "2001", n, "", "", "") for i, s, t, a, n in rows], RAW)


ISBN = ["9787020002207", "9780306406157"]


def lexicon(spark, *titles):
    return L.build(raw(spark, [(i, "douban", t, "", "") for i, t in enumerate(titles)]))


def test_longest_prefix(spark):
    lex = lexicon(spark, "红楼梦", "红楼梦新证", "家")
    rows = spark.createDataFrame([(0, "红楼梦（全二册）当当自营"), (1, "红楼梦新证 周汝昌 著"), (2, "西游记"), (3, ""), (4, None)], "id int, title_raw string")
    assert [r["hit"] for r in L.match(rows, lex).orderBy("id").collect()] == ["红楼梦", "红楼梦新证", None, None, None]
    assert lex.count() == 2  # one character is too short


def test_lexicon_keeps_the_first_display(spark):
    assert lexicon(spark, "红楼 梦", "红楼梦").first()["display"] == "红楼 梦"


def test_lexicon_saves(spark, tmp_path):
    path = str(tmp_path / "lex")
    assert L.load(spark, path).count() == 0
    L.save(lexicon(spark, "红楼梦"), path)
    assert L.load(spark, path).first()["key"] == "红楼梦"


def test_distinct_titles_stay(spark):
    records = R.clean_records(raw(spark, [(1, "dangdang", "西游记续 著", "", ""), (2, "dangdang", "家", "", ""), (3, "dangdang", "西游记外传集锦 作家出版社", "", "")]), lexicon(spark, "西游记"))
    got = {r["raw_id"]: r for r in records.collect()}
    assert got[1]["key"] == "西游记续" and got[1]["reason"] is None
    assert got[2]["reason"] == "single_char"
    assert (got[3]["title"], got[3]["confidence"]) == ("西游记", 1.0)


def test_chain_of_keys_and_isbns(spark):
    rows = [(0, "pdc", "红楼", "", ""), (1, "pdc", "红楼", "", ISBN[0]), (2, "pdc", "西游", "", ISBN[0]), (3, "pdc", "水浒", "", ISBN[1]), (4, "pdc", "西游", "", ISBN[1]), (5, "pdc", "三国", "", "")]
    clustered = R.clusters(R.candidates(R.clean_records(raw(spark, rows))))
    books, members = R.canonical_books(clustered), R.members(clustered)
    assert sorted((r["book_id"], r["raw_id"]) for r in members.collect()) == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (5, 5)]
    assert sorted(r["id"] for r in books.collect()) == [0, 5]
    assert sorted(tuple(r) for r in R.numbered(books).collect()) == [(0, 1), (5, 2)]


def test_survivorship(spark):
    rows = [(0, "dangdang", "红楼梦", "", ""), (1, "douban", "红楼梦 正版包邮", "", ""), (2, "weread", "《红楼梦》", "曹雪芹 著", ISBN[0])]
    book = R.canonical_books(R.clusters(R.candidates(R.clean_records(raw(spark, rows))))).first()
    assert (book["id"], book["author"], book["sources"], book["n_sources"], book["isbn"]) == (0, "曹雪芹", "douban,weread,dangdang", 3, "")
    assert book["aliases"] == "《红楼梦》 | 红楼梦"
    assert book["confidence"] == 0.8  # 0.6 of the best row, two more sources, an author


def test_every_row_once(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["douban", "pdc", "x"]), rng.choice(["红楼", "西游", "家", "abc", "红楼梦"]) + rng.choice(["", "春", "夏", "秋"]), "", rng.choice(["", "", *ISBN])) for i in range(300)]
    records = R.clean_records(raw(spark, rows)).cache()
    members = R.members(R.clusters(R.candidates(records)))
    assert members.count() + R.reject_histogram(records).agg(F.sum("n")).first()[0] == 300
    assert members.select("raw_id").distinct().count() == members.count()


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(50)]
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(n, n) == top(n) for n in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_by_hand(books, threshold, max_block):
    grams = lambda s: {s[i : i + 2] for i in range(len(s) - 1)} or {s}
    out = {}
    for c, n in {(k[0], len(k)) for _, k in books}:
        pool = [(t, k) for t, k in books if k[0] == c and len(k) in (n, n + 1)]
        if not 2 <= len(pool) <= max_block:
            continue
        for i, (t, k) in enumerate(pool):
            for u, m in pool[i + 1 :]:
                shared = len(grams(k) & grams(m))
                sim = shared / len(grams(k) | grams(m))
                if sim >= threshold:
                    out[tuple(sorted((t, u)))] = round(sim, 3)
    return out


def test_near_duplicates(spark):
    rng = random.Random(9)
    keys = {"一二三四五六七八九十", "一二三四五六七八九十百"} | {"".join(rng.choice("一二") + rng.choice("三四") for _ in range(rng.randrange(1, 7))) for _ in range(150)} | {"甲", "甲乙"}
    books = [(f"《{k}》", k) for k in sorted(keys)]
    df = spark.createDataFrame(books, "title string, title_key string")
    for threshold, most in ((0.9, 4000), (0.5, 4000), (0.5, 25)):
        got = {(r["title_a"], r["title_b"]): r["similarity"] for r in near_titles.near_duplicates(df, threshold, most).collect()}
        assert got == near_by_hand(books, threshold, most)
    assert ("《一二三四五六七八九十百》", "《一二三四五六七八九十》") in near_by_hand(books, 0.9, 4000) or ("《一二三四五六七八九十》", "《一二三四五六七八九十百》") in near_by_hand(books, 0.9, 4000)


def test_reports_of_nothing(spark):
    books = R.canonical_books(R.clusters(R.candidates(R.clean_records(raw(spark, [])))))
    assert books.count() == 0
    assert report.multi_source(books).first()["share"] == "0%"
    assert report.markdown(raw(spark, []), books).startswith("# Report")


def test_report_file(spark, tmp_path):
    rows = raw(spark, [(0, "douban", "红楼梦", "曹雪芹", ""), (1, "pdc", "《红楼梦》", "", ISBN[0])])
    books = R.canonical_books(R.clusters(R.candidates(R.clean_records(rows))))
    path = str(tmp_path / "report")
    report.write_markdown(rows, books, path)
    text = "\n".join(r[0] for r in spark.read.text(path).collect())
    assert "| in several sources | 1 (100.0%) |" in text and "| 2000s | 1 |" in text and "| 红 | 1 |" in text


def test_empty_year_is_not_counted(spark):
    books = spark.createDataFrame([("",), ("1996",), ("1948",), ("2029",)], "pub_year string")
    assert [tuple(r) for r in report.decade_histogram(books).collect()] == [("1990s", 1), ("2020s", 1)]


def test_components_that_do_not_settle_are_an_error(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(chain, most_rounds=1)
    assert {r["root"] for r in components(chain).collect()} == {0}


def test_blocks_of_any_size(spark):
    """No block is passed over unless a limit is given."""
    long = "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉"
    books = spark.createDataFrame([(f"{long}{chr(0x4E00 + k)}", f"{long}{chr(0x4E00 + k)}") for k in range(30)], "title string, title_key string")
    assert near_titles.near_duplicates(books, 0.9).count() == 30 * 29 // 2
    assert near_titles.near_duplicates(books, 0.9, 20).count() == 0


@pytest.mark.parametrize("name", ["lexicon_match", "lexicon_override", "canonical_books", "members", "lineage"])
def test_no_listing_table_is_sent_whole(spark, no_broadcast, name):
    """Lexicon, clusters and books grow with the listings, so none is broadcast, however small it looks."""
    assert len(QUERIES[name](spark, f"{TESTDATA}/sf0.01").collect()) > 0


def test_near_titles_compare_without_broadcast(spark):
    books = spark.createDataFrame([("红楼梦新证上", "红楼梦新证上"), ("红楼梦新证上下", "红楼梦新证上下")], "title string, title_key string")
    df = near_titles.near_duplicates(books, 0.5)
    assert df.count() == len(df.collect()) == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join [c#" in plan and not re.search(r"BroadcastHashJoin \[c#\d+, block#\d+L?, gram", plan)


@pytest.mark.parametrize("name", [
    "completeness",
    "decade_histogram",
    "multi_source",
    "rebuild",
    "score",
    "candidates",
    "clusters",
    "source_list",
    "export_rows",
    "high_conf_split",
    "confidence_tiers",
])
def test_no_table_behind_a_result_is_sent_whole(spark, no_broadcast, name):
    """The rest of what is built on lexicon, clusters and books, also where the result is a single row."""
    assert len(QUERIES[name](spark, f"{TESTDATA}/sf0.01").collect()) > 0


def test_titles_with_much_in_common_are_not_all_compared(spark):
    """Ten thousand long titles that differ in their last four characters: far more pairs than can be compared in so short a time."""
    digits = "天地玄黄宇宙洪荒日月"
    books = [(k, k) for k in ("丁七丈三上下丌不与丐丑专且丕世丗丘丙业丛" + "".join(d) for d in itertools.product(digits, repeat=4))]
    began = time.monotonic()
    assert near_titles.near_duplicates(spark.createDataFrame(books, "title string, title_key string"), 0.9).count() >= 45_000
    assert time.monotonic() - began < 90


def test_near_titles_of_many_lengths(spark):
    """Sizes, repeated grams and thresholds against all pairs; several titles of a key are each a row."""
    rng = random.Random(4)
    keys = set()
    for _ in range(25):
        key = "甲" + "".join(rng.choice("乙丙丁戊己庚辛壬") for _ in range(rng.choice([1, 3, 12, 25, 26, 60])))
        keys.add(key)
        for _ in range(4):
            at = rng.randrange(1, len(key))
            keys |= {key[:at] + rng.choice("乙丙子") + key[at + 1 :], key[:at] + key[at + 1 :], key[:at] + key[at - 1] + key[at:]}
    keys |= {"甲" * n for n in range(1, 9)} | {"甲乙" * n for n in range(1, 9)}
    books = [(f"《{k}》", k) for k in sorted(keys)] + [(f"又{k}", k) for k in sorted(keys)[::5]]
    df = spark.createDataFrame(books, "title string, title_key string")
    for threshold, most in ((0.95, None), (0.9, None), (0.9, 40), (0.7, None), (0.3, 40)):
        got = {(r["title_a"], r["title_b"]): r["similarity"] for r in near_titles.near_duplicates(df, threshold, most).collect()}
        want = {p: s for p, s in near_by_hand(books, threshold, most or 10**9).items() if p[0].strip("《》又") != p[1].strip("《》又")}
        assert got == want and want


def test_near_duplicates_of_a_large_block(spark, monkeypatch):
    """The query passes over no block, here one of 4,102 keys."""
    keys = [chr(0x4E00 + k) + chr(0x6E00 + k) for k in range(4100)]
    books = spark.createDataFrame([(k, k) for k in ["甲" + "".join(keys[k : k + 5]) for k in range(4100)] + ["甲乙乙丙乙乙丙", "甲乙丙乙乙乙丙"]], "title string, title_key string").withColumn("title_key", F.when(F.length("title") == 7, F.col("title")).otherwise(F.substring("title", 1, 7)))
    monkeypatch.setattr(queries, "books", lambda spark, sf_dir: books)
    got = [(r["title_a"], r["title_b"]) for r in QUERIES["near_duplicates"](spark, "").collect()]
    assert got == [("甲乙丙乙乙乙丙", "甲乙乙丙乙乙丙")]  # the same grams in another order

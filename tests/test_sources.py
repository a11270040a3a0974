"""Listings, files, ingest and streams."""

import json as json_lib
import os

from pyspark.sql import functions as F

from quireflow.operators import ingest, legacy
from quireflow.plans import frontier
from quireflow.sources import files, html, json
from quireflow.streaming import ingest as streams


def test_shop_page(spark):
    page = """<ul><li class="line1" id="p123" sku="1"><a title=" 红楼梦 " href="#"><p class="search_book_author"><a dd_name='itemlist-author' title='曹雪芹 著'>x</a>
    <span> /2016-09-01</span><a name='P_cbs' title='人民文学出版社'>y</a></li><li id="p5">none</li></ul>"""
    rows = html.shop_items(spark.createDataFrame([("01.03", page), ("x", None)], "category string, html string")).collect()
    assert [tuple(r) for r in rows] == [("dangdang", "123", "红楼梦", "曹雪芹 著", "人民文学出版社", "2016", "", "01.03", "https://product.dangdang.com/123.html")]


def test_tag_page(spark):
    page = """<ul><li class="subject-item"><div class="info"><h2 class=""><a href="https://b.example.com/subject/99/" title="红楼梦">
    红楼梦</a></h2><div class="pub"> [清] 曹雪芹 / 人民文学出版社 / 1996-12 / 59.70元 </div></div></li>
    <li class="subject-item"><h2><a href="" title="">无名 &amp; 书</a></h2></li><li class="subject-item"><p>no heading</p></li></ul>"""
    rows = [tuple(r) for r in html.tag_items(spark.createDataFrame([("小说", 20, page)], "tag string, start int, html string")).collect()]
    assert rows[0] == ("douban", "99", "红楼梦", "[清] 曹雪芹", "人民文学出版社", "1996", "", "小说", "https://b.example.com/subject/99/")
    assert rows[1][1:3] == ("小说-20-", "无名 & 书")
    assert len(rows) == 2


def test_legacy_pages(spark):
    page = '<li class="subject-item"><h2><a href="/1/" title="红楼梦">x</a></h2><div class="pub">[清] 曹雪芹 / 某出版社</div></li><li class="subject-item"><h2><a href="/2/" title="无作者">x</a></h2></li>'
    rows = html.legacy_items(spark.createDataFrame([("t", 0, page)], "tag string, start int, html string"), "douban")
    assert [tuple(r) for r in rows.collect()] == [("红楼梦", "曹雪芹", "douban")]


def test_tags(spark):
    counted = '<a href="/tag/小说" class="tag">小说</a> (10) <a href="/tag/历史" class="t">历史</a>(30)<a href="/tag/小说" class="tag">小说</a> (20)'
    rows = html.ranked_tags(spark.createDataFrame([(1, counted)], "page_id int, html string")).collect()
    assert [tuple(r) for r in rows] == [("历史", 30), ("小说", 20)]
    plain = '<a href="/tag/b">b</a><a href="/tag/a">a</a><a href="/tag/b">b</a>'
    rows = html.ranked_tags(spark.createDataFrame([(1, plain)], "page_id int, html string"))
    assert [r["tag"] for r in rows.collect()] == ["b", "a"]
    none = html.ranked_tags(spark.createDataFrame([(1, "")], "page_id int, html string"))
    assert {r["tag"] for r in html.or_fallback(none, "tag", html.FALLBACK_TAGS).collect()} == set(html.FALLBACK_TAGS)
    assert html.or_fallback(rows, "tag", html.FALLBACK_TAGS).count() == 2


def test_children(spark):
    links = "".join(f"category.dangdang.com/cp{c}.html " for c in ("01.03.00.00.00.00", "01.03.05.00.00.00", "01.03.05.02.00.00", "01.04.01.00.00.00", "01.03.05.02.00.00"))
    pages = spark.createDataFrame([("01.03.00.00.00.00", links), ("01.03.05.00.00.00", links), ("01.01.01.01.01.01", links)], "parent string, html string")
    assert sorted(tuple(r) for r in html.children(pages).collect()) == [
        ("01.03.00.00.00.00", "01.03.05.00.00.00"), ("01.03.00.00.00.00", "01.03.05.02.00.00"), ("01.03.05.00.00.00", "01.03.05.02.00.00"),
    ]
    assert [r["cid"] for r in html.categories(pages).collect()] == ["01.03.00.00.00.00", "01.03.05.00.00.00", "01.03.05.02.00.00", "01.04.01.00.00.00"]


def test_frontier(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("b", "a")], "parent string, cid string")
    got = frontier.expand(spark.createDataFrame([("a",)], "cid string"), edges, spark.createDataFrame([("b",)], "cid string"))
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1), ("c", 3)]


def test_json_pages(spark):
    pages = spark.createDataFrame([('{"books":[{"bookInfo":{"bookId":"7","title":"三体","author":"刘慈欣","publishTime":"2008-01-01"}},{"bookInfo":{"title":""}},{}]}',), ("broken",), (None,)], "json string")
    assert [tuple(r) for r in json.page_items(pages).collect()] == [("weread", "7", "三体", "刘慈欣", "", "2008", "", "", "")]
    pages = spark.createDataFrame([('{"data":{"list":[{"bookName":"","firstbookname":"三体","id":"9","publishDate":"2008-1"}]}}',), ('{"list":[{"bookName":"围城","isbn":"978","cate1":"文学"}]}',), ("[]",)], "json string")
    assert sorted(tuple(r)[1:7] for r in json.catalogue_items(pages).collect()) == [("9", "三体", "", "", "2008", ""), ("978", "围城", "", "", "", "978")]


def test_tree(spark):
    tree = '{"data":[{"categories":[{"CategoryId":1,"title":"文学","sublist":[{"CategoryId":"2","name":"小说"},{"name":"无号","sublist":[{"CategoryId":"3","title":"x"}]}]},{"CategoryId":"4","title":"叶"}]},{"sublist":[{"CategoryId":"5","name":"别","categories":[{"CategoryId":"6","title":"深"}]}]}]}'
    rows = json.tree_leaves(spark.createDataFrame([(tree,), ("no json",), ("{}",)], "json string"))
    assert sorted(tuple(r) for r in rows.collect()) == [("别/深", "6", "深"), ("叶", "4", "叶"), ("文学/小说", "2", "小说")]


def test_query_results(spark):
    bindings = '{"results":{"bindings":[{"itemLabel":{"value":"红楼梦"},"authorLabel":{"value":"曹雪芹"}},{"itemLabel":{"value":"Q12"},"authorLabel":{"value":"a"}},{"itemLabel":{"value":"x"}}]}}'
    assert [tuple(r) for r in json.query_bindings(spark.createDataFrame([(bindings,)], "json string")).collect()] == [("红楼梦", "曹雪芹", "wikidata")]
    docs = '{"docs":[{"title":"A","author_name":["x","y"]},{"title":"B"}]}'
    assert [tuple(r) for r in json.library_docs(spark.createDataFrame([(docs,)], "json string")).collect()] == [("A", "x, y", "openlibrary")]


def test_book_pattern(spark):
    triples = spark.createDataFrame([("b1", "P31", "Q571"), ("b1", "P50", "a1"), ("b1", "P407", "Q35288"), ("b2", "P31", "Q571"), ("b2", "P50", "a2"), ("a2", "P27", "Q148"), ("a1", "P27", "Q1")], "s string, p string, o string")
    labels = spark.createDataFrame([("b1", "B one"), ("a2", "A two")], "id string, label string")
    assert [tuple(r) for r in json.book_pattern(triples, labels, language="Q35288").collect()] == [("b1", "B one", "a1")]
    assert [tuple(r) for r in json.book_pattern(triples, labels, citizenship="Q148").collect()] == [("b2", "b2", "A two")]


def test_legacy_cleaning(spark, column):
    assert column(legacy.clean_title, ["《红楼梦》第三卷", "第二性", "围城精装版", "ＡＢＣ①", None, "a/b|c"]) == ["红楼梦", "", "围城", "ABC1", "", "abc"]
    assert column(legacy.clean_author, ["曹雪芹 著", "（美）海明威", ""]) == ["曹雪芹", "美海明威", ""]
    rows = spark.createDataFrame([(2, "A", "x", "s"), (1, "a", "X", "t"), (3, "", "x", "s")], "id int, title string, author string, source string")
    assert [tuple(r)[:4] for r in legacy.clean_and_deduplicate(rows).collect()] == [(1, "a", "X", "t")]


def test_csv_bytes(spark, tmp_path):
    path = str(tmp_path / "export")
    books = spark.createDataFrame([("红,楼", "", "", "a\"b", "", "", "", "", "douban", 1, 0.6), ("西游", "", "", "", "", "", "", "", "x", 2, 1.0)], ", ".join(f"{c} {'bigint' if c == 'n_sources' else 'double' if c == 'confidence' else 'string'}" for c in files.EXPORT_HEADERS))
    files.export_csv(books, path)
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    data = open(f"{path}/{part}", "rb").read().decode("utf-8")
    assert data == '﻿书名,版本,卷册,著者,出版社,出版年,ISBN,分类,来源,来源数,置信度\r\n西游,,,,,,,,x,2,1.0\r\n"红,楼",,,"a""b",,,,,douban,1,0.6\r\n'
    assert files.export_rows(books, 0.9).count() == 1


def test_legacy_files(spark, tmp_path):
    rows = spark.createDataFrame([("红楼梦", "曹雪芹", "douban"), ('a "b", c', "x\ny", "")], "title string, author string, source string")
    out = files.save_all(rows, str(tmp_path))
    same = sorted(tuple(r) for r in rows.collect())
    assert sorted(tuple(r) for r in files.read_csv(spark, out["csv"]).collect()) == same
    assert sorted(tuple(r) for r in spark.read.schema("title string, author string, source string").json(out["json"]).collect()) == same
    one = tmp_path / "array.json"
    one.write_text('[{"title": "t", "author": "a", "source": "s"}]')
    assert [tuple(r) for r in files.read_json(spark, str(one)).collect()] == [("t", "a", "s")]
    assert files.read_csv(spark, str(tmp_path / "none")).count() == files.read_json(spark, str(tmp_path / "none")).count() == 0


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "raw")
    batch = spark.createDataFrame([(1, "s", "k", "t"), (2, "s", "k", "u"), (3, "s", "l", ""), (4, "r", "k", "v")], "id long, source string, source_id string, title_raw string")
    assert ingest.append(spark, batch, path) == 2
    assert ingest.append(spark, batch, path) == 0
    assert sorted(r["title_raw"] for r in spark.read.parquet(path).collect()) == ["t", "v"]


def test_state(spark):
    schema = "source string, task_key string, done long, pages long, items long, updated_at string"
    state = spark.createDataFrame([("s", "a", 0, 1, 5, "1"), ("s", "b", 1, 2, 6, "1")], schema)
    new = ingest.upsert(state, spark.createDataFrame([("s", "a", 1, 3, 9, "1"), ("s", "c", 0, 0, 0, "0")], schema))
    assert sorted(tuple(r)[:4] for r in new.collect()) == [("s", "a", 1, 3), ("s", "b", 1, 2), ("s", "c", 0, 0)]
    tasks = spark.createDataFrame([("s", "a"), ("s", "c"), ("s", "d")], "source string, task_key string")
    assert sorted(tuple(r) for r in ingest.pending(tasks, new).collect()) == [("s", "c"), ("s", "d")]
    assert sorted(tuple(r)[1:] for r in ingest.read_state(tasks, new).collect()) == [("a", 1, 3, 9), ("c", 0, 0, 0), ("d", 0, 0, 0)]


def test_failed_fetch_never_ends_a_task(spark):
    rows = spark.createDataFrame([("s", "a", 3), ("s", "a", None), ("s", "b", 0)], "source string, task_key string, items long")
    assert sorted(tuple(r) for r in ingest.mark_done(rows).collect()) == [("s", "a", 0, 1, 3), ("s", "b", 1, 1, 0)]


def test_versions(spark, tmp_path):
    folder = f"file://{tmp_path}/books"
    ingest.replace_tables({"books": spark.range(3), "members": spark.range(5)}, folder)
    ingest.replace_tables({"books": spark.range(4), "members": spark.range(1)}, folder)
    assert (ingest.read_version(spark, folder, "books").count(), ingest.read_version(spark, folder, "members").count()) == (4, 1)


def test_stream_resumes(spark, tmp_path):
    schema = "source string, source_id string, n int"
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    batches = []

    def run():
        rows = streams.stream(spark, folder, schema)
        streams.ingest(streams.first_writes(rows, ["source", "source_id"]), out, check, lambda batch, number: batches.append((number, batch.count())))

    spark.createDataFrame([("s", "a", 1), ("s", "a", 1), ("s", "b", 2)], schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    spark.createDataFrame([("s", "a", 9), ("s", "c", 3)], schema).coalesce(1).write.mode("append").parquet(folder)
    run()
    assert sorted((r["source_id"], r["n"]) for r in spark.read.parquet(out).select("source_id", "n").collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert sum(n for _, n in batches) == 3


def test_watermarked_keys(spark, tmp_path):
    folder = str(tmp_path / "events")
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 01:00:00"), ("b", "2024-01-01 00:00:00")], "k string, ts string").select("k", F.to_timestamp("ts").alias("ts")).write.parquet(folder)
    rows = streams.stream(spark, folder, "k string, ts timestamp")
    streams.ingest(streams.first_writes(rows, ["k"], "ts"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_book_pattern_gives_all_matches_or_its_pages(spark):
    books = [f"B{k:02}" for k in range(23)]
    triples = spark.createDataFrame([(b, "P31", "Q571") for b in books] + [(b, "P50", "A1") for b in books] + [("A1", "P27", "Q8"), ("X", "P31", "Q571"), ("X", "P50", "A2")], "s string, p string, o string")
    labels = spark.createDataFrame([("A1", "one")], "id string, label string")
    got = [r["item"] for r in json.book_pattern(triples, labels, citizenship="Q8", limit=None).collect()]
    assert sorted(got) == books
    pages = [[r["item"] for r in json.book_pattern(triples, labels, citizenship="Q8", limit=10, offset=at).collect()] for at in (0, 10, 20)]
    assert [len(p) for p in pages] == [10, 10, 3] and sum(pages, []) == books


def test_deep_trees(spark):
    """Twelve levels, and leaves on the way down."""
    node = {"CategoryId": "c12", "title": "t12"}
    for k in range(11, 0, -1):
        node = {"CategoryId": f"c{k}", "title": f"t{k}", "sublist": [node, {"CategoryId": f"leaf{k}", "name": f"l{k}"}]}
    tree = json_lib.dumps({"data": [{"categories": [node]}]})
    rows = json.tree_leaves(spark.createDataFrame([(tree,)], "json string")).collect()
    assert {r["cid"] for r in rows} == {"c12", *(f"leaf{k}" for k in range(1, 12))}
    assert next(r["path"] for r in rows if r["cid"] == "c12") == "/".join(f"t{k}" for k in range(1, 13))


def test_first_writes_are_kept_whole(spark, tmp_path):
    source, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    schema = "k string, n long, say string"
    for rows in ([("a", 2, "second"), ("a", 1, "first"), (None, 5, "none")], [("a", 0, "late"), ("b", 7, "b"), (None, 4, "late none")], [("b", 1, "late b")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        streams.ingest_first(streams.stream(spark, source, schema), out, check, ("k",), "n")
    assert sorted((r["say"] for r in spark.read.parquet(out).collect())) == ["b", "first", "none"]


def test_null_keys_are_added_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "s", None, "t"), (2, "s", None, "u"), (3, None, "x", "v"), (4, "s", "x", "w")], "id long, source string, source_id string, title_raw string")
    path = str(tmp_path / "t")
    assert [ingest.append(spark, rows, path) for _ in range(2)] == [3, 0]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3, 4]


def test_review_file(spark, tmp_path):
    pairs = spark.createDataFrame([("a", " b ", 0.9), ("c", 'd "e"', 1.0)], "title_a string, title_b string, similarity double")
    files.review_csv(pairs, str(tmp_path / "review"))
    text = next((tmp_path / "review").glob("*.csv")).read_bytes().decode("utf-8")
    assert text == "\ufefftitle_a,title_b,similarity\r\nc,\"d \"\"e\"\"\",1.0\r\na, b ,0.9\r\n"


def test_pages_up_to_the_first_short_one(spark):
    rows = [("s", "a", 1, 60), ("s", "a", 2, None), ("s", "a", 3, 20), ("s", "a", 4, 60), ("s", "b", 1, 0), ("s", "b", 2, 60), ("s", "c", 1, 60), ("s", None, 1, 5), ("s", None, 2, 60)]
    pages = spark.createDataFrame(rows, "source string, task_key string, page int, items int")
    kept = {(r["task_key"], r["page"]) for r in ingest.until_short(pages, 60).collect()}
    assert kept == {("a", 1), ("a", 3), ("c", 1), (None, 1)}
    assert ingest.until_short(pages.limit(0), 60).count() == 0


def test_charset_of_pages(spark):
    pages = spark.createDataFrame([(1, bytearray("中国".encode("gbk"))), (2, None), (3, bytearray(b"")), (4, bytearray(b"a\xff"))], "id int, html binary")
    assert [r["html"] for r in files.decoded(pages, "gbk").orderBy("id").collect()] == ["中国", None, "", "a\ufffd"]


def test_database_table(spark, tmp_path):
    """Written, replaced, indexed and read back, in the database that comes with the engine."""
    url, driver = f"jdbc:derby:{tmp_path}/books", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([("红楼梦", "曹雪芹", "douban"), ("家", "", "weread")], "title string, author string, source string")
    for _ in range(2):
        files.write_table(rows, f"{url};create=true", "books", driver, indexes=("title", "author"))
    assert sorted(map(tuple, files.read_table(spark, url, "books", driver).collect())) == sorted(map(tuple, rows.collect()))
    indexed = files.read_table(spark, url, "(SELECT CONGLOMERATENAME AS n FROM SYS.SYSCONGLOMERATES WHERE ISINDEX) x", driver)
    assert {"IDX_BOOKS_TITLE", "IDX_BOOKS_AUTHOR"} <= {r[0] for r in indexed.collect()}

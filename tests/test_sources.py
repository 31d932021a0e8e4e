"""Scans: document shapes, file choice and order, URL lists, page expressions."""

import json

import pytest
from pyspark.sql import functions as F

from shelfspark.sources.files import (
    exclude_files,
    glob_regex,
    plain_path,
    rank_argument,
    rank_files,
    rank_of,
    select_files,
)
from shelfspark.sources.checkpoint import scan_checkpoint
from shelfspark.sources.html import decode_page, encode_page, scan_html_pages
from shelfspark.sources.json_docs import (
    explode_items,
    file_table,
    parse_documents,
    scan_json_documents,
    scan_json_lines,
    unwrap_books,
)
from shelfspark.sources.text_lists import (
    index_lines,
    indexed_lines,
    expand_page_range,
    explode_range,
    numbered_lines,
    page_list_urls,
    page_urls,
    scan_url_list,
)
from shelfspark.streaming.stateful import settings

HOST = "https://books.example"
SHAPES = {
    "list": '[{"a":1}]',
    "books": '{"books":[{"a":1},2],"meta":{}}',
    "null_then_items": '{"books":null,"items":[1]}',
    "text_then_data": '{"books":"x","data":[1,2]}',
    "data": '{"data":[]}',
    "no_key": '{"x":[1]}',
    "number": " 5 ",
    "text": '"books"',
    "null": "null",
    "broken": "{bad",
    "empty": "",
    "trailing": '{"a":1} x',
    "two": "[1],[2]",
    "nan": '{"a":NaN}',
    "bom": "﻿[1]",
    "repeated": '{"books":[1],"books":[2,3]}',
    "pretty": '\n{\n "items" : [ {"b" : 1.0} ]\n}\n',
}


def test_clean_shapes(docs):
    table = file_table(unwrap_books(parse_documents(docs(SHAPES)), "clean"))
    got = {r.file: (r.status, r.skipped, r.books_key, r.meta_keys_removed) for r in table.collect()}
    no_key = ("ok", "no books, items or data", None, [])
    scalar = ("ok", "not an object or array", None, [])
    bad = ("error", None, None, [])
    assert got == {
        "list": ("ok", None, None, []),
        "books": ("ok", None, "books", ["meta"]),
        "null_then_items": no_key,
        "text_then_data": ("ok", "books is not an array", None, []),
        "data": ("ok", None, "data", []),
        "no_key": no_key,
        "number": scalar, "text": scalar, "null": scalar,
        "broken": bad, "empty": bad, "trailing": bad, "two": bad, "nan": bad, "bom": bad,
        "repeated": ("ok", None, "books", []),
        "pretty": ("ok", None, "items", []),
    }


def test_merge_shapes(docs):
    good = {k: v for k, v in SHAPES.items() if k not in ("broken", "empty", "trailing", "two", "nan", "bom")}
    rows = explode_items(unwrap_books(parse_documents(docs(good), "failfast"), "merge")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.pos):
        got.setdefault(r.file, []).append(r.raw)
    assert got == {
        "list": ['{"a":1}'],
        "books": ['{"a":1}', "2"],
        "null_then_items": ["1"],
        "text_then_data": ["1", "2"],
        "no_key": ['{"x":[1]}'],
        "number": ["5"], "text": ['"books"'], "null": ["null"],
        "repeated": ["2", "3"],
        "pretty": ['{"b":1.0}'],
    }


def test_invalid_utf8_is_an_error_row(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'["\xff"]')
    (tmp_path / "b.json").write_bytes('["é"]'.encode())
    files = file_table(unwrap_books(parse_documents(scan_json_documents(spark, [str(tmp_path)]))))
    assert {r.file[-6:]: r.status for r in files.collect()} == {"a.json": "error", "b.json": "ok"}


def test_unknown_modes_raise(docs):
    with pytest.raises(ValueError):
        parse_documents(docs({"a": "1"}), "lenient")
    with pytest.raises(ValueError):
        unwrap_books(parse_documents(docs({"a": "1"})), "other")


@pytest.fixture
def tree(tmp_path):
    for name in ("b.json", "a.json", "a/b.json", "a/c d+%.json", "a/x.txt", "z_clean.json"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("[1]")
    return tmp_path


def names(df, tree):
    rows = df.orderBy("file_rank").collect()
    return [r.file.removeprefix(str(tree) + "/") for r in rows]


def test_select_files_in_order(spark, tree):
    flat = ["a.json", "b.json", "z_clean.json"]
    assert names(select_files(spark, [str(tree)]), tree) == flat
    # components order: everything inside folder a comes before a.json
    assert names(select_files(spark, [str(tree)], recursive=True), tree) == ["a/b.json", "a/c d+%.json", *flat]
    assert names(select_files(spark, [str(tree)], exclude=["*_clean.json"]), tree) == flat[:2]
    two = select_files(spark, [str(tree / "b.json"), str(tree), str(tree / "none.json")])
    assert names(two, tree) == ["b.json", "a.json", "z_clean.json"]


def test_scan_finds_the_same_files(spark, tree):
    paths = [str(tree / "b.json"), str(tree)]
    scanned = scan_json_documents(spark, paths, recursive=True)
    assert names(scanned, tree) == names(select_files(spark, paths, recursive=True), tree)


def test_rank_order_equals_component_order(spark):
    paths = ["a/b.json", "a.json", "a b/c.json", "a-b.json", "a/a/a.json", "б/я.json", "a", "B/x.json", "a!/x"]
    df = spark.createDataFrame([(p,) for p in paths], "file string")
    ranked = [r.file for r in df.orderBy(rank_of(F.col("file"))).collect()]
    assert ranked == sorted(paths, key=lambda p: p.split("/"))


def test_places_beyond_six_digits_keep_their_order(spark):
    files = spark.createDataFrame([("f", 1234567), ("f", 999999), ("f", 1000000), ("g", 1000000)], "file string, arg long")
    ranked = {r.file: r for r in rank_files(files).withColumn("arg", rank_argument(F.col("file_rank"))).collect()}
    assert ranked["f"].arg == 999999 and ranked["g"].arg == 1000000 and ranked["f"].file_rank < ranked["g"].file_rank
    with pytest.raises(Exception, match="not negative"):
        rank_files(spark.createDataFrame([("f", -1)], "file string, arg int")).collect()


def test_rank_files_keeps_first_argument(spark):
    df = spark.createDataFrame([("x", 12), ("x", 3), ("y", 100)], "file string, arg int")
    got = {r.file: r.a for r in rank_files(df).select("file", rank_argument(F.col("file_rank")).alias("a")).collect()}
    assert got == {"x": 3, "y": 100}


@pytest.mark.parametrize(
    "pattern,hits", [("*.json", {"/d/a.json", "/d/[x].json"}), ("/d/?.json", {"/d/a.json"}),
                     ("[[]x[]].json", {"/d/[x].json"}), ("b*", {"/d/b.txt"}), ("*", {"/d/a.json", "/d/[x].json", "/d/b.txt"})],
)
def test_exclude_patterns(spark, pattern, hits):
    paths = ["/d/a.json", "/d/[x].json", "/d/b.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "file string")
    left = {r.file for r in exclude_files(df, [pattern]).collect()}
    assert left == set(paths) - hits, glob_regex(pattern)


def test_plain_path(spark):
    df = spark.createDataFrame([("file:///a/b%20c+d.json",), ("hdfs://h:8020/x%25y",), ("/p",)], "u string")
    assert [r[0] for r in df.select(plain_path(F.col("u"))).collect()] == ["/a/b c+d.json", "/h:8020/x%y", "/p"]


def test_numbered_lines_over_many_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 90) if i % 7 else "" for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    (tmp_path / "small.txt").write_text("one\r\ntwo\rthree")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        df = numbered_lines(spark, str(tmp_path))
        rows = df.collect()
        blocks = spark.read.text(str(tmp_path)).select("_metadata.file_block_start").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert blocks > 10
    big = {r.line_no: r.value for r in rows if r.file.endswith("big.txt")}
    assert big == dict(enumerate(lines, 1))
    small = {r.line_no: r.value for r in rows if r.file.endswith("small.txt")}
    assert small == {1: "one", 2: "two", 3: "three"}


def test_scan_url_list(spark, tmp_path):
    (tmp_path / "u.txt").write_text("/detail/1\n\n# note\n  x/2 \nhttp://other/3\n #no\nhttps4\n")
    rows = scan_url_list(spark, str(tmp_path), HOST).collect()
    assert {r.line_no: r.url for r in rows} == {
        1: HOST + "/detail/1", 4: HOST + "/x/2", 5: "http://other/3", 7: "https4",
    }
    part = scan_url_list(spark, str(tmp_path), HOST, start_line=2, end_line=5).collect()
    assert sorted(r.line_no for r in part) == [4, 5]


def pages_of(spark, spec, total=None):
    df = spark.createDataFrame([(spec, total)], "spec string, total int")
    return sorted(r.page for r in expand_page_range(df, total=F.col("total")).collect())


@pytest.mark.parametrize(
    "spec,total,expected",
    [("1-5", None, [0, 1, 2, 3, 4]), ("1,3,5", None, [0, 2, 4]), (" 1 - 3 ,5,7-10,2", None, [0, 1, 2, 4, 6, 7, 8, 9]),
     ("all", 3, [0, 1, 2]), ("ALL", 2, [0, 1]), ("", 2, [0, 1]), (None, 1, [0]), ("all", 0, []), ("+2", None, [1])],
)
def test_page_ranges(spark, spec, total, expected):
    assert pages_of(spark, spec, total) == expected


@pytest.mark.parametrize(
    "spec,message",
    [("0", "start at 1"), ("0-3", "start at 1"), ("5-3", "reversed"), ("a-b", "not a page number"), ("1,", "not a page number"),
     ("-3", "not a page number"), ("1-2-3", "not a page number"), ("all", "needs a total"), ("1.5", "not a page number")],
)
def test_bad_page_ranges_raise(spark, spec, message):
    with pytest.raises(Exception, match=message):
        pages_of(spark, spec)


def test_explode_range_goes_through_blocks(spark):
    df = spark.createDataFrame([(1, 0, 2500), (2, 7, 7), (3, 5, 6), (4, 9, 2)], "k int, lo int, hi int")
    rows = explode_range(df, F.col("lo"), F.col("hi"), "n").collect()
    assert sorted((r.k, r.n) for r in rows) == [(1, n) for n in range(2500)] + [(3, 5)]


def test_page_urls(spark):
    df = spark.createDataFrame([("http://c/",)], "base string")
    rows = page_urls(df, F.lit(0), F.lit(3)).orderBy("page").collect()
    assert [r.url for r in rows] == ["http://c/", "http://c/?pg=1", "http://c/?pg=2"]
    listed = spark.createDataFrame([("http://c/", 4)], "base string, page int")
    assert page_list_urls(listed).first().url == "http://c/?pg=4"


def test_html_pages(spark, tmp_path):
    (tmp_path / "p.html").write_bytes("<b>Книга №5 «Ё»</b>".encode("cp1251"))
    assert scan_html_pages(spark, str(tmp_path)).first().html == "<b>Книга №5 «Ё»</b>"
    df = spark.createDataFrame([("ü é я",), (None,)], "t string").select(encode_page(F.col("t")).alias("b"))
    assert [r[0] for r in df.select(decode_page(F.col("b"))).collect()] == ["&#252; &#233; я", None]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a":1.0}\n"text"\n\nnull\n')
    rows = scan_json_lines(spark, str(tmp_path)).orderBy("pos").collect()
    assert [(r.pos, r.is_object, r.raw) for r in rows] == [(1, True, '{"a":1.0}'), (2, False, '"text"'), (4, False, "null")]
    assert json.loads(rows[0].raw) == {"a": 1.0}


def test_line_numbers_with_small_files_packed_beside_splits(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"s{i:02d}.txt").write_text("\n".join(f"{i}-{k}" for k in range(1, i % 5 + 2)) + "\n")
    (tmp_path / "big.txt").write_text("\n".join(f"big-{k}" for k in range(1, 4001)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        rows = numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 4000 + sum(i % 5 + 1 for i in range(40))
    assert all(r.value.split("-")[1] == str(r.line_no) for r in rows)


def test_damaged_checkpoint_raises(spark, tmp_path):
    folder = tmp_path / "c"
    spark.range(10).repartition(2).write.parquet(str(folder))
    sorted(folder.glob("part-*"))[0].write_bytes(b"damaged")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error
        scan_checkpoint(spark, str(folder), "id long").collect()
    assert scan_checkpoint(spark, str(tmp_path / "none"), "id long").count() == 0


def test_overlapping_arguments_read_each_file_once_without_a_join(spark, tmp_path):
    for name in ("a/x.json", "a/y.json", "a/b/z.json", "c/w.json", "a b+c%/q.json"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text('[{"n":"%s"}]' % name)
    root = str(tmp_path)
    cases = [
        ([f"{root}/a/y.json", f"{root}/a"], True), ([f"{root}/a", root], True), ([root, f"{root}/a/x.json"], True),
        ([f"{root}/a/x.json", f"{root}/a/x.json"], False), ([f"{root}/a", f"{root}/a/b"], False), ([f"{root}/a", f"{root}/a/"], False),
        ([f"{root}/a b+c%", root], True), ([f"{root}/*/x.json", f"{root}/a"], True), ([f"{root}/c", root], True),
    ]
    for paths, recursive in cases:
        docs = scan_json_documents(spark, paths, recursive=recursive)
        found = sorted((r.file, r.file_rank) for r in docs.select("file", "file_rank").collect())
        expected = sorted((r.file, r.file_rank) for r in select_files(spark, paths, recursive).collect())
        assert found == expected, paths
        assert "Join" not in docs._jdf.queryExecution().executedPlan().toString()


def test_indexed_lines_equal_the_files_and_read_few_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    texts = {"a": [f"line {i}" for i in range(5000)], "b": ["", "x", "", "é"], "c": [f"{i}" * 3 for i in range(2500)]}
    for name, lines in texts.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1"}):
        index_lines(spark, f"{tmp_path}/*.txt", str(tmp_path / "index"), group_bytes=4096)
    rows = indexed_lines(spark, str(tmp_path / "index")).collect()
    got = {name: [r.value for r in sorted(rows, key=lambda r: r.line_no) if r.file.endswith(f"/{name}.txt")] for name in texts}
    assert got == texts
    part = indexed_lines(spark, str(tmp_path / "index"), 1001, 1010)
    assert sorted((r.file[-5], r.line_no, r.value) for r in part.collect()) == sorted(
        (name, i + 1, texts[name][i]) for name in "ac" for i in range(1000, 1010)
    )
    assert "GreaterThanOrEqual(line_no,1001), LessThanOrEqual(line_no,1010)" in part._jdf.queryExecution().executedPlan().toString()
    ranges = []
    for f in (tmp_path / "index").glob("*.parquet"):
        meta = pq.ParquetFile(f).metadata
        ranges += [meta.row_group(g).column(1).statistics for g in range(meta.num_row_groups)]
    # the groups know their ranges, and few of them have a line of this one
    assert sum(s.min <= 1010 and s.max >= 1001 for s in ranges) < 0.5 * len(ranges)

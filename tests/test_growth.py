"""What must not grow with the tables: plans that hold all pages in one place, work done twice."""

from pyspark.sql import functions as F

from shelfspark.operators.paging import has_keyword, keyword_context
from shelfspark.plans.detail import BOOK_SCHEMA, extract_details
from shelfspark.plans.listing import collect_links

HOST = "https://books.example"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_detail_pages_are_no_broadcast(spark):
    urls = spark.createDataFrame([(1, HOST + "/detail/book1.html")], "line_no long, url string")
    pages = spark.createDataFrame([(HOST + "/detail/book1.html", "<html>")], "url string, html string")
    job = extract_details(urls, pages, spark.createDataFrame([], BOOK_SCHEMA), HOST, stage=False)
    assert "BroadcastHashJoin" not in physical(job.results)
    assert "BroadcastHashJoin" not in physical(job.books)


def test_listing_pages_are_no_broadcast(spark):
    wanted = spark.createDataFrame([("a", 0, HOST + "/a")], "base string, page long, url string")
    stored = spark.createDataFrame([(HOST + "/a", "<html>")], "url string, html string")
    assert "SortMergeJoin [url" in physical(collect_links(wanted, stored, HOST, stage=False).pages)


def test_keyword_context_looks_once(spark):
    texts = ["x" * 300 + "Страницы: 1</table>y", "страниц", "nothing", "", None, "</table>Страницы" + "z" * 2000]
    pages = spark.createDataFrame(list(enumerate(texts)), "id int, html string")
    found = pages.select("id", has_keyword(F.col("html")).alias("has"), keyword_context(F.col("html")).alias("c")).collect()
    assert {r.id for r in found if r.has} == {r.id for r in found if r.c is not None} == {0, 1, 5}
    at = next(r.c for r in found if r.id == 0)
    assert (at.word, at["head"], at.tail) == ("Страницы", "x" * 200 + "Страницы: 1</table>", ("x" * 200 + "Страницы: 1</table>")[-200:])
    # a search for each of the two words, not one for each use of a place
    assert optimized(pages.repartition(2).select(keyword_context(F.col("html")).alias("c"))).lower().count("instr(") == 2


def test_pager_context_makes_pages_in_all_partitions(spark):
    from shelfspark.bindings.listing_bindings import pager_context

    plan = pager_context(spark, "/root/testdata/sf0.001")
    assert plan.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "isnotnull(c" not in optimized(plan)


def test_many_pages_in_a_file(spark, tmp_path):
    from shelfspark.sources.html import PAGE_END, scan_html_pages, write_html_pages

    pages = ["<html>Страницы\n«»</html>", "второй\r\nряд \"x\" 'y'\n", "é ☃ 😀", "", " <b> "]
    out = str(tmp_path / "pages")
    write_html_pages(spark.createDataFrame([(p,) for p in pages], "html string").coalesce(1), out)
    assert len(list((tmp_path / "pages").glob("part-*"))) == 1
    found = [r.html for r in scan_html_pages(spark, out, PAGE_END).collect()]
    assert sorted(found) == sorted([*pages[:2], "&#233; &#9731; &#128512;", *pages[3:]])


def test_parsing_copies_no_elements(spark):
    from shelfspark.functions.text import casefold
    from shelfspark.sources.json_docs import parse_documents

    texts = ["[1,2]", "1", "null", "", "1,2", "[1", '{"a":1} x']
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "file string, doc string").repartition(2)
    parsed = parse_documents(docs)
    assert [r.error is None for r in parsed.orderBy("file").collect()] == [True, True, True, False, False, False, False]
    assert "array<variant>" not in parsed._jdf.queryExecution().toString()
    # letters that fold to several are looked up, not replaced one kind after the other
    folded = docs.select(casefold(F.col("doc")).alias("c"))
    assert folded._jdf.queryExecution().optimizedPlan().toString().count("replace(") < 5


def test_batches_of_a_stream_are_no_more_with_more_splits(spark, tmp_path):
    from shelfspark.bindings.page_bindings import _stream_job
    from shelfspark.streaming.stateful import settings

    given = "/root/testdata/sf0.001"
    spark.read.parquet(f"{given}/orders.parquet").repartition(20).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet(f"{given}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1"}):
        assert spark.read.parquet(f"{tmp_path}/orders.parquet").rdd.getNumPartitions() >= 20
        output, _ = _stream_job(spark, str(tmp_path))
    # each meets all pages: two batches a run, numbered from 0, where there were five
    assert list(output.notes()["batches"].values()) == [3]

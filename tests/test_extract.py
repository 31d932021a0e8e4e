"""Detail and listing pages against Python's own regular expressions."""

import re

import pytest
from pyspark.sql import functions as F

from shelfspark.functions.regex import first_group, first_match
from shelfspark.functions.text import decode_entities, is_blank, strip_tags
from shelfspark.functions.urls import absolute_url, extract_id
from shelfspark.operators.extract import DETAIL_RULES, apply_rules, classify_page, extract_records, parse_detail_page
from shelfspark.operators.paging import (
    keyword_context,
    listing_blocks,
    pagination_info,
    pagination_profile,
    visible_pages,
)
from shelfspark.plans.detail import BOOK_SCHEMA, detail_files, extract_details
from shelfspark.plans.listing import collect_links, listing_files, wanted_pages

HOST = "https://books.example"
FULL = """<html><head><title>[ Дом ]
 Автор </title><meta name="description" content=" о
книге "></head>
<p><b>Каталог:</b> <a href="/c/">Все</a> <a href="/c/x/">Проза</a><br>
<h3 class="nomargin"><a  href="/?cat_author=%C0&amp;author_key=15" title="x"> Автор <b>А.</b> </a></h3>
<h1 class="nomargin"> Дом </h1><h3 class="nomargin">Серия: Окна </h3>
<tr><td>Издательство:  Лань </td></tr>
<a href="/qna/ref/binding/">Переплет</a>: мягкий ; 320  страниц;\xa01999 г.
<a href="/qna/ref/isbn/">ISBN</a>: 5-01 ;<a href="/qna/ref/format/">Формат</a>: 84x108 <br>
<tr><td>Язык: <i>рус</i>ский</td></tr><small class="ltgray">На сайте с  1 мая </small>
<a href="/img/x/1.jpg"><img   src="/img/t/1.jpg"></a><img src="/chart/cnt.php?id=77&amp;c=1">
<h3>Аннотация</h3>
<p> <b>Текст</b>&nbsp;&laquo;x&raquo; &mdash; &amp;lt;&lt;&quot; </p>
<a href="./book1.html" title="предыдущая книга в разделе"><a href="./book3.html" title="следующая книга">
"""
PAGES = {
    "/detail/book2.html": FULL,
    "/x": FULL.replace("/img/x/1.jpg", "/pic/1.jpg") + '<img src="/img/defcover.jpg">',
    "/small": '<html><img src="/img/s.gif"  width="60"><h1 class="nomargin"></h1>',
    "/sold": FULL + "сейчас этого издания книги в продаже нет",
    "/tables": FULL + "<table a><tr><td b> цена </td></tr> </table>\n<table><tr><td>",
    "/no": FULL + "<table><tr><td>" + "Н" + "ЕТ" + "</td></tr></table><table><tr><td>",
    "/far": FULL + "<table><tr><td>" + "x" * 99 + "нет</td></tr></table><table><tr><td>",
    "/near": FULL + "<table><tr><td>" + "x" * 97 + "нет</td></tr></table><table><tr><td>",
    "/nothing": "<html><title>[a] b</title>",
    "/crumbs": "<html><b>Каталог:</b> нет ссылок</p><tr><td>Издательство: </td></tr>",
    "/sep": "<html><a href=\"/qna/ref/isbn/\">ISBN</a>: 1 <small class=\"ltgray\">На сайте с a b\x85c</small>",
}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(list(PAGES.items()), "url string, html string")


def python_match(rule, html):
    return re.search(rule.pattern, html, re.DOTALL if rule.dotall else 0)


def test_rules_equal_python(spark, pages):
    rows = {r.url: r for r in apply_rules(pages, DETAIL_RULES).collect()}
    for url, html in PAGES.items():
        for rule in DETAIL_RULES:
            match = python_match(rule, html)
            for name, (group, _) in rule.fields.items():
                value = rows[url][name]
                if match is None:
                    assert value is None, (url, name)
                elif name in ("pages", "year"):
                    assert value == int(match.group(group))
                elif name not in ("language", "annotation"):
                    assert value.strip() == match.group(group).strip(), (url, name)


def test_record_fields(spark, pages):
    rows = {r.url: r for r in parse_detail_page(pages, HOST, keep=("url",)).collect()}
    r = rows["/detail/book2.html"]
    assert (r.book_id, r.title_from_title, r.author_from_title) == ("2", "Дом", "Автор")
    assert (r.meta_description, r.category_path, r.category) == ("о\nкниге", "Все > Проза", "Проза")
    assert (r.category_urls, r.category_url) == (["/c/", "/c/x/"], HOST + "/c/x/")
    assert (r.author, r.author_key) == ("Автор <b>А.</b>", "15")
    assert r.author_search_url == "/?cat_author=%C0&author_key=15"
    assert (r.binding, r["pages"], r.year, r.isbn, r.format) == ("мягкий", 320, 1999, "5-01", "84x108")
    assert (r.series, r.publisher, r.language, r.date_added) == ("Окна", "Лань", "русский", "1 мая")
    assert (r.image_large_url, r.image_thumb_url, r.has_image) == (HOST + "/img/x/1.jpg", HOST + "/img/t/1.jpg", True)
    assert (r.view_counter_id, r.annotation) == ("77", "Текст «x» — <<\"")
    assert (r.prev_book_url, r.next_book_url) == (HOST + "/detail/book1.html", HOST + "/detail/book3.html")
    assert (r.in_stock, r.in_stock_text, r.n_fields) == (False, "нет в продаже", 31)


def test_images_and_stock(spark, pages):
    rows = {r.url: r for r in parse_detail_page(pages, HOST, keep=("url",)).collect()}
    assert (rows["/x"].image_large_url, rows["/x"].image_thumb_url, rows["/x"].has_image) == (
        None, HOST + "/img/defcover.jpg", False,
    )
    assert (rows["/small"].image_thumb_url, rows["/small"].has_image) == (HOST + "/img/s.gif", True)
    assert (rows["/nothing"].image_thumb_url, rows["/nothing"].has_image) == (None, False)
    stock = {u: rows[u].in_stock for u in ("/sold", "/tables", "/no", "/far", "/near", "/nothing")}
    assert stock == {"/sold": False, "/tables": True, "/no": False, "/far": True, "/near": False, "/nothing": False}
    # an empty match counts as present
    assert rows["/small"].title == "" and rows["/small"].book_id is None
    assert (rows["/crumbs"].category_path, rows["/crumbs"].category_urls, rows["/crumbs"].category) == ("", [], None)
    assert rows["/crumbs"].publisher == "" and rows["/crumbs"].n_fields == 8


def test_status(spark, pages):
    more = spark.createDataFrame(
        [("/blank", " \n\xa0"), ("/none", None), ("/text", "просто\r\nтекст " + "y" * 200), ("/403", "Try harder")],
        "url string, html string",
    )
    rows = {r.url: r for r in extract_records(pages.union(more), HOST, keep=("url",)).collect()}
    status = {u: r.status for u, r in rows.items()}
    assert status == {
        **dict.fromkeys(PAGES, "ok"), "/nothing": "unparsed",
        "/blank": "empty", "/none": "empty", "/text": "no_markup", "/403": "blocked",
    }
    assert rows["/text"].error == "no markup: " + ("просто  текст " + "y" * 200)[:120].strip()
    assert rows["/x"].error is None and rows["/nothing"].error
    assert classify_page(more).where("status = 'ok'").isEmpty()


def test_text_helpers(spark):
    df = spark.createDataFrame([("&amp;lt;&lt;b&gt; <i\nx>y</i>&nbsp;<>",)], "t string")
    assert df.select(decode_entities(strip_tags(F.col("t")))).first()[0] == "<<b> y <>"
    urls = ["http://a", "/a", "a", "httpx", ""]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(absolute_url(F.col("u"), HOST)).collect()]
    assert got == ["http://a", HOST + "/a", HOST + "/a", "httpx", HOST + "/"]
    ids = spark.createDataFrame([("/book12.html",), ("/book.html",), ("x/book7.htmlx/book8.html",)], "u string")
    assert [r[0] for r in ids.select(extract_id(F.col("u"))).collect()] == ["12", None, "7"]


BLOCK = '<div style="border-bottom:1px solid #330066;padding:0.35em 0em 0.35em 0em;">{}<br clear="all" />\n </div>'
PAGER = (
    '<td><a href="?pg=10">11</a></td><td class="selected"><a href="?pg=2">3</a></td><td a><a href="?pg=2">3</a></td>'
    '<td><a href="?pg=4"><img src="r.gif" alt="вперед"></a></td>'
    '<td><a href="?pg=40"><img src="l.gif" alt="на последнюю страницу"></a></td>'
)
LISTING = (
    BLOCK.format('<a href="/detail/book1.html">x</a>\n') + BLOCK.format("нет")
    + BLOCK.format('<a href="/other"><a href="/detail/book2.html"><a href="/detail/book9.html">') + PAGER
)


def test_listing_page(spark):
    df = spark.createDataFrame([(1, LISTING), (2, "<html>")], "p int, html string")
    rows = listing_blocks(df, HOST, ("p",)).collect()
    assert sorted((r.p, r.block_no, r.detail_url) for r in rows) == [
        (1, 0, HOST + "/detail/book1.html"), (1, 2, HOST + "/detail/book2.html"),
    ]
    info = {r.p: r.i for r in df.select("p", pagination_info(F.col("html")).alias("i")).collect()}
    assert tuple(info[1]) == (2, 41, "?pg=40", [2, 10]) and tuple(info[2]) == (None, None, None, [])
    profile = df.where("p = 1").select(pagination_profile(F.col("html")).alias("x")).first().x
    assert [tuple(c) for c in profile.cells] == [("10", "11"), ("2", "3")]
    assert [tuple(c) for c in profile.images] == [("4", "вперед"), ("40", "на последнюю страницу")]
    assert (profile.selected_pg, profile.selected_label) == ("2", "3")
    assert sorted(r.page for r in visible_pages(df).collect()) == [2, 10]


@pytest.mark.parametrize(
    "text",
    ["a" * 300 + "Страницы" + "b" * 1500, "страниц" + "c" * 30 + "</table>tail", "x</table>Страницы y" + "z" * 990 + "</table>",
     "страниц … Страницы</table>", "нет слова", "q" * 100 + "страниц" + "я" * 2000 + "</table>"],
)
def test_keyword_context_equals_python(spark, text):
    expected = None
    for word in ("Страницы", "страниц"):
        place = text.find(word)
        if place > -1:
            start, end = max(0, place - 200), min(len(text), place + 1000)
            stop = text.find("</table>", place)
            end = stop + 8 if 0 < stop < end else end
            expected = (word, text[start:end][:500], text[start:end][-200:])
            break
    got = spark.createDataFrame([(text,)], "t string").select(keyword_context(F.col("t")).alias("c")).first().c
    assert (got and tuple(got)) == expected


def test_detail_job(spark):
    def page(title, extra=""):
        return f'<html><h1 class="nomargin">{title}</h1>{extra}'

    urls = spark.createDataFrame(
        [(1, "u1"), (2, "u2"), (3, "u1"), (4, "old"), (5, "gone"), (6, "old")], "line_no bigint, url string"
    )
    stored = spark.createDataFrame(
        [("u1", page("A")), ("u2", "<html>x"), ("old", page("новое")), ("spare", page("S"))], "url string, html string"
    )
    earlier = spark.createDataFrame(
        [(0, 0, "old", page("B")), (0, 9, "older", page("C"))], "run int, pos bigint, url string, html string"
    )
    existing = parse_detail_page(earlier, HOST, keep=("run", "pos"))
    job = extract_details(urls, stored, existing, HOST)
    assert {(r.url, r.status) for r in job.results.collect()} == {("u1", "ok"), ("u2", "unparsed"), ("gone", "empty")}
    books = job.books.orderBy("run", "pos").collect()
    assert [(b.detail_url, b.title) for b in books] == [("old", "B"), ("older", "C"), ("u1", "A")]
    assert tuple(job.metrics.first()) == (6, 2, 1, 2, 3)


def test_pages_beyond_the_stop_have_not_failed(spark):
    wanted = spark.createDataFrame([("b", p, f"b?pg={p}") for p in range(6)], "base string, page int, url string")
    block = BLOCK.format('<a href="/detail/book1.html">')
    html = spark.createDataFrame([("b?pg=0", block), ("b?pg=2", "<p>none</p>")], "url string, html string")
    assert [r.page_no for r in collect_links(wanted, html, HOST).failed.collect()] == [2]
    html = spark.createDataFrame([(f"b?pg={p}", block) for p in (0, 2, 4)], "url string, html string")
    assert sorted(r.page_no for r in collect_links(wanted, html, HOST).failed.collect()) == [2, 4, 6]
    assert [r.page_no for r in collect_links(wanted, html, HOST, max_pages=2).failed.collect()] == [2]


def test_listing_job(spark):
    def stored(section, page, n, last=None):
        blocks = "".join(BLOCK.format(f'<a href="/detail/book{section}{page}{i}.html">') for i in range(n))
        pager = f'<a href="?pg={last}"><img x alt="На последнюю страницу"></a>' if last else ""
        return (f"b{section}?pg={page}", blocks + pager)

    wanted = spark.createDataFrame(
        [(f"b{s}", p, f"b{s}?pg={p}") for s in (1, 2) for p in range(5)], "base string, page int, url string"
    )
    html = spark.createDataFrame(
        [stored(1, 0, 1), stored(1, 1, 2, last=2), stored(1, 2, 1), stored(1, 3, 1),
         stored(2, 0, 1), stored(2, 2, 1), stored(2, 3, 0), stored(2, 4, 1)],
        "url string, html string",
    )
    job = collect_links(wanted, html, HOST)
    got = [r.detail_url.split("book")[-1] for r in job.links.orderBy("base", "page", "block_no").collect()]
    assert got == ["100.html", "110.html", "111.html", "120.html", "200.html", "220.html"]
    assert sorted((r.page_no, r.url) for r in job.failed.collect()) == [(2, "b2?pg=1")]
    limited = collect_links(wanted, html, HOST, max_pages=1)
    assert limited.links.count() == 2


def test_detail_files_over_three_runs(spark, tmp_path):
    def page(title):
        return f'<html><h1 class="nomargin">{title}</h1>'

    (tmp_path / "urls.txt").write_text("/a\n# note\n/b\n/a\n/c\n")
    html = {HOST + "/a": page("A"), HOST + "/c": page("C")}
    urls = str(tmp_path / "urls.txt")

    def run(number, resume, **lines):
        stored = spark.createDataFrame(list(html.items()), "url string, html string")
        out = str(tmp_path / f"run{number}")
        resume = None if resume is None else str(tmp_path / f"run{resume}")
        books = detail_files(spark, urls, stored, out, HOST, resume, number, **lines)
        return [(b.run, b.pos, b.title) for b in books.orderBy("run", "pos").collect()]

    assert run(1, None, end_line=4) == [(1, 1, "A")]
    assert [r.value for r in spark.read.text(str(tmp_path / "run1/failed/urls")).collect()] == [HOST + "/b"]
    meta = spark.read.json(str(tmp_path / "run1/meta")).first()
    assert (meta.total_books, meta.total_input_urls, meta.processed_new, meta.failed) == (1, 3, 1, 1)
    html[HOST + "/b"] = page("B")
    expected = [(1, 1, "A"), (2, 3, "B"), (2, 5, "C")]
    assert run(2, 1) == expected
    # nothing new: the old records come back and nothing is written
    assert run(3, 2) == expected and not (tmp_path / "run3").exists()
    # an earlier run that is not there counts as empty
    assert len(run(4, 99)) == 3
    assert spark.createDataFrame([], BOOK_SCHEMA).columns[:2] == ["run", "pos"]


def test_listing_files(spark, tmp_path):
    sections = spark.createDataFrame([("b1", 3, "2-3"), ("b2", 2, "all")], "base string, end_page int, spec string")
    by_spec = wanted_pages(sections, spec="spec")
    assert sorted((r.base, r.page) for r in by_spec.collect()) == [("b1", 1), ("b1", 2), ("b2", 0), ("b2", 1)]
    wanted = wanted_pages(sections, start_page=1)
    assert sorted((r.url) for r in wanted.collect()) == ["b1?pg=1", "b1?pg=2", "b2?pg=1"]
    stored = spark.createDataFrame(
        [(u, BLOCK.format(f'<a href="/detail/book{i}.html">')) for i, u in enumerate(["b1?pg=2", "b2?pg=1"])],
        "url string, html string",
    )
    links = listing_files(spark, wanted, stored, str(tmp_path / "out"), HOST)
    assert [r.detail_url for r in links.collect()] == [HOST + "/detail/book0.html", HOST + "/detail/book1.html"]


def test_empty_match_is_no_missing_match(spark):
    rows = [("ab",), ("b",), ("xyz",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(
        "t", first_match(F.col("t"), "a*").alias("m"), first_group(F.col("t"), "(a)?b").alias("g"), first_group(F.col("t"), "(a*)b").alias("e"),
        first_group(F.col("t"), "(x)|(y)", 2).alias("o"),
    )
    got = {r.t: (r.m, r.g, r.e, r.o) for r in df.collect()}
    assert got["ab"] == ("a", "a", "a", None) and got["b"] == ("", None, "", None)
    assert got["xyz"] == ("", None, None, None) and got[""] == ("", None, None, None) and got[None] == (None,) * 4


def test_pager_numbers_beyond_int(spark):
    cells = "".join(f'<td><a href="?pg={n}">1</a></td>' for n in (5, 2147483647, 99999999999, 10**30))
    html = cells + '<a href="?pg=9223372036854775807"><img x alt="На последнюю страницу"></a>'
    df = spark.createDataFrame([(html,)], "html string")
    info = df.select(pagination_info(F.col("html")).alias("i")).first().i
    assert info.pages == [5, 2147483647, 99999999999] and info.total_pages is None
    assert sorted(r.page for r in visible_pages(df).collect()) == [5, 2147483647, 99999999999]


def test_blank_pages(spark):
    texts = ["", " ", "\xa0" + " " * 200 + "\n", " " * 63 + "\x1f" * 70 + "\u3000", " " * 64 + "x", "\xa0" * 20 + " " * 500 + ".",
             " " * 640, "x" + " " * 100, " \u200b" + " " * 64, "\u2028" * 40 + "<html", "\n" * 17 + "Try harder", None]
    pages = spark.createDataFrame(list(enumerate(texts)), "id int, html string").repartition(2)
    found = {r.id: r for r in classify_page(pages).collect()}
    assert [found[i].status == "empty" for i in range(len(texts))] == [t is None or not t.strip() for t in texts]
    assert (found[9].status, found[10].status) == ("ok", "blocked")
    blank = {r.id: r.b for r in pages.select("id", is_blank(F.col("html")).alias("b")).collect()}
    assert all(blank[i] == (None if t is None else not t.strip()) for i, t in enumerate(texts))
    # trimming looks at characters one by one, so it gets the begin of a text, never all of it
    trimmed = re.findall(r"trim\((.{9})", classify_page(pages).select("status")._jdf.queryExecution().optimizedPlan().toString(), re.I)
    assert trimmed and not any("html#" in t for t in trimmed)

"""Listing pages derived from parts, and page sequences from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.bindings.tables import Registry, table
from shelfspark.functions.urls import listing_url
from shelfspark.operators.paging import (
    failed_pages,
    has_keyword,
    keyword_context,
    listing_blocks,
    pagination_info,
    pagination_profile,
    running_totals,
    take_pages,
    visible_pages,
)
from shelfspark.plans.listing import collect_links

_registry = Registry()
QUERIES, ORACLE = _registry.queries, _registry.oracle
query = _registry.add

HOST = "https://books.example"
_BLOCK_START = '<div style="border-bottom:1px solid #330066;padding:0.35em 0em 0.35em 0em;">'
_BLOCK_END = '<br clear="all" />\n</div>'


def _cat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def listing_html():
    """A listing page per part: three blocks, the middle one without a link, and a pager."""
    size, pid = F.col("p_size"), F.col("p_partkey")

    def block(*inner):
        return _cat(_BLOCK_START, *inner, _BLOCK_END)

    def cell(page):
        return _cat('<td><a href="?pg=', page, '">', page + 1, "</a></td>")

    return _cat(
        "<html><body>",
        F.when(F.col("p_brand") != "Brand#1", block('<a href="/detail/book', pid, '.html">', F.col("p_name"), "</a>")).otherwise(""),
        block("<b>без ссылки</b>"),
        F.when(size > 10, block('<img><a\nhref="/detail/book', pid + 1, '.html">n</a>')).otherwise(""),
        F.when(size > 2, _cat(
            "<table><tr><td>Страницы:</td>", cell(size), cell(size - 1), cell(size + 9), cell(size),
            '<td class="selected"><a href="?pg=', size, '">', size + 1, "</a></td>",
            F.when(size > 20, _cat(
                '<td><a href="?pg=', size + 40, '"><img src="r.gif" alt="На последнюю страницу"></a></td>'
            )).otherwise(""),
            "</tr></table>хвост",
        )).otherwise(""),
        "</body></html>",
    )


def listing_pages(spark, sf_dir):
    # the table's rows are dealt out while they are narrow, before pages are made of them
    part = table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return part.withColumn("html", listing_html())


@query(
    "pagination_info",
    """
SELECT p_partkey, CASE WHEN p_size > 2 THEN p_size END AS current_page,
  CASE WHEN p_size > 20 THEN p_size + 41 END AS total_pages,
  CASE WHEN p_size > 20 THEN '?pg=' || (p_size + 40) END AS last_page_url,
  CASE WHEN p_size > 2 THEN (p_size - 1) || ',' || p_size || ',' || (p_size + 9) ELSE '' END AS pages
FROM part""",
)
def pagination_info_query(spark, sf_dir):
    """I13, E8."""
    info = listing_pages(spark, sf_dir).select("p_partkey", pagination_info(F.col("html")).alias("i"))
    return info.select(
        "p_partkey", "i.current_page", "i.total_pages", "i.last_page_url",
        F.array_join(F.transform("i.pages", lambda p: p.cast("string")), ",").alias("pages"),
    )


@query(
    "visible_pages",
    """
SELECT DISTINCT p_brand, unnest([p_size - 1, p_size, p_size + 9])::INTEGER AS page FROM part WHERE p_size > 2""",
)
def visible_pages_query(spark, sf_dir):
    """E8 across the pages of a section."""
    return visible_pages(listing_pages(spark, sf_dir), ("p_brand",))


@query(
    "pagination_profile",
    """
WITH c AS (
  SELECT p_partkey, p_size, CASE WHEN p_size > 2 THEN
    list_sort([(p_size - 1) || ':' || p_size, p_size || ':' || (p_size + 1), (p_size + 9) || ':' || (p_size + 10)])
    END AS cells FROM part)
SELECT p_partkey, coalesce(array_to_string(cells, ','), '') AS cells,
  CASE WHEN p_size > 20 THEN (p_size + 40) || ':На последнюю страницу' ELSE '' END AS images,
  CASE WHEN p_size > 2 THEN p_size::VARCHAR END AS selected_pg,
  CASE WHEN p_size > 2 THEN (p_size + 1)::VARCHAR END AS selected_label
FROM c""",
)
def pagination_profile_query(spark, sf_dir):
    """I14."""
    profile = listing_pages(spark, sf_dir).select("p_partkey", pagination_profile(F.col("html")).alias("p"))

    def shown(pairs, label):
        return F.array_join(F.transform(pairs, lambda x: F.concat(x["pg"], F.lit(":"), x[label])), ",")

    return profile.select(
        "p_partkey",
        shown(F.col("p.cells"), "label").alias("cells"),
        shown(F.col("p.images"), "alt").alias("images"),
        "p.selected_pg",
        "p.selected_label",
    )


_CONTEXT = """
WITH w AS (SELECT {id}, {text} AS html, CASE WHEN instr({text}, '{a}') > 0 THEN '{a}' WHEN instr({text}, '{b}') > 0
  THEN '{b}' END AS word FROM {table}),
x AS (SELECT *, instr(html, word) AS place FROM w WHERE word IS NOT NULL),
y AS (SELECT *, greatest(0, place - 201) AS lo, least(length(html), place + 999) AS hi,
  CASE WHEN instr(html[place:], '</table>') > 0 THEN place + instr(html[place:], '</table>') - 2 ELSE -1 END AS tend FROM x),
z AS (SELECT *, html[lo + 1 : CASE WHEN tend > 0 AND tend < hi THEN tend + 8 ELSE hi END] AS excerpt FROM y)
SELECT {id}, word, excerpt[1:500] AS head, right(excerpt, 200) AS tail FROM z
"""


@query(
    "keyword_context",
    _CONTEXT.format(id="page_id", text="html", a="tionhe", b="</h1>", table="pages"),
)
def keyword_context_query(spark, sf_dir):
    """I15 on whole pages."""
    words = ("tionhe", "</h1>")
    pages = table(spark, sf_dir, "pages").where(has_keyword(F.col("html"), words))
    return pages.select("page_id", keyword_context(F.col("html"), words).alias("c")).select("page_id", "c.word", "c.head", "c.tail")


_CELL = """'<td><a href="?pg=' || ({n}) || '">' || ({n} + 1) || '</a></td>'"""
_LISTING_SQL = (
    "'<html><body>' || CASE WHEN p_brand <> 'Brand#1' THEN @start || '<a href=\"/detail/book' || p_partkey || '.html\">'"
    " || p_name || '</a>' || @end ELSE '' END || @start || '<b>без ссылки</b>' || @end || CASE WHEN p_size > 10 THEN"
    " @start || '<img><a' || chr(10) || 'href=\"/detail/book' || (p_partkey + 1) || '.html\">n</a>' || @end ELSE '' END"
    " || CASE WHEN p_size > 2 THEN '<table><tr><td>Страницы:</td>' || "
    + " || ".join(_CELL.format(n=n) for n in ("p_size", "p_size - 1", "p_size + 9", "p_size"))
    + " || '<td class=\"selected\"><a href=\"?pg=' || p_size || '\">' || (p_size + 1) || '</a></td>' || CASE WHEN p_size > 20"
    " THEN '<td><a href=\"?pg=' || (p_size + 40) || '\"><img src=\"r.gif\" alt=\"На последнюю страницу\"></a></td>'"
    " ELSE '' END || '</tr></table>хвост' ELSE '' END || '</body></html>'"
).replace("@start", f"'{_BLOCK_START}'").replace("@end", "('<br clear=\"all\" />' || chr(10) || '</div>')")


@query(
    "pager_context",
    _CONTEXT.format(id="p_partkey", text=f"({_LISTING_SQL})", a="Страницы", b="страниц", table="part"),
)
def pager_context(spark, sf_dir):
    """I15 on listing pages, cut at the table end."""
    pages = listing_pages(spark, sf_dir).where(has_keyword(F.col("html")))
    return pages.select("p_partkey", keyword_context(F.col("html")).alias("c")).select("p_partkey", "c.word", "c.head", "c.tail")


@query(
    "listing_blocks",
    """
SELECT p_partkey, 0 AS block_no, 'https://books.example/detail/book' || p_partkey || '.html' AS detail_url
FROM part WHERE p_brand <> 'Brand#1'
UNION ALL SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE 2 END,
  'https://books.example/detail/book' || (p_partkey + 1) || '.html' FROM part WHERE p_size > 10""",
)
def listing_blocks_query(spark, sf_dir):
    """I16, C4."""
    return listing_blocks(listing_pages(spark, sf_dir), HOST, ("p_partkey",))


def event_pages(spark, sf_dir):
    """Events as pages of a user's section, numbered by event: errors failed, low values are blank."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("base"),
        F.col("event_id").alias("page"),
        F.when(F.col("value") < 1, 0).otherwise(F.ceil("value")).cast("bigint").alias("n_books"),
        (F.col("event_type") != "error").alias("ok"),
        F.when(
            F.col("event_type") == "purchase", F.col("event_id") + F.floor(F.col("value") * 20)
        ).cast("bigint").alias("total_pages"),
    )


_PAGES = """
WITH p AS (
  SELECT user_id AS base, event_id AS page, (CASE WHEN value < 1 THEN 0 ELSE ceil(value) END)::BIGINT AS n_books,
    event_type <> 'error' AS ok,
    CASE WHEN event_type = 'purchase' THEN (event_id + floor(value * 20))::BIGINT END AS total_pages FROM events)
"""
# Adds to the CTE ``p`` where each section stops.
_STOPS = """
g AS (SELECT *, ok AND n_books > 0 AS good FROM p),
k AS (SELECT *, first_value(CASE WHEN good AND total_pages > 0 THEN total_pages END IGNORE NULLS)
  OVER (PARTITION BY base ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tk FROM g),
s AS (SELECT *, coalesce(max(CASE WHEN (good AND coalesce(page + 1 >= tk, FALSE)) OR (ok AND n_books = 0) THEN 1 ELSE 0 END)
    OVER (PARTITION BY base ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
  coalesce(sum(good::INTEGER) OVER (PARTITION BY base ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS done FROM k)
"""
_TAKEN = _PAGES.rstrip() + "," + _STOPS + "SELECT base, page, n_books FROM s WHERE good AND stopped = 0\n"


@query(
    "running_totals",
    _PAGES + """
SELECT base, page, (sum(n_books) OVER w)::BIGINT AS books_so_far, count(*) OVER w AS pages_done FROM p
WINDOW w AS (PARTITION BY base ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_totals_query(spark, sf_dir):
    """F2."""
    return running_totals(event_pages(spark, sf_dir)).select("base", "page", "books_so_far", "pages_done")


@query("take_pages", _TAKEN)
def take_pages_query(spark, sf_dir):
    """F3 without a limit."""
    return take_pages(event_pages(spark, sf_dir)).select("base", "page", "n_books")


@query("take_pages_limited", _TAKEN + "AND done < 10")
def take_pages_limited(spark, sf_dir):
    """At most ten pages per section."""
    return take_pages(event_pages(spark, sf_dir), max_pages=10).select("base", "page", "n_books")


@query(
    "failed_pages",
    """
SELECT event_id + 1 AS page_no, 'https://books.example/cat/' || user_id || '/?pg=' || event_id AS url, 'HTTP 503' AS error
FROM events WHERE event_type = 'error' AND event_id > 0
UNION ALL SELECT 1, 'https://books.example/cat/' || user_id || '/', 'HTTP 503' FROM events
WHERE event_type = 'error' AND event_id = 0""",
)
def failed_pages_query(spark, sf_dir):
    """E9."""
    base = _cat(HOST + "/cat/", F.col("base"), "/")
    pages = event_pages(spark, sf_dir).withColumns(
        {"url": listing_url(base, F.col("page")), "error": F.lit("HTTP 503")}
    )
    return failed_pages(pages)


_LINKS = """
WITH p AS (
  SELECT p_brand AS base, p_partkey AS page, p_type <> 'SMALL' AS ok, p_partkey, p_size, p_brand,
    (p_brand <> 'Brand#1')::INTEGER + (p_size > 10)::INTEGER AS n_books,
    CASE WHEN p_size > 20 THEN p_size + 41 END AS total_pages FROM part),
""" + _STOPS.rstrip() + """,
used AS (SELECT * FROM s WHERE good AND stopped = 0)
SELECT base, page, 0 AS block_no, 'https://books.example/detail/book' || p_partkey || '.html' AS detail_url
FROM used WHERE p_brand <> 'Brand#1'
UNION ALL SELECT base, page, CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE 1 END,
  'https://books.example/detail/book' || (p_partkey + 1) || '.html' FROM used WHERE p_size > 10"""


def _listing_job(spark, sf_dir, max_pages=None):
    """Brands are sections, parts of one type failed to load."""
    pages = listing_pages(spark, sf_dir).withColumn("base", F.col("p_brand")).withColumn("page", F.col("p_partkey"))
    pages = pages.withColumn("url", listing_url(_cat(HOST + "/cat/", F.col("base"), "/"), F.col("page")))
    wanted, stored = pages.select("base", "page", "url"), pages.where("p_type <> 'SMALL'").select("url", "html")
    return collect_links(wanted, stored, HOST, max_pages)


@query("collect_links", _LINKS)
def collect_links_query(spark, sf_dir):
    """The listing job."""
    return _listing_job(spark, sf_dir).links


# A crawl asks for pages until it has stopped or has enough of them.
_FAILED = _LINKS[: _LINKS.index("used AS")] + """
used AS (SELECT * FROM s WHERE NOT ok AND stopped = 0 AND done < {limit})
SELECT page + 1 AS page_no, 'https://books.example/cat/' || base || '/' || CASE WHEN page = 0 THEN '' ELSE '?pg=' || page END AS url,
  'page not stored' AS error FROM used"""


@query("listing_failures", _FAILED.format(limit=1_000_000_000))
def listing_failures(spark, sf_dir):
    """Failed pages that the crawl of their section came to."""
    return _listing_job(spark, sf_dir).failed


@query("listing_failures_limited", _FAILED.format(limit=3))
def listing_failures_limited(spark, sf_dir):
    """The same where a crawl ends with its third page with records."""
    return _listing_job(spark, sf_dir, max_pages=3).failed

"""Listing pages: pagers, record blocks, and which pages of a section to take."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.functions.regex import all_groups, first_group

# The markup of a listing page.
PAGER_SELECTED = r'<td class="selected"><a href="\?pg=(\d+)">(\d+)</a></td>'
PAGER_LAST = r'<a href="\?pg=(\d+)"><img[^>]+alt="[Нн]а последнюю страницу"'
PAGER_CELL = r'<td[^>]*><a href="\?pg=(\d+)">(\d+)</a></td>'
PAGER_IMAGE = r'<a href="\?pg=(\d+)"><img[^>]+alt="([^"]+)"'
LISTING_BLOCK = (
    r'<div style="border-bottom:1px solid #330066;padding:0\.35em 0em 0\.35em 0em;">'
    r'(.*?)<br clear="all" />\s*</div>'
)
LISTING_LINK = r'href="(/detail/book\d+\.html)"'
PAGER_WORDS = ("Страницы", "страниц")
CONTEXT_BEFORE = 200
CONTEXT_AFTER = 1000
CONTEXT_END = "</table>"
CONTEXT_HEAD = 500
CONTEXT_TAIL = 200

# Pages of one section that are summed in one window group.
PAGE_BLOCK = 100_000


def pagination_info(html: Column) -> Column:
    """Struct of current page, number of pages, last page's address and visible pages.

    Numbers are bigint; one beyond that is NULL, or left out of the visible pages.
    """
    current = first_group(html, PAGER_SELECTED)
    last = first_group(html, PAGER_LAST)
    pages = F.filter(F.transform(all_groups(html, PAGER_CELL), lambda p: p.try_cast("bigint")), lambda p: p.isNotNull())
    return F.struct(
        current.try_cast("bigint").alias("current_page"),
        F.try_add(last.try_cast("bigint"), F.lit(1).cast("bigint")).alias("total_pages"),
        F.concat(F.lit("?pg="), last).alias("last_page_url"),
        F.array_sort(F.array_distinct(pages)).alias("pages"),
    )


def visible_pages(pages: DataFrame, by: Sequence[str] = (), html: str = "html") -> DataFrame:
    """Distinct page numbers that the pagers of a section show, one row each."""
    found = pages.select(*by, F.explode(all_groups(F.col(html), PAGER_CELL)).alias("_page"))
    numbers = found.select(*by, F.col("_page").try_cast("bigint").alias("page"))
    return numbers.where(F.col("page").isNotNull()).distinct()


def _pairs(html: Column, pattern: str, first: str, second: str) -> Column:
    return F.zip_with(
        all_groups(html, pattern, 1),
        all_groups(html, pattern, 2),
        lambda a, b: F.struct(a.alias(first), b.alias(second)),
    )


def pagination_profile(html: Column) -> Column:
    """Raw texts of a pager: distinct cells sorted as text, navigation images, selected cell."""
    return F.struct(
        F.array_sort(F.array_distinct(_pairs(html, PAGER_CELL, "pg", "label"))).alias("cells"),
        _pairs(html, PAGER_IMAGE, "pg", "alt").alias("images"),
        first_group(html, PAGER_SELECTED, 1).alias("selected_pg"),
        first_group(html, PAGER_SELECTED, 2).alias("selected_label"),
    )


def keyword_context(html: Column, words: Sequence[str] = PAGER_WORDS) -> Column:
    """Surroundings of the first of ``words`` that occurs, cut at the next table end.

    Struct of the word and the first and last characters of the excerpt; NULL when no
    word occurs.
    """

    def first_of(rest: Sequence[str]) -> Column:
        if not rest:
            return F.lit(None).cast("struct<word:string,place:int>")
        return _once(
            F.instr(html, rest[0]),
            lambda at: F.when(at > 0, F.struct(F.lit(rest[0]).alias("word"), at.alias("place"))).otherwise(first_of(rest[1:])),
        )

    def around(found: Column) -> Column:
        # offsets below are 0-based, as ends of half-open ranges
        place = found["place"]
        start = F.greatest(F.lit(0), place - 1 - CONTEXT_BEFORE)
        end = F.least(F.length(html), place - 1 + CONTEXT_AFTER)
        cut = _once(
            F.struct(end.alias("end"), (F.position(F.lit(CONTEXT_END), html, place) - 1).alias("table_end")),
            lambda x: F.when((x["table_end"] > 0) & (x["table_end"] < x["end"]), x["table_end"] + len(CONTEXT_END)).otherwise(x["end"]),
        )
        excerpt = F.substring(html, (start + 1).cast("int"), (cut - start).cast("int"))
        return _once(
            excerpt,
            lambda text: F.struct(
                found["word"].alias("word"),
                F.substring(text, 1, CONTEXT_HEAD).alias("head"),
                F.right(text, F.lit(CONTEXT_TAIL)).alias("tail"),
            ),
        )

    return _once(first_of(words), lambda found: F.when(found.isNotNull(), around(found)))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used: looking for
    a word costs a pass over the page."""
    return F.transform(F.array(value), use)[0]


def has_keyword(html: Column, words: Sequence[str] = PAGER_WORDS) -> Column:
    """Whether :func:`keyword_context` gives a row: a filter on its result would be pushed below
    it, and make it twice."""
    found = F.lit(False)
    for w in words:
        found = found | F.contains(html, F.lit(w))
    return found


def block_links(html: Column, host: str) -> Column:
    """Detail addresses of the record blocks of a page; a block without one gives NULL."""
    return F.transform(
        all_groups(html, LISTING_BLOCK, 1, dotall=True),
        lambda b: F.concat(F.lit(host), first_group(b, LISTING_LINK)),
    )


def listing_blocks(pages: DataFrame, host: str, keep: Sequence[str] = (), html: str = "html") -> DataFrame:
    """One row per record block that has a detail link: ``(keep..., block_no, detail_url)``."""
    blocks = pages.select(*keep, F.posexplode(block_links(F.col(html), host)).alias("block_no", "detail_url"))
    return blocks.where(F.col("detail_url").isNotNull())


def _block(page: str, block: int) -> Column:
    return F.expr(f"`{page}` div {block}")


def join_section(
    rows: DataFrame, sections: DataFrame, base: str = "base", page: str = "page", block: int = PAGE_BLOCK
) -> DataFrame:
    """Inner join of pages with a one-row-per-section table, safe for a huge section.

    The section row is first handed to each block of page numbers the section has; rows
    then meet it by section and block, at most ``block`` rows per join key.
    """
    blocked = rows.withColumn("_block", _block(page, block))
    per_block = blocked.select(base, "_block").distinct().join(sections, base)
    return blocked.join(per_block, [base, "_block"]).drop("_block")


def running_sum(
    df: DataFrame,
    values: dict[str, Column],
    base: str = "base",
    page: str = "page",
    block: int = PAGE_BLOCK,
) -> DataFrame:
    """Sums of ``values`` over a section's pages up to and including each page.

    ``page`` is an integer, unique per section. A section of any length is cut into
    blocks of page numbers: blocks are summed first, and a row then needs only its own
    block and the sum of the blocks before.
    """
    blocked = df.withColumn("_block", _block(page, block)).withColumns(
        {f"_v_{name}": F.coalesce(value, F.lit(0)).cast("bigint") for name, value in values.items()}
    )
    earlier = W.partitionBy(base).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = (
        blocked.groupBy(base, "_block")
        .agg(*[F.sum(f"_v_{name}").alias(f"_s_{name}") for name in values])
        .select(
            base,
            "_block",
            *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in values],
        )
    )
    inside = W.partitionBy(base, "_block").orderBy(page).rowsBetween(W.unboundedPreceding, 0)
    return (
        blocked.withColumns({f"_i_{name}": F.sum(f"_v_{name}").over(inside) for name in values})
        .join(before, [base, "_block"])
        .withColumns({name: F.col(f"_b_{name}") + F.col(f"_i_{name}") for name in values})
        .drop("_block", *[f"_{t}_{name}" for name in values for t in "vib"])
    )


def running_totals(
    pages: DataFrame, base: str = "base", page: str = "page", n_books: str = "n_books"
) -> DataFrame:
    """Records and pages so far after each page: adds ``books_so_far`` and ``pages_done``."""
    return running_sum(pages, {"books_so_far": F.col(n_books), "pages_done": F.lit(1)}, base, page)


def _walked(pages: DataFrame, max_pages: int | None, base: str, page: str, n_books: str, total: str, ok: str) -> DataFrame:
    """``pages`` with ``_stop``: the page with which the crawl of its section has ended by the
    end of the row's block, or NULL.

    A segmented scan: pages are cut into blocks of page numbers, and a block turns the state
    of the crawl at its begin into that at its end. The state is what the first page with
    records showed as the total, and how many pages had records; such steps can be put together
    in any grouping. What decides is read once, narrow, and exchanged once, by section and
    block; a row per block goes on to the section, and to the pages.
    """
    # one reading of the narrow rows serves both uses below: nothing is left to infer for one of them
    narrow = pages.select(base, page, n_books, total, ok, _block(page, PAGE_BLOCK).alias("_block"))
    narrow = narrow.where(F.col(base).isNotNull() & F.col("_block").isNotNull()).repartition(base, "_block")
    good = F.col(ok) & (F.col(n_books) > 0)
    shows = F.when(good & (F.col(total) > 0), F.col(total).cast("bigint"))
    up_to = W.partitionBy(base, "_block").orderBy(page).rowsBetween(W.unboundedPreceding, 0)
    rows = narrow.withColumns(
        {"_total": F.first(shows, ignorenulls=True).over(up_to), "_done": F.sum(good.cast("bigint")).over(up_to)}
    )
    blocks = rows.groupBy(base, "_block").agg(F.max_by("_total", page).alias("_total"), F.max("_done").alias("_done"))
    before = W.partitionBy(base).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    states = blocks.select(
        base, "_block", F.first("_total", ignorenulls=True).over(before).alias("_total_before"),
        F.coalesce(F.sum("_done").over(before), F.lit(0)).alias("_done_before"),
    )
    shown = F.coalesce("_total_before", "_total")
    ends = F.col(ok) & (F.col(n_books) == 0)
    ends = ends | (good & F.coalesce(F.try_add(F.col(page).cast("bigint"), F.lit(1).cast("bigint")) >= shown, F.lit(False)))
    if max_pages is not None:
        ends = ends | (good & (F.col("_done_before") + F.col("_done") >= max_pages))
    firsts = rows.join(states, [base, "_block"]).groupBy(base, "_block").agg(F.min(F.when(ends, F.col(page))).alias("_end"))
    stops = firsts.select(base, "_block", F.min("_end").over(before.rowsBetween(W.unboundedPreceding, 0)).alias("_stop"))
    return pages.withColumn("_block", _block(page, PAGE_BLOCK)).join(stops, [base, "_block"]).select(*pages.columns, "_stop")


def take_pages(
    pages: DataFrame,
    max_pages: int | None = None,
    base: str = "base",
    page: str = "page",
    n_books: str = "n_books",
    total: str = "total_pages",
    ok: str = "ok",
) -> DataFrame:
    """The pages a crawl of each section would have used, in page order.

    It stops before the first loaded page without records, after the last page once the
    number of pages is known (the first page that shows it decides), and after
    ``max_pages`` pages with records. Pages that failed to load are passed over. ``page`` is
    unique per section.
    """
    if max_pages is not None and max_pages <= 0:
        return pages.where("false")
    walked = _walked(pages, max_pages, base, page, n_books, total, ok)
    in_time = F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))
    return walked.where(F.col(ok) & (F.col(n_books) > 0) & in_time).drop("_stop")


def tried_pages(
    pages: DataFrame,
    max_pages: int | None = None,
    base: str = "base",
    page: str = "page",
    n_books: str = "n_books",
    total: str = "total_pages",
    ok: str = "ok",
) -> DataFrame:
    """The pages a crawl of each section would have asked for, loaded or not.

    It ends with the page on which :func:`take_pages` stops: the blank page, the last one,
    or the one that makes ``max_pages`` pages with records.
    """
    if max_pages is not None and max_pages <= 0:
        return pages.where("false")
    walked = _walked(pages, max_pages, base, page, n_books, total, ok)
    return walked.where(F.col("_stop").isNull() | (F.col(page) <= F.col("_stop"))).drop("_stop")


def failed_pages(
    pages: DataFrame, ok: str = "ok", page: str = "page", url: str = "url", error: str = "error"
) -> DataFrame:
    """Pages that failed to load, numbered from 1, with address and reason."""
    return pages.where(~F.col(ok)).select(
        (F.col(page) + 1).alias("page_no"), F.col(url).alias("url"), F.col(error).alias("error")
    )

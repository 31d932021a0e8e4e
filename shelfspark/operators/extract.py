"""Detail pages to typed records by a declarative rule table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.regex import all_groups, first_group, first_match, group_in, group_of, needs_context
from shelfspark.functions.text import decode_entities, is_blank, strip_tags, ws_trim
from shelfspark.functions.urls import extract_id


def _as_int(text: Column) -> Column:
    return text.try_cast("int")


@dataclass(frozen=True)
class FieldRule:
    """One pattern and the fields its groups fill.

    The page is scanned once per rule; groups are then taken from the matched text.
    """

    pattern: str
    # field name -> (group, functions applied in order)
    fields: dict[str, tuple[int, Sequence[Callable[[Column], Column]]]]
    dotall: bool = False


def rule(name: str, pattern: str, *post: Callable[[Column], Column], dotall: bool = False) -> FieldRule:
    """A rule with one group filling one field."""
    return FieldRule(pattern, {name: (1, post or (ws_trim,))}, dotall)


# The markup of a detail page.
DETAIL_RULES = (
    FieldRule(
        r"<title>\[(.*?)\]\s*(.*?)</title>",
        {"title_from_title": (1, (ws_trim,)), "author_from_title": (2, (ws_trim,))},
        dotall=True,
    ),
    rule("meta_description", r'<meta name="description" content="(.*?)"', dotall=True),
    FieldRule(
        r'<h3 class="nomargin"><a\s+href="/\?cat_author=([^"]+)&amp;author_key=(\d+)"[^>]*>(.*?)</a></h3>',
        {"author": (3, (ws_trim,)), "author_key": (2, ()), "_author_query": (1, ())},
    ),
    rule("title", r'<h1 class="nomargin">(.*?)</h1>', dotall=True),
    rule("series", r'<h3 class="nomargin">Серия:\s*(.*?)</h3>', dotall=True),
    rule("publisher", r"<tr><td>Издательство:\s*(.*?)</td></tr>", dotall=True),
    FieldRule(
        r'<a href="/qna/ref/binding/">Переплет</a>:\s*(.*?);\s*(\d+)\s+страниц;\s*(\d{4})\s*г\.',
        {"binding": (1, (ws_trim,)), "pages": (2, (_as_int,)), "year": (3, (_as_int,))},
    ),
    rule("isbn", r'<a href="/qna/ref/isbn/">ISBN</a>:\s*([^<;]+)'),
    rule("format", r'<a href="/qna/ref/format/">Формат</a>:\s*([^<;]+)'),
    rule("language", r"<tr><td>Язык:\s*(.*?)</td></tr>", strip_tags, ws_trim, dotall=True),
    rule("date_added", r'<small class="ltgray">На сайте с\s+(.*?)</small>'),
    FieldRule(r'<img\s+src="/chart/cnt\.php\?id=(\d+)&amp;c=1"', {"view_counter_id": (1, ())}),
    rule(
        "annotation", r"<h3>Аннотация</h3>\s*<p>(.*?)</p>", strip_tags, decode_entities, ws_trim,
        dotall=True,
    ),
    FieldRule(r'<a href="\.(/book\d+\.html)"\s+title="предыдущая книга', {"_prev": (1, ())}),
    FieldRule(r'<a href="\.(/book\d+\.html)"\s+title="следующая книга', {"_next": (1, ())}),
)
BREADCRUMB = r"<b>Каталог:</b>\s*(.*?)(?:</p>|<br)"
BREADCRUMB_LINK = r'<a href="([^"]+)">([^<]+)</a>'
IMAGE_PAIR = r'<a href="(/img/x/[^"]+)"><img\s+src="([^"]+)"'
IMAGE_DEFAULT = r'<img\s+src="(/img/defcover\.jpg)"'
IMAGE_SMALL = r'<img\s+src="(/img/[^"]+)"\s+width="60"'
OUT_OF_STOCK = "сейчас этого издания книги в продаже нет"
STOCK_NO = "нет"
STOCK_TABLE = (
    r"<table[^>]*>\s*<tr><td[^>]*>\s*(.*?)\s*</td></tr>\s*</table>\s*<table[^>]*>\s*<tr><td[^>]*>"
)
STOCK_CHARS = 100
STOCK_TEXT_YES = "в продаже"
STOCK_TEXT_NO = "нет в продаже"
MARKUP_SIGNS = ("<html", "<title", "nomargin", "<body")
BLOCKED_SIGN = "Try harder"
SNIPPET_CHARS = 120
SIGNIFICANT = ("title", "author", "isbn", "publisher")

# The fields of a record, in order.
RECORD_COLUMNS = (
    "detail_url", "book_id", "title_from_title", "author_from_title", "meta_description",
    "category_path", "category_urls", "category", "category_url",
    "author", "author_key", "author_search_url", "title", "series", "publisher",
    "binding", "pages", "year", "isbn", "format", "language", "date_added",
    "image_large_url", "image_thumb_url", "has_image", "view_counter_id", "annotation",
    "in_stock", "in_stock_text", "prev_book_url", "next_book_url",
)


def apply_rules(
    df: DataFrame,
    rules: Sequence[FieldRule],
    html: str = "html",
    more: dict[str, Column] | None = None,
) -> DataFrame:
    """Add one column per rule field; NULL where the rule does not match.

    Matches are projected first, together with ``more``: each is referenced by all
    fields of its rule, and nothing else reads the page. Rules whose match depends on the
    text around it have their groups taken from the page, which costs a scan per group.
    """
    around = [needs_context(r.pattern) for r in rules]
    matches = {
        f"_m{i}": first_match(F.col(html), r.pattern, r.dotall)
        for i, (r, apart) in enumerate(zip(rules, around, strict=True))
        if not apart
    }
    out = df.withColumns({**matches, **(more or {})})
    fields = {}
    for i, r in enumerate(rules):
        for name, (group, post) in r.fields.items():
            if around[i]:
                value = group_in(F.col(html), r.pattern, group, r.dotall)
            else:
                value = group_of(F.col(f"_m{i}"), r.pattern, group, r.dotall)
            for step in post:
                value = step(value)
            fields[name] = value
    return out.withColumns(fields).drop(*matches)


def page_matches(html: Column) -> dict[str, Column]:
    """Texts the composite fields are made of; each costs one scan of the page."""
    return {
        "_crumbs": first_group(html, BREADCRUMB, 1, dotall=True),
        "_pair": first_match(html, IMAGE_PAIR),
        "_default": first_group(html, IMAGE_DEFAULT),
        "_small": first_group(html, IMAGE_SMALL),
        "_sold_out": F.contains(html, F.lit(OUT_OF_STOCK)),
        "_cell": first_group(html, STOCK_TABLE, 1, dotall=True),
    }


def breadcrumb(fragment: Column, host: str) -> dict[str, Column]:
    """Path, addresses, last name and last address of the catalogue links.

    A fragment without links still gives an empty path and an empty array.
    """
    urls = all_groups(fragment, BREADCRUMB_LINK, 1)
    names = all_groups(fragment, BREADCRUMB_LINK, 2)
    return {
        "category_path": F.array_join(names, " > "),
        "category_urls": urls,
        "category": F.try_element_at(names, F.lit(-1)),
        "category_url": F.concat(F.lit(host), F.try_element_at(urls, F.lit(-1))),
    }


def image_cascade(pair: Column, default: Column, small: Column, host: str) -> dict[str, Column]:
    """Large and small image; else the default cover; else any small image."""
    thumb = F.when(pair.isNotNull(), group_of(pair, IMAGE_PAIR, 2)).otherwise(F.coalesce(default, small))
    return {
        "image_large_url": F.concat(F.lit(host), group_of(pair, IMAGE_PAIR, 1)),
        "image_thumb_url": F.concat(F.lit(host), thumb),
        "has_image": pair.isNotNull() | (default.isNull() & small.isNotNull()),
    }


def in_stock(sold_out: Column, cell: Column) -> Column:
    """False for the fixed phrase; else decided by the first of two adjoining tables; else False."""
    said_no = F.contains(F.substring(F.lower(cell), 1, STOCK_CHARS), F.lit(STOCK_NO))
    return (
        F.when(sold_out, F.lit(False)).when(cell.isNotNull(), ~said_no).otherwise(F.lit(False))
    )


def stock_text(available: Column) -> Column:
    return F.when(available, F.lit(STOCK_TEXT_YES)).otherwise(F.lit(STOCK_TEXT_NO))


def neighbour_url(path: Column, host: str) -> Column:
    return F.concat(F.lit(host + "/detail"), path)


def significant(df: DataFrame) -> DataFrame:
    """Records with at least one identifying field *present*, if only as an empty text."""
    return df.where(F.coalesce(*SIGNIFICANT).isNotNull())


def significant_column() -> Column:
    return F.coalesce(*[F.col(c) for c in SIGNIFICANT]).isNotNull()


def parse_detail_page(
    pages: DataFrame, host: str, url: str = "url", html: str = "html", keep: Sequence[str] = ()
) -> DataFrame:
    """All record fields of every page, plus ``n_fields``; ``keep`` passes input columns on.

    ``n_fields`` counts present fields; the identifier counts even when the address has none.
    """
    out = apply_rules(pages, DETAIL_RULES, html, page_matches(F.col(html)))
    out = out.withColumns(
        {
            **breadcrumb(F.col("_crumbs"), host),
            **image_cascade(F.col("_pair"), F.col("_default"), F.col("_small"), host),
            "in_stock": F.coalesce(in_stock(F.col("_sold_out"), F.col("_cell")), F.lit(False)),
        }
    ).withColumns(
        {
            "detail_url": F.col(url),
            "book_id": extract_id(F.col(url)),
            "in_stock_text": stock_text(F.col("in_stock")),
            "author_search_url": F.concat(
                F.lit("/?cat_author="), F.col("_author_query"), F.lit("&author_key="), F.col("author_key")
            ),
            "prev_book_url": neighbour_url(F.col("_prev"), host),
            "next_book_url": neighbour_url(F.col("_next"), host),
        }
    )
    present = F.lit(0)
    for name in RECORD_COLUMNS:
        present = present + (F.lit(1) if name == "book_id" else F.col(name).isNotNull().cast("int"))
    return out.select(*keep, *RECORD_COLUMNS, present.alias("n_fields"))


def classify_page(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``status`` and ``error`` of a fetched page, before any field is extracted.

    ``blocked`` (the site's refusal), ``empty``, ``no_markup`` (with the start of the
    text) or ``ok``.
    """
    text, status = F.col(html), F.col("status")
    blank = text.isNull() | is_blank(text)
    marked = F.lit(False)
    for sign in MARKUP_SIGNS:
        marked = marked | F.contains(text, F.lit(sign))
    snippet = ws_trim(F.translate(F.substring(text, 1, SNIPPET_CHARS), "\n\r", "  "))
    return pages.withColumn(
        "status",
        # no sign is blank, so a blank page need not be searched for any
        F.when(blank, "empty")
        .when(F.contains(text, F.lit(BLOCKED_SIGN)), "blocked")
        .when(marked, "ok")
        .otherwise("no_markup"),
    ).withColumn(
        "error",
        F.when(status == "blocked", F.lit("HTTP 403"))
        .when(status == "empty", F.lit("empty response"))
        .when(status == "no_markup", F.concat(F.lit("no markup: "), snippet)),
    )


def extract_records(
    pages: DataFrame, host: str, url: str = "url", html: str = "html", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per page: record fields with ``status`` and ``error``; status ``unparsed``
    marks a page whose identifying fields are all missing."""
    classified = classify_page(pages, html)
    usable = F.when(F.col("status") == "ok", F.col(html))
    parsed = parse_detail_page(
        classified.withColumn(html, usable), host, url, html, (*keep, "status", "error")
    )
    unparsed = (F.col("status") == "ok") & ~significant_column()
    return parsed.withColumns(
        {
            "status": F.when(unparsed, "unparsed").otherwise(F.col("status")),
            "error": F.when(unparsed, "no identifying field found").otherwise(F.col("error")),
        }
    )

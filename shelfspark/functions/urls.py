"""URL helpers. The site's host is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.regex import first_group


def absolute_url(url: Column, host: str) -> Column:
    """Prefix ``host`` unless the URL already starts with ``http``; one slash between."""
    return (
        F.when(F.startswith(url, F.lit("http")), url)
        .when(F.startswith(url, F.lit("/")), F.concat(F.lit(host), url))
        .otherwise(F.concat(F.lit(host + "/"), url))
    )


def extract_id(url: Column) -> Column:
    """Digits of a ``/book<digits>.html`` address, NULL without one."""
    return first_group(url, r"/book(\d+)\.html")


def listing_url(base: Column, page: Column) -> Column:
    """Address of a listing page; page 0 is the bare base address."""
    return F.when(page == 0, base).otherwise(F.concat(base, F.lit("?pg="), page.cast("string")))

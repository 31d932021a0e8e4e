"""Listing: stored listing pages to the list of detail addresses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators.paging import block_links, failed_pages, pagination_info, take_pages, tried_pages
from shelfspark.session import staged, unstage
from shelfspark.sources.sinks import write_url_list
from shelfspark.sources.text_lists import expand_page_range, page_list_urls, page_urls


@dataclass(frozen=True)
class ListingResult:
    """``pages`` are those used, ``links`` their detail addresses in order, ``failed`` the rest."""

    pages: DataFrame
    links: DataFrame
    failed: DataFrame
    loaded: DataFrame | None = None

    def release(self) -> None:
        """Remove what was staged; no table of this job can be read afterwards."""
        if self.loaded is not None:
            unstage(self.loaded)


def collect_links(
    wanted: DataFrame, stored: DataFrame, host: str, max_pages: int | None = None, stage: bool = True
) -> ListingResult:
    """``wanted`` is ``(base, page, url)``, ``stored`` ``(url, html)`` with one page per URL.

    A wanted page that is not stored failed to load, and is reported if the crawl of its
    section would have come to it. Blocks without a detail link do not
    count as records. With ``stage`` what was found on the pages is written once to the
    shared folder, since several steps need it.
    """
    links = F.filter(block_links(F.col("html"), host), lambda u: u.isNotNull())
    # by sorting, as Spark reckons pages by their column's type, and would hold all of them in every task
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = stored.select("url", "html").repartition(parts, "url").hint("merge")
    loaded = (
        wanted.repartition(parts, "url").join(pages, "url", "left")
        .withColumn("ok", F.col("html").isNotNull())
        .withColumn("links", links)
        .withColumn("total_pages", pagination_info(F.col("html"))["total_pages"])
        .select(
            "base", "page", "url", "ok", "total_pages",
            F.coalesce(F.size("links"), F.lit(0)).alias("n_books"),
            "links",
            F.when(~F.col("ok"), F.lit("page not stored")).alias("error"),
        )
    )
    if stage:
        loaded = staged(loaded, "listing-pages")
    used = take_pages(loaded, max_pages)
    rows = used.select("base", "page", F.posexplode("links").alias("block_no", "detail_url"))
    failed = failed_pages(tried_pages(loaded.drop("links"), max_pages))
    return ListingResult(used.drop("links"), rows, failed, loaded if stage else None)


def wanted_pages(
    sections: DataFrame, start_page: int = 0, end: str = "end_page", spec: str | None = None
) -> DataFrame:
    """Pages to look at, ``(base, page, url)``: up to column ``end``, or by the page
    expressions in column ``spec``, for which ``end`` is what ``all`` means."""
    if spec is None:
        pages = page_urls(sections.select("base", end), F.lit(start_page), F.col(end))
    else:
        pages = page_list_urls(expand_page_range(sections, spec, F.col(end), by=("base",)))
    return pages.select("base", "page", "url")


def listing_files(
    spark: SparkSession,
    wanted: DataFrame,
    stored: DataFrame,
    output: str,
    host: str,
    max_pages: int | None = None,
) -> DataFrame:
    """Run the job and write the address list and the failed pages into ``output``."""
    job = collect_links(wanted, stored, host, max_pages)
    write_url_list(job.links.orderBy("base", "page", "block_no"), f"{output}/urls")
    job.failed.write.json(f"{output}/failed")
    job.release()
    return spark.read.text(f"{output}/urls").withColumnRenamed("value", "detail_url")

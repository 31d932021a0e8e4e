"""Detail extraction: URL list and stored pages to records, resuming an earlier run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.operators.dedup import dedup_richest
from shelfspark.operators.extract import RECORD_COLUMNS, extract_records
from shelfspark.operators.membership import merge_existing_new, url_plan
from shelfspark.operators.metrics import run_metrics
from shelfspark.session import staged, unstage
from shelfspark.sources.checkpoint import scan_checkpoint
from shelfspark.sources.sinks import failed_urls, write_failed_urls, write_results_with_meta
from shelfspark.sources.text_lists import scan_url_list
from shelfspark.sources.versions import VersionedOutput

# Records of all runs are ordered by the run that found them, then by input line.
_KINDS = {"category_urls": "array<string>", "pages": "int", "year": "int", "has_image": "boolean", "in_stock": "boolean"}
BOOK_SCHEMA = ", ".join(
    ["run int", "pos bigint", *(f"{c} {_KINDS.get(c, 'string')}" for c in RECORD_COLUMNS), "n_fields int"]
)
_COLUMNS = ("run", "pos", *RECORD_COLUMNS, "n_fields")


@dataclass(frozen=True)
class DetailResult:
    """``results`` has one row per URL tried, ``books`` the records old and new."""

    plan: DataFrame
    results: DataFrame
    books: DataFrame
    metrics: DataFrame
    staged: bool = False

    def release(self) -> None:
        """Remove the staged results; no table of this job can be read afterwards."""
        if self.staged:
            unstage(self.results)


def extract_details(
    urls: DataFrame,
    pages: DataFrame,
    existing: DataFrame,
    host: str,
    run: int = 1,
    stage: bool = True,
) -> DetailResult:
    """Extract the pages of URLs that have no record yet and join old and new records.

    ``urls`` is ``(line_no, url)``; an address's place is its least ``line_no``, also where
    several lists are read as one. ``pages`` is ``(url, html)`` with one page per URL, ``existing`` has ``BOOK_SCHEMA`` with runs below ``run``. The URL
    filter runs before any page is looked at. A URL without a stored page failed to load.
    """
    plan = url_plan(urls, existing.select(F.col("detail_url").alias("url")))
    todo = plan.where(~F.col("is_processed")).select("url", "line_no")
    # Spark reckons a page by its column's type, not its length, and would send all pages to every
    # executor through the driver; and tasks are as many for short pages that compress well
    parts = int(todo.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = pages.select("url", "html").repartition(parts, "url").hint("merge")
    found = todo.repartition(parts, "url").join(stored, "url", "left")
    results = extract_records(found, host, keep=("line_no", "url"))
    if stage:
        results = staged(results, "detail-results")
    good = results.where(F.col("status") == "ok").withColumnRenamed("line_no", "pos")
    # addresses in the plan are distinct and new, and a record's address is the one it was asked for by
    new = good.withColumn("run", F.lit(run))
    return DetailResult(plan, results, final_books(existing, new), run_metrics(plan, results, existing), stage)


def final_books(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new records, per address the one with most fields, the older on a tie.

    The order columns of a record are where its address first occurred.
    """
    both = merge_existing_new(existing.select(*_COLUMNS), new.select(*_COLUMNS)).drop("gen")
    keyed = both.withColumn("record_key", F.coalesce("detail_url", "book_id"))
    best = dedup_richest(keyed, order=("run", "pos"))
    return best.select(
        F.col("first_seen.run").alias("run"),
        F.col("first_seen.pos").alias("pos"),
        *RECORD_COLUMNS,
        "n_fields",
    )


def detail_version(
    spark: SparkSession, url_list: str, pages: DataFrame, output: VersionedOutput, host: str, run: int = 1,
    start_line: int | None = None, end_line: int | None = None,
) -> int:
    """Run the job on a URL list file, going on from the latest version of ``output``; returns
    the version made.

    Records, run statistics and failed addresses appear together, and the version before stays
    readable. Earlier records that are damaged count as absent: their addresses are processed
    again and the version says why. With no URL left to do no version is made.
    """
    earlier = output.load("books", BOOK_SCHEMA)
    urls = scan_url_list(spark, url_list, host, start_line, end_line).select("line_no", "url")
    job = extract_details(urls, pages, earlier.rows, host, run)
    try:
        if job.results.isEmpty():
            return output.latest()
        tables = {"books": job.books, "failed": failed_urls(job.results), "metrics": job.metrics}
        return output.publish({n: [output.write(df)] for n, df in tables.items()}, notes={"earlier_records": earlier.reason})
    finally:
        job.release()


def detail_files(
    spark: SparkSession,
    url_list: str,
    pages: DataFrame,
    output: str,
    host: str,
    resume_from: str | None = None,
    run: int = 1,
    start_line: int | None = None,
    end_line: int | None = None,
) -> DataFrame:
    """Run the job on a URL list file; returns the records old and new.

    Into the new folder ``output`` go the results with run statistics and the failed
    addresses. ``resume_from`` is the output of an earlier run. With no URL left to do
    nothing is written and the earlier records are returned as they are.
    """
    if resume_from is None:
        existing = spark.createDataFrame([], BOOK_SCHEMA)
    else:
        existing = scan_checkpoint(spark, f"{resume_from}/books", BOOK_SCHEMA)
    urls = scan_url_list(spark, url_list, host, start_line, end_line).select("line_no", "url")
    job = extract_details(urls, pages, existing, host, run)
    try:
        if job.results.isEmpty():
            return existing
        write_results_with_meta(job.books, job.metrics, output)
        write_failed_urls(job.results, f"{output}/failed")
    finally:
        job.release()
    return spark.read.schema(BOOK_SCHEMA).parquet(f"{output}/books")

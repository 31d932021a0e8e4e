"""Line-oriented text: URL lists and page numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.functions.text import ws_trim
from shelfspark.functions.urls import absolute_url, listing_url
from shelfspark.session import staged, unstage
from shelfspark.sources.files import plain_path

# Pages put into one array before it is exploded.
PAGE_BLOCK = 1000


def numbered_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Lines with their 1-based number in the file: ``(file, line_no, value)``.

    Files stay splittable. Rows of one split come in file order, so a line's number is
    its place in the split plus the number of lines in the splits before; only that
    small per-split table goes through a window. Whether it is broadcast is Spark's choice
    by its size. Lines are scanned twice; their running ids agree, as both scans pack the
    same files into tasks by the same settings.
    """
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    blocks = (
        lines.groupBy("uri", "block")
        .agg(F.min("row_id").alias("first_id"), F.count("*").alias("n"))
        .select(
            "uri",
            "block",
            "first_id",
            F.coalesce(
                F.sum("n").over(
                    W.partitionBy("uri").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("before"),
        )
    )
    return lines.join(blocks, ["uri", "block"]).select(
        plain_path(F.col("uri")).alias("file"),
        (F.col("before") + F.col("row_id") - F.col("first_id") + 1).alias("line_no"),
        "value",
    )


def index_lines(spark: SparkSession, paths: Sequence[str] | str, folder: str, group_bytes: int = 1 << 20) -> None:
    """Number the lines of files once, into ``folder``, for :func:`indexed_lines`.

    The files are read once; numbers come from the rows' places in their splits and the few
    sums of splits, taken from what was read. Rows are kept in the order of their numbers in
    groups of about ``group_bytes``, each of which knows its least and largest number, so a
    range of lines is read from the groups that have some of it.
    """
    told = staged(
        spark.read.text(list(paths) if not isinstance(paths, str) else paths).select(
            F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row_id"), "value",
        ),
        "lines",
    )
    before = W.partitionBy("uri").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = told.groupBy("uri", "block").agg(F.min("row_id").alias("first_id"), F.count("*").alias("n"))
    blocks = blocks.select("uri", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = told.join(blocks, ["uri", "block"]).select(
        plain_path(F.col("uri")).alias("file"), (F.col("before") + F.col("row_id") - F.col("first_id") + 1).alias("line_no"), "value"
    )
    ordered = numbered.repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no")
    ordered.write.option("parquet.block.size", group_bytes).option("parquet.page.size", min(group_bytes, 1 << 16)).parquet(folder)
    unstage(told)


def indexed_lines(spark: SparkSession, folder: str, start_line: int | None = None, end_line: int | None = None) -> DataFrame:
    """``(file, line_no, value)`` of lines that :func:`index_lines` has numbered, the range inclusive.

    Row groups without a line of the range aren't read.
    """
    lines = spark.read.schema("file string, line_no bigint, value string").parquet(folder)
    if start_line is not None:
        lines = lines.where(F.col("line_no") >= start_line)
    return lines if end_line is None else lines.where(F.col("line_no") <= end_line)


def urls_from_lines(
    lines: DataFrame,
    host: str,
    start_line: int | None = None,
    end_line: int | None = None,
    value: str = "value",
) -> DataFrame:
    """URLs of a numbered text; blank and ``#`` lines count in the numbering but give none."""
    if start_line is not None:
        lines = lines.where(F.col("line_no") >= start_line)
    if end_line is not None:
        lines = lines.where(F.col("line_no") <= end_line)
    url = ws_trim(F.col(value))
    return lines.where((url != "") & ~url.startswith("#")).withColumn("url", absolute_url(url, host)).drop(value)


def scan_url_list(
    spark: SparkSession,
    path: Sequence[str] | str,
    host: str,
    start_line: int | None = None,
    end_line: int | None = None,
) -> DataFrame:
    """URL list file as ``(file, line_no, url)``; the line range is inclusive."""
    return urls_from_lines(numbered_lines(spark, path), host, start_line, end_line)


def explode_range(df: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """One row per integer in ``[low, high)``, through blocks of bounded size.

    However long a range is, no row holds more than ``PAGE_BLOCK`` of its numbers, and
    its blocks are spread over the tasks.
    """
    bounds = df.withColumns({"_low": low.cast("bigint"), "_high": high.cast("bigint")})
    starts = F.sequence("_low", F.col("_high") - 1, F.lit(PAGE_BLOCK).cast("bigint"))
    blocks = bounds.withColumn("_block", F.explode(F.when(F.col("_low") < F.col("_high"), starts)))
    # a block is one row for up to PAGE_BLOCK pages, so spreading blocks is cheap
    blocks = blocks.hint("rebalance")
    last = F.least(F.col("_block") + PAGE_BLOCK, F.col("_high")) - 1
    return blocks.withColumn(name, F.explode(F.sequence("_block", last))).drop("_low", "_high", "_block")


def page_urls(
    bases: DataFrame, start: Column, end: Column, base: str = "base"
) -> DataFrame:
    """Listing addresses of pages ``[start, end)`` of each base: adds ``page`` and ``url``."""
    pages = explode_range(bases, start, end, "page")
    return pages.withColumn("url", listing_url(F.col(base), F.col("page")))


def page_list_urls(pages: DataFrame, base: str = "base", page: str = "page") -> DataFrame:
    """The same for an explicit list of pages."""
    return pages.withColumn("url", listing_url(F.col(base), F.col(page)))


def expand_page_range(
    specs: DataFrame,
    spec: str = "spec",
    total: Column | None = None,
    by: Sequence[str] = ("spec",),
) -> DataFrame:
    """Page expressions such as ``1-3,5,7-10`` to distinct 0-based pages, one row each.

    ``all`` and the empty text mean all of ``total`` pages. A number below 1, a reversed
    range, anything that is no number, and ``all`` without a total raise.
    """
    text = F.coalesce(F.col(spec), F.lit(""))
    total = F.lit(None).cast("bigint") if total is None else total.cast("bigint")
    wants_all = (text == "") | (F.lower(text) == "all")
    whole = F.array(F.lit(None).cast("string"))
    # equal specs give equal pages, so a spec repeated in a third of the rows is expanded once
    specs = specs.select(*by, text.alias(spec), total.alias("_total")).distinct() if spec not in by else (
        specs.select(*by, total.alias("_total")).distinct()
    )
    total = F.col("_total")
    parts = specs.withColumn("_part", F.explode(F.when(wants_all, whole).otherwise(F.split(text, ","))))
    parts = parts.withColumn("_part", ws_trim(F.col("_part")))
    part, dash = F.col("_part"), F.col("_dash")
    parts = parts.withColumn("_dash", F.instr(part, "-"))

    def number(value: Column) -> Column:
        value = ws_trim(value)
        return F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("bigint"))

    def fail(what: str) -> Column:
        return F.raise_error(F.concat(F.lit(what + ": "), F.coalesce(part, F.lit("")))).cast("bigint")

    # the place of the dash is projected before, the numbers here, the checks after
    parts = parts.withColumns(
        {
            "_lo": number(F.when(dash > 0, F.substring(part, F.lit(1), dash - 1)).otherwise(part)),
            "_hi": number(F.when(dash > 0, F.substring(part, dash + 1, F.length(part))).otherwise(part)),
        }
    )
    lo, hi = F.col("_lo"), F.col("_hi")
    checked = (
        F.when(lo.isNull() | hi.isNull(), fail("not a page number"))
        .when((lo < 1) | (hi < 1), fail("page numbers start at 1"))
        .when(lo > hi, fail("reversed range"))
        .otherwise(lo - 1)
    )
    known = F.coalesce(total, fail("all needs a total"))
    ranged = parts.withColumns(
        {
            "_from": F.when(part.isNull(), F.lit(0).cast("bigint")).otherwise(checked),
            "_to": F.when(part.isNull(), known).otherwise(hi),
        }
    )
    return explode_range(ranged, F.col("_from"), F.col("_to"), "page").select(*by, "page").distinct()

"""Outputs. Every run writes a new folder; no sink overwrites what a job reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WRITE_MODES = {"w": "overwrite", "a": "append"}
PREVIEW_ROWS = 50


def write_json_lines(items: DataFrame, path: str, ordered: bool = False, raw: str = "raw") -> None:
    """Items as JSON Lines, many files, splittable when read again.

    ``ordered`` range-partitions by file and position, so that part files follow the
    order of the input.
    """
    if ordered:
        items = items.orderBy("file_rank", "pos")
    items.select(raw).write.text(path)


def document_lines(items: DataFrame, envelopes: DataFrame, raw: str = "raw", single: bool = False) -> DataFrame:
    """Items and envelopes as lines ``(file, rank, seq, line)`` which, joined in order, form
    one JSON document per file.

    ``envelopes`` has ``file``, ``head`` and ``tail``. The comma goes in front of every
    item but the first of its document. Nothing is collected: a document with most of the
    items spreads over many partitions. ``single`` says that all items are of one document,
    so that the one row with its first place is sent to them.
    """
    place = ["file", "file_rank", "pos"]
    first = items.groupBy("file").agg(F.min(F.struct("file_rank", "pos")).alias("first"))
    marks = first.select("file", "first.*", F.lit(True).alias("_first"))
    if single:
        marks = marks.hint("broadcast")
    comma = F.when(F.col("_first"), F.lit("")).otherwise(F.lit(","))
    body = items.join(marks, place, "left").select(
        "file",
        F.col("file_rank").alias("rank"),
        F.col("pos").cast("bigint").alias("seq"),
        F.concat(comma, F.col(raw)).alias("line"),
    )

    def edge(rank: str, text: str) -> DataFrame:
        return envelopes.select(
            "file", F.lit(rank).alias("rank"), F.lit(0).cast("bigint").alias("seq"), F.col(text).alias("line")
        )

    # ranks start with a digit: the empty text sorts before them, the last character after
    return edge("", "head").union(body).union(edge("\U0010ffff", "tail"))


def write_documents(lines: DataFrame, path: str) -> None:
    """One folder ``source_file=...`` per document; its part files in name order are the text."""
    order = ("source_file", "rank", "seq")
    (
        lines.withColumnRenamed("file", "source_file")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("source_file", "line")
        .write.partitionBy("source_file")
        .text(path)
    )


def write_json_array(items: DataFrame, path: str, name: str = "merged") -> None:
    """All items in input order as one JSON array, spread over part files."""
    spark = items.sparkSession
    envelope = spark.createDataFrame([(name, "[", "]")], "file string, head string, tail string")
    write_documents(document_lines(items.withColumn("file", F.lit(name)), envelope, single=True), path)


def write_duplicates_report(report: DataFrame, dedup_key: str, path: str) -> None:
    """Removed records under ``duplicates``, their number and the key under ``summary``."""
    counted = Observation("duplicates_report")
    observed = report.observe(counted, F.count(F.lit(1)).alias("total"))
    observed.write.option("ignoreNullFields", "false").json(f"{path}/duplicates")
    summary = report.sparkSession.createDataFrame(
        [(dedup_key, counted.get["total"])], "dedup_key string, total bigint"
    )
    summary.write.json(f"{path}/summary")


def write_results_with_meta(
    books: DataFrame, stats: DataFrame, path: str, is_checkpoint: bool = False
) -> None:
    """Records under ``books``; totals, time and run statistics under ``meta``."""
    counted = Observation("results")
    books.observe(counted, F.count(F.lit(1)).alias("total_books")).write.parquet(f"{path}/books")
    meta = stats.select(
        F.lit(counted.get["total_books"]).alias("total_books"),
        F.current_timestamp().alias("saved_at"),
        *([F.lit(True).alias("is_checkpoint")] if is_checkpoint else []),
        *stats.columns,
    )
    meta.write.json(f"{path}/meta")


def write_url_list(records: DataFrame, path: str, mode: str = "w", url: str = "detail_url") -> None:
    """Non-empty addresses, one per line; mode ``w`` or ``a``."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be 'w' or 'a', not {mode!r}")
    records.where(F.col(url) != "").select(url).write.mode(WRITE_MODES[mode]).text(path)


def failed_urls(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != "ok").select("url", "status", "error")


def write_failed_urls(results: DataFrame, path: str) -> None:
    """Addresses without a record under ``urls``, with their errors under ``errors``."""
    failed = failed_urls(results)
    failed.select("url").write.text(f"{path}/urls")
    failed.write.json(f"{path}/errors")


def preview(records: DataFrame, order: Column | str, n: int = PREVIEW_ROWS, **labels: str) -> DataFrame:
    """The first ``n`` records in order; ``labels`` are shown where a field is missing."""
    shown = records.orderBy(order).limit(n)
    for name, label in labels.items():
        shown = shown.withColumn(name, F.coalesce(F.col(name), F.lit(label)))
    return shown

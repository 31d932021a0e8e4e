"""Resumable extraction as a stream: addresses arrive, pages are stored elsewhere.

Every micro-batch is one version of the output: the records so far, the addresses without a
record with how often they were tried, and what was counted, visible together. A batch that
runs again after a failure finds that its version exists and does nothing.

An address is tried when it first arrives, and again once in every later run until it has a
record or was tried ``max_attempts`` times. Addresses without a record are a small table that
is written anew with each batch; records are only added, and merged when their folders have
grown in number.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfspark.operators.dedup import dedup_richest
from shelfspark.operators.extract import RECORD_COLUMNS, extract_records
from shelfspark.session import staged, unstage
from shelfspark.sources.versions import NoTable, VersionedOutput
from shelfspark.streaming.incremental import run_available, run_id

MAX_ATTEMPTS = 5
MERGE_FOLDERS = 16
OPEN = "url string, line_no bigint, attempts int, status string, error string, last_run string"
_COUNTS = ("total_input_urls", "skipped_existing", "processed_new", "failed_tries")


def _table(output: VersionedOutput, name: str, schema: str) -> DataFrame:
    try:
        return output.read(name)
    except NoTable:
        return output.spark.createDataFrame([], schema)


def extraction_batch(
    output: VersionedOutput, pages: Callable[[], DataFrame], host: str, run: str, max_attempts: int = MAX_ATTEMPTS
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for a stream of ``(url, line_no)``.

    ``pages`` gives the pages stored by now, ``(url, html)`` with one page per address, and is
    called once per batch. ``run`` names the run, so that a failed address is tried once in it.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = output.notes().get("batches", {})
        if batch_id <= done.get(run_id(spark), -1):
            return
        before = output.latest()
        counted = Observation()
        first = batch.groupBy("url").agg(F.min("line_no").alias("line_no"), F.count("*").alias("n"))
        first = staged(first.observe(counted, F.coalesce(F.sum("n"), F.lit(0)).alias("total_input_urls")), "arrived")

        waiting = _table(output, "open", OPEN)
        try:
            known = output.read("books").select("url")
        except NoTable:
            known = spark.createDataFrame([], "url string")
        # an address is looked up among records and open ones; both tables have it once
        seen = known.withColumn("has", F.lit("record")).unionByName(waiting.select("url", F.lit("open").alias("has")))
        marked = first.join(seen, "url", "left")
        again = waiting.where((F.col("last_run") != run) & (F.col("attempts") < max_attempts))
        todo = (
            marked.where("has IS NULL").select("url", "line_no", F.lit(0).alias("attempts"))
            .unionByName(again.select("url", "line_no", "attempts"))
        )
        # by a given number, since pages are small when compressed and long to extract: partitions
        # that were merged by size would be little more than the cores
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = todo.repartition(n, "url").join(pages().select("url", "html").repartition(n, "url"), "url", "left")
        skipped, tried = Observation(), Observation()
        good = F.col("status") == "ok"
        results = extract_records(found, host, keep=("url", "line_no", "attempts")).observe(
            tried, F.count_if(good).alias("processed_new"), F.count_if(~good).alias("failed_tries")
        )
        results = staged(results, "tried")
        books = results.where(good).select("url", "line_no", *RECORD_COLUMNS, "n_fields", (F.col("attempts") + 1).alias("attempts"))
        failed = results.where(~good).select(
            "url", "line_no", (F.col("attempts") + 1).alias("attempts"), "status", "error", F.lit(run).alias("last_run")
        )
        still = waiting.join(results.select("url"), "url", "left_anti").unionByName(failed)
        marked.observe(skipped, F.coalesce(F.sum(F.when(F.col("has") == "record", F.col("n"))), F.lit(0)).alias("skipped_existing")).write.format(
            "noop"
        ).mode("overwrite").save()

        try:
            parts = output.parts("books")
        except NoTable:
            parts = []
        parts = [*parts, output.write(books)]
        if len(parts) >= MERGE_FOLDERS:
            parts = [output.write(output.rows_of(parts))]
        now = {**counted.get, **skipped.get, **tried.get}
        sums = {n: output.notes().get(n, 0) + now[n] for n in _COUNTS}
        output.publish(
            {"books": parts, "open": [output.write(still)]}, before, {**sums, "batches": {**done, run_id(spark): batch_id}}
        )
        unstage(first)
        unstage(results)

    return apply


def extract_available(
    urls: DataFrame, pages: Callable[[], DataFrame], output: VersionedOutput, checkpoint: str, host: str, max_attempts: int = MAX_ATTEMPTS
) -> StreamingQuery:
    """One run: all addresses that have arrived since the last one, and one more try of open
    ones. Arrived rows are counted on the way, as ``arrived_urls`` of the stream's progress."""
    counted = urls.observe("arrived", F.count(F.lit(1)).alias("arrived_urls"))
    return run_available(counted, extraction_batch(output, pages, host, uuid.uuid4().hex, max_attempts), checkpoint)


def final_records(output: VersionedOutput) -> DataFrame:
    """Records of all runs, per address the one with most fields, the first on a tie."""
    keyed = output.read("books").withColumn("record_key", F.coalesce("detail_url", "book_id"))
    return dedup_richest(keyed, order="line_no").drop("record_key", "first_seen")


def run_counts(output: VersionedOutput) -> DataFrame:
    """One row: what the runs have counted while they read and wrote, without a pass over the outputs."""
    notes = output.notes()
    row = [notes.get(n, 0) for n in _COUNTS] + [sum(p["rows"] for p in output.parts("open")), sum(p["rows"] for p in output.parts("books"))]
    schema = ", ".join(f"{n} bigint" for n in (*_COUNTS, "failed", "total_processed"))
    return output.spark.createDataFrame([row], schema)

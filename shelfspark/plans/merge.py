"""Merge: all records of a folder in one collection, first occurrence wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.keys import JOB_KEY_MODE, key_mode
from shelfspark.functions.records import DEFAULT_DROP_FIELDS, drop_listed
from shelfspark.operators.dedup import dedup_first_wins, duplicates_report, label_duplicates, removed_rows
from shelfspark.operators.metrics import merge_metrics
from shelfspark.plans.clean import keyed_items, report_fields
from shelfspark.session import staged, unstage
from shelfspark.sources.files import inside
from shelfspark.sources.json_docs import (
    explode_documents,
    files_of,
    parse_documents,
    require_files,
    scan_json_documents,
    unwrap_books,
)
from shelfspark.sources.sinks import write_duplicates_report, write_json_array, write_json_lines


class MergeJob:
    """Merge ``(file, file_rank, doc)`` rows; ``dedup_key=None`` keeps duplicates.

    Listed fields go after duplicates do, so those of removed records do not count. An
    unreadable document stops the run. Tables are built when first asked for; with
    ``stage``, one pass over the documents writes items and files to the shared folder.
    """

    def __init__(
        self,
        docs: DataFrame,
        dedup_key: str | None = JOB_KEY_MODE,
        unwrap: bool = True,
        clean_fields: bool = True,
        fields: Sequence[str] = DEFAULT_DROP_FIELDS,
        exact: bool = True,
        stage: bool = True,
    ) -> None:
        self.mode = None if dedup_key is None else key_mode(dedup_key)
        self.clean_fields = clean_fields
        self.fields = tuple(fields)
        self.exact = exact
        self.stage = stage
        self._unwrapped = unwrap_books(parse_documents(docs, "failfast"), "merge", unwrap)

    @cached_property
    def rows(self) -> DataFrame:
        """Items and files of :func:`explode_documents`, items with key and number of listed fields."""
        keyed = keyed_items(explode_documents(self._unwrapped), self.mode or JOB_KEY_MODE, self.fields, self.exact)
        return staged(keyed, "merge-rows") if self.stage else keyed

    @property
    def files(self) -> DataFrame:
        return files_of(self.rows)

    @property
    def items(self) -> DataFrame:
        """All items with key and number of listed fields."""
        return self.rows.where(F.col("pos").isNotNull()).drop("document")

    def release(self) -> None:
        """Remove the staged rows; no table of this job can be read afterwards."""
        if self.stage and "rows" in self.__dict__:
            unstage(self.rows)

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.release()

    @property
    def merged(self) -> DataFrame:
        items = self.items.select("file", "file_rank", "pos", "is_object", "raw", "key_id", "n_listed", "repeats")
        kept = items if self.mode is None else dedup_first_wins(items)
        if self.clean_fields:
            kept = drop_listed(kept, self.fields, "n_listed", "repeats")
        return kept.select("file", "file_rank", "pos", "raw")

    @property
    def metrics(self) -> DataFrame:
        """One row of statistics, with the kind of key that records were compared by."""
        found = merge_metrics(self.files, self.items, self.mode is not None, self.clean_fields)
        return found.withColumn("dedup_key", F.lit(self.mode).cast("string"))

    @property
    def report(self) -> DataFrame | None:
        """Removed records; None without de-duplication."""
        if self.mode is None:
            return None
        return duplicates_report(removed_rows(label_duplicates(self.items)), report_fields())


def merge_files(
    spark: SparkSession,
    folder: str,
    output: str,
    dedup_key: str | None = JOB_KEY_MODE,
    recursive: bool = True,
    unwrap: bool = True,
    clean_fields: bool = True,
    exclude_paths: Sequence[str] = (),
    report: bool = False,
    ordered: bool = False,
    as_array: bool = False,
) -> MergeJob:
    """Merge a folder into a new folder ``output``: ``records``, ``metrics`` and ``report``.

    Records are JSON Lines, in input order if ``ordered``; with ``as_array`` their part
    files in name order form one JSON array. The job that is returned still has its staged
    rows, until it is released or the ``with`` block that it stands in ends.
    """
    docs = scan_json_documents(spark, [folder], recursive, [inside(output)], exclude_paths)
    job = MergeJob(docs, dedup_key, unwrap, clean_fields)
    require_files(job.files)
    if as_array:
        write_json_array(job.merged, f"{output}/records")
    else:
        write_json_lines(job.merged, f"{output}/records", ordered)
    job.metrics.write.json(f"{output}/metrics")
    if report and job.report is not None:
        write_duplicates_report(job.report, job.mode, f"{output}/report")
    return job

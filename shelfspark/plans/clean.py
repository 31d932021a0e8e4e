"""Clean: drop listed fields, then remove duplicates, and write one document per source."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.keys import JOB_KEY_MODE, key_mode, with_json_dedup_key
from shelfspark.functions.records import DEFAULT_DROP_FIELDS, drop_listed, with_names_counted
from shelfspark.operators.dedup import (
    dedup_first_wins,
    duplicates_report,
    label_duplicates,
    removed_rows,
)
from shelfspark.operators.metrics import metrics_rollup, rolled_files, rolled_totals
from shelfspark.session import staged, unstage
from shelfspark.sources.files import inside
from shelfspark.sources.json_docs import (
    explode_documents,
    files_of,
    parse_documents,
    require_files,
    scan_json_documents,
    unwrap_books,
    with_envelope,
)
from shelfspark.sources.sinks import document_lines, write_documents, write_duplicates_report


def keyed_items(
    items: DataFrame, mode: str, fields: Sequence[str] = DEFAULT_DROP_FIELDS, exact: bool = True
) -> DataFrame:
    """Items with their duplicate key, the number of listed fields they have, and whether they repeat a key."""
    return with_names_counted(with_json_dedup_key(items, mode, exact), "n_listed", "repeats", fields)


def report_fields(raw: str = "raw") -> dict:
    """Identifying fields shown for a removed record, as text."""
    names = ("title", "author", "publisher", "year", "isbn")
    rec = F.from_json(F.col(raw), ", ".join(f"{n} string" for n in names))
    return {n: rec[n] for n in names}


class UnreadableDocuments(RuntimeError):
    """A run has ended, but not all of its documents could be read."""


class CleanJob:
    """Clean ``(file, file_rank, doc)`` rows; unreadable documents become error rows.

    Every table is built when it is first asked for. With ``stage``, one pass over the
    documents writes their items, with what concerns a whole file on its first row, to the
    shared folder, and all outputs are derived from there; a column that an output doesn't
    need, such as the items' text, isn't read for it. :meth:`release` removes that folder.
    """

    def __init__(
        self,
        docs: DataFrame,
        dedup_key: str = JOB_KEY_MODE,
        cross_file: bool = True,
        fields: Sequence[str] = DEFAULT_DROP_FIELDS,
        keep_meta: bool = False,
        exact: bool = True,
        stage: bool = True,
    ) -> None:
        self.mode = key_mode(dedup_key)
        self.cross_file = cross_file
        self.fields = tuple(fields)
        self.keep_meta = keep_meta
        self.exact = exact
        self.stage = stage
        self._unwrapped = unwrap_books(parse_documents(docs), "clean")

    @cached_property
    def rows(self) -> DataFrame:
        """Items and files of :func:`explode_documents`, items with key and number of listed fields."""
        rows = explode_documents(with_envelope(self._unwrapped, self.keep_meta), ("head", "tail"))
        keyed = keyed_items(rows, self.mode, self.fields, self.exact)
        return staged(keyed, "clean-rows") if self.stage else keyed

    @property
    def files(self) -> DataFrame:
        """One row per file, with the text around its items."""
        files = files_of(self.rows)
        if self.keep_meta:
            nothing = {"meta_removed": F.lit(False), "meta_keys_removed": F.lit([]).cast("array<string>")}
            files = files.withColumns(nothing)
        return files

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

    @cached_property
    def labelled(self) -> DataFrame:
        return label_duplicates(self.items, cross_file=self.cross_file)

    @property
    def kept(self) -> DataFrame:
        """Items left, without the listed fields."""
        items = self.items.select("file", "file_rank", "pos", "is_object", "raw", "key_id", "n_listed", "repeats")
        kept = dedup_first_wins(items, cross_file=self.cross_file)
        return drop_listed(kept, self.fields, "n_listed", "repeats").select("file", "file_rank", "pos", "raw")

    @property
    def report(self) -> DataFrame:
        return duplicates_report(removed_rows(self.labelled), report_fields())

    @cached_property
    def metrics(self) -> DataFrame:
        """Metrics of files and of the run, from one aggregate."""
        return metrics_rollup(self.files.drop("head", "tail"), self.items, self.cross_file)

    @property
    def per_file(self) -> DataFrame:
        return rolled_files(self.metrics, self.files.drop("head", "tail"))

    @property
    def totals(self) -> DataFrame:
        return rolled_totals(self.metrics)

    @property
    def envelopes(self) -> DataFrame:
        """Files that are written again: those read without error and not skipped."""
        used = self.files.where((F.col("status") == "ok") & F.col("skipped").isNull())
        return used.select("file", "head", "tail")


def clean_files(
    spark: SparkSession,
    paths: Sequence[str],
    output: str,
    dedup_key: str = JOB_KEY_MODE,
    recursive: bool = False,
    exclude: Sequence[str] = (),
    cross_file: bool = True,
    keep_meta: bool = False,
    fields: Sequence[str] = DEFAULT_DROP_FIELDS,
    report: bool = False,
) -> CleanJob:
    """Clean files and folders into a new folder ``output``; sources are never touched.

    Files below ``output`` are no input, should it lie in one of the folders.

    ``documents`` gets the cleaned documents, ``metrics`` one row per file, ``totals`` one
    row for the run, ``report`` the removed records if asked for. Documents that can't be
    read raise at the end, when all outputs have been written. The job that is returned still has
    its staged rows, until it is released or the ``with`` block that it stands in ends.
    """
    docs = scan_json_documents(spark, paths, recursive, [*exclude, inside(output)])
    job = CleanJob(docs, dedup_key, cross_file, fields, keep_meta)
    require_files(job.files)
    write_documents(document_lines(job.kept, job.envelopes), f"{output}/documents")
    job.per_file.drop("file_rank").write.json(f"{output}/metrics")
    seen = Observation("clean_totals")
    job.totals.observe(seen, F.max("errors").alias("errors")).write.json(f"{output}/totals")
    if report:
        write_duplicates_report(job.report, job.mode, f"{output}/report")
    if seen.get["errors"]:
        raise UnreadableDocuments(f"{seen.get['errors']} of the documents could not be read; the others are under {output}")
    return job

"""Run statistics, computed from aggregates without labelling a single row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.dedup import first_per_file, first_per_key
from shelfspark.operators.membership import resume_counts


def side_by_side(*totals: DataFrame) -> DataFrame:
    """Global aggregates of one row each as one row, without joining anything."""
    out = totals[0]
    for other in totals[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.agg(*[F.max(name).alias(name) for name in out.columns])


def _contributions(
    files: DataFrame, items: DataFrame, cross_file: bool, key: str, file: str, pos: str, n_listed: str
) -> DataFrame:
    """What every file, item, first of a key in its file and first of a key over all files adds
    to its file's metrics, one below the other: nothing is joined."""
    per_file = first_per_file(items, key, file, pos)
    heads = first_per_key(per_file, key, file, pos) if cross_file else per_file
    one = F.lit(1).cast("bigint")
    facts = [c for c in files.columns if c != file]
    parts = (
        files.select(file, F.struct(*facts).alias("_facts")),
        items.select(
            file, one.alias("items_count"), F.col(n_listed).cast("bigint").alias("removed_count"),
            F.col(key).isNotNull().cast("bigint").alias("_keyed"),
        ),
        per_file.select(file, one.alias("_firsts")),
        heads.select(file, one.alias("_heads")),
    )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _counts() -> list:
    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    firsts, heads = total("_firsts"), total("_heads")
    return [
        total("items_count").alias("items_count"), total("removed_count").alias("removed_count"),
        (total("_keyed") - firsts).alias("duplicates_removed"), (firsts - heads).alias("cross_file_duplicates_removed"),
        (total("items_count") - total("_keyed") + heads).alias("books_count"),
    ]


def file_metrics(
    files: DataFrame,
    items: DataFrame,
    cross_file: bool = True,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    n_listed: str = "n_listed",
) -> DataFrame:
    """Per file: records left, listed fields removed, duplicates of both kinds.

    ``files`` has one row per file, so a file without items still shows. Of the keyed
    rows of a file, those beyond the first of each key are in-file duplicates, and
    firsts that are not the first over all files are cross-file duplicates. Listed
    fields are counted before duplicates go.
    """
    added = _contributions(files, items, cross_file, key, file, pos, n_listed)
    return _shown(added.groupBy(file).agg(F.any_value("_facts", True).alias("_facts"), *_counts()), files, file)


def _shown(grouped: DataFrame, files: DataFrame, file: str) -> DataFrame:
    listed = grouped.where(F.col("_facts").isNotNull())
    facts = [F.col(file) if c == file else F.col(f"_facts.{c}").alias(c) for c in files.columns]
    counts = [c for c in grouped.columns if c not in (file, "_facts") and not c.startswith("_")]
    return listed.select(*facts, *counts)


def metrics_rollup(
    files: DataFrame,
    items: DataFrame,
    cross_file: bool = True,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    n_listed: str = "n_listed",
) -> DataFrame:
    """:func:`file_metrics` and :func:`run_totals` from one aggregate, a rollup over files:
    for :func:`rolled_files` and :func:`rolled_totals`.

    Every row has the run's tallies of files, which mean something in the total only.
    """
    added = _contributions(files, items, cross_file, key, file, pos, n_listed)
    listed, used = F.col("_facts").isNotNull(), F.col("_facts.skipped").isNull()
    return added.rollup(file).agg(
        F.grouping(file).alias("_is_total"),
        F.any_value("_facts", True).alias("_facts"),
        *_counts(),
        F.count_if(listed & used).alias("_files_processed"),
        F.count_if(listed & ~used).alias("_files_skipped"),
        F.count_if(listed & used & (F.col("_facts.status") != "ok")).alias("_errors"),
        F.count_if(listed & used & F.col("_facts.meta_removed")).alias("_meta_removed_files"),
    )


def rolled_files(rolled: DataFrame, files: DataFrame, file: str = "file_rank") -> DataFrame:
    """The rows of :func:`file_metrics`; ``files`` names the columns."""
    return _shown(rolled.where("_is_total = 0"), files, file)


def rolled_totals(rolled: DataFrame) -> DataFrame:
    """The row of :func:`run_totals`; a skipped file has no items, so the sums need no filter."""
    names = {n: f"_{n}" for n in ("files_processed", "files_skipped", "errors", "meta_removed_files")}
    names |= {n: n for n in ("books_count", "removed_count", "duplicates_removed", "cross_file_duplicates_removed")}
    # of an empty input a rollup gives no row
    return rolled.where("_is_total = 1").agg(*(F.coalesce(F.max(c), F.lit(0)).alias(n) for n, c in names.items()))


def run_totals(per_file: DataFrame) -> DataFrame:
    """Sums over :func:`file_metrics`; skipped files count only as skipped."""
    used = F.col("skipped").isNull()

    def total(name: str):
        return F.coalesce(F.sum(F.when(used, F.col(name))), F.lit(0)).alias(name)

    return per_file.agg(
        F.count_if(used).alias("files_processed"),
        F.count_if(~used).alias("files_skipped"),
        F.count_if(used & (F.col("status") != "ok")).alias("errors"),
        F.count_if(used & F.col("meta_removed")).alias("meta_removed_files"),
        total("books_count"),
        total("removed_count"),
        total("duplicates_removed"),
        total("cross_file_duplicates_removed"),
    )


def merge_metrics(
    files: DataFrame,
    items: DataFrame,
    dedup: bool = True,
    clean_fields: bool = True,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    n_listed: str = "n_listed",
) -> DataFrame:
    """One row of merge statistics; listed fields count for kept records only.

    The number of listed fields rides along with the first row of each key, so kept
    records need not be found again.
    """
    file_side = files.agg(
        F.count("*").alias("files_count"),
        F.count_if(F.col("unwrapped")).alias("unwrapped_files"),
    )
    compared = F.col(key) if dedup else F.lit(None).cast("binary")
    keyed = items.select(file, pos, n_listed, compared.alias(key))
    is_free = F.col(key).isNull()
    free = keyed.agg(
        F.count_if(is_free).alias("free_rows"), F.sum(F.when(is_free, F.col(n_listed))).alias("free_fields")
    )
    heads = (
        keyed.where(F.col(key).isNotNull())
        .groupBy(key, file)
        .agg(F.min(F.struct(pos, n_listed)).alias("first"), F.count("*").alias("n_rows"))
        .groupBy(key)
        .agg(
            F.min(F.struct(F.col(file), F.col(f"first.{pos}"), F.col(f"first.{n_listed}"))).alias("head"),
            F.sum("n_rows").alias("n_rows"),
            F.count("*").alias("n_files"),
        )
        .agg(
            F.count("*").alias("head_rows"),
            F.sum(f"head.{n_listed}").alias("head_fields"),
            F.sum("n_rows").alias("keyed_rows"),
            F.sum("n_files").alias("first_rows"),
        )
    )
    n = {
        name: F.coalesce(F.col(name), F.lit(0)).cast("bigint")
        for name in (
            "free_rows", "free_fields", "head_rows", "head_fields", "keyed_rows", "first_rows"
        )
    }
    removed = n["free_fields"] + n["head_fields"] if clean_fields else F.lit(0).cast("bigint")
    return side_by_side(file_side, free, heads).select(
        "files_count",
        (n["free_rows"] + n["keyed_rows"]).alias("items_read"),
        (n["free_rows"] + n["head_rows"]).alias("items_count"),
        "unwrapped_files",
        (n["keyed_rows"] - n["first_rows"]).alias("in_file_duplicates"),
        (n["first_rows"] - n["head_rows"]).alias("cross_file_duplicates"),
        (n["keyed_rows"] - n["head_rows"]).alias("duplicates_removed"),
        removed.alias("fields_removed"),
        F.lit(clean_fields).alias("cleaned_fields"),
    )


def run_metrics(plan: DataFrame, results: DataFrame, existing: DataFrame) -> DataFrame:
    """Statistics of an extraction run, taken before the final richest-wins step.

    ``plan`` comes from ``url_plan``; ``results`` has one row per processed URL.
    """
    done = results.agg(
        F.count_if(F.col("status") == "ok").alias("processed_new"),
        F.count_if(F.col("status") != "ok").alias("failed"),
    )
    carried = existing.agg(F.count("*").alias("_existing"))
    return side_by_side(resume_counts(plan), done, carried).select(
        "total_input_urls",
        "skipped_existing",
        "processed_new",
        "failed",
        (F.col("processed_new") + F.col("_existing")).alias("total_processed"),
    )

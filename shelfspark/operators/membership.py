"""Resume: which inputs are new, and how new records join the old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.operators.dedup import distinct_keep_order


def url_plan(urls: DataFrame, processed: DataFrame, url: str = "url", order: str = "line_no") -> DataFrame:
    """Distinct input URLs with ``is_processed``, first place and number of occurrences.

    URLs are made distinct before the join, so one URL repeated in a third of the
    lines reaches the join as a single row.
    """
    # alike at every size: addresses outgrow a broadcast long before their estimated size does
    done = processed.where(F.col(url) != "").select(url).distinct().withColumn("_done", F.lit(True)).hint("merge")
    return (
        distinct_keep_order(urls, url, order)
        .join(done, url, "left")
        .withColumn("is_processed", F.col("_done").isNotNull())
        .drop("_done")
    )


def resume_new_urls(urls: DataFrame, processed: DataFrame, url: str = "url", order: str = "line_no") -> DataFrame:
    """URLs still to be processed, each once, with the place where it first occurs."""
    return url_plan(urls, processed, url, order).where(~F.col("is_processed")).select(url, order)


def resume_counts(plan: DataFrame) -> DataFrame:
    """Counts over :func:`url_plan`; lines already processed are counted before de-duplication."""
    n, done = F.col("n_seen"), F.col("is_processed")
    return plan.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_input_urls"),
        F.coalesce(F.sum(F.when(done, n)), F.lit(0)).alias("skipped_existing"),
        F.coalesce(F.sum(F.when(~done, n - 1)), F.lit(0)).alias("duplicate_urls"),
        F.count_if(~done).alias("to_process"),
    )


def drop_already_added(
    new: DataFrame, existing: DataFrame, url: str = "detail_url", order: str = "pos"
) -> DataFrame:
    """New records whose address is not in ``existing``, the first one per address.

    Records without an address are all kept. ``order`` must identify a row of ``new``.
    """
    addressed = new.where(F.col(url) != "")
    known = existing.where(F.col(url) != "").select(url).distinct()
    winners = (
        addressed.groupBy(url)
        .agg(F.min(order).alias(order))
        .join(known, url, "left_anti")
        .select(order, F.lit(True).alias("_wins"))
    )
    return (
        new.join(winners, order, "left")
        .where(F.col("_wins") | F.col(url).isNull() | (F.col(url) == ""))
        .drop("_wins")
    )


def merge_existing_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Old records followed by new ones; ``gen`` keeps the old ones first."""
    return existing.withColumn("gen", F.lit(0)).unionByName(
        new.withColumn("gen", F.lit(1)), allowMissingColumns=True
    )

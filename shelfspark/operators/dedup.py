"""First-wins and richest-wins de-duplication.

Rows are ordered by ``(file, pos)``, which must identify a row. Everything that has
to be decided per key is an aggregate with a map-side partial step, so a key held by
a third of all rows shrinks to one partial row per task before it is shuffled. The
decision goes back to the rows by a join on ``(file, pos)``, never on the key: those
values are unique, so that join cannot be skewed. No window runs over a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.keys import key_parts

KEPT = "kept"
IN_FILE = "in_file"
CROSS_FILE = "cross_file"


def first_per_file(
    rows: DataFrame,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per key and file: the first position there, with the ``carry`` columns of that row."""
    # The rows without a key form one group per file, dropped after the partial step. A
    # filter on the key itself would be pushed below the projection that computes it and
    # compute it a second time.
    first = F.min(F.struct(pos, *carry) if carry else F.col(pos)).alias("first")
    # A file is never NULL (see _placed). Saying so keeps Spark from inferring it for one use
    # of this table and not for another, whose plans would then differ and share no shuffle.
    placed = rows.where(F.col(file).isNotNull())
    grouped = placed.groupBy(key, file).agg(first, F.count(key).alias("_n")).where(F.col("_n") > 0)
    if carry:
        return grouped.select(key, file, "first.*")
    return grouped.select(key, file, F.col("first").alias(pos))


def first_per_key(
    per_file: DataFrame,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per key: its first occurrence over all files."""
    first = F.min(F.struct(file, pos, *carry)).alias("first")
    return per_file.groupBy(key).agg(first).select(key, "first.*")


def _placed(file: str, value: Column) -> Column:
    """``value``, unless the row has no file and so no place in the order: that ends the run."""
    message = F.lit(f"a row has no {file}, so its place in the order is unknown")
    return F.when(F.col(file).isNull(), F.raise_error(message)).otherwise(value)


def _keyed(key: str, has_key: str | None) -> Column:
    return F.col(has_key) if has_key else F.col(key).isNotNull()


def label_duplicates(
    rows: DataFrame,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    cross_file: bool = True,
    has_key: str | None = None,
) -> DataFrame:
    """Add ``label``: ``kept``, ``in_file`` or ``cross_file``.

    A repeat inside a file is ``in_file`` even when the first one there lost to an
    earlier file. Rows without a key are always kept. ``has_key`` names a cheap boolean
    column equal to "the key is not NULL", which spares computing a costly key twice. A row
    whose file is NULL ends the run.
    """
    per_file = first_per_file(rows, key, file, pos)
    marks = per_file.select(file, pos)
    mark = F.lit(KEPT)
    if cross_file:
        first_ever = first_per_key(per_file, key, file, pos).select(file, pos, F.lit(True).alias("_ever"))
        marks = marks.join(first_ever, [file, pos], "left")
        mark = F.when(F.col("_ever"), KEPT).otherwise(CROSS_FILE)
    # the narrow marks are joined with each other first, so that rows meet one table only
    marks = marks.select(file, pos, mark.alias("_mark"))
    label = F.when(~_keyed(key, has_key), KEPT).otherwise(F.coalesce("_mark", F.lit(IN_FILE)))
    return rows.join(marks, [file, pos], "left").withColumn("label", _placed(file, label)).drop("_mark")


def dedup_first_wins(
    rows: DataFrame,
    key: str = "key_id",
    file: str = "file_rank",
    pos: str = "pos",
    cross_file: bool = True,
    has_key: str | None = None,
) -> DataFrame:
    """Rows that stay: the first of each key (of each key and file if not ``cross_file``).

    ``has_key`` as for :func:`label_duplicates`.
    """
    winners = first_per_file(rows, key, file, pos)
    if cross_file:
        winners = first_per_key(winners, key, file, pos)
    marks = winners.select(file, pos, F.lit(True).alias("_wins"))
    return (
        rows.join(marks, [file, pos], "left")
        .where(_placed(file, ~_keyed(key, has_key) | F.col("_wins")))
        .drop("_wins")
    )


def removed_rows(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("label") != KEPT)


def duplicates_report(labelled: DataFrame, fields: dict[str, Column], key: str = "dedup_key") -> DataFrame:
    """One row per removed record: file, reason, key and the identifying fields."""
    return removed_rows(labelled).select(
        "file",
        F.col("label").alias("reason"),
        key_parts(F.col(key)).alias("key"),
        *[column.cast("string").alias(name) for name, column in fields.items()],
    )


def dedup_richest(
    rows: DataFrame,
    key: str = "record_key",
    n_fields: str = "n_fields",
    order: str | Sequence[str] = "pos",
) -> DataFrame:
    """Per key the record with most fields, the earlier one on a tie.

    ``order`` names one or more integer columns that together identify a row of a key. Records
    whose key is NULL or empty are dropped. ``first_seen`` is where the key first
    occurred, for callers that want that order; a struct if ``order`` has several columns.
    """
    order = [order] if isinstance(order, str) else list(order)
    backwards = [(-F.col(name)).alias(name) for name in order]
    first = F.min(F.struct(*order) if len(order) > 1 else F.col(order[0]))
    # empty keys are dropped after the partial step, see first_per_file
    best = (
        rows.groupBy(key)
        .agg(
            F.max(F.struct(F.col(n_fields).alias("_fields"), *backwards)).alias("_best"),
            first.alias("first_seen"),
            F.count_if(F.col(key) != "").alias("_n"),
        )
        .where(F.col("_n") > 0)
        .select(F.col(key).alias("_key"), *[(-F.col(f"_best.{name}")).alias(f"_{name}") for name in order], "first_seen")
    )
    # On the key, too, so that an order that repeats between keys multiplies nothing. The
    # null-safe comparison keeps Spark from inferring that the key is not NULL and testing it
    # below the projection that makes it, which would make it again.
    same = F.col(key).eqNullSafe(F.col("_key"))
    for name in order:
        same = same & (F.col(name) == F.col(f"_{name}"))
    # as many rows as there are keys: no broadcast, whatever their estimated size
    return rows.join(best.hint("merge"), same).drop("_key", *[f"_{name}" for name in order])


def distinct_keep_order(rows: DataFrame, value: str = "url", order: str = "line_no") -> DataFrame:
    """Distinct values with the place of their first occurrence and how often they occur."""
    return rows.groupBy(value).agg(F.min(order).alias(order), F.count("*").alias("n_seen"))

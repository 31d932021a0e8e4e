"""Bounded samples of labelled documents, for models fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.words import id_and_text, is_held_out


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id", text_col: str = "text",
    each: bool = False,
) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``most`` labelled documents, or of each label with ``each``.

    Held-out rows never take part. Which rows are taken depends on their ids' hashes alone.
    A row without id or label is no labelled row, and an id labelled twice counts once, by
    its larger label. The chosen ids are at most ``most`` (or twice that), so the join with
    the documents broadcasts them.
    """
    rows = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
    rows = rows.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64(F.col("doc_id"), F.lit(11))
    if each:
        chosen = [rows.where(F.col("label") == v).orderBy(order).limit(most) for v in (0, 1)]
        ids = chosen[0].unionByName(chosen[1])
    else:
        ids = rows.orderBy(order).limit(most)
    texts = id_and_text(docs, id_col, text_col)
    return texts.join(F.broadcast(ids), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")

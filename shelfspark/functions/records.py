"""Operations on one item of an open-schema JSON array, held as JSON text.

Keeping the item as text, not as VARIANT, preserves what a VARIANT loses: the order
of the keys and the spelling of numbers such as ``1.0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fields dropped from a record by default.
DEFAULT_DROP_FIELDS = (
    "detail_url",
    "format",
    "book_id",
    "title_from_title",
    "author_from_title",
    "author_key",
    "meta_description",
    "category_path",
    "category_urls",
    "category_url",
    "author_search_url",
    "date_added",
    "image_thumb_url",
    "image_large_url",
    "has_image",
    "view_counter_id",
    "in_stock",
    "in_stock_text",
    "prev_book_url",
    "next_book_url",
)


def _names(fields: Sequence[str]) -> Column:
    return F.array(*[F.lit(f) for f in fields]) if fields else F.lit([]).cast("array<string>")


def json_string(text: Column) -> Column:
    """``text`` as a quoted JSON string; characters beyond ASCII stay as they are."""
    # most names need no escapes
    return F.when(text.rlike("^[A-Za-z0-9_ .-]*$"), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.to_json(text.cast("variant")))


def field_names(raw: Column) -> Column:
    """Keys present in the object, explicit nulls included."""
    return F.array_distinct(F.json_object_keys(raw))


def json_members(fields: Column) -> Column:
    """``"key":value`` texts from an array of ``struct<key, json>``."""
    return F.transform(fields, lambda f: F.concat(json_string(f["key"]), F.lit(":"), f["json"]))


def with_object_fields(df: DataFrame, name: str, raw: Column) -> DataFrame:
    """Add ``name``: ``array<struct<key, json>>`` in written order; a repeated key keeps its
    last value. NULL where ``raw`` is NULL.

    The text is parsed twice: a VARIANT tells strings apart but respells numbers and
    reorders nested keys, plain text does neither.
    """
    values = F.map_values(F.from_json(raw, "map<string,variant>"))
    parsed = df.withColumns(
        {
            "_texts": F.map_entries(F.from_json(raw, "map<string,string>")),
            "_values": F.transform(values, lambda v: F.to_json(v)),
        }
    )
    # a string is taken as it was written out, quotes and all; anything else as it was read
    entries = F.zip_with(
        F.col("_texts"),
        F.col("_values"),
        lambda e, v: F.struct(
            e["key"].alias("key"),
            F.when(v.startswith('"'), v).otherwise(F.coalesce(e["value"], F.lit("null"))).alias("json"),
        ),
    )
    keys = F.array_distinct(F.transform("_texts", lambda e: e["key"]))
    parsed = parsed.withColumns({"_entries": entries, "_keys": keys}).drop("_texts", "_values")
    last = F.transform(
        "_keys", lambda k: F.element_at(F.filter("_entries", lambda e: e["key"] == k), -1)
    )
    repeated = F.size("_keys") < F.size("_entries")
    return parsed.withColumn(name, F.when(repeated, last).otherwise(F.col("_entries"))).drop(
        "_entries", "_keys"
    )


def count_listed(is_object: Column, raw: Column, fields: Sequence[str] = DEFAULT_DROP_FIELDS) -> Column:
    """How many of the listed fields the item has; 0 for items that are no objects."""
    present = F.size(F.array_intersect(field_names(raw), _names(fields)))
    return F.when(is_object, present).otherwise(F.lit(0))


def with_names_counted(
    items: DataFrame, n_listed: str, repeats: str, fields: Sequence[str] = DEFAULT_DROP_FIELDS
) -> DataFrame:
    """Add the number of listed fields and whether the object repeats a key, from one look at its keys."""
    named = items.withColumn("_names", F.when(F.col("is_object"), F.json_object_keys("raw")))
    listed = F.size(F.array_intersect("_names", _names(fields)))
    twice = F.size("_names") > F.size(F.array_distinct("_names"))
    return named.withColumns(
        {n_listed: F.when(F.col("is_object"), listed).otherwise(F.lit(0)), repeats: F.coalesce(F.col("is_object") & twice, F.lit(False))}
    ).drop("_names")


def drop_listed(
    items: DataFrame, fields: Sequence[str] = DEFAULT_DROP_FIELDS, n_listed: str | None = None, repeats: str | None = None
) -> DataFrame:
    """Items whose ``raw`` has lost the listed fields; anything but an object passes untouched.

    Of a key that an object repeats the last value stays. ``n_listed`` and ``repeats`` name
    columns with the count and whether a key is repeated, if both are there. Only objects
    that have a listed field or repeat a key are taken apart.
    """
    columns = items.columns
    if n_listed is None or repeats is None:
        n_listed, repeats = "_n_listed", "_repeats"
        items = with_names_counted(items, n_listed, repeats, fields)
    changed = (F.col(n_listed) > 0) | F.col(repeats)
    touched = with_object_fields(items, "_fields", F.when(changed, F.col("raw")))
    left = F.filter("_fields", lambda f: ~F.array_contains(_names(fields), f["key"]))
    text = F.concat(F.lit("{"), F.array_join(json_members(left), ","), F.lit("}"))
    return touched.withColumn("raw", F.coalesce(text, F.col("raw"))).select(columns)


def drop_columns(df: DataFrame, fields: Sequence[str] = DEFAULT_DROP_FIELDS) -> DataFrame:
    """Closed-form counterpart of :func:`drop_listed` for typed records."""
    return df.drop(*fields)


def count_listed_columns(df: DataFrame, fields: Sequence[str] = DEFAULT_DROP_FIELDS) -> Column:
    """Closed-form counterpart of :func:`count_listed`: a present field is a non-NULL column."""
    total = F.lit(0)
    for name in df.columns:
        if name in fields:
            total = total + F.col(name).isNotNull().cast("int")
    return total


def record_to_json(*columns: Column | str) -> Column:
    """A typed record as JSON text, NULL fields written as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

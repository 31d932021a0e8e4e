"""Duplicate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.text import normalize_isbn, normalize_text

# Key modes and their accepted spellings.
KEY_ISBN = "isbn"
KEY_FOUR_FIELDS = "title-author-publisher-year"
KEY_MODES = {
    "4": KEY_FOUR_FIELDS,
    "4fields": KEY_FOUR_FIELDS,
    "title-author-publisher-year": KEY_FOUR_FIELDS,
    "isbn": KEY_ISBN,
}
# Jobs compare by four fields unless told otherwise; the bare operators by ISBN.
JOB_KEY_MODE = KEY_FOUR_FIELDS

KEY_SCHEMA = "struct<kind:string,k1:string,k2:string,k3:string,k4:string>"
# Normalised fields cannot hold this character: it counts as whitespace and is collapsed.
_SEPARATOR = "\x1f"


def key_mode(name: str) -> str:
    mode = KEY_MODES.get(name.strip().lower())
    if mode is None:
        raise ValueError(f"unknown duplicate key {name!r}; known: {', '.join(sorted(KEY_MODES))}")
    return mode


def _key(kind: str, *parts: Column) -> Column:
    values = list(parts) + [F.lit(None).cast("string")] * (4 - len(parts))
    return F.struct(
        F.lit(kind).alias("kind"), *[v.alias(f"k{i}") for i, v in enumerate(values, 1)]
    )


def with_dedup_key(
    df: DataFrame,
    fields: dict[str, Column],
    mode: str = KEY_ISBN,
    exact: bool = True,
    is_record: Column | None = None,
) -> DataFrame:
    """Add ``dedup_key`` (NULL when the record cannot be compared) and ``key_id``.

    ``fields`` maps isbn, title, author, publisher and year to columns; missing ones count
    as absent. A record with an ISBN is only ever compared with records that have one. In
    four-field mode the others need all four fields. Rows that are no records have no key.

    Normalised fields are projected first, since the key refers to each several times.
    """
    mode = key_mode(mode)
    absent = F.lit(None).cast("string")

    def given(name: str) -> Column:
        value = fields.get(name, absent).cast("string")
        return value if is_record is None else F.when(is_record, value)

    parts = {"_isbn": normalize_isbn(given("isbn"))}
    if mode == KEY_FOUR_FIELDS:
        for name in ("title", "author", "publisher", "year"):
            parts[f"_{name}"] = normalize_text(given(name), exact)
    key = F.when(F.col("_isbn").isNotNull(), _key(KEY_ISBN, F.col("_isbn")))
    if mode == KEY_FOUR_FIELDS:
        four = [F.col(name) for name in parts if name != "_isbn"]
        complete = F.lit(True)
        for part in four:
            complete = complete & (part != "")
        key = key.when(complete, _key(KEY_FOUR_FIELDS, *four))
    keyed = df.withColumns(parts).withColumn("dedup_key", key).drop(*parts)
    return keyed.withColumn("key_id", key_id(F.col("dedup_key")))


def with_json_dedup_key(
    items: DataFrame, mode: str = KEY_ISBN, exact: bool = True, raw: str = "raw"
) -> DataFrame:
    """:func:`with_dedup_key` of items held as JSON text; only the key fields are parsed."""
    schema = "isbn string, title string, author string, publisher string, year string"
    rec = F.when(F.col("is_object"), F.from_json(raw, schema))
    parsed = items.withColumn("_rec", rec)
    fields = {n: F.col(f"_rec.{n}") for n in ("isbn", "title", "author", "publisher", "year")}
    return with_dedup_key(parsed, fields, mode, exact).drop("_rec")


def key_id(key: Column) -> Column:
    """Fixed-size stand-in for a key struct.

    Grouping on 32 bytes keeps long titles, or whole texts, out of the shuffle.
    """
    text = F.concat_ws(_SEPARATOR, *[key[f] for f in ("kind", "k1", "k2", "k3", "k4")])
    return F.when(key.isNotNull(), F.unhex(F.sha2(text, 256)))


def text_id(text: Column) -> Column:
    """The same for a single text column; NULL stays NULL."""
    return F.unhex(F.sha2(text, 256))


def key_parts(key: Column) -> Column:
    """Key as an array without the unused places, as reports show it."""
    return F.when(
        key.isNotNull(),
        F.filter(F.array(*[key[f] for f in ("kind", "k1", "k2", "k3", "k4")]), lambda x: x.isNotNull()),
    )

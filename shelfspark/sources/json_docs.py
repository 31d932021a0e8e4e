"""JSON documents of varying shape, unwrapped to one row per item.

A document is one file holding an object or an array, so it is parsed by one task;
parallelism comes from the number of files. Collections too big for that belong in
JSON Lines (``scan_json_lines``), which is also what the sinks write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.records import json_members, json_string, with_object_fields
from shelfspark.session import require_settings
from shelfspark.sources.files import (
    NoInputFiles,
    exclude_files,
    plain_path,
    rank_of,
    reached_through,
    read_arguments,
)
from shelfspark.sources.text_lists import numbered_lines

# Top-level keys that may hold the records, in order of precedence.
BOOKS_KEYS = ("books", "items", "data")

SKIP_NOT_CONTAINER = "not an object or array"
SKIP_NO_KEY = "no books, items or data"
SKIP_NOT_LIST = "books is not an array"

_ITEMS = "array<struct<v:variant,t:string>>"


def scan_json_documents(
    spark: SparkSession,
    paths: Sequence[str],
    recursive: bool = False,
    exclude: Sequence[str] = (),
    exclude_paths: Sequence[str] = (),
    missing_ok: bool = True,
) -> DataFrame:
    """Whole files as ``(file, file_rank, doc)``.

    A file that several arguments stand for is read through the first of them only: the others
    leave it out by its name, so contents are neither read twice nor joined with anything.
    """
    def read(target, options):
        return (
            spark.read.options(**options).text(target, wholetext=True)
            .select(plain_path(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("doc"))
        )

    docs = exclude_files(
        read_arguments(spark, paths, read, recursive, missing_ok), exclude, exclude_paths
    )
    repeated = F.lit(False)
    for arg, path in enumerate(paths[:-1]):
        repeated = repeated | ((F.col("arg") > arg) & reached_through(spark, path, recursive, F.col("file")))
    docs = docs.where(~repeated) if len(paths) > 1 else docs
    return docs.select("file", rank_of(F.col("file"), F.col("arg")).alias("file_rank"), "doc")


def parse_documents(docs: DataFrame, mode: str = "permissive") -> DataFrame:
    """Add ``v`` (VARIANT) and ``error``.

    Reading the text as the only element of an array rejects what the VARIANT parser
    would let pass: an empty file and text after the first complete value.
    ``failfast`` stops the run at the first unreadable document.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    require_settings(docs.sparkSession)
    wrapped = F.try_parse_json(F.concat(F.lit("["), F.col("doc"), F.lit("]")))
    # one element: without a second one, and a first one is looked up below
    usable = F.is_valid_utf8(F.col("doc")) & F.variant_get("_w", "$[1]", "variant").isNull()
    parsed = docs.withColumn("_w", wrapped).withColumn(
        "v", F.when(usable, F.variant_get("_w", "$[0]", "variant"))
    )
    error = F.when(F.col("v").isNull(), F.lit("unreadable JSON"))
    if mode == "failfast":
        error = F.when(
            F.col("v").isNull(),
            F.raise_error(F.concat(F.lit("unreadable JSON: "), F.col("file"))).cast("string"),
        )
    return parsed.withColumn("error", error).drop("_w")


def _items(array: Column, text: Column) -> Column:
    """Array items both as VARIANT, for their kind, and as text, for their spelling."""
    return F.zip_with(
        array, F.from_json(text, "array<string>"), lambda v, t: F.struct(v.alias("v"), t.alias("t"))
    )


def unwrap_books(docs: DataFrame, mode: str = "clean", unwrap: bool = True) -> DataFrame:
    """Find the record array of each parsed document.

    ``clean``: an array, or the value of the first *present* key of ``BOOKS_KEYS``;
    anything else is skipped with a reason. ``merge``: an array, or the first key whose
    value *is an array*; anything else is one single record.

    Adds ``books_key``, ``skipped``, ``unwrapped``, ``meta_keys`` and ``items``.
    """
    if mode not in ("clean", "merge"):
        raise ValueError(f"unknown mode {mode!r}")
    v, doc = F.col("v"), F.col("doc")
    # of a document known to be valid the first character tells the kind
    docs = docs.withColumn("_first", F.left(F.ltrim(doc, F.lit(" \t\r\n")), F.lit(1)))
    is_array, is_object = F.col("_first") == "[", F.col("_first") == "{"
    top = F.from_json(doc, ", ".join(f"{k} string" for k in BOOKS_KEYS))
    arrays = {k: F.try_variant_get(v, f"$.{k}", "array<variant>") for k in BOOKS_KEYS}
    whole = F.when(is_array, _items(F.try_variant_get(v, "$", "array<variant>"), doc))

    chosen = F.lit(None).cast("string")
    for k in reversed(BOOKS_KEYS):
        if mode == "clean":
            hit = F.variant_get(v, f"$.{k}", "variant").isNotNull()
        else:
            hit = arrays[k].isNotNull()
        chosen = F.when(hit, F.lit(k)).otherwise(chosen)
    if not unwrap:
        chosen = F.lit(None).cast("string")
    out = docs.withColumn("books_key", F.when(is_object & v.isNotNull(), chosen))

    found = whole
    for k in BOOKS_KEYS:
        found = found.when(F.col("books_key") == k, _items(arrays[k], top[k]))
    if mode == "merge":
        single = _items(F.array(v), F.concat(F.lit("["), doc, F.lit("]")))
        found = F.when(v.isNull(), F.lit(None).cast(_ITEMS)).otherwise(F.coalesce(found, single))
        out = out.withColumn("items", found).withColumn("skipped", F.lit(None).cast("string"))
    else:
        # found out without the items, so that file-level columns do not need them
        is_null, is_list = F.lit(False), F.lit(False)
        for k in BOOKS_KEYS:
            chosen_here = F.col("books_key") == k
            is_null = is_null | (chosen_here & F.is_variant_null(F.variant_get(v, f"$.{k}", "variant")))
            is_list = is_list | (chosen_here & arrays[k].isNotNull())
        skipped = (
            F.when(v.isNull(), F.lit(None).cast("string"))
            .when(~is_array & ~is_object, SKIP_NOT_CONTAINER)
            .when(is_object & (F.col("books_key").isNull() | is_null), SKIP_NO_KEY)
            .when(is_object & ~is_list, SKIP_NOT_LIST)
        )
        out = out.withColumn("items", F.when(v.isNotNull(), found)).withColumn("skipped", skipped)
        # only a document whose array was found has lost its envelope
        out = out.withColumn("books_key", F.when(F.col("skipped").isNull(), F.col("books_key")))
    return (
        out.withColumn("unwrapped", F.col("books_key").isNotNull())
        .withColumn("meta_keys", meta_keys(doc, F.col("books_key")))
        .drop("_first")
    )


def meta_keys(doc: Column, books_key: Column) -> Column:
    """Top-level keys that go when the envelope is stripped."""
    keys = F.json_object_keys(doc)
    return F.when(books_key.isNotNull(), F.array_except(keys, F.array(books_key))).otherwise(
        F.lit([]).cast("array<string>")
    )


def with_envelope(unwrapped: DataFrame, keep_meta: bool) -> DataFrame:
    """Add ``head`` and ``tail``, the text around the items when a document is written again."""
    bare = {"head": F.lit("["), "tail": F.lit("]")}
    if not keep_meta:
        return unwrapped.withColumns(bare)
    wrapped = F.col("books_key").isNotNull()
    out = with_object_fields(unwrapped, "_top", F.when(wrapped, F.col("doc")))
    place = F.array_position(F.transform("_top", lambda f: f["key"]), F.col("books_key")).cast("int")
    out = out.withColumn("_place", place)
    before = json_members(F.slice("_top", F.lit(1), F.col("_place") - 1))
    after = json_members(F.slice("_top", F.col("_place") + 1, F.size("_top")))
    head = F.concat(
        F.lit("{"),
        F.array_join(F.transform(before, lambda t: F.concat(t, F.lit(","))), ""),
        json_string(F.col("books_key")),
        F.lit(":["),
    )
    tail = F.concat(
        F.lit("]"),
        F.array_join(F.transform(after, lambda t: F.concat(F.lit(","), t)), ""),
        F.lit("}"),
    )
    return out.withColumns(
        {
            "head": F.when(wrapped, head).otherwise(bare["head"]),
            "tail": F.when(wrapped, tail).otherwise(bare["tail"]),
        }
    ).drop("_top", "_place")


def file_table(unwrapped: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per file, without contents; ``keep`` passes further columns on."""
    return unwrapped.select(
        "file",
        "file_rank",
        F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"),
        "error",
        "skipped",
        "books_key",
        "unwrapped",
        F.col("unwrapped").alias("meta_removed"),
        F.col("meta_keys").alias("meta_keys_removed"),
        *keep,
    )


def explode_documents(unwrapped: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per item, and one with a NULL ``pos`` per file without items:
    ``(file, file_rank, pos, is_object, raw, document)``.

    ``document`` has the columns of :func:`file_table` in one row per file, the first, and
    is NULL in the others, so files and items come from one pass over the documents.
    """
    # a plain posexplode makes Spark infer a filter on the array and push it below the
    # projections that parse the document, which would then be parsed many times over
    document = F.struct(*(c for c in file_table(unwrapped, keep).columns if c not in ("file", "file_rank")))
    files = file_table(unwrapped, (*keep, "items")).withColumn("_document", document)
    exploded = files.select("file", "file_rank", "_document", F.posexplode_outer("items").alias("pos", "item"))
    kinds = exploded.withColumn("kind", F.schema_of_variant(F.col("item.v")))
    raw = F.when(F.col("kind") == "STRING", F.to_json(F.col("item.v"))).otherwise(F.coalesce(F.col("item.t"), F.lit("null")))
    return kinds.select(
        "file",
        "file_rank",
        "pos",
        F.col("kind").startswith("OBJECT").alias("is_object"),
        F.when(F.col("pos").isNotNull(), raw).alias("raw"),
        F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("_document")).alias("document"),
    )


def files_of(rows: DataFrame) -> DataFrame:
    """The file table out of :func:`explode_documents`."""
    return rows.where(F.col("document").isNotNull()).select("file", "file_rank", "document.*")


def explode_items(unwrapped: DataFrame) -> DataFrame:
    """One row per item: ``(file, file_rank, pos, is_object, raw)``; ``raw`` is JSON text."""
    return explode_documents(unwrapped).where(F.col("pos").isNotNull()).drop("document")


def scan_json_lines(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Items from JSON Lines: splittable at any size, in the shape of :func:`explode_items`.

    ``pos`` is the line number; a line that is no JSON value raises.
    """
    require_settings(spark)
    lines = numbered_lines(spark, paths)
    v = F.parse_json("value")
    return lines.where(F.trim("value") != "").select(
        "file",
        rank_of(F.col("file")).alias("file_rank"),
        F.col("line_no").alias("pos"),
        F.schema_of_variant(v).startswith("OBJECT").alias("is_object"),
        F.col("value").alias("raw"),
    )


def require_files(files: DataFrame) -> None:
    if files.isEmpty():
        raise NoInputFiles("no JSON file left to process")

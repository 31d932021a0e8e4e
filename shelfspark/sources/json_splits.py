"""One JSON array of any size, read in splits by many tasks.

The file is read as pieces of text between commas, which Spark splits anywhere. Whether a
comma stands between two items depends on all the text before it: on whether it is inside a
string and how many brackets are open. A stretch of text turns the one state into the next:
it has an odd or even number of quotes, and closes or opens so many brackets where it begins
outside a string, so many where it begins inside. Such steps can be put together in any
grouping, so each task joins the pieces of its splits to stretches, a row each, and sums them
up alone, for both beginnings; the sums are run through in order, and then each stretch is
cut from its true state. The text is written once and never sorted.

In an array no comma outside strings has fewer than one bracket open, so the commas between
items are, in each stretch, the ones with the fewest, and can be listed before the state is
known. Most items lie within a stretch; the ends of others are joined by the item's number.
Nothing holds more than one stretch or one item.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.session import require_settings, staged
from shelfspark.sources.files import plain_path, rank_of

_BLANK = " \t\r\n"  # fixed value: white space between JSON tokens
_QUOTE, _OPEN, _CLOSE, _COMMA, _BACKSLASH = range(1, 6)
_KIND = np.zeros(256, np.uint8)
for _chars, _kind in (('"', _QUOTE), ("[{", _OPEN), ("]}", _CLOSE), (",", _COMMA), ("\\", _BACKSLASH)):
    _KIND[[ord(c) for c in _chars]] = _kind
STRETCH_BYTES = 1 << 20  # a stretch ends with the piece that begins beyond so many bytes
_STEP = pa.struct([("net", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("cuts", pa.list_(pa.int32()))])
_STRETCH = pa.schema(
    [("part", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("text", pa.binary()),
     ("odd", pa.bool_()), ("from_out", _STEP), ("from_in", _STEP)]
)
_STRETCH_SQL = "part string, block bigint, at bigint, text binary, odd boolean" + "".join(
    f", {name} struct<net: bigint, low: bigint, n: bigint, cuts: array<int>>" for name in ("from_out", "from_in")
)


def _steps(text: bytes) -> dict:
    """Of a stretch: whether its quotes are odd in number and, if it begins outside or inside a
    string, the brackets it opens, and the commas with the fewest brackets open: how many those
    are, the number of such commas, and their places."""
    kinds = _KIND[np.frombuffer(text, np.uint8)]
    place = np.flatnonzero(kinds)
    back = np.flatnonzero(kinds == _BACKSLASH)
    if len(back):
        # a quote behind an odd run of backslashes is none; a comma is never escaped
        first = np.flatnonzero(np.diff(back, prepend=-2) > 1)
        length = np.diff(first, append=len(back))
        escaped = (back[first] + length)[length % 2 == 1]
        kinds[escaped[escaped < len(kinds)]] = 0
    kind = kinds[place]
    inside = np.cumsum(kind == _QUOTE) % 2
    step = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
    found = {"odd": bool(len(inside) and inside[-1])}
    for name, begin in (("from_out", 0), ("from_in", 1)):
        here = inside == begin
        depth = np.cumsum(np.where(here, step, 0))
        commas = here & (kind == _COMMA)
        low = int(depth[commas].min()) if commas.any() else None
        cuts = place[commas & (depth == low)].astype(np.int32) if low is not None else np.empty(0, np.int32)
        found[name] = {"net": int(depth[-1]) if len(depth) else 0, "low": low, "n": len(cuts), "cuts": cuts}
    return found


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces ``(part, block, value)``, in the order of the scan, joined to stretches."""
    split, at = None, 0
    for batch in batches:
        part, block, value = (batch.column(name) for name in ("part", "block", "value"))
        n = batch.num_rows
        if not n:
            continue
        volume = np.cumsum(pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64)) // STRETCH_BYTES
        new = np.diff(volume) > 0
        for column in (part, block):
            new |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(new) + 1), n]
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            here = part[begin].as_py(), block[begin].as_py()
            split, at = here, at + 1 if here == split else 0
            pieces = pa.ListArray.from_arrays(pa.array([0, end - begin], pa.int32()), value[begin:end])
            text = pc.binary_join(pieces, b",")[0].as_py()
            row = {"part": here[0], "block": here[1], "at": at, "text": text, **_steps(text)}
            yield pa.RecordBatch.from_pylist([row], _STRETCH)


def _chosen(field: str) -> Column:
    return F.when(F.col("in_string"), F.col(f"from_in.{field}")).otherwise(F.col(f"from_out.{field}"))


def _damaged(file: Column) -> Column:
    return F.raise_error(F.concat(F.lit("no JSON array, or an item in it is no JSON: "), file))


def array_pieces(spark: SparkSession, paths: Sequence[str] | str, joined: bool = False) -> DataFrame:
    """``(uri, part, block, at, text, item, whole, ends, closed)``: the text of items, ``whole``
    or as much as a stretch has of it, with the number of the item.

    ``ends`` marks a file's last piece, ``closed`` that the array is closed behind it. ``block``
    is a split of a file and ``at`` the order there. With ``joined`` the files of a folder, in
    order of their names, are one text, as the sinks write it.
    """
    path = F.col("_metadata.file_path")
    pieces = spark.read.option("lineSep", ",").text(list(paths) if not isinstance(paths, str) else paths).select(
        path.alias("part"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )
    uri = F.regexp_replace("part", "/[^/]*$", "") if joined else F.col("part")
    # the splits of one scan, written once, are those that everything below refers to
    told = staged(pieces.mapInArrow(_stretches, _STRETCH_SQL).withColumn("uri", uri), "array-pieces")

    # between the stretches of a text: a row each
    place = ("uri", "part", "block", "at")
    order = W.partitionBy("uri").orderBy(*place[1:])
    before = order.rowsBetween(W.unboundedPreceding, -1)

    def running(value: Column) -> Column:
        return F.coalesce(F.sum(value).over(before), F.lit(0))

    following = F.lead("part").over(order)
    sums = [F.struct(*(F.col(f"{name}.{c}") for c in ("net", "low", "n"))).alias(name) for name in ("from_out", "from_in")]
    known = told.select(*place, "odd", *sums).select(
        *place, "odd", "from_out", "from_in", (running(F.col("odd").cast("bigint")) % 2 == 1).alias("in_string"),
        following.isNull().alias("ends"), F.coalesce(following == F.col("part"), F.lit(False)).alias("has_comma"),
    )
    known = known.select(
        *place, "in_string", "ends", "has_comma", *(_chosen(c).alias(c) for c in ("net", "low", "n")),
        (F.col("in_string") != F.col("odd")).alias("string_after"),
    )
    known = known.withColumn("open", running(F.col("net")))
    lowest = F.col("open") + F.col("low")
    known = known.select(
        *place, "in_string", "ends", "has_comma",
        F.when(lowest < 1, _damaged(plain_path(F.col("uri"))).cast("boolean")).otherwise(F.coalesce(lowest == 1, F.lit(False))).alias("cut"), "n",
        (~F.col("string_after") & (F.col("open") + F.col("net") == 0)).alias("closed"),
        (F.col("has_comma") & ~F.col("string_after") & (F.col("open") + F.col("net") == 1)).alias("ends_item"),
    )
    ended = F.when(F.col("cut"), F.col("n")).otherwise(F.lit(0)) + F.col("ends_item").cast("bigint")
    known = known.withColumns(
        {"item": running(ended), "begins_item": F.coalesce(F.lag("ends_item").over(order), F.lit(True))}
    ).drop("n")

    # its size is known when it is written, and with that how to join it
    cut = told.join(staged(known, "array-states"), list(place))
    cuts = F.when(F.col("cut"), _chosen("cuts")).otherwise(F.array().cast("array<int>"))
    cut = cut.withColumns({"cuts": cuts, "size": F.octet_length("text")})
    begins = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c + 1))
    ends = F.concat("cuts", F.array("size"))
    # as an element the text is taken from its row once; as a column it is copied for each piece
    texts = F.transform(
        F.array("text"), lambda text: F.zip_with(begins, ends, lambda b, e: F.substring(text, b + 1, e - b).cast("string"))
    )[0]
    rows = cut.select(
        *place, F.col("item").alias("first"), F.size("cuts").alias("last"), "begins_item", "ends_item", "has_comma",
        F.col("ends").alias("last_stretch"), "closed", F.posexplode(texts).alias("i", "piece"),
    )
    is_first, is_last = F.col("i") == 0, F.col("i") == F.col("last")
    return rows.select(
        *place, (F.col("first") + F.col("i")).alias("item"),
        F.when(is_last & F.col("has_comma") & ~F.col("ends_item"), F.concat("piece", F.lit(","))).otherwise(F.col("piece")).alias("text"),
        ((~is_first | F.col("begins_item")) & (~is_last | F.col("ends_item") | F.col("last_stretch"))).alias("whole"),
        (is_last & F.col("last_stretch")).alias("ends"), "closed",
    )


def scan_json_array(spark: SparkSession, paths: Sequence[str] | str, joined: bool = False) -> DataFrame:
    """Items of files that each hold one JSON array, in the shape of :func:`explode_items`:
    ``(file, file_rank, pos, is_object, raw)``, ``raw`` being the item's text as it stands.

    With ``joined`` the files of each folder are one array, as :func:`write_json_array` leaves
    them, and ``file`` is the folder. An empty array gives no row, nor does a file without a
    single character, of which Spark reads nothing. Text that is no array, or an item that is
    no JSON value, ends the run. Files are read once, into the shared folder.
    """
    require_settings(spark)
    pieces = array_pieces(spark, paths, joined)
    order = F.array_sort(F.collect_list(F.struct("part", "block", "at", "text")))
    parted = pieces.where(~F.col("whole")).groupBy("uri", "item").agg(
        F.array_join(F.transform(order, lambda p: p["text"]), "").alias("text"),
        F.max("ends").alias("last"), F.max(F.col("ends") & F.col("closed")).alias("closed"),
    )
    items = pieces.where("whole").select("uri", "item", "text", F.col("ends").alias("last"), "closed").unionByName(parted)
    text = F.btrim("text", F.lit(_BLANK))
    opened = F.when(F.col("item") > 0, text).when(text.startswith("["), F.btrim(F.substring(text, F.lit(2), F.length(text)), F.lit(_BLANK)))
    raw = F.when(~F.col("last"), opened).when(
        F.col("closed") & opened.endswith("]"), F.btrim(F.left(opened, F.length(opened) - 1), F.lit(_BLANK))
    )
    rows = items.select(plain_path(F.col("uri")).alias("file"), F.col("item").alias("pos"), "last", raw.alias("raw"))
    # the only item of an array, if blank, is none
    alone = F.col("last") & (F.col("pos") == 0) & (F.col("raw") == "")
    checked = rows.where(F.coalesce(~alone, F.lit(True))).withColumn(
        "raw", F.when(F.try_parse_json("raw").isNotNull(), F.col("raw")).otherwise(_damaged(F.col("file")))
    )
    return checked.select(
        "file", rank_of(F.col("file")).alias("file_rank"), "pos", F.col("raw").startswith("{").alias("is_object"), "raw"
    )

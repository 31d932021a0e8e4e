"""Positions of all matches of a pattern, in DataFrame functions.

Splitting a text at a pattern gives the stretches between its matches, and their lengths add
up to the places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = "array<struct<start:int,end:int,match:string>>"


BLOCK = 64  # matches whose places are summed up one after the other


def with_matches(rows: DataFrame, out: str, searched: Column, pattern: str) -> DataFrame:
    """``rows`` with ``out``: leftmost matches that don't overlap, as (start, end, match).

    Places are code points and ends exclusive. A null text has no match. Each step is a
    column of its own, as the regex functions would else run once per use. Matches are taken
    in blocks, whose lengths give where each begins, so no array grows match by match.
    """
    rows = rows.withColumn("_searched", searched)
    rows = rows.withColumns({"_found": F.regexp_extract_all("_searched", F.lit(pattern), F.lit(0)), "_between": F.split("_searched", pattern, -1)})
    steps = F.zip_with(
        F.slice("_between", F.lit(1), F.size("_found")), "_found", lambda gap, m: F.struct(F.length(gap).alias("gap"), m.alias("match"))
    )
    blocks = F.transform(F.sequence(F.lit(0), F.size("_steps") - 1, F.lit(BLOCK)), lambda i: F.slice("_steps", i + 1, F.lit(BLOCK)))
    rows = rows.withColumn("_steps", F.when(F.size("_found") > 0, steps)).withColumn("_blocks", F.when(F.col("_steps").isNotNull(), blocks))

    def long(x: Column) -> Column:
        return x["gap"] + F.length(x["match"])

    def step(state: Column, x: Column) -> Column:
        end = state["end"] + long(x)
        span = F.struct((state["end"] + x["gap"]).alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("end"), F.concat(state["out"], F.array(span)).alias("out"))

    lengths = F.transform("_blocks", lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + long(x)))
    begins = F.aggregate(lengths, F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n)))
    rows = rows.withColumn("_begins", F.slice(begins, F.lit(1), F.size("_blocks")))
    empty = F.array().cast(MATCHES)
    spans = F.flatten(F.zip_with(
        "_blocks", "_begins", lambda b, at: F.aggregate(b, F.struct(at.alias("end"), empty.alias("out")), step, lambda s: s["out"])
    ))
    return rows.withColumn(out, F.coalesce(spans, empty)).drop("_searched", "_found", "_between", "_steps", "_blocks", "_begins")


def before(text: Column, start: Column, most: int) -> Column:
    """The code points before a place, ``most`` at most."""
    first = F.greatest(start - most, F.lit(0))
    return F.substring(text, first + 1, start - first)

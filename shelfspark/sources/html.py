"""Stored HTML pages in a single-byte Cyrillic encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.sources.files import plain_path

PAGE_ENCODING = "cp1251"
PAGE_END = "\0"  # a character that markup must not hold
_NO_MEANING = 0x98  # the one byte that the encoding leaves undefined
_UPPER = [b for b in range(0x80, 0x100) if b != _NO_MEANING]
_AS_LATIN = "".join(map(chr, _UPPER))
_AS_PAGE = bytes(_UPPER).decode(PAGE_ENCODING)


def decode_page(content: Column) -> Column:
    """Page bytes as text; a byte without a meaning in the encoding raises.

    Spark's own ``decode`` refuses this encoding unless a legacy setting is on. A byte of
    Latin 1 is a character of the same number, which is then exchanged for the page's.
    """
    latin = F.decode(content, "ISO-8859-1")
    undefined = F.raise_error(F.lit(f"byte {_NO_MEANING:#x} has no meaning in {PAGE_ENCODING}")).cast("string")
    return F.when(F.instr(latin, chr(_NO_MEANING)) > 0, undefined).otherwise(F.translate(latin, _AS_LATIN, _AS_PAGE))


def encode_page(text: Column) -> Column:
    """Inverse of :func:`decode_page`; other characters become numeric references."""
    # neighbours share a range, the longest first: a letter is compared with few of them
    ranges = []
    for c in sorted(map(ord, _AS_PAGE)):
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    ranges.sort(key=lambda r: r[0] - r[1])
    known = "\\x{0}-\\x{7f}" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)
    spelled = F.array_join(
        F.transform(F.split(text, ""), lambda c: F.when(c.rlike(f"[^{known}]"), F.concat(F.lit("&#"), F.ascii(c).cast("string"), F.lit(";"))).otherwise(c)),
        "",
    )
    written = F.when(text.rlike(f"[^{known}]"), spelled).otherwise(text)
    return F.encode(F.translate(written, _AS_PAGE, _AS_LATIN), "ISO-8859-1")


def write_html_pages(pages: DataFrame, path: str, html: str = "html") -> None:
    """Pages in their encoding, as many in a file as a task has, for :func:`scan_html_pages`
    with ``PAGE_END``; a page that holds that character ends the run."""
    whole = F.when(~F.contains(F.col(html), F.lit(PAGE_END)), F.col(html)).otherwise(
        F.when(F.col(html).isNotNull(), F.raise_error(F.lit("a page holds the character that ends pages")).cast("string"))
    )
    pages.select(encode_page(whole).cast("string").alias("page")).write.option("lineSep", PAGE_END).text(path)


def scan_html_pages(spark: SparkSession, path: Sequence[str] | str, page_end: str | None = None) -> DataFrame:
    """Stored pages as ``(file, html)``: a file each, or with ``page_end`` many in a file, each
    ended by that text, which none of them holds. Such files are few, and read in splits."""
    if page_end is not None:
        lines = spark.read.option("lineSep", page_end).text(path)
        return lines.select(plain_path(F.col("_metadata.file_path")).alias("file"), decode_page(F.col("value").cast("binary")).alias("html"))
    files = spark.read.format("binaryFile").load(path)
    return files.select(plain_path(F.col("_metadata.file_path")).alias("file"), decode_page(F.col("content")).alias("html"))

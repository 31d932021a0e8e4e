"""Choosing input files and giving them an order."""

from __future__ import annotations

import fnmatch
import glob
import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stands for the path separator in a rank; sorts before every character of a name.
_BEFORE_ALL = "\x01"
_ARGUMENT_DIGITS = 19  # as many as the largest bigint has


class NoInputFiles(ValueError):
    """No file matched; an empty result would hide a wrong path."""


def glob_regex(pattern: str) -> str:
    """Shell pattern as an anchored regular expression of the JVM dialect."""
    return "^" + fnmatch.translate(pattern).removesuffix(r"\Z").removesuffix(r"\z") + r"\z"


def inside(folder: str) -> str:
    """Pattern for everything below ``folder``."""
    return "*" + glob.escape(folder.rstrip("/")) + "/*"


def plain_path(uri: Column) -> Column:
    """File URI, as ``_metadata.file_path`` gives it, without scheme and percent escapes."""
    escaped = F.regexp_replace(uri, r"^[a-z0-9+.-]+:/*(?=/)", "")
    return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))


def whole_path(spark: SparkSession, path: str) -> str:
    """A path argument as :func:`plain_path` gives the paths of files: whole and without scheme."""
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = given.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(given).toString()
    return re.sub(r"^[a-z0-9+.-]+:/*(?=/)", "", whole)


def reached_through(spark: SparkSession, path: str, recursive: bool, file: Column) -> Column:
    """Whether a JSON file is one that the argument ``path`` stands for, by their names alone."""
    if glob.has_magic(path):
        # a star stands for part of a name, and a folder for all below it
        rx = "(?:[^/]*)".join(map(re.escape, whole_path(spark, path).split("*")))
        if glob.has_magic(path.replace("*", "")):
            raise ValueError(f"only * is a wildcard where several inputs are named: {path}")
        below = "" if _names_json_file(path) else "/.*" if recursive else "/[^/]*"
        return file.rlike(f"^{rx}{below}$")
    whole = whole_path(spark, path)
    if _names_json_file(path):
        return file == whole
    if recursive:
        return F.startswith(file, F.lit(whole.rstrip("/") + "/"))
    return F.regexp_replace(file, "/[^/]*$", "") == whole.rstrip("/")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def rank_of(path: Column, arg: Column | int = 0) -> Column:
    """Sort key of a file: its argument's place, then its path component by component.

    One text instead of a struct with an array: with the separator below every other
    character, text order equals component order (``a/b`` comes before ``a.json``).
    A negative place raises.
    """
    arg = (F.lit(arg) if isinstance(arg, int) else arg).cast("bigint")
    digits = F.when(arg < 0, F.raise_error(F.lit("a place is not negative")).cast("string")).otherwise(arg.cast("string"))
    place = F.lpad(digits, _ARGUMENT_DIGITS, "0")
    return F.concat(place, F.lit(_BEFORE_ALL), F.translate(path, "/", _BEFORE_ALL))


def rank_argument(rank: Column) -> Column:
    """Place of the argument a ranked file was reached through."""
    return F.left(rank, F.lit(_ARGUMENT_DIGITS)).cast("bigint")


def exclude_files(
    files: DataFrame,
    patterns: Sequence[str] = (),
    paths: Sequence[str] = (),
    path: str = "file",
) -> DataFrame:
    """Drop files whose base name or whole path matches a pattern, and exact paths.

    Patterns and paths are arguments of the run: a handful of strings.
    """
    excluded = F.lit(False)
    for pattern in patterns:
        rx = glob_regex(pattern)
        excluded = excluded | base_name(F.col(path)).rlike(rx) | F.col(path).rlike(rx)
    if paths:
        excluded = excluded | F.col(path).isin(*paths)
    return files.where(~excluded)


def exclude_listed(files: DataFrame, listed: DataFrame, path: str = "file") -> DataFrame:
    """:func:`exclude_files` for a table of exact paths of any size.

    The paths are not made distinct: an anti-join does not mind, and with two plain
    shuffles below it Spark can split a path that fills a partition.
    """
    return files.join(listed.select(path), path, "left_anti")


def rank_files(files: DataFrame, path: str = "file", arg: str = "arg") -> DataFrame:
    """One row per path with its earliest ``file_rank``; a path reached twice counts once."""
    return files.groupBy(path).agg(F.min(rank_of(F.col(path), F.col(arg))).alias("file_rank"))


def _names_json_file(path: str) -> bool:
    return path.lower().endswith(".json")


def read_arguments(
    spark: SparkSession,
    paths: Sequence[str],
    read,
    recursive: bool,
    missing_ok: bool = True,
) -> DataFrame:
    """Union of ``read(path, options)`` over the arguments, tagged with ``arg``.

    An argument ending in ``.json`` is a file, any other a folder, searched for
    ``*.json``. Hidden names (leading ``.`` or ``_``) are never listed by Spark.
    """
    parts = []
    for arg, path in enumerate(paths):
        if _names_json_file(path):
            target, options = path, {}
        elif recursive:
            target, options = path, {"recursiveFileLookup": "true", "pathGlobFilter": "*.json"}
        else:
            target, options = path.rstrip("/") + "/*.json", {}
        try:
            parts.append(read(target, options).withColumn("arg", F.lit(arg)))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or not missing_ok:
                raise
    if not parts:
        raise NoInputFiles(f"no JSON file under {list(paths)}")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def select_files(
    spark: SparkSession,
    paths: Sequence[str],
    recursive: bool = False,
    exclude: Sequence[str] = (),
    exclude_paths: Sequence[str] = (),
) -> DataFrame:
    """Files to process as ``(file, file_rank)``; contents are not read."""
    def read(target, options):
        return (
            spark.read.format("binaryFile").options(**options).load(target)
            .select(plain_path(F.col("_metadata.file_path")).alias("file"))
        )

    listed = read_arguments(spark, paths, read, recursive)
    return rank_files(exclude_files(listed, exclude, exclude_paths))

"""Earlier output as input."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_checkpoint(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of an earlier run; empty when there is none.

    A checkpoint counts as a whole: a damaged file in it raises when it is read, since
    going on without its records would do work again and lose results without a word.
    """
    try:
        return spark.read.schema(schema).option("ignoreCorruptFiles", "false").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

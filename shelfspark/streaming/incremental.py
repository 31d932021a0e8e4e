"""De-duplication and extraction that go on where the last run stopped.

State is a table, not the state store: keys never expire, so the store would grow
without bound in executor memory. Each micro-batch writes ``run=<id>/batch=<id>`` folders
with overwrite, and reads only what other batches wrote; a batch replayed after a failure
therefore neither sees its own keys nor writes anything twice. The run is the one whose
progress the checkpoint folder holds. Should that folder be lost, the next run has another
id: it writes beside the batches there are, and all of them count as earlier ones.

Below a batch, rows are kept by the first digits of their key's digest, so a batch reads the
earlier keys of those prefixes only that it has itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfspark.operators.dedup import dedup_first_wins
from shelfspark.session import staged, unstage

RUN, BATCH, PREFIX = "run", "batch", "key_prefix"
PREFIX_DIGITS = 2
_DIRECT = "direct"


def key_prefix(key: str) -> Column:
    """First hex digits of a key's digest; rows without a key share one prefix."""
    return F.coalesce(F.substring(F.sha1(F.col(key).cast("binary")), 1, PREFIX_DIGITS), F.lit("none"))


def run_id(spark: SparkSession) -> str:
    """Id of the streaming query that is at work, the same after a restart from its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or _DIRECT


def _table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    places = [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType()), T.StructField(PREFIX, T.StringType())]
    full = T.StructType([*schema.fields, *places])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows written so far, with the batch that wrote them."""
    return _table(spark, path, schema).drop(RUN, PREFIX)


def earlier_batches(spark: SparkSession, path: str, schema: T.StructType, batch_id: int, prefixes: list[str]) -> DataFrame:
    """Rows of other runs and of this run's earlier batches under the given key prefixes; the
    folders of all others are pruned, not scanned."""
    table = _table(spark, path, schema)
    earlier = (F.col(RUN) != run_id(spark)) | (F.col(BATCH) < batch_id)
    return table.where(earlier & F.col(PREFIX).isin(prefixes)).drop(RUN, BATCH, PREFIX)


def _prefixes(batch: DataFrame, key: str) -> list[str]:
    """The prefixes of a batch's keys: 256 at most."""
    return [r[0] for r in batch.where(F.col(key).isNotNull()).select(key_prefix(key)).distinct().collect()]


def _unseen(new: DataFrame, batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is not among the (many) earlier ones.

    The earlier keys are first reduced to those the (small) batch has, so that they are
    scanned but not shuffled while the batch fits a broadcast.
    """
    hits = seen.join(batch.select(key).distinct(), key, "left_semi").distinct()
    return new.join(hits, key, "left_anti")


def _write_batch(df: DataFrame, path: str, batch_id: int, key: str) -> None:
    folder = f"{path}/{RUN}={run_id(df.sparkSession)}/{BATCH}={batch_id}"
    placed = df.withColumn(PREFIX, key_prefix(key)).repartition(PREFIX)
    placed.write.mode("overwrite").partitionBy(PREFIX).parquet(folder)


def dedup_batch(
    output: str, key: str = "key_id", file: str = "file_rank", pos: str = "pos"
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for first-wins de-duplication across batches.

    A key kept by an earlier batch always wins; within a batch the first by ``(file, pos)``
    does. The batch is read once, and reduced to one row per key before it meets the
    earlier keys, of which only the key column is read.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        kept = f"{output}/kept"
        rows = staged(batch, "stream-batch")
        earlier = earlier_batches(batch.sparkSession, kept, batch.schema, batch_id, _prefixes(rows, key))
        known = earlier.where(F.col(key).isNotNull()).select(key)
        winners = dedup_first_wins(rows, key, file, pos)
        # one row per key on both sides; rows without a key match nothing and stay
        _write_batch(_unseen(winners, rows, known, key), kept, batch_id, key)
        unstage(rows)

    return run


def resume_batch(
    output: str,
    process: Callable[[DataFrame], DataFrame],
    schema: T.StructType,
    url: str = "url",
    order: str = "line_no",
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that processes each URL until it has succeeded once.

    ``process`` gets distinct URLs not yet done and returns rows of ``schema`` with
    ``url`` and ``status``, which are appended under ``results``. A URL that failed is
    tried again when it arrives again.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        results = f"{output}/results"
        first = staged(batch.groupBy(url).agg(F.min(order).alias(order)), "stream-batch")
        earlier = earlier_batches(batch.sparkSession, results, schema, batch_id, _prefixes(first, url))
        done = earlier.where(F.col("status") == "ok").select(url)
        new = _unseen(first, first, done, url)
        _write_batch(process(new).select(schema.names), results, batch_id, url)
        unstage(first)

    return run


def run_available(
    stream: DataFrame, batch_function: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process everything that has arrived since the last run, then stop."""
    query = (
        stream.writeStream.foreachBatch(batch_function)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query

"""First-wins de-duplication of a stream whose earlier keys are in the state store.

The state is one row per key: the first row of the batch that brought it, and when it first
and last came. It is a streaming aggregate, so a batch's rows are partly aggregated before they
are shuffled, and a key that a third of a batch has is one row per task. The store is RocksDB:
keys lie on the executors' disks and in the checkpoint folder, not in memory.

The state grows with the keys; they have no end of life. Where a table of keys that other jobs
read is wanted, or runs are far apart, :mod:`shelfspark.streaming.keytable` keeps it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfspark.streaming.incremental import BATCH, RUN, run_id

ROCKS_DB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside; they keep them."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def first_arrivals(
    stream: DataFrame, key: str = "key_id", file: str = "file_rank", pos: str = "pos", carry: Sequence[str] = ()
) -> DataFrame:
    """The rows that bring a key no earlier batch has brought, the first of a batch by
    ``(file, pos)``, and all rows without a key: ``key``, ``file``, ``pos`` and ``carry``.

    To be written in update mode. A key is given out by the one batch whose time is both the
    first and the last at which it came, so a clock that was put back repeats none.
    """
    now, place = F.current_timestamp(), (file, pos, *carry)
    timed = stream.where(F.col(key).isNotNull()).withColumn("_now", now)
    keys = timed.groupBy(key).agg(
        F.min(F.struct(*place)).alias("first"), F.min("_now").alias("since"), F.max("_now").alias("last")
    )
    new = keys.where((F.col("since") == F.col("last")) & (F.col("last") == now)).select(key, "first.*")
    return new.unionByName(stream.where(F.col(key).isNull()).select(key, *place))


def dedup_with_state(
    stream: DataFrame, output: str, checkpoint: str, key: str = "key_id", file: str = "file_rank", pos: str = "pos",
    carry: Sequence[str] = (),
) -> StreamingQuery:
    """Write the first arrivals of all that has come since the last run, then stop.

    Each batch writes a folder of its own under ``output``/kept, by overwriting, so a batch
    that runs again after a failure writes nothing twice. :func:`read_batches` reads them.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/kept/{RUN}={run_id(batch.sparkSession)}/{BATCH}={batch_id}")

    with settings(stream.sparkSession, ROCKS_DB):
        query = (
            first_arrivals(stream, key, file, pos, carry).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    query.awaitTermination()
    return query

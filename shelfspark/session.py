"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # sort-merge becomes hash join at run time where every partition of a side is this small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # JSON objects that repeat a key keep the last value
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(
    app_name: str = "shelfspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators expect.

    Leave ``shuffle_partitions`` unset on a cluster whose defaults already fit
    its size; AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application: they need not have it installed,
    nor be started from its folder. The archive is served by the driver."""
    context = spark.sparkContext
    if not getattr(context, "_ships_shelfspark", False):
        package = os.path.dirname(os.path.abspath(__file__))
        name = os.path.join(tempfile.mkdtemp(prefix="shelfspark-ship-"), "shelfspark")
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        context._ships_shelfspark = True


def require_settings(spark: SparkSession) -> None:
    """Raise unless JSON objects that repeat a key can be read; :func:`build_session` sees to that."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        raise ValueError("set spark.sql.variant.allowDuplicateKeys to true")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """New folder name under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder;
    a cluster session without it is an error, since executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="shelfspark-")
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Several outputs can then be derived from one parse of the input, and a lost
    executor costs a re-read of the table rather than a re-run of the parse.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove the folder of a staged table, through the file system that holds it."""
    spark = df.sparkSession
    for uri in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

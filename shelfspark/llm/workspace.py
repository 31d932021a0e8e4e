"""Tables that a job writes to the shared folder and removes again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfspark.session import scratch_dir


class Workspace:
    """A folder under ``spark.checkpoint.dir`` for one job's intermediate tables.

    ``put`` writes a table and reads it back, which cuts its lineage: a lost executor costs
    a re-read. ``drop`` removes tables that nothing reads any more, ``clear`` all but the
    ones named.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.made = spark, scratch_dir(spark, label), 0
        self.tables: list[tuple[DataFrame, str]] = []

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}/{self.made:04d}-{name}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((back, path))
        return back

    def _remove(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def drop(self, *tables: DataFrame) -> None:
        """Remove these tables."""
        for df, path in self.tables:
            if any(df is x for x in tables):
                self._remove(path)
        self.tables = [(df, path) for df, path in self.tables if not any(df is x for x in tables)]

    def clear(self, *keep: DataFrame) -> None:
        """Remove every table but these."""
        self.drop(*(df for df, _ in self.tables if not any(df is x for x in keep)))

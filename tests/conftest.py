import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        shuffle_partitions=8,
        extra={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Makes ``(file, file_rank, doc)`` rows from a dict of file name to text."""
    from pyspark.sql import functions as F

    from shelfspark.sources.files import rank_of

    def make(texts):
        df = spark.createDataFrame(list(texts.items()), "file string, doc string")
        return df.withColumn("file_rank", rank_of(F.col("file")))

    return make

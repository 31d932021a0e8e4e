"""Incremental jobs: arrival in parts, replays, retries."""

import pytest
from pyspark.sql import functions as F

from shelfspark.streaming.incremental import (
    dedup_batch,
    earlier_batches,
    key_prefix,
    read_batches,
    resume_batch,
    run_available,
)

ROWS = "file_rank string, pos int, key_id string"


def arrive(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")


def test_dedup_over_runs_equals_one_run(spark, folders):
    source, out, progress = folders
    waves = [
        [("f1", 0, "a"), ("f1", 1, "a"), ("f1", 2, None), ("f1", 3, "b")],
        [("f2", 0, "c"), ("f2", 1, "a"), ("f3", 0, "c"), ("f2", 2, "c")],
        [("f4", 0, None), ("f4", 1, "d"), ("f4", 2, "b"), ("f0", 9, "a")],
    ]
    for wave in waves:
        arrive(spark, wave, ROWS, source)
        run_available(spark.readStream.schema(ROWS).parquet(source), dedup_batch(out), progress)
    schema = spark.createDataFrame([], ROWS).schema
    kept = read_batches(spark, f"{out}/kept", schema)
    got = sorted((r.file_rank, r.pos, r.batch) for r in kept.collect())
    assert got == [("f1", 0, 0), ("f1", 2, 0), ("f1", 3, 0), ("f2", 0, 1), ("f4", 0, 2), ("f4", 1, 2)]
    # nothing new: nothing happens
    run_available(spark.readStream.schema(ROWS).parquet(source), dedup_batch(out), progress)
    assert read_batches(spark, f"{out}/kept", schema).count() == 6


def test_replayed_batch_gives_the_same(spark, folders):
    _, out, _ = folders
    run = dedup_batch(out)
    first = spark.createDataFrame([("f1", 0, "a"), ("f1", 1, "b")], ROWS)
    second = spark.createDataFrame([("f2", 0, "a"), ("f2", 1, "c")], ROWS)
    run(first, 0)
    run(second, 1)
    run(second, 1)
    run(first, 0)
    kept = read_batches(spark, f"{out}/kept", first.schema).collect()
    assert sorted((r.file_rank, r.pos) for r in kept) == [("f1", 0), ("f1", 1), ("f2", 1)]


def test_resume_retries_failures_only(spark, folders):
    source, out, progress = folders
    schema = "url string, line_no bigint"
    result = spark.createDataFrame([], "url string, line_no bigint, status string").schema
    broken = {"names": ["u2", "u3"]}

    def process(new):
        return new.withColumn("status", F.when(F.col("url").isin(broken["names"]), "empty").otherwise("ok"))

    def run():
        run_available(spark.readStream.schema(schema).parquet(source), resume_batch(out, process, result), progress)
        rows = read_batches(spark, f"{out}/results", result).collect()
        return sorted((r.batch, r.url, r.line_no, r.status) for r in rows)

    arrive(spark, [("u1", 1), ("u2", 2), ("u1", 3)], schema, source)
    assert run() == [(0, "u1", 1, "ok"), (0, "u2", 2, "empty")]
    broken["names"] = ["u3"]
    arrive(spark, [("u2", 4), ("u1", 5), ("u3", 6)], schema, source)
    assert run()[2:] == [(1, "u2", 4, "ok"), (1, "u3", 6, "empty")]


def test_resume_in_small_batches(spark, folders):
    source, out, progress = folders
    schema = "url string, line_no bigint"
    result = spark.createDataFrame([], "url string, line_no bigint, status string").schema
    for wave in ([("u1", 1), ("u2", 2)], [("u2", 3), ("u3", 4)], [("u1", 5), ("u3", 6), ("u4", 7)]):
        arrive(spark, wave, schema, source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    run_available(stream, resume_batch(out, lambda new: new.withColumn("status", F.lit("ok")), result), progress)
    rows = read_batches(spark, f"{out}/results", result).collect()
    assert sorted(r.url for r in rows) == ["u1", "u2", "u3", "u4"]
    assert len({r.batch for r in rows}) > 1


def test_lost_progress_neither_loses_nor_repeats_rows(spark, folders):
    source, out, progress = folders
    schema = spark.createDataFrame([], ROWS).schema
    arrive(spark, [("f1", 0, "a"), ("f1", 1, "b")], ROWS, source)
    run_available(spark.readStream.schema(ROWS).parquet(source), dedup_batch(out), progress)
    arrive(spark, [("f2", 0, "a"), ("f2", 1, "c")], ROWS, source)
    run_available(spark.readStream.schema(ROWS).parquet(source), dedup_batch(out), progress + "-new")
    kept = read_batches(spark, f"{out}/kept", schema).collect()
    assert sorted((r.file_rank, r.pos) for r in kept) == [("f1", 0), ("f1", 1), ("f2", 1)]


def test_only_the_prefixes_of_a_batch_are_read(spark, folders):
    _, out, _ = folders
    run = dedup_batch(out)
    run(spark.createDataFrame([("f1", i, f"k{i}") for i in range(200)], ROWS), 0)
    schema = spark.createDataFrame([], ROWS).schema
    one = spark.createDataFrame([("f2", 0, "k7")], ROWS)
    wanted = [r[0] for r in one.select(key_prefix("key_id")).collect()]
    earlier = earlier_batches(spark, f"{out}/kept", schema, 1, wanted)
    assert 0 < len(set(earlier.select("key_id").collect())) < 20
    assert "PartitionFilters" in earlier._jdf.queryExecution().executedPlan().toString()
    run(one, 1)
    assert read_batches(spark, f"{out}/kept", schema).count() == 200

"""Outputs in versions, damage found by count and checksum, and extraction as a stream."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfspark.operators.metrics import file_metrics, metrics_rollup, rolled_files, rolled_totals, run_totals
from shelfspark.plans.detail import detail_version
from shelfspark.sources.manifest import StaleVersion
from shelfspark.sources.versions import NoTable, VersionedOutput
from shelfspark.streaming import extraction
from shelfspark.streaming.extraction import extract_available, extraction_batch, final_records, run_counts
from shelfspark.streaming.observed import observed_counts

HOST = "https://books.example"


def numbers(spark, n, add=0):
    return spark.range(n).select("id", (F.col("id") % 7 + add).alias("v"), F.array("id").alias("a"))


def page(i, title="T"):
    return f'<html><head><title>[ {title} {i} ] A </title></head><body><h1 class="nomargin">{title} {i}</h1></body></html>'


def test_tables_appear_together(spark, tmp_path):
    out = VersionedOutput(spark, str(tmp_path))
    assert out.latest() == 0
    with pytest.raises(NoTable):
        out.read("a")
    assert out.save(a=numbers(spark, 10), b=numbers(spark, 3)) == 1
    waiting = out.write(numbers(spark, 20))
    assert out.read("a").count() == 10
    assert out.publish({"a": [*out.parts("a"), waiting]}, after=1) == 2
    assert out.read("a").count() == 30 and out.read("b").count() == 3 and out.read("a", 1).count() == 10
    with pytest.raises(StaleVersion):
        out.publish({"a": [waiting]}, after=1)


def test_old_versions_go_with_their_folders(spark, tmp_path):
    out = VersionedOutput(spark, str(tmp_path), keep=2)
    for i in range(5):
        out.save(a=numbers(spark, i + 1))
    assert len(os.listdir(tmp_path / "data")) == 2 and out.read("a", 4).count() == 4 and out.read("a").count() == 5


@pytest.mark.parametrize("harm", ["cut", "gone", "changed", "twice", "none"])
def test_damage_is_found_and_counts_as_absent(spark, tmp_path, harm):
    out = VersionedOutput(spark, str(tmp_path))
    out.save(a=numbers(spark, 100).repartition(3))
    files = glob.glob(f"{tmp_path}/data/*/part-*.parquet")
    if harm == "cut":
        data = open(files[0], "rb").read()
        open(files[0], "wb").write(data[: len(data) // 2])
    elif harm == "gone":
        os.remove(files[0])
    elif harm in ("changed", "twice"):
        other = numbers(spark, 100, 1) if harm == "changed" else numbers(spark, 100).union(numbers(spark, 1))
        out.publish({"a": [{**out.parts("a")[0], "folder": out.write(other)["folder"]}]})
    for crc in glob.glob(f"{tmp_path}/data/*/.*.crc"):
        os.remove(crc)
    if harm == "none":
        loaded = out.load("a", "id long")
        assert loaded.reason is None and loaded.rows.count() == 100
        return
    with pytest.warns(UserWarning, match="counts as absent"):
        loaded = out.load("a", "id long, v long, a array<long>")
    assert loaded.reason and loaded.rows.count() == 0
    assert out.load("b", "id long").rows.count() == 0 and out.load("b", "id long").reason is None


def test_a_damaged_earlier_run_is_done_again(spark, tmp_path):
    (tmp_path / "urls.txt").write_text("/book1.html\n/book2.html\n")
    pages = spark.createDataFrame([(f"{HOST}/book{i}.html", page(i)) for i in (1, 2)], "url string, html string")
    out = VersionedOutput(spark, str(tmp_path / "out"))
    assert detail_version(spark, str(tmp_path / "urls.txt"), pages, out, HOST) == 1
    assert detail_version(spark, str(tmp_path / "urls.txt"), pages, out, HOST) == 1
    assert out.read("books").count() == 2 and out.notes()["earlier_records"] is None
    out.publish({"books": [{**out.parts("books")[0], "checksum": 5}]})
    with pytest.warns(UserWarning, match="checksum"):
        assert detail_version(spark, str(tmp_path / "urls.txt"), pages, out, HOST, run=2) == 3
    assert out.read("books").count() == 2 and "checksum" in out.notes()["earlier_records"]
    assert out.read("metrics").first().processed_new == 2


def test_extraction_over_runs_and_replays(spark, tmp_path):
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    out = VersionedOutput(spark, str(tmp_path / "out"), keep=3)
    stored = {1: page(1), 2: "", 4: page(4)}

    def pages():
        return spark.createDataFrame([(f"{HOST}/book{i}.html", t) for i, t in stored.items()], "url string, html string")

    def arrive(*lines):
        rows = [(f"{HOST}/book{i}.html", n) for i, n in lines]
        spark.createDataFrame(rows, "url string, line_no long").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema("url string, line_no long").option("maxFilesPerTrigger", 1).parquet(source)
        extract_available(stream, pages, out, progress, HOST, max_attempts=2)
        opened = {(r.url[-10:], r.attempts, r.status) for r in out.read("open").collect()}
        return sorted(r.title for r in final_records(out).collect()), opened

    arrive((1, 1), (2, 2), (1, 3))
    arrive((3, 4), (1, 5))
    with observed_counts(spark) as seen:
        books, opened = run()
    assert seen.sums["arrived_urls"] == 5
    assert books == ["T 1"] and opened == {("book2.html", 1, "empty"), ("book3.html", 1, "empty")}
    stored[2] = page(2)
    arrive((4, 6))
    books, opened = run()
    assert books == ["T 1", "T 2", "T 4"] and opened == {("book3.html", 2, "empty")}
    stored[3] = page(3)
    arrive((5, 7), (4, 8))
    books, opened = run()
    # the third address has had its tries
    assert books == ["T 1", "T 2", "T 4"] and opened == {("book3.html", 2, "empty"), ("book5.html", 1, "empty")}
    row = run_counts(out).first()
    assert (row.total_input_urls, row.skipped_existing, row.processed_new, row.failed, row.total_processed) == (8, 2, 3, 2, 3)


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    out = VersionedOutput(spark, str(tmp_path / "out"))
    pages = spark.createDataFrame([(f"{HOST}/book1.html", page(1))], "url string, html string")
    batch = spark.createDataFrame([(f"{HOST}/book1.html", 1), (f"{HOST}/book2.html", 2)], "url string, line_no long")
    run = extraction_batch(out, lambda: pages, HOST, "r1")
    run(batch, 0)
    before = out.latest()
    run(batch, 0)
    assert out.latest() == before and run_counts(out).first().total_input_urls == 2


def test_folders_of_records_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(extraction, "MERGE_FOLDERS", 3)
    out = VersionedOutput(spark, str(tmp_path / "out"), keep=2)
    pages = spark.createDataFrame([(f"{HOST}/book{i}.html", page(i)) for i in range(6)], "url string, html string")
    run = extraction_batch(out, lambda: pages, HOST, "r1")
    for i in range(6):
        run(spark.createDataFrame([(f"{HOST}/book{i}.html", i)], "url string, line_no long"), i)
    assert len(out.parts("books")) <= 2 and out.read("books").count() == 6 and out.damage("books") is None


def test_rollup_equals_the_single_aggregates(spark):
    files = spark.createDataFrame(
        [("a", "ok", None, True, ["m"]), ("b", "ok", None, False, []), ("c", "error", None, False, []), ("d", "ok", "why", False, [])],
        "file_rank string, status string, skipped string, meta_removed boolean, keys array<string>",
    )
    items = spark.createDataFrame(
        [("a", 0, "k", 1), ("a", 1, "k", 2), ("b", 0, "k", 0), ("b", 1, None, 5), ("b", 2, "l", 0)],
        "file_rank string, pos int, key_id string, n_listed int",
    )
    for rows in (items, items.where("false")):
        rolled = metrics_rollup(files, rows)
        per_file = file_metrics(files, rows)
        assert sorted(map(tuple, rolled_files(rolled, files).collect())) == sorted(map(tuple, per_file.collect()))
        assert rolled_totals(rolled).collect() == run_totals(per_file).collect()
    empty = metrics_rollup(files.where("false"), items.where("false"))
    assert rolled_totals(empty).collect() == run_totals(file_metrics(files.where("false"), items.where("false"))).collect()

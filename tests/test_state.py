"""De-duplication by the state store and by a merged key table, against one pass over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from shelfspark.streaming import keytable
from shelfspark.streaming.incremental import read_batches, run_available
from shelfspark.streaming.keytable import KeyTable, dedup_into
from shelfspark.sources.manifest import Manifest, StaleVersion
from shelfspark.streaming.stateful import dedup_with_state

ROWS = "file_rank string, pos int, key_id string"


def schema_of(spark):
    return spark.createDataFrame([], ROWS).schema


def arrive(spark, rows, folder):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(folder)


def kept(waves):
    """First of each key by arrival, then place; all rows without a key."""
    seen, out = set(), []
    for wave in waves:
        now = set()
        for file, pos, key in sorted(wave, key=lambda r: r[:2]):
            if key is None or key not in seen | now:
                out.append((file, pos))
            now.add(key)
        seen |= now
    return sorted(out)


WAVES = [
    [("f1", 0, "a"), ("f1", 1, "a"), ("f1", 2, None), ("f1", 3, "b")],
    [("f2", 0, "c"), ("f2", 1, "a"), ("f3", 0, "c"), ("f2", 2, "c")],
    [("f4", 0, None), ("f4", 1, "d"), ("f4", 2, "b"), ("f0", 9, "a")],
]


def test_state_over_restarts_equals_plain(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for wave in WAVES:
        arrive(spark, wave, source)
        dedup_with_state(spark.readStream.schema(ROWS).parquet(source), out, progress)
    found = read_batches(spark, f"{out}/kept", schema_of(spark))
    assert sorted((r.file_rank, r.pos) for r in found.collect()) == kept(WAVES)
    dedup_with_state(spark.readStream.schema(ROWS).parquet(source), out, progress)
    assert found.count() == len(kept(WAVES))
    assert (tmp_path / "progress" / "state").exists()


def test_state_of_a_hot_key_is_aggregated_before_the_shuffle(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = [(f"f{i:03d}", i, "hot" if i % 3 else f"k{i}") for i in range(300)]
    arrive(spark, rows, source)
    query = dedup_with_state(spark.readStream.schema(ROWS).parquet(source), out, progress)
    found = read_batches(spark, f"{out}/kept", schema_of(spark)).collect()
    assert sorted((r.file_rank, r.pos) for r in found) == kept([rows])
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 101


def test_key_table_over_runs_equals_plain(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    table = KeyTable(spark, out, schema_of(spark))
    for wave in WAVES:
        arrive(spark, wave, source)
        run_available(spark.readStream.schema(ROWS).parquet(source), dedup_into(table), progress)
    assert sorted((r.file_rank, r.pos) for r in table.rows().collect()) == kept(WAVES)


def test_many_small_batches_stay_in_few_files(spark, tmp_path, monkeypatch):
    """Merged levels, replays of old and new batches, few pieces opened, old files gone."""
    monkeypatch.setattr(keytable, "FAN_OUT", 3)
    monkeypatch.setattr(keytable, "PIECE_ROWS", 20)
    rng = random.Random(2)
    waves = [[(f"f{b:02d}", i, rng.choice([None, f"k{rng.randrange(400)}"])) for i in range(12)] for b in range(24)]
    table = KeyTable(spark, str(tmp_path / "t"), schema_of(spark))
    run = dedup_into(table)
    for b, wave in enumerate(waves):
        run(spark.createDataFrame(wave, ROWS), b)
    expected = kept(waves)
    assert sorted((r.file_rank, r.pos) for r in table.rows().collect()) == expected
    segments = table.segments()
    assert len(segments) <= 3 * 4 and max(s["level"] for s in segments) >= 2 and any(s["digits"] for s in segments)
    live = {s["id"] for v in table.manifest.versions() for s in table.manifest.read(v)[1]["segments"]}
    assert {p.name for p in (tmp_path / "t" / "rows").iterdir()} == live
    for b in (0, 5, 22, 23):
        run(spark.createDataFrame(waves[b], ROWS), b)
    assert sorted((r.file_rank, r.pos) for r in table.rows().collect()) == expected
    new = spark.createDataFrame([("z", i, f"new{i}") for i in range(4)], ROWS)
    assert len(table.pieces_to_open(new.select("key_id"), [s for s in table.segments() if s["keyed"]])) <= 2
    old = spark.createDataFrame([(None, 0, k) for _, _, k in waves[0] if k][:1], ROWS)
    assert table.pieces_to_open(old.select("key_id"), [s for s in table.segments() if s["keyed"]])


def test_filters_name_every_piece_that_has_a_key(spark, tmp_path):
    table = KeyTable(spark, str(tmp_path), schema_of(spark))
    table.append(spark.createDataFrame([("f", i, f"k{i}") for i in range(500)], ROWS), "r", 0)
    for i in (0, 77, 499):
        one = spark.createDataFrame([("g", 0, f"k{i}")], ROWS)
        assert table.new_rows(one, "r", 1).count() == 0
    others = spark.createDataFrame([("g", i, f"x{i}") for i in range(200)], ROWS)
    assert table.new_rows(others, "r", 1).count() == 200


def test_two_writers_of_one_version(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"), keep=2)
    assert manifest.read() == (0, {})
    manifest.commit(0, {"a": 1})
    with pytest.raises(StaleVersion):
        manifest.commit(0, {"a": 2})
    assert manifest.read() == (1, {"a": 1})
    for v in range(1, 5):
        manifest.commit(v, {"a": v})
    assert [held["a"] for held in manifest.forget()] == [1, 1, 2]
    assert manifest.versions() == [4, 5] and manifest.read(4)[1] == {"a": 3}


def test_a_reader_of_a_version_keeps_it(spark, tmp_path):
    table = KeyTable(spark, str(tmp_path), schema_of(spark))
    table.append(spark.createDataFrame(WAVES[0], ROWS), "r", 0)
    first, _ = table.manifest.read()
    before = table.rows(first)
    table.append(spark.createDataFrame(WAVES[1], ROWS), "r", 1)
    assert before.count() == 4 and table.rows().count() == 8
    assert table.batches().groupBy("batch").count().orderBy(F.col("batch")).collect()[1]["count"] == 4

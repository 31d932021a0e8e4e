"""One JSON array read in many splits against the whole-document scan and Python."""

import json
import random

import pytest

from shelfspark.sources.json_docs import explode_items, parse_documents, scan_json_documents, unwrap_books
from shelfspark.sources.json_splits import array_pieces, scan_json_array
from shelfspark.sources.sinks import document_lines, write_json_array
from shelfspark.streaming.stateful import settings

SMALL = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1"}


def value(rng, depth):
    roll = rng.random()
    if depth and roll < 0.3:
        return {rng.choice('abc"\\,[]{}é') + str(i): value(rng, depth - 1) for i in range(rng.randrange(4))}
    if depth and roll < 0.5:
        return [value(rng, depth - 1) for _ in range(rng.randrange(4))]
    if roll < 0.8:
        return "".join(rng.choice('ab,"\\[]{}\n é😀') for _ in range(rng.randrange(12)))
    return rng.choice([1, None, True, 2.5, -1e9])


@pytest.mark.parametrize(("n", "indent", "ends"), [(3000, None, ""), (300, 1, "\n"), (1, None, "\n"), (0, None, " ")])
def test_random_arrays(spark, tmp_path, n, indent, ends):
    rng = random.Random(n)
    values = [value(rng, 3) for _ in range(n)]
    path = tmp_path / "a.json"
    path.write_text(" \n" + json.dumps(values, ensure_ascii=False, indent=indent) + ends)
    with settings(spark, SMALL):
        blocks = array_pieces(spark, str(path)).select("block").distinct().count()
        rows = sorted(scan_json_array(spark, str(path)).collect(), key=lambda r: r.pos)
    assert blocks > 10 or n < 3000
    assert [r.pos for r in rows] == list(range(n)) and [json.loads(r.raw) for r in rows] == values
    assert [r.is_object for r in rows] == [isinstance(v, dict) for v in values]


def test_equals_the_whole_document_scan(spark, tmp_path):
    rng = random.Random(9)
    for name in ("x", "y"):
        values = [value(rng, 2) for _ in range(400)]
        (tmp_path / f"{name}.json").write_text(json.dumps(values, separators=(",", ":"), ensure_ascii=False))
    whole = explode_items(unwrap_books(parse_documents(scan_json_documents(spark, [str(tmp_path)])), "clean"))
    with settings(spark, SMALL):
        split = scan_json_array(spark, f"{tmp_path}/*.json").collect()

    def values_of(rows):
        return sorted(((r.file, r.file_rank, r.pos, r.is_object, json.loads(r.raw)) for r in rows), key=lambda x: x[:3])

    assert values_of(split) == values_of(whole.collect())


def test_reads_what_the_array_sink_writes(spark, tmp_path):
    items = spark.range(0, 500, 1, 7).selectExpr("'f' AS file_rank", "id AS pos", """concat('{"a":"x,', id, '","b":[1,2]}') AS raw""")
    write_json_array(items, str(tmp_path / "out"))
    with settings(spark, SMALL):
        rows = sorted(scan_json_array(spark, f"{tmp_path}/out/*", joined=True).collect(), key=lambda r: r.pos)
    assert [json.loads(r.raw)["a"] for r in rows] == [f"x,{i}" for i in range(500)]


@pytest.mark.parametrize("text", ['{"a":1}', "[1,2", "[1,]", "[1,,2]", "1", '["a]', "[1]]", "[1] 2", "[1}", "[,1]"])
def test_damaged_arrays_end_the_run(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="no JSON array"):
        scan_json_array(spark, str(tmp_path / "bad.json")).collect()


def test_items_longer_than_stretches(spark, tmp_path):
    rng = random.Random(5)
    values = [value(rng, 4) for _ in range(150)] + ['\\"' * 9 + ",[" * 20, [["{" + "\\" * i, i] for i in range(9)]] + [[]] * 5
    (tmp_path / "a.json").write_text(json.dumps(values, ensure_ascii=False))
    # two pieces of text to a stretch: strings, escapes and brackets stay open over its ends
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "2"}):
        pieces = array_pieces(spark, str(tmp_path / "a.json"))
        assert 0 < pieces.where("whole").count() < len(values)
        rows = sorted(scan_json_array(spark, str(tmp_path / "a.json")).collect(), key=lambda r: r.pos)
    assert [json.loads(r.raw) for r in rows] == values


@pytest.mark.parametrize("text", ["[1],2,[3]", "[1,2],[3,4]", '["a",1],["b"]', "1,2]", "[1]],[[2]"])
def test_commas_outside_the_array_end_the_run(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="no JSON array"):
        scan_json_array(spark, str(tmp_path / "bad.json")).collect()


def test_whole_items_are_not_shuffled(spark, tmp_path):
    items = spark.range(0, 20000, 1, 3).selectExpr("'f' AS file_rank", "id AS pos", """concat('{"a":"x,', id, '","b":[1,2]}') AS raw""")
    write_json_array(items, str(tmp_path / "out"))
    path = f"{tmp_path}/out/*"
    pieces = array_pieces(spark, path, joined=True)
    # a row per item and not one per comma; only the ends of stretches are put together
    assert pieces.count() < 20100
    assert pieces.where("NOT whole").count() < 100
    assert "Window" not in scan_json_array(spark, path, joined=True)._jdf.queryExecution().executedPlan().toString()


def test_first_item_of_one_document_is_broadcast(spark):
    items = spark.range(9).selectExpr("'d' AS file", "'f' AS file_rank", "id AS pos", "string(id) AS raw")
    edges = spark.createDataFrame([("d", "[", "]")], "file string, head string, tail string")
    lines = document_lines(items, edges, single=True)
    assert "SortMergeJoin" not in lines._jdf.queryExecution().executedPlan().toString()
    assert "".join(r.line for r in lines.orderBy("rank", "seq").collect()) == "[0,1,2,3,4,5,6,7,8]"

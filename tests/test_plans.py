"""Shape of physical plans: what must not come back."""

import os
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.bindings import all_queries
from shelfspark.operators.dedup import dedup_first_wins, dedup_richest, label_duplicates
from shelfspark.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_tables
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(all_queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # a window without partition columns prints an empty second bracket
    for window in re.findall(r"Window \[.*", text):
        assert not re.search(r"windowspecdefinition\(\w+#\d+\w* (ASC|DESC)", window), window


def test_no_window_over_a_key(spark):
    rows = spark.createDataFrame([("f", 0, "k", 1)], "file_rank string, pos int, key_id string, n_fields int")
    for df in (
        label_duplicates(rows),
        dedup_first_wins(rows),
        dedup_richest(rows.withColumnRenamed("key_id", "record_key")),
    ):
        assert "Window" not in plan(df) and "partial_" in plan(df)


@needs_tables
def test_a_document_is_parsed_once_per_pass(spark):
    text = plan(all_queries()["explode_items"](spark, SF_DIR))
    assert text.count("parseJson") == 1


@needs_tables
def test_costly_key_is_computed_once_per_side(spark):
    text = plan(all_queries()["dedup_first_wins"](spark, SF_DIR))
    assert text.count("sha2(") == 1


@needs_tables
def test_scans_read_only_needed_columns(spark):
    text = plan(all_queries()["cross_file_membership"](spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in text
    text = plan(all_queries()["exclude_listed"](spark, SF_DIR))
    assert "LessThan(c_acctbal,0.0)" in text
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", text)) == {
        "o_orderkey:bigint,o_custkey:bigint", "c_custkey:bigint,c_acctbal:double",
    }


@needs_tables
def test_both_marks_share_the_shuffle_by_key(spark):
    df = all_queries()["label_duplicates"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_scratch_dir_is_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root or "/tmp/")


def test_rows_are_shuffled_once_for_both_marks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).select(
            F.col("id").cast("string").alias("file_rank"), (F.col("id") + 1).alias("pos"), F.hex("id").alias("key_id"),
            F.repeat(F.lit("x"), 50).alias("raw"),
        )
        text = plan(label_duplicates(rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_row = re.findall(r"Exchange hashpartitioning\(file_rank#\d+, pos#\d+L?,", text)
    # the rows and the two tables of marks, each once
    assert text.count("SortMergeJoin") == 2 and len(by_row) == 3

"""The pipeline stage by stage, and the registered queries."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline

from oracle import compare, connect
from shelfspark.llm import decontaminate, near_dedup, toxicity
from shelfspark.llm.queries import ORACLE, QUERIES
from shelfspark.session import staged

SF_DIR = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(spark, given):
    docs, _ = given
    labels, items = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("labels", "benchmark"))
    rows = docs
    model = toxicity.fit_toxicity(docs, labels)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, staged(stage(spark, rows, SF_DIR), "stage")
        assert rows.columns == docs.columns
        assert rows.exceptAll(before).count() == 0
        gone = before.join(rows, "doc_id", "left_anti")
        if name == "toxicity":
            rejected = toxicity.toxicity_scores(before, model).where("predicted = 1").select("doc_id")
        elif name == "near_duplicates":
            rejected = near_dedup.near_duplicates(before).where("not kept").select("doc_id")
        elif name == "decontamination":
            rejected = decontaminate.benchmark_hits(before, items).select("doc_id").distinct()
        else:
            continue
        assert {r.doc_id for r in gone.collect()} == {r.doc_id for r in rejected.collect()}, name
    assert rows.count() > 0.2 * docs.count()
    tokens = corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR)
    assert tokens.count() == rows.count() and tokens.join(rows, "doc_id").count() == rows.count()


def test_run_gives_one_row_per_document_left(spark, given):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and 0 < found.count() <= given[0].count()
    ends = found.agg(F.max(F.col("start") + F.col("n_tokens")).alias("e"), F.sum("n_tokens").alias("s")).first()
    assert ends.e == ends.s


def test_pipeline_of_an_empty_table(spark, given):
    rows = given[0].where("false")
    for _, stage in corpus_pipeline.STAGES:
        rows = staged(stage(spark, rows, SF_DIR), "stage")
    assert rows.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, given, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_the_table(spark, given, name):
    found = QUERIES[name](spark, SF_DIR)
    if name in ("op11_prefix_trie", "op13_whitening"):
        assert found.count() > 0
        return
    assert "doc_id" in found.columns
    if name not in ("op3_secrets", "op8_decontamination"):
        assert found.count() == given[0].count()


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}


LONG = " ".join(f"word{i}" for i in range(60))


def test_near_duplicates_are_decided_by_row(spark):
    other = " ".join(f"other{i}" for i in range(60))
    rows = [
        (1, LONG), (5, LONG), (5, other), (5, other), (None, LONG), (None, LONG + " more"), (None, None), (None, ""), (7, None), (7, None), (8, "short text"),
        (9, "unlike " + other.replace("other", "x")), (None, "no id at all " + other.replace("other", "y")),
    ]
    docs = spark.createDataFrame([(*r, "en", "s", 0, 1, True) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept int, component_id boolean")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, LONG), (5, other), (None, None), (None, ""), (7, None), (7, None), (8, "short text"), rows[11], rows[12]], key=repr
    )


def test_stages_take_awkward_rows(spark, edges):
    rows = edges
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows
        rows = staged(stage(spark, rows, SF_DIR), "stage")
        assert rows.columns == edges.columns, name
        assert rows.exceptAll(before).count() == 0, name
        if name in ("toxicity", "decontamination"):
            assert rows.count() == before.count(), name
    assert corpus_pipeline.STAGES[-1][1](spark, rows, SF_DIR).count() == rows.where("doc_id is not null").count()

"""Every registered query against its SQL, some against plain Python too."""

import os

import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from shelfspark.bindings import all_oracles, all_queries
from shelfspark.bindings.tables import table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, all_queries()[name], all_oracles()[name], SF_DIR) == ""


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())


def test_exact_normalisation_equals_python(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    result = all_queries()["normalize_text_exact"](spark, SF_DIR).collect()
    assert {r.doc_id: r.norm for r in result} == {k: " ".join(v.split()).casefold() for k, v in texts.items()}


def test_pager_context_equals_python(spark):
    from shelfspark.bindings.listing_bindings import listing_pages

    expected = {}
    for row in listing_pages(spark, SF_DIR).select("p_partkey", "html").collect():
        place = row.html.find("Страницы")
        if place < 0:
            continue
        end = min(len(row.html), place + 1000)
        stop = row.html.find("</table>", place)
        end = stop + 8 if 0 < stop < end else end
        excerpt = row.html[max(0, place - 200):end]
        expected[row.p_partkey] = ("Страницы", excerpt[:500], excerpt[-200:])
    result = all_queries()["pager_context"](spark, SF_DIR).collect()
    assert {r.p_partkey: (r.word, r["head"], r.tail) for r in result} == expected


def test_entry(spark):
    import __spark_entry__ as entry_module

    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.queries()) >= set(all_queries())
    assert set(entry_module.oracle_sql()) >= set(all_oracles())


def test_columns_are_stable(spark):
    first = all_queries()["dedup_first_wins"](spark, SF_DIR)
    second = all_queries()["dedup_first_wins"](spark, SF_DIR)
    assert first.schema == second.schema
    assert first.where(F.col("doc_id").isNull()).count() == 0

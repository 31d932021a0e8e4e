"""Running totals and page taking against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import paging
from shelfspark.operators.paging import failed_pages, join_section, running_sum, running_totals, take_pages, tried_pages


def crawl(pages, max_pages):
    """Pages of one section in order -> those with records that a crawl would use."""
    used, known = [], None
    for page, n, total, ok in pages:
        if max_pages is not None and len(used) >= max_pages:
            break
        if not ok:
            continue
        if n == 0:
            break
        used.append(page)
        if known is None and total:
            known = total
        if known is not None and page + 1 >= known:
            break
    return used


def sections(seed, count=40):
    rng = random.Random(seed)
    rows = []
    for s in range(count):
        numbers = sorted(rng.sample(range(40), rng.randrange(1, 25)))
        for p in numbers:
            rows.append((f"s{s}", p, rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]), rng.choice([None, None, 0, rng.randrange(1, 45)]),
                         rng.random() > 0.15))
    return rows


SCHEMA = "base string, page int, n_books int, total_pages int, ok boolean"


@pytest.mark.parametrize("max_pages", [None, 0, 1, 5])
@pytest.mark.parametrize("seed", range(3))
def test_take_pages_equals_loop(spark, seed, max_pages):
    rows = sections(seed)
    got = {}
    for r in take_pages(spark.createDataFrame(rows, SCHEMA).repartition(4), max_pages).collect():
        got.setdefault(r.base, []).append(r.page)
    for base in {r[0] for r in rows}:
        expected = crawl(sorted(r[1:] for r in rows if r[0] == base), max_pages)
        assert sorted(got.get(base, [])) == expected, base


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_running_sum_does_not_depend_on_blocks(spark, block):
    rows = sections(7, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    out = running_sum(df, {"a": F.col("n_books"), "b": F.lit(1), "c": F.col("total_pages")}, block=block)
    for r in out.collect():
        before = [x for x in rows if x[0] == r.base and x[1] <= r.page]
        assert (r.a, r.b, r.c) == (sum(x[2] for x in before), len(before), sum(x[3] or 0 for x in before))
    assert out.count() == len(rows)


def test_running_totals(spark):
    df = spark.createDataFrame([("x", 0, 3), ("x", 1, 0), ("x", 5, 2), ("y", 2, 1)], "base string, page int, n_books int")
    got = {(r.base, r.page): (r.books_so_far, r.pages_done) for r in running_totals(df).collect()}
    assert got == {("x", 0): (3, 1), ("x", 1): (3, 2), ("x", 5): (5, 3), ("y", 2): (1, 1)}


def test_join_section_equals_join(spark):
    df = spark.createDataFrame(sections(8, 10), SCHEMA)
    per = df.groupBy("base").agg(F.max("page").alias("top")).where("top > 20")
    a, b = join_section(df, per, block=4), df.join(per, "base")
    assert a.select(b.columns).exceptAll(b).isEmpty() and a.count() == b.count()


def test_failed_pages(spark):
    df = spark.createDataFrame([(0, "u0", True, None), (4, "u4", False, "HTTP 500")], "page int, url string, ok boolean, error string")
    assert [tuple(r) for r in failed_pages(df).collect()] == [(5, "u4", "HTTP 500")]


@pytest.mark.parametrize("max_pages", [None, 0, 1, 4])
@pytest.mark.parametrize("block", [2, 1000])
def test_tried_pages_equal_the_loop(spark, max_pages, block, monkeypatch):
    monkeypatch.setattr(paging, "PAGE_BLOCK", block)
    rows = sections(11)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {}
    for r in tried_pages(df, max_pages).collect():
        found.setdefault(r.base, set()).add(r.page)
    taken = {}
    for r in take_pages(df, max_pages).collect():
        taken.setdefault(r.base, []).append(r.page)
    for base in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == base)
        used = crawl(own, max_pages)
        assert sorted(taken.get(base, [])) == used
        assert found.get(base, set()) == asked(own, max_pages), base


def asked(pages, max_pages):
    """Pages a crawl asks for, in order, up to the one it ends with."""
    out, used, known = set(), 0, None
    for page, n, total, ok in pages:
        if max_pages is not None and used >= max_pages:
            break
        out.add(page)
        if not ok:
            continue
        if n == 0:
            break
        used += 1
        known = known or total
        if known and page + 1 >= known:
            break
    return out


def test_pages_are_scanned_once_and_exchanged_once(spark, tmp_path):
    spark.createDataFrame(sections(3), SCHEMA).write.parquet(str(tmp_path / "p"))
    taken = take_pages(spark.read.parquet(str(tmp_path / "p")), 5)
    taken.collect()
    plan = taken._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # once narrow, once whole; what both uses of the narrow rows need is shuffled once
    assert plan.count("FileScan parquet") <= 2, plan
    assert "ReusedExchange" in plan

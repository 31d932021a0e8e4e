"""De-duplication against plain Python restatements, hot keys included."""

import random
import unicodedata

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfspark.functions.keys import key_mode, with_dedup_key
from shelfspark.functions.text import casefold, normalize_isbn, normalize_text, ws_trim
from shelfspark.operators.dedup import dedup_first_wins, dedup_richest, distinct_keep_order, label_duplicates
from shelfspark.operators.membership import (
    drop_already_added,
    merge_existing_new,
    resume_counts,
    resume_new_urls,
    url_plan,
)
from shelfspark.operators.metrics import file_metrics, merge_metrics, run_totals


def labels(rows, cross_file):
    """Rows sorted by file and position -> label of each."""
    out, before, here, file_now = {}, set(), set(), None
    for file, pos, key in sorted(rows, key=lambda r: r[:2]):
        if file != file_now:
            before, here, file_now = before | here, set(), file
        if key is None:
            out[file, pos] = "kept"
        elif key in here:
            out[file, pos] = "in_file"
        else:
            out[file, pos] = "cross_file" if cross_file and key in before else "kept"
            here.add(key)
    return out


def random_rows(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows shares one key, a sixth has none
        key = rng.choice(["hot", "hot", None] + [f"k{rng.randrange(80)}" for _ in range(3)])
        rows.append((f"f{rng.randrange(7)}", i, key))
    return rows


@pytest.mark.parametrize("cross_file", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_labels_equal_python(spark, seed, cross_file):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "file_rank string, pos int, key_id string").repartition(5)
    got = label_duplicates(df, cross_file=cross_file)
    expected = labels(rows, cross_file)
    assert {(r.file_rank, r.pos): r.label for r in got.collect()} == expected
    kept = dedup_first_wins(df, cross_file=cross_file).collect()
    assert {(r.file_rank, r.pos) for r in kept} == {k for k, v in expected.items() if v == "kept"}
    assert len(kept) == len({(r.file_rank, r.pos) for r in kept})


def test_cheap_key_flag_changes_nothing(spark):
    df = spark.createDataFrame(random_rows(9), "file_rank string, pos int, key_id string")
    flagged = df.withColumn("has_key", F.col("key_id").isNotNull())
    a = label_duplicates(df).select("file_rank", "pos", "label")
    b = label_duplicates(flagged, has_key="has_key").select("file_rank", "pos", "label")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    kept = dedup_first_wins(flagged, has_key="has_key")
    assert kept.count() == a.where("label = 'kept'").count()


@pytest.mark.parametrize("cross_file", [True, False])
def test_metrics_equal_labels(spark, cross_file):
    rng = random.Random(1)
    rows = [(*r, rng.randrange(4)) for r in random_rows(5)]
    items = spark.createDataFrame(rows, "file_rank string, pos int, key_id string, n_listed int")
    names = [f"f{i}" for i in range(8)]  # f7 has no items
    files = spark.createDataFrame(
        [(n, "ok", "why" if n == "f7" else None, n < "f3") for n in names],
        "file_rank string, status string, skipped string, meta_removed boolean",
    )
    expected = labels([r[:3] for r in rows], cross_file)
    per_file = file_metrics(files, items, cross_file)
    got = {r.file_rank: r for r in per_file.collect()}
    assert set(got) == set(names)
    for name in names:
        mine = [r for r in rows if r[0] == name]
        kinds = [expected[r[:2]] for r in mine]
        assert got[name].items_count == len(mine)
        assert got[name].duplicates_removed == kinds.count("in_file")
        assert got[name].cross_file_duplicates_removed == kinds.count("cross_file")
        assert got[name].books_count == kinds.count("kept")
        assert got[name].removed_count == sum(r[3] for r in mine)
    totals = run_totals(per_file).first()
    assert (totals.files_processed, totals.files_skipped, totals.meta_removed_files) == (7, 1, 3)
    assert totals.books_count == list(expected.values()).count("kept")


def test_merge_metrics_equal_labels(spark):
    rng = random.Random(2)
    rows = [(*r, rng.randrange(4)) for r in random_rows(6)]
    items = spark.createDataFrame(rows, "file_rank string, pos int, key_id string, n_listed int")
    files = spark.createDataFrame([("f0", True), ("f1", False)], "file_rank string, unwrapped boolean")
    expected = labels([r[:3] for r in rows], True)
    kinds = list(expected.values())
    m = merge_metrics(files, items).first()
    assert (m.files_count, m.unwrapped_files, m.items_read) == (2, 1, len(rows))
    assert (m.in_file_duplicates, m.cross_file_duplicates) == (kinds.count("in_file"), kinds.count("cross_file"))
    assert m.items_count == kinds.count("kept") == m.items_read - m.duplicates_removed
    assert m.fields_removed == sum(r[3] for r in rows if expected[r[:2]] == "kept")
    plain = merge_metrics(files, items, dedup=False, clean_fields=False).first()
    assert (plain.items_count, plain.duplicates_removed, plain.fields_removed) == (len(rows), 0, 0)


def test_metrics_of_nothing(spark):
    items = spark.createDataFrame([], "file_rank string, pos int, key_id string, n_listed int")
    files = spark.createDataFrame([("f0", True)], "file_rank string, unwrapped boolean")
    m = merge_metrics(files, items).first()
    assert (m.files_count, m.items_read, m.items_count, m.fields_removed) == (1, 0, 0, 0)


def test_richest_equals_python(spark):
    rng = random.Random(3)
    rows = [
        (i, rng.choice(["hot", "hot", "", None, f"k{rng.randrange(20)}", f"k{rng.randrange(20)}"]), rng.randrange(5))
        for i in range(400)
    ]
    best, first = {}, {}
    for pos, key, n in rows:
        if key:
            first.setdefault(key, pos)
            if key not in best or n > best[key][1]:
                best[key] = (pos, n)
    df = spark.createDataFrame(rows, "pos bigint, record_key string, n_fields int")
    got = {r.record_key: (r.pos, r.n_fields, r.first_seen) for r in dedup_richest(df).collect()}
    assert got == {k: (*best[k], first[k]) for k in best}


def test_distinct_and_resume(spark):
    lines = [(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, "b"), (6, "b"), (7, "d")]
    urls = spark.createDataFrame(lines, "line_no bigint, url string")
    done = spark.createDataFrame([("b",), ("b",), ("",), (None,), ("z",)], "url string")
    assert {(r.url, r.line_no, r.n_seen) for r in distinct_keep_order(urls).collect()} == {
        ("a", 1, 2), ("b", 2, 3), ("c", 4, 1), ("d", 7, 1),
    }
    assert {(r.url, r.line_no) for r in resume_new_urls(urls, done).collect()} == {("a", 1), ("c", 4), ("d", 7)}
    counts = resume_counts(url_plan(urls, done)).first()
    assert (counts.total_input_urls, counts.skipped_existing, counts.duplicate_urls, counts.to_process) == (7, 3, 1, 3)
    empty = resume_counts(url_plan(urls.limit(0), done)).first()
    assert tuple(empty) == (0, 0, 0, 0)


def test_drop_already_added(spark):
    new = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "old"), (4, ""), (5, None), (6, ""), (7, "b")], "pos bigint, detail_url string"
    )
    old = spark.createDataFrame([("old",), ("",)], "detail_url string")
    assert sorted(r.pos for r in drop_already_added(new, old).collect()) == [1, 4, 5, 6, 7]
    both = merge_existing_new(old, new)
    assert both.columns == ["detail_url", "gen", "pos"] and both.count() == 9


def keys_of(spark, rows, mode, exact=True):
    df = spark.createDataFrame(rows, "i int, isbn string, title string, author string, publisher string, year string")
    fields = {n: F.col(n) for n in ("isbn", "title", "author", "publisher", "year")}
    return {r.i: r.dedup_key and tuple(x for x in r.dedup_key if x is not None)
            for r in with_dedup_key(df, fields, mode, exact).collect()}


def test_dedup_keys(spark):
    rows = [
        (0, " 978-5 x\xa0", "t", "a", "p", "1"),
        (1, " - ", "T\xa0 t", " A ", "P", "1990"),
        (2, None, "t", "a", "　", "1"),
        (3, None, "t", "a", "p", None),
    ]
    four = "title-author-publisher-year"
    assert keys_of(spark, rows, "4") == {0: ("isbn", "9785X"), 1: (four, "t t", "a", "p", "1990"), 2: None, 3: None}
    assert keys_of(spark, rows, "isbn") == {0: ("isbn", "9785X"), 1: None, 2: None, 3: None}


def test_exact_keys_fold_sharp_s(spark):
    rows = [(0, None, "Straße", "a", "p", "1"), (1, None, "STRASSE", "a", "p", "1")]
    exact, fast = keys_of(spark, rows, "4"), keys_of(spark, rows, "4", False)
    assert exact[0] == exact[1] and fast[0] != fast[1]


def test_casefold_equals_python_on_all_letters(spark):
    # letters newer than Python's character database may be lower-cased by the JVM
    known = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) != "Cn"]
    df = spark.createDataFrame(pd.DataFrame({"c": known, "t": [chr(c) for c in known]}))
    rows = df.select("c", casefold(F.col("t")).alias("f")).toPandas()
    wrong = [c for c, f in zip(rows.c, rows.f, strict=True) if f != chr(c).casefold()]
    assert len(wrong) <= 2, wrong  # these two gained an upper or lower partner later
    words = ["ΟΔΟΣ Σ", "ﬁn ŉ", "ԵՒ և", "ꭰᎠ", "ẞß", "İI", "µ", "ΐᾳ", None, ""]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    assert [r[0] for r in df.select(casefold(F.col("t"))).collect()] == [w and w.casefold() for w in words]


def test_key_modes():
    assert key_mode(" 4FIELDS ") == "title-author-publisher-year" and key_mode("ISBN") == "isbn"
    with pytest.raises(ValueError, match="unknown"):
        key_mode("title")


def test_normalisation_equals_python(spark):
    rng = random.Random(4)
    alphabet = "aBЖщßΣǰ -\t\n\x1c\x1f\x85\xa0 　xX09"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(1500)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    t = F.col("t")
    rows = df.select("i", normalize_isbn(t).alias("n"), normalize_text(t).alias("x"), ws_trim(t).alias("w")).collect()
    for r in rows:
        text = texts[r.i]
        if text is None:
            assert (r.n, r.x, r.w) == (None, "", None)
            continue
        isbn = "".join(c for c in text.strip().upper() if c not in " -")
        assert r.n == (isbn or None)
        assert r.x == " ".join(text.split()).casefold()
        assert r.w == text.strip()


def test_rows_without_a_file_end_the_run(spark):
    rows = spark.createDataFrame([("f", 0, "k"), (None, 1, "k"), (None, 2, None)], "file_rank string, pos int, key_id string")
    for made in (dedup_first_wins(rows), label_duplicates(rows)):
        with pytest.raises(Exception, match="has no file_rank"):
            made.collect()


def test_richest_computes_its_key_once_per_use(spark):
    """The key's expression stands once in the aggregate's input and once in the joined rows."""
    rows = spark.range(50).select("id", F.sha2(F.concat(F.lit("k"), F.col("id") % 7), 256).alias("record_key"), (F.col("id") % 3).alias("n_fields"))
    best = dedup_richest(rows, order="id")
    assert best._jdf.queryExecution().executedPlan().toString().count("sha2(") <= 2
    assert {(r.id, r.first_seen) for r in best.collect()} == {
        (min((i for i in range(k, 50, 7)), key=lambda i: (-(i % 3), i)), k) for k in range(7)
    }

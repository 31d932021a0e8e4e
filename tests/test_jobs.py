"""Clean and merge jobs on small folders."""

import json

import pytest
from pyspark.sql import functions as F

from shelfspark.functions.records import DEFAULT_DROP_FIELDS, count_listed, drop_listed
from shelfspark.plans.clean import CleanJob, UnreadableDocuments, clean_files
from shelfspark.plans.merge import MergeJob, merge_files
from shelfspark.sources.files import NoInputFiles

NOVEL = {
    "title": "Степь", "author": "Чехов А.", "publisher": "Лань", "year": 1988, "isbn": "5-01-000001-x",
    "pages": 120, "detail_url": "/detail/book7.html", "book_id": 7, "in_stock": False, "image_thumb_url": None,
}
NOVEL_AGAIN = {
    "title": "Степь", "author": "Чехов А.", "publisher": "Лань", "year": 1988, "isbn": "5 01 000001 X",
    "pages": 120, "detail_url": "/detail/book8.html", "book_id": 8,
}
POEMS = {"title": "Лирика", "author": "Блок А.", "publisher": "Нева", "year": 1971, "isbn": None, "format": "70x90"}
POEMS_AGAIN = {
    "title": " лирика", "author": "БЛОК А.", "publisher": "Нева", "year": "1971", "isbn": " - ",
    "category_url": "/cat/poems/",
}
TALES = {
    "title": "Сказки", "author": "Даль В.", "publisher": "Лань", "year": 1990, "isbn": "5010000028", "has_image": True,
}


def write(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False, indent=1), encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.json", {"meta": {"n": 3}, "books": [NOVEL, NOVEL_AGAIN, POEMS]})
    write(source / "b.json", [POEMS_AGAIN, TALES])
    return source


def items_of(spark, values):
    rows = [("f", i, isinstance(v, dict), json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "file string, pos int, is_object boolean, raw string")


def records(df):
    return [json.loads(r.raw) for r in df.orderBy("file_rank", "pos").collect()]


def test_drop_listed_removes_only_listed_fields(spark):
    values = [NOVEL, "текст", POEMS, {"title": "без полей"}, None, [1, 2], 5]
    items = items_of(spark, values).withColumn("n", count_listed(F.col("is_object"), F.col("raw")))
    rows = items.orderBy("pos").collect()
    assert [r.n for r in rows] == [4, 0, 1, 0, 0, 0, 0]
    left = [json.loads(r.raw) for r in drop_listed(items, n_listed="n").orderBy("pos").collect()]
    assert left[0] == {k: v for k, v in NOVEL.items() if k not in DEFAULT_DROP_FIELDS}
    assert list(left[0]) == ["title", "author", "publisher", "year", "isbn", "pages"]
    assert left[1] == "текст" and left[4:] == [None, [1, 2], 5]
    assert left[2]["isbn"] is None and "format" not in left[2]


def test_repeated_keys_keep_the_last_value_everywhere(spark):
    raws = ['{"a":1,"a":2}', '{"a":1,"a":2,"format":"x"}', '{"a":1}', '[{"a":1,"a":2}]']
    items = spark.createDataFrame([(i, r[0] == "{", r) for i, r in enumerate(raws)], "pos int, is_object boolean, raw string")
    assert [r.raw for r in drop_listed(items).orderBy("pos").collect()] == ['{"a":2}', '{"a":2}', '{"a":1}', raws[3]]


def test_drop_listed_with_own_list(spark):
    items = items_of(spark, [{"title": "x", "format": "y", "book_id": 5}])
    assert json.loads(drop_listed(items, ["book_id"]).first().raw) == {"title": "x", "format": "y"}


def test_spelling_of_values_survives(spark):
    raw = '{"a":1.0,"b":[1.50,{"z":1,"y":"\\"й"}],"format":"x","c":12345678901234567890123,"d":"1.0","a":2.0}'
    items = spark.createDataFrame([(True, raw)], "is_object boolean, raw string")
    assert drop_listed(items).first().raw == (
        '{"a":2.0,"b":[1.50,{"z":1,"y":"\\"й"}],"c":12345678901234567890123,"d":"1.0"}'.replace("1.50", "1.5")
    )


def test_clean_one_document(docs):
    job = CleanJob(docs({"a.json": json.dumps({"meta": {"n": 2}, "books": [NOVEL, NOVEL_AGAIN]})}), "isbn")
    metrics = job.per_file.first()
    assert (metrics.status, metrics.removed_count, metrics.duplicates_removed, metrics.books_count) == ("ok", 6, 1, 1)
    assert metrics.meta_removed and metrics.meta_keys_removed == ["meta"]
    (kept,) = records(job.kept)
    assert kept["pages"] == 120 and "detail_url" not in kept


def test_merge_counts(spark, folder, tmp_path):
    job = merge_files(spark, str(folder), str(tmp_path / "out"), report=True)
    m = job.metrics.first()
    assert (m.files_count, m.items_read, m.unwrapped_files) == (2, 5, 1)
    assert (m.in_file_duplicates, m.cross_file_duplicates, m.duplicates_removed, m.items_count) == (1, 1, 2, 3)
    assert m.fields_removed == 6 and m.cleaned_fields
    merged = records(job.merged)
    assert [r["title"] for r in merged] == ["Степь", "Лирика", "Сказки"]
    assert sorted(merged[0]) == ["author", "isbn", "pages", "publisher", "title", "year"]
    written = spark.read.text(str(tmp_path / "out" / "records"))
    assert sorted(json.loads(r.value)["title"] for r in written.collect()) == ["Лирика", "Сказки", "Степь"]
    reasons = {r.reason: r for r in spark.read.json(str(tmp_path / "out/report/duplicates")).collect()}
    assert reasons["in_file"].key == ["isbn", "501000001X"] and reasons["in_file"].isbn == "5 01 000001 X"
    assert reasons["cross_file"].key == ["title-author-publisher-year", "лирика", "блок а.", "нева", "1971"]
    assert reasons["cross_file"].file.endswith("/b.json")
    summary = spark.read.json(str(tmp_path / "out/report/summary")).first()
    assert (summary.dedup_key, summary.total) == ("title-author-publisher-year", 2)


def test_merge_without_field_cleaning(spark, folder, tmp_path):
    job = merge_files(spark, str(folder), str(tmp_path / "out"), clean_fields=False)
    m = job.metrics.first()
    assert m.fields_removed == 0 and not m.cleaned_fields and m.items_count == 3
    assert records(job.merged)[0]["detail_url"] == "/detail/book7.html"


def test_merge_without_dedup_and_unwrap(spark, folder, tmp_path):
    job = merge_files(spark, str(folder), str(tmp_path / "out"), dedup_key=None, unwrap=False)
    m = job.metrics.first()
    assert (m.items_read, m.items_count, m.unwrapped_files, m.duplicates_removed) == (3, 3, 0, 0)
    assert job.report is None


def test_merge_to_one_array(spark, folder, tmp_path):
    merge_files(spark, str(folder), str(tmp_path / "out"), as_array=True)
    parts = sorted((tmp_path / "out/records/source_file=merged").glob("part-*"))
    array = json.loads("".join(p.read_text(encoding="utf-8") for p in parts))
    assert [r["title"] for r in array] == ["Степь", "Лирика", "Сказки"]


def test_output_inside_the_input_is_no_input(spark, folder):
    out = folder / "out [1]"
    job = merge_files(spark, str(folder), str(out / "a"), report=True)
    assert job.metrics.first().files_count == 2
    again = clean_files(spark, [str(folder)], str(out / "b"), recursive=True, exclude=["*/a/*"])
    assert again.totals.first().files_processed == 2


def test_merge_in_order(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for f in range(5):
        write(source / f"{f}.json", [{"n": 100 * f + i} for i in range(50)])
    merge_files(spark, str(source), str(tmp_path / "out"), ordered=True)
    parts = sorted((tmp_path / "out/records").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert [json.loads(line)["n"] for line in lines] == [100 * f + i for f in range(5) for i in range(50)]


def test_merge_by_isbn_only(spark, folder, tmp_path):
    m = merge_files(spark, str(folder), str(tmp_path / "out"), dedup_key="ISBN ").metrics.first()
    assert (m.in_file_duplicates, m.cross_file_duplicates, m.items_count) == (1, 0, 4)


def test_merge_skips_given_paths(spark, folder, tmp_path):
    job = merge_files(spark, str(folder), str(tmp_path / "out"), exclude_paths=[str(folder / "b.json")])
    assert job.metrics.first().items_read == 3


def test_merge_stops_at_unreadable_file(spark, folder, tmp_path):
    (folder / "c.json").write_text("{bad")
    with pytest.raises(Exception, match="unreadable JSON"):
        merge_files(spark, str(folder), str(tmp_path / "out"))


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(NoInputFiles):
        merge_files(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"))
    with pytest.raises(NoInputFiles):
        clean_files(spark, [str(tmp_path)], str(tmp_path / "out"))


def read_document(path, file):
    parts = sorted((path / "documents").glob("source_file=*/part-*"))
    text = "".join(p.read_text(encoding="utf-8") for p in parts if file in str(p.parent))
    return json.loads(text)


def test_clean_files_writes_documents(spark, folder, tmp_path):
    (folder / "bad.json").write_text("{bad")
    (folder / "note.json").write_text("5")
    write(folder / "z_clean.json", [NOVEL])
    out = tmp_path / "out"
    with pytest.raises(UnreadableDocuments, match="1 of the documents"):
        clean_files(spark, [str(folder)], str(out), exclude=["*_clean.json"], report=True)
    assert [b["title"] for b in read_document(out, "a.json")] == ["Степь", "Лирика"]
    assert [b["title"] for b in read_document(out, "b.json")] == ["Сказки"]
    totals = spark.read.json(str(out / "totals")).first()
    assert (totals.files_processed, totals.files_skipped, totals.errors) == (3, 1, 1)
    assert (totals.books_count, totals.removed_count) == (3, 9)
    assert (totals.duplicates_removed, totals.cross_file_duplicates_removed, totals.meta_removed_files) == (1, 1, 1)
    assert sorted(p.name for p in folder.iterdir()) == ["a.json", "b.json", "bad.json", "note.json", "z_clean.json"]


def test_clean_keeps_meta_on_request(spark, folder, tmp_path):
    out = tmp_path / "out"
    job = clean_files(spark, [str(folder)], str(out), keep_meta=True)
    document = read_document(out, "a.json")
    assert list(document) == ["meta", "books"] and document["meta"] == {"n": 3}
    assert len(document["books"]) == 2 and isinstance(read_document(out, "b.json"), list)
    assert job.totals.first().meta_removed_files == 0


def test_clean_per_file(spark, folder, tmp_path):
    totals = clean_files(spark, [str(folder)], str(tmp_path / "out"), cross_file=False).totals.first()
    assert (totals.duplicates_removed, totals.cross_file_duplicates_removed, totals.books_count) == (1, 0, 4)


def test_a_file_reached_twice_counts_once(spark, folder, tmp_path):
    totals = clean_files(
        spark, [str(folder / "b.json"), str(folder)], str(tmp_path / "out")
    ).totals.first()
    assert (totals.files_processed, totals.books_count) == (2, 3)
    # b.json is named first, so its record of the poems wins
    kept = records(CleanJob(_scan(spark, [str(folder / "b.json"), str(folder)])).kept)
    assert [r["title"] for r in kept] == [" лирика", "Сказки", "Степь"]


def _scan(spark, paths):
    from shelfspark.sources.json_docs import scan_json_documents

    return scan_json_documents(spark, paths)


def test_all_removed_leaves_an_empty_document(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.json", [NOVEL])
    write(source / "b.json", {"data": [NOVEL_AGAIN], "n": 1.0})
    out = tmp_path / "out"
    clean_files(spark, [str(source)], str(out), keep_meta=True)
    assert read_document(out, "b.json") == {"data": [], "n": 1.0}


def test_staged_and_direct_runs_agree(docs):
    texts = {"a.json": json.dumps([NOVEL, NOVEL_AGAIN, 1]), "b.json": json.dumps({"items": [POEMS, NOVEL]})}
    for job in (CleanJob, MergeJob):
        results = [job(docs(texts), stage=stage) for stage in (True, False)]
        frames = [r.kept if job is CleanJob else r.merged for r in results]
        assert records(frames[0]) == records(frames[1])


def test_staged_rows_go_with_their_job(spark, tmp_path):
    import os

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"title":"t"}]')

    def folder(job):
        return os.path.dirname(job.rows.inputFiles()[0]).removeprefix("file://")

    with clean_files(spark, [str(tmp_path / "in")], str(tmp_path / "out")) as job:
        assert job.totals.first().books_count == 1 and os.path.isdir(folder(job))
        cleaned = folder(job)
    with merge_files(spark, str(tmp_path / "in"), str(tmp_path / "merged")) as job:
        assert job.metrics.first().items_read == 1
        merged = folder(job)
    assert not os.path.exists(cleaned) and not os.path.exists(merged)

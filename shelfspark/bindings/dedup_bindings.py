"""De-duplication, resume and merging on texts, events and addresses."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.bindings.tables import Registry, table
from shelfspark.functions.keys import text_id
from shelfspark.functions.text import WS_CLASS, normalize_text
from shelfspark.functions.urls import absolute_url
from shelfspark.operators.dedup import (
    dedup_first_wins,
    dedup_richest,
    distinct_keep_order,
    first_per_file,
    first_per_key,
    label_duplicates,
    removed_rows,
)
from shelfspark.operators.membership import (
    drop_already_added,
    merge_existing_new,
    resume_counts,
    resume_new_urls,
    url_plan,
)
from shelfspark.session import scratch_dir
from shelfspark.sources.sinks import preview
from shelfspark.streaming.incremental import dedup_batch, read_batches, resume_batch, run_available
from shelfspark.streaming.keytable import KeyTable, dedup_into
from shelfspark.streaming.stateful import dedup_with_state

_registry = Registry()
QUERIES, ORACLE = _registry.queries, _registry.oracle
query = _registry.add

HOST = "https://books.example"
# full case folding: of the letters it changes beyond lower case, the texts have only sharp s
_NORM = f"replace(lower(trim(regexp_replace(text, '{WS_CLASS}+', ' ', 'g'))), 'ß', 'ss')"
_DOCS = f"""
WITH d AS (SELECT doc_id, source, lang, {_NORM} AS norm FROM documents),
labelled AS (
  SELECT doc_id, source, lang, CASE
    WHEN row_number() OVER (PARTITION BY norm, source ORDER BY doc_id) > 1 THEN 'in_file'
    WHEN min(source) OVER (PARTITION BY norm) < source THEN 'cross_file' ELSE 'kept' END AS label FROM d)
"""


def document_rows(spark, sf_dir):
    """Texts as records: the source is the file, the id the position, the folded text the key."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.col("text").isNotNull().alias("has_key"),
        F.when(F.col("text").isNotNull(), text_id(normalize_text(F.col("text")))).alias("key_id"),
    )


@query("dedup_first_wins", _DOCS + "SELECT doc_id, source FROM labelled WHERE label = 'kept'")
def dedup_first_wins_query(spark, sf_dir):
    """E2, D2."""
    kept = dedup_first_wins(document_rows(spark, sf_dir), file="source", pos="doc_id", has_key="has_key")
    return kept.select("doc_id", "source")


@query("label_duplicates", _DOCS + "SELECT doc_id, source, label FROM labelled")
def label_duplicates_query(spark, sf_dir):
    """F1."""
    labelled = label_duplicates(
        document_rows(spark, sf_dir), file="source", pos="doc_id", has_key="has_key"
    )
    return labelled.select("doc_id", "source", "label")


@query(
    "dedup_per_file",
    f"SELECT source, min(doc_id) AS doc_id FROM (SELECT *, {_NORM} AS norm FROM documents) GROUP BY source, norm",
)
def dedup_per_file(spark, sf_dir):
    """E2 inside files only."""
    rows = document_rows(spark, sf_dir)
    kept = dedup_first_wins(rows, file="source", pos="doc_id", cross_file=False, has_key="has_key")
    return kept.select("source", "doc_id")


@query("duplicates_report", _DOCS + "SELECT source, label AS reason, doc_id FROM labelled WHERE label <> 'kept'")
def duplicates_report_query(spark, sf_dir):
    """B3 on texts."""
    labelled = label_duplicates(
        document_rows(spark, sf_dir), file="source", pos="doc_id", has_key="has_key"
    )
    return removed_rows(labelled).select("source", F.col("label").alias("reason"), "doc_id")


_EVENTS = """
WITH e AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, user_id || '|' || event_type AS key FROM events),
labelled AS (
  SELECT event_id, day, CASE
    WHEN row_number() OVER (PARTITION BY key, day ORDER BY event_id) > 1 THEN 'in_file'
    WHEN min(day) OVER (PARTITION BY key) < day THEN 'cross_file' ELSE 'kept' END AS label FROM e)
"""


@query("label_events", _EVENTS + "SELECT event_id, day, label FROM labelled")
def label_events(spark, sf_dir):
    """F1 where most rows are duplicates: days are files, user and type the key."""
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.concat_ws("|", "user_id", "event_type").alias("key_id"),
    )
    return label_duplicates(rows, file="day", pos="event_id").select("event_id", "day", "label")


@query(
    "cross_file_membership",
    """
SELECT l_partkey, l_shipdate, count(*) AS n, min(l_shipdate) OVER (PARTITION BY l_partkey) < l_shipdate AS seen_before
FROM lineitem GROUP BY l_partkey, l_shipdate""",
)
def cross_file_membership(spark, sf_dir):
    """Whether a key occurs in an earlier file; the ship date is the file."""
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    per_file = rows.groupBy("l_partkey", "l_shipdate").agg(F.count("*").alias("n"))
    first = (
        first_per_key(per_file, "l_partkey", "l_shipdate", "n")
        .select("l_partkey", "l_shipdate", F.lit(True).alias("_first"))
    )
    return per_file.join(first, ["l_partkey", "l_shipdate"], "left").select(
        "l_partkey", "l_shipdate", "n", F.col("_first").isNull().alias("seen_before")
    )


@query(
    "dedup_richest",
    f"""
WITH r AS (
  SELECT d.doc_id, {_NORM.replace('text', 'd.text')} AS k,
    3 + (quality IS NOT NULL)::INTEGER + (toxic IS NOT NULL)::INTEGER AS n_fields
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, n_fields, first_seen FROM (
  SELECT *, min(doc_id) OVER (PARTITION BY k) AS first_seen,
    row_number() OVER (PARTITION BY k ORDER BY n_fields DESC, doc_id) AS rn FROM r WHERE k <> '') WHERE rn = 1""",
)
def dedup_richest_query(spark, sf_dir):
    """Of equal texts the one with most labels."""
    rows = (
        table(spark, sf_dir, "documents")
        .withColumn("norm", normalize_text(F.col("text")))
        .select("doc_id", F.when(F.col("norm") != "", F.sha2("norm", 256)).alias("record_key"))
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
    )
    n_fields = F.lit(3) + F.col("quality").isNotNull().cast("int") + F.col("toxic").isNotNull().cast("int")
    best = dedup_richest(rows.withColumn("n_fields", n_fields), order="doc_id")
    return best.select("doc_id", "n_fields", "first_seen")


def _order_urls(spark, sf_dir):
    """An address per order, repeated for every order of a customer."""
    url = absolute_url(F.concat(F.lit("detail/book"), "o_custkey", F.lit(".html")), HOST)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line_no"), url.alias("url"))


def _customer_urls(spark, sf_dir, segment="BUILDING"):
    url = absolute_url(F.concat(F.lit("/detail/book"), "c_custkey", F.lit(".html")), HOST)
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == segment).select(
        F.col("c_custkey").alias("pos"), url.alias("url"), "c_name"
    )


_URLS = """
WITH u AS (SELECT o_orderkey AS line_no, 'https://books.example/detail/book' || o_custkey || '.html' AS url FROM orders),
done AS (SELECT c_custkey, c_name, 'https://books.example/detail/book' || c_custkey || '.html' AS url
         FROM customer WHERE c_mktsegment = 'BUILDING')
"""


@query("distinct_urls", _URLS + "SELECT url, min(line_no) AS line_no, count(*) AS n_seen FROM u GROUP BY url")
def distinct_urls(spark, sf_dir):
    """E1."""
    return distinct_keep_order(_order_urls(spark, sf_dir))


@query(
    "resume_new_urls",
    _URLS + "SELECT url, min(line_no) AS line_no FROM u WHERE url NOT IN (SELECT url FROM done) GROUP BY url",
)
def resume_new_urls_query(spark, sf_dir):
    """D1."""
    return resume_new_urls(_order_urls(spark, sf_dir), _customer_urls(spark, sf_dir))


@query(
    "resume_counts",
    _URLS + """
SELECT count(*) AS total_input_urls, count(*) FILTER (is_done) AS skipped_existing,
  count(*) FILTER (NOT is_done) - count(DISTINCT url) FILTER (NOT is_done) AS duplicate_urls,
  count(DISTINCT url) FILTER (NOT is_done) AS to_process
FROM (SELECT url, url IN (SELECT url FROM done) AS is_done FROM u)""",
)
def resume_counts_query(spark, sf_dir):
    """Counts of a resumed run."""
    return resume_counts(url_plan(_order_urls(spark, sf_dir), _customer_urls(spark, sf_dir)))


@query(
    "drop_already_added",
    _URLS + """
SELECT url, min(line_no) AS line_no FROM u WHERE url NOT IN (SELECT url FROM done) GROUP BY url""",
)
def drop_already_added_query(spark, sf_dir):
    """D3."""
    return drop_already_added(
        _order_urls(spark, sf_dir), _customer_urls(spark, sf_dir), url="url", order="line_no"
    ).select("url", "line_no")


@query(
    "merge_existing_new",
    _URLS + """
SELECT 0 AS gen, url, c_custkey AS pos, c_name FROM done
UNION ALL SELECT 1, url, min(line_no), NULL FROM u WHERE url NOT IN (SELECT url FROM done) GROUP BY url""",
)
def merge_existing_new_query(spark, sf_dir):
    """H2, H1: old records, then new ones, with a column only the old ones have."""
    old = _customer_urls(spark, sf_dir)
    new = resume_new_urls(_order_urls(spark, sf_dir), old).withColumnRenamed("line_no", "pos")
    return merge_existing_new(old, new).select("gen", "url", "pos", "c_name")


@query(
    "first_per_file",
    f"SELECT source, min(doc_id) AS doc_id, {_NORM} AS norm FROM documents GROUP BY source, norm",
)
def first_per_file_query(spark, sf_dir):
    """The aggregate behind F1, with the carried text of the first row."""
    rows = table(spark, sf_dir, "documents").select(
        "source", "doc_id", normalize_text(F.col("text")).alias("norm")
    )
    keyed = rows.withColumn("key_id", text_id(F.col("norm")))
    return first_per_file(keyed, file="source", pos="doc_id", carry=("norm",)).drop("key_id")


@query(
    "preview_50",
    """
SELECT doc_id, source, coalesce(quality::VARCHAR, 'unlabelled') AS quality
FROM documents LEFT JOIN labels USING (doc_id) ORDER BY doc_id LIMIT 50""",
)
def preview_50(spark, sf_dir):
    """The first records with labels for missing fields."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(
        table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string")), "doc_id", "left"
    )
    return preview(rows, "doc_id", quality="unlabelled")


@query("ordered_output", "SELECT source, doc_id, n_chars FROM documents ORDER BY source, doc_id")
def ordered_output(spark, sf_dir):
    """Output order is file order, then position."""
    return table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars").orderBy("source", "doc_id")


# Sources arrive in two waves, those with short names first.
_STREAM = _DOCS.replace("min(source) OVER (PARTITION BY norm) < source",
                        "min([length(source)::VARCHAR, source]) OVER (PARTITION BY norm) "
                        "< [length(source)::VARCHAR, source]")


_STREAM_SQL = _STREAM + "SELECT doc_id, source FROM labelled WHERE label = 'kept'"


def _two_waves(spark, sf_dir, label, run):
    """The rows come in two waves; ``run(stream, folder)`` takes what has come, each time
    as a query of its own that goes on from the last one's checkpoint."""
    out = scratch_dir(spark, label)
    rows = document_rows(spark, sf_dir).select(
        "doc_id", "source", F.struct(F.length("source").alias("n"), "source").alias("file_rank"), "key_id"
    )
    # the keys are made once; a wave is a folder that the stream finds
    rows.withColumn("wave", (F.length("source") > 4).cast("int")).write.partitionBy("wave").parquet(f"{out}/all")
    for wave in (0, 1):
        spark.read.schema(rows.schema).parquet(f"{out}/all/wave={wave}").write.mode("append").parquet(f"{out}/in")
        run(spark.readStream.schema(rows.schema).parquet(f"{out}/in"), out)
    return out, rows.schema


@query("stream_dedup", _STREAM_SQL)
def stream_dedup(spark, sf_dir):
    """J1 by the state store: the second run knows the keys of the first from its checkpoint."""
    out, schema = _two_waves(
        spark, sf_dir, "stream-dedup",
        lambda stream, out: dedup_with_state(stream, out, f"{out}/progress", pos="doc_id", carry=("source",)),
    )
    return read_batches(spark, f"{out}/kept", schema).select("doc_id", "source")


@query("stream_dedup_prefixes", _STREAM_SQL)
def stream_dedup_prefixes(spark, sf_dir):
    """J1 by tables of earlier batches under key prefixes."""
    out, schema = _two_waves(
        spark, sf_dir, "stream-dedup", lambda stream, out: run_available(stream, dedup_batch(out, pos="doc_id"), f"{out}/progress")
    )
    return read_batches(spark, f"{out}/kept", schema).select("doc_id", "source")


@query("stream_dedup_compacted", _STREAM_SQL)
def stream_dedup_compacted(spark, sf_dir):
    """J1 by a key table that merges its batches; it is read after two runs."""
    def run(stream, out):
        table = KeyTable(spark, f"{out}/kept", stream.schema)
        run_available(stream, dedup_into(table, pos="doc_id"), f"{out}/progress")

    out, schema = _two_waves(spark, sf_dir, "stream-keytable", run)
    return KeyTable(spark, f"{out}/kept", schema).rows().select("doc_id", "source")


@query(
    "stream_resume",
    """
WITH u AS (SELECT o_orderdate, o_orderkey, 'https://books.example/detail/book' || o_custkey || '.html' AS url FROM orders),
r AS (
  SELECT url, o_orderdate < TIMESTAMP '1996-01-01' AS wave, min(o_orderkey) AS line_no FROM u GROUP BY 1, 2)
SELECT url, line_no, 'ok' AS status FROM r
WHERE wave OR url NOT IN (SELECT url FROM r WHERE wave)""",
)
def stream_resume(spark, sf_dir):
    """Two runs over a growing URL list; the second processes only new URLs."""
    out = scratch_dir(spark, "stream-resume")
    urls = _order_urls(spark, sf_dir)
    dated = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("line_no"), "o_orderdate")
    rows = urls.join(dated, "line_no").withColumn("early", F.col("o_orderdate") < "1996-01-01")
    results = rows.select("url", "line_no").withColumn("status", F.lit("ok")).schema

    def process(new):
        return new.withColumn("status", F.lit("ok"))

    stream = None
    for wave in (rows.where("early"), rows.where("not early")):
        wave.select("url", "line_no").write.mode("append").parquet(f"{out}/in")
        stream = stream or spark.readStream.schema("url string, line_no bigint").parquet(f"{out}/in")
        run_available(stream, resume_batch(out, process, results), f"{out}/progress")
    return read_batches(spark, f"{out}/results", results).drop("batch")

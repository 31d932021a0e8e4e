"""Normalisation, URL lists and page numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.bindings.tables import Registry, table
from shelfspark.functions.keys import key_parts, with_dedup_key
from shelfspark.functions.text import WS_CLASS, decode_entities, normalize_isbn, normalize_text, strip_tags
from shelfspark.functions.urls import extract_id
from shelfspark.session import scratch_dir
from shelfspark.sources.html import decode_page, encode_page
from shelfspark.sources.text_lists import expand_page_range, index_lines, indexed_lines, page_list_urls, page_urls, urls_from_lines

_registry = Registry()
QUERIES, ORACLE = _registry.queries, _registry.oracle
query = _registry.add

HOST = "https://books.example"


def _isbn():
    text = F.concat(F.lit("\xa0978-"), "p_partkey", F.lit(" "), "p_size", F.lit("-x\t"))
    return F.when(F.col("p_type") == "SMALL", " - ").when(F.col("p_type") != "ECONOMY", text)


@query(
    "normalize_isbn",
    """
SELECT p_partkey, CASE WHEN p_type NOT IN ('SMALL','ECONOMY') THEN '978' || p_partkey || p_size || 'X' END AS isbn
FROM part""",
)
def normalize_isbn_query(spark, sf_dir):
    """I1."""
    return table(spark, sf_dir, "part").select("p_partkey", normalize_isbn(_isbn()).alias("isbn"))


_SQL_FLAT = f"trim(regexp_replace(text, '{WS_CLASS}+', ' ', 'g'))"


@query("normalize_text", f"SELECT doc_id, lower({_SQL_FLAT}) AS norm FROM documents")
def normalize_text_query(spark, sf_dir):
    """I2 on whole texts, by lower-casing alone."""
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", normalize_text(F.col("text"), exact=False).alias("norm"))


@query(
    "normalize_text_exact",
    # of the letters that fold otherwise than they lower, the texts have only this one
    f"SELECT doc_id, replace(lower({_SQL_FLAT}), 'ß', 'ss') AS norm FROM documents",
)
def normalize_text_exact(spark, sf_dir):
    """I2 with full case folding."""
    return table(spark, sf_dir, "documents").select("doc_id", normalize_text(F.col("text")).alias("norm"))


@query(
    "dedup_keys",
    """
SELECT p_partkey,
  CASE WHEN p_type NOT IN ('SMALL','ECONOMY') THEN 'isbn|978' || p_partkey || p_size || 'X'
       WHEN p_size > 5 THEN 'title-author-publisher-year|' || lower(p_name) || '|' || lower(p_brand) || '|'
         || lower(p_type) || '|' || p_size END AS key_four,
  CASE WHEN p_type NOT IN ('SMALL','ECONOMY') THEN 'isbn|978' || p_partkey || p_size || 'X' END AS key_isbn
FROM part""",
)
def dedup_keys(spark, sf_dir):
    """I3 in both modes; small parts lack a year."""
    fields = {
        "isbn": _isbn(), "title": F.col("p_name"), "author": F.col("p_brand"), "publisher": F.col("p_type"),
        "year": F.when(F.col("p_size") > 5, F.col("p_size")),
    }
    part = table(spark, sf_dir, "part")
    key = F.col("dedup_key")
    shown = F.when(key.isNotNull(), F.array_join(key_parts(key), "|"))
    four = with_dedup_key(part, fields, "4fields").withColumn("key_four", shown).drop("dedup_key", "key_id")
    both = with_dedup_key(four, fields, "isbn").withColumn("key_isbn", shown)
    return both.select("p_partkey", "key_four", "key_isbn")


@query(
    "strip_tags_decode",
    """
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(html, '<[^>]+>', '', 'g'),
  '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', ' '), '&mdash;', '—'), '&raquo;', '»'),
  '&laquo;', '«') AS text FROM pages""",
)
def strip_tags_decode(spark, sf_dir):
    """I9, I10 on whole pages."""
    return table(spark, sf_dir, "pages").select(
        "page_id", decode_entities(strip_tags(F.col("html"))).alias("text")
    )


@query(
    "extract_ids",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_partkey::VARCHAR AS book_id FROM lineitem",
)
def extract_ids(spark, sf_dir):
    """I5."""
    url = F.concat(F.lit(HOST + "/detail/book"), "l_partkey", F.lit(".html"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", extract_id(url).alias("book_id")
    )


_LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS value,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM documents),
t AS (SELECT doc_id, line_no, regexp_replace(value, '^WS+|WS+$', '', 'g') AS url FROM l)
SELECT doc_id, line_no, CASE WHEN starts_with(url, 'http') THEN url
  WHEN starts_with(url, '/') THEN 'https://books.example' || url ELSE 'https://books.example/' || url END AS url
FROM t WHERE url <> '' AND NOT starts_with(url, '#') AND line_no >= 2""".replace("WS", WS_CLASS)


@query("scan_url_list", _LINES_SQL)
def scan_url_list_query(spark, sf_dir):
    """Every line of every text from the second on."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "value")
    )
    numbered = lines.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "value")
    return urls_from_lines(numbered, HOST, start_line=2)


@query(
    "indexed_lines",
    """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS value, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
n AS (SELECT doc_id // 100 AS place, value, row_number() OVER (PARTITION BY doc_id // 100 ORDER BY doc_id, pos) AS line_no FROM l)
SELECT place, line_no, sha256(value) AS line FROM n WHERE line_no BETWEEN 50 AND 300""",
)
def indexed_lines_query(spark, sf_dir):
    """Line numbers of written files, read by a range that leaves most row groups out."""
    out = scratch_dir(spark, "lines")
    # a file per hundred documents, their lines in order
    place = F.expr("doc_id div 100")
    lines = table(spark, sf_dir, "documents").select(place.alias("place"), "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "value"))
    spread = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "place").sortWithinPartitions("place", "doc_id", "pos")
    spread.select("place", "value").write.partitionBy("place").option("lineSep", "\n").text(f"{out}/text")
    index_lines(spark, f"{out}/text/*", f"{out}/index")
    found = indexed_lines(spark, f"{out}/index", 50, 300)
    number = F.regexp_extract("file", "/place=([0-9]+)/", 1).cast("bigint")
    return found.select(number.alias("place"), "line_no", F.sha2("value", 256).alias("line"))


@query(
    "page_urls",
    """
WITH b AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT o_custkey, page, CASE WHEN page = 0 THEN 'https://books.example/cat/' || o_custkey || '/'
  ELSE 'https://books.example/cat/' || o_custkey || '/?pg=' || page END AS url
FROM (SELECT o_custkey, unnest(range(0, n)) AS page FROM b)""",
)
def page_urls_query(spark, sf_dir):
    """A section per customer, a page per order."""
    bases = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    bases = bases.withColumn("base", F.concat(F.lit(HOST + "/cat/"), "o_custkey", F.lit("/")))
    return page_urls(bases, F.lit(0), F.col("n")).select("o_custkey", "page", "url")


_RANGE_SQL = """
WITH r AS (
  SELECT p_partkey, 0 AS lo, p_size AS hi FROM part WHERE p_type IN ('ECONOMY', 'SMALL')
  UNION ALL SELECT p_partkey, 0, p_size FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')
  UNION ALL SELECT p_partkey, p_size + 2, p_size + 3 FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')
  UNION ALL SELECT p_partkey, p_size - 1, p_size + 5 FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL')),
e AS (SELECT DISTINCT p_partkey, unnest(range(lo, hi)) AS page FROM r)
"""


@query("expand_page_range", _RANGE_SQL + "SELECT * FROM e")
def expand_page_range_query(spark, sf_dir):
    """Overlapping ranges, ``all`` and the empty text."""
    size = F.col("p_size")
    ranges = F.concat(F.lit("1-"), size, F.lit(","), size + 3, F.lit(", "), size, F.lit(" - "), size + 5)
    spec = F.when(F.col("p_type") == "ECONOMY", "all").when(F.col("p_type") == "SMALL", "").otherwise(ranges)
    specs = table(spark, sf_dir, "part").select("p_partkey", "p_size", spec.alias("spec"))
    return expand_page_range(specs, total=F.col("p_size"), by=("p_partkey",))


@query(
    "page_list_urls",
    _RANGE_SQL + """
SELECT p_partkey, page, 'https://books.example/' || p_partkey || CASE WHEN page = 0 THEN '' ELSE '?pg=' || page END
  AS url FROM e""",
)
def page_list_urls_query(spark, sf_dir):
    """A11 for a list of pages."""
    pages = expand_page_range_query(spark, sf_dir)
    based = pages.withColumn("base", F.concat(F.lit(HOST + "/"), F.col("p_partkey").cast("string")))
    return page_list_urls(based).drop("base")


@query("decode_cp1251", "SELECT p_partkey, 'Книга «' || p_name || '» — ' || p_brand AS text FROM part")
def decode_cp1251(spark, sf_dir):
    """Text to single-byte Cyrillic and back."""
    text = F.concat(F.lit("Книга «"), "p_name", F.lit("» — "), "p_brand")
    stored = table(spark, sf_dir, "part").select("p_partkey", encode_page(text).alias("content"))
    return stored.select("p_partkey", decode_page(F.col("content")).alias("text"))

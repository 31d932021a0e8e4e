"""The operators on their whole tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import (
    decontaminate, line_dedup, merkle, mixing, near_dedup, pieces, pii, prefix_trie, quality, secrets, token_files, toxicity, whitening,
)
from shelfspark.llm.workspace import Workspace
from shelfspark.session import staged

END_ID = 2
# Powers to which the present shares of tokens are taken: sources are flattened most.
MIX_POWERS = {"source": 0.7, "lang": 0.85, "topic": 1.0}
# Expected tokens of the mixed sample, as a part of the input's.
MIX_PART = 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id",
        *(_count(k).alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(every).alias("spans"),
    )


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with a secret: how many, and their places as start:end."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), path_col="source")
    place = F.struct("start", "end", F.round("score", 6).alias("score"))
    rows = found.groupBy("doc_id").agg(F.count("*").alias("n_secrets"), F.array_sort(F.collect_list(place)).alias("s"))
    joined = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return rows.select("doc_id", "n_secrets", joined.alias("spans"), F.array_max(F.transform("s", lambda x: x["score"])).alias("best_score"))


def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_by_next(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5, digest=True)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    hits = decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.withColumn("similarity", F.round("similarity", 6))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def with_topic(docs: DataFrame, name: str = "topic") -> DataFrame:
    return docs.withColumn(name, mixing.form_topic(F.col("text")))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, probability and whether it is in the sample."""
    docs = with_topic(table(spark, sf_dir, "documents"))
    by_text = F.when(F.col("doc_id").isNull(), F.col("text")).alias("text")
    rows = staged(docs.select("doc_id", "source", "lang", "topic", mixing.n_words(F.col("text")).alias("n_tokens"), by_text), "mix-rows")
    weighed = mixing.fit_tempered(rows, MIX_POWERS, "n_tokens", MIX_PART).applied(rows)
    mixed = weighed.withColumn("mix_kept", mixing.kept_by_hash(F.col("mix_probability"), "doc_id", "text"))
    return mixed.select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("mix_weight", 9).alias("weight"),
        F.round("mix_probability", 9).alias("probability"), F.col("mix_kept").alias("kept"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin like the first of their twenty."""
    work = Workspace(spark, "prefix-trie")
    given = prefix_trie.ordered(table(spark, sf_dir, "conversations"), work)
    rebuilt = prefix_trie.started_by_others(
        given, work, lambda c: c - c % 20, lambda c: F.crc32(c.cast("string").cast("binary")) % 4, most=3
    )
    return prefix_trie.prefix_trie(rebuilt, work)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), bos=True, eos=True)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component."""
    rows, found = whitening.whitened(table(spark, sf_dir, "embeddings"), k=16)
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = [float(v / found.trace) for v in found.values] if found else []
    part = F.element_at(F.array(*map(F.lit, explained)).cast("array<double>"), F.col("at") + 1)
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(found.n if found else 0).cast("long").alias("n"), "deviation",
        "whitened", (part if explained else F.lit(None).cast("double")).alias("explained"),
        F.lit(found.identity_error if found else None).cast("double").alias("identity_error"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_personal_data, op3_secrets, op4_merkle_fingerprints, op5_quality, op6_toxicity,
        op7_line_dedup, op8_decontamination, op9_token_files, op10_mixing, op11_prefix_trie,
        op12_pieces, op13_whitening,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op1_near_duplicates": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n_shingles FROM sets),
items AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * n >= 80 * (p.n_shingles + q.n_shingles - n)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM sizes
  UNION
  SELECT r.x, l.y FROM reach r JOIN both_ways l ON r.y = l.x)
SELECT s.doc_id, n_shingles, min(y) AS component_id, s.doc_id = min(y) AS kept
FROM sizes s JOIN reach ON s.doc_id = x GROUP BY 1, 2
""",
    "op7_line_dedup": rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
  FROM lines),
often AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.last_id AS gone FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op11_prefix_trie": rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
lengths AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1),
bits AS (
  SELECT conv_id, n, list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, i: xor(v // 2, (v % 2) * 3988292384))) AS crc
  FROM lengths),
convs AS (
  SELECT b.conv_id, b.conv_id - b.conv_id % 20 AS other_id, xor(crc, 4294967295) % 4 AS h,
    least(xor(crc, 4294967295) % 4, coalesce(o.n, 0)) AS taken
  FROM bits b LEFT JOIN lengths o ON o.conv_id = b.conv_id - b.conv_id % 20),
rebuilt AS (
  SELECT c.conv_id, pos - h + taken AS pos, role, text FROM turns t JOIN convs c ON t.conv_id = c.conv_id WHERE pos > h
  UNION ALL
  SELECT c.conv_id, pos, role, text FROM turns t JOIN convs c ON t.conv_id = c.other_id WHERE pos <= taken),
hashed AS (
  SELECT conv_id, pos, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    string_agg(sha256(length(role) || ':' || role || text), '' ORDER BY pos) OVER (PARTITION BY conv_id ORDER BY pos) AS chain
  FROM rebuilt),
prefixes AS (
  SELECT conv_id, pos AS depth, words, sha256(chain) AS k, max(pos) OVER (PARTITION BY conv_id) = pos AS ends FROM hashed
  UNION ALL
  SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs),
nodes AS (
  SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY 1, 2),
paths AS (SELECT p.conv_id, p.depth, p.k, n.conv_id AS top FROM prefixes p JOIN nodes n USING (depth, k)),
linked AS (
  SELECT n.*, p.top AS parent_conv_id FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
marked AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids USING (conv_id, depth)),
sums AS (
  SELECT p.top AS conv_id, p.depth, count(*) FILTER (WHERE m.n_children = 0) AS n_leaves, sum(m.saved) AS saved_tokens
  FROM marked m JOIN paths p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY 1, 2)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM marked JOIN sums USING (conv_id, depth)
""",
}

"""A training corpus from documents: toxicity, near-duplicates, benchmark, mixing, token files.

Each stage takes all rows that the one before kept and returns the columns of ``documents``,
but the last, which returns the documents of the token files. Between stages the rows are
written as Parquet to the shared folder.

Stages decide by row: rows that share an id, or have none, are judged by their own texts. A
null text is empty; empty texts are neither toxic, nor copies, nor benchmark passages. An empty
table stays empty. Columns beside those of ``documents`` pass through, whatever their names,
but for names that begin with ``_pipeline``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import decontaminate, mixing, near_dedup, token_files, toxicity
from shelfspark.llm.queries import END_ID, MIX_PART, MIX_POWERS, table, tokenizer_path, with_topic
from shelfspark.session import staged

ROW = "_pipeline_row"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model trained on the labels doesn't reject."""
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the least id, rows without an id
    last, the earlier on a tie; five-word shingles, similarity 0.8."""
    numbered = staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-numbered")
    found = near_dedup.near_duplicates(numbered, id_col=ROW, k=5, percent=80)
    found = found.select(F.col("doc_id").alias(ROW), F.col("component_id").alias("_pipeline_group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    first = numbered.select(ROW, "doc_id").join(found, ROW).groupBy("_pipeline_group").agg(F.min(order)[ROW].alias(ROW))
    # the same plan at every size: the rows' numbers outgrow a broadcast soon
    return numbered.join(first.select(ROW).hint("merge"), ROW, "left_semi").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose expected tokens have flattened shares of sources, languages and topics."""
    named = with_topic(docs, "topic")
    rows = staged(named.select("source", "lang", "topic", mixing.n_words(F.col("text")).alias("n_tokens")), "mix-rows")
    weighed = mixing.fit_tempered(rows, MIX_POWERS, "n_tokens", MIX_PART).applied(named)
    return weighed.where(mixing.kept_by_hash(F.col("mix_probability"), "doc_id", "text")).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents left, read back: place, length and checksum of each."""
    return token_files.token_files(docs, tokenizer_path(), END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

# Toxicity, near-duplicates by MinHash, SimHash and raking can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, in order."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = staged(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)

"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a private-key header, a provider's key, or a long run of key characters with a digit. Its features
are its length and make-up, how often the class of characters changes from one to the next,
how much of it common word parts cover, what the document's path says, and the words around
it. A random forest is trained on labelled findings and scores every candidate. Everything
runs in DataFrame functions and Spark's own forest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.matches import before, with_matches
from shelfspark.session import staged

SAMPLE = 20_000  # labelled findings that the forest is trained on, at most
TREES, DEPTH, SEED = 40, 6, 7
AROUND = 40  # code points before and after a candidate that count as its neighbours
THRESHOLD = 0.5

CANDIDATE = (
    r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----|(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{12,}+={0,2}"
)

# Word parts of the dictionary, names of secrets, and signs of made-up ones.
WORD_PARTS = (
    "tion|ment|able|ible|ness|ing|the|and|for|with|from|that|this|have|are|was|not|you|all|can|her|his|one|our|out|day|get|has|him|how|man|new|now|old|"
    "see|two|way|who|did|its|let|put|say|she|too|use|test|name|user|file|page|data|http|https|www|com|org|net|html|index|version|release|example|"
    "sch|ein|und|der|die|das|ung|keit|lich|les|des|que|eau|pour|los|las|del|por|una|ado|mente"
)
SECRET_NAMES = r"(?i)(passw(or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private)\W*$"
MADE_UP = r"(?i)(?<![a-z])(example|sample|dummy|placeholder|changeme|xxxx|test)(?![a-z.])"

# Formats of providers and of assignments that leave no doubt, for labelling findings by rule.
SURE = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abps]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{20,}|-----BEGIN .*)$"

FEATURES = (
    "length", "share_digit", "share_upper", "share_lower", "share_other", "transitions", "distinct", "hex", "digits_only", "words_cover",
    "path_odd", "path_depth", "named", "assigned", "quoted", "made_up", "after_word",
)

_CHANGE = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``(doc_id, start, end, match, before, after, path)``, a row for every candidate.

    Places are code points, ends exclusive. A null text has no candidate; rows that repeat
    an id, or have none, are searched one by one.
    """
    path = docs[path_col].cast("string") if path_col else F.lit(None).cast("string")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), path.alias("path"))
    hinted = F.when(F.col("text").rlike(r"[0-9][A-Za-z0-9+/_\-]{5}|[A-Za-z0-9+/_\-]{5}[0-9]|PRIVATE KEY|AKIA"), F.col("text"))
    found = with_matches(rows, "found", hinted, CANDIDATE)
    around = F.transform(
        "found",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"), before(F.col("text"), s["start"], AROUND).alias("before"),
            F.substring(F.col("text"), s["end"] + 1, F.lit(AROUND)).alias("after"),
        ),
    )
    return found.select("doc_id", "path", F.explode(around).alias("c")).select("doc_id", "c.*", "path")


def with_features(found: DataFrame) -> DataFrame:
    """Candidates with FEATURES, all of them numbers without null."""
    m, n = F.col("match"), F.length("match")
    core = F.regexp_replace(m, "[^A-Za-z0-9]", "")

    def share(chars: str) -> Column:
        return F.length(F.regexp_replace(m, f"[^{chars}]", "")) / n

    path, flag = F.coalesce(F.col("path"), F.lit("")), lambda c: c.cast("double")
    values = {
        "length": n.cast("double"), "share_digit": share("0-9"), "share_upper": share("A-Z"), "share_lower": share("a-z"),
        "share_other": F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")) / n,
        "transitions": F.regexp_count(m, F.lit(_CHANGE)) / n,
        "distinct": F.size(F.array_distinct(F.split(m, ""))) / n,
        "hex": flag(core.rlike("^([0-9a-f]+|[0-9A-F]+)$")), "digits_only": flag(core.rlike("^[0-9]+$")),
        "words_cover": 1 - F.length(F.regexp_replace(F.lower(m), WORD_PARTS, "")) / n,
        "path_odd": flag(path.rlike(r"(?i)(test|example|sample|doc|mock|fixture)")),
        "path_depth": F.length(F.regexp_replace(path, "[^/]", "")).cast("double"),
        "named": flag(F.col("before").rlike(SECRET_NAMES)), "assigned": flag(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        "quoted": flag(F.col("before").rlike("[\"']$")), "made_up": flag(F.concat_ws("", "before", "match").rlike(MADE_UP)),
        "after_word": flag(F.col("after").rlike("^[\"']?\\s+[a-z]+")),
    }
    return found.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in values.items()})


def rule_labels(found: DataFrame) -> DataFrame:
    """Candidates labelled without doubt: ``label`` 1 for a provider's format or a named, assigned
    value that mixes letters and digits; 0 for made-up values, for numbers without a secret's
    name before them, and for runs that mostly consist of words. The others are left out."""
    m = F.col("match")
    named = F.col("before").rlike(SECRET_NAMES) & F.col("before").rlike(r"[=:]\s*[\"']?$")
    mixed = m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    made_up = F.concat_ws("", "before", "match").rlike(MADE_UP)
    worded = F.length(F.regexp_replace(F.lower(m), WORD_PARTS, "")) < 0.4 * F.length(m)
    label = (
        F.when(made_up, 0).when(m.rlike(SURE) | (named & mixed), 1).when((m.rlike("^[0-9+/_-]+$") & ~F.col("before").rlike(SECRET_NAMES)) | worded, 0)
    )
    return found.withColumn("label", label).where(F.col("label").isNotNull())


def fit_forest(labelled: DataFrame):
    """Forest trained on at most SAMPLE labelled candidates, chosen by hash; None without both labels."""
    order = F.xxhash64("match", "before", "doc_id", "start")
    rows = with_features(labelled).select(*(F.col(f) for f in FEATURES), F.col("label").cast("double").alias("label"), order.alias("_order"))
    sample = staged(rows.orderBy("_order", *FEATURES).limit(SAMPLE).drop("_order"), "secret-findings")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="_x", labelCol="label", probabilityCol="_p", rawPredictionCol="_r", predictionCol="_y")
    return forest.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(sample))


def scored(found: DataFrame, forest) -> DataFrame:
    """Candidates with ``score``, the forest's probability of a secret. Without a forest, for
    want of both labels, only a provider's format is taken for one."""
    if forest is None:
        return found.withColumn("score", F.when(F.col("match").rlike(SURE), 1.0).otherwise(0.0))
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(with_features(found))
    return forest.transform(ready).withColumn("score", vector_to_array("_p")[1]).select(*found.columns, "score")


def find_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(doc_id, start, end, score)`` of the candidates that score at least ``threshold``.

    ``labelled`` has findings ``(doc_id, start, end, label)`` in ``docs``; without it findings
    that a rule labels beyond doubt stand in. An empty table gives an empty result.
    """
    found = staged(candidates(docs, id_col, text_col, path_col), "secret-candidates")
    if labelled is None:
        known = rule_labels(found)
    else:
        known = found.join(labelled.select("doc_id", "start", "end", "label"), ["doc_id", "start", "end"])
    return scored(found, fit_forest(known)).where(F.col("score") >= threshold).select("doc_id", "start", "end", "score")

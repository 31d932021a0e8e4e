"""Quality and toxicity: held-out accuracy, and nothing learnt from held-out rows."""

import os
import pickle
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import quality, toxicity
from shelfspark.llm.labelled import labelled_sample
from shelfspark.llm.words import is_held_out

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return tuple(spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    found = quality.quality_scores(docs, quality.fit_quality(docs, labels))
    assert found.count() == docs.count() and found.where("score < 0 or score > 1 or score is null").count() == 0
    held = found.join(labels, "doc_id").where("held_out")
    assert held.where("predicted = quality").count() >= 0.97 * held.count()
    assert found.where((F.col("score") >= 0.3) != (F.col("predicted") == 1)).count() == 0


def test_toxicity_of_planted_sentences(spark):
    draw = np.random.default_rng(3)
    plain = ["".join(draw.choice(list("aeioubcdfglmnprst"), draw.integers(3, 9))) for _ in range(1500)]
    insults = ["blockhead", "nitwit", "dimwit", "scoundrel"]
    rows, labels = [], []
    for i in range(700):
        words = draw.choice(plain, 60).tolist()
        if i % 3 == 0:
            words.insert(int(draw.integers(60)), insults[i % 4])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, known)
    held = toxicity.toxicity_scores(docs, model).where("held_out").join(known, "doc_id")
    assert held.count() > 100 and held.where("predicted = toxic").count() >= 0.97 * held.count()
    probe = ["you BLOCKHEAD.", "you b l o c k h e a d", "you block-head", "you blockxhead", "you blocks", None, "", "ordinary words"]
    scored = toxicity.toxicity_scores(spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string"), model)
    assert [r.predicted for r in scored.orderBy("doc_id").collect()] == [1, 1, 1, 1, 0, 0, 0, 0]
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.join(known, "doc_id").where("toxic = 1").count() <= 0.05 * 234


def test_toxicity_learns_from_given_labels(tables):
    docs, labels = tables
    found = toxicity.toxicity_scores(docs, toxicity.fit_toxicity(docs, labels)).join(labels, "doc_id")
    # documents labelled clean stay clean
    assert found.where("toxic = 0 and predicted = 1").count() <= 0.01 * found.where("toxic = 0").count()


def test_table_of_codes_equals_kernel_with_landmarks():
    bad, good = ["idiot", "moron", "scumbag"], ["idiom", "morning", "escutcheon", "plain"]
    marks = toxicity._Landmarks(bad, good, 1)
    w, b = toxicity._machine(marks.features(bad + good), np.repeat([1.0, -1.0], [3, 4]))
    direct = marks.features(["idxiot", "plane"]) @ w
    assert np.allclose(toxicity.sums(["idxiot", "plane"], marks.table(w)), direct, atol=1e-4)
    codes, phi = toxicity.kernel_features(bad)
    assert np.all(phi >= 0) and np.allclose((phi @ phi.T).T, phi @ phi.T)


def test_units():
    assert toxicity.units_of("I.d.1.o.t!!") == ["Idiot".lower()] and toxicity.units_of("12345") == [] and toxicity.units_of("a") == []
    assert all(len(u) <= toxicity.LONGEST for u in toxicity.units_of("x" * 1000))
    assert "idiot" in toxicity.words_of("an i d i o t here") and toxicity.words_of("") == set()


def test_held_out_rows_are_never_sampled(spark, tables):
    docs, labels = tables
    expected = {i for (i,) in labels.select("doc_id").collect() if zlib.crc32(str(i).encode()) % 5}
    got = {r.doc_id for r in labelled_sample(docs, labels, "toxic", 10_000).collect()}
    assert got == expected
    assert labelled_sample(docs, labels, "toxic", 20).count() == 20
    marks = spark.range(50).select(F.col("id").alias("doc_id"), is_held_out().alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in marks)


def test_gam_finds_an_interaction():
    draw = np.random.default_rng(4)
    x = np.zeros((4000, len(quality.FEATURES)))
    x[:, :4] = draw.random((4000, 4))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(int)
    model = quality.fit(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.95


def test_without_both_labels(spark, edges, nothing):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for fit, score in ((quality.fit_quality, quality.quality_scores), (toxicity.fit_toxicity, toxicity.toxicity_scores)):
        found = score(edges, fit(edges, labels))
        assert found.count() == edges.count() and found.where("score is null").count() == 0
        assert score(nothing, fit(nothing, labels.where("false"))).count() == 0
    assert toxicity.toxicity_scores(edges, toxicity.fit_toxicity(edges, labels)).where("predicted = 1").count() == 0


def test_word_scores_stay_with_their_model():
    # a later broadcast may lie where an earlier one was: here both are the same object
    class Sent:
        pass

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["insulting words"])], ["doc_id", "text"])
    sent, got = Sent(), []
    for weight in (0.0, 1.0):
        table = np.full(1 << 20, weight, np.complex64)
        table[0] = 0
        sent.value = toxicity.ToxicModel(table, (1.0, 1.0), (0.0, -9.0))
        got.append(next(toxicity._score(iter([batch]), 1, sent, "score", None)).column("score")[0].as_py())
    assert got[0] == 0.5 and got[1] > 0.9
    assert pickle.loads(pickle.dumps(sent.value)).known == {} and sent.value.known


def test_units_that_are_toxic_in_company_only():
    draw = np.random.default_rng(6)

    def word(n=7):
        return "".join(draw.choice(list("abcdefghilmnoprstu"), n))

    def text(stems):
        return " ".join(draw.permutation([word() for _ in range(30)] + ["zorgul" + word(3) for _ in range(stems)]))

    texts = [text(3) for _ in range(120)] + [text(int(draw.integers(2))) for _ in range(400)]
    model = toxicity.fit(texts, [1] * 120 + [0] * 400)
    new = [text(2 + i % 3) for i in range(60)] + [text(i % 2) for i in range(200)]
    p = model.probability(toxicity.worst_units(new, model.table, model.known))
    assert (p[:60] >= 0.5).mean() > 0.9 and (p[60:] >= 0.5).mean() < 0.03


def test_the_model_does_not_depend_on_the_hash_seed(tmp_path):
    import os
    import subprocess
    import sys

    code = (
        "import random, hashlib\nfrom shelfspark.llm import toxicity\nr = random.Random(1)\n"
        "w = lambda: ''.join(r.choice('abcdeilnorst') for _ in range(6))\n"
        "t = [' '.join([w() for _ in range(25)] + ['vermincur'] * (i < 60) + ['quzzle' + w() for _ in range(3 * (60 <= i < 130) + (i >= 130 and i % 3 == 0))]) for i in range(400)]\n"
        "m = toxicity.fit(t, [int(i < 130) for i in range(400)])\n"
        "print(hashlib.sha256(m.table.tobytes()).hexdigest(), m.slope, m.bias, abs(m.table.imag).max() > 0, abs(m.table.real).max() > 0)"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = {
        subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONHASHSEED": str(s), "PYTHONPATH": root}, capture_output=True, text=True, check=True).stdout
        for s in (1, 2, 3)
    }
    assert len(out) == 1 and out.pop().strip().endswith("True True")


def test_documents_that_share_a_common_unit_are_no_copies():
    draw = np.random.default_rng(8)
    # unit 0 is in all of them, and each has most of its units for itself
    docs = [np.unique(np.concatenate([[0], draw.integers(1, 100_000, 80)])) for _ in range(300)]
    near = [np.unique(np.append(d[:-3], draw.integers(1, 100_000, 3))) for d in docs[:100]]
    kept = toxicity._one_of_copies(docs + near)
    assert len([i for i in kept if i < 300]) == 300 and len([i for i in kept if i >= 300]) < 15

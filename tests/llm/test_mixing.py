"""Raking and sampling against the marginals asked for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm.mixing import OTHER, fit_mix, fit_tempered, form_topic, mix, n_words, rake, rake_within, tempered_targets

TARGETS = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.6, "de": 0.4}, "topic": {"x": 0.5, "y": 0.5}}


@pytest.fixture(scope="module")
def docs(spark):
    draw = np.random.default_rng(2)
    rows = [
        (i, str(draw.choice(["a", "b", "c"], p=[0.8, 0.1, 0.1])), str(draw.choice(["en", "de"], p=[0.9, 0.1])), str(draw.choice(["x", "y"])), int(draw.integers(1, 200)))
        for i in range(20_000)
    ]
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n long").withColumn("text", F.lit(None).cast("string"))


def test_expected_tokens_have_the_marginals(docs):
    mixed = mix(docs, TARGETS, "n").toPandas()
    expected = mixed.n * mixed.mix_probability
    for column, shares in TARGETS.items():
        got = expected.groupby(mixed[column]).sum() / expected.sum()
        assert all(abs(got[k] - v) < 1e-6 for k, v in shares.items())
        sampled = mixed[mixed.mix_kept].groupby(column).n.sum() / mixed[mixed.mix_kept].n.sum()
        assert all(abs(sampled[k] - v) < 0.05 for k, v in shares.items())
    assert mixed.mix_probability.max() == pytest.approx(1.0) and mixed.mix_probability.min() > 0
    assert mixed.mix_kept.mean() == pytest.approx(mixed.mix_probability.mean(), abs=0.02)


def test_budget_and_repeatability(docs):
    total = mix(docs, TARGETS, "n", budget=100_000.0)
    kept = total.where("mix_kept").agg(F.sum("n")).first()[0]
    assert kept == pytest.approx(100_000, rel=0.1)
    again = mix(docs.repartition(7), TARGETS, "n", budget=100_000.0)
    assert total.where("mix_kept").select("doc_id").exceptAll(again.where("mix_kept").select("doc_id")).count() == 0


def test_rake_by_hand():
    # two by two table with tokens 40 30 20 10, raked to halves, has the known odds ratio
    at = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    n = np.array([40.0, 30, 20, 10])
    out = n * rake(n, at, [np.array([0.5, 0.5])] * 2)
    assert np.allclose(out[[0, 1]].sum(), 0.5) and np.allclose(out[[0, 2]].sum(), 0.5)
    assert np.isclose(out[0] * out[3] / (out[1] * out[2]), 40 * 10 / (30 * 20))


def test_unnamed_null_and_empty(spark, docs):
    odd = spark.createDataFrame([(1, None, "en", "x", 5, "t"), (None, "zz", None, "y", 7, "u"), (2, "a", "en", "x", 0, None), (None, "a", "en", "x", None, None)],
                                "doc_id long, source string, lang string, topic string, n long, text string")
    mixed = mix(odd, {"source": {"a": 0.5}, "lang": {"en": 1.0}}, "n")
    assert mixed.count() == 4 and mixed.where("mix_kept is null or mix_probability is null").count() == 0
    assert mix(docs.where("false"), TARGETS, "n").count() == 0
    assert set(fit_mix(odd, {"source": {"a": 0.5}}, "n").names["source"]) == {"a", OTHER}
    with pytest.raises(ValueError):
        fit_mix(odd, {c: {str(i): 1 / 2000 for i in range(2000)} for c in ("source", "lang")}, "n")


def test_tempered_targets(docs):
    found = tempered_targets(docs, {"source": 0.5, "lang": 1.0}, "n", most=2)
    assert sum(found["source"].values()) == pytest.approx(1) and len(found["source"]) == 3 and OTHER in found["source"]
    assert found["source"]["a"] < 0.8


def test_words_and_topics(spark):
    rows = [("a b\tc\n", 3, "prose"), (None, 0, "note"), ("", 0, "note"), ("x | y", 3, "table"), ("A!! B!!", 2, "shouting")]
    df = spark.createDataFrame(rows, "t string, n int, topic string")
    assert df.where((n_words(F.col("t")) != F.col("n")) | (form_topic(F.col("t")) != F.col("topic"))).count() == 0


def test_every_source_of_a_long_tail_has_its_share(spark):
    # one hot source, one named like the rest, one without a name and a tail of 200
    sizes = {"hot": 100_000, OTHER: 3000, None: 500} | {f"s{i}": 100 + i for i in range(200)}
    rows = [(s, lang, n * m) for s, n in sizes.items() for lang, m in (("en", 3), ("de", 1))]
    docs = spark.createDataFrame(rows, "source string, lang string, n long")
    mixed = fit_tempered(docs, {"source": 0.7, "lang": 0.85}, "n", 0.01).applied(docs).toPandas()
    assert len(mixed) == len(rows)
    got = (mixed.n * mixed.mix_weight).groupby(mixed.source.fillna("-")).sum()
    flat = {s or "-": (4 * n) ** 0.7 for s, n in sizes.items()}
    assert all(abs(got[s] / got.sum() - v / sum(flat.values())) < 1e-6 for s, v in flat.items())
    assert fit_tempered(docs.where("false"), {"source": 0.7}, "n", 0.8).applied(docs.where("false")).count() == 0
    # what isn't named has the sum of its shares, a source named like it its own on top
    named = tempered_targets(docs, {"source": 0.7}, "n", most=2)["source"]
    assert named[OTHER] == pytest.approx(1 - flat["hot"] / sum(flat.values())) and set(named) == {"hot", OTHER}


def test_a_rare_cell_does_not_shrink_the_sample(spark):
    sizes = {"hot": 50_000, "rare": 10} | {f"s{i}": 5000 for i in range(18)}
    rows = [(s, lang, n * m) for s, n in sizes.items() for lang, m in (("en", 3), ("de", 1))]
    docs = spark.createDataFrame(rows, "source string, lang string, n long")
    mixed = fit_tempered(docs, {"source": 0.7, "lang": 0.85}, "n", 0.8).applied(docs).toPandas()
    expected = mixed.n * mixed.mix_probability
    assert expected.sum() == pytest.approx(0.8 * mixed.n.sum()) and mixed.mix_probability.max() <= 1
    assert (mixed.mix_probability[mixed.source == "rare"] > 1 - 1e-6).all()
    en, de = (expected[mixed.lang == x].sum() / expected.sum() for x in ("en", "de"))
    assert en / de == pytest.approx(3**0.85)
    # the sources that can have their shares have them, as far as they go by what is left
    got = expected.groupby(mixed.source).sum()
    assert got["hot"] / got["s0"] == pytest.approx(10**0.7, rel=1e-6)


def test_probabilities_stay_within_one_and_meet_all_marginals():
    draw = np.random.default_rng(6)
    at = np.array([(a, b, c) for a in range(30) for b in range(4) for c in range(6)]).T
    for n in (draw.lognormal(5, 0.4, len(at[0])) * np.repeat([9, 1, 0.01], [24, 24 * 28, 24]), draw.pareto(0.8, len(at[0])) * 100 + 1):
        shares = [(h := np.bincount(x, n)) ** p / (h**p).sum() for x, p in zip(at, (0.7, 0.85, 1.0), strict=True)]
        for part in (0.05, 0.5, 0.8, 1.0):
            p = rake_within(n, list(at), shares, part * n.sum())
            assert p.max() <= 1 and p.min() > 1e-4 and (p * n).sum() == pytest.approx(part * n.sum(), rel=1e-6)
            if n.max() > 0.1 * n.sum():
                continue  # a cell as large as this makes the marginals contradict each other
            for x, share in zip(at, shares, strict=True):
                got, have = np.bincount(x, p * n), np.bincount(x, n)
                loose = got < have * (1 - 1e-6)
                ratio = got[loose] / share[loose]
                assert ratio.size == 0 or np.allclose(ratio, ratio[0], rtol=1e-4)
                assert all(have[~loose] <= share[~loose] * (ratio[0] if ratio.size else np.inf) * (1 + 1e-4))

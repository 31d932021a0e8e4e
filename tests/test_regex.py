"""First match and groups of random patterns against ``re``."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.functions.regex import first_group, needed_literal, needs_context
from shelfspark.operators.extract import DETAIL_RULES

TEXTS = ["", "a", "ab", "ax12 b", "xx12", "aab b1", "1 a2b3", "b\nab", "x1 b x2  b", "12", "aaab", " "]
LOOKING = [
    (r"(?<=x)(\d+)", 1), (r"(\d+)(?= b)", 1), (r"(?<!x)(\d)", 1), (r"(a+)(?!b)", 1), (r"\b(\w)\b", 1), (r"^(a)", 1), (r"(b)$", 1),
    (r"a|(a?)", 1), (r"(a?)|b", 1), (r"(?:(x)|(\d))(?= )", 1), (r"(?:(x)|(\d))(?= )", 2), (r"(?<=x)(y?)", 1), (r"(?<=a)(x)?(b)?", 2),
]


def expected(pattern, group, text):
    found = re.search(pattern, text)
    return found.group(group) if found else None


def check(spark, cases):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").coalesce(1)
    columns = [first_group(F.col("t"), p, g).alias(f"c{i}") for i, (p, g) in enumerate(cases)]
    for row in rows.select("t", *columns).collect():
        for i, (p, g) in enumerate(cases):
            assert row[f"c{i}"] == expected(p, g, row.t), (p, g, row.t)


def test_patterns_that_look_around(spark):
    assert sum(needs_context(p) for p, _ in LOOKING) == len(LOOKING) - 2
    check(spark, LOOKING)


@pytest.mark.parametrize("seed", range(4))
def test_random_patterns(spark, seed):
    rng = random.Random(seed)
    atoms = ["a", "b", "x", r"\d", "[ab]", "[^x]", " "]

    def piece(depth):
        roll = rng.random()
        if depth and roll < 0.35:
            inner = "|".join(pattern(depth - 1) for _ in range(rng.choice([1, 2])))
            return ("(" if rng.random() < 0.6 else "(?:") + inner + ")" + rng.choice(["", "", "?"])  # engines differ in repeated groups that match nothing
        if roll < 0.45:
            return rng.choice([r"(?=b)", r"(?<=a)", r"(?!a)", r"(?<!x)", r"\b"])
        return rng.choice(atoms) + rng.choice(["", "", "+", "*", "?"])

    def pattern(depth):
        return "".join(piece(depth) for _ in range(rng.choice([1, 2, 3])))

    cases = []
    while len(cases) < 25:
        p = pattern(2)
        groups = re.compile(p).groups
        if groups:
            cases.append((p, rng.randrange(1, groups + 1)))
    check(spark, cases)


def test_literals_that_every_match_has():
    wanted = {
        "abc": "abc", "a(bc)d": "abcd", "ab?cd": "cd", "(ab|cd)e": "e", "x(?:abc)+y": "abc", "x(?:abc)*y": "x", r"<b>\s*(.*?)</b>": "</b>",
        "": "", "[a]bc": "abc", "[ab]cd": "cd", r"\d+": "", "(?i:abc)d": "d", "a.b": "a", "(?=abc)x": "x", "(?<!abc)xy": "xy", r"a\.b": "a.b",
    }
    assert {p: needed_literal(p) for p in wanted} == wanted
    assert all(len(needed_literal(r.pattern)) > 3 for r in DETAIL_RULES)


def test_random_patterns_match_only_texts_with_their_literal():
    rng = random.Random(5)
    for _ in range(3000):
        p = "".join(rng.choice(["a", "b", "ab", "(a|b)", "(ab)?", "(?:ba)+", ".", "[ab]", "(a(b))", "b*", "(?=a)"]) for _ in range(5))
        text = "".join(rng.choice("abx") for _ in range(12))
        found = re.search(p, text)
        assert not found or needed_literal(p) in text, (p, text)

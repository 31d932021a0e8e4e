"""Near-duplicates against all pairs compared on full sets."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from shelfspark.llm.components import connected_components
from shelfspark.llm.near_dedup import BANDS, ROWS, largest_distance, minhashes, near_duplicates, odd_sketches
from shelfspark.llm.words import shingle_set


def brute(texts, k, percent):
    """Component by id, from sets of tuples of words."""
    sets = {}
    for i, t in texts.items():
        w = [x for x in (t or "").encode().lower().split()]
        n = min(k, len(w))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()
    part = {i: i for i in texts}

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            part[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def as_dict(found):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}


def test_equals_all_pairs(given):
    docs, texts = given
    assert as_dict(near_duplicates(docs, k=2)) == brute(texts, 2, 80)


def test_hot_group_of_near_copies(spark):
    draw = np.random.default_rng(1)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in draw.integers(0, 80, draw.integers(0, 9)):
            words[at] = f"new{draw.integers(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base)) for i in range(200)]
    rows += [(2000 + i, " ".join(f"z{i}_{j}" for j in range(20))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_dict(near_duplicates(docs, k=2)) == brute(dict(rows), 2, 80)


def test_edges(edges, nothing):
    found = near_duplicates(edges, k=2)
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()}
    assert found.count() == edges.count()
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 5, True), (6, 1, 5, False)} <= rows
    assert (11, 11, 10, False) in rows or (11, 11, 11, True) in rows
    assert all(kept and part is None for i, _, part, kept in rows if i is None)
    assert sum(i == 7 for i, *_ in rows) == 1 and found.where("doc_id = 7 and kept").count() == 2
    empty = near_duplicates(nothing)
    assert empty.count() == 0 and empty.columns == found.columns


def test_sketch_keeps_pairs_at_the_threshold():
    draw = np.random.default_rng(2)
    far = []
    for _ in range(300):
        common, rest = draw.integers(0, 2**63, 400, np.uint64), draw.integers(0, 2**63, 100, np.uint64)
        a, b = np.concatenate([common, rest[:50]]), np.concatenate([common, rest[50:]])
        x, y = odd_sketches(minhashes([a, b], BANDS * ROWS)).view(np.uint64)
        far.append(sum(int(v).bit_count() for v in x ^ y))
    assert max(far) <= largest_distance(0.8)
    unlike = odd_sketches(minhashes([draw.integers(0, 2**63, 500, np.uint64) for _ in range(2)], BANDS * ROWS)).view(np.uint64)
    assert sum(int(v).bit_count() for v in unlike[0] ^ unlike[1]) > largest_distance(0.8)


def test_components_of_a_long_path(spark):
    ends = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(ends, "a long, b long"))
    parts = {r.node: r.component for r in found.collect()}
    assert {parts[i] for i in range(61)} == {0} and {parts[i] for i in (100, 200, 300)} == {100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_of_whole_words():
    assert len(shingle_set(b"A b a B", 2)) == 2 and len(shingle_set(b"a", 2)) == 1 and len(shingle_set(b" ", 2)) == 0
    assert set(shingle_set(b"ab c", 2)) != set(shingle_set(b"a bc", 2))


def test_kept_is_one_of_each_component(given):
    docs, _ = given
    found = near_duplicates(docs)
    per = found.groupBy("component_id").agg(F.sum(F.col("kept").cast("int")).alias("n"))
    assert per.where("n <> 1").count() == 0

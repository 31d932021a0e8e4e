"""Benchmark hits against every window of every document."""

import numpy as np
from collections import Counter, defaultdict

from shelfspark.llm.decontaminate import RADIUS, Benchmark, benchmark_hits, passage_words, without_benchmark
from shelfspark.llm.words import shingles, word_hashes


def brute(bench, texts, similarity=0.8):
    sharing = defaultdict(set)
    for item, bag in enumerate(bench.bags):
        for s in bag:
            sharing[s].add(item)
    out = set()
    for doc, text in texts.items():
        found = shingles(word_hashes(passage_words((text or "").encode())), bench.k)
        for item in {x for s in found.tolist() for x in sharing.get(s, ())}:
            width = bench.sizes[item] - bench.k + 1
            if any(bench.exact(item, found[a : a + width]) >= similarity for a in range(len(found) - width + 1)):
                out.add((doc, bench.ids[item]))
    return out


def words(draw, n):
    return [f"w{draw.integers(400)}" for _ in range(n)]


def planted():
    draw = np.random.default_rng(7)
    items = {i: " ".join(words(draw, int(draw.integers(12, 60)))) for i in range(30)}
    texts = {}
    for i in range(300):
        body = words(draw, 120)
        if i % 3 == 0:
            passage = items[i % 30].split()
            for at in draw.integers(0, len(passage), int(draw.integers(0, 4))):
                passage[at] = "changed"
            body[40:40] = passage if i % 2 else [w.upper() + "," for w in passage]
        texts[i] = " ".join(body)
    return items, texts


def test_equals_all_windows(spark):
    items, texts = planted()
    docs, bench = (spark.createDataFrame(list(x.items()), s) for x, s in ((texts, "doc_id long, text string"), (items, "item_id long, text string")))
    got = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, bench).collect()}
    expected = brute(Benchmark([(i, t.encode()) for i, t in items.items()], 5, 0.8), texts)
    assert got == expected and len(got) > 25
    kept = {r.doc_id for r in without_benchmark(docs, bench).collect()}
    assert kept == set(texts) - {d for d, _ in got}


def test_given_tables(spark, given):
    docs, texts = given
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    bench = Benchmark([(r.item_id, r.text.encode()) for r in items.collect()], 5, 0.8)
    got = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, items).collect()}
    assert got == brute(bench, texts)
    assert {(d, r.item_id) for r in items.collect() for d, t in texts.items() if r.text in t} <= got


def test_blocks_name_all_fingerprints_within_the_radius():
    draw = np.random.default_rng(8)
    items, _ = planted()
    bench = Benchmark([(i, t.encode()) for i, t in items.items()], 5, 0.8)
    for size, which in bench.of_size.items():
        prints = draw.integers(0, 256, (200, 8)).astype(np.uint8)
        prints[::2] = bench.prints[draw.choice(which, 100)] ^ np.packbits(draw.random((100, 64)) < 0.25, axis=1)
        far = np.unpackbits(prints[:, None] ^ bench.prints[which][None], axis=2).sum(2)
        expected = {(int(a), int(which[b])) for a, b in zip(*np.nonzero(far <= RADIUS), strict=True)}
        assert set(zip(*(x.tolist() for x in bench.within(size, prints)), strict=True)) == expected


def test_small_blocks_find_the_same(spark, monkeypatch):
    items, texts = planted()
    docs, bench = (spark.createDataFrame(list(x.items()), s) for x, s in ((texts, "doc_id long, text string"), (items, "item_id long, text string")))
    expected = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, bench).collect()}
    monkeypatch.setattr("shelfspark.llm.decontaminate.BLOCK_CHARS", 2000)
    assert {(r.doc_id, r.item_id) for r in benchmark_hits(docs, bench).collect()} == expected


def test_edges(spark, edges, nothing):
    bench = spark.createDataFrame([(1, "one two"), (2, None), (None, "x x x x x x x"), (3, "  ,, "), (4, "one two")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in benchmark_hits(edges, bench).collect()}
    assert got == {(5, 1), (5, 4), (6, 1), (6, 4)}
    kept = without_benchmark(edges, bench)
    assert kept.columns == edges.columns and kept.count() == edges.count() - 2
    assert benchmark_hits(nothing, bench).count() == 0 and benchmark_hits(edges, bench.where("false")).count() == 0
    assert without_benchmark(edges, bench.where("false")).count() == edges.count()


def plain(item, text, k=5):
    """Best similarity of the item's windows, or of the whole text where it has fewer words, by counting five-word runs."""
    a, b = item.split(), text.split()
    def runs(w):
        return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    mine, n = runs(a), min(len(a), len(b))
    return max(((mine & o).total() / (mine | o).total() for o in (runs(b[i : i + n]) for i in range(len(b) - n + 1)) if o), default=0.0)


def templated():
    """Items that repeat, items that share a template, and documents with a word changed in either."""
    draw = np.random.default_rng(9)
    same, form = words(draw, 50), words(draw, 45)
    items = {i: " ".join(same) for i in range(10)} | {10 + i: " ".join([*form, *(f"v{i}x{j}" for j in range(15))]) for i in range(12)}
    items |= {30 + i: " ".join(words(draw, int(draw.integers(12, 60)))) for i in range(10)}
    texts = {}
    for i in range(60):
        passage = items[list(items)[i % len(items)]].split()
        passage[int(draw.integers(len(passage)))] = "changed"
        texts[i] = " ".join([*words(draw, 40), *passage, *words(draw, 40)])
    return items, texts


def test_near_copies_of_repeated_and_templated_items(spark, monkeypatch):
    items, texts = templated()
    docs, bench = (spark.createDataFrame(list(x.items()), s) for x, s in ((texts, "doc_id long, text string"), (items, "item_id long, text string")))
    found = benchmark_hits(docs, bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    sure = {(d, i) for d, t in texts.items() for i, item in items.items() if plain(item, t) >= 0.8}
    assert sure <= got and len({d for d, i in sure if i < 10}) > 5 and len({d for d, i in sure if 10 <= i < 30}) > 5
    assert got == brute(Benchmark([(i, t.encode()) for i, t in items.items()], 5, 0.8), texts)
    # neither hits nor similarities depend on the blocks
    monkeypatch.setattr("shelfspark.llm.decontaminate.BLOCK_CHARS", 1500)
    assert {tuple(r) for r in benchmark_hits(docs, bench).collect()} == {tuple(r) for r in found}


def test_rare_shingles_name_every_item_found_without_fingerprints(monkeypatch):
    items, texts = templated()
    bench = Benchmark([(i, t.encode()) for i, t in items.items()], 5, 0.8)
    expected = {d: bench.matches(t.encode()) for d, t in texts.items()}
    monkeypatch.setattr(Benchmark, "within", lambda *_: (np.empty(0, np.int64), np.empty(0, np.int64)))
    assert {d: bench.matches(t.encode()) for d, t in texts.items()} == expected


def test_document_with_fewer_words_than_the_item(spark):
    item = words(np.random.default_rng(4), 40)
    texts = {n: " ".join(item[:n]) for n in (40, 39, 36, 33, 32, 5, 2)} | {100: " ".join(item[1:]), 101: " ".join([*item[:2], *item[3:]]), 102: " ".join(words(np.random.default_rng(5), 39))}
    items = {1: " ".join(item), 2: " ".join(item[:12])}
    docs, bench = (spark.createDataFrame(list(x.items()), s) for x, s in ((texts, "doc_id long, text string"), (items, "item_id long, text string")))
    got = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, bench).collect()}
    assert {d for d, i in got if i == 1} == {d for d, t in texts.items() if plain(items[1], t) >= 0.8} == {40, 39, 36, 33, 100, 101}
    assert {d for d, i in got if i == 2} == {d for d, t in texts.items() if plain(items[2], t) >= 0.8}
    kept = {r.doc_id for r in without_benchmark(docs, bench).collect()}
    assert kept == set(texts) - {d for d, _ in got}


def test_fingerprints_alone_find_nearly_all(monkeypatch):
    """The Hamming index by itself, without the index of rare shingles: its recall is measured."""
    items, texts = templated()
    bench = Benchmark([(i, t.encode()) for i, t in items.items()], 5, 0.8)
    expected = {(d, i) for d, t in texts.items() for i, *_ in bench.matches(t.encode())}
    monkeypatch.setattr(Benchmark, "named", lambda *_: np.empty(0, np.int64))
    got = {(d, i) for d, t in texts.items() for i, *_ in bench.matches(t.encode())}
    assert got <= expected and len(got) >= 0.95 * len(expected), len(got) / len(expected)


def test_slices_of_windows_give_the_same(monkeypatch):
    items, texts = templated()
    bench = Benchmark([(i, t.encode()) for i, t in items.items()], 5, 0.8)
    expected = {d: bench.matches(t.encode()) for d, t in texts.items()}
    monkeypatch.setattr("shelfspark.llm.decontaminate.CELLS", 50)
    assert {d: bench.matches(t.encode()) for d, t in texts.items()} == expected
    assert [len(x) for x in bench.within(50, np.empty((0, 8), np.uint8))] == [0, 0]

"""Line de-duplication against a plain restatement, and the perfect hash by itself."""

import collections
import hashlib

import numpy as np

from shelfspark.llm.line_dedup import PerfectHash, drop_repeated_lines, line_key

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOW)


def brute(rows):
    count, last = collections.Counter(), {}
    for i, t in rows:
        if i is not None:
            for k in {key(x) for x in (t or "").split("\n")}:
                if len(k) >= 40:
                    count[k] += 1
                    last[k] = max(last.get(k, i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or not (count[key(x)] >= 5 and last[key(x)] != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return collections.Counter(out)


def result(found):
    return collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found.collect())


def test_equals_plain(given):
    docs, texts = given
    assert result(drop_repeated_lines(docs, digest=True)) == brute(list(texts.items()))


def test_hot_line(spark):
    line = "a common line that more than a third of the documents have"
    rows = [(i, f"{line}\nown line number {i} that is certainly long enough\n{line}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(drop_repeated_lines(docs, digest=True)) == brute(rows)


def test_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert result(drop_repeated_lines(edges, digest=True)) == brute(rows)
    assert drop_repeated_lines(edges).where("doc_id = 13").first().kept_text.startswith("This line")
    assert drop_repeated_lines(nothing, digest=True).count() == 0


def test_perfect_hash_is_minimal_and_survives_storage():
    draw = np.random.default_rng(3)
    h1, h2 = draw.integers(0, 2**63, (2, 5000), np.uint64)
    h1[:10] = h1[10:20]  # equal halves, different keys
    index = PerfectHash.load(PerfectHash.build(h1, h2).dump())
    assert sorted(index.slots(h1, h2)) == list(range(5000))
    assert PerfectHash.build(h1[:0], h2[:0]).slots(h1, h2).max() == -1


def test_key_counts_code_points():
    assert line_key(("é" * 39).encode(), 40) is None and line_key(("É" * 40).encode(), 40) == ("É" * 40).encode()

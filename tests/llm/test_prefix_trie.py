"""The prefix trie and tree contraction against plain Python."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import prefix_trie
from shelfspark.llm.tree_contraction import subtree_totals
from shelfspark.llm.workspace import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shared(c):
    return zlib.crc32(str(c).encode()) % 4


def plain(rows):
    """Rebuilt conversations and their trie, node by node."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        other = c - (c % 20 if c >= 0 else -(-c % 20))
        rebuilt[c] = tuple(own.get(other, [])[: shared(c)] + turns[shared(c) :])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    out = {}

    def visit(p):
        stack, order = [p], []
        while stack:
            x = stack.pop()
            order.append(x)
            stack.extend(kids.get(x, []))
        leaves, saved = {}, {}
        for x in reversed(order):
            own_saved = (len(members[x]) - 1) * len(WORD.findall(x[-1][1])) if x else 0
            leaves[x] = sum(leaves[k] for k in kids.get(x, [])) or 1
            saved[x] = own_saved + sum(saved[k] for k in kids.get(x, []))
            ends = ",".join(str(c) for c in sorted(c for c in members[x] if rebuilt[c] == x))
            out[(min(members[x]), len(x))] = (
                min(members[x[:-1]]) if x else None, len(members[x]), len(kids.get(x, [])), leaves[x], saved[x],
                hashlib.sha256(ends.encode()).hexdigest(),
            )

    if members:
        visit(())
    return out


def built(spark, rows):
    table = spark.createDataFrame(
        [(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, depth int"
    )
    work = Workspace(spark, "test")
    given = prefix_trie.ordered(table, work)
    rebuilt = prefix_trie.started_by_others(
        given, work, lambda c: c - c % 20, lambda c: F.crc32(c.cast("string").cast("binary")) % 4, most=3
    )
    found = prefix_trie.prefix_trie(rebuilt, work).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    assert len(got) == len(found)
    return got


def test_random_conversations_equal_plain(spark):
    rng = random.Random(3)
    rows = []
    for c in range(-25, 70):
        for t in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a b", "c", "", None])))
    assert built(spark, rows) == plain(rows)


def test_edges_equal_plain(spark):
    rows = [
        (None, 1, "user", "no conversation"), (1, None, "user", "first"), (1, None, "user", "first"), (1, 0, None, None),
        (1, 0, None, "tie b"), (1, 0, "a", "tie a"), (20, 5, "user", ""), (21, 1, "user", "only one"), (23, 1, "user", "gone"),
        (40, 1, "x", "  \t "), (41, 1, "x", "x " * 50_000), (42, 1, "x", None), (43, -3, "é", "😀 ü"), (44, 1, "ab", "c"), (45, 1, "a", "bc"),
    ]
    assert built(spark, rows) == plain(rows)


def test_no_conversations(spark):
    assert built(spark, []) == {} and built(spark, [(None, 1, "user", "x")]) == {}


def test_hot_conversations_and_a_long_one(spark, monkeypatch):
    """A third of all conversations alike, many ends at one node, one conversation of many blocks."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    rows = [(c * 20, t, "user", f"same {t}") for c in range(3000) for t in range(2)]
    rows += [(7, t, "user", "on") for t in range(700)]
    rows += [(c * 20 + 1, t, "user", f"own {c}") for c in range(1000) for t in range(3)]
    assert built(spark, rows) == plain(rows)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "broom", "forest", "empty"])
def test_subtree_totals(spark, shape):
    rng = random.Random(5)
    n = 400
    parents = {
        "chain": [None] + list(range(n - 1)), "star": [None] + [0] * (n - 1),
        "random": [None] + [rng.randrange(i) for i in range(1, n)],
        "broom": [None] + [i - 1 if i < 200 else 199 for i in range(1, n)],
        "forest": [None if i % 50 == 0 else i - 1 for i in range(n)], "empty": [],
    }[shape]
    weight = [rng.randrange(1, 9) for _ in parents]
    rows = [(i, p, i not in parents, 1, w) for i, (p, w) in enumerate(zip(parents, weight, strict=True))]
    nodes = spark.createDataFrame(rows, "node long, parent long, is_leaf boolean, size long, weight long")
    found = subtree_totals(nodes, ["size", "weight"], Workspace(spark, "test")).collect()
    size, total = [1] * len(parents), list(weight)
    for i in reversed(range(len(parents))):
        if parents[i] is not None:
            size[parents[i]] += size[i]
            total[parents[i]] += total[i]
    assert {(r.node, r.size, r.weight) for r in found} == set(zip(range(len(parents)), size, total, strict=True))
    assert len(found) == len(parents)


def test_rounds_grow_with_the_logarithm_of_a_chain(spark):
    n = 600
    rows = [((0, i), (0, i - 1) if i else None, i == n - 1, 1) for i in range(n)]
    kind = "struct<conv_id: long, depth: long>"
    nodes = spark.createDataFrame(rows, f"node {kind}, parent {kind}, is_leaf boolean, size long")
    work = Workspace(spark, "test")
    found = subtree_totals(nodes, ["size"], work, prefix_trie._rank)
    assert {(r.node.depth, r.size) for r in found.collect()} == {(i, n - i) for i in range(n)}
    assert work.made <= 2 * 13 + 6

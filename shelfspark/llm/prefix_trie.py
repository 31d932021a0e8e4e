"""The trie of conversation prefixes: what conversations share from their first turn on.

A node of depth d is a distinct sequence of d turns; its members are the conversations that
start with it. A turn's place in its conversation comes from one global sort by range, the
rows' numbers in the sorted partitions and the few sums of whole partitions, so that a
conversation of any length is dealt over many tasks. A prefix is known by 124 bits: the sum
of hashes of its turns, each hashed with its place, which makes prefixes sums over blocks
of places instead of one pass over a conversation. Subtree sums are by tree contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfspark.llm.tree_contraction import subtree_totals
from shelfspark.llm.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 4096  # places of a conversation that are summed together
END_BITS = 10  # ids of ending conversations are joined to texts by their higher bits first

_LIMB = 1 << 31
_LIMBS = ("a", "b", "c", "d")
_KEY = ("depth", "k1", "k2")


@dataclass(frozen=True)
class Conversations:
    """``turns`` (conv_id, pos from 1, digest, words, length) and ``convs`` (conv_id, length),
    the length being the conversation's number of turns."""

    turns: DataFrame
    convs: DataFrame


def ordered(
    rows: DataFrame, work: Workspace, conv_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Conversations:
    """Turns with their places.

    Turns are in order of ``order_col``, null first, those that share it by role, then text;
    null role or text is empty. Repeated rows are turns of their own. Rows without a
    conversation are left out.
    """
    turns = rows.select(
        rows[conv_col].cast("long").alias("conv_id"), rows[order_col].alias("turn"),
        F.coalesce(rows[role_col].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text_col].cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    order = ("conv_id", "turn", "role", "text")
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    marked = work.put(
        turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id", F.monotonically_increasing_id().alias("at"),
            F.unhex(F.sha2(content, 256)).alias("digest"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        ),
        "sorted",
    ).withColumn("part", F.shiftright("at", 33))
    # a conversation has as many rows here as partitions hold its turns
    runs = marked.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = work.put(
        runs.select(
            "conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
            F.sum("n").over(whole).alias("length"),
        ),
        "runs",
    )
    placed = marked.join(runs, ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("pos"), "digest", "words", "length"
    )
    return Conversations(work.put(placed, "placed"), runs.where("before = 0").select("conv_id", "length"))


def started_by_others(
    given: Conversations, work: Workspace, other: Callable[[Column], Column], shared: Callable[[Column], Column], most: int
) -> Conversations:
    """Conversations whose first ``shared(id)`` turns, ``most`` at most, are those of ``other(id)``.

    Where the other conversation has fewer turns all are taken, where it is absent none.
    A conversation may be left without a turn.
    """
    ids = given.convs.select("conv_id", "length", other(F.col("conv_id")).alias("other_id"), shared(F.col("conv_id")).cast("long").alias("shared"))
    lengths = given.convs.select(F.col("conv_id").alias("other_id"), F.col("length").alias("other_length"))
    taken = F.least("shared", F.coalesce("other_length", F.lit(0)))
    convs = work.put(
        ids.join(lengths, "other_id", "left").select(
            "conv_id", "other_id", "shared", taken.alias("taken"), (taken + F.greatest(F.col("length") - F.col("shared"), F.lit(0))).alias("new_length")
        ),
        "rebuilt",
    )
    # a conversation's own numbers reach its turns by the id and the place in thousands
    place = F.expr(f"(pos - 1) div {BLOCK}")
    spread = convs.join(given.convs, "conv_id").withColumn("place", F.explode(F.expr(f"sequence(0L, (length - 1) div {BLOCK})")))
    own = (
        given.turns.withColumn("place", place).drop("length").join(spread, ["conv_id", "place"])
        .where(F.col("pos") > F.col("shared"))
        .select("conv_id", (F.col("pos") - F.col("shared") + F.col("taken")).alias("pos"), "digest", "words", F.col("new_length").alias("length"))
    )
    heads = given.turns.where(F.col("pos") <= most).select(F.col("conv_id").alias("other_id"), "pos", "digest", "words")
    begun = (
        heads.join(convs.where("taken > 0"), "other_id").where(F.col("pos") <= F.col("taken"))
        .select("conv_id", "pos", "digest", "words", F.col("new_length").alias("length"))
    )
    return Conversations(own.unionByName(begun), convs.select("conv_id", F.col("new_length").alias("length")))


def _key(sums: list[Column]) -> list[Column]:
    low = [s % _LIMB for s in sums]
    return [low[0] * _LIMB + low[1], low[2] * _LIMB + low[3]]


def prefixes(turns: DataFrame, work: Workspace) -> DataFrame:
    """``(conv_id, depth, k1, k2, p1, p2, words, ends)``: every prefix of every conversation,
    its key and its parent's."""
    hashes = [F.xxhash64(F.lit(seed), "digest", "pos") for seed in (1, 2)]
    limbs = [x for h in hashes for x in (h.bitwiseAND(F.lit(_LIMB - 1)), F.shiftrightunsigned(h, 33))]
    rows = turns.select(
        "conv_id", F.col("pos").alias("depth"), "words", "length", F.expr(f"(pos - 1) div {BLOCK}").alias("block"),
        *(x.alias(n) for x, n in zip(limbs, _LIMBS, strict=True)),
    )
    up_to = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    inner = rows.select("*", *(F.sum(n).over(up_to).alias(f"{n}_in") for n in _LIMBS))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.where(F.col("length") > BLOCK).groupBy("conv_id", "block").agg(*(F.sum(n).alias(n) for n in _LIMBS))
    blocks = blocks.select("conv_id", "block", *(F.sum(n).over(earlier).alias(f"{n}_before") for n in _LIMBS))
    found = inner.join(blocks, ["conv_id", "block"], "left")
    sums = [F.col(f"{n}_in") + F.coalesce(F.col(f"{n}_before"), F.lit(0)) for n in _LIMBS]
    keys = _key(sums) + _key([s - F.col(n) for s, n in zip(sums, _LIMBS, strict=True)])
    return work.put(
        found.select(
            "conv_id", "depth", *(x.alias(n) for x, n in zip(keys, ("k1", "k2", "p1", "p2"), strict=True)), "words",
            (F.col("depth") == F.col("length")).alias("ends"),
        ),
        "prefixes",
    )


def _hash_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the texts of each key, comma-joined; a key's rows come together and in order."""
    key, state = None, None
    for batch in batches:
        done = []
        for *k, text in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids")), strict=True):
            if k != key:
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield _hashed(done)
    if key:
        yield _hashed([(*key, state.hexdigest())])


def _hashed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(columns)], [*_KEY, "ends_sha256"]
    )


def _end_hashes(ends: DataFrame) -> DataFrame:
    """Hash of the ids that end at each node, in order: ids that share all but their lowest
    bits are joined first, then a node's texts are hashed one after the other."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    texts = ends.groupBy(*_KEY, F.shiftright("conv_id", END_BITS).alias("high")).agg(ids.alias("ids"))
    sorted_texts = texts.repartition(*_KEY).sortWithinPartitions(*_KEY, "high").select(*_KEY, "ids")
    return sorted_texts.mapInArrow(_hash_runs, "depth long, k1 long, k2 long, ends_sha256 string")


def _rank(node: Column) -> Column:
    """Odd depths above even ones, these by half their depth in the same way; then by hash."""
    depth = node["depth"]
    zeros = F.bit_count(depth.bitwiseAND(-depth) - 1)
    return F.struct((-zeros).alias("z"), F.xxhash64(node).alias("h"))


def prefix_trie(given: Conversations, work: Workspace) -> DataFrame:
    """One row per node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``
    (null at the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``.

    ``saved_tokens`` are the words that need not be processed again, summed over the subtree:
    for each node its members but one, times the words of its last turn. ``ends_sha256`` is
    the hash of the ids, in order and comma-joined, of the conversations that end there.
    Without conversations there is no node, not even a root.
    """
    prefix = prefixes(given.turns, work)
    zero = F.lit(0).cast("long")
    grown = prefix.groupBy(*_KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.min("p1").alias("p1"),
        F.min("p2").alias("p2"), F.min("words").alias("words"),
    )
    roots = given.convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "n_convs", "conv_id", F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), zero.alias("words"),
    )
    keyed = work.put(grown.unionByName(roots), "nodes")
    children = keyed.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = children.agg(F.count("*").alias("n_children"))
    ends = prefix.where("ends").select(*_KEY, "conv_id").unionByName(
        given.convs.where("length = 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    )
    named = keyed.join(children, list(_KEY), "left").join(_end_hashes(ends), list(_KEY), "left")
    above = keyed.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = work.put(
        named.join(above, ["depth", "p1", "p2"], "left").select(
            F.struct("conv_id", "depth").alias("node"),
            F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))).alias("parent"),
            "n_convs", F.coalesce("n_children", zero).alias("n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        ),
        "named",
    )
    values = nodes.select(
        "node", "parent", (F.col("n_children") == 0).alias("is_leaf"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
    )
    totals = subtree_totals(values, ["n_leaves", "saved_tokens"], work, _rank)
    found = work.put(
        nodes.join(totals, "node").select(
            "node.conv_id", "node.depth", F.col("parent.conv_id").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", "ends_sha256",
        ),
        "trie",
    )
    work.clear(found)
    return found

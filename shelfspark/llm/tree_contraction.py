"""Subtree totals of a forest by parallel tree contraction.

The forest shrinks in rounds of joins. Rake: every leaf's total is final; it is added to its
parent and the leaf goes. Compress: of every unary chain an independent part is spliced out,
each node's value passing to its parent and its child to that parent; what is kept of it is
``(node, child, value)``, as its total is its value and its child's total. A star is gone in
one round and a chain in as many as its length has binary digits. The spliced nodes are then
expanded again by pointer jumping: a node that points to one with a known total has its own,
others jump over the node that they point to.

No join has a node's children on one side under the node's key: what a parent needs of its
children are counts, sums and minima, which are partly aggregated before they are shuffled,
and joins are on the nodes' own keys, which are unique.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.workspace import Workspace


def by_hash(node: Column) -> Column:
    """An order of nodes in which about a third of a chain are above both neighbours."""
    return F.xxhash64(node)


def subtree_totals(
    nodes: DataFrame, values: list[str], work: Workspace, rank: Callable[[Column], Column] = by_hash
) -> DataFrame:
    """``(node, *values)``: the sums of ``values`` over every node's subtree, itself included.

    ``nodes`` has unique ``node`` of any type that can be compared, ``parent`` (null at
    roots, else a node of the table), ``is_leaf`` (whether no node has it as parent) and
    the ``values``, longs. ``rank`` orders a chain's nodes by themselves; a node is spliced
    where its rank is above that of its parent and its child, so an order in which every
    second node is high halves chains. Ties only delay. An empty table gives an empty one.
    """
    active = work.put(nodes.select("node", "parent", "is_leaf", *values), "active")
    raked, spliced = [], []
    while True:
        raked.append(active.where("is_leaf").select("node", *values))
        fed = F.when(F.col("is_leaf"), F.lit(0)).otherwise(F.lit(1))
        families = active.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.sum(fed).alias("kids"),
            F.min(F.when(~F.col("is_leaf"), F.col("node"))).alias("child"),
            *(F.sum(F.when(F.col("is_leaf"), F.col(v)).otherwise(F.lit(0))).alias(f"{v}_raked") for v in values),
        )
        left = active.where("NOT is_leaf").join(families, "node")
        chain = (F.col("kids") == 1) & F.col("parent").isNotNull()
        here = rank(F.col("node"))
        goes = chain & (here > rank(F.col("parent"))) & (here > rank(F.col("child")))
        summed = work.put(
            left.select(
                "node", "parent", "child", (F.col("kids") == 0).alias("is_leaf"), F.coalesce(goes, F.lit(False)).alias("goes"),
                *((F.col(v) + F.col(f"{v}_raked")).alias(v) for v in values),
            ),
            "summed",
        )
        if summed.isEmpty():
            break
        gone = summed.where("goes")
        spliced.append(gone.select("node", "child", *values))
        told = gone.select(F.explode(F.array(
            F.struct(F.col("parent").alias("node"), F.lit(None).cast(gone.schema["parent"].dataType).alias("above"), *values),
            F.struct(F.col("child").alias("node"), F.col("parent").alias("above"), *(F.lit(0).cast("long").alias(v) for v in values)),
        )).alias("m")).select("m.*")
        told = told.groupBy("node").agg(F.max("above").alias("above"), *(F.sum(v).alias(f"{v}_told") for v in values))
        active = work.put(
            summed.where("NOT goes").join(told, "node", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"), "is_leaf",
                *((F.col(v) + F.coalesce(F.col(f"{v}_told"), F.lit(0))).alias(v) for v in values),
            ),
            "active",
        )
    return _expanded(raked, spliced, values, work)


def _union(tables: list[DataFrame]) -> DataFrame:
    found = tables[0]
    for more in tables[1:]:
        found = found.unionByName(more)
    return found


def _expanded(raked: list[DataFrame], spliced: list[DataFrame], values: list[str], work: Workspace) -> DataFrame:
    """Totals of raked and spliced nodes; a spliced one's total is its values and its child's total."""
    known = [_union(raked)]
    if not spliced:
        return known[0]
    waiting = work.put(_union(spliced), "waiting")
    while not waiting.isEmpty():
        ends = _union(known).select(F.col("node").alias("child"), F.lit(True).alias("ended"), F.lit(None).cast(waiting.schema["child"].dataType).alias("on"), *(F.col(v).alias(f"{v}_on") for v in values))
        steps = waiting.select(F.col("node").alias("child"), F.lit(False).alias("ended"), F.col("child").alias("on"), *(F.col(v).alias(f"{v}_on") for v in values))
        jumped = work.put(
            waiting.join(ends.unionByName(steps), "child").select(
                "node", F.col("on").alias("child"), "ended", *((F.col(v) + F.col(f"{v}_on")).alias(v) for v in values)
            ),
            "jumped",
        )
        known.append(jumped.where("ended").select("node", *values))
        waiting = jumped.where("NOT ended").select("node", "child", *values)
    return _union(known)

"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import staged


def _narrow(df: DataFrame, label: str) -> DataFrame:
    """Staged in an eighth of the partitions: nodes and labels are two numbers a row."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.coalesce(max(1, n // 8)), label)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that a link has; the component is its least node.

    Each round a node takes the least label among its neighbours, and then the label of
    its label, so paths halve. Labels are written to the shared folder each round, which
    cuts the lineage; only the number of changes comes to the driver. Links with a null
    end are ignored, and an empty table gives an empty one.
    """
    ends = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).where(F.col("src") != F.col("dst"))
    # both directions of a row, so that what makes the links runs once
    turned = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = _narrow(ends.select(F.explode(turned).alias("e")).select("e.*").distinct(), "links")
    labels = both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least"))
    labels = _narrow(labels.select("node", F.least("node", "least").alias("component")), "labels")
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("component").alias("least"))
        lower = labels.join(near, labels.node == near.src).select(
            "node", "component", F.least("component", "least").alias("lower")
        )
        root = labels.select(F.col("node").alias("lower"), F.col("component").alias("root"))
        after = _narrow(
            lower.join(root, "lower").select("node", "component", F.least("lower", "root").alias("next")), "labels"
        )
        labels = after.select("node", F.col("next").alias("component"))
        if after.where(F.col("next") != F.col("component")).isEmpty():
            return labels

"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges``; root is the same within a component.

    Every round sends each node to the smallest of its neighbours, follows that one
    step further and replaces the nodes of the edges by what they were sent to. Edges
    within one node vanish, and the rounds end when none is left. A node's neighbours
    are only ever reduced to their minimum, never gathered. Null ends are ignored; no
    edges give no rows.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    left = stored(both.select(low.alias("u"), high.alias("v")).distinct(), "edges")
    ends = F.explode(F.array("u", "v")).alias("node")
    labels = left.select(ends).distinct().withColumn("root", F.col("node"))
    left = left.where("u <> v")
    swapped = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    while not left.isEmpty():
        near = (
            left.select(F.explode(F.array(F.struct("u", "v"), swapped)).alias("e"))
            .groupBy(F.col("e.u").alias("at"))
            .agg(F.least(F.col("e.u"), F.min("e.v")).alias("to"))
        )
        near = stored(near, "hooks")
        further = near.select(F.col("at").alias("to"), F.col("to").alias("next"))
        step = stored(near.join(further, "to").select("at", F.col("next").alias("to")), "steps")
        labels = stored(
            labels.join(step, labels["root"] == step["at"], "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            "labels",
        )
        for end in ("u", "v"):
            moved = step.select(F.col("at").alias(end), F.col("to").alias("_to"))
            left = left.join(moved, end).withColumn(end, F.col("_to")).drop("_to")
        left = left.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        left = stored(left.distinct(), "edges")
    return labels

"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of ``links`` (``a, b``); a component is named by its smallest node.

    Every round each node takes the smallest label around it and then the label
    of its label, so paths shorten by half or more. A hub meets its neighbours
    only in joins and in minima that combine before the shuffle.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("low"))
    labels = materialize(labels.select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("low"))
        near = labels.join(around, labels["node"] == around["a"])
        near = near.select("node", F.col("component").alias("was"), F.least("component", "low").alias("next"))
        further = labels.select(F.col("node").alias("via"), F.col("component").alias("beyond"))
        moved = near.join(further, near["next"] == further["via"], "left")
        moved = moved.select("node", "was", F.least("next", F.coalesce("beyond", "next")).alias("component"))
        moved = materialize(moved, "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> was").isEmpty():
            return labels

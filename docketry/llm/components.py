"""Connected components of a large, sparse set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.sources.workspace import new_folder, stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); a component is named by its smallest node.

    Each round a node takes the smallest label among its neighbours and itself, then the label of that label, so long
    chains halve. Every round is written, so a lost executor costs a read. Minima are taken before rows are moved, so
    a node with very many links is no burden. Links in either direction, repeated ones and loops are fine.
    """
    spark = links.sparkSession
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    edges = stored(both.distinct(), new_folder(spark, "edges"))
    labels = stored(
        edges.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")),
        new_folder(spark, "labels"),
    )
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("to"))
        step = stored(step, new_folder(spark, "labels"))
        jump = step.select(F.col("node").alias("at"), F.col("to").alias("further"))
        moved = step.join(jump, step["to"] == jump["at"], "left").select(
            "node", "label", F.least("to", F.coalesce("further", "to")).alias("next")
        )
        moved = stored(moved, new_folder(spark, "labels"))
        changed = moved.filter("label <> next").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")

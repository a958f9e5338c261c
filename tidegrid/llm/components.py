"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.storage import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every node of ``edges(a, b)``; comp is the smallest node of its component.

    Every step takes the least label among the neighbours and then that label's own label, so the
    number of steps follows the logarithm of the longest chain. Labels and edges stay distributed,
    each step is written to the shared folder, and only the number of changed labels reaches the
    driver. Self-loops and repeated edges do no harm; an empty table has no components.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = staged(both.where("a <> b").distinct())
    labels = staged(links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("comp")))
    while True:
        least = (
            links.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("comp").alias("near"))
        )
        met = labels.join(least, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("to"))
        own = labels.select(F.col("node").alias("to"), F.col("comp").alias("next"))
        stepped = staged(met.join(own, "to").select("node", "old", F.least("to", "next").alias("comp")))
        labels = stepped.select("node", "comp")
        if not stepped.where("old <> comp").limit(1).count():
            return labels

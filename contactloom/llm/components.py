"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.shared import settle


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): the smallest node that can be reached.

    Every round takes the least label among the neighbours and then the label of that label, so that stars settle in
    two rounds and long chains in about the logarithm of their length.  Each round is written down."""
    both = settle(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
        "node", F.least("node", "least").alias("component"))
    while True:
        labels = settle(labels, "labels")
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near"))
        best = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("old"), F.least("component", "near").alias("best"))
        of_label = labels.select(F.col("node").alias("best"), F.col("component").alias("beyond"))
        new = settle(best.join(of_label, "best").select("node", "old", F.least("best", "beyond").alias("component")), "labels-next")
        if new.filter("component <> old").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")

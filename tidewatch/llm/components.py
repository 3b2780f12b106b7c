"""Connected components of a graph given as pairs, by smallest label, without gathering a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import durable


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) of every node in ``pairs`` (a, b); a component is named by its smallest node.

    Each round every node takes the smallest label around it, then the label of its label, so the rounds grow with
    the logarithm of a component's length. A round is written before the next, and only counts come to the driver.
    """
    both = durable(
        pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels-0")
    step = 0
    while True:
        step += 1
        around = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = durable(
            lower.join(jump, "next", "left").select(
                "node", "label", F.least("next", F.coalesce("far", "next")).alias("next")
            ),
            f"labels-{step}",
        )
        changed = moved.where("next <> label").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")

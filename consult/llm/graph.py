"""Connected components of a link table, by shrinking labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); ``root`` is the smallest node that it reaches.

    Each round takes the smallest label around a node, then that label's own
    label; chains halve, so rounds grow with the logarithm of the diameter.
    Every round is written to the shared folder.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
        least = stage(labels.join(near, "node").select("node", F.least("root", "r").alias("root"), F.col("root").alias("was")), "labels")
        jump = least.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = stage(least.join(jump, "root", "left").select("node", F.least("root", F.coalesce("far", "root")).alias("root"), "was"), "labels")
        labels = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return labels

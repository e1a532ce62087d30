"""Connected components of links between documents, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, label): the smallest node that each node reaches.

    Every round a node takes the smallest label around it, then the label of that label, so
    chains shrink by halves. Labels are written to the shared folder each round; the driver
    sees the number of changes only. No links give no rows.
    """
    both = store(links.select("a", "b").where("a <> b").distinct()
                 .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
                 .select("e.a", "e.b"), "links")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n"))
                .agg(F.min("label").alias("near")))
        step = (labels.join(near, F.col("node") == F.col("n"))
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jump = step.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = store(step.join(jump, F.col("label") == F.col("via"), "left")
                      .select("node", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        if after.where("label <> old").isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")

"""Connected components of an undirected edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import drop_scratch, materialise


def components(edges: DataFrame) -> DataFrame:
    """(a long, b long) -> (node, root): root is the smallest node of the component.

    Each round takes the smallest label among neighbours and then follows
    labels one step (pointer jumping), until nothing changes. Labels are
    written to the shared folder after each round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.filter("a <> b").distinct(), "cc-edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")),
                         "cc-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"),
                                                F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = materialise(step.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("root")), "cc-labels")
        changed = not new.filter("old <> root").isEmpty()
        drop_scratch(labels.sparkSession, labels)
        labels = new.select("node", "root")
        if not changed:
            return labels

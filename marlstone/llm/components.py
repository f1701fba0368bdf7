"""Connected components of an edge table, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) -> (node, comp): comp is the smallest node reachable. Each round halves the depth at
    least; nothing but the number of changed labels reaches the driver. An empty table gives none."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        moved = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        root = moved.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new = materialize(moved.join(root, "comp", "left").select("node", "old", F.coalesce("root", "comp").alias("comp")))
        labels = new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            return labels

"""Connected components of a graph of long ids, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellspark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every vertex of ``edges`` (a, b); the label is the smallest id reachable.

    Each round takes the smallest label of a vertex and its neighbours, then the label's own label,
    so a chain of n vertices takes about log n rounds. Labels are written to the shared folder each
    round, which cuts the lineage. The minimum is combined before the shuffle: a hub of any degree
    costs a row per task, and the joins' other side has one row per vertex, so skewed ones split.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["a"] == labels["id"]).select(F.col("b").alias("id"), "label")
        low = near.union(labels).groupBy("id").agg(F.min("label").alias("label"))
        parent = low.select(F.col("id").alias("label"), F.col("label").alias("root"))
        jumped = low.join(parent, "label").select("id", F.col("root").alias("label"))
        after = materialize(jumped, "labels")
        old = labels.select("id", F.col("label").alias("old"))
        if after.join(old, "id").filter("label <> old").isEmpty():
            return after
        labels = after

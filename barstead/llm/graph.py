"""Connected components of a link table by minimum labels with pointer jumping, entirely in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import materialise

EDGES_PER_TASK = 200_000


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b): root is the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label's own label, so a
    chain of n nodes needs about log n rounds. A round's labels are written to the shared folder.
    Only a count of changes reaches the driver.
    """
    size = Observation()
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    edges = materialise(both.observe(size, F.count(F.lit(1)).alias("n")), "edges")
    # small graphs in few tasks: a round is then a matter of its rows, not of its tasks
    tasks = max(1, size.get["n"] // EDGES_PER_TASK)
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")).coalesce(tasks), "labels")
    while True:
        heard = edges.join(labels, edges["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("heard"))
        nearer = labels.join(heard, labels["node"] == heard["a"], "left").select("node", "root", F.least("root", F.coalesce("heard", "root")).alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("root").alias("above"))
        moved = nearer.join(up, "next", "left").select("node", F.col("root").alias("old"), F.least("next", F.coalesce("above", "next")).alias("root"))
        changes = Observation()
        moved = moved.coalesce(tasks).observe(changes, F.count_if(F.col("old") != F.col("root")).alias("n"))
        labels = materialise(moved, "labels").select("node", "root")
        if not changes.get["n"]:
            return labels

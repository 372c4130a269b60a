"""Connected components of an edge table, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jobloom.plans.shared import write_cut


def min_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, label`` for the nodes of ``edges(a, b)``: the label is the least node of the component.

    Each round takes the least label among neighbours, then jumps to the label's
    own label, so long chains close in logarithmically many rounds. Every round is
    aggregations with map-side combine and equi-joins; nothing is gathered per
    component. Rounds are cut by written tables. Loops, repeated edges and nulls
    change nothing; no edges give no rows.
    """
    both = write_cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label"))
    for _ in range(max_rounds):
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("best"))
        ends = labels.select(F.col("node").alias("best"), F.col("label").alias("jump"))
        jumped = F.coalesce(F.least("best", "jump"), "best")
        seen = Observation()
        stepped = met.join(ends, "best", "left").select("node", jumped.alias("label"), (jumped < F.col("label")).alias("moved"))
        labels = write_cut(stepped.observe(seen, F.count_if("moved").alias("moved")), "labels").select("node", "label")
        if not seen.get["moved"]:
            return labels
    raise RuntimeError(f"components did not close in {max_rounds} rounds")

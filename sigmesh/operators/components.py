"""Connected components (I11) by contraction.

Every node points to its smallest neighbour, pointers are doubled until they
reach the roots, and the edges are contracted to edges between roots, until
none is left. A component of two or more roots at least halves its roots in
a round, and doubling takes a logarithmic number of steps, so a long chain
needs few rounds. Every state is cut from its lineage with ``checkpoint()``
in the shared folder; there is no round limit.

Hub nodes: smallest neighbours are partial aggregations, and the joins on a
node read checkpointed inputs on both sides, so AQE can split a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _roots(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of ``edges``: the end of the chain of smallest neighbours."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    point = both.groupBy("node").agg(F.least("node", F.min("other")).alias("component")).checkpoint()
    while True:
        ahead = point.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = (point.join(ahead, "component")
                  .select("node", F.col("further").alias("component"), (F.col("further") != F.col("component")).alias("moved"))
                  .checkpoint())
        point = jumped.select("node", "component")
        if jumped.filter("moved").isEmpty():
            return point


def component_labels(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of the undirected edges ``a``-``b``; a component is named by its smallest node."""
    ensure_checkpoint_dir(edges.sparkSession)
    left = (edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint())
    labels = None
    while labels is None or not left.isEmpty():
        step = _roots(left)
        if labels is None:
            labels = step
        else:
            later = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
            labels = (labels.join(later, "component", "left")
                      .select("node", F.coalesce("further", "component").alias("component")).checkpoint())
        a_to = step.select(F.col("node").alias("a"), F.col("component").alias("ra"))
        b_to = step.select(F.col("node").alias("b"), F.col("component").alias("rb"))
        left = (left.join(a_to, "a").join(b_to, "b").filter("ra != rb")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct().checkpoint())
    return labels

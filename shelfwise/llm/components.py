"""Connected components of a graph given as a table of edges.

Each round every node hooks onto its smallest neighbour, and the edges are
carried over to what their ends hooked onto; every node of an edge takes part
in a hook, so the number of live nodes at least halves and the rounds grow with
the logarithm of the graph.  Each round's tables are written to the shared
folder.  Hub nodes meet only in a minimum, which Spark combines before the
shuffle, and in joins that AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest
    node of its component.  Null ends, loops and repeated edges count for
    nothing; no edges give no rows."""
    edges = _proper(edges.select("a", "b"))
    edges = common.stored(edges, "components-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("parent"))
        hooks = common.stored(hooks, "components-hooks")
        labels = (labels.join(hooks.withColumnRenamed("node", "_n"), F.col("root") == F.col("_n"), "left")
                  .select("node", F.coalesce("parent", "root").alias("root")))
        labels = common.stored(labels, "components-labels")
        for end in ("a", "b"):
            edges = (edges.join(hooks, F.col(end) == F.col("node"))
                     .withColumn(end, F.col("parent")).select("a", "b"))
        edges = common.stored(_proper(edges), "components-edges")
    return labels


def _proper(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct())

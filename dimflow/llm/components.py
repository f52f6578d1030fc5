"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so no neighbourhood is collected and
a node of any degree is no task of its own. The number of steps grows with the
logarithm of the longest path; each step's edges are written to the shared
folder, and only counts reach the driver. A graph is held in as many partitions
as its edges need (``EDGES`` in each), so that small ones are not dealt into
hundreds of tasks step by step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import staged


EDGES = 1 << 20  # in a partition: 16 MB


def _star(edges: DataFrame, larger: bool, tasks: int) -> DataFrame:
    """Point nodes at the smallest neighbour of a node: its larger neighbours, or the node and its smaller ones.

    An edge leads from its larger node ``a`` to its smaller one ``b``, before and after, so neither end need be listed
    twice: a node's smaller neighbours are the ``b`` of its ``a``, its larger ones the ``a`` of its ``b``.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    if larger:
        linked = (edges.join(least.withColumnRenamed("a", "b"), "b", "left")
                  .select("a", F.coalesce("m", "b").alias("b")))
    else:
        linked = (edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                  .unionByName(least.withColumnRenamed("m", "b")))
    return linked.coalesce(tasks).where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Does every node with a smaller neighbour have just one, and that one none (``b < a`` in every edge)?"""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"))
            .unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count(F.lit(1)).alias("all"))
    return nodes.where("ups > 1 or (ups = 1 and all > 1)").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a, b``): ``root`` is the smallest node of its component."""
    current = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"),
                     "cc_edges")
    tasks = max(1, -(-current.count() // EDGES))
    while True:
        # Each star is written before it is used twice or more: no step computes another again.
        current = staged(_star(current.coalesce(tasks), True, tasks), "cc_larger", tasks)
        current = staged(_star(current.coalesce(tasks), False, tasks), "cc_step", tasks)
        if _settled(current.coalesce(tasks)):
            break
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())

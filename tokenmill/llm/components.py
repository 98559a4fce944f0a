"""Connected components by contraction.

Every round hooks each node to its smallest neighbour (or itself),
relabels the edges and drops those inside a node; the maps of the rounds
are then composed. Nodes are hash-like keys, so a round shrinks chains by
a constant factor, and stars around their smallest node vanish at once.
All state lives in tables; the driver sees only whether edges are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``: nodes share a root
    when edges connect them. Self edges, repeats and nulls do no harm."""
    edges = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    whole = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = written(both.groupBy("a").agg(F.min("b").alias("to"))
                        .select(F.col("a").alias("node"), F.least("a", "to").alias("root")), "hooks")
        if whole is None:
            whole = hooks
        else:
            # nodes that no edge leaves any more keep their root
            later = hooks.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            whole = written(whole.join(later, "root", "left")
                            .select("node", F.coalesce("_next", "root").alias("root")), "roots")
        for end in ("a", "b"):
            edges = (edges.join(hooks.select(F.col("node").alias(end), "root"), end).drop(end)
                     .withColumnRenamed("root", end))
        edges = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    if whole is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return whole

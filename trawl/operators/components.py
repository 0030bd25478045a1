"""Connected components over an edge list (G1) by alternating star contraction.

Edges point from the larger to the smaller node. A round has two steps, each one aggregate and one join:

* large star: an edge (a, b) becomes (a, m(b)), m(b) being the smallest neighbour of b, or b;
* small star: the smaller neighbours b of a, and a itself, are tied to the smallest of them, m(a).

Both keep components together, and the distance to a component's smallest node falls by a constant
factor a round. Then leaves are settled: a node with one edge (a, b), on which no other node hangs, is written to the
round's table as "a follows b" and leaves the graph, so the edges that a round writes shrink to nothing. At the
end the tables are read backwards: a node's label is the label of the node that it follows.

A round's tables are in the shared folder (lineage stays one round deep; survives executor loss); the driver only
learns whether edges are left. Minima are taken in partial and final aggregates, so a hub's edges never meet in
one task for them; the joins have one row per node on the other side, and adaptive execution splits a hub's side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_table, materialize


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    m = _smallest(edges).select(F.col("a").alias("b"), "m")
    return edges.join(m, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    tied = edges.join(_smallest(edges), "a")
    ends = F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
    return tied.select(ends.alias("e")).select("e.a", "e.b").where("a <> b").distinct()


def settled(edges: DataFrame) -> DataFrame:
    """(a, b): nodes with one edge, to a smaller node, that no node is tied to."""
    single = edges.groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    return single.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         nodes: DataFrame | None = None, node_col: str = "node",
                         written: list[int] | None = None) -> DataFrame:
    """(node, component) with component = smallest node id of the component.

    Nodes only present in ``nodes`` (no edges) are their own component; loops, repeated and reversed
    edges change nothing; edges with a null end are no edges. ``written`` receives the edges left after every round.
    """
    e = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b"))
    e = materialize(e.where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("a") != F.col("b"))).distinct(), "edges")
    follows: list[DataFrame] = []
    while not e.isEmpty():  # reads the written table
        large = materialize(large_star(e), "large-star")
        drop_table(e)
        small = materialize(small_star(large), "small-star")
        drop_table(large)
        leaves = materialize(settled(small), "follows")
        follows.append(leaves)
        e = materialize(small.join(leaves.select("a"), "a", "left_anti"), "edges")
        drop_table(small)
        if written is not None:
            written.append(e.count())
    out = None
    for i, leaves in enumerate(reversed(follows)):
        if out is None:
            roots = leaves.select(F.col("b").alias("node")).distinct()
            out = leaves.select(F.col("a").alias("node"), F.col("b").alias("component"))
        else:
            known = out.select(F.col("node").alias("b"), F.col("component").alias("to"))
            new = leaves.join(known, "b", "left").select(F.col("a").alias("node"), F.coalesce("to", "b").alias("component"))
            roots = roots.unionByName(leaves.select(F.col("b").alias("node")))
            out = materialize(out.unionByName(new), "labels") if i % 4 == 3 else out.unionByName(new)
    if out is None:
        out = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    else:
        own = roots.distinct().join(out.select("node"), "node", "left_anti")
        out = out.unionByName(own.select("node", F.col("node").alias("component")))
    out = out.withColumnRenamed("node", node_col)
    if nodes is not None:
        lone = nodes.select(F.col(node_col)).join(out.select(node_col), node_col, "left_anti")
        out = out.unionByName(lone.select(node_col, F.col(node_col).alias("component")))
    return out

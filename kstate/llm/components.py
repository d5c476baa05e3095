"""Consolidating pairwise links into groups: deterministic Boruvka hooking.

Each round every component selects its smallest outgoing edge, the trees that arise collapse by
pointer doubling, edges are relabelled with the roots and deduplicated; the rounds end when no edge
between two components is left. Edges order by (smaller label, larger label); distinct weights mean
that the selected edges hold no cycle but mutual pairs. The smaller end of a mutual pair becomes the
root, and as every selected edge of a tree weighs at least as much as that pair, it is also the
smallest label of the tree: roots need no renaming at the end.

A record that a third of all links name is one hot key. Aggregations combine before the shuffle, and
every join here is a plain equi-join onto one row a key, whose large side adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kstate.runtime import cut


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node of the group.

    Labels may have any orderable type. Edges with a null end are ignored, self links only make
    their node appear, repeated and reversed edges count once, other columns are ignored; no edge
    gives an empty result.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a is not null and b is not null")
    e = cut(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = e.select(F.col("a").alias("node")).union(e.select("b")).distinct().withColumn("root", F.col("node"))
    live = e.filter("a <> b")
    while not live.isEmpty():
        parent = _collapse(_hook(live))
        up = parent.select(F.col("node").alias("a"), F.col("root").alias("x"))
        live = live.join(up, "a").select("x", "b")
        live = live.join(up.toDF("b", "y"), "b").filter("x <> y")
        live = cut(live.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        labels = labels.join(up.toDF("root", "new"), "root", "left")
        labels = cut(labels.select("node", F.coalesce("new", "root").alias("root")))
    return labels.select("node", F.col("root").alias("component"))


def _hook(live: DataFrame) -> DataFrame:
    """(node, root): per component the other end of its smallest outgoing edge."""
    both = live.select(F.col("a").alias("node"), F.col("b").alias("other")).union(live.select("b", "a"))
    weight = F.struct(F.least("node", "other").alias("lo"), F.greatest("node", "other").alias("hi"))
    w = both.groupBy("node").agg(F.min(weight).alias("w"))
    return w.select("node", F.when(F.col("w.lo") == F.col("node"), F.col("w.hi")).otherwise(F.col("w.lo")).alias("root"))


def _collapse(parent: DataFrame) -> DataFrame:
    """Pointer doubling until every node points to its root; a mutual pair roots at its smaller end."""
    p = cut(parent)
    while True:
        up = p.select(F.col("node").alias("root"), F.col("root").alias("grand"))
        new = F.when(F.col("grand") == F.col("node"), F.least("node", "root")).otherwise(F.col("grand"))
        q = cut(p.join(up, "root").select("node", new.alias("root"), (new != F.col("root")).alias("moved")))
        p = q.select("node", "root")
        if q.filter("moved").isEmpty():
            return p

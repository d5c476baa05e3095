"""Groups of ids tied by explicit links, for folds that must see everything they touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kstate.runtime import cut


def linked_groups(links: DataFrame) -> DataFrame:
    """(id, group) for the ids of ``links`` (a, b): group is the smallest id reached. Labels spread and jump until none moves."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a is not null and b is not null").distinct())
    g = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("group")))
    while True:
        near = both.join(g.toDF("b", "gb"), "b").groupBy(F.col("a").alias("id")).agg(F.min("gb").alias("near"))
        n = g.join(near, "id").withColumn("low", F.least("group", "near"))
        jump = g.toDF("low", "jump")
        n = n.join(jump, "low", "left").select("id", F.least("low", "jump").alias("new"), "group")
        n = cut(n.select("id", F.col("new").alias("group"), (F.col("new") != F.col("group")).alias("moved")))
        done = n.filter("moved").isEmpty()
        g = n.select("id", "group")
        if done:
            return g

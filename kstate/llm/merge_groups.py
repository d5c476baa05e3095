"""Merge chains of concepts and claims as groups (who was merged into whom, directly or through others)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kstate.llm.components import connected_components


def id_key(c: Column) -> Column:
    """Ids are compared without outer blanks and letter case; blank counts as null."""
    k = F.lower(F.regexp_replace(c, r"(?U)^[\s\x{200B}\x{FEFF}]+|[\s\x{200B}\x{FEFF}]+$", ""))
    return F.when(k != "", k)


def merge_groups(records: DataFrame) -> DataFrame:
    """(object_type, internal_id, group_id) from rows (object_type, internal_id, merged_into).

    One row per internal_id that has a row and shares its group with another such id; group_id is
    the smallest internal_id of the group. Null or blank merged_into links nothing, an id linked to
    itself forms no group, an id named but without a row still ties together those that name it,
    repeated rows count once, rows with a null or blank internal_id are ignored. Object types never mix.
    """
    r = records.select("object_type", "internal_id", "merged_into").filter("object_type is not null")
    r = r.withColumn("k", id_key(F.col("internal_id"))).filter("k is not null").withColumn("t", id_key(F.col("merged_into")))
    # 16-byte keys instead of ids of a hundred characters; the type is part of the key
    key = lambda c: F.unhex(F.md5(F.concat_ws("\u0001", "object_type", c)))
    links = r.filter("t is not null").select(key("k").alias("src"), key("t").alias("dst"))
    comp = connected_components(links)
    have = r.groupBy("object_type", "k").agg(F.min("internal_id").alias("internal_id"))
    placed = have.withColumn("node", key("k")).join(comp, "node").select("object_type", "internal_id", "component")
    firsts = placed.groupBy("component").agg(F.min("internal_id").alias("group_id"), F.count("*").alias("n")).filter("n > 1")
    return placed.join(firsts, "component").select("object_type", "internal_id", "group_id")

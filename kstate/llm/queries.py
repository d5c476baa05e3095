"""Queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kstate.llm.canonical_match import UNMATCHED, map_to_canonical
from kstate.llm.leakage import leaked_items, near_items
from kstate.llm.lookalikes import look_alike_groups, look_alike_pairs
from kstate.llm.merge_groups import merge_groups
from kstate.llm.mixture import mix, shares
from kstate.llm.near_duplicates import expand_pairs, near_duplicate_groups, near_duplicates
from kstate.llm.packing import pack
from kstate.llm.sentences import sentence_units
from kstate.runtime import table


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "candidate")
    said = F.when(F.col("candidate_type") == "concept", F.concat(F.coalesce("name", F.lit("")), F.lit(" "), "description")).otherwise(F.col("statement"))
    return c.select("candidate_no", F.col("candidate_type").alias("kind"), said.alias("text"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, pairs = near_duplicates(_candidates(spark, sf_dir), key="candidate_no")
    return expand_pairs(members, pairs, "candidate_no")


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, pairs = near_duplicates(_candidates(spark, sf_dir), key="candidate_no")
    return near_duplicate_groups(members, pairs, "candidate_no").withColumnRenamed("kind", "candidate_type")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for kind in ("concept", "claim"):
        part = table(spark, sf_dir, kind).select(F.lit(kind).alias("object_type"), "internal_id", "merged_into")
        rows = part if rows is None else rows.unionByName(part)
    return merge_groups(rows)


def _unit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for name in ("raw_unit", "normalized_unit"):
        part = table(spark, sf_dir, name).select(F.lit(name).alias("table_name"), "unit_no", "text")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return look_alike_pairs(_unit_texts(spark, sf_dir))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every unit whose text has look-alikes, one row a unit."""
    return look_alike_groups(_unit_texts(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = map_to_canonical(table(spark, sf_dir, "resolution"), table(spark, sf_dir, "catalog_concept"))
    return found.select("candidate_no", "internal_id")


def p4_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed values that mean no entry of the reference list, and how many rows carry them."""
    found = map_to_canonical(table(spark, sf_dir, "resolution"), table(spark, sf_dir, "catalog_concept"))
    return found.filter(F.col("internal_id") == UNMATCHED).groupBy("candidate_name").agg(F.count("*").alias("n"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "normalized_unit").select(F.col("source_version_uri").alias("bag"), F.col("unit_no").alias("item"), F.length("text").alias("size"))
    bag = F.concat(F.lit("kst-source:"), "source_id", F.lit("@"), "snapshot_id")
    runs = table(spark, sf_dir, "synthesis_manifest").select(
        F.col("run_id").alias("run"), bag.alias("bag"), F.col("max_input_chars").alias("capacity"), F.col("max_batch_units").alias("slots")
    )
    return pack(units, runs)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir).filter("pieces > 1").select(F.col("run").alias("run_id"), F.col("item").alias("unit_no")).distinct()


def p5_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of every unit, or of every piece of a divided one."""
    return _packed(spark, sf_dir).select(
        F.col("run").alias("run_id"), F.col("container").alias("batch_no"), F.col("item").alias("unit_no"), "piece", F.col("start").alias("piece_start"), F.col("size").alias("piece_chars")
    )


def p5_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of each run, and how many of them least squares gave, beside the number no packing can go below."""
    own = _packed(spark, sf_dir).groupBy("run", "container", "solved").agg(F.sum("size").alias("chars"), F.count_if(F.col("piece") == 0).alias("units"))
    b = own.groupBy(F.col("run").alias("run_id")).agg(F.count("*").alias("batches"), F.count_if("solved").alias("solved_batches"), F.sum("chars").alias("chars"), F.sum("units").alias("units"))
    m = table(spark, sf_dir, "synthesis_manifest").select("run_id", "max_input_chars", "max_batch_units").distinct()
    least = F.greatest(F.ceil(F.col("chars") / F.col("max_input_chars")), F.ceil(F.col("units") / F.col("max_batch_units")))
    return b.join(m, "run_id").select("run_id", "units", "chars", "batches", "solved_batches", least.alias("least_batches"))


def p5_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each run's batches hold in all, and whether every batch keeps both limits."""
    own = _packed(spark, sf_dir).groupBy("run", "container").agg(F.sum("size").alias("chars"), F.count("*").alias("pieces"), F.count_if(F.col("piece") == 0).alias("units"))
    m = table(spark, sf_dir, "synthesis_manifest").select(F.col("run_id").alias("run"), "max_input_chars", "max_batch_units").distinct()
    keeps = (F.col("chars") <= F.col("max_input_chars")) & (F.col("pieces") <= F.col("max_batch_units"))
    return own.join(m, "run").groupBy(F.col("run").alias("run_id")).agg(F.sum("units").alias("units"), F.sum("chars").alias("chars"), F.bool_and(keeps).alias("limits_kept"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))
    return found.filter("exact_windows > 0").select("doc_id", "item_id")


def p6_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    items = table(spark, sf_dir, "eval_item").select("item_id", "suite").distinct()
    found = leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))
    n = found.groupBy("item_id").agg(F.count_if(F.col("exact_windows") > 0).alias("documents"), F.sum("exact_windows").alias("windows"))
    return items.join(n, "item_id", "left").na.fill(0)


def p6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold most of an item, with or without small edits, and how alike."""
    found = near_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))
    return found.select("doc_id", "item_id", "windows", F.round("similarity", 6).alias("similarity"), (F.col("exact_windows") > 0).alias("exact"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents chosen for each source, with the number of uses."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_target"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    return shares(p7_mix(spark, sf_dir), table(spark, sf_dir, "mix_target"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_units(table(spark, sf_dir, "documents"))


def p8_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All signs but blanks of each document's sentences, in order, as a hash: none may be lost, doubled or moved."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    s = sentence_units(d).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sent_start", "sent_end"))).alias("s"))
    parts = F.transform("s", lambda x: F.substring("text", (x["sent_start"] + 1).cast("int"), (x["sent_end"] - x["sent_start"]).cast("int")))
    bare = F.regexp_replace(F.array_join(parts, ""), r"[\s\p{Z}\x1C-\x1F\x85]+", "")
    return d.distinct().join(s, "doc_id").select("doc_id", F.md5(bare).alias("signs_md5"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p3_found": p3_found, "p3_groups": p3_groups, "p4_found": p4_found, "p4_misses": p4_misses, "p5_found": p5_found, "p5_batches": p5_batches, "p5_runs": p5_runs, "p5_placed": p5_placed, "p6_found": p6_found, "p6_items": p6_items, "p6_near": p6_near, "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found, "p8_covered": p8_covered}

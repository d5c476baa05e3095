"""Raw units to addressed units: one text form, stable anchors, content hashes, and the rules they must keep.

Every rule is a table of violations; ``require`` turns a non-empty one into an error, so no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kstate.functions.canon import SCHEME, KStateError, canonical_json_text, json_object, json_string, json_string_list, sha256_id
from kstate.functions.text import nfc, normal_text

ANCHOR_BASIS = "kst-anchor-v1"


def require(violations: DataFrame, rule: str) -> None:
    """Raises KStateError with an example if a rule is broken."""
    if bad := violations.limit(1).collect():
        raise KStateError(f"{rule}: {bad[0].asDict(recursive=True)}")


def source_uri(source_id: Column) -> Column:
    return F.concat(F.lit(f"{SCHEME}-source:"), F.replace(F.url_encode(source_id), F.lit("+"), F.lit("%20")))


def anchor_id(path: Column, kind: Column, locator: Column) -> Column:
    """Identity of a place in a source: its path, kind and locator (canonical JSON); a unit's number plays no part."""
    basis = F.lit(f'"{ANCHOR_BASIS}"')
    return F.concat(F.lit("a-"), sha256_id(json_object({"basis": basis, "source_path": json_string(path), "kind": json_string(kind), "native_locator": locator})))


def content_sha256(path: Column, kind: Column, text: Column, data: Column, locator: Column, metadata: Column, diagnostics: Column) -> Column:
    fields = {
        "source_path": json_string(path), "kind": json_string(kind), "text": json_string(text), "data": data,
        "native_locator": locator, "metadata": metadata, "diagnostics": json_string_list(diagnostics),
    }
    return F.sha2(json_object(fields), 256)


def normalize(units: DataFrame) -> DataFrame:
    """Addressed units of raw units: text in LF and NFC, JSON in canonical form, URIs, anchor and content hash."""
    u = units.withColumn("text", normal_text(F.col("text"))).withColumn("source_path", nfc(F.col("source_path")))
    for c in ("data", "native_locator", "metadata"):
        u = u.withColumn(c, canonical_json_text(F.coalesce(c, F.lit("{}"))))
    u = u.withColumn("diagnostics", F.coalesce("diagnostics", F.array().cast("array<string>")))
    u = u.withColumn("source_uri", source_uri(F.col("source_id"))).withColumn("source_version_uri", F.concat("source_uri", F.lit("@"), "snapshot_id"))
    u = u.withColumn("anchor_id", anchor_id(F.col("source_path"), F.col("kind"), F.col("native_locator")))
    u = u.withColumn("anchor_uri", F.concat("source_version_uri", F.lit("#"), "anchor_id"))
    return u.withColumn("content_sha256", content_sha256(*(F.col(c) for c in ("source_path", "kind", "text", "data", "native_locator", "metadata", "diagnostics"))))


# -- rules ------------------------------------------------------------------------------------------


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def path_collisions(units: DataFrame, by: list[str], path: str = "source_path") -> DataFrame:
    """Paths in NFC that several spellings share within a source."""
    return units.groupBy(*by, nfc(F.col(path)).alias("nfc_path")).agg(F.countDistinct(path).alias("spellings")).filter("spellings > 1")


def unit_faults(units: DataFrame) -> DataFrame:
    """Units whose fields are missing or unsafe, each with the first fault found."""
    from kstate.sources.files import safe_path

    fault = (
        F.when(~F.coalesce(F.col("unit_id").rlike(r"^u\d{6,}$"), F.lit(False)), "unit_id")
        .when(F.col("source_path").isNull() | ~((F.col("source_path") == ".") | safe_path(F.col("source_path"))), "source_path")
        .when(F.coalesce(F.col("kind"), F.lit("")) == "", "kind")
        .when(F.col("native_locator").isNull() | F.try_parse_json("native_locator").isNull(), "native_locator")
        .when(F.col("diagnostics").isNull(), "diagnostics")
    )
    return units.withColumn("fault", fault).filter("fault is not null")


def count_differences(units: DataFrame, manifest: DataFrame, by: list[str]) -> DataFrame:
    """Sources whose units or diagnostics are not as many as their manifest says."""
    n = units.groupBy(*by).agg(F.count("*").alias("units"), F.sum(F.size("diagnostics")).alias("notes"))
    m = manifest.select(*by, "unit_count", "diagnostic_count")
    d = m.join(n, by, "full_outer").na.fill(0, ["units", "notes", "unit_count", "diagnostic_count"])
    return d.filter("units <> unit_count or notes <> diagnostic_count")


def checked_normalize(units: DataFrame) -> DataFrame:
    """normalize with its rules enforced: fields, unique unit ids, unique anchors, one spelling a path."""
    by = ["source_id", "snapshot_id"]
    require(unit_faults(units), "unit fields")
    require(repeated(units, [*by, "unit_id"]), "unit ids are unique in a snapshot")
    require(path_collisions(units, by), "paths are unique in NFC")
    out = normalize(units)
    require(repeated(out, ["anchor_uri"]), "native locators are unique in a snapshot")
    return out

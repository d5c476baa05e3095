"""The pipeline's stages as callables: each verifies what it builds on, runs its operators, and publishes one immutable folder.

A folder holds ``manifest.json`` and one Parquet dataset a table; the manifest has the tables' hashes and the hash of the
manifest before it. Reading a folder checks all of them, so a changed input fails the stage that reads it. What a stage publishes
is named by its identity (source, snapshot, run id), so running it again changes nothing. The folders lie in one root all nodes share.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kstate.functions.canon import UNICODE_VERSION, KStateError, canonical_json, digest
from kstate.functions.text import path_key
from kstate.operators import apply as A
from kstate.operators import classify as C
from kstate.operators import extract as X
from kstate.operators import normalize as N
from kstate.operators import plan as P
from kstate.operators import resolve as R
from kstate.operators import synthesize as S
from kstate.runtime import cut
from kstate.sources import files

PROFILE = "builtin-v1"
#: What orders the rows of each table, for its hash.
ORDER = {
    "entries": ["path"], "units": ["unit_id"], "notes": ["path", "note"], "candidates": ["candidate_id"], "resolutions": ["candidate_id"], "catalog": ["internal_id"],
    "operations": ["operation_id"], "claims": ["internal_id"], "relations": ["internal_id"], "decisions": ["candidate_id"], "events": ["event_id"], "registry": ["object_type", "internal_id"],
    **{t: ["internal_id"] for t in A.TYPES},
}
DECISIONS = "candidate_id string, action string, target_internal_ids array<string>, survivor_internal_id string, reason string"


@dataclass(frozen=True)
class Limits:
    """What a run of synthesis and resolution may use."""

    max_input_chars: int = 120_000
    max_batch_units: int = 50
    max_output_tokens: int = 8_000
    threshold: float = R.THRESHOLD
    shortlist: int = R.LIMIT

    def __post_init__(self) -> None:
        if self.max_input_chars < 1024 or self.max_batch_units < 1 or self.max_output_tokens < 256:
            raise KStateError("at least 1,024 characters, 1 unit and 256 tokens")
        if not 0 <= self.threshold <= 1 or not 1 <= self.shortlist <= R.MOST:
            raise KStateError("the threshold lies in [0, 1], the shortlist in [1, 50]")


class Store:
    """Immutable folders of one root, by stage and identity."""

    def __init__(self, spark: SparkSession, root: str | Path) -> None:
        self.spark, self.root = spark, Path(root)

    def folder(self, stage: str, *identity: str) -> Path:
        for part in identity:
            if not part or part in (".", "..") or "/" in part or "\\" in part:
                raise KStateError(f"unsafe identity {part!r}")
        return self.root.joinpath(stage, *identity)

    def publish(self, stage: str, identity: tuple[str, ...], manifest: dict, tables: dict[str, DataFrame]) -> dict:
        """Writes tables and manifest beside their place and moves them there at once. Equal content there already is fine, other content an error."""
        final = self.folder(stage, *identity)
        manifest = {"schema_version": 1, "stage": stage, "identity": list(identity), "tables": {n: A.table_hash(t, ORDER[n]) for n, t in tables.items()}} | manifest
        if final.exists():
            if self.manifest(stage, *identity) != manifest:
                raise KStateError(f"{final} holds another result for the same identity")
            return manifest
        work = final.parent / f".{final.name}-{uuid.uuid4().hex}"
        try:
            for name, t in tables.items():
                t.write.parquet(str(work / name))
            work.mkdir(parents=True, exist_ok=True)
            files.write_manifest(work / "manifest.json", manifest)
            try:
                work.rename(final)
            except OSError:
                if not final.exists() or self.manifest(stage, *identity) != manifest:
                    raise
        finally:
            shutil.rmtree(work, ignore_errors=True)
        return manifest

    def manifest(self, stage: str, *identity: str) -> dict:
        found = files.read_manifest(self.folder(stage, *identity) / "manifest.json")
        if found.get("stage") != stage or found.get("identity") != list(identity):
            raise KStateError(f"the manifest of {stage} names another identity")
        return found

    def load(self, stage: str, *identity: str) -> tuple[dict, dict[str, DataFrame]]:
        """Manifest and tables, each checked against its hash."""
        found, tables = self.manifest(stage, *identity), {}
        for name, want in found["tables"].items():
            t = self.spark.read.parquet(str(self.folder(stage, *identity) / name))
            if A.table_hash(t, ORDER[name]) != want:
                raise KStateError(f"{name} of {stage} {'/'.join(identity)} is not what was published")
            tables[name] = t
        return found, tables

    def unchanged(self, stage: str, *identity: str, before: dict) -> None:
        """Raises if a folder changed since it was read."""
        if self.load(stage, *identity)[0] != before:
            raise KStateError(f"{stage} {'/'.join(identity)} changed while it was in use")


def optional(spark: SparkSession, path: str | Path | None, schema: str) -> tuple[DataFrame, dict]:
    """An input that may be left out: rows of JSON lines and its provenance, or none and mode ``empty``."""
    if path is None:
        return spark.createDataFrame([], schema), {"mode": "empty", "source_sha256": None}
    if not Path(path).is_file():
        raise KStateError(f"{path} is missing")
    with open(path, "rb") as f:
        raw = hashlib.file_digest(f, "sha256").hexdigest()
    return files.read_json_lines(spark, str(path), schema), {"mode": "file", "source_sha256": raw}


# -- 1, 2: acquired sources, snapshots ----------------------------------------------------------------


def _fingerprint(entries: DataFrame) -> str:
    return files.tree_fingerprint(entries.withColumn("tree", F.lit(1)), ["tree"]).first().fingerprint


def snapshot(store: Store, source_id: str) -> dict:
    """Freezes an acquired source: its copy has to equal the source, which has to be the same before and after copying."""
    place = store.root / "acquired" / source_id
    files.validate_spec(source_id, "x")
    receipt = files.read_manifest(place / "receipt.json")
    if receipt.get("stage") != "acquire" or receipt.get("source_id") != source_id:
        raise KStateError("the receipt names another source")
    artifact = place / receipt["artifact"]["path"]
    is_git = receipt["artifact"]["kind"] == "git"
    see: Callable[[Path], tuple[DataFrame, str]] = lambda p: (e := cut(files.inventory(store.spark, str(p))), _fingerprint(e))
    entries, before = see(artifact)
    lock = files.git_lock(artifact, receipt.get("requested_ref")) if is_git else None
    ident = files.snapshot_id(lock, before)
    final = store.folder("snapshot", source_id, ident)
    manifest = {
        "source_id": source_id, "snapshot_id": ident, "artifact": {"path": "artifact", "kind": receipt["artifact"]["kind"]}, "fingerprint": before, "version_lock": lock, "source_name": receipt["observations"].get("source_name") or source_id,
        "receipt_sha256": hashlib.sha256((place / "receipt.json").read_bytes()).hexdigest(),
    }
    if final.exists():
        return verify_snapshot(store, source_id, ident)
    work = store.root / f".snapshot-{uuid.uuid4().hex}"
    try:
        work.mkdir(parents=True)
        if artifact.is_dir() and not artifact.is_symlink():
            shutil.copytree(artifact, work / "artifact", symlinks=True)
        else:
            shutil.copy2(artifact, work / "artifact", follow_symlinks=False)
        if see(work / "artifact")[1] != before or see(artifact)[1] != before:
            raise KStateError("the source changed while it was copied")
        published = store.publish("snapshot", (source_id, ident), manifest, {"entries": entries})
        (work / "artifact").rename(final / "artifact")
        return published
    finally:
        shutil.rmtree(work, ignore_errors=True)


def verify_snapshot(store: Store, source_id: str, ident: str) -> dict:
    """The manifest of a snapshot whose copy still is what was frozen, entry by entry."""
    manifest, tables = store.load("snapshot", source_id, ident)
    entries = cut(files.inventory(store.spark, str(store.folder("snapshot", source_id, ident) / "artifact")))
    if not files.tree_difference(entries, tables["entries"]).isEmpty() or _fingerprint(entries) != manifest["fingerprint"]:
        raise KStateError(f"snapshot {ident} was changed")
    if files.snapshot_id(manifest["version_lock"], manifest["fingerprint"]) != ident:
        raise KStateError(f"snapshot {ident} has another identity")
    return manifest


# -- 3, 4, 5: classification, extraction, normalisation -------------------------------------------------


ENTRY = ["path", "entry_kind", "target", "extension", "format", "media_type", "family", "route", "basis", "strength", "signature", "encoding_hint", "diagnostics"]


def classified(store: Store, source_id: str, ident: str) -> DataFrame:
    """Every entry of a snapshot with what it is; one row for a repository."""
    manifest, tables = store.load("snapshot", source_id, ident)
    none = F.lit(None).cast("string")
    artifact = store.folder("snapshot", source_id, ident) / "artifact"
    if manifest["artifact"]["kind"] == "git":
        row = {"path": ".", "entry_kind": "directory", "format": "git", "media_type": "application/x-git-repository", "family": "repository", "route": "git", "basis": "version-lock", "strength": "exact"}
        d = store.spark.range(1).select(*(F.lit(row[c]).alias(c) if c in row else none.alias(c) for c in ENTRY if c != "diagnostics"))
        return d.withColumn("diagnostics", F.array().cast("array<string>"))
    entries = tables["entries"]
    single = manifest["artifact"]["kind"] == "file"
    content = files.read_files(store.spark, str(artifact)) if not single else store.spark.read.format("binaryFile").load(str(artifact)).select(F.lit(".").alias("path"), "content")
    # a single file is known by the name it was acquired under
    name = manifest["source_name"] if single else None
    found = entries.filter("kind = 'file'").select("path", "kind", "target").join(content.select("path", "content"), "path", "left")
    shown = found.withColumn("at", F.col("path")).withColumn("path", F.lit(name) if single else F.col("path"))
    c = C.classify_files(shown).withColumn("path", F.col("at")).withColumn("entry_kind", F.lit("file")).select(*ENTRY)
    link = F.col("kind") == "symlink"
    other = entries.filter("kind <> 'file'").select(
        "path", F.col("kind").alias("entry_kind"), "target", none.alias("extension"), F.col("kind").alias("format"), F.when(link, "inode/symlink").otherwise("inode/directory").alias("media_type"),
        F.when(link, "reference").otherwise("container").alias("family"), F.col("kind").alias("route"), F.lit("filesystem").alias("basis"), F.lit("exact").alias("strength"),
        none.alias("signature"), none.alias("encoding_hint"), F.array().cast("array<string>").alias("diagnostics"),
    )
    return c.unionByName(other)


def classify(store: Store, source_id: str, ident: str) -> dict:
    """What every entry of a verified snapshot is, and a summary; the first entry stands for the source."""
    before = verify_snapshot(store, source_id, ident)
    entries = cut(classified(store, source_id, ident))
    first = entries.orderBy(F.col("path") != ".", files.depth_first(F.col("path"))).first()
    counts = {f"{r.kind}:{r.value}" if r.value else r.kind: r.n for r in C.classification_summary(entries).collect()}
    if verify_snapshot(store, source_id, ident) != before:
        raise KStateError("the snapshot changed while it was classified")
    manifest = {
        "source_id": source_id, "snapshot_id": ident, "ruleset": PROFILE, "snapshot_manifest": digest(before), "summary": counts,
        "source": {"artifact_kind": before["artifact"]["kind"], "primary_format": first.format, "primary_media_type": first.media_type, "primary_route": first.route},
    }
    return store.publish("classify", (source_id, ident), manifest, {"entries": entries})


def extract(store: Store, source_id: str, ident: str, limits: X.Limits = X.LIMITS) -> dict:
    """Units of a classified snapshot, numbered in the order of its entries; diagnostics of files beside them."""
    before = classify(store, source_id, ident)
    entries = store.load("classify", source_id, ident)[1]["entries"]
    snap, _ = store.load("snapshot", source_id, ident)
    artifact = store.folder("snapshot", source_id, ident) / "artifact"
    if snap["artifact"]["kind"] == "git":
        every = X.git_units(store.spark, str(artifact), snap["version_lock"]["commit"], limits)
    else:
        content = files.read_files(store.spark, str(artifact)) if artifact.is_dir() else store.spark.read.format("binaryFile").load(str(artifact)).select(F.lit(".").alias("path"), "content")
        every = X.extract_all(entries.filter("entry_kind = 'file'").join(content.select("path", "content"), "path", "left"), limits)
        every = every.unionByName(X.tree_units(entries.select("path", F.col("entry_kind").alias("kind"), "target")))
    every = cut(every)
    units = every.filter("kind is not null").withColumn("_root", F.col("path") != ".").withColumn("_walk", files.depth_first(F.col("path"))).withColumn("source_id", F.lit(source_id)).withColumn("snapshot_id", F.lit(ident))
    units = X.number_units(units, ["source_id", "snapshot_id"], ["_root", "_walk", "unit_index"]).drop("_root", "_walk", "unit_index").withColumnRenamed("path", "source_path")
    notes = every.filter("kind is null").select("path", F.explode("diagnostics").alias("note"))
    units, notes = cut(units), cut(notes)
    n = units.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("diagnostics")), F.lit(0)).alias("d")).first()
    if classify(store, source_id, ident) != before:
        raise KStateError("the classification changed while units were extracted")
    manifest = {
        "source_id": source_id, "snapshot_id": ident, "profile": PROFILE, "classification_manifest": digest(before), "unit_count": n.n, "diagnostic_count": n.d + notes.count(),
        "tools": X.tools({r.format for r in entries.select("format").distinct().collect()}), "routes": {r.route: r["count"] for r in entries.groupBy("route").count().collect()},
    }
    return store.publish("extract", (source_id, ident), manifest, {"units": units, "notes": notes})


def normalize(store: Store, source_id: str, ident: str) -> dict:
    """Addressed units of extracted ones, every rule enforced and the counts reconciled."""
    before, tables = store.load("extract", source_id, ident)
    units = cut(N.checked_normalize(tables["units"]))
    m = store.spark.createDataFrame([(source_id, ident, before["unit_count"], before["diagnostic_count"] - tables["notes"].count())], "source_id string, snapshot_id string, unit_count long, diagnostic_count long")
    if before["unit_count"]:
        N.require(N.count_differences(units, m, ["source_id", "snapshot_id"]), "as many units and diagnostics as extracted")
    store.unchanged("extract", source_id, ident, before=before)
    manifest = {"source_id": source_id, "snapshot_id": ident, "profile": PROFILE, "extraction_manifest": digest(before), "unit_count": before["unit_count"], "unicode_version": UNICODE_VERSION}
    return store.publish("normalize", (source_id, ident), manifest, {"units": units})


# -- 6, 7: candidates and their resolution --------------------------------------------------------------


def _run_id(descriptor: dict) -> str:
    return digest(descriptor)


def synthesize(store: Store, source_id: str, ident: str, provider: S.Provider, model: str = "offline", limits: Limits = Limits()) -> dict:  # noqa: B008
    """Candidates a provider finds in the units, batch by batch; evidence and relations are checked before anything is published."""
    before, tables = store.load("normalize", source_id, ident)
    run = F.lit("run")
    units = tables["units"].withColumn("run_id", run).withColumn("unit_no", F.expr("bigint(substring(unit_id, 2))"))
    units = units.withColumn("max_input_chars", F.lit(limits.max_input_chars)).withColumn("max_batch_units", F.lit(limits.max_batch_units))
    N.require(N.repeated(units, ["anchor_uri"]), "anchors are unique")
    batched = units.join(S.rendered_batches(units), ["run_id", "unit_no"])
    asked = cut(S.requests(batched, model, limits.max_output_tokens))
    answers = cut(S.call_provider(asked, provider))
    found = cut(S.assign_ids(S.parse_answers(answers)))
    N.require(S.evidence_violations(found, units.select("run_id", F.col("anchor_uri").alias("anchor"))), "evidence names units of the run")
    N.require(S.relation_violations(found.filter("candidate_type = 'relation'"), found), "relations join concepts of the run")
    of = lambda df, *order: A.table_hash(df, list(order))
    descriptor = {
        "profile": PROFILE, "source_id": source_id, "snapshot_id": ident, "normalization_manifest": digest(before), "provider": provider.name, "model": model,
        "prompt": digest(S.INSTRUCTIONS), "schema": digest(S.answer_schema()), "max_input_chars": limits.max_input_chars, "max_batch_units": limits.max_batch_units, "max_output_tokens": limits.max_output_tokens,
        "requests": of(asked.drop("schema"), "batch_id"), "responses": of(answers, "batch_id"), "candidates": of(found.drop("run_id"), "candidate_id"),
    }
    run_id = _run_id(descriptor)
    store.unchanged("normalize", source_id, ident, before=before)
    counts = {r.candidate_type: r.n for r in S.candidate_counts(found).collect()}
    manifest = {"source_id": source_id, "snapshot_id": ident, "run_id": run_id, "descriptor": descriptor, "batches": asked.count(), "counts": counts}
    return store.publish("synthesize", (source_id, ident, run_id), manifest, {"candidates": found.withColumn("run_id", F.lit(run_id))})


def _checked_run(manifest: dict, run_id: str) -> None:
    if manifest["run_id"] != run_id or _run_id(manifest["descriptor"]) != run_id:
        raise KStateError(f"run {run_id} does not follow from its descriptor")


def load_synthesis(store: Store, source_id: str, ident: str, run_id: str) -> tuple[dict, DataFrame]:
    """Candidates of a run whose id follows from its descriptor and whose units still are the ones it read."""
    manifest, tables = store.load("synthesize", source_id, ident, run_id)
    _checked_run(manifest, run_id)
    if manifest["descriptor"]["normalization_manifest"] != digest(store.load("normalize", source_id, ident)[0]):
        raise KStateError("the run was made of other units")
    c = tables["candidates"]
    if manifest["descriptor"]["candidates"] != A.table_hash(c.drop("run_id"), ["candidate_id"]):
        raise KStateError("the run has other candidates")
    N.require(S.relation_violations(c.filter("candidate_type = 'relation'"), c), "relations join concepts of the run")
    return manifest, c


def _ordered(c: DataFrame) -> DataFrame:
    """Candidates with one number each: batch, then order within it."""
    place = F.conv(F.regexp_extract("batch_id", r"(\d+)$", 1), 10, 10).cast("bigint")
    return c.withColumn("candidate_no", place * 1_000_000 + F.col("ordinal")).withColumn("ordinal", F.col("candidate_no"))


def resolve(store: Store, source_id: str, ident: str, run_id: str, catalog: str | Path | None = None, limits: Limits = Limits(), adjudicator=None) -> dict:  # noqa: ANN001, B008
    """Which catalog concept each concept candidate is; ``catalog`` is a file of JSON lines, or none at all."""
    before, c = load_synthesis(store, source_id, ident, run_id)
    known, origin = optional(store.spark, catalog, A.SCHEMAS["concept"].removesuffix(", merged_into string"))
    known = cut(known)
    N.require(R.catalog_faults(known), "the catalog keeps its rules")
    concepts = cut(_ordered(c.filter("candidate_type = 'concept'")))
    out = cut(R.resolve(concepts, known, limits.threshold, limits.shortlist, adjudicator).join(concepts.select("candidate_no", "candidate_id", F.col("name").alias("candidate_name"), "evidence_anchors"), "candidate_no").drop("candidate_no"))
    descriptor = {
        "profile": PROFILE, "synthesis_manifest": digest(before), "catalog": origin | {"canonical": A.table_hash(known, ["internal_id"])}, "threshold": limits.threshold, "shortlist": limits.shortlist,
        "adjudicator": getattr(adjudicator, "name", None), "resolutions": A.table_hash(out, ["candidate_id"]),
    }
    store.unchanged("synthesize", source_id, ident, run_id, before=before)
    res_id = _run_id(descriptor)
    manifest = {"source_id": source_id, "snapshot_id": ident, "synthesis_run_id": run_id, "run_id": res_id, "descriptor": descriptor, "counts": {r.status: r.n for r in R.resolution_counts(out).collect()}}
    return store.publish("resolve", (source_id, ident, run_id, res_id), manifest, {"resolutions": out, "catalog": known})


def load_resolution(store: Store, source_id: str, ident: str, run_id: str, res_id: str) -> tuple[dict, dict[str, DataFrame], DataFrame]:
    """A resolution of every concept candidate of its run, one row each, with its catalog and the candidates."""
    manifest, tables = store.load("resolve", source_id, ident, run_id, res_id)
    _checked_run(manifest, res_id)
    synthesis, c = load_synthesis(store, source_id, ident, run_id)
    if manifest["descriptor"]["synthesis_manifest"] != digest(synthesis) or manifest["descriptor"]["catalog"]["canonical"] != A.table_hash(tables["catalog"], ["internal_id"]):
        raise KStateError("the resolution was made of other candidates or another catalog")
    N.require(N.repeated(tables["resolutions"], ["candidate_id"]), "one resolution a candidate")
    a, b = c.filter("candidate_type = 'concept'").select("candidate_id"), tables["resolutions"].select("candidate_id")
    N.require(files.tree_difference(a, b), "a resolution for every concept candidate, and no other")
    return manifest, tables, c


# -- 8, 9: the plan and the canonical state --------------------------------------------------------------


def plan(store: Store, source_id: str, ident: str, run_id: str, res_id: str, claims: str | Path | None = None, relations: str | Path | None = None, decisions: str | Path | None = None) -> dict:
    """The operation log of a resolved run, given what is known already and what was decided by hand."""
    before, tables, c = load_resolution(store, source_id, ident, run_id, res_id)
    spark, catalog = store.spark, tables["catalog"]
    known, claim_origin = optional(spark, claims, "internal_id string, statement string, evidence_anchors array<string>, status string")
    rels, relation_origin = optional(spark, relations, A.SCHEMAS["relation"].removesuffix(", merged_into string"))
    ledger, ledger_origin = optional(spark, decisions, DECISIONS)
    known, rels, ledger = cut(known), cut(rels), cut(ledger)
    N.require(planning_faults(known, rels, catalog), "the planning state keeps its rules")
    c = cut(_ordered(c))
    of = lambda kind: c.filter(F.col("candidate_type") == kind)
    N.require(P.decision_faults(ledger, c, tables["resolutions"], known, rels), "decisions keep their rules")
    used = catalog.select(F.explode(F.concat(F.array("canonical_path"), "path_history")).alias("p")).select(path_key(F.col("p")).alias("path_key"))
    concepts = cut(P.plan_concepts(of("concept"), tables["resolutions"], ledger, used))
    parts = [concepts, P.plan_summaries(of("summary"), ledger), P.plan_claims(of("claim"), known, ledger), P.plan_relations(of("relation"), concepts, rels, ledger)]
    log = cut(P.number_operations([cut(p) for p in parts]))
    N.require(A.operation_faults(log), "the log keeps its rules")
    descriptor = {
        "profile": PROFILE, "resolution_manifest": digest(before), "catalog": before["descriptor"]["catalog"]["canonical"], "unicode_version": UNICODE_VERSION, "slug_basis": "kst-slug-v1",
        "claims": claim_origin | {"canonical": A.table_hash(known, ["internal_id"])}, "relations": relation_origin | {"canonical": A.table_hash(rels, ["internal_id"])},
        "decisions": ledger_origin | {"canonical": A.table_hash(ledger, ["candidate_id"])}, "operations": A.table_hash(log, ["operation_id"]),
    }
    plan_id = _run_id(descriptor)
    store.unchanged("resolve", source_id, ident, run_id, res_id, before=before)
    counts = {f"{r.kind}:{r.value}" if r.value else r.kind: r.n for r in P.plan_counts(log).collect()}
    manifest = {"source_id": source_id, "snapshot_id": ident, "synthesis_run_id": run_id, "resolution_run_id": res_id, "run_id": plan_id, "descriptor": descriptor, "counts": counts}
    return store.publish("plan", (source_id, ident, run_id, res_id, plan_id), manifest, {"operations": log, "claims": known, "relations": rels, "decisions": ledger})


def planning_faults(claims: DataFrame, relations: DataFrame, catalog: DataFrame) -> DataFrame:
    """(internal_id, fault): ids used twice over claims and relations, blank texts, ends that are no catalog concept."""
    ids = claims.select("internal_id").unionByName(relations.select("internal_id"))
    twice = N.repeated(ids, ["internal_id"]).select("internal_id", F.lit("repeated id").alias("fault"))
    blank = claims.filter("internal_id is null or internal_id = '' or trim(coalesce(statement, '')) = '' or evidence_anchors is null").select("internal_id", F.lit("claim").alias("fault"))
    ends = relations.select("internal_id", F.explode(F.array("subject_internal_id", "object_internal_id")).alias("x"))
    lost = ends.join(catalog.select(F.col("internal_id").alias("x")), "x", "left_anti").select("internal_id", F.lit("end not in the catalog").alias("fault")).distinct()
    return twice.unionByName(blank).unionByName(lost)


def load_plan(store: Store, *identity: str) -> tuple[dict, dict[str, DataFrame], DataFrame]:
    """A plan whose id follows from its descriptor, made on the resolution that is still there, and that resolution's catalog."""
    manifest, tables = store.load("plan", *identity)
    _checked_run(manifest, identity[-1])
    resolution, res_tables, _ = load_resolution(store, *identity[:-1])
    if manifest["descriptor"]["resolution_manifest"] != digest(resolution):
        raise KStateError("the plan was made on another resolution")
    for name in ("claims", "relations", "decisions"):
        if manifest["descriptor"][name]["canonical"] != A.table_hash(tables[name], ORDER[name]):
            raise KStateError(f"the plan has other {name}")
    if manifest["descriptor"]["operations"] != A.table_hash(tables["operations"], ["operation_id"]):
        raise KStateError("the plan has other operations")
    return manifest, tables, res_tables["catalog"]


def load_current(store: Store) -> tuple[dict, dict[str, DataFrame]] | None:
    """The active generation, its rules, registry and id checked; none before the first compilation."""
    pointer = store.root / "current.json"
    if not pointer.exists():
        return None
    at = files.read_manifest(pointer)
    if set(at) != {"schema_version", "generation_id", "manifest"} or not isinstance(at["generation_id"], str):
        raise KStateError("the pointer is malformed")
    manifest, tables = store.load("generation", at["generation_id"])
    if digest(manifest) != at["manifest"] or digest(manifest["descriptor"]) != at["generation_id"]:
        raise KStateError("the pointer names another generation")
    state = {t: tables[t] for t in A.TYPES}
    N.require(A.state_faults(state), "the state keeps its rules")
    if A.table_hash(A.identity_registry(state), ORDER["registry"]) != manifest["tables"]["registry"]:
        raise KStateError("the registry is not that of the state")
    return manifest, tables


def compile_state(store: Store, *identity: str) -> dict:
    """Applies a plan to the active generation and makes the result active, one writer at a time.

    A plan applied last changes nothing; one applied earlier, one made against another state, and a pointer that moved
    meanwhile are errors. The generation stays on disk in any case, the pointer moves last.
    """
    first, tables, catalog = load_plan(store, *identity)
    plan_id = identity[-1]
    store.root.mkdir(parents=True, exist_ok=True)
    with files.exclusive(store.root / ".lock"):
        now = load_current(store)
        current = now[0]["descriptor"] | {"generation_id": now[0]["generation_id"]} if now else None
        if A.replay_guard(current, plan_id):
            return now[0]
        relations = tables["relations"]
        if now is None:
            base = A.bootstrap(catalog, tables["claims"], relations)
        else:
            base = {t: now[1][t] for t in A.TYPES}
            A.stale_guard(catalog, A.catalog_projection(base["concept"]))
            claims_now, relations_now = A.planning_projection(base["claim"], base["relation"])
            A.stale_guard(tables["claims"], claims_now)
            A.stale_guard(relations, relations_now)
        N.require(A.path_faults(base["concept"], tables["operations"]), "new concepts have paths of their own")
        state, results = A.apply_operations(base, A.translate(tables["operations"]))
        state = {t: cut(s) for t, s in state.items()}
        N.require(A.state_faults(state), "the new state keeps its rules")
        log = cut(A.events(tables["operations"], results, plan_id))
        if now is not None:
            log = cut(now[1]["events"].unionByName(log))
        if load_plan(store, *identity)[0] != first:
            raise KStateError("the plan changed while it was compiled")
        made = A.generation(state, log, plan_id, current)
        ident = made.pop("generation_id")
        counts = {f"{r.object_type}:{r.status}": r.n for r in A.identity_registry(state).groupBy("object_type", "status").agg(F.count("*").alias("n")).collect()}
        manifest = {"generation_id": ident, "descriptor": made, "counts": counts}
        manifest = store.publish("generation", (ident,), manifest, state | {"events": log, "registry": A.identity_registry(state)})
        after = load_current(store)
        if (after[0]["generation_id"] if after else None) != made["parent_generation_id"]:
            raise KStateError("the pointer moved during the compilation; the new generation is not active")
        files.write_pointer(store.root / "current.json", {"schema_version": 1, "generation_id": ident, "manifest": digest(manifest)})
        return manifest


def current_projections(store: Store, folder: str | Path) -> list[str]:
    """Writes catalog, claims and relations of the active generation as JSON lines, as the next run's inputs."""
    now = load_current(store)
    if now is None:
        raise KStateError("nothing was compiled yet")
    claims, relations = A.planning_projection(now[1]["claim"], now[1]["relation"])
    os.makedirs(folder, exist_ok=True)
    out = []
    for name, t in (("catalog", A.catalog_projection(now[1]["concept"])), ("claims", claims), ("relations", relations)):
        path = str(Path(folder) / f"{name}.jsonl")
        files.write_json_lines(t, path, ["internal_id"])
        out.append(path)
    return out


def summary(manifest: dict) -> str:
    return canonical_json({k: manifest[k] for k in ("stage", "identity", "run_id", "generation_id", "snapshot_id", "counts", "unit_count", "summary") if k in manifest})

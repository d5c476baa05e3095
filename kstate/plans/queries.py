"""Queries of the pipeline's operators over whole tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kstate import stages
from kstate.functions.canon import canonical_json_text
from kstate.functions.text import id_key, label, label_tokens, normal_text, path_key, path_title, slug
from kstate.operators import apply as A
from kstate.operators import classify as C
from kstate.operators import extract as X
from kstate.operators import normalize as N
from kstate.operators import plan as P
from kstate.operators import resolve as R
from kstate.operators import synthesize as S
from kstate.plans import extraction
from kstate.runtime import cut, table
from kstate.sources import files

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


# -- inputs -------------------------------------------------------------------------------------------


def raw_units(spark: SparkSession, d: str) -> DataFrame:
    """Raw units, each once."""
    return table(spark, d, "raw_unit").dropDuplicates(["unit_no"])


def normal_units(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "normalized_unit").dropDuplicates(["unit_no"])


def candidates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "candidate").dropDuplicates(["candidate_no"])


def concept_candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).filter("candidate_type = 'concept'")


def catalog(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "catalog_concept").dropDuplicates(["internal_id"])


def run_units(spark: SparkSession, d: str) -> DataFrame:
    """Units of each run's snapshot with the run's limits."""
    m = table(spark, d, "synthesis_manifest").select("run_id", "source_id", "snapshot_id", "max_input_chars", "max_batch_units").distinct()
    m = m.withColumn("source_version_uri", F.concat(F.lit("kst-source:"), "source_id", F.lit("@"), "snapshot_id")).drop("source_id", "snapshot_id")
    return normal_units(spark, d).join(m, "source_version_uri").withColumn("size", F.coalesce(F.length("text"), F.lit(0)))


def latest(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The state of each id recorded last; equal times are settled by the row itself."""
    t = table(spark, d, name)
    return A.latest_by(t, ["internal_id"], [F.col("recorded_at").desc_nulls_last(), F.to_json(F.struct("status", "merged_into"), {"ignoreNullFields": "false"})])


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# -- sources ------------------------------------------------------------------------------------------


@query
def infer_provider(spark: SparkSession, d: str) -> DataFrame:
    p = documents(spark, d).select(F.explode(F.array(*[F.concat(F.lit(a), "source_path", F.lit(b)) for a, b in LOCATORS])).alias("locator"))
    return p.filter("locator is not null").distinct().select("locator", files.infer_provider(F.col("locator")).alias("provider"))


LOCATORS = (("", ""), ("git+https://h/", ""), ("user@host:", ""), ("https://h/", ".git"), ("http://h/", ""), ("file:///", ""), ("ssh://h/", ""), ("git://h/", ""), ("https://h/", "?x=.git"))


@query
def source_id_valid(spark: SparkSession, d: str) -> DataFrame:
    s = documents(spark, d).select(F.explode(F.array("source", "source_path", F.concat(F.lit("-"), "source"))).alias("source_id")).distinct()
    return s.select("source_id", files.source_id_valid(F.col("source_id")).alias("valid"))


@query
def safe_path(spark: SparkSession, d: str) -> DataFrame:
    p = documents(spark, d).select(F.explode(F.array("source_path", F.concat(F.lit("/"), "source_path"), F.concat(F.lit("../"), "source_path"), F.concat("source_path", F.lit("/.."))))).distinct()
    return p.select(F.col("col").alias("path"), files.safe_path(F.col("col")).alias("safe"))


def _entries(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents(spark, d).select(
        "source", F.concat("source_path", F.lit("/"), F.col("doc_id").cast("string")).alias("path"), F.lit("file").alias("kind"), F.octet_length(text).cast("long").alias("size"),
        F.sha2(text, 256).alias("sha256"), F.lit(False).alias("executable"), F.lit(None).cast("string").alias("target"),
    )


@query
def tree_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return files.tree_fingerprint(_entries(spark, d), ["source"])


@query
def tree_difference(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "raw_unit").select("unit_no", "source_path")
    return files.tree_difference(a, table(spark, d, "normalized_unit").select("unit_no", "source_path"))


# -- classification -----------------------------------------------------------------------------------


def _classified(spark: SparkSession, d: str) -> DataFrame:
    f = documents(spark, d).select("doc_id", F.col("source_path").alias("path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    return C.classify_files(f)


@query
def classify_extension(spark: SparkSession, d: str) -> DataFrame:
    p = documents(spark, d).select(F.explode(F.array("source_path", F.upper("source_path"), F.concat("source_path", F.lit(".tar.gz")), F.concat(F.lit("a/."), F.col("source")))).alias("path")).distinct()
    return p.select("path", C.extension(F.col("path")).alias("extension"))


@query
def classify_ladder(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).select("doc_id", "extension", "format", "media_type", "family", "route", "basis", "strength", F.array_join("diagnostics", ",").alias("diagnostics"))


@query
def classify_summary(spark: SparkSession, d: str) -> DataFrame:
    return C.classification_summary(_classified(spark, d).withColumn("entry_kind", F.lit("file")))


@query
def text_probe(spark: SparkSession, d: str) -> DataFrame:
    """Control characters and encoding of each text, some with a mark of UTF-16 or UTF-8, some behind bytes no text has."""
    t = documents(spark, d).select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.repeat(F.lit("\x01"), (F.length("source_path") % 3).cast("int"))).alias("t"))
    plain, k = F.encode("t", "UTF-8"), F.col("doc_id")
    content = F.when(k % 7 == 0, F.encode("t", "UTF-16")).when(k % 11 == 0, F.concat(F.unhex(F.lit("EFBBBF")), plain)).when(k % 13 == 0, F.concat(F.unhex(F.lit("FF00")), plain)).otherwise(plain)
    return t.select("doc_id", C.control_characters(F.col("t")).alias("controls"), C.text_encoding(F.substring(content, 1, C.PROBE_BYTES)).alias("encoding"))


@query
def tree_rows(spark: SparkSession, d: str) -> DataFrame:
    """Units of folders and links among the entries of a tree."""
    k = F.col("doc_id") % 3
    e = documents(spark, d).select(F.concat_ws("/", "source_path", F.col("doc_id").cast("string")).alias("path"), F.when(k == 0, "file").when(k == 1, "directory").otherwise("symlink").alias("kind"), F.when(k == 2, F.col("source_path")).alias("target"))
    return X.tree_units(e).select("path", "kind", "data", "native_locator", F.array_join("diagnostics", ",").alias("diagnostics"))


# -- extraction ---------------------------------------------------------------------------------------


def _containers(spark: SparkSession, d: str, make: Callable[[str], bytes], suffix: str, fmt: str, route: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": [f"{k}.{suffix}" for k in b["doc_id"]], "content": [make(t) for t in b["text"]]})

    f = documents(spark, d).filter("text is not null").select("doc_id", "text").mapInPandas(run, "path string, content binary")
    return X.extract(f.withColumn("format", F.lit(fmt)).withColumn("route", F.lit(route)))


def _zip(**parts: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return out.getvalue()


@query
def zip_members(spark: SparkSession, d: str) -> DataFrame:
    u = _containers(spark, d, lambda t: _zip(a_dot_txt=t, b_dot_txt=t[::-1]), "zip", "zip", "archive")
    return u.select("path", F.get_json_object("native_locator", "$.member").alias("member"), "kind", F.get_json_object("data", "$.sha256").alias("sha256"), F.get_json_object("data", "$.size").cast("long").alias("size"))


@query
def text_units(spark: SparkSession, d: str) -> DataFrame:
    f = documents(spark, d).filter("text is not null").select(F.concat_ws("/", "source_path", F.col("doc_id").cast("string")).alias("path"), F.encode("text", "UTF-8").alias("content"), F.lit("text").alias("route"), F.lit("text").alias("format"))
    return X.extract(f).select("path", "kind", F.sha2("text", 256).alias("sha256"), F.length("text").alias("chars"))


@query
def unit_numbers(spark: SparkSession, d: str) -> DataFrame:
    u = raw_units(spark, d).select("source_id", "snapshot_id", "unit_no")
    return X.number_units(u, ["source_id", "snapshot_id"], ["unit_no"]).select("unit_no", "unit_id")


@query
def kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return raw_units(spark, d).groupBy("source_id", "snapshot_id", "kind").agg(F.count("*").alias("n"))


@query
def member_guard(spark: SparkSession, d: str) -> DataFrame:
    u = raw_units(spark, d).withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    small = X.Limits(members=40, member_bytes=4000, total_bytes=16_000)
    return X.over_limit(u, ["source_id", "snapshot_id"], ["unit_no"], "size", small).select("unit_no", "running", "number")


# -- normalisation ------------------------------------------------------------------------------------


@query
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return raw_units(spark, d).select("unit_no", F.md5(normal_text(F.col("text"))).alias("text_md5"))


@query
def normalize_parity(spark: SparkSession, d: str) -> DataFrame:
    """Units of both tables whose text is not the normal form of the raw text, once every 89th raw text was changed."""
    text = F.when(F.col("unit_no") % 89 == 0, F.concat("text", F.lit("\r\n"))).otherwise(F.col("text"))
    a = raw_units(spark, d).select("unit_no", normal_text(text).alias("mine"))
    return a.join(normal_units(spark, d).select("unit_no", "text"), "unit_no").filter("not (mine <=> text)").select("unit_no")


@query
def source_uris(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "raw_unit").select("source_id", "snapshot_id").distinct()
    return u.select("source_id", "snapshot_id", N.source_uri(F.col("source_id")).alias("source_uri"), F.concat(N.source_uri(F.col("source_id")), F.lit("@"), "snapshot_id").alias("source_version_uri"))


@query
def anchor_ids(spark: SparkSession, d: str) -> DataFrame:
    return raw_units(spark, d).select("unit_no", N.anchor_id(F.col("source_path"), F.col("kind"), canonical_json_text("native_locator")).alias("anchor_id"))


@query
def anchor_collisions(spark: SparkSession, d: str) -> DataFrame:
    """Places that more than one unit of a source claims, over all its snapshots, once every 40th unit was put in one place."""
    u = raw_units(spark, d)
    for name, value in (("source_path", "same.md"), ("kind", "text"), ("native_locator", "{}")):
        u = u.withColumn(name, F.when(F.col("unit_no") % 40 == 0, value).otherwise(F.col(name)))
    u = u.withColumn("anchor_id", N.anchor_id(F.col("source_path"), F.col("kind"), canonical_json_text("native_locator")))
    return N.repeated(u, ["source_id", "anchor_id"])


@query
def unit_id_repeats(spark: SparkSession, d: str) -> DataFrame:
    return N.repeated(table(spark, d, "raw_unit"), ["source_id", "snapshot_id", "unit_id"])


@query
def path_collisions(spark: SparkSession, d: str) -> DataFrame:
    u = raw_units(spark, d).select("source_id", F.explode(F.array(F.concat(F.lit("café/"), "source_path"), F.when(F.col("kind") == "page", F.concat(F.lit("café/"), "source_path")))).alias("source_path"))
    return N.path_collisions(u.filter("source_path is not null"), ["source_id"])


@query
def unit_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of units once every rule was broken for some: ids, paths, kinds, locators, diagnostics."""
    u, n = raw_units(spark, d), F.col("unit_no") % 61
    broken = {"unit_id": (1, F.lit("u12")), "source_path": (2, F.concat(F.lit("../"), "source_path")), "kind": (3, F.lit("")), "native_locator": (4, F.lit("{")), "diagnostics": (5, F.lit(None).cast("array<string>"))}
    for c, (k, value) in broken.items():
        u = u.withColumn(c, F.when(n == k, value).otherwise(F.col(c)))
    return N.unit_faults(u).select("unit_no", "fault")


@query
def count_differences(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots whose normalised units, or their diagnostics, are not as many as counted before normalisation."""
    by = ["source_id", "snapshot_id"]
    notes = raw_units(spark, d).groupBy(*by).agg(F.sum(F.size("diagnostics")).alias("diagnostic_count"))
    m = table(spark, d, "synthesis_manifest").select(*by, "unit_count").distinct().join(notes, by, "left").na.fill(0, ["diagnostic_count"])
    u = normal_units(spark, d).withColumn("source_id", F.regexp_extract("source_version_uri", "^kst-source:([^@]*)@", 1)).withColumn("snapshot_id", F.substring_index("source_version_uri", "@", -1))
    return N.count_differences(u, m, by).select(*by, "unit_count", "units", "diagnostic_count", "notes")


@query
def diagnostic_counts(spark: SparkSession, d: str) -> DataFrame:
    return raw_units(spark, d).select(F.explode("diagnostics").alias("diagnostic")).groupBy("diagnostic").agg(F.count("*").alias("n"))


@query
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return N.normalize(raw_units(spark, d)).select("unit_no", "content_sha256")


@query
def unit_counts(spark: SparkSession, d: str) -> DataFrame:
    u = raw_units(spark, d).withColumn("text", normal_text(F.col("text"))).withColumn("anchor_id", N.anchor_id(F.col("source_path"), F.col("kind"), canonical_json_text("native_locator")))
    return u.groupBy("source_id").agg(F.count("*").alias("units"), F.countDistinct("snapshot_id").alias("snapshots"), F.countDistinct("anchor_id").alias("anchors"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))


# -- synthesis ----------------------------------------------------------------------------------------


@query
def ordered_batches(spark: SparkSession, d: str) -> DataFrame:
    return S.ordered_batches(run_units(spark, d))


@query
def batch_sizes(spark: SparkSession, d: str) -> DataFrame:
    u = run_units(spark, d)
    b = S.ordered_batches(u).join(u.select("run_id", "unit_no", "size"), ["run_id", "unit_no"])
    return b.groupBy("run_id", "batch_id").agg(F.count("*").alias("units"), F.sum("size").alias("chars"))


@query
def unit_renderings(spark: SparkSession, d: str) -> DataFrame:
    """Each unit as a provider reads it."""
    u = normal_units(spark, d)
    return u.select("unit_no", F.md5(S.unit_json(u)).alias("json_md5"), F.length(S.unit_json(u)).alias("chars"))


@query
def rendered_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches by the length of what is sent, at three times the longest unit of the run and at most twelve units."""
    u = run_units(spark, d)
    most = u.groupBy("run_id").agg(F.max(F.length(S.unit_json(u))).alias("most"))
    return S.rendered_batches(u.join(most, "run_id").withColumn("max_input_chars", 3 * F.col("most") + 200).withColumn("max_batch_units", F.lit(12)))


@query
def offline_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of the offline provider from every batch, with ids."""
    u = run_units(spark, d)
    req = S.requests(u.join(S.ordered_batches(u), ["run_id", "unit_no"]))
    c = S.assign_ids(S.parse_answers(S.call_provider(req, S.OfflineProvider())))
    return S.candidate_counts(c)


@query
def offline_concepts(spark: SparkSession, d: str) -> DataFrame:
    """Summaries, concepts and relations of the offline provider in each batch; claims are left to the tests, SQL cannot tell sentences."""
    u = run_units(spark, d)
    req = S.requests(u.join(S.ordered_batches(u), ["run_id", "unit_no"]))
    c = S.parse_answers(S.call_provider(req, S.OfflineProvider())).filter("candidate_type <> 'claim'")
    return c.groupBy("run_id", "batch_id", "candidate_type").agg(F.count("*").alias("n"), F.countDistinct("name").alias("names"))


@query
def offline_evidence(spark: SparkSession, d: str) -> DataFrame:
    u = run_units(spark, d)
    req = S.requests(u.join(S.ordered_batches(u), ["run_id", "unit_no"]))
    c = S.assign_ids(S.parse_answers(S.call_provider(req, S.OfflineProvider())))
    # cut after the provider, without the texts: it is asked once, and what is kept are ids and anchors
    c = cut(c.select("run_id", "candidate_id", "evidence_anchors"))
    return S.evidence_violations(c, u.select("run_id", F.col("anchor_uri").alias("anchor")).distinct())


@query
def candidate_ids(spark: SparkSession, d: str) -> DataFrame:
    return S.ordinal_ids(candidates(spark, d), "candidate_no")


@query
def evidence_violations(spark: SparkSession, d: str) -> DataFrame:
    """Faults of evidence in each run, once some candidates lost theirs, name one twice, or one no unit has."""
    n, e = F.col("candidate_no"), F.col("evidence_anchors")
    c = candidates(spark, d).withColumn("evidence_anchors", F.when(n % 97 == 0, F.array().cast("array<string>")).when(n % 101 == 0, F.concat(e, F.slice(e, 1, 1))).when(n % 103 == 0, F.concat(e, F.array(F.lit("kst-source:none#a")))).otherwise(e))
    known = run_units(spark, d).select("run_id", F.col("anchor_uri").alias("anchor")).distinct()
    return S.evidence_violations(c, known).groupBy("run_id", "fault").agg(F.countDistinct("candidate_id").alias("candidates"))


@query
def candidate_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.candidate_counts(candidates(spark, d))


def relation_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Neighbouring concepts of a batch as relations."""
    w = Window.partitionBy("run_id", "batch_id").orderBy("candidate_no")
    c = concept_candidates(spark, d).withColumn("subject_no", F.lag("candidate_no").over(w)).filter("subject_no is not null")
    return c.select(F.col("candidate_no").alias("ordinal"), F.concat(F.lit("r"), F.col("candidate_no").cast("string")).alias("candidate_id"), F.col("subject_no").cast("string").alias("subject_candidate_id"), F.lit("Appears  with").alias("predicate"), F.col("candidate_no").cast("string").alias("object_candidate_id"), "evidence_anchors")


@query
def relation_violations(spark: SparkSession, d: str) -> DataFrame:
    r = relation_candidates(spark, d).withColumn("run_id", F.lit("all"))
    named = concept_candidates(spark, d).filter("trim(coalesce(name, '')) <> ''").select(F.lit("all").alias("run_id"), F.col("candidate_no").cast("string").alias("candidate_id"), "candidate_type")
    return S.relation_violations(r, named).select("candidate_id", "end")


# -- resolution ---------------------------------------------------------------------------------------


@query
def label_keys(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d).select("candidate_no", label(F.col("name")).alias("name_key"), F.md5(label(F.col("statement"))).alias("statement_md5"))


@query
def path_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "concept").select(F.explode(F.array("canonical_path", F.upper("canonical_path"), F.replace("canonical_path", F.lit("/"), F.lit("\\")), F.concat(F.lit("/"), "canonical_path"))).alias("path")).distinct()
    return p.select("path", path_key(F.col("path")).alias("path_key"), path_title(F.col("path")).alias("title_key"))


@query
def catalog_keys(spark: SparkSession, d: str) -> DataFrame:
    return R.key_table(catalog(spark, d))


@query
def catalog_faults(spark: SparkSession, d: str) -> DataFrame:
    return R.catalog_faults(table(spark, d, "concept").select("internal_id", "title", "canonical_path", "aliases", "title_history", "path_history", "resource_uris", "source_anchors"))


@query
def name_matches(spark: SparkSession, d: str) -> DataFrame:
    m = R.name_matches(concept_candidates(spark, d), R.key_table(catalog(spark, d)))
    return m.select("candidate_no", "internal_id", F.array_join("kinds", ",").alias("kinds"))


@query
def ladder_pairs(spark: SparkSession, d: str) -> DataFrame:
    return R.ladder_pairs(concept_candidates(spark, d), catalog(spark, d))


@query
def match_ladder(spark: SparkSession, d: str) -> DataFrame:
    return R.match_ladder(concept_candidates(spark, d), catalog(spark, d)).select("candidate_no", "method", F.array_join("considered", ",").alias("considered"))


@query
def ambiguous_keys(spark: SparkSession, d: str) -> DataFrame:
    """Labels several concepts go by, their titles cut to the first word."""
    k = R.key_table(table(spark, d, "concept").withColumn("title", F.substring_index("title", " ", 1)))
    return k.groupBy("key").agg(F.countDistinct("internal_id").alias("concepts")).filter("concepts > 1")


@query
def match_signals(spark: SparkSession, d: str) -> DataFrame:
    return R.signals(concept_candidates(spark, d), catalog(spark, d)).select("candidate_no", "internal_id", F.array_join("signals", ",").alias("signals"))


@query
def token_overlap_top(spark: SparkSession, d: str) -> DataFrame:
    """The five catalog concepts whose words, descriptions included, overlap most with those of each candidate."""
    w = Window.partitionBy("candidate_no").orderBy(F.desc("overlap"), "internal_id")
    o = R.token_overlap(concept_candidates(spark, d), catalog(spark, d), limit=5).withColumn("overlap", F.round("overlap", 6))
    return o.withColumn("rank", F.row_number().over(w)).filter("rank <= 5")


@query
def shortlist(spark: SparkSession, d: str) -> DataFrame:
    return R.shortlist(concept_candidates(spark, d), catalog(spark, d)).select("candidate_no", "rank", "internal_id", "similarity", F.array_join("signals", ",").alias("signals"))


@query
def resolve(spark: SparkSession, d: str) -> DataFrame:
    r = R.resolve(concept_candidates(spark, d), catalog(spark, d))
    return r.select("candidate_no", "status", "method", "resolved_internal_id", F.size("considered_internal_ids").alias("considered"), F.when(F.col("signals").isNull(), 0).otherwise(F.size("signals")).alias("shortlisted"))


@query
def resolution_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.resolution_counts(table(spark, d, "resolution").dropDuplicates(["candidate_no"]))


# -- planning -----------------------------------------------------------------------------------------


def _resolutions(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "resolution").dropDuplicates(["candidate_no"])
    return r.select(F.col("candidate_no").cast("string").alias("candidate_id"), "status", "resolved_internal_id", "considered_internal_ids")


def _decisions(spark: SparkSession, d: str) -> DataFrame:
    """A ledger made from the data: placeholders are ignored, claims that open with 'No' contradict a known claim.

    That is the one stated as their rest, the smallest id if several are; where none is, one made up, spread evenly over
    all known claims.
    """
    c = candidates(spark, d)
    none = F.array().cast("array<string>")
    blank = c.filter("candidate_type = 'concept' and lower(trim(name)) in ('tbd', '(untitled)', 'unknown', '???', '-')")
    ignore = blank.select(F.col("candidate_no").cast("string").alias("candidate_id"), F.lit("ignore").alias("action"), none.alias("target_internal_ids"), F.lit(None).cast("string").alias("survivor_internal_id"), F.lit("placeholder").alias("reason"))
    known = known_claims(spark, d).select("internal_id", "statement")
    said = known.groupBy(label(F.col("statement")).alias("rest")).agg(F.min("internal_id").alias("stated"))
    no = c.filter("candidate_type = 'claim' and statement like 'No %'").select("candidate_no", label(F.expr("substring(statement, 4)")).alias("rest")).join(said, "rest", "left")
    # ids are numbered in stretches with offsets, so no task sees all of them
    stretch = known.select("internal_id", F.md5("internal_id").substr(1, 3).alias("stretch"))
    n = stretch.groupBy("stretch").agg(F.count("*").alias("n"))
    off = n.withColumn("off", F.sum("n").over(Window.orderBy("stretch")) - F.col("n")).drop("n")
    rank = F.row_number().over(Window.partitionBy("stretch").orderBy("internal_id")) - 1
    spread = stretch.withColumn("r", rank).join(off, "stretch").select((F.col("off") + F.col("r")).alias("at"), F.col("internal_id").alias("made_up"))
    no = no.join(F.broadcast(known.agg(F.count("*").alias("all")))).withColumn("at", F.expr("pmod(candidate_no, all)")).join(spread, "at").select("candidate_no", F.coalesce("stated", "made_up").alias("t"))
    against = no.select(F.col("candidate_no").cast("string").alias("candidate_id"), F.lit("contradict").alias("action"), F.array("t").alias("target_internal_ids"), F.lit(None).cast("string").alias("survivor_internal_id"), F.lit("denies").alias("reason"))
    return ignore.unionByName(against)


def known_claims(spark: SparkSession, d: str) -> DataFrame:
    return latest(spark, d, "claim").filter("status <> 'merged'").select("internal_id", "statement", "evidence_anchors", "status")


def _numbered(c: DataFrame) -> DataFrame:
    return c.withColumn("ordinal", F.col("candidate_no")).withColumn("candidate_id", F.col("candidate_no").cast("string"))


def _used_paths(spark: SparkSession, d: str) -> DataFrame:
    return catalog(spark, d).select(F.explode(F.concat(F.array("canonical_path"), "path_history")).alias("p")).select(path_key(F.col("p")).alias("path_key"))


def concept_operations(spark: SparkSession, d: str) -> DataFrame:
    return P.plan_concepts(_numbered(concept_candidates(spark, d)), _resolutions(spark, d), _decisions(spark, d), _used_paths(spark, d))


def summary_operations(spark: SparkSession, d: str) -> DataFrame:
    c = _numbered(concept_candidates(spark, d)).filter("description is not null").select("ordinal", F.concat(F.lit("s"), "candidate_id").alias("candidate_id"), F.col("description").alias("text"), "evidence_anchors")
    return P.plan_summaries(c, _decisions(spark, d))


def claim_operations(spark: SparkSession, d: str) -> DataFrame:
    c = _numbered(candidates(spark, d).filter("candidate_type = 'claim' and statement is not null"))
    return P.plan_claims(c, known_claims(spark, d), _decisions(spark, d))


def known_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations made from the data: about half the neighbours that were both matched are known to appear together."""
    r = _resolutions(spark, d).filter("status = 'matched'").select("candidate_id", "resolved_internal_id")
    c = relation_candidates(spark, d).select("subject_candidate_id", "object_candidate_id")
    c = c.join(r.toDF("subject_candidate_id", "subject_internal_id"), "subject_candidate_id").join(r.toDF("object_candidate_id", "object_internal_id"), "object_candidate_id")
    c = c.filter(F.substring("subject_internal_id", -1, 1) < "8").select("subject_internal_id", "object_internal_id").distinct()
    ident = F.concat(F.lit("urn:kst:relation:"), F.md5(F.concat_ws("|", "subject_internal_id", "object_internal_id")))
    return c.select(ident.alias("internal_id"), "subject_internal_id", F.lit("appears with").alias("predicate"), "object_internal_id", F.array().cast("array<string>").alias("evidence_anchors"), F.lit("active").alias("status"), F.lit(None).cast("string").alias("merged_into"))


def relation_operations(spark: SparkSession, d: str, concepts: DataFrame | None = None) -> DataFrame:
    concepts = cut(concept_operations(spark, d)) if concepts is None else concepts
    return P.plan_relations(relation_candidates(spark, d), concepts, known_relations(spark, d), _decisions(spark, d))


def operation_log(spark: SparkSession, d: str) -> DataFrame:
    concepts = cut(concept_operations(spark, d))
    parts = [concepts, cut(summary_operations(spark, d)), cut(claim_operations(spark, d)), cut(relation_operations(spark, d, concepts))]
    return cut(P.number_operations(parts))


def _shown(o: DataFrame) -> DataFrame:
    return o.select("ordinal", "operation", "reason", F.size("target_internal_ids").alias("targets"), F.get(F.transform("after", lambda x: x["o"]), F.lit(0)).alias("after"))


@query
def plan_concepts(spark: SparkSession, d: str) -> DataFrame:
    return _shown(concept_operations(spark, d))


@query
def plan_summaries(spark: SparkSession, d: str) -> DataFrame:
    return _shown(summary_operations(spark, d))


@query
def plan_claims(spark: SparkSession, d: str) -> DataFrame:
    return _shown(claim_operations(spark, d))


@query
def plan_relations(spark: SparkSession, d: str) -> DataFrame:
    return relation_operations(spark, d).select("ordinal", "operation", "reason", F.size("after").alias("after"))


@query
def plan_counts(spark: SparkSession, d: str) -> DataFrame:
    return P.plan_counts(operation_log(spark, d))


@query
def operation_numbers(spark: SparkSession, d: str) -> DataFrame:
    return operation_log(spark, d).select("object_type", "ordinal", "operation_id")


@query
def operation_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of the log once some operations got an unknown verb, wait for themselves, or share a candidate."""
    n, o = F.col("number"), operation_log(spark, d)
    o = o.withColumn("operation", F.when(n % 101 == 0, "explode").otherwise(F.col("operation"))).withColumn("candidate_id", F.when(n % 107 == 0, "twice").otherwise(F.col("candidate_id")))
    return A.operation_faults(o.withColumn("dependencies", F.when(n % 103 == 0, F.concat("dependencies", F.array("operation_id"))).otherwise(F.col("dependencies"))))


@query
def decision_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of a ledger that breaks every rule: no reason, unknown candidates and targets, actions and targets not allowed, decided twice."""
    c = candidates(spark, d).select(F.col("candidate_no").cast("string").alias("candidate_id"), "candidate_type", "candidate_no")
    bad = _decisions(spark, d).withColumn("reason", F.when(F.col("action") == "ignore", " ").otherwise(F.col("reason")))
    rest = c.join(bad.select("candidate_id"), "candidate_id", "left_anti")
    k, is_claim = F.col("candidate_no") % 50, F.col("candidate_type") == "claim"
    one, none = F.array(F.lit("urn:none")), F.array().cast("array<string>")
    broken = [
        (~is_claim & (k == 1), "contradict", none), (~is_claim & (k == 2), "ignore", one), (~is_claim & (k == 3), "merge", one), (k == 4, "ignore", none),
        (k == 5, "ignore", none), (k == 5, "ignore", none), (is_claim & (k == 6), "update", none), (is_claim & (k == 7), "supersede", one),
    ]
    for which, action, targets in broken:
        ident = F.when(k == 4, F.concat(F.lit("z"), "candidate_id")).otherwise(F.col("candidate_id"))
        bad = bad.unionByName(rest.filter(which).select(ident.alias("candidate_id"), F.lit(action).alias("action"), targets.alias("target_internal_ids"), F.lit(None).cast("string").alias("survivor_internal_id"), F.lit("planted").alias("reason")))
    return P.decision_faults(cut(bad), c.drop("candidate_no"), _resolutions(spark, d), known_claims(spark, d), known_relations(spark, d))


@query
def planning_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of a planning state in which some claims stand twice or say nothing, and some relations start nowhere."""
    c, r = known_claims(spark, d), known_relations(spark, d).drop("merged_into")
    n = F.length("statement")
    c = c.withColumn("statement", F.when(n % 17 == 0, " ").otherwise(F.col("statement"))).unionByName(c.filter(n % 13 == 0))
    r = r.withColumn("subject_internal_id", F.when(F.substring("internal_id", -1, 1) < "8", "urn:none").otherwise(F.col("subject_internal_id")))
    return stages.planning_faults(c, r, catalog(spark, d))


@query
def path_faults(spark: SparkSession, d: str) -> DataFrame:
    """New concepts whose path is a current or former one of the catalog, once some were given such a path."""
    log, taken = operation_log(spark, d), catalog(spark, d).agg(F.min("canonical_path").alias("taken"))
    log = log.join(F.broadcast(taken)).withColumn("proposed_canonical_path", F.when((F.col("number") % 5 == 0) & F.col("proposed_canonical_path").isNotNull(), F.upper("taken")).otherwise(F.col("proposed_canonical_path"))).drop("taken")
    return A.path_faults(_state(spark, d)["concept"], log).select("operation_id", "fault")


@query
def provisional_ids(spark: SparkSession, d: str) -> DataFrame:
    return claim_operations(spark, d).filter("operation = 'create'").select("ordinal", "provisional_internal_id", P.final_id(F.lit("claim"), F.col("provisional_internal_id")).alias("final_id"))


@query
def translated_ids(spark: SparkSession, d: str) -> DataFrame:
    """Final ids of the claims an operation makes, and of those it merges into."""
    t = A.translate(operation_log(spark, d)).filter("object_type = 'claim'")
    return t.select("ordinal", "operation", "final_id", F.when(F.col("operation") == "merge", F.get("target_internal_ids", F.lit(0))).alias("merged_into"), F.when(F.col("operation") == "merge", F.col("survivor_internal_id")).alias("survivor"))


@query
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return concept_candidates(spark, d).select("candidate_no", slug(F.col("name")).alias("slug"))


@query
def path_proposals(spark: SparkSession, d: str) -> DataFrame:
    o = concept_operations(spark, d).filter("operation = 'create'")
    p = F.col("proposed_canonical_path")
    return o.select("ordinal", F.regexp_replace(p, "--[0-9a-f]{10}(-[0-9]+)?\\.md$", ".md").alias("base"), p.rlike("--[0-9a-f]{10}(-[0-9]+)?\\.md$").alias("made_unique"))


# -- compilation --------------------------------------------------------------------------------------


def _state(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return A.bootstrap(catalog(spark, d), known_claims(spark, d), known_relations(spark, d))


def compiled(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    log = operation_log(spark, d)
    state, results = A.apply_operations(_state(spark, d), A.translate(log))
    return state, log, results


@query
def compile_counts(spark: SparkSession, d: str) -> DataFrame:
    state, _, _ = compiled(spark, d)
    return A.identity_registry(state).groupBy("object_type", "status").agg(F.count("*").alias("n"))


@query
def compile_titles(spark: SparkSession, d: str) -> DataFrame:
    """Catalog concepts after the log: the last name said wins, earlier ones are history."""
    state, _, _ = compiled(spark, d)
    return state["concept"].join(catalog(spark, d).select("internal_id"), "internal_id").select("internal_id", "title", F.size("source_anchors").alias("anchors"))


@query
def compile_links(spark: SparkSession, d: str) -> DataFrame:
    """How many claims each contradicted claim has against it, and whether the links are mutual."""
    state, _, _ = compiled(spark, d)
    c = state["claim"].filter("size(contradicted_by) > 0").select("internal_id", F.size("contradicted_by").alias("against"))
    back = state["claim"].select(F.explode("contradicts").alias("internal_id")).groupBy("internal_id").agg(F.count("*").alias("back"))
    return c.join(back, "internal_id", "left")


@query
def compile_faults(spark: SparkSession, d: str) -> DataFrame:
    """Faults of the compiled state once some catalog concepts were merged into themselves and some moved to one path."""
    state, end = dict(compiled(spark, d)[0]), F.substring("internal_id", -1, 1)
    c = state["concept"].join(catalog(spark, d).select("internal_id", F.lit(True).alias("old")), "internal_id", "left")
    c = c.withColumn("merged_into", F.when(F.col("old") & end.isin("0", "1", "2"), F.col("internal_id")).otherwise(F.col("merged_into")))
    state["concept"] = c.withColumn("canonical_path", F.when(F.col("old") & end.isin("3", "4"), "Concepts/shared.md").otherwise(F.col("canonical_path"))).drop("old")
    return A.state_faults(state)


@query
def state_faults(spark: SparkSession, d: str) -> DataFrame:
    """Rules the latest rows of concepts and claims break as they stand: merges written loosely, links to nothing."""
    none = {t: spark.createDataFrame([], A.SCHEMAS[t]) for t in ("summary", "relation")}
    return A.state_faults({"concept": latest(spark, d, "concept"), "claim": latest(spark, d, "claim"), **none})


@query
def event_log(spark: SparkSession, d: str) -> DataFrame:
    _, log, results = compiled(spark, d)
    e = A.events(log, results, "sha256-plan")
    return e.select("number", "operation_id", F.size("result_ids").alias("results"), F.get_json_object("operation_snapshot", "$.operation").alias("operation"))


@query
def verb_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Verbs by object type, and whether the type knows them; what a decision denies or drops is written as a supersession here."""
    rows = [(t, v) for t, vs in A.VERBS.items() for v in vs]
    known = spark.createDataFrame(rows, "object_type string, operation string").withColumn("allowed", F.lit(True))
    o = operation_log(spark, d).withColumn("operation", F.when(F.col("reason").isin("denies", "placeholder", "relation-endpoint-unresolved"), "supersede").otherwise(F.col("operation")))
    n = o.groupBy("object_type", "operation").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(known), ["object_type", "operation"], "left").select("object_type", "operation", "n", F.coalesce("allowed", F.lit(False)).alias("allowed"))


@query
def catalog_projection(spark: SparkSession, d: str) -> DataFrame:
    return A.catalog_projection(latest(spark, d, "concept")).select("internal_id", "title", "canonical_path", "status")


@query
def planning_projection(spark: SparkSession, d: str) -> DataFrame:
    claims, relations = A.planning_projection(latest(spark, d, "claim"), known_relations(spark, d))
    return claims.select("internal_id", "statement", "status").unionByName(relations.select("internal_id", F.concat_ws(" ", "subject_internal_id", "predicate", "object_internal_id").alias("statement"), "status"))


@query
def identity_registry(spark: SparkSession, d: str) -> DataFrame:
    return A.identity_registry({"concept": latest(spark, d, "concept"), "claim": latest(spark, d, "claim")})


@query
def link_faults(spark: SparkSession, d: str) -> DataFrame:
    """Links of claims that lead to no claim, once some claims contradict one nobody made."""
    c = latest(spark, d, "claim")
    lost = F.when(F.length("statement") % 11 == 0, F.array(F.lit("urn:kst:claim:none"))).otherwise(F.array().cast("array<string>"))
    x = c.withColumn("contradicts", F.concat("contradicts", lost))
    x = x.select("internal_id", F.explode(F.concat(*A.LINKS)).alias("target"))
    return x.join(c.select(F.col("internal_id").alias("target")), "target", "left_anti").select("internal_id", "target").distinct()


@query
def shared_paths(spark: SparkSession, d: str) -> DataFrame:
    """Active concepts on one path with another, the paths cut to twelve signs."""
    return A.shared_paths(latest(spark, d, "concept").withColumn("canonical_path", F.substring("canonical_path", 1, 12))).select("internal_id")


@query
def ordered_anchors(spark: SparkSession, d: str) -> DataFrame:
    """Evidence of each run's candidates in the order in which it first appears, as a hash and a count.

    Each anchor's first place is found by aggregation; what is gathered for a run is its distinct anchors.
    """
    e = candidates(spark, d).select("run_id", "candidate_no", F.posexplode("evidence_anchors").alias("i", "a"))
    f = e.groupBy("run_id", "a").agg(F.min(F.struct("candidate_no", "i")).alias("at"))
    g = f.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("at", "a"))).alias("all"))
    return g.select("run_id", F.size("all").alias("anchors"), F.md5(F.array_join(F.transform("all", lambda x: x["a"]), "\n")).alias("order_md5"))


@query
def merge_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Ends moved along chains of merged concepts, as relations would be: every merged concept with where it ended up.

    Ids are compared without outer blanks and letter case. A concept that names itself, or an id no concept has, was merged
    into nothing; a cycle ends at its smallest id, for the concepts on it too.
    """
    c = cut(latest(spark, d, "concept").select("internal_id", id_key(F.col("internal_id")).alias("own"), id_key(F.col("merged_into")).alias("k")))
    ids = c.groupBy(F.col("own").alias("k")).agg(F.min("internal_id").alias("merged_into"))
    state = cut(c.filter("k <> own").join(ids, "k").select("internal_id", "merged_into"))
    probe = state.select("internal_id", F.col("internal_id").alias("subject_internal_id"), F.lit("is").alias("predicate"), F.col("merged_into").alias("object_internal_id"), F.lit("active").alias("status"))
    return A.rewrite_ends(probe, state).select("internal_id", F.col("subject_internal_id").alias("survivor"))


@query
def token_sets(spark: SparkSession, d: str) -> DataFrame:
    t = label_tokens(F.col("description"))
    return concept_candidates(spark, d).filter("description is not null").select("candidate_no", F.size(t).alias("tokens"), F.md5(F.array_join(F.sort_array(t), " ")).alias("tokens_md5"))


def queries() -> dict[str, Query]:
    return REGISTRY | extraction.REGISTRY



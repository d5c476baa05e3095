"""A canonical state and an operation log give the next state.

Operations take effect in order, yet only within the ids that merges, contradictions and supersessions tie
together: state rows and operations are folded group by group. Relations follow after the concepts,
with the composed map of merged concepts. The rules the state must keep are tables of violations.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError, canonical_json, digest
from kstate.functions.text import path_key
from kstate.operators.graph import linked_groups
from kstate.operators.plan import final_id
from kstate.runtime import cut

LIST = "array<string>"
SCHEMAS = {
    "concept": f"internal_id string, title string, description string, canonical_path string, aliases {LIST}, title_history {LIST}, path_history {LIST}, resource_uris {LIST}, source_anchors {LIST}, status string, merged_into string",
    "summary": f"internal_id string, text string, evidence_anchors {LIST}, status string, merged_into string",
    "claim": f"internal_id string, statement string, evidence_anchors {LIST}, status string, merged_into string, contradicts {LIST}, contradicted_by {LIST}, supersedes {LIST}, superseded_by {LIST}",
    "relation": f"internal_id string, subject_internal_id string, predicate string, object_internal_id string, evidence_anchors {LIST}, status string, merged_into string",
}
TYPES = tuple(SCHEMAS)
LINKS = ("contradicts", "contradicted_by", "supersedes", "superseded_by")
#: verbs each object type knows
VERBS = {"concept": ("create", "update", "merge", "ignore"), "summary": ("create", "merge", "ignore"), "claim": ("create", "update", "merge", "contradict", "supersede", "ignore"), "relation": ("create", "update", "merge", "ignore")}
FOLD_SCHEMA = "object_type string, row string, result_of string, result_ids array<string>"


def ordered_union(*lists: list[str] | None) -> list[str]:
    """Members of the lists in the order in which they first appear."""
    return list(dict.fromkeys(x for part in lists for x in part or ()))


# -- the fold ---------------------------------------------------------------------------------------


class Fold:
    """Rows of one object type by id, changed by one operation after the other."""

    def __init__(self, kind: str, rows: list[dict]) -> None:
        self.kind, self.rows = kind, {r["internal_id"]: r for r in rows}

    def target(self, op: dict, ident: str) -> dict:
        row = self.rows.get(ident)
        if row is None or row["status"] == "merged":
            raise KStateError(f"{op['operation_id']}: target {ident} is unknown or merged")
        return row

    def fresh(self, op: dict) -> dict:
        ident = op["final_id"]
        if ident in self.rows:
            raise KStateError(f"{op['operation_id']}: {ident} exists already")
        lists = [f.split()[0] for f in SCHEMAS[self.kind].split(", ") if f.endswith(LIST)]
        row = {k: [] for k in lists} | {"internal_id": ident, "status": "active", "merged_into": None}
        self.rows[ident] = row
        return row

    def say(self, row: dict, op: dict) -> None:
        """Takes over what the operation says and its evidence."""
        p, evidence = op["payload"], "source_anchors" if self.kind == "concept" else "evidence_anchors"
        if self.kind == "concept":
            if row.get("title") not in (None, p["name"]):
                row["title_history"] = ordered_union(row["title_history"], [row["title"]])
            row["title"], row["description"] = p["name"], p["description"]
        elif self.kind == "summary":
            row["text"] = p["text"]
        elif self.kind == "claim":
            row["statement"] = p["statement"]
        else:
            row["predicate"] = p["predicate"]
            row.setdefault("subject_internal_id", p["subject_internal_id"])
            row.setdefault("object_internal_id", p["object_internal_id"])
        row[evidence] = ordered_union(row[evidence], op["evidence_anchors"])

    def absorb(self, winner: dict, loser: dict) -> None:
        if self.kind == "concept":
            winner["aliases"] = ordered_union(winner["aliases"], loser["aliases"], [loser["title"]])
            winner["path_history"] = ordered_union(winner["path_history"], [loser["canonical_path"]], loser["path_history"])
            same = ("title_history", "resource_uris", "source_anchors")
        else:
            same = ("evidence_anchors", *(LINKS if self.kind == "claim" else ()))
        for f in same:
            winner[f] = ordered_union(winner[f], loser[f])
        loser["status"], loser["merged_into"] = "merged", winner["internal_id"]

    def apply(self, op: dict) -> list[str]:
        """Ids that come out of the operation."""
        verb, targets, survivor = op["operation"], op["target_internal_ids"], op["survivor_internal_id"]
        if verb not in VERBS[self.kind]:
            raise KStateError(f"{op['operation_id']}: a {self.kind} knows no {verb}")
        if verb == "ignore":
            return []
        if verb == "create":
            row = self.fresh(op)
            if self.kind == "concept":
                row["canonical_path"] = op["proposed_canonical_path"]
            self.say(row, op)
        elif verb == "update":
            if len(targets) != 1:
                raise KStateError(f"{op['operation_id']}: an update has one target")
            row = self.target(op, targets[0])
            self.say(row, op)
        elif verb == "merge":
            if survivor not in targets:
                raise KStateError(f"{op['operation_id']}: the survivor is no target")
            row = self.target(op, survivor)
            gone = {}
            for t in targets:
                if t != survivor:
                    self.absorb(row, self.target(op, t))
                    gone[t] = survivor
            if self.kind == "claim" and gone:
                for r in self.rows.values():
                    for f in LINKS:
                        r[f] = [x for x in ordered_union([gone.get(x, x) for x in r[f]]) if x != r["internal_id"]]
            self.say(row, op)
        else:
            if len(targets) != 1:
                raise KStateError(f"{op['operation_id']}: {verb} has one target")
            old = self.target(op, targets[0])
            row = self.fresh(op)
            self.say(row, op)
            mine, theirs = ("contradicts", "contradicted_by") if verb == "contradict" else ("supersedes", "superseded_by")
            row[mine] = [old["internal_id"]]
            old[theirs] = ordered_union(old[theirs], [row["internal_id"]])
            if verb == "supersede":
                old["status"] = "superseded"
        return [row["internal_id"]]


def _fold_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds rows sorted by type, group and number, a group after the other: its state (number 0) first, then its operations.

    Only the state of one group is held; operations stream by.
    """
    names = [f.split()[0] for f in FOLD_SCHEMA.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string())]
    at, fold, out = None, None, []

    def close() -> None:
        out.extend((fold.kind, canonical_json(r), None, None) for r in fold.rows.values())

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    for b in batches:
        for kind, group, number, body in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (kind, group) != at:
                if fold is not None:
                    close()
                at, fold = (kind, group), Fold(kind, [])
            row = json.loads(body)
            if number == 0:
                fold.rows[row["internal_id"]] = row
            else:
                row["payload"] = json.loads(row["payload"])
                out.append((kind, None, row["operation_id"], fold.apply(row)))
        yield batch()
        out.clear()
    if fold is not None:
        close()
        yield batch()


def translate(operations: DataFrame) -> DataFrame:
    """Adds final_id and puts final ids for provisional ones into targets, survivor and the ends of relations."""
    o = operations.withColumn("final_id", F.when(F.col("provisional_internal_id").isNotNull(), final_id(F.col("object_type"), F.col("provisional_internal_id"))))
    ids = cut(o.filter("final_id is not null").select(F.col("provisional_internal_id").alias("p"), F.col("final_id").alias("f")).distinct())
    t = o.select("operation_id", F.posexplode("target_internal_ids").alias("i", "p")).join(ids, "p", "left").select("operation_id", "i", F.coalesce("f", "p").alias("t"))
    t = t.groupBy("operation_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda x: x["t"]).alias("tt"))
    o = o.join(t, "operation_id", "left").withColumn("target_internal_ids", F.coalesce("tt", F.array().cast(LIST))).drop("tt")
    o = o.join(ids.toDF("survivor_internal_id", "sf"), "survivor_internal_id", "left").withColumn("survivor_internal_id", F.coalesce("sf", "survivor_internal_id")).drop("sf")
    is_rel = F.col("object_type") == "relation"
    for side in ("subject_internal_id", "object_internal_id"):
        o = o.withColumn(side, F.when(is_rel, F.get_json_object("payload", f"$.{side}"))).join(ids.toDF(side, "e"), side, "left").withColumn(side, F.coalesce("e", side)).drop("e")
    body = F.to_json(F.struct(F.col("object_internal_id"), F.get_json_object("payload", "$.predicate").alias("predicate"), F.col("subject_internal_id")), {"ignoreNullFields": "false"})
    return o.withColumn("payload", F.when(is_rel, body).otherwise(F.col("payload"))).drop("subject_internal_id", "object_internal_id")


def apply_operations(state: dict[str, DataFrame], operations: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The next state, and (operation_id, result_ids) of every operation.

    ``operations`` is a numbered log; ids in it are final (see translate). State rows no operation touches
    pass by the fold. An operation that breaks a rule fails the run.
    """
    ops = cut(operations)
    fields = ["operation_id", "operation", "target_internal_ids", "survivor_internal_id", "final_id", "proposed_canonical_path", "payload", "evidence_anchors"]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    touched = ops.select("object_type", "number", body.alias("body"), F.array_distinct(F.filter(F.concat("target_internal_ids", F.array("final_id", "survivor_internal_id")), lambda x: x.isNotNull())).alias("ids"))
    key = lambda t, i: F.concat_ws("\u0001", t, i)
    ids = touched.select("object_type", "number", F.explode("ids").alias("id"))
    links = touched.filter("size(ids) > 0").select(key(F.col("object_type"), F.get("ids", F.lit(0))).alias("a"), F.explode("ids").alias("x"), "object_type").select("a", key(F.col("object_type"), F.col("x")).alias("b"))
    # claims a fold may rewrite through their links belong to the group of what they link to
    near = state["claim"].select("internal_id", F.explode(F.concat(*LINKS)).alias("x"))
    merged = ids.join(ops.filter("operation in ('merge', 'contradict', 'supersede') and object_type = 'claim'").select("number"), "number").select(F.col("id").alias("x")).distinct()
    hit = near.join(merged, "x").select(key(F.lit("claim"), F.col("internal_id")).alias("a"), key(F.lit("claim"), F.col("x")).alias("b"))
    back = near.join(merged.toDF("internal_id"), "internal_id").select(key(F.lit("claim"), F.col("internal_id")).alias("a"), key(F.lit("claim"), F.col("x")).alias("b"))
    groups = cut(linked_groups(links.unionByName(hit).unionByName(back)))
    work = touched.select("object_type", "number", "body", F.coalesce(key(F.col("object_type"), F.get("ids", F.lit(0))), F.concat(F.lit("none\u0001"), "object_type")).alias("id"), F.pmod(F.col("number"), F.lit(64)).alias("salt"))
    work = work.join(groups, "id", "left").select("object_type", "number", "body", F.coalesce("group", F.concat_ws("\u0001", "id", "salt")).alias("group"))
    rest = {}
    for t in TYPES:
        s = state[t].withColumn("id", key(F.lit(t), F.col("internal_id")))
        rest[t] = s.join(groups, "id", "left_anti").drop("id")
        inside = s.join(groups, "id").select(F.lit(t).alias("object_type"), F.lit(0).cast("bigint").alias("number"), F.to_json(F.struct(*[c for c in state[t].columns]), {"ignoreNullFields": "false"}).alias("body"), "group")
        work = work.unionByName(inside)
    keys = ["object_type", "group"]
    folded = cut(work.select(*keys, "number", "body").repartition(*keys).sortWithinPartitions(*keys, "number").mapInArrow(_fold_rows, FOLD_SCHEMA))
    out = {}
    for t in TYPES:
        new = folded.filter((F.col("object_type") == t) & F.col("row").isNotNull()).select(F.from_json("row", SCHEMAS[t]).alias("r")).select("r.*")
        out[t] = rest[t].unionByName(new.select(*rest[t].columns))
    out["relation"] = rewrite_ends(out["relation"], out["concept"])
    return out, folded.filter("result_of is not null").select(F.col("result_of").alias("operation_id"), "result_ids")


def survivors(links: DataFrame) -> DataFrame:
    """(a, b): where each a of ``links`` (a, b; one row an a) ends. Who leads into a cycle, or stands on it, ends at its smallest id.

    Pointers double; beside each goes the smallest id passed on the way. Once a round ends no further chain, only ways
    into cycles are left, and as many steps as there are such ids go round each cycle whole.
    """
    m, steps, before = cut(links.select("a", "b", F.col("a").alias("low"))), 1, -1
    while True:
        n = cut(m.join(m.toDF("b", "c", "next"), "b", "left").select("a", F.coalesce("c", "b").alias("b"), F.least("low", "next").alias("low"), "next"))
        left = n.filter("next is not null").count()
        if left == 0 or left == before and steps >= left:
            return n.select("a", F.coalesce("next", "b").alias("b"))
        m, steps, before = n.drop("next"), 2 * steps, left


def rewrite_ends(relations: DataFrame, concepts: DataFrame) -> DataFrame:
    """Ends of relations that are not merged move from merged concepts to what these were merged into, however often."""
    m = survivors(concepts.filter("merged_into is not null").select(F.col("internal_id").alias("a"), F.col("merged_into").alias("b")))
    r = relations
    for side in ("subject_internal_id", "object_internal_id"):
        r = r.join(m.toDF(side, "to"), side, "left").withColumn(side, F.when(F.col("status") != "merged", F.coalesce("to", side)).otherwise(F.col(side))).drop("to")
    return r.select(*relations.columns)


# -- rules ------------------------------------------------------------------------------------------


def operation_faults(operations: DataFrame) -> DataFrame:
    """(operation_id, fault): verbs a type does not know, dependencies that do not come before, candidates used twice, gaps in the numbers."""
    pairs = [f"{t}\u0001{v}" for t, vs in VERBS.items() for v in vs]
    o = operations.withColumn("number", F.regexp_extract("operation_id", r"^op(\d{6,})$", 1).cast("bigint"))
    verb = o.filter(~F.concat_ws("\u0001", "object_type", "operation").isin(pairs)).select("operation_id", F.lit("verb").alias("fault"))
    d = o.select("operation_id", "number", F.explode("dependencies").alias("dep"))
    known = o.select(F.col("operation_id").alias("dep"), F.col("number").alias("dn"))
    late = d.join(known, "dep", "left").filter("dn is null or dn >= number").select("operation_id", F.lit("dependency").alias("fault")).distinct()
    twice = o.join(o.groupBy("candidate_id").count().filter("count > 1").select("candidate_id"), "candidate_id", "left_semi").select("operation_id", F.lit("candidate").alias("fault"))
    total = o.agg(F.max("number").alias("top"), F.count("*").alias("n"), F.countDistinct("number").alias("d")).filter("top <> n or d <> n").select(F.lit(None).cast("string").alias("operation_id"), F.lit("numbers").alias("fault"))
    return verb.unionByName(late).unionByName(twice).unionByName(total)


def path_faults(concepts: DataFrame, operations: DataFrame) -> DataFrame:
    """(operation_id, fault): operations that create a concept at a path some concept has or had, or that another one creates too."""
    new = operations.filter("object_type = 'concept' and proposed_canonical_path is not null").select("operation_id", path_key(F.col("proposed_canonical_path")).alias("k"))
    had = concepts.select(F.explode(F.concat(F.array("canonical_path"), "path_history")).alias("p")).select(path_key(F.col("p")).alias("k")).distinct()
    used = new.join(had, "k", "left_semi").select("operation_id", F.lit("path in use").alias("fault"))
    twice = new.join(new.groupBy("k").count().filter("count > 1").select("k"), "k", "left_semi").select("operation_id", F.lit("path created twice").alias("fault"))
    return used.unionByName(twice).unionByName(new.filter("k is null").select("operation_id", F.lit("unsafe path").alias("fault")))


def state_faults(state: dict[str, DataFrame]) -> DataFrame:
    """(object_type, internal_id, fault) of rows that break a rule of the state."""
    out = None
    for t in TYPES:
        s = state[t]
        own = F.when(F.col("internal_id").isNull() | (F.col("internal_id") == ""), "id").when((F.col("status") == "merged") != F.col("merged_into").isNotNull(), "merged").when(F.col("merged_into") == F.col("internal_id"), "merged into itself")
        a = s.select(F.lit(t).alias("object_type"), "internal_id", own.alias("fault")).filter("fault is not null")
        b = s.groupBy("internal_id").count().filter("count > 1").select(F.lit(t).alias("object_type"), "internal_id", F.lit("repeated").alias("fault"))
        c = s.filter("merged_into is not null").join(s.select(F.col("internal_id").alias("merged_into")), "merged_into", "left_anti").select(F.lit(t).alias("object_type"), "internal_id", F.lit("merged into unknown").alias("fault"))
        part = a.unionByName(b).unionByName(c)
        out = part if out is None else out.unionByName(part)
    links = state["claim"].select("internal_id", F.explode(F.concat(*LINKS)).alias("x")).join(state["claim"].select(F.col("internal_id").alias("x")), "x", "left_anti")
    out = out.unionByName(links.select(F.lit("claim").alias("object_type"), "internal_id", F.lit("link to unknown").alias("fault")).distinct())
    ends = state["relation"].filter("status <> 'merged'").select("internal_id", F.explode(F.array("subject_internal_id", "object_internal_id")).alias("x"))
    lost = ends.join(state["concept"].filter("status <> 'merged'").select(F.col("internal_id").alias("x")), "x", "left_anti")
    out = out.unionByName(lost.select(F.lit("relation").alias("object_type"), "internal_id", F.lit("end not active").alias("fault")).distinct())
    return out.unionByName(shared_paths(state["concept"]).select(F.lit("concept").alias("object_type"), "internal_id", F.lit("shared path").alias("fault")))


def shared_paths(concepts: DataFrame) -> DataFrame:
    """Active concepts whose canonical path another active concept has too."""
    c = concepts.filter("status <> 'merged'").withColumn("k", path_key(F.col("canonical_path")))
    return c.join(c.groupBy("k").agg(F.countDistinct("internal_id").alias("n")).filter("n > 1").select("k"), "k", "left_semi").select("internal_id", "canonical_path")


# -- projections, events, generations -----------------------------------------------------------------


def catalog_projection(concepts: DataFrame) -> DataFrame:
    return concepts.filter("status <> 'merged'").drop("merged_into")


def planning_projection(claims: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claims and relations that are not merged; superseded ones stay."""
    return claims.filter("status <> 'merged'").select("internal_id", "statement", "evidence_anchors", "status"), relations.filter("status <> 'merged'").drop("merged_into")


def identity_registry(state: dict[str, DataFrame]) -> DataFrame:
    """(object_type, internal_id, status, merged_into, canonical_path) of everything, tombstones too."""
    out = None
    for t in TYPES:
        if t in state:
            path = F.col("canonical_path") if t == "concept" else F.lit(None).cast("string")
            part = state[t].select(F.lit(t).alias("object_type"), "internal_id", "status", "merged_into", path.alias("canonical_path"))
            out = part if out is None else out.unionByName(part)
    return out


def bootstrap(catalog: DataFrame, claims: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """First state from a catalog and known claims and relations."""
    spark = catalog.sparkSession
    none = F.lit(None).cast("string")
    if not catalog.filter("status = 'merged'").isEmpty():
        raise KStateError("a catalog holds no merged concepts")
    c = claims.select("internal_id", "statement", "evidence_anchors", "status", none.alias("merged_into"), *(F.array().cast(LIST).alias(f) for f in LINKS))
    r = relations.select("internal_id", "subject_internal_id", "predicate", "object_internal_id", "evidence_anchors", "status", none.alias("merged_into"))
    names = [f.split()[0] for f in SCHEMAS["concept"].split(", ")]
    return {"concept": catalog.withColumn("merged_into", none).select(*names), "summary": spark.createDataFrame([], SCHEMAS["summary"]), "claim": c, "relation": r}


def events(operations: DataFrame, results: DataFrame, plan_run_id: str) -> DataFrame:
    """(event_id, plan_run_id, operation_id, number, operation_snapshot, result_ids): one event an operation, ignored ones too.

    ``operations`` is the log as planned, with its provisional ids.
    """
    o = operations.join(results, "operation_id", "left").withColumn("result_ids", F.coalesce("result_ids", F.array().cast(LIST)))
    keep = ["operation_id", "operation", "object_type", "candidate_id", "target_internal_ids", "survivor_internal_id", "provisional_internal_id", "proposed_canonical_path", "payload", "evidence_anchors", "dependencies", "reason"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for snapshot, n, op, ids in zip(b["s"], b["number"], b["operation_id"], b["result_ids"]):
                value = json.loads(snapshot)
                ids = list(ids)
                rows.append((digest({"plan_run_id": plan_run_id, "operation": value, "result_ids": ids}), plan_run_id, op, n, canonical_json(value), ids))
            yield pd.DataFrame(rows, columns=["event_id", "plan_run_id", "operation_id", "number", "operation_snapshot", "result_ids"])

    s = o.select("operation_id", "number", "result_ids", F.to_json(F.struct(*keep), {"ignoreNullFields": "false"}).alias("s"))
    return s.mapInPandas(run, "event_id string, plan_run_id string, operation_id string, number long, operation_snapshot string, result_ids array<string>")


def table_hash(df: DataFrame, order: list[str], parts: int = 1 << 16) -> str:
    """Hash of a table's rows in order: rows are hashed where they are, then parts, then the whole on the driver (at most ``parts`` hashes)."""
    h = df.select(*[F.col(c).alias(c) for c in order], F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256).alias("h"))
    h = h.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    p = h.groupBy("part").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "h"))), lambda x: x["h"]), ""), 256).alias("h")).collect()
    return digest([[r.part, r.h] for r in sorted(p, key=lambda r: r.part)])


def generation(state: dict[str, DataFrame], log: DataFrame, plan_run_id: str, parent: dict | None) -> dict:
    """Descriptor of a generation, with the hash that is its id."""
    body = {
        "profile": "kst-generation-v1", "parent_generation_id": parent["generation_id"] if parent else None, "plan_run_id": plan_run_id,
        "applied_plan_run_ids": [*(parent["applied_plan_run_ids"] if parent else []), plan_run_id],
        "hashes": {t: table_hash(state[t], ["internal_id"]) for t in TYPES} | {"events": table_hash(log, ["event_id"])},
    }
    return body | {"generation_id": digest(body)}


def replay_guard(current: dict | None, plan_run_id: str) -> bool:
    """True if the plan is the active one (nothing to do), an error if it was applied before that."""
    applied = current["applied_plan_run_ids"] if current else []
    if applied and applied[-1] == plan_run_id:
        return True
    if plan_run_id in applied:
        raise KStateError("the plan was applied to an earlier generation")
    return False


def stale_guard(planned: DataFrame, current: DataFrame) -> None:
    """An error if a plan was made against other rows than the current ones."""
    cols = sorted(set(planned.columns) & set(current.columns))
    if not planned.select(cols).exceptAll(current.select(cols)).isEmpty() or not current.select(cols).exceptAll(planned.select(cols)).isEmpty():
        raise KStateError("the plan was made against another state")


def latest_by(df: DataFrame, key: list[str], order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")

"""Operation log from resolved candidates: what to create, update, merge, contradict, supersede or ignore.

First occurrence decides: among candidates that would create the same thing the first in order creates it, later ones
merge into it. It is found by an aggregation and a join, not by a window over a key that many rows may share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kstate.functions.canon import URN, json_object, json_string, json_string_list
from kstate.functions.text import label, path_key, slug

TYPES = ("concept", "summary", "claim", "relation")
ACTIONS = ("ignore", "merge", "update", "contradict", "supersede")
#: actions an explicit decision may take, by type
DECIDABLE = {"concept": ("ignore", "merge"), "summary": ("ignore",), "claim": ACTIONS, "relation": ("ignore", "update", "merge")}
NONE = "array<string>"


def empty() -> Column:
    return F.array().cast(NONE)


def provisional_id(kind: str, descriptor: dict[str, Column]) -> Column:
    """Identity of a thing that does not exist yet: the hash of what proposes it."""
    body = json_object({"object_type": F.lit(f'"{kind}"'), "descriptor": json_object(descriptor)})
    return F.concat(F.lit(f"{URN}:{kind}:sha256-"), F.sha2(body, 256))


def final_id(kind: Column, provisional: Column) -> Column:
    """Identity in the canonical state of a provisional one."""
    body = json_object({"basis": F.lit('"kst-identity-v1"'), "object_type": json_string(kind), "provisional": json_string(provisional)})
    return F.concat(F.lit(f"{URN}:identity:"), kind, F.lit(":sha256-"), F.sha2(body, 256))


def relation_key(subject: Column, predicate: Column, obj: Column) -> Column:
    return F.concat_ws("\u0001", subject, label(predicate), obj)


def first_of_key(rows: DataFrame, key: str, order: str, carry: str) -> DataFrame:
    """(key, first_order, first_carry): the first row of each key and its ``carry``."""
    g = rows.groupBy(key).agg(F.min(F.struct(F.col(order).alias("o"), F.col(carry).alias("c"))).alias("f"))
    return g.select(key, F.col("f.o").alias(f"first_{order}"), F.col("f.c").alias(f"first_{carry}"))


def propose_paths(creates: DataFrame, used: DataFrame) -> DataFrame:
    """(ordinal, path) for new concepts (ordinal, name, provisional): a slug of the name, made unique.

    A slug that is in use, or that an earlier new concept takes, gets ten digits of the provisional id, and a
    counter if that too is taken. ``used`` has the path keys of all current and former paths.
    """
    own = F.substring_index("provisional", "sha256-", -1)
    c = creates.withColumn("slug", slug(F.coalesce("name", F.lit(""))))
    c = c.withColumn("base", F.concat(F.lit("concepts/"), F.when(F.col("slug") == "", F.concat(F.lit("concept-"), own.substr(1, 12))).otherwise(F.col("slug"))))
    c = c.withColumn("plain", F.concat("base", F.lit(".md"))).withColumn("k", path_key(F.col("plain")))
    taken = used.select(F.col("path_key").alias("k")).distinct().withColumn("taken", F.lit(True))
    c = c.join(taken, "k", "left").join(first_of_key(c, "k", "ordinal", "provisional"), "k")
    free = F.col("taken").isNull() & (F.col("ordinal") == F.col("first_ordinal"))
    c = c.withColumn("path", F.when(free, F.col("plain")).otherwise(F.concat("base", F.lit("--"), own.substr(1, 10), F.lit(".md"))))
    c = c.withColumn("free", free).select("ordinal", "path", "free").withColumn("k", path_key(F.col("path")))
    # what the digits leave in doubt: equal paths among themselves, or taken ones
    c = c.join(taken, "k", "left").withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("free"), "ordinal")) - F.when(F.col("free") | F.col("taken").isNull(), 1).otherwise(0))
    return c.select("ordinal", F.when(F.col("n") == 0, F.col("path")).otherwise(F.concat(F.regexp_replace("path", r"\.md$", ""), F.lit("-"), F.col("n").cast("string"), F.lit(".md"))).alias("path"))


OPERATION = ["object_type", "ordinal", "candidate_id", "operation", "target_internal_ids", "survivor_internal_id", "provisional_internal_id", "proposed_canonical_path", "payload", "evidence_anchors", "after", "reason"]


def _operations(d: DataFrame, kind: str, payload: Column, after: Column, path: Column | None = None) -> DataFrame:
    """Rows of the log from columns action, targets, survivor, provisional, reason."""
    new = F.col("action").isin("create", "contradict", "supersede")
    return d.select(
        F.lit(kind).alias("object_type"), "ordinal", "candidate_id", F.col("action").alias("operation"), F.coalesce("targets", empty()).alias("target_internal_ids"),
        F.col("survivor").alias("survivor_internal_id"), F.when(new, F.col("provisional")).alias("provisional_internal_id"), (path if path is not None else F.lit(None).cast("string")).alias("proposed_canonical_path"),
        payload.alias("payload"), F.coalesce("evidence_anchors", empty()).alias("evidence_anchors"), after.alias("after"), "reason",
    )


def _decided(d: DataFrame, decisions: DataFrame) -> DataFrame:
    return d.join(decisions.select("candidate_id", F.col("action").alias("d_action"), F.col("target_internal_ids").alias("d_targets"), F.col("survivor_internal_id").alias("d_survivor"), F.col("reason").alias("d_reason")), "candidate_id", "left")


def plan_concepts(candidates: DataFrame, resolutions: DataFrame, decisions: DataFrame, used_paths: DataFrame) -> DataFrame:
    """Operations for concept candidates (ordinal, candidate_id, name, description, evidence_anchors).

    ``resolutions`` has candidate_id, status, resolved_internal_id, considered_internal_ids; ``decisions`` candidate_id,
    action, target_internal_ids, survivor_internal_id, reason. A decision comes before the status.
    """
    c = candidates.join(resolutions.select("candidate_id", "status", "resolved_internal_id", "considered_internal_ids"), "candidate_id")
    c = _decided(c, decisions)
    c = c.withColumn("key", F.concat_ws("\u0001", label(F.coalesce("name", F.lit(""))), label(F.coalesce("description", F.lit("")))))
    c = c.withColumn("provisional", provisional_id("concept", {"candidate_id": json_string(F.col("candidate_id")), "name": json_string(F.col("name")), "description": json_string(F.col("description")), "evidence_anchors": json_string_list(F.col("evidence_anchors"))}))
    plain = c.filter("d_action is null and status = 'new'")
    c = c.join(first_of_key(plain, "key", "ordinal", "provisional"), "key", "left")
    new, first = F.col("status") == "new", F.col("ordinal") == F.col("first_ordinal")
    decided = F.col("d_action").isNotNull()
    c = c.withColumn("action", F.when(decided, F.col("d_action")).when(F.col("status") == "matched", "update").when(F.col("status") == "ambiguous", "ignore").when(first, "create").otherwise("merge"))
    repeat = ~decided & new & ~first
    c = c.withColumn("targets", F.when(decided, F.col("d_targets")).when(F.col("status") == "matched", F.array("resolved_internal_id")).when(F.col("status") == "ambiguous", F.col("considered_internal_ids")).when(repeat, F.array("first_provisional")))
    c = c.withColumn("survivor", F.when(decided, F.col("d_survivor")).when(F.col("status") == "matched", F.col("resolved_internal_id")).when(new, F.when(first, F.col("provisional")).otherwise(F.col("first_provisional"))))
    c = c.withColumn("reason", F.when(decided, F.col("d_reason")).when(F.col("status") == "matched", "resolved-existing-concept").when(F.col("status") == "ambiguous", "identity-ambiguous").when(first, "resolved-new-concept").otherwise("exact-new-concept-duplicate"))
    paths = propose_paths(c.filter("action = 'create'").select("ordinal", "name", "provisional"), used_paths)
    c = c.join(paths, "ordinal", "left")
    payload = json_object({"name": json_string(F.col("name")), "description": json_string(F.col("description"))})
    after = F.when(repeat, F.array(F.struct(F.lit("concept").alias("t"), F.col("first_ordinal").alias("o")))).otherwise(F.array().cast("array<struct<t:string,o:bigint>>"))
    return _operations(c, "concept", payload, after, F.col("path"))


def plan_summaries(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Operations for summary candidates (ordinal, candidate_id, text, evidence_anchors)."""
    c = _decided(candidates, decisions).withColumn("key", label(F.col("text")))
    c = c.withColumn("provisional", provisional_id("summary", {"candidate_id": json_string(F.col("candidate_id")), "text": json_string(F.col("text")), "evidence_anchors": json_string_list(F.col("evidence_anchors"))}))
    c = c.join(first_of_key(c.filter("d_action is null"), "key", "ordinal", "provisional"), "key", "left")
    decided, first = F.col("d_action").isNotNull(), F.col("ordinal") == F.col("first_ordinal")
    c = c.withColumn("action", F.when(decided, F.col("d_action")).when(first, "create").otherwise("merge"))
    c = c.withColumn("targets", F.when(~decided & ~first, F.array("first_provisional"))).withColumn("survivor", F.when(~decided, F.col("first_provisional")))
    c = c.withColumn("reason", F.when(decided, F.col("d_reason")).when(first, "new-source-summary").otherwise("exact-new-summary-duplicate"))
    after = F.when(~decided & ~first, F.array(F.struct(F.lit("summary").alias("t"), F.col("first_ordinal").alias("o")))).otherwise(F.array().cast("array<struct<t:string,o:bigint>>"))
    return _operations(c, "summary", json_object({"text": json_string(F.col("text"))}), after)


def _against_state(c: DataFrame, known: DataFrame, kind: str, word: str) -> DataFrame:
    """Adds action, targets, survivor, reason of rows with key, provisional and decision columns, given known (key, internal_id)."""
    ids = known.groupBy("key").agg(F.sort_array(F.collect_set("internal_id")).alias("known"))
    c = c.join(ids, "key", "left")
    decided, n = F.col("d_action").isNotNull(), F.coalesce(F.size("known"), F.lit(0))
    c = c.withColumn("plain", ~decided & (F.when(F.col("known").isNull(), 0).otherwise(F.size("known")) == 0) & F.col("key").isNotNull())
    c = c.join(first_of_key(c.filter("plain"), "key", "ordinal", "provisional"), "key", "left")
    n = F.when(F.col("known").isNull(), 0).otherwise(F.size("known"))
    first = F.col("ordinal") == F.col("first_ordinal")
    c = c.withColumn("first", first)
    c = c.withColumn("action", F.when(decided, F.col("d_action")).when(F.col("key").isNull(), "ignore").when(n == 1, "update").when(n > 1, "ignore").when(first, "create").otherwise("merge"))
    c = c.withColumn("targets", F.when(decided, F.col("d_targets")).when(F.col("key").isNull(), empty()).when(n >= 1, F.col("known")).when(~first, F.array("first_provisional")))
    c = c.withColumn(
        "survivor",
        F.when(decided & (F.col("d_action") == "update"), F.coalesce("d_survivor", F.get("d_targets", F.lit(0)))).when(decided, F.col("d_survivor"))
        .when(F.col("key").isNull(), F.lit(None)).when(n == 1, F.get("known", F.lit(0))).when(n == 0, F.col("first_provisional")),
    )
    return c.withColumn(
        "reason",
        F.when(decided, F.col("d_reason")).when(F.col("key").isNull(), f"{kind}-endpoint-unresolved").when(n == 1, f"exact-existing-{kind}")
        .when(n > 1, f"existing-{kind}-duplicate-ambiguous").when(first, word).otherwise(f"exact-new-{kind}-duplicate"),
    )


def plan_claims(candidates: DataFrame, claims: DataFrame, decisions: DataFrame) -> DataFrame:
    """Operations for claim candidates (ordinal, candidate_id, statement, evidence_anchors) given known claims (internal_id, statement).

    Claims made by an explicit contradict or supersede do not count as first occurrences.
    """
    c = _decided(candidates, decisions).withColumn("key", label(F.col("statement")))
    c = c.withColumn("provisional", provisional_id("claim", {"candidate_id": json_string(F.col("candidate_id")), "statement": json_string(F.col("statement")), "evidence_anchors": json_string_list(F.col("evidence_anchors"))}))
    c = _against_state(c, claims.select(label(F.col("statement")).alias("key"), "internal_id"), "claim", "new-claim")
    after = F.when((F.col("action") == "merge") & F.col("plain"), F.array(F.struct(F.lit("claim").alias("t"), F.col("first_ordinal").alias("o")))).otherwise(F.array().cast("array<struct<t:string,o:bigint>>"))
    return _operations(c, "claim", json_object({"statement": json_string(F.col("statement"))}), after)


def plan_relations(candidates: DataFrame, concept_operations: DataFrame, relations: DataFrame, decisions: DataFrame) -> DataFrame:
    """Operations for relation candidates (ordinal, candidate_id, subject_candidate_id, predicate, object_candidate_id, evidence_anchors).

    Ends go through the plan of their concepts; an end whose concept is ignored blocks the relation.
    """
    end = concept_operations.select("candidate_id", F.when(F.col("operation") != "ignore", F.col("survivor_internal_id")).alias("id"), F.col("ordinal").alias("o"))
    c = candidates.join(end.toDF("subject_candidate_id", "subject", "so"), "subject_candidate_id", "left").join(end.toDF("object_candidate_id", "object", "oo"), "object_candidate_id", "left")
    c = _decided(c, decisions)
    both = F.col("subject").isNotNull() & F.col("object").isNotNull()
    c = c.withColumn("key", F.when(both, relation_key(F.col("subject"), F.col("predicate"), F.col("object"))))
    c = c.withColumn("provisional", provisional_id("relation", {"candidate_id": json_string(F.col("candidate_id")), "subject": json_string(F.col("subject")), "predicate": json_string(F.col("predicate")), "object": json_string(F.col("object")), "evidence_anchors": json_string_list(F.col("evidence_anchors"))}))
    known = relations.select(relation_key(F.col("subject_internal_id"), F.col("predicate"), F.col("object_internal_id")).alias("key"), "internal_id")
    c = _against_state(c, known, "relation", "new-relation")
    dep = lambda t, o: F.when(F.col(o).isNotNull(), F.struct(F.lit(t).alias("t"), F.col(o).alias("o")))
    again = F.when((F.col("action") == "merge") & F.col("plain"), F.struct(F.lit("relation").alias("t"), F.col("first_ordinal").alias("o")))
    after = F.array_distinct(F.filter(F.array(dep("concept", "so"), dep("concept", "oo"), again), lambda x: x.isNotNull()))
    payload = json_object({"subject_internal_id": json_string(F.col("subject")), "predicate": json_string(F.col("predicate")), "object_internal_id": json_string(F.col("object"))})
    return _operations(c, "relation", payload, after)


def decision_faults(decisions: DataFrame, candidates: DataFrame, resolutions: DataFrame, claims: DataFrame, relations: DataFrame) -> DataFrame:
    """(candidate_id, fault): decisions without candidate, twice, or not allowed for their type, targets or status."""
    d = decisions.join(candidates.select("candidate_id", "candidate_type"), "candidate_id", "left").join(resolutions.select("candidate_id", "status", "considered_internal_ids"), "candidate_id", "left")
    n, survivor = F.when(F.col("target_internal_ids").isNull(), 0).otherwise(F.size("target_internal_ids")), F.col("survivor_internal_id")
    allowed = F.lit(False)
    for kind, actions in DECIDABLE.items():
        allowed = allowed | ((F.col("candidate_type") == kind) & F.col("action").isin(*actions))
    inside = F.array_contains("target_internal_ids", survivor)
    fault = (
        F.when(F.col("candidate_type").isNull(), "unknown candidate")
        .when(F.trim(F.coalesce("reason", F.lit(""))) == "", "no reason")
        .when(~F.coalesce(allowed, F.lit(False)), "action not allowed")
        .when((F.col("action") == "ignore") & ((n > 0) | survivor.isNotNull()), "ignore names targets")
        .when((F.col("action") == "merge") & ((n < 2) | survivor.isNull() | ~F.coalesce(inside, F.lit(False))), "merge needs two targets and a survivor among them")
        .when((F.col("action") == "update") & ((n != 1) | (survivor.isNotNull() & ~F.coalesce(inside, F.lit(False)))), "update needs one target")
        .when(F.col("action").isin("contradict", "supersede") & ((n != 1) | survivor.isNotNull()), "one target and no survivor")
        .when((F.col("candidate_type") == "concept") & (F.col("action") == "merge") & ((F.col("status") != "ambiguous") | (F.size(F.array_except("target_internal_ids", "considered_internal_ids")) > 0)), "targets were not considered")
    )
    own = d.select("candidate_id", fault.alias("fault")).filter("fault is not null")
    twice = decisions.groupBy("candidate_id").count().filter("count > 1").select("candidate_id", F.lit("decided twice").alias("fault"))
    state = claims.select("internal_id", F.lit("claim").alias("candidate_type")).unionByName(relations.select("internal_id", F.lit("relation").alias("candidate_type")))
    targets = d.filter("candidate_type in ('claim', 'relation')").select("candidate_id", "candidate_type", F.explode("target_internal_ids").alias("internal_id"))
    lost = targets.join(state, ["candidate_type", "internal_id"], "left_anti").select("candidate_id", F.lit("unknown target").alias("fault")).distinct()
    return own.unionByName(twice).unionByName(lost)


def number_operations(parts: list[DataFrame], bits: int = 16) -> DataFrame:
    """The log in its order (concepts, summaries, claims, relations, each by ordinal), with operation_id and dependencies.

    Numbers come from counts of ordinal stretches and a rank within each, so no task sees the whole log.
    """
    ops = parts[0]
    for p in parts[1:]:
        ops = ops.unionByName(p)
    place = F.array_position(F.array(*map(F.lit, TYPES)), F.col("object_type"))
    ops = ops.withColumn("t", place).withColumn("stretch", F.shiftright("ordinal", bits))
    n = ops.groupBy("t", "stretch").agg(F.count("*").alias("n"))
    off = n.withColumn("off", F.sum("n").over(Window.orderBy("t", "stretch").rowsBetween(Window.unboundedPreceding, -1))).na.fill(0, ["off"]).drop("n")
    ops = ops.withColumn("r", F.row_number().over(Window.partitionBy("t", "stretch").orderBy("ordinal"))).join(off, ["t", "stretch"])
    ops = ops.withColumn("number", F.col("off") + F.col("r")).withColumn("operation_id", F.format_string("op%06d", "number")).drop("t", "stretch", "off", "r")
    ids = ops.select(F.col("object_type").alias("at"), F.col("ordinal").alias("ao"), F.col("operation_id").alias("dep"))
    deps = ops.select("operation_id", F.posexplode("after").alias("i", "x")).select("operation_id", "i", F.col("x.t").alias("at"), F.col("x.o").alias("ao"))
    deps = deps.join(ids, ["at", "ao"]).groupBy("operation_id").agg(F.array_sort(F.collect_list(F.struct("i", "dep"))).alias("d"))
    ops = ops.join(deps, "operation_id", "left")
    return ops.withColumn("dependencies", F.coalesce(F.transform("d", lambda x: x["dep"]), empty())).drop("d", "after")


def plan_counts(operations: DataFrame) -> DataFrame:
    """(kind, value, n): operations by verb and by object type, and those blocked."""
    g = operations.groupingSets([["operation"], ["object_type"]], "operation", "object_type").agg(F.count("*").alias("n"), F.grouping("operation").alias("g"))
    by = g.select(F.when(F.col("g") == 0, "operation").otherwise("object_type").alias("kind"), F.coalesce("operation", "object_type").alias("value"), "n")
    return by.unionByName(operations.filter("operation = 'ignore'").agg(F.count("*").alias("n")).select(F.lit("blocked").alias("kind"), F.lit(None).cast("string").alias("value"), "n"))

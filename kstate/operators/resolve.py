"""Concept candidates resolved against a catalog: exact tiers first, then a lexical shortlist.

The tiers are equi-joins on a key table. The shortlist takes the catalog as a stated set of entries in
blocks: each worker holds one block and takes a name's entries by their upper bound (letters in common, tokens in
common) until the rest can no longer be among the best, so the result is that of scoring every pair. Names and
texts typed more than once are scored once.
"""

from __future__ import annotations

import difflib
import json
import math
import re
from bisect import insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError, canonical_json
from kstate.functions.text import fold, label, label_tokens, path_key, path_title
from kstate.operators.normalize import repeated
from kstate.runtime import cut

THRESHOLD, LIMIT, MOST = 0.40, 5, 50
BLOCK = 20_000
#: Keys of a block whose matchers are kept at a time.
MATCHERS = 20_000
TIERS = ("source-anchor+name", "resource-uri+name", "alias-history-exact", "title-path-exact")
#: signals in the order they are reported
SIGNALS = ("source-anchor-overlap", "resource-uri-overlap", "alias-history-exact", "title-exact", "path-title-exact")
_TOKEN = re.compile(r"[^\W_]+")


def key_table(catalog: DataFrame) -> DataFrame:
    """(internal_id, kind, key): every label a concept goes by; kind is title, alias, title_history, path or path_history."""
    arr = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    named = lambda kind, c: F.transform(c, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("raw")))
    names = F.concat(named("title", F.array("title")), named("alias", arr("aliases")), named("title_history", arr("title_history")))
    paths = F.concat(named("path", F.array("canonical_path")), named("path_history", arr("path_history")))
    n = catalog.select("internal_id", F.explode(names).alias("x")).select("internal_id", "x.kind", label(F.col("x.raw")).alias("key"))
    p = catalog.select("internal_id", F.explode(paths).alias("x")).select("internal_id", "x.kind", path_title(F.col("x.raw")).alias("key"))
    return n.unionByName(p).filter("key is not null").distinct()


def catalog_faults(catalog: DataFrame) -> DataFrame:
    """Catalog rows that break a rule: unsafe or repeated id, blank title, unsafe or shared path, repeated list members."""
    c = catalog.withColumn("pk", path_key(F.col("canonical_path")))
    lists = ("aliases", "title_history", "path_history", "resource_uris", "source_anchors")
    uneven = F.lit(False)
    for k in lists:
        uneven = uneven | (F.size(F.array_distinct(k)) < F.size(k))
    own = F.when(~F.coalesce(F.col("internal_id").rlike(r"^[^\x00-\x1F\x7F]{1,200}$"), F.lit(False)), "internal_id").when(F.trim(F.coalesce("title", F.lit(""))) == "", "title").when(F.col("pk").isNull(), "canonical_path").when(uneven, "list")
    single = c.select("internal_id", own.alias("fault")).filter("fault is not null")
    twice = repeated(c, ["internal_id"]).select("internal_id", F.lit("repeated id").alias("fault"))
    shared = c.join(repeated(c.filter("pk is not null"), ["pk"]).select("pk"), "pk", "left_semi").select("internal_id", F.lit("shared path").alias("fault"))
    return single.unionByName(twice).unionByName(shared)


def resource_bases(anchors: Column) -> Column:
    """What stands before the # of each anchor that has one."""
    return F.array_distinct(F.transform(F.filter(anchors, lambda a: F.instr(a, "#") > 0), lambda a: F.substring_index(a, "#", 1)))


def name_matches(candidates: DataFrame, keys: DataFrame) -> DataFrame:
    """(candidate_no, internal_id, kinds): concepts one of whose keys is the candidate's name."""
    c = candidates.select("candidate_no", label(F.col("name")).alias("key")).filter("key <> ''")
    return c.join(keys, "key").groupBy("candidate_no", "internal_id").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))


def ladder_pairs(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """(candidate_no, internal_id, tier): what each tier of the ladder matches, tiers numbered from 1."""
    m = name_matches(candidates, key_table(catalog))
    m = m.join(candidates.select("candidate_no", "evidence_anchors"), "candidate_no").join(catalog.select("internal_id", "source_anchors", "resource_uris"), "internal_id")
    has = lambda *kinds: F.arrays_overlap("kinds", F.array(*map(F.lit, kinds)))
    alias = has("alias", "title_history")
    tiers = F.array(
        F.when(F.arrays_overlap("evidence_anchors", "source_anchors"), 1), F.when(F.arrays_overlap(resource_bases(F.col("evidence_anchors")), "resource_uris"), 2),
        F.when(alias, 3), F.when(~alias & has("title", "path", "path_history"), 4),
    )
    return m.select("candidate_no", "internal_id", F.explode(F.filter(tiers, lambda t: t.isNotNull())).alias("tier"))


def match_ladder(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """(candidate_no, method, considered): the first tier with a match decides; more than one concept there is ambiguous."""
    p = ladder_pairs(candidates, catalog)
    g = p.groupBy("candidate_no", "tier").agg(F.sort_array(F.collect_set("internal_id")).alias("considered"))
    best = g.groupBy("candidate_no").agg(F.min(F.struct("tier", "considered")).alias("b"))
    return best.select("candidate_no", F.element_at(F.array(*map(F.lit, TIERS)), F.col("b.tier")).alias("method"), F.col("b.considered").alias("considered"))


def signals(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """(candidate_no, internal_id, signals): all pairs with a deterministic signal, signals in their order."""
    anchors = candidates.select("candidate_no", F.explode("evidence_anchors").alias("a"))
    cat = catalog.select("internal_id", "source_anchors", "resource_uris")
    by_anchor = anchors.join(cat.select("internal_id", F.explode("source_anchors").alias("a")), "a").select("candidate_no", "internal_id", F.lit(0).alias("s"))
    bases = candidates.select("candidate_no", F.explode(resource_bases(F.col("evidence_anchors"))).alias("a"))
    by_base = bases.join(cat.select("internal_id", F.explode("resource_uris").alias("a")), "a").select("candidate_no", "internal_id", F.lit(1).alias("s"))
    c = candidates.select("candidate_no", label(F.col("name")).alias("key")).filter("key <> ''")
    rank = F.when(F.col("kind").isin("alias", "title_history"), 2).when(F.col("kind") == "title", 3).otherwise(4)
    by_name = c.join(key_table(catalog), "key").select("candidate_no", "internal_id", rank.alias("s"))
    g = by_anchor.unionByName(by_base).unionByName(by_name).groupBy("candidate_no", "internal_id").agg(F.sort_array(F.collect_set("s")).alias("s"))
    return g.select("candidate_no", "internal_id", F.transform("s", lambda i: F.element_at(F.array(*map(F.lit, SIGNALS)), i + 1)).alias("signals"))


def token_overlap(candidates: DataFrame, catalog: DataFrame, limit: int | None = None) -> DataFrame:
    """(candidate_no, internal_id, overlap): Jaccard of the token sets of pairs that share a token.

    A candidate's tokens are those of name and description, a concept's those of title, description, aliases and former
    titles. Counted against the catalog in blocks. With a limit, pairs that cannot be among a candidate's best ``limit``
    once overlaps are rounded to six places are left out; equal ones at the last place all stay.
    """
    a = candidates.select("candidate_no", F.array_join(label_tokens(F.concat_ws(" ", "name", "description")), " ").alias("t")).filter("t <> ''")
    text = F.concat_ws(" ", "title", "description", F.array_join("aliases", " "), F.array_join("title_history", " "))
    b = cut(catalog.select("internal_id", label_tokens(text).alias("t")).filter("size(t) > 0"))
    blocks = max(1, math.ceil(b.count() / BLOCK))
    out = None
    for k in range(blocks):
        rows = b.filter(F.pmod(F.xxhash64("internal_id"), F.lit(blocks)) == k).collect()
        part = a.mapInPandas(_overlaps(sorted((r.internal_id, list(r.t)) for r in rows), limit), "candidate_no long, internal_id string, overlap double")
        out = part if out is None else out.unionByName(part)
    return out


def _overlaps(data: list[tuple[str, list[str]]], limit: int | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, size = np.array([i for i, _ in data], dtype=object), np.array([len(t) for _, t in data], dtype=np.int64)
        where: dict[str, list[int]] = defaultdict(list)
        for n, (_, tokens) in enumerate(data):
            for t in tokens:
                where[t].append(n)
        holds = {t: np.array(x) for t, x in where.items()}
        for b in batches:
            numbers, found, values = [], [], []
            for c, text in zip(b["candidate_no"], b["t"]):
                own = text.split(" ")
                hit = [holds[t] for t in own if t in holds]
                if not hit:
                    continue
                shared = np.bincount(np.concatenate(hit), minlength=len(size))
                overlap = shared / (size + len(own) - shared)
                least = np.partition(overlap, -limit)[-limit] - 1e-6 if limit is not None and limit < len(size) else 0.0
                at = np.flatnonzero((shared > 0) & (overlap >= least))
                numbers.append(np.full(len(at), c))
                found.append(ids[at])
                values.append(overlap[at])
            if numbers:
                yield pd.DataFrame({"candidate_no": np.concatenate(numbers), "internal_id": np.concatenate(found), "overlap": np.concatenate(values)})

    return run


class ShortlistBlock:
    """A bounded block of catalog concepts, scored against any name and text."""

    def __init__(self, rows: list[tuple[str, list[str], set[str]]]) -> None:
        self.rows = rows
        self.keys = [(i, k) for i, (_, keys, _) in enumerate(rows) for k in keys]
        self.first = np.unique(np.array([i for i, _ in self.keys], dtype=np.int64), return_index=True)[1]
        self.length = np.array([len(k) for _, k in self.keys], dtype=np.float64)
        self.letters = np.zeros((len(self.keys), 64), dtype=np.int16)
        for n, (_, k) in enumerate(self.keys):
            for c, m in Counter(k).items():
                self.letters[n, ord(c) % 64] += m
        self.size = np.array([len(t) for _, _, t in rows], dtype=np.float64)
        self.holds: dict[str, list[int]] = defaultdict(list)
        for i, (_, _, tokens) in enumerate(rows):
            for t in tokens:
                self.holds[t].append(i)
        self.where = {r[0]: i for i, r in enumerate(rows)}
        self.matcher = lru_cache(MATCHERS)(lambda k: difflib.SequenceMatcher(None, "", k))

    def scores(self, name: str, text: str, must: list[str], threshold: float, limit: int) -> list[tuple[str, float]]:
        """The best ``limit`` entries at or above the threshold or named in ``must``."""
        own = {t for t in _TOKEN.findall(fold(text)) if len(t) > 1}
        shared = np.zeros(len(self.rows))
        for t in own:
            shared[self.holds.get(t, [])] += 1
        total = self.size + len(own) - shared
        overlap = np.divide(shared, total, out=np.zeros_like(shared), where=total > 0)
        mine = np.zeros(64, dtype=np.int16)
        for c, m in Counter(name).items():
            mine[ord(c) % 64] += m
        both = self.length + len(name)
        shares = np.divide(2.0 * np.minimum(self.letters, mine).sum(axis=1, dtype=np.int32), both, out=np.ones_like(both), where=both > 0)
        # the keys of an entry stand together, and each has one at least
        bound = np.maximum.reduceat(shares, self.first)
        # the best first by what they can reach at most; once ``limit`` are surely better than the rest, the rest need no ratio
        most = 0.55 * bound + 0.45 * overlap
        named = {self.where[m] for m in must if m in self.where}
        found: list[tuple[float, str]] = []
        at = np.flatnonzero(most >= threshold - 1e-6)
        for i in [*named, *(k for k in at[np.argsort(-most[at], kind="stable")].tolist() if k not in named)]:
            if i not in named and len(found) >= limit and most[i] < -found[limit - 1][0] - 2e-6:
                break
            s = round(0.55 * self.ratio(name, i) + 0.45 * float(overlap[i]), 6)
            if s >= threshold or i in named:
                insort(found, (-s, self.rows[i][0]))
        return [(ident, -s) for s, ident in found[:limit]]

    def ratio(self, name: str, i: int) -> float:
        """Best ratio of the name with a key of entry i; keys keep what the matcher works out about them."""
        best = 0.0
        for k in self.rows[i][1]:
            m = self.matcher(k)
            m.set_seq1(name)
            if m.real_quick_ratio() > best and m.quick_ratio() > best:
                best = max(best, m.ratio())
        return best


def shortlist(candidates: DataFrame, catalog: DataFrame, threshold: float = THRESHOLD, limit: int = LIMIT) -> DataFrame:
    """(candidate_no, internal_id, similarity, signals, rank): the best ``limit`` concepts at or above the threshold or with a signal."""
    if not 0 <= threshold <= 1 or not 1 <= limit <= MOST:
        raise KStateError("threshold must lie in [0, 1] and the limit in [1, 50]")
    sig = signals(candidates, catalog)
    must = sig.groupBy("candidate_no").agg(F.collect_set("internal_id").alias("must"))
    c = candidates.join(must, "candidate_no", "left").select("candidate_no", label(F.coalesce("name", F.lit(""))).alias("name"), F.concat(F.coalesce("name", F.lit("")), F.lit(" "), F.coalesce("description", F.lit(""))).alias("text"), F.sort_array(F.coalesce("must", F.array().cast("array<string>"))).alias("must"))
    # equal rows are scored once, spread evenly: a few bytes are much work (see _scorer)
    said = F.xxhash64("name", "text", "must")
    c = cut(c.withColumn("said", F.md5(F.to_json(F.struct("name", "text", "must")))))
    one = c.groupBy("said").agg(F.first("name").alias("name"), F.first("text").alias("text"), F.first("must").alias("must"))
    one = one.repartition(int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")), said)
    keys = key_table(catalog).groupBy("internal_id").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    text = F.concat_ws(" ", "title", "description", F.array_join("aliases", " "), F.array_join("title_history", " "))
    entries = catalog.join(keys, "internal_id").select("internal_id", "keys", text.alias("text"))
    blocks = max(1, math.ceil(entries.count() / BLOCK))
    out = None
    for k in range(blocks):
        rows = entries.filter(F.pmod(F.xxhash64("internal_id"), F.lit(blocks)) == k).collect()
        data = sorted((r.internal_id, list(r["keys"]), {t for t in _TOKEN.findall(fold(r.text)) if len(t) > 1}) for r in rows)
        part = one.mapInPandas(_scorer(data, threshold, limit), "said string, internal_id string, similarity double")
        out = part if out is None else out.unionByName(part)
    out = c.select("candidate_no", "said").join(out, "said").drop("said")
    out = out.join(sig, ["candidate_no", "internal_id"], "left").withColumn("signals", F.coalesce("signals", F.array().cast("array<string>")))
    w = Window.partitionBy("candidate_no").orderBy(F.desc("similarity"), "internal_id")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def _scorer(data: list, threshold: float, limit: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = ShortlistBlock(data)
        for b in batches:
            rows = [(n, i, s) for n, name, text, must in zip(b["said"], b["name"], b["text"], b["must"]) for i, s in block.scores(name, text, list(must), threshold, limit)]
            yield pd.DataFrame(rows, columns=["said", "internal_id", "similarity"])

    return run


def resolve(candidates: DataFrame, catalog: DataFrame, threshold: float = THRESHOLD, limit: int = LIMIT, adjudicator=None) -> DataFrame:  # noqa: ANN001
    """(candidate_no, status, method, resolved_internal_id, considered_internal_ids, signals) of every concept candidate.

    matched: one concept at the deciding tier. new: nothing considered. ambiguous: all else, unless the
    adjudicator, asked with the ids considered, decides.
    """
    exact = match_ladder(candidates, catalog)
    short = shortlist(candidates, catalog, threshold, limit)
    near = short.groupBy("candidate_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "internal_id"))), lambda x: x["internal_id"]).alias("near"),
        F.array_sort(F.collect_list(F.struct("rank", "internal_id", "similarity", "signals"))).alias("signals"),
    )
    r = candidates.join(exact, "candidate_no", "left").join(near, "candidate_no", "left")
    one = F.size("considered") == 1
    none = F.array().cast("array<string>")
    considered = F.sort_array(F.array_distinct(F.coalesce("considered", "near", none)))
    r = r.withColumn("resolved_internal_id", F.when(one, F.get("considered", F.lit(0)))).withColumn("considered_internal_ids", F.when(F.coalesce(one, F.lit(False)), none).otherwise(considered))
    r = r.withColumn("status", F.when(F.col("resolved_internal_id").isNotNull(), "matched").when(F.size("considered_internal_ids") == 0, "new").otherwise("ambiguous"))
    r = r.withColumn("method", F.coalesce("method", F.when(F.col("status") == "new", "no-catalog-candidate").otherwise("similarity-shortlist")))
    if adjudicator is not None:
        r = adjudicate(r, adjudicator)
    return r.select("candidate_no", "status", "method", "resolved_internal_id", "considered_internal_ids", "signals")


class ModelAdjudicator:
    """Asks a model, through anything that answers requests (see synthesize), which of the concepts considered is meant."""

    INSTRUCTIONS = "Say which of the concepts considered the candidate is: match with its id, new if it is none of them, ambiguous if that cannot be told."

    def __init__(self, provider, model: str, max_output_tokens: int = 1200) -> None:  # noqa: ANN001
        self.provider, self.model, self.tokens = provider, model, max_output_tokens
        self.name = provider.name

    def decide(self, question: dict) -> tuple[str, str | None]:
        ident = {"type": ["string", "null"], "enum": [*question["considered"], None]}
        fields = {"decision": {"type": "string", "enum": ["match", "new", "ambiguous"]}, "internal_id": ident, "reason": {"type": "string"}}
        schema = {"type": "object", "additionalProperties": False, "required": list(fields), "properties": fields}
        asked = {"model": self.model, "instructions": self.INSTRUCTIONS, "input": canonical_json(question), "max_output_tokens": self.tokens, "schema": canonical_json(schema)}
        try:
            answer = json.loads(self.provider.generate(asked))
        except ValueError as e:
            raise KStateError(f"the adjudicator's answer is no JSON: {e}") from e
        if not isinstance(answer, dict) or set(answer) != set(fields):
            raise KStateError("the adjudicator's answer has other fields")
        return answer["decision"], answer["internal_id"]


def adjudicate(resolutions: DataFrame, adjudicator) -> DataFrame:  # noqa: ANN001
    """Asks the adjudicator about ambiguous rows; it answers (match, id), (new, None) or (ambiguous, None) within the ids considered."""
    fields = [f for f in resolutions.schema.fieldNames()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = b.to_dict("records")
            for r in rows:
                if r["status"] != "ambiguous":
                    continue
                ids = list(r["considered_internal_ids"])
                decision, ident = adjudicator.decide({"name": r["name"], "description": r["description"], "considered": ids})
                if decision not in ("match", "new", "ambiguous") or (decision == "match") != (ident in ids):
                    raise KStateError(f"adjudicator answered {decision!r}, {ident!r}")
                if decision != "ambiguous":
                    r["status"], r["method"], r["resolved_internal_id"] = ("matched" if decision == "match" else "new"), "adjudicated", ident
            yield pd.DataFrame(rows, columns=fields)

    return resolutions.mapInPandas(run, resolutions.schema)


def resolution_counts(resolutions: DataFrame) -> DataFrame:
    """(status, n), also for a status no row has."""
    each = resolutions.sparkSession.createDataFrame([(s,) for s in ("matched", "new", "ambiguous")], "status string")
    return each.join(resolutions.groupBy("status").agg(F.count("*").alias("n")), "status", "left").na.fill(0, ["n"])



"""Batches of units, requests to a provider, and candidates from its answers."""

from __future__ import annotations

import json
import os
import re
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError, canonical_json, json_object, json_string, json_string_list
from kstate.operators.normalize import require
from kstate.runtime import cut

KINDS = {"summary": "s", "concept": "c", "claim": "q", "relation": "r"}
LISTS = {"summary": "summaries", "concept": "concepts", "claim": "claims", "relation": "relations"}
SHAPES: dict[str, dict[str, type]] = {
    "summaries": {"text": str}, "concepts": {"name": str, "description": str}, "claims": {"statement": str},
    "relations": {"subject_index": int, "predicate": str, "object_index": int},
}
INSTRUCTIONS = "List the summaries, concepts, claims and relations of these units. Cite the anchors of the units as evidence."
BATCH_SCHEMA = "run_id string, unit_no long, batch_id string"
ANSWER_SCHEMA = "run_id string, batch_id string, response string"
ANSWER_FIELDS = ["run_id", "batch_id", "response"]
#: characters of answers handed on at once
CHUNK = 4_000_000
CANDIDATE_SCHEMA = (
    "run_id string, batch_id string, candidate_type string, ordinal int, name string, description string, text string, statement string, "
    "subject_index int, predicate string, object_index int, evidence_anchors array<string>"
)


def ordered_batches(units: DataFrame, run: str = "run_id", order: str = "unit_no", size: str = "size", max_chars: str = "max_input_chars", max_units: str = "max_batch_units") -> DataFrame:
    """(run, unit, batch_id): units in order, a batch closed before the unit that would exceed a limit.

    The fold streams over the sorted rows of a run and keeps two numbers, so a run of any length fits; a
    unit longer than the limit stands alone in its batch.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, number, chars, count = None, 0, 0, 0
        for b in batches:
            out = []
            for r, s, mc, mu in zip(b["run"], b["size"], b["max_chars"], b["max_units"]):
                if r != at:
                    at, number, chars, count = r, 1, 0, 0
                if count and (count >= mu or chars + s > mc):
                    number, chars, count = number + 1, 0, 0
                chars += s
                count += 1
                out.append(f"b{number:04d}")
            yield pd.DataFrame({"run_id": b["run"], "unit_no": b["unit"], "batch_id": out})

    d = units.select(F.col(run).alias("run"), F.col(order).alias("unit"), F.coalesce(F.col(size), F.lit(0)).alias("size"), F.col(max_chars).alias("max_chars"), F.col(max_units).alias("max_units"))
    return d.repartition("run").sortWithinPartitions("run", "unit").mapInPandas(fold, BATCH_SCHEMA)


def unit_json(units: DataFrame) -> Column:
    """A unit as a provider reads it: canonical JSON of ten fields; fields the table lacks are null."""
    has = lambda c: F.col(c) if c in units.columns else F.lit(None).cast("string")
    body = {c: json_string(has(c)) for c in ("unit_id", "anchor_uri", "source_path", "kind", "text", "content_sha256")}
    body |= {c: F.coalesce(has(c), F.lit("null")) for c in ("data", "native_locator", "metadata")}
    return json_object(body | {"diagnostics": json_string_list(F.col("diagnostics")) if "diagnostics" in units.columns else F.lit("null")})


def envelope(units: Column) -> Column:
    """A batch as a provider reads it, around its units' JSON."""
    return json_object({"source_uri": json_string(F.col("source_uri")), "source_version_uri": json_string(F.col("source_version_uri")), "units": F.concat(F.lit("["), units, F.lit("]"))})


def rendered_batches(units: DataFrame) -> DataFrame:
    """(run_id, unit_no, batch_id) like ordered_batches, by the length of what is sent; a unit too long for a batch of its own is an error."""
    one = F.length(unit_json(units)) + 1
    d = units.withColumn("size", one).withColumn("max_input_chars", F.col("max_input_chars") - F.length(envelope(F.lit(""))) + 1)
    require(d.filter("size > max_input_chars").select("run_id", "unit_no", "size", "max_input_chars"), "a unit exceeds max_input_chars by itself")
    return ordered_batches(d)


def requests(units: DataFrame, model: str = "offline", max_output_tokens: int = 8000) -> DataFrame:
    """One request a batch: the batch's units as canonical JSON, in order. A batch is bounded by its limits.

    ``units`` has run_id, batch_id, unit_no, source_uri, source_version_uri and the fields of unit_json.
    """
    g = units.withColumn("u", unit_json(units)).groupBy("run_id", "batch_id", "source_uri", "source_version_uri")
    g = g.agg(F.array_sort(F.collect_list(F.struct("unit_no", "u", "anchor_uri"))).alias("all"))
    body = envelope(F.array_join(F.transform("all", lambda x: x["u"]), ","))
    return g.select(
        "run_id", "batch_id", F.lit(model).alias("model"), F.lit(INSTRUCTIONS).alias("instructions"), body.alias("input"), F.lit(max_output_tokens).alias("max_output_tokens"),
        F.lit(canonical_json(answer_schema())).alias("schema"), F.transform("all", lambda x: x["anchor_uri"]).alias("anchors"),
    )


def answer_schema() -> dict:
    """JSON schema of an answer: four lists of objects, each with its fields and evidence, nothing else."""
    text, number = {"type": "string"}, {"type": "integer"}
    types = {str: text, int: number}

    def closed(fields: dict) -> dict:
        return {"type": "object", "additionalProperties": False, "required": list(fields), "properties": fields}

    item = lambda shape: closed({f: types[t] for f, t in shape.items()} | {"evidence_anchors": {"type": "array", "items": text}})
    return closed({key: {"type": "array", "items": item(shape)} for key, shape in SHAPES.items()})


class Provider(Protocol):
    """Answers a request with the JSON of four lists: summaries, concepts, claims, relations."""

    name: str

    def generate(self, request: dict) -> str: ...


#: short forms and initials whose dot ends no sentence of the offline provider
_SHORT = r"(?<!\b[A-Z])(?<!\bDr)(?<!\bMr)(?<!\bMs)(?<!\bSt)(?<!\bNo)(?<!\bvs)(?<!\bMrs)(?<!\bFig)(?<!\bProf)"
#: a sentence of the offline provider: up to terminators before a blank, a full-width terminator, a blank line or the end
_SENTENCE = re.compile(rf"\S(?:.*?(?:{_SHORT}[.!?\u2026]+(?=\s|$)|[\u3002\uff01\uff1f]+)|.*?(?=\n\s*\n)|.*$)", re.S)


class ResponsesProvider:
    """A model behind a public responses endpoint, asked for JSON of a strict schema; nothing is stored there and nothing tried twice.

    ``opener`` takes (urllib request, timeout=seconds) and gives the response; by default urllib's.
    """

    name = "openai"

    def __init__(self, api_key: str | None = None, endpoint: str = "https://api.openai.com/v1/responses", timeout: float = 120, opener: Callable | None = None) -> None:
        self.api_key, self.endpoint, self.timeout, self.opener = api_key, endpoint, timeout, opener

    def generate(self, request: dict) -> str:
        key = self.api_key or os.environ.get("OPENAI_API_KEY")
        if not key:
            raise KStateError("the model needs an API key")
        shape = {"type": "json_schema", "name": "candidates", "schema": json.loads(request["schema"]), "strict": True}
        body = {k: request[k] for k in ("model", "instructions", "input")} | {"max_output_tokens": int(request["max_output_tokens"]), "store": False, "text": {"format": shape}}
        ask = urllib.request.Request(self.endpoint, canonical_json(body).encode(), {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}, method="POST")
        try:
            with (self.opener or urllib.request.urlopen)(ask, timeout=self.timeout) as got:
                answer = json.loads(got.read())
        except (OSError, ValueError) as e:
            raise KStateError(f"the model cannot be asked: {e}") from e
        if not isinstance(answer, dict) or answer.get("status") != "completed":
            raise KStateError(f"the answer is not complete: {answer.get('status') if isinstance(answer, dict) else answer}")
        parts = [p for item in answer.get("output") or [] if isinstance(item, dict) for p in item.get("content") or [] if isinstance(p, dict)]
        if refused := [p for p in parts if p.get("type") == "refusal"]:
            raise KStateError(f"the model refused: {refused[0].get('refusal')}")
        texts = [p["text"] for p in parts if p.get("type") == "output_text"]
        if len(texts) != 1:
            raise KStateError(f"the answer has {len(texts)} texts")
        return texts[0]


class OfflineProvider:
    """Deterministic answers from the text alone: names become concepts, sentences claims, neighbours relations.

    Each distinct name of a unit (a word of four or more signs that opens with A to Z) is a concept that has the unit's whole
    text as its description; each sentence, told by its terminators, is a claim.
    """

    name = "offline"

    def generate(self, request: dict) -> str:
        units = json.loads(request["input"])["units"]
        out: dict[str, list] = {k: [] for k in LISTS.values()}
        for u in units:
            text = (u["text"] or "").strip()
            if not text:
                continue
            for name in dict.fromkeys(re.findall(r"\b[A-Z]\w{3,}\b", text)):
                out["concepts"].append({"name": name, "description": text, "evidence_anchors": [u["anchor_uri"]]})
            for m in _SENTENCE.finditer(text):
                out["claims"].append({"statement": m[0].rstrip(), "evidence_anchors": [u["anchor_uri"]]})
        for k in range(1, len(out["concepts"])):
            e = sorted({*out["concepts"][k - 1]["evidence_anchors"], *out["concepts"][k]["evidence_anchors"]})
            out["relations"].append({"subject_index": k - 1, "predicate": "appears with", "object_index": k, "evidence_anchors": e})
        if units:
            out["summaries"].append({"text": f"{len(units)} units", "evidence_anchors": [units[0]["anchor_uri"]]})
        return canonical_json(out)


def call_provider(req: DataFrame, provider: Provider) -> DataFrame:
    """Answers of a provider, a batch at a time in the workers; an empty answer fails the run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, held = [], 0
            for r in b.to_dict("records"):
                answer = provider.generate(r)
                if not answer:
                    raise KStateError(f"no answer for {r['run_id']} {r['batch_id']}")
                rows.append((r["run_id"], r["batch_id"], answer))
                held += len(answer)
                if held > CHUNK:
                    yield pd.DataFrame(rows, columns=ANSWER_FIELDS)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=ANSWER_FIELDS)

    return req.mapInPandas(run, ANSWER_SCHEMA)


def parse_answers(answers: DataFrame) -> DataFrame:
    """Candidates of the answers, one row each, in order; answers with other keys or types fail."""
    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[f.split()[0] for f in CANDIDATE_SCHEMA.split(", ")])
        return out.astype({"subject_index": "Int32", "object_index": "Int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, held = [], 0
            for run_id, batch, answer in zip(b["run_id"], b["batch_id"], b["response"]):
                if held > CHUNK:
                    yield frame(rows)
                    rows, held = [], 0
                held += len(answer)
                try:
                    value = json.loads(answer)
                except ValueError as e:
                    raise KStateError(f"{batch}: the answer is no JSON") from e
                if not isinstance(value, dict) or set(value) != set(SHAPES):
                    raise KStateError(f"{batch}: the answer has other fields")
                for kind, key in LISTS.items():
                    for n, item in enumerate(value[key], 1):
                        shape = SHAPES[key]
                        if not isinstance(item, dict) or set(item) != {*shape, "evidence_anchors"}:
                            raise KStateError(f"{batch}: {kind} {n} has other fields")
                        for f, t in shape.items():
                            if type(item[f]) is not t or t is str and not item[f].strip():
                                raise KStateError(f"{batch}: {kind} {n} has a bad {f}")
                        rows.append((run_id, batch, kind, n, item.get("name"), item.get("description"), item.get("text"), item.get("statement"), item.get("subject_index"), item.get("predicate"), item.get("object_index"), list(item["evidence_anchors"])))
            yield frame(rows)

    return answers.mapInPandas(run, CANDIDATE_SCHEMA)


def assign_ids(candidates: DataFrame) -> DataFrame:
    """Adds candidate_id (batch, letter of the type, number) and, for relations, the ids of both ends."""
    letter = F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.col("candidate_type"))
    c = candidates.withColumn("candidate_id", F.format_string("%s-%s%04d", "batch_id", letter, "ordinal"))
    end = lambda index: F.when(F.col(index).isNotNull(), F.format_string("%s-c%04d", F.col("batch_id"), F.col(index) + 1))
    return c.withColumn("subject_candidate_id", end("subject_index")).withColumn("object_candidate_id", end("object_index"))


def ordinal_ids(candidates: DataFrame, order: str) -> DataFrame:
    """(run_id, <order>, candidate_id): ids from the order of candidates within run, batch and type."""
    letter = F.element_at(F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv]), F.col("candidate_type"))
    n = F.row_number().over(Window.partitionBy("run_id", "batch_id", "candidate_type").orderBy(order))
    return candidates.select("run_id", order, F.format_string("%s-%s%04d", "batch_id", letter, n).alias("candidate_id"))


def evidence_violations(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """(run_id, candidate_id, anchor, fault): evidence missing, repeated, or not among the ``known`` (run_id, anchor)."""
    c = candidates.select("run_id", "candidate_id", F.coalesce("evidence_anchors", F.array().cast("array<string>")).alias("e"))
    none = c.filter("size(e) = 0").select("run_id", "candidate_id", F.lit(None).cast("string").alias("anchor"), F.lit("none").alias("fault"))
    each = c.select("run_id", "candidate_id", F.explode("e").alias("anchor")).groupBy("run_id", "candidate_id", "anchor").agg(F.count("*").alias("n"))
    twice = each.filter("n > 1").select("run_id", "candidate_id", "anchor", F.lit("repeated").alias("fault"))
    unknown = each.join(known, ["run_id", "anchor"], "left_anti").select("run_id", "candidate_id", "anchor", F.lit("unknown").alias("fault"))
    return none.unionByName(twice).unionByName(unknown)


def relation_violations(relations: DataFrame, concepts: DataFrame) -> DataFrame:
    """Relations with an end that is no concept of the run."""
    ends = relations.select("run_id", "candidate_id", F.explode(F.array("subject_candidate_id", "object_candidate_id")).alias("end"))
    known = concepts.filter("candidate_type = 'concept'").select("run_id", F.col("candidate_id").alias("end"))
    return ends.join(known, ["run_id", "end"], "left_anti").select("run_id", "candidate_id", "end").distinct()


def candidate_counts(candidates: DataFrame) -> DataFrame:
    """(run_id, candidate_type, n) with a row for each type, also those a run has none of."""
    n = cut(candidates.groupBy("run_id", "candidate_type").agg(F.count("*").alias("n")))
    each = n.select("run_id").distinct().withColumn("candidate_type", F.explode(F.array(*map(F.lit, KINDS))))
    return each.join(n, ["run_id", "candidate_type"], "left").na.fill(0, ["n"])

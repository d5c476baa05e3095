import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError, canonical_json_text, canonical_value, digest
from kstate.functions.text import fold, label, label_tokens, name_ratio, path_key, path_title, slug
from kstate.operators import apply as A
from kstate.operators import normalize as N
from kstate.operators import plan as P
from kstate.operators import resolve as R
from kstate.operators import synthesize as S
from kstate.operators.graph import linked_groups

RAW = "source_id string, snapshot_id string, unit_id string, source_path string, kind string, text string, data string, native_locator string, metadata string, diagnostics array<string>"


def raw(*rows):
    return [("s", "sha256-a", u, p, k, t, "{}", json.dumps({"path": p, "n": n}), "{}", []) for u, p, k, t, n in rows]


def test_canonical_values():
    assert canonical_value({"é": ["å", 1.5, None]}) == {"é": ["å", 1.5, None]}
    for bad in (float("nan"), "\ud800", {"é": 1, "é": 2}):
        with pytest.raises(KStateError):
            canonical_value(bad)
    assert digest({"b": 1, "a": "é"}) == digest({"a": "é", "b": 1})


def test_text_functions(spark):
    df = spark.createDataFrame([(" Straße \n X ", "Concepts\\A-b_c.MD"), (None, "/abs"), ("", "a/../b")], "t string, p string")
    rows = df.select(label(F.col("t")).alias("l"), path_key(F.col("p")).alias("k"), path_title(F.col("p")).alias("pt"), slug(F.col("t")).alias("s"), label_tokens(F.col("t")).alias("tok")).collect()
    assert (rows[0].l, rows[0].k, rows[0].s, rows[0].tok) == ("strasse x", "concepts/a-b_c.md", "strasse-x", ["strasse"])
    assert rows[1].l is None and rows[1].k is None and rows[2].k is None and fold("ß") == "ss"
    assert name_ratio("abc", []) == 0 and name_ratio("abc", ["abd", "abc"]) == 1


def test_normalize(spark):
    df = spark.createDataFrame(raw(("u000001", "café.txt", "page", "  Café\r\nline\r", 1), ("u000002", "b.txt", "page", None, 2)), RAW)
    a, b = sorted(N.checked_normalize(df).collect(), key=lambda r: r.unit_id)
    assert a.text == "  Café\nline\n" and a.source_path == unicodedata.normalize("NFC", "café.txt") and b.text is None
    assert a.anchor_uri == f"kst-source:s@sha256-a#{a.anchor_id}" and a.anchor_id.startswith("a-sha256-")
    again = N.normalize(df.withColumn("unit_id", F.lit("u000009"))).filter("text is not null").first()
    assert again.anchor_id == a.anchor_id and again.content_sha256 == a.content_sha256


@pytest.mark.parametrize("rows", [
    raw(("u000001", "a", "p", "x", 1), ("u000001", "b", "p", "x", 2)),
    raw(("u000001", "a", "p", "x", 1), ("u000002", "a", "p", "y", 1)),
    raw(("u000001", "é", "p", "x", 1), ("u000002", "é", "p", "y", 2)),
    raw(("u000001", "../a", "p", "x", 1)),
])
def test_normalize_refuses(spark, rows):
    with pytest.raises(KStateError):
        N.checked_normalize(spark.createDataFrame(rows, RAW))


def test_json_column(spark):
    df = spark.createDataFrame([('{"b": 1.0, "a": "é"}',), (None,)], "t string")
    assert [r[0] for r in df.select(canonical_json_text("t")).collect()] == ['{"a":"\\u00e9","b":1.0}', None]


def test_batches(spark):
    rows = [("r", n, s, 100, 2) for n, s in enumerate([40, 40, 10, 95, 300, 1, None])]
    df = spark.createDataFrame(rows, "run_id string, unit_no long, size long, max_input_chars long, max_batch_units long")
    got = [r.batch_id for r in S.ordered_batches(df).orderBy("unit_no").collect()]
    assert got == ["b0001", "b0001", "b0002", "b0003", "b0004", "b0005", "b0005"]


def test_answers(spark):
    unit = spark.createDataFrame([("r", "b0001", 1, "u", "v", "x#1", "p", "page", 'Alpha "says"\nmore'), ("r", "b0001", 2, "u", "v", "x#2", "p", "page", "Beta too")], "run_id string, batch_id string, unit_no long, source_uri string, source_version_uri string, anchor_uri string, source_path string, kind string, text string")
    req = S.requests(unit)
    assert json.loads(req.first().input)["units"][0]["text"] == 'Alpha "says"\nmore'
    c = S.assign_ids(S.parse_answers(S.call_provider(req, S.OfflineProvider()))).collect()
    assert {r.candidate_id for r in c} == {"b0001-s0001", "b0001-c0001", "b0001-c0002", "b0001-q0001", "b0001-q0002", "b0001-r0001"}
    rel = next(r for r in c if r.candidate_type == "relation")
    assert (rel.subject_candidate_id, rel.object_candidate_id) == ("b0001-c0001", "b0001-c0002")
    for bad in ("[]", "{}", '{"summaries":[],"concepts":[{"name":" ","description":"x","evidence_anchors":[]}],"claims":[],"relations":[]}', '{"summaries":[],"concepts":[],"claims":[],"relations":[{"subject_index":true,"predicate":"x","object_index":0,"evidence_anchors":[]}]}'):
        with pytest.raises(Exception, match="b0001"):
            S.parse_answers(spark.createDataFrame([("r", "b0001", bad)], S.ANSWER_SCHEMA)).collect()
    c = spark.createDataFrame([("r", "c1", ["x#1", "x#1"]), ("r", "c2", []), ("r", "c3", ["y"])], "run_id string, candidate_id string, evidence_anchors array<string>")
    known = spark.createDataFrame([("r", "x#1")], "run_id string, anchor string")
    assert {(r.candidate_id, r.fault) for r in S.evidence_violations(c, known).collect()} == {("c1", "repeated"), ("c2", "none"), ("c3", "unknown")}


CATALOG = "internal_id string, title string, description string, canonical_path string, aliases array<string>, title_history array<string>, path_history array<string>, resource_uris array<string>, source_anchors array<string>, status string"
CAND = "candidate_no long, name string, description string, evidence_anchors array<string>"


def concept(i, title, path=None, aliases=(), uris=(), anchors=()):
    return (i, title, "d", path or f"concepts/{i}.md", list(aliases), [], [], list(uris), list(anchors), "active")


def test_resolve(spark):
    cat = spark.createDataFrame([
        concept("k1", "Alpha", anchors=["s@v#a"]), concept("k2", "Other", aliases=["Alpha"]), concept("k3", "Third", aliases=["Shared"]), concept("k4", "Fourth", aliases=["shared"]),
        concept("k5", "Distributed Cache"), concept("k6", "X", path="concepts/path-name.md", uris=["s@w"]),
    ], CATALOG)
    c = spark.createDataFrame([(1, "ALPHA", "d", ["s@v#a"]), (2, "Alpha", "d", []), (3, "Shared", "d", []), (4, "Distributed caching", "d", []), (5, "path name", "q", ["s@w#z"]), (6, "Zzzz", "nothing", []), (7, None, None, [])], CAND)
    got = {r.candidate_no: (r.status, r.method, r.resolved_internal_id) for r in R.resolve(c, cat).collect()}
    assert got[1] == ("matched", "source-anchor+name", "k1") and got[2] == ("matched", "alias-history-exact", "k2")
    assert got[3][:2] == ("ambiguous", "alias-history-exact") and got[4][:2] == ("ambiguous", "similarity-shortlist")
    assert got[5] == ("matched", "resource-uri+name", "k6") and got[6][:2] == ("new", "no-catalog-candidate")

    class First:
        def decide(self, request):
            return "match", request["considered"][0]

    assert {r.candidate_no: r.resolved_internal_id for r in R.resolve(c, cat, adjudicator=First()).collect()}[3] == "k3"


def test_shortlist_equals_scoring_all_pairs(spark):
    names = ["Cache layer", "Layered cache", "Queue", "Quick queue of tasks", "Ledger", "Ledge", "zz"]
    cat = spark.createDataFrame([concept(f"k{n}", x, aliases=[x[::-1]]) for n, x in enumerate(names)], CATALOG)
    cand = [(n, x.replace("e", "a", 1), f"about {x}", []) for n, x in enumerate(names)]
    want = set()
    for n, name, desc, _ in cand:
        for k, x in enumerate(names):
            a, b = ({t for t in fold(s).split() if len(t) > 1} for s in (f"{name} {desc}", f"{x} d {x[::-1]}"))
            s = round(0.55 * name_ratio(fold(name), [fold(x), fold(x[::-1]), fold(f"k{k}")]) + 0.45 * len(a & b) / len(a | b), 6)
            if s >= 0.3:
                want.add((n, f"k{k}", s))
    got = R.shortlist(spark.createDataFrame(cand, CAND), cat, threshold=0.3, limit=50).collect()
    assert {(r.candidate_no, r.internal_id, r.similarity) for r in got} == want


DECISION = "candidate_id string, action string, target_internal_ids array<string>, survivor_internal_id string, reason string"


def plan_of(spark, decisions=()):
    c = spark.createDataFrame([(1, "1", "New One", "d", ["a"]), (2, "2", "new  one", "D", ["b"]), (3, "3", "New one!", "e", []), (4, "4", "Seen", "f", ["c"]), (5, "5", "Unsure", "g", [])], "ordinal long, candidate_id string, name string, description string, evidence_anchors array<string>")
    r = spark.createDataFrame([("1", "new", None, []), ("2", "new", None, []), ("3", "new", None, []), ("4", "matched", "k1", []), ("5", "ambiguous", None, ["k1", "k2"])], "candidate_id string, status string, resolved_internal_id string, considered_internal_ids array<string>")
    d = spark.createDataFrame(list(decisions), DECISION)
    used = spark.createDataFrame([("concepts/k1.md",)], "path_key string")
    q = spark.createDataFrame([(1, "q1", "It holds", ["a"]), (2, "q2", "it  HOLDS", ["b"]), (3, "q3", "Known", ["c"]), (4, "q4", "Twice", []), (5, "q5", "Against", ["d"])], "ordinal long, candidate_id string, statement string, evidence_anchors array<string>")
    known = spark.createDataFrame([("c1", "known"), ("c2", "twice"), ("c3", "TWICE")], "internal_id string, statement string")
    rel = spark.createDataFrame([(1, "r1", "1", "links", "4", ["a"]), (2, "r2", "2", "Links", "4", ["b"]), (3, "r3", "1", "links", "5", [])], "ordinal long, candidate_id string, subject_candidate_id string, predicate string, object_candidate_id string, evidence_anchors array<string>")
    concepts = P.plan_concepts(c, r, d, used)
    none = spark.createDataFrame([], A.SCHEMAS["relation"])
    return P.number_operations([concepts, P.plan_claims(q, known, d), P.plan_relations(rel, concepts, none, d)])


def test_plan_and_apply(spark):
    d = [("q5", "supersede", ["c1"], None, "newer"), ("5", "merge", ["k1", "k2"], "k1", "same thing")]
    log = plan_of(spark, d).cache()
    ops = {r.candidate_id: r for r in log.collect()}
    assert [ops[k].operation for k in ("1", "2", "3", "4", "5")] == ["create", "merge", "create", "update", "merge"]
    assert [ops[k].operation for k in ("q1", "q2", "q3", "q4", "q5")] == ["create", "merge", "update", "ignore", "supersede"]
    assert [ops[k].operation for k in ("r1", "r2", "r3")] == ["create", "merge", "merge"]
    assert ops["2"].dependencies == ["op000001"] and ops["1"].operation_id == "op000001" and ops["r2"].dependencies[-1] == ops["r1"].operation_id
    assert ops["1"].proposed_canonical_path == "concepts/new-one.md" and ops["3"].proposed_canonical_path.startswith("concepts/new-one--")
    assert A.operation_faults(log).count() == 0
    cat = spark.createDataFrame([concept("k1", "Old"), concept("k2", "Two", aliases=["Zwei"])], CATALOG)
    claims = spark.createDataFrame([("c1", "known", ["x"], "active"), ("c2", "twice", [], "active"), ("c3", "TWICE", [], "active")], "internal_id string, statement string, evidence_anchors array<string>, status string")
    state, results = A.apply_operations(A.bootstrap(cat, claims, spark.createDataFrame([], A.SCHEMAS["relation"])), A.translate(log))
    c = {r.internal_id: r for r in state["concept"].collect()}
    assert c["k1"].title == "Unsure" and c["k1"].title_history == ["Old", "Seen"] and c["k1"].aliases == ["Zwei", "Two"] and c["k1"].path_history == ["concepts/k2.md"]
    assert c["k2"].merged_into == "k1" and len(c) == 4
    q = {r.internal_id: r for r in state["claim"].collect()}
    new = next(r for r in q.values() if r.statement == "Against")
    assert q["c1"].status == "superseded" and q["c1"].superseded_by == [new.internal_id] and new.supersedes == ["c1"] and q["c1"].evidence_anchors == ["x", "c"]
    assert {r.statement for r in q.values()} == {"it  HOLDS", "Known", "twice", "TWICE", "Against"}
    rel = state["relation"].collect()
    assert len(rel) == 1 and {r.object_internal_id for r in rel} == {"k1"}
    assert A.state_faults(state).count() == 0
    assert {r.internal_id for r in A.catalog_projection(state["concept"]).collect()} == set(c) - {"k2"}
    log_rows = A.events(log, results, "p1").collect()
    assert len(log_rows) == len(ops) and len({r.event_id for r in log_rows}) == len(ops)
    one = A.generation(state, A.events(log, results, "p1"), "p1", None)
    assert one == A.generation({k: v.repartition(3) for k, v in state.items()}, A.events(log, results, "p1"), "p1", None)
    assert A.replay_guard(one, "p1") and not A.replay_guard(one, "p2")
    with pytest.raises(KStateError):
        A.replay_guard(A.generation(state, A.events(log, results, "p2"), "p2", one), "p1")
    with pytest.raises(KStateError):
        A.stale_guard(cat, A.catalog_projection(state["concept"]))


def test_fold_rules():
    rows = [{"internal_id": i, "statement": i, "evidence_anchors": [], "status": "active", "merged_into": None, "contradicts": x, "contradicted_by": [], "supersedes": [], "superseded_by": []} for i, x in (("q1", []), ("q2", ["q1"]), ("q3", ["q2"]))]
    f = A.Fold("claim", rows)
    op = {"operation_id": "op1", "operation": "merge", "target_internal_ids": ["q1", "q2"], "survivor_internal_id": "q1", "payload": {"statement": "s"}, "evidence_anchors": ["e"]}
    assert f.apply(op) == ["q1"] and f.rows["q3"]["contradicts"] == ["q1"] and f.rows["q1"]["contradicts"] == []
    with pytest.raises(KStateError):
        f.apply(op)
    with pytest.raises(KStateError):
        A.Fold("summary", []).apply(op | {"operation": "update"})


def test_decision_faults(spark):
    d = [("1", "merge", ["k1"], None, "r"), ("9", "ignore", [], None, "r"), ("q", "contradict", ["zz"], None, "r"), ("q", "ignore", [], None, " ")]
    c = spark.createDataFrame([("1", "concept"), ("q", "claim")], "candidate_id string, candidate_type string")
    r = spark.createDataFrame([("1", "ambiguous", ["k1"])], "candidate_id string, status string, considered_internal_ids array<string>")
    claims = spark.createDataFrame([("c1",)], "internal_id string")
    got = {(x.candidate_id, x.fault) for x in P.decision_faults(spark.createDataFrame(d, DECISION), c, r, claims, claims.limit(0)).collect()}
    assert got == {("1", "merge needs two targets and a survivor among them"), ("9", "unknown candidate"), ("q", "decided twice"), ("q", "no reason"), ("q", "unknown target")}


def test_linked_groups(spark):
    links = spark.createDataFrame([(str(i), str(i + 1)) for i in range(10, 40)] + [("a", "b"), ("z", "z")], "a string, b string")
    got = {r.id: r.group for r in linked_groups(links).collect()}
    assert got["40"] == "10" and got["b"] == "a" and got["z"] == "z" and len(got) == 34
    assert linked_groups(links.limit(0)).count() == 0


def test_stream(spark, tmp_path):
    from kstate.streaming import incremental as I

    df = spark.createDataFrame(raw(("u000001", "a", "p", "é", 1), ("u000002", "a", "p", "y", 2), ("u000001", "a", "p", "é", 1)), RAW).withColumn("acquired_at", F.lit("2024-01-01").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    schema = RAW + ", acquired_at timestamp"
    I.append_to(I.normalize_stream(I.unit_stream(spark, str(tmp_path / "in"), schema)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["y", "é"]


def follow(links):
    """Where each id ends, link by link; a cycle ends at its smallest id."""
    out = {}
    for a in links:
        way = [a]
        while (b := links.get(way[-1])) and b not in way:
            way.append(b)
        out[a] = min(way[way.index(b):]) if b else way[-1]
    return out


def test_survivors(spark):
    import random

    from kstate.operators.apply import survivors

    assert survivors(spark.createDataFrame([], "a string, b string")).count() == 0
    rnd = random.Random(5)
    for n, most in ((40, 40), (60, 75)):
        names = [f"{rnd.random():.6f}" for _ in range(most)]
        links = {a: rnd.choice(names) for a in names[:n]} | {f"z{k:02d}": f"z{k - 1:02d}" for k in range(1, 18)} | {"self": "self"}
        got = {r.a: r.b for r in survivors(spark.createDataFrame(list(links.items()), "a string, b string")).collect()}
        assert got == follow(links)


def test_merge_lineage(spark, tmp_path):
    from kstate.plans.queries import merge_lineage

    rows = [("k5", "k3"), ("k3", "k7"), ("k7", None), ("k9", " K5 "), ("k1", "k2"), ("k2", "k1"), ("k0", "k2"), ("k4", "k4"), ("k6", "K6 "), ("k8", "gone"), ("ka", " ")]
    df = spark.createDataFrame([(a, "merged", b) for a, b in rows], "internal_id string, status string, merged_into string").withColumn("recorded_at", F.lit("2024-01-02").cast("timestamp"))
    old = spark.createDataFrame([("k7", "merged", "k1")], "internal_id string, status string, merged_into string").withColumn("recorded_at", F.lit("2024-01-01").cast("timestamp"))
    df.unionByName(old).unionByName(old).write.parquet(str(tmp_path / "concept.parquet"))
    got = {r.internal_id: r.survivor for r in merge_lineage(spark, str(tmp_path)).collect()}
    assert got == {"k5": "k7", "k3": "k7", "k9": "k7", "k1": "k1", "k2": "k1", "k0": "k1"}


def test_token_overlap_top(spark, tmp_path, monkeypatch):
    import random
    import re

    from kstate.plans.queries import token_overlap_top

    rnd = random.Random(3)
    words = [f"w{k}" for k in range(14)] + ["Straße", "a", "été"]
    some = lambda least, most: " ".join(rnd.choices(words, k=rnd.randint(least, most)))
    cat = [(f"k{n:02d}", some(1, 2), rnd.choice([None, some(2, 9)]), [some(1, 2) for _ in range(n % 3)], [some(1, 1) for _ in range(n % 2)]) for n in range(40)]
    cand = [(n, "concept", rnd.choice([None, "", some(1, 2)]), rnd.choice([None, some(3, 9)])) for n in range(60)] + [(60, "concept", "zz", "w3 w4 w5"), (61, "claim", "w1", "w2")]
    spark.createDataFrame(cand, "candidate_no long, candidate_type string, name string, description string").write.parquet(str(tmp_path / "candidate.parquet"))
    spark.createDataFrame(cat, "internal_id string, title string, description string, aliases array<string>, title_history array<string>").write.parquet(str(tmp_path / "catalog_concept.parquet"))
    tokens = lambda *x: {t for t in re.findall(r"[^\W_]+", fold(" ".join(y or "" for y in x))) if len(t) > 1}
    want, pairs = set(), set()
    for n, kind, *text in cand:
        a, scored = tokens(*text), []
        for i, title, desc, aliases, history in cat:
            b = tokens(title, desc, *aliases, *history)
            if kind == "concept" and a & b:
                scored.append((-round(len(a & b) / len(a | b), 6), i))
        want |= {(n, i, -s, k) for k, (s, i) in enumerate(sorted(scored)[:5], 1)}
        pairs |= {(n, i, -s) for s, i in scored}
    for block in (R.BLOCK, 9):
        monkeypatch.setattr(R, "BLOCK", block)
        assert {(r.candidate_no, r.internal_id, r.overlap, r["rank"]) for r in token_overlap_top(spark, str(tmp_path)).collect()} == want
    c, k = spark.read.parquet(str(tmp_path / "candidate.parquet")).filter("candidate_type = 'concept'"), spark.read.parquet(str(tmp_path / "catalog_concept.parquet"))
    assert {(r.candidate_no, r.internal_id, round(r.overlap, 6)) for r in R.token_overlap(c, k).collect()} == pairs


def test_offline_answers_are_whole(spark, monkeypatch):
    long = "Gamma " + "holds many a word " * 30 + "until Delta ends."
    text = f"Dr. Alpha meets Bravo. Then\nAlpha goes!\n\n{long} 本文は長い。終わり。"
    units = [("r", "b0001", n, "u", "v", f"x#{n}", "p", "page", t) for n, t in ((1, text), (2, None), (3, " "), (4, "no name"))]
    req = S.requests(spark.createDataFrame(units, "run_id string, batch_id string, unit_no long, source_uri string, source_version_uri string, anchor_uri string, source_path string, kind string, text string"))
    monkeypatch.setattr(S, "CHUNK", 10)
    c = S.assign_ids(S.parse_answers(S.call_provider(req, S.OfflineProvider()))).orderBy("ordinal").collect()
    of = lambda kind: [r for r in c if r.candidate_type == kind]
    assert [r.name for r in of("concept")] == ["Alpha", "Bravo", "Then", "Gamma", "Delta"] and {r.description for r in of("concept")} == {text}
    assert [r.statement for r in of("claim")] == ["Dr. Alpha meets Bravo.", "Then\nAlpha goes!", long, "本文は長い。", "終わり。", "no name"]
    assert [r.evidence_anchors for r in of("claim")] == [["x#1"]] * 5 + [["x#4"]] and len(of("relation")) == 4
    known = spark.createDataFrame([("r", f"x#{n}") for n in (1, 2, 3, 4)], "run_id string, anchor string")
    assert S.evidence_violations(spark.createDataFrame(c), known).count() == 0
    assert {(r.candidate_type, r.n) for r in S.candidate_counts(spark.createDataFrame(c)).collect()} == {("summary", 1), ("concept", 5), ("claim", 6), ("relation", 4)}


def test_stream_keeps_late_units(spark, tmp_path):
    from kstate.streaming import incremental as I

    def arrive(n, *rows):
        df = spark.createDataFrame(raw(*((u, "a", "p", t, k) for u, t, k, _ in rows)), RAW)
        at = F.create_map(*[F.lit(x) for u, _, _, day in rows for x in (u, day)])
        df.withColumn("acquired_at", at[F.col("unit_id")].cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in" / f"f={n}"))
        stream = I.unit_stream(spark, str(tmp_path / "in" / "*"), RAW + ", acquired_at timestamp")
        I.append_to(I.normalize_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        return sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert arrive(1, ("u000001", "one", 1, "2024-06-01"), ("u000002", "two", 2, "2024-06-30")) == ["one", "two"]
    assert arrive(2, ("u000003", "three", 3, "2024-07-30"), ("u000001", "one", 1, "2024-06-01")) == ["one", "three", "two"]
    assert arrive(3, ("u000004", "late", 4, "2023-01-01"), ("u000002", "two", 2, "2024-06-30"), ("u000005", "undated", 5, None)) == ["late", "one", "three", "two", "undated"]


def test_denials_have_their_own_targets(spark, tmp_path):
    from kstate.plans.queries import _decisions

    claims = [(f"k{n}", "merged" if n == 9 else "active", None, f"Claim {n} holds", []) for n in range(10)] + [("ka", "active", None, "claim 4  HOLDS", [])]
    spark.createDataFrame(claims, "internal_id string, status string, merged_into string, statement string, evidence_anchors array<string>").withColumn("recorded_at", F.lit("2024-01-01").cast("timestamp")).write.parquet(str(tmp_path / "claim.parquet"))
    cand = [(n, "claim", None, f"No rest {n}") for n in range(20)] + [(20, "claim", None, "No claim 7 holds"), (21, "claim", None, "No Claim 4 holds"), (22, "claim", None, "Yes"), (23, "concept", "tbd", None)]
    spark.createDataFrame(cand, "candidate_no long, candidate_type string, name string, statement string").write.parquet(str(tmp_path / "candidate.parquet"))
    got = {int(r.candidate_id): (r.action, list(r.target_internal_ids)) for r in _decisions(spark, str(tmp_path)).collect()}
    assert got.pop(23) == ("ignore", []) and got.pop(20) == ("contradict", ["k7"]) and got.pop(21) == ("contradict", ["k4"])
    assert sorted(got) == list(range(20)) and {t for _, ts in got.values() for t in ts} == {f"k{n}" for n in range(9)} | {"ka"}
    per = [sum(ts == [t] for _, ts in got.values()) for t in ("k0", "k8", "ka")]
    assert per == [2, 2, 2]

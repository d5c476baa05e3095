import json
import shutil

import pytest
from pyspark.sql import functions as F

from kstate import stages
from kstate.__main__ import parser, run
from kstate.functions.canon import KStateError
from kstate.operators import synthesize as S
from kstate.sources import files


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """A folder taken through all stages once."""
    top = tmp_path_factory.mktemp("work")
    src = top / "src"
    (src / "notes").mkdir(parents=True)
    (src / "a.md").write_text("Alpha meets Bravo. Charlie waits!\n")
    (src / "notes" / "b.txt").write_text("Alpha returns to Delta.")
    (src / "c.bin").write_bytes(b"\x00\xff\x00\x80")
    (src / "link").symlink_to("a.md")
    store = stages.Store(spark, top / "root")
    files.acquire("paper", str(src), store.root / "acquired")
    ident = stages.snapshot(store, "paper")["snapshot_id"]
    stages.extract(store, "paper", ident)
    stages.normalize(store, "paper", ident)
    run_id = stages.synthesize(store, "paper", ident, S.OfflineProvider())["run_id"]
    res = stages.resolve(store, "paper", ident, run_id)
    planned = stages.plan(store, "paper", ident, run_id, res["run_id"])
    who = ("paper", ident, run_id, res["run_id"], planned["run_id"])
    return store, who, stages.compile_state(store, *who)


def copied(made, tmp_path):
    store, who, generation = made
    shutil.copytree(store.root, tmp_path / "root", symlinks=True)
    return stages.Store(store.spark, tmp_path / "root"), who, generation


def test_all_stages(made):
    store, who, generation = made
    entries = {r.path: (r.entry_kind, r.format, r.route) for r in store.load("classify", *who[:2])[1]["entries"].collect()}
    assert entries["."] == ("directory", "directory", "directory") and entries["link"][0] == "symlink" and entries["a.md"] == ("file", "markdown", "markdown") and entries["c.bin"][1] == "binary"
    m, t = store.load("extract", *who[:2])
    units = [(r.unit_id, r.source_path, r.kind) for r in t["units"].orderBy("unit_id").collect()]
    assert [u[1] for u in units] == [".", "a.md", "c.bin", "link", "notes", "notes/b.txt"] and [u[0] for u in units] == [f"u{n:06d}" for n in range(1, 7)]
    assert m["unit_count"] == 6 and m["diagnostic_count"] == 3 and m["routes"]["markdown"] == 1
    state = stages.load_current(store)[1]
    assert {r.title for r in state["concept"].collect()} == {"Alpha", "Bravo", "Charlie", "Delta"} and generation["counts"]["claim:active"] == 3
    assert state["registry"].count() == sum(generation["counts"].values()) and state["events"].count() > 0


def test_stages_repeat_without_change(made):
    store, who, generation = made
    assert stages.snapshot(store, "paper")["snapshot_id"] == who[1]
    assert stages.extract(store, *who[:2]) == store.manifest("extract", *who[:2])
    assert stages.synthesize(store, *who[:2], S.OfflineProvider())["run_id"] == who[2]
    assert stages.plan(store, *who[:4])["run_id"] == who[4]
    assert stages.compile_state(store, *who) == generation
    assert run(parser().parse_args(["--root", str(store.root), "normalize", *who[:2]]), store.spark).startswith('{"identity":["paper"')


def test_run_ids_do_not_depend_on_partitions(made):
    store, who, _ = made
    try:
        store.spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert stages.resolve(store, *who[:3])["run_id"] == who[3]
        store.spark.conf.set("spark.sql.shuffle.partitions", "9")
        assert stages.plan(store, *who[:4])["run_id"] == who[4]
    finally:
        store.spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("stage,parts,table,reader", [
    ("snapshot", 2, "entries", lambda s, w: stages.classify(s, *w[:2])), ("extract", 2, "units", lambda s, w: stages.normalize(s, *w[:2])),
    ("normalize", 2, "units", lambda s, w: stages.synthesize(s, *w[:2], S.OfflineProvider())), ("synthesize", 3, "candidates", lambda s, w: stages.resolve(s, *w[:3])),
    ("resolve", 4, "resolutions", lambda s, w: stages.plan(s, *w[:4])), ("plan", 5, "operations", lambda s, w: stages.compile_state(s, *w)),
])
def test_changed_inputs_fail_the_next_stage(made, tmp_path, stage, parts, table, reader):
    store, who, _ = copied(made, tmp_path)
    place = store.folder(stage, *who[:parts]) / table
    t = store.spark.read.parquet(str(place))
    column = next(f.name for f in t.schema.fields if f.dataType.simpleString() == "string")
    t.withColumn(column, F.concat(F.coalesce(column, F.lit("")), F.lit("x"))).write.parquet(str(tmp_path / "other"))
    shutil.rmtree(place)
    (tmp_path / "other").rename(place)
    with pytest.raises(KStateError):
        reader(store, who)


def test_changed_snapshot_and_pointer(made, tmp_path):
    store, who, generation = copied(made, tmp_path)
    (store.folder("snapshot", *who[:2]) / "artifact" / "a.md").write_text("other")
    with pytest.raises(KStateError):
        stages.classify(store, *who[:2])
    files.write_pointer(store.root / "current.json", {"schema_version": 1, "generation_id": generation["generation_id"], "manifest": "x"})
    with pytest.raises(KStateError):
        stages.load_current(store)


def test_run_ids_follow_from_descriptors(made, tmp_path):
    store, who, _ = copied(made, tmp_path)
    path = store.folder("plan", *who) / "manifest.json"
    m = files.read_manifest(path)
    m["descriptor"]["slug_basis"] = "other"
    files.write_manifest(path, m)
    with pytest.raises(KStateError):
        stages.load_plan(store, *who)


def test_stale_and_replayed_plans(made, tmp_path):
    store, who, _ = copied(made, tmp_path)
    catalog, claims, relations = stages.current_projections(store, tmp_path / "now")
    (tmp_path / "more.md").write_text("Alpha leaves Zzyxq. Alpha returns to Delta.")
    files.acquire("more", str(tmp_path / "more.md"), store.root / "acquired")
    ident = stages.snapshot(store, "more")["snapshot_id"]
    assert stages.classify(store, "more", ident)["source"]["primary_format"] == "markdown"
    stages.extract(store, "more", ident)
    stages.normalize(store, "more", ident)
    base = ("more", ident, stages.synthesize(store, "more", ident, S.OfflineProvider())["run_id"])
    res = stages.resolve(store, *base, catalog)
    assert res["counts"] == {"matched": 1, "new": 1, "ambiguous": 1}
    stale = stages.plan(store, *base, res["run_id"], claims)
    with pytest.raises(KStateError):
        stages.compile_state(store, *base, res["run_id"], stale["run_id"])
    fresh = stages.plan(store, *base, res["run_id"], claims, relations)
    second = stages.compile_state(store, *base, res["run_id"], fresh["run_id"])
    assert second["descriptor"]["parent_generation_id"] == made[2]["generation_id"] and second["descriptor"]["applied_plan_run_ids"] == [who[4], fresh["run_id"]]
    assert second["counts"]["concept:active"] == 6 and second["counts"]["claim:active"] == 4
    with pytest.raises(KStateError):
        stages.compile_state(store, *who)


def test_limits_and_names(made, tmp_path):
    store, who, _ = made
    with pytest.raises(KStateError):
        stages.Limits(max_input_chars=1000)
    with pytest.raises(KStateError):
        store.folder("plan", "..", "x")
    with pytest.raises(KStateError):
        stages.optional(store.spark, tmp_path / "gone", "a string")
    (tmp_path / "big").mkdir()
    (tmp_path / "big" / "x.txt").write_text("long " * 400)
    other = stages.Store(store.spark, tmp_path / "root")
    files.acquire("big", str(tmp_path / "big"), other.root / "acquired")
    ident = stages.snapshot(other, "big")["snapshot_id"]
    stages.extract(other, "big", ident)
    stages.normalize(other, "big", ident)
    with pytest.raises(KStateError):
        stages.synthesize(other, "big", ident, S.OfflineProvider(), limits=stages.Limits(max_input_chars=1024))


class Answer:
    def __init__(self, body):
        self.body = body

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def read(self):
        return json.dumps(self.body).encode()


def test_responses_provider():
    asked = []

    def opener(body):
        return lambda request, timeout: asked.append(json.loads(request.data)) or Answer(body)

    req = {"model": "m", "instructions": "i", "input": "{}", "max_output_tokens": 300, "schema": json.dumps(S.answer_schema())}
    text = {"type": "output_text", "text": "{}"}
    ask = lambda body: S.ResponsesProvider("key", opener=opener(body)).generate(req)
    assert ask({"status": "completed", "output": [{"content": [text]}]}) == "{}"
    assert asked[0]["store"] is False and asked[0]["text"]["format"]["strict"] and set(asked[0]["text"]["format"]["schema"]["required"]) == {"summaries", "concepts", "claims", "relations"}
    for bad in ({"status": "incomplete"}, {"status": "completed", "output": [{"content": [{"type": "refusal", "refusal": "no"}]}]}, {"status": "completed", "output": [{"content": [text, text]}]}, []):
        with pytest.raises(KStateError):
            ask(bad)


def test_model_adjudicator(spark):
    from kstate.operators import resolve as R

    class Model:
        name = "fixture"

        def generate(self, request):
            ids = json.loads(request["input"])["considered"]
            return json.dumps({"decision": "match", "internal_id": max(ids), "reason": "r"})

    rows = [(1, "Shared", "d", "ambiguous", "alias-history-exact", None, ["k1", "k2"], None), (2, "Other", None, "new", "no-catalog-candidate", None, [], None)]
    schema = "candidate_no long, name string, description string, status string, method string, resolved_internal_id string, considered_internal_ids array<string>, signals array<string>"
    got = {r.candidate_no: (r.status, r.method, r.resolved_internal_id) for r in R.adjudicate(spark.createDataFrame(rows, schema), R.ModelAdjudicator(Model(), "m")).collect()}
    assert got == {1: ("matched", "adjudicated", "k2"), 2: ("new", "no-catalog-candidate", None)}
    for answer in ("no json", "{}"):
        with pytest.raises(KStateError):
            R.ModelAdjudicator(type("P", (), {"name": "p", "generate": lambda self, r, a=answer: a})(), "m").decide({"considered": ["k1"]})


def test_json_lines_in_parts(spark, tmp_path):
    df = spark.range(500).selectExpr("id AS n", "concat('x', id) AS t")
    files.write_json_lines(df.repartition(5), str(tmp_path / "rows"), ["n"], parts=True)
    parts = sorted((tmp_path / "rows").glob("part-*"))
    assert [json.loads(x)["n"] for p in parts for x in p.read_text().splitlines()] == list(range(500))
    assert files.read_json_lines(spark, str(tmp_path / "rows"), "n long, t string").count() == 500
    parts[0].write_text(parts[0].read_text() + "{")
    with pytest.raises(KStateError):
        files.read_json_lines(spark, str(tmp_path / "rows"), "n long, t string")

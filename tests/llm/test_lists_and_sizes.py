import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kstate.llm.canonical_match import NameIndex, distance, map_to_canonical, tokens
from kstate.llm.mixture import count_tokens, min_cost_flow, mix, route, shares
from kstate.llm.packing import best_fit, fill_in_turn, greedy, lower_bound, nnls, pack, place, plan, spread, total

ENTRIES = [("1", "Cobalt Quarantine Protocol", ["Taexgriaquaet", "CQPL96"], []), ("2", "Cobalt Protocol", [], ["Fiageinuth Vault"]), ("3", "Falcon Ledger", [], []), ("4", "Birch Monitor", [], []), ("5", "Copper Vault", None, None)]
NAMES = {
    "cobalt protocol": "2", "Protocol, Cobalt": "2", "the Cobált Protocols": "2", "Cobalt Quarantnie Protocol (draft)": "1", "CobaltQuarantineProtocol": "1", "cqpl 96": "1", "CQPL97": None,
    "Bitch monitor": "4", "Falc. Ledger": "3", "Copper vault - see notes": "5", "Copper Falcon Vault": None, "Taexgraiquaet": "1", "Fiageinuth/Vault": "2", "Copper": None, "???": None, "TBD": None, "": None, "Cobalt Ledger": None,
}


@pytest.mark.parametrize("name,want", NAMES.items())
def test_names(name, want):
    voc = {w for _, t, a, h in ENTRIES for f in (t, *(a or []), *(h or [])) for w, _ in tokens(f)}
    got = NameIndex(ENTRIES, voc).match(name)[0]
    assert got == ([want] if want else [])


def test_a_whole_key_wins_over_fillers():
    entries = [("A", "Payment", [], []), ("B", "Payment Service", [], []), ("C", "Policy", None, None)]
    voc = {w for _, t, _, _ in entries for w, _ in tokens(t)}
    for name, want in {"Payment Service": ["B"], "payment service (draft)": ["B"], "the Payment": ["A"], "Payment": ["A"], "Policy Craft": [], "Policy drafts": ["C"], "Policy remark": []}.items():
        assert NameIndex(entries, voc).match(name)[0] == want, name
    assert NameIndex(entries, voc, frozenset(["remark"])).match("Policy remark")[0] == ["C"]


def brute_distance(a, b):
    d = np.zeros((len(a) + 1, len(b) + 1), int)
    d[:, 0], d[0, :] = range(len(a) + 1), range(len(b) + 1)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[-1, -1]


def test_distance_equals_brute_force():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(7))) for _ in "ab")
        want = brute_distance(a, b)
        got = distance(a, b, 2)
        assert (got is None) == (want > 2) and (got is None or got[0] == want)


def test_map_to_canonical(spark):
    rows = [(1, "Cobalt Protocol"), (2, None), (3, "Birch Mnitor"), (1, "Cobalt Protocol"), (None, "x"), (4, "x" * 5000)]
    names = spark.createDataFrame(rows, "candidate_no long, candidate_name string").withColumn("internal_id", F.lit(0))
    ref = spark.createDataFrame(ENTRIES, "internal_id string, title string, aliases array<string>, title_history array<string>")
    got = {r.candidate_no: r.internal_id for r in map_to_canonical(names, ref).collect()}
    assert got == {1: "2", 2: "unmatched", 3: "4", 4: "unmatched"}
    assert {r.internal_id for r in map_to_canonical(names, ref.limit(0)).collect()} == {"unmatched"}


def test_nnls_on_known_systems():
    a = np.array([[1.0, 1, 0], [0, 1, 1], [1, 0, 1]])
    assert np.allclose(nnls(a, a @ np.array([1.0, 2, 3])), [1, 2, 3])
    assert (nnls(a, np.array([1.0, -5, 1])) >= 0).all()


@pytest.mark.parametrize("seed", range(12))
def test_plan_keeps_the_limits(seed):
    rng = random.Random(seed)
    capacity, limit = rng.choice([(50, 4), (1024, 10), (1600, 50), (10, 1)])
    h = Counter(min(capacity, int(rng.expovariate(4 / capacity))) for _ in range(rng.choice([1, 30, 3000])))
    sizes, counts = np.array(list(h)), np.array(list(h.values()))
    rows, bins, solved = plan(sizes, counts, capacity, limit)
    assert solved <= bins <= total(greedy(h, capacity, limit))
    load, number, seen = Counter(), Counter(), Counter()
    for size, lo, hi, first, wide in rows:
        for k in range(lo, hi):
            b = first + (k - lo) % wide
            load[b] += size
            number[b] += 1
            seen[size, k] += 1
    assert max(load.values()) <= capacity and max(number.values()) <= limit and set(seen.values()) == {1} and len(seen) == sum(h.values())
    assert set(number) == set(range(bins)) and lower_bound(list(h), list(h.values()), capacity, limit) <= bins


@pytest.mark.parametrize("way", [best_fit, lambda h, c, n: fill_in_turn(h, c, n, 0), lambda h, c, n: fill_in_turn(h, c, n, 7.5), lambda h, c, n: spread(h, c, n, 700)])
def test_greedy_ways_keep_the_limits(way):
    rng = random.Random(9)
    h = Counter(rng.choice([0, 100, 33, rng.randrange(101)]) for _ in range(900))
    got, seen = way(h, 100, 6), Counter()
    for own, n in got:
        assert n > 0 and sum(s * k for s, k in own.items()) <= 100 and sum(own.values()) <= 6
        for s, k in own.items():
            seen[s] += k * n
    assert seen == h


@pytest.mark.parametrize("n", [3000, 30_000, 300_000])
def test_least_squares_packs_most_at_every_size(n):
    rng = random.Random(4)
    h = Counter(min(8000, int(rng.lognormvariate(0, 1) * 1000)) for _ in range(n))
    _, bins, solved = plan(np.array(list(h)), np.array(list(h.values())), 8000, 16)
    least = lower_bound(list(h), list(h.values()), 8000, 16)
    assert 2 * solved > bins and bins <= 1.01 * least and bins <= total(greedy(h, 8000, 16))


def test_three_lengths_in_many_containers():
    h = {7000: 40_000, 6500: 300, 3000: 200_000}
    rows, bins, solved = plan(np.array(list(h)), np.array(list(h.values())), 20_000, 50)
    assert len(rows) < 50 and solved > 0 and bins <= 46_767


def test_one_length_in_many_plan_rows(spark):
    how = spark.range(100_000).selectExpr("'r' AS run", "5L AS size", "id AS lo", "id + 1 AS hi", "id * 3 AS first", "1L AS wide")
    got = place(spark.range(100_000).selectExpr("'r' AS run", "5L AS size", "id AS rank"), how)
    assert got.count() == 100_000 and got.filter("container <> 3 * rank").count() == 0


def test_pack(spark):
    items = [("x", n, s) for n, s in enumerate([10, 90, 95, 5, 250, None, 0, 100])] + [("x", 1, 90), ("y", 1, 3), (None, 9, 1), ("x", None, 1)]
    runs = [("r1", "x", 100, 3), ("r2", "x", 60, 2), ("r3", "z", 10, 1), ("r4", "y", None, 1), ("r5", "y", 0, 1), ("r1", "x", 100, 3)]
    got = pack(spark.createDataFrame(items, "bag string, item long, size long").withColumn("rank", F.lit(1)), spark.createDataFrame(runs, "run string, bag string, capacity long, slots long")).collect()
    assert {r.run for r in got} == {"r1", "r2"}
    for run, cap, slots in (("r1", 100, 3), ("r2", 60, 2)):
        own = [r for r in got if r.run == run]
        for c in {r.container for r in own}:
            inside = [r for r in own if r.container == c]
            assert sum(r.size for r in inside) <= cap and len(inside) <= slots
        for n, s in enumerate([10, 90, 95, 5, 250, 0, 0, 100]):
            p = sorted((r.start, r.size) for r in own if r["item"] == n)
            assert sum(x for _, x in p) == s and (len(p) > 1) == (s > cap)
            assert all(a + b == c for (a, b), (c, _) in zip(p, p[1:]))


def test_flow_prefers_cheap_arcs_and_fills():
    f = min_cost_flow([(0, 1, 5, 1), (0, 1, 5, 4), (0, 2, 3, 1), (1, 3, 7, 0), (2, 3, 9, 0), (3, 4, 8, 0)], 0, 4)
    assert sum(f[:3]) == 8 and f[0] == 5 and f[2] == 3 and f[1] == 0
    got = route({("a",): 10, ("a", "b"): 10}, {"a": 10, "b": 10}, {"a": 1, "b": 1})
    assert got == {(("a",), "a"): 10, (("a", "b"), "b"): 10}


def test_mix(spark):
    rng = random.Random(2)
    rows = [(n, rng.choice("abc"), " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randrange(1, 40)))) for n in range(400)]
    rows += [(400, "a", None), (401, None, "one"), (402, "z", "one two"), (403, "b", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("tokens", F.lit(0))
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 1), ("c", 0.1, 1), ("none", 0.1, 3)], "source string, target_share double, max_repeat int")
    m = mix(docs, targets)
    s = {r.source: r for r in shares(m, targets).collect()}
    assert s["none"].tokens == 0 and s["a"].most_uses <= 2 and s["b"].most_uses <= 1
    assert s["c"].tokens == pytest.approx(s["a"].tokens / 5, rel=0.15)
    assert sorted(m.collect()) == sorted(mix(docs.repartition(3), targets).collect())
    assert mix(docs.limit(0), targets).count() == 0
    with pytest.raises(ValueError):
        mix(docs, targets.union(spark.createDataFrame([("a", 0.6, 1)], targets.schema)))


def test_mix_reaches_its_quotas(spark):
    """Of disjoint sources each gives the smaller of its quota and all its tokens times max_repeat, to within a document a pattern."""
    rng = random.Random(8)
    rows = [(n, rng.choice("aaaabbc"), f"{n} " + " ".join(rng.choice(["one", "two", "three"]) for _ in range(rng.randrange(1, 30)))) for n in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.4, 2), ("c", 0.4, 2)], "source string, target_share double, max_repeat int")
    own = {r.source: r.t for r in count_tokens(docs, "text", ["source"]).groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    total, got = sum(own.values()), {r.source: r for r in shares(mix(docs, targets), targets).collect()}
    for source, share, repeat in (("a", 0.2, 1), ("b", 0.4, 2), ("c", 0.4, 2)):
        want = min(int(share * total), own[source] * repeat)
        assert abs(got[source].tokens - want) <= 60 and got[source].most_uses <= repeat
    assert sum(r.share for r in got.values()) == pytest.approx(1) and got["c"].gap < -0.05

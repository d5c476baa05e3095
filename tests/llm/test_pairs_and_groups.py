import random

import pytest
from pyspark.sql import functions as F

from kstate.llm.components import connected_components
from kstate.llm.merge_groups import merge_groups
from kstate.llm.near_duplicates import expand_pairs, near_duplicate_groups, near_duplicates

WORDS = [f"w{i}" for i in range(400)]


def brute(rows, t):
    out = set()
    for i, (ka, na, ta) in enumerate(rows):
        for kb, nb, tb in rows[i + 1 :]:
            a, b = set((ta or "").lower().split()), set((tb or "").lower().split())
            if ka == kb and a and b and ta is not None and tb is not None and len(a & b) >= t * len(a | b) - 1e-9:
                out.add((min(na, nb), max(na, nb)))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for n in range(300):
        if n % 3 or not rows:
            t = rng.sample(WORDS, 20)
        else:
            t = rows[rng.randrange(len(rows))][2].split()
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            rng.shuffle(t)
        rows.append(("ab"[n % 7 == 0], n, " ".join(t)))
    df = spark.createDataFrame(rows + rows[:5], "kind string, key long, text string").withColumn("band", F.lit(1)).withColumn("rep", F.lit(2))
    members, pairs = near_duplicates(df)
    got = {tuple(r) for r in expand_pairs(members, pairs).collect()}
    assert got == brute(rows, 0.6)
    groups = {r.key: r.group_id for r in near_duplicate_groups(members, pairs).collect()}
    assert len(groups) == 300 and all(groups[a] == groups[b] for a, b in got)


def test_near_duplicates_of_odd_rows(spark):
    rows = [("a", 1, None), ("a", 2, ""), ("a", 3, " .. "), (None, 4, "x y"), ("a", None, "x y"), ("a", 5, "X, y!"), ("a", 6, "y x"), ("b", 7, "x y"), ("a", 8, "long " * 5000 + "x y")]
    members, pairs = near_duplicates(spark.createDataFrame(rows, "kind string, key long, text string"))
    assert {tuple(r) for r in expand_pairs(members, pairs).collect()} == {(5, 6), (5, 8), (6, 8)}
    none = spark.createDataFrame([], "kind string, key long, text string")
    members, pairs = near_duplicates(none)
    assert expand_pairs(members, pairs).count() == 0


def test_copies_are_one_class(spark):
    rows = [("a", n, "one two three four five") for n in range(200)]
    members, pairs = near_duplicates(spark.createDataFrame(rows, "kind string, key long, text string"))
    assert pairs.count() == 0 and members.select("rep").distinct().count() == 1


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_equal_union_find(spark, shape):
    rng = random.Random(3)
    edges = {"chain": [(i, i + 1) for i in range(150)], "star": [(0, i) for i in range(1, 300)], "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(130)]}[shape]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    want = {x: find(x) for e in edges for x in e}
    df = spark.createDataFrame(edges + edges[:3] + [(None, 1), (2, None)], "src long, dst long").withColumn("node", F.lit("x"))
    assert {r.node: r.component for r in connected_components(df).collect()} == want


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0


def test_merge_groups(spark):
    rows = [
        ("concept", "A", " b "), ("concept", "b", None), ("concept", "c", "X"), ("concept", "d", "x"), ("concept", "e", "e"), ("concept", "f", ""),
        ("claim", "A", "c"), ("claim", "b", None), ("concept", "A", " b "), ("concept", None, "b"), ("concept", "g", "nowhere"),
    ]
    got = {tuple(r) for r in merge_groups(spark.createDataFrame(rows, "object_type string, internal_id string, merged_into string")).collect()}
    assert got == {("concept", "A", "A"), ("concept", "b", "A"), ("concept", "c", "c"), ("concept", "d", "c")}

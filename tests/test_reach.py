"""Masks and label reach against a walk in Python."""

import random

import pytest

from corvane.operators import graph as G


def walked(edges, own):
    after = {}
    for a, b in edges:
        if a is not None and b is not None:
            after.setdefault(a, set()).add(b)
    bits = {}
    for n, m in own:
        if n is not None:
            bits[n] = bits.get(n, 0) | m
    out = {}
    for start in {*after, *bits}:
        seen, todo, mask = {start}, [start], 0
        while todo:
            n = todo.pop()
            mask |= bits.get(n, 0)
            new = after.get(n, set()) - seen
            seen |= new
            todo += new
        if mask:
            out[start] = mask
    return out


def masks(spark, edges, own):
    got = G.reached_masks(spark.createDataFrame(edges, "source int, target int"), spark.createDataFrame(own, "node int, mask bigint")).collect()
    assert len(got) == len({r.node for r in got})
    return {r.node: r["mask"] for r in got}


def graphs():
    random.seed(6)
    chain = [(k, k + 1) for k in range(200)]
    yield "chain", chain, [(200, 1), (77, 2), (0, 4)]
    yield "ring", [*chain, (200, 0)], [(50, 1), (120, 8)]
    yield "ring with tails", [*((k, (k + 1) % 7) for k in range(7)), (100, 3), (101, 100), (5, 200), (200, 201)], [(201, 1), (6, 2), (101, 4)]
    yield "loops and nulls", [(1, 1), (2, None), (None, 3), (3, 4), (3, 4), (4, 3)], [(1, 1), (4, 2), (None, 4), (4, 2)]
    yield "nothing", [], []
    yield "labels without edges", [], [(5, 3)]
    for k in (1, 3):
        n = 60
        yield f"random {k}", [(random.randrange(n), random.randrange(n)) for _ in range(20 + 25 * k)], [(random.randrange(n), 1 << random.randrange(6)) for _ in range(6)]


@pytest.mark.parametrize(("edges", "own"), [g[1:] for g in graphs()], ids=[g[0] for g in graphs()])
def test_masks(spark, edges, own):
    assert masks(spark, edges, own) == walked(edges, own)


def test_label_reach(spark):
    entries = spark.createDataFrame([("call", "A", 1), ("option", "B", 4), ("protocol", "C", 9), ("call", "D", None)], "kind string, entry string, unit int")
    calls = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "source int, target int")
    references = spark.createDataFrame([(3, "X"), (4, "Y"), (4, "Z"), (4, "Y")], "unit int, store string")
    stores = spark.createDataFrame([("X", "2"), ("Y", "80"), ("Y", "81"), ("Z", "5")], "store string, record string")
    labels = spark.createDataFrame([("2", "P"), ("80", "K"), ("81", "S"), ("5", "other")], "record string, label string")
    got = {r.entry: (r.labels, r.n_labels) for r in G.label_reach(entries, calls, references, stores, labels, ["P", "I", "K", "S"]).collect()}
    assert got == {"A": ("P,K,S", 3), "B": ("K,S", 2), "C": ("", 0), "D": ("", 0)}


def test_bounded_group_graph(spark):
    from corvane.operators.edges import bounded_group_graph

    groups = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "X"), ("d", "Y"), ("e", "Y"), (None, "Y"), ("f", None)], "node string, grp string")
    edges = [("a", "b"), ("a", "b"), ("c", "b"), ("b", "c"), ("a", "a"), ("d", "a"), ("e", "b"), ("d", "b"), ("b", "e"), ("b", "d"), ("c", "d"), ("f", "b"), ("z", "a"), ("a", None)]
    got = bounded_group_graph(spark.createDataFrame(edges, "source string, target string"), groups, 2).collect()
    assert sorted(tuple(r) for r in got) == sorted([
        ("X", "inside", "b", "c", 1), ("X", "inside", "c", "b", 1), ("X", "out", "b", "group:Y", 2), ("X", "out", "c", "group:Y", 1), ("X", "in", "group:Y", "b", 2),
        ("Y", "out", "d", "group:X", 2), ("Y", "out", "e", "group:X", 1), ("Y", "in", "group:X", "d", 2), ("Y", "in", "group:X", "e", 1),
    ])
    weighted = spark.createDataFrame([("a", "b", 5), ("a", "b", 2)], "source string, target string, w int")
    assert bounded_group_graph(weighted, groups, 3, "w").head().refs == 7


@pytest.mark.parametrize("a_row", [100_000, 3])
def test_reachable_from_many_starts(spark, monkeypatch, a_row):
    monkeypatch.setattr(G, "NODES_A_ROW", a_row)
    random.seed(7)
    edges = [(random.randrange(40), random.randrange(40)) for _ in range(70)] + [(3, None), (None, 4), (0, 0)] + [(5, k) for k in range(100, 120)]
    edges += edges[:9]
    starts = [*range(0, 40, 3), 5, 77]
    after = {}
    for a, b in edges:
        if a is not None:
            after.setdefault(a, set()).add(b)
    for depth in (0, 1, 2, 9):
        want = set()
        for s in starts:
            at = {s: 0}
            for k in range(1, depth + 1):
                for b in {b for n, d in at.items() if d == k - 1 for b in after.get(n, ())} - at.keys():
                    at[b] = k
            want |= {(s, n, d) for n, d in at.items()}
        found = G.reachable(spark.createDataFrame(edges, "source bigint, target bigint"), spark.createDataFrame([(s,) for s in [*starts, 5]], "node bigint"), depth)
        got = [tuple(r) for r in found.collect()]
        assert set(got) == want and len(got) == len(want)


def test_reachable_writes_no_pairs_of_its_last_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(G, "cut", lambda df: written.append(df.count()) or df.checkpoint())
    edges = spark.range(30_000).selectExpr("id % 300 as source", "1000 + id % 299 as target").union(spark.range(30_000).selectExpr("1000 + id % 299 as source", "5000 + id % 200 as target"))
    found = G.reachable(edges, spark.range(300).toDF("node"), 2)
    assert found.where("depth = 2").count() == 300 * 200
    assert sum(written) < 2 * edges.distinct().count()

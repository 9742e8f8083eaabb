"""Propagation in place against a loop over the nodes in order."""

import random

import pytest

from corvane.operators import graph as G


def looped(nodes, edges, labels, rounds=6):
    known = {k: v for k, v in labels if v is not None}
    out, into = {}, {t for _, t in edges}
    targets = {}
    for a, b in edges:
        targets.setdefault(a, []).append(b)
    for r in range(1, rounds + 1):
        new = 0
        for n in sorted(set(nodes), key=float):
            if n in known:
                continue
            if n not in targets and n not in into:
                known[n], out[n], new = "S", ("S", "H-39", "orphan: 0 ptrs in, 0 ptrs out", r), new + 1
                continue
            seen = [known[t] for t in targets.get(n, ()) if t in known]
            if len(seen) < 2:
                continue
            kinds, p, k = len(set(seen)), seen.count("P"), seen.count("K")
            found = ("P", "H-38", f"targets span {kinds} PIKS categories") if kinds >= 3 else ("P", "H-36", f"{p}/{len(seen)} targets classified P") if p / len(seen) > 0.7 else ("K", "H-40", f"{k} targets all classified K") if k == len(seen) else None
            if found:
                known[n], out[n], new = found[0], (*found, r), new + 1
        if not new:
            break
    return out


@pytest.mark.parametrize("seed", range(2))
def test_equals_a_sequential_loop(spark, seed):
    rng = random.Random(seed)
    n = 40
    ids = [f"{k}.5" if k % 3 == 0 else str(k) for k in range(1, n)]
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(110)] + [(ids[3], "unknown")]
    labels = [(i, rng.choice("PPKKIS")) for i in rng.sample(ids, 12)] + [(ids[0], None)]
    got = G.propagate_in_place(spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame(edges, "id string, target string"), spark.createDataFrame(labels, "id string, label string"), "P", "K", order="double").collect()
    assert {r.id: (r.label, r.method, r.evidence, r.round) for r in got} == looped(ids, edges, labels)


def test_a_line_is_done_in_one_round(spark):
    """Each node points to the two before it: one pass in order reaches the end, synchronous rounds do not."""
    edges = [(k, k - j) for k in range(3, 14) for j in (1, 2)]
    nodes, labels = spark.createDataFrame([(k,) for k in range(3, 14)], "id bigint"), spark.createDataFrame([(1, "K"), (2, "K")], "id bigint, label string")
    pointers = spark.createDataFrame(edges, "id bigint, target bigint")
    got = G.propagate_in_place(nodes, pointers, labels, "P", "K").collect()
    assert {r.id for r in got} == set(range(3, 14)) and {r.round for r in got} == {1}
    assert G.propagate(nodes, pointers, labels, "P", "K").where("method <> 'seed'").count() == 6
    assert G.propagate_in_place(nodes.limit(0), pointers, labels, "P", "K").count() == 0

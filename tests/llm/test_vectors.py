import numpy as np
import pytest

from corvane.llm import vectors as V
from corvane.llm.queries import op8_vectors


def brute(rows, threshold=0.9):
    """vec_id to (links, component) by comparing all pairs in double precision."""
    fine = {k: np.array(v, float) for k, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    unit = {k: v / np.linalg.norm(v) for k, v in fine.items()}
    links = {k: {j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= threshold} for k in unit}
    out = {}
    for k, _ in rows:
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[k] = (len(links.get(k, ())), min(seen))
    return out


def clustered(seed, n, dim, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 12, dim))
    return [(k, (centres[rng.integers(len(centres))] + spread * rng.normal(size=dim)).astype(np.float32).tolist()) for k in range(n)]


@pytest.mark.parametrize(("dim", "spread", "block"), [(2, 0.02, 1 << 20), (8, 0.25, 160), (32, 0.3, 32 * 25), (64, 0.28, 1 << 20)])
def test_links_equal_brute_force(spark, dim, spread, block):
    rows = clustered(dim, 360, dim, spread)
    rows += [(1000 + k, rows[5][1]) for k in range(7)] + [(2000, [2 * x for x in rows[9][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * dim), (3003, [None] + [1.0] * (dim - 1)), (3004, [float("nan")] * dim), (3005, [1.0] * (dim + 1)), (3006, [float("inf")] + [0.0] * (dim - 1))]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in V.vector_components(frame, block_values=block).collect()}
    assert got == brute(rows)


def brute_rows(rows, threshold=0.9):
    """(links, smallest id reached) of every row, whatever its id, all rows being vectors of their own."""
    unit = [np.array(v, float) / np.linalg.norm(v) for _, v in rows]
    near = [[j for j in range(len(rows)) if j != i and unit[i] @ unit[j] >= threshold - 1e-12] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        out.append((rows[i][0], len(near[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return sorted(out, key=str)


def test_repeated_and_null_ids(spark):
    plain = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0])]
    bridge = [(None, [1.0, 0.05, 0.0]), (8, [1.0, 0.0, 0.0]), (5, [1.0, 0.4, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.02, 1.0]), (3, [0.0, 1.0, 0.0]), (3, [0.7, -0.7, 0.1]), (7, [0.0, 1.0, 0.1]), (7, [0.0, 0.1, -1.0])]
    rng = np.random.default_rng(3)
    near = [(None if k % 4 == 0 else int(k % 9), (np.eye(6)[k % 3] + 0.18 * rng.normal(size=6)).tolist()) for k in range(60)]
    for rows in (plain, bridge, near):
        frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        got = V.vector_components(frame).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute_rows(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert V.vector_components(frame.limit(0)).count() == 0


def test_dense_clique_gives_a_row_each(spark):
    rng = np.random.default_rng(1)
    rows = [(k, (np.ones(16) + 0.05 * rng.normal(size=16)).tolist()) for k in range(400)]
    got = V.vector_components(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert {(r.n_links, r.component_id, r.kept == (r.vec_id == 0)) for r in got} == {(399, 0, True)}


def test_pivots_prune_where_vectors_cluster():
    x = V._unit(np.array([v for _, v in clustered(2, 1200, 3, 0.01)]))
    assert len(V.choose_pivots(x, 10**6, 0.45)) >= 8


def test_query(spark, sf):
    rows = {r.vec_id: (r.n_links, r.component_id) for r in op8_vectors(spark, sf).collect()}
    data = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert rows == brute(data)

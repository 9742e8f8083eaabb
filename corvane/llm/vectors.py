"""Embedding near-duplicates by an exact metric range join.

Vectors are scaled to length one, where a cosine of at least c is a distance of
at most r. Pivots cut them into cells of nearest pivot. By the triangle
inequality a vector that has a partner in another cell is at most 2 r farther
from that cell's pivot than from its own, so it is replicated to just those
cells; each pair of cells is served from one side. Cells join independently, in
blocks of bounded size: a projection on a few orthonormal directions never
lengthens a distance, so pairs that are too far apart there are dropped by a small
single-precision product with a margin, and the rest is checked in double
precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import connected_components, stored

THRESHOLD = 0.9
#: Rows that pivots are drawn from and the replication is estimated on: those with the smallest hashes.
SAMPLE_ROWS = 2048
PIVOT_CHOICES = (1, 8, 32, 128, 512)
#: Numbers in either side of a block of a cell: 16,384 rows of 64 dimensions.
BLOCK_VALUES = 1 << 20
#: Directions of largest spread in the sample that pairs are first compared in.
DIRECTIONS = 32
#: Above the error of a product in single precision.
MARGIN = 1e-4


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of an array column as rows."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), float)
    return flat.reshape(len(column), -1)


def _packed(values: np.ndarray, kind: str) -> pa.Array:
    """Rows as bytes, which pass through joins and shuffles without a step per number."""
    data = np.ascontiguousarray(values, kind)
    ends = np.arange(len(data) + 1, dtype=np.int32) * (data.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _unpacked(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(b"".join(c.to_pylist()), kind).reshape(len(c), -1) for c in column.chunks if len(c)]).astype(float)


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / big
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def is_usable(v: Column) -> Column:
    """Whether a vector has components, none of them null or non-finite and not all zero; null has none."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def choose_pivots(sample: np.ndarray, n_rows: int, radius: float) -> np.ndarray:
    """Pivots from the sample, as many as make the estimated work least.

    Work is the comparisons in cells plus what moving the replicas costs. Where
    distances are so alike that nearly all vectors go to all cells, few pivots
    win; the result is exact with any.
    """
    best, best_work = sample[:1], math.inf
    for k in PIVOT_CHOICES:
        if k * 2 > len(sample):
            break
        pivots = sample[:k]
        near = np.sqrt(np.maximum(0.0, 2 - 2 * sample @ pivots.T))
        home = near.argmin(axis=1)
        goes = near - near.min(axis=1, keepdims=True) <= 2 * radius
        visits = np.array([(goes[:, c] & (home < c)).sum() for c in range(k)]) / len(sample) * n_rows
        homes = np.bincount(home, minlength=k) / len(sample) * n_rows
        work = (homes * (homes / 2 + visits)).sum() + 2000 * visits.sum()
        if work < best_work:
            best, best_work = pivots, work
    return best


def directions(sample: np.ndarray, n: int = DIRECTIONS) -> np.ndarray:
    """Orthonormal columns along which the sample spreads most; any such columns give right results."""
    _, _, rows = np.linalg.svd(sample, full_matrices=False)
    return np.ascontiguousarray(rows[:n].T)


def _flat(root: np.ndarray) -> np.ndarray:
    while (up := root[root]) is not None and (up != root).any():
        root = up
    return root


def _join_roots(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots (smallest positions) after joining x[k] with y[k]; pairs that are joined already cost no loop."""
    root = _flat(root)
    pairs = np.unique(np.stack([np.minimum(root[x], root[y]), np.maximum(root[x], root[y])], 1), axis=0)
    for u, w in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
        while root[u] != u:
            u = root[u]
        while root[w] != w:
            w = root[w]
        root[max(u, w)] = min(u, w)
    return _flat(root)


def block_links(node: np.ndarray, copies: np.ndarray, unit: np.ndarray, left: np.ndarray, same: bool, threshold: float, basis: np.ndarray):
    """Links of the left rows with the others (``same``: among all rows): counted copies and smallest node reached, per row.

    ``node`` ascends, so the smallest position of a component is its smallest node.
    """
    a = np.arange(len(node)) if same else np.nonzero(left)[0]
    b = a if same else np.nonzero(~left)[0]
    shadow = unit @ basis
    half, one = np.square(shadow).sum(axis=1, keepdims=True) / 2, np.ones((len(unit), 1))
    # the product of these two is minus half the squared distance of the shadows
    here = np.hstack([shadow, -half, one]).astype(np.float32)
    there = np.ascontiguousarray(np.hstack([shadow, one, -half]).astype(np.float32)[b].T)
    counts, root = np.zeros(len(node), np.int64), np.arange(len(node))
    for s in range(0, len(a), 512):
        first = s if same else 0  # pairs of earlier rows are done
        i, j = np.divmod(np.flatnonzero((here[a[s : s + 512]] @ there[:, first:]).ravel() >= threshold - 1 - MARGIN), len(b) - first)
        i, j = a[s + i], b[first + j]
        if same:
            i, j = i[i < j], j[i < j]
        for p in range(0, len(i), 1 << 16):  # a dense cell has many pairs; they are checked piece by piece
            x, y = i[p : p + (1 << 16)], j[p : p + (1 << 16)]
            fine = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
            x, y = x[fine], y[fine]
            if len(x):
                counts += np.bincount(x, copies[y], len(node)).astype(np.int64) + np.bincount(y, copies[x], len(node)).astype(np.int64)
                root = _join_roots(root, x, y)
    return counts, node[root]


def linked(vectors: DataFrame, dim: int, element: str, threshold: float = THRESHOLD, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(node, n, root): partial results per block, from usable vectors (node, copies, v) of one dimension.

    n is the number of other vectors linked within a block, root the smallest
    node that a vector is joined to there; sums and components over all blocks
    are the whole answer. A group of k vectors close to each other gives k rows a
    block, not a row per pair.
    """
    spark = vectors.sparkSession
    radius = math.sqrt(2 - 2 * threshold) + 1e-9
    block_rows = max(1, block_values // dim)
    n_rows = vectors.count()
    drawn = vectors.orderBy(F.xxhash64("node"), "node").select("v").limit(SAMPLE_ROWS).collect()
    sample = _unit(np.array([r.v for r in drawn], float)) if drawn else np.eye(1, dim)
    kind = "<f4" if element == "float" else "<f8"
    pivots = spark.sparkContext.broadcast(choose_pivots(sample, n_rows, radius))
    basis = spark.sparkContext.broadcast(directions(sample))

    def placed(batches):
        """Each vector in its own cell, and in each later cell that may hold a partner."""
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _matrix(batch.column(2))
            near = np.sqrt(np.maximum(0.0, 2 - 2 * _unit(values) @ pivots.value.T))
            home = near.argmin(axis=1)
            goes = near - near.min(axis=1, keepdims=True) <= 2 * radius
            row, cell = np.nonzero(goes & (np.arange(near.shape[1])[None, :] > home[:, None]))
            take = np.concatenate([np.arange(len(home)), row])
            cells = np.concatenate([home, cell]).astype(np.int32)
            at_home = np.arange(len(take)) < len(home)
            for s in range(0, len(take), block_rows):
                part = take[s : s + block_rows]
                columns = [batch.column(k).take(pa.array(part)) for k in range(2)]
                columns += [_packed(values[part], kind), pa.array(cells[s : s + block_rows]), pa.array(at_home[s : s + block_rows])]
                yield pa.RecordBatch.from_arrays(columns, ["node", "copies", "v", "cell", "home"])

    spread = vectors.select("node", "copies", "v").mapInArrow(
        placed, "node bigint, copies bigint, v binary, cell int, home boolean"
    )
    sizes = spread.groupBy("cell").agg(
        F.ceil(F.count_if("home") / block_rows).cast("int").alias("h"), F.ceil(F.count_if(~F.col("home")) / block_rows).cast("int").alias("g")
    )
    # A cell's rows at home are cut into h pieces and its visitors into g; a block is a piece at home (s) with
    # another one (t >= s) or with a piece of visitors. The number of cells is bounded by the choice of pivots.
    piece = F.pmod(F.xxhash64("node"), F.when(F.col("home"), F.col("h")).otherwise(F.col("g"))).cast("int")
    among = F.transform(
        F.sequence(F.lit(0), F.col("h") - 1),
        lambda o: F.struct(F.least(F.col("piece"), o).alias("s"), F.greatest(F.col("piece"), o).alias("t"), (F.col("piece") <= o).alias("is_left"), F.lit(True).alias("own")),
    )
    hosts = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("g")), lambda o: o < F.col("g")),
        lambda o: F.struct(F.col("piece").alias("s"), o.alias("t"), F.lit(True).alias("is_left"), F.lit(False).alias("own")),
    )
    guests = F.transform(
        F.filter(F.sequence(F.lit(0), F.col("h")), lambda o: o < F.col("h")),
        lambda o: F.struct(o.alias("s"), F.col("piece").alias("t"), F.lit(False).alias("is_left"), F.lit(False).alias("own")),
    )
    meetings = (
        spread.join(F.broadcast(sizes), "cell")
        .withColumn("piece", piece)
        .withColumn("m", F.explode(F.when(F.col("home"), F.concat(among, hosts)).otherwise(guests)))
        .select("node", "copies", "v", "cell", "m.s", "m.t", "m.is_left", "m.own")
    )

    def compare(key, rows):
        rows = rows.sort_by("node")
        _, s, t, own = (k.as_py() for k in key)
        node, copies = np.asarray(rows.column("node")), np.asarray(rows.column("copies"))
        left = np.asarray(rows.column("is_left").to_pylist(), bool)
        counts, root = block_links(node, copies, _unit(_unpacked(rows.column("v"), kind)), left, own and s == t, threshold, basis.value)
        hit = np.nonzero(counts)[0]
        return pa.table({"node": node[hit], "n": counts[hit], "root": root[hit]})

    return meetings.groupBy("cell", "s", "t", "own").applyInArrow(compare, "node bigint, n bigint, root bigint")


def vector_components(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, block_values: int = BLOCK_VALUES
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Equal vectors form a class and are compared once; each links with the other
    members and, with all of them, to the classes linked to its own. Vectors that
    are null, empty, zero, or hold null or non-finite components link with
    nothing, and so do vectors of different dimensions. Every row is a vector of
    its own, also where ids repeat or are null: ids join nothing. component_id is
    the smallest id that is not null among the vectors reached; null if there is
    none.
    """
    kind = vectors.schema[embedding].dataType
    element = "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(f"array<{element}>").alias("v"))
    good = rows.where(is_usable(F.col("v")))
    # the hash spares sorting whole vectors; equality decides
    good = good.withColumn("h", F.xxhash64("v"))
    grouped = good.groupBy("h", "v").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first(F.size("v")).alias("dim"))
    # a class has a number of its own, as ids may be null or shared; it is stored, so it stays
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    dims = [r.dim for r in classes.select("dim").distinct().collect()]
    partial = None
    for dim in dims:
        part = linked(classes.where(F.col("dim") == dim), dim, element, threshold, block_values)
        partial = part if partial is None else partial.unionByName(part)
    if partial is None:
        partial = vectors.sparkSession.createDataFrame([], "node bigint, n bigint, root bigint")
    partial = stored(partial, "links")
    labels = connected_components(partial.select(F.col("node").alias("a"), F.col("root").alias("b")))
    summed = partial.groupBy("node").agg(F.sum("n").alias("n"))
    placed = stored(classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    named = placed.join(summed, "node", "left").join(lowest, "component").select(
        F.col("h").alias("class_h"), F.col("v").alias("class_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "component_id"
    )
    ok = good.join(named, (F.col("h") == F.col("class_h")) & (F.col("v") == F.col("class_v"))).select("vec_id", "n_links", "component_id")
    bad = rows.where(~is_usable(F.col("v"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return ok.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is cut into segments; the counts of set bits per segment are
a point on an integer grid. Changing a bit moves the point by one step, so the
Manhattan distance of two points is a lower bound of the Hamming distance of the
fingerprints. Points within distance 2 share a midpoint that is at most one step
from each. Both sides therefore go to their own cell and the cells one step away,
an equi-join on cells finds all candidates, and the exact distance decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import LOWER_ASCII, as_bytes, bounded_batches, connected_components, cut, free_names

SHINGLE = 3
SEED = 42
SEGMENTS = 16
MAX_DISTANCE = 2


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each word shingle of a lower-cased (A-Z) text, repeats included."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)


#: Row b: the eight bits of byte value b, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority_bits(hashes: np.ndarray) -> int:
    """The 64-bit number with a bit set where over half of ``hashes`` have it; zero for none."""
    n = len(hashes)
    if not n:
        return 0
    octets = hashes.astype("<u8", copy=False).view(np.uint8).reshape(n, 8)
    if n < 1024:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


@arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """The SimHash of each whole text as a signed 64-bit number. Null and wordless texts give zero."""
    prints = np.fromiter((majority_bits(shingle_hashes(t)) for t in as_bytes(texts)), np.uint64, len(texts))
    return pa.array(prints.view(np.int64))


def segment_popcounts(fp: str, segments: int = SEGMENTS) -> list[Column]:
    """Set bits in each segment of the fingerprint column."""
    width = 64 // segments
    mask = (1 << width) - 1
    return [
        F.bit_count(F.shiftrightunsigned(F.col(fp), k * width).bitwiseAND(F.lit(mask).cast("long"))).cast("long")
        for k in range(segments)
    ]


def close_fingerprints(prints: DataFrame, fp: str, node: str, segments: int = SEGMENTS) -> DataFrame:
    """Pairs (a, b) of ``node`` whose distinct fingerprints differ in one or two bits.

    ``prints`` has a row per distinct fingerprint. The cell of a point is its
    counts packed into one number with four bits (or more) a segment, so a step
    in a segment adds or takes a power of two. Offset zero is the point's own
    cell. A pair meets in its cells as follows, each once but for the last kind,
    twice: equal points in that point; points one step apart in the right one;
    points two steps apart in a cell next to both.
    """
    width = 64 // segments
    field = max(1, width.bit_length())
    if segments * field > 63:
        raise ValueError("the counts of so many segments don't fit into a long")
    counts = segment_popcounts(fp, segments)
    cell = sum((c * F.lit(1 << (k * field)) for k, c in enumerate(counts)), F.lit(0).cast("long"))
    steps = [F.lit(0).cast("long")]
    for k, c in enumerate(counts):
        one = F.lit(1 << (k * field)).cast("long")
        steps += [F.when(c < width, one), F.when(c > 0, -one)]
    spread = (
        prints.select(F.col(fp).alias("fp"), F.col(node).alias("node"), cell.alias("own"), F.array(*steps).alias("steps"))
        .select("fp", "node", "own", F.explode(F.filter("steps", lambda s: s.isNotNull())).alias("step"))
        .select("fp", "node", "step", (F.col("own") + F.col("step")).alias("cell"))
    )
    l, r = spread.alias("l"), spread.alias("r")
    return (
        l.join(
            r,
            (F.col("l.cell") == F.col("r.cell"))
            & (F.col("l.fp") < F.col("r.fp"))
            & ((F.col("r.step") == 0) | ((F.col("l.step") != 0) & (F.col("l.step") != F.col("r.step"))))
            & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= MAX_DISTANCE),
        )
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        .distinct()
    )


def class_components(classes: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """(fp, component) of each row of ``classes``, which has a row per distinct fingerprint.

    A component is named by its smallest fingerprint, so neither a missing id nor
    a repeated one can part or join classes.
    """
    linked = connected_components(close_fingerprints(classes, "fp", "fp", segments)).withColumnRenamed("node", "fp")
    return classes.select("fp").join(linked, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segments: int = SEGMENTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long), component_id.

    ``doc_id`` is a whole number, as text if need be; other texts are an error.
    Rows with equal fingerprints form a class; only classes are joined, so groups
    of copies never become pairs. Null and wordless texts have fingerprint zero
    and link like any other. component_id is the smallest id of the component;
    rows without an id link like any other, and a component of such rows alone
    has a null component_id. Rows that share an id but no close text stay in
    components of their own, which may then bear the same id. Repeated rows each
    give a row.
    """
    bounded_batches(docs.sparkSession)
    prints = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint(F.col(text)).alias("fp")))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    labels = cut(class_components(classes, segments))
    lowest = classes.join(labels, "fp").groupBy("component").agg(F.min("low").alias("component_id"))
    return prints.join(labels.join(lowest, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def near_duplicates_removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, with or without ids.

    It is the one with the smallest id, a missing id last; ties go by the
    fingerprint and then by a digest of the row, so that a rerun keeps the same.
    Rows that are equal in all columns count as one. Columns stay as they are.
    """
    bounded_batches(docs.sparkSession)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    digest = F.unhex(F.sha2(F.concat(F.to_json(F.struct(*rest)), F.col(text).isNull().cast("string"), body), 256))
    prints = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint(F.col(text)).alias("fp"), digest.alias("row")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    classes = cut(prints.groupBy("fp").agg(first))
    best = F.min(F.struct("first.unnamed", "first.doc_id", "fp", "first.row"))
    (name,) = free_names(docs.columns, "row")
    keep = classes.join(class_components(classes), "fp").groupBy("component").agg(best.alias("best")).select(F.col("best.row").alias(name))
    # a plain equi-join on the digest, whose shuffle also serves the removal of repeats
    return docs.withColumn(name, digest).join(keep, name, "left_semi").dropDuplicates([name]).select(*[F.col(f"`{c}`") for c in docs.columns])

"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import cut, scratch, spread

#: A-Z to a-z on UTF-8 bytes; bytes from 0x80 on belong to other code points and stay.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: As LOWER_ASCII, and what is neither digit, letter nor from 0x80 on becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, over all cores also where it is a file or two."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def free_names(taken: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores in front until no column has them (upper and lower case alike)."""
    known = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return out


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text of an Arrow column, one at a time; null is empty."""
    return (x.as_py() or b"" for x in column.cast(pa.binary()))


def as_texts(column: pa.Array) -> Iterator[str]:
    """Each text of an Arrow column, one at a time; null is empty."""
    return (x.as_py() or "" for x in column)


#: Bytes of texts that go to a Python worker at once.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches for whole texts, unless the session has its own lower bound.

    Spark reads this setting when a plan runs, so it stays lowered in the session.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, "64m").lower().strip()
    digits = now.rstrip("bkmgt")
    unit = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[len(digits) :][:1], 1 << 30)
    if int(digits) * unit > BATCH_BYTES or int(digits) < 0:
        spark.conf.set(key, f"{BATCH_BYTES}b")


def crc_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, by which rows are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as compressed Parquet in the shared folder and read back.

    Used instead of checkpoint() for wide data: the files are compressed, and
    later readers prune columns.
    """
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """The smallest id reachable from each end of ``edges``: (node, component), both long.

    Alternating large-star and small-star rounds. A node's minimum comes from a
    partially aggregated groupBy and goes back by an equi-join that adaptive
    execution can split, so a node with very many edges is no single task. Each
    round ends in a checkpoint. Null ends and self-loops are ignored; no edges
    give no rows.
    """
    now = cut(
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # every edge now points from the larger to the smaller id
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        now = cut(small.select("e.u", "e.v").where("u <> v").distinct())
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
        if (seen.n, seen.h) == state:
            break
        state = (seen.n, seen.h)
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    # settled: each node points at its component's smallest id
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )

"""Sharding by jump consistent hashing, in Spark SQL expressions alone.

The published algorithm: a linear congruential generator seeded with the key
makes the jumps; the last jump below the number of shards is the shard. No ring
table exists, and with one more shard a row either stays or goes to the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import free_names

N_SHARDS = 8
#: Rows of a shard that are numbered in one task.
ROWS_PER_RANGE = 20_000

#: Fixed value: the generator's multiplier.
MULTIPLIER = 2862933555777941757


def jump_hash(key: Column, n_shards: int) -> Column:
    """The shard (0 to n_shards - 1) of a 64-bit key.

    Spark's integers raise on overflow, so the 64-bit state is held as two halves
    of 32 bits, and products are made of 16-bit pieces of the multiplier. j grows
    with each jump, so ``n_shards`` jumps are enough.
    """
    a_low0, a_low1, a_high = MULTIPLIER & 0xFFFF, (MULTIPLIER >> 16) & 0xFFFF, MULTIPLIER >> 32
    mask = F.lit(0xFFFFFFFF).cast("long")
    key = key.cast("long")

    def state(b: Column, j: Column, hi: Column, lo: Column) -> Column:
        return F.struct(b.alias("b"), j.alias("j"), hi.alias("hi"), lo.alias("lo"))

    def low16_up(x: Column) -> Column:
        return F.shiftleft(x.bitwiseAND(F.lit(0xFFFF).cast("long")), 16)

    def halves(s: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        p1 = lo * a_low1
        low = lo * a_low0 + low16_up(p1) + 1
        carry = F.shiftright(low, 32) + F.shiftright(p1, 16)
        cross = (hi * a_low0 + low16_up(hi * a_low1)).bitwiseAND(mask)
        return F.struct(
            s["j"].alias("b"), (carry + lo * a_high + cross).bitwiseAND(mask).alias("hi"), low.bitwiseAND(mask).alias("lo")
        )

    def jumped(h: Column) -> Column:
        ratio = F.lit(float(1 << 31)) / (F.shiftright(h["hi"], 1) + 1).cast("double")
        return state(h["b"], F.floor((h["b"] + 1).cast("double") * ratio).cast("long"), h["hi"], h["lo"])

    def step(s: Column, _: Column) -> Column:
        # a one-element array names the halves, so that they are computed once
        return F.when(s["j"] < n_shards, F.element_at(F.transform(F.array(halves(s)), jumped), 1)).otherwise(s)

    start = state(F.lit(-1).cast("long"), F.lit(0).cast("long"), F.shiftrightunsigned(key, 32), key.bitwiseAND(mask))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n_shards)), start, step, lambda s: s["b"].cast("int"))


def shard_key(docs: DataFrame, doc_id: str) -> Column:
    """The id itself where it is a whole number, else a hash of its text. Null counts as 0."""
    whole = isinstance(docs.schema[doc_id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(F.col(doc_id).cast("long") if whole else F.xxhash64(F.col(doc_id).cast("string")), F.lit(0).cast("long"))


def sharded(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_shards: int = N_SHARDS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard (which replace columns of their names).

    The law is ``key``: id and number of shards decide. size is the UTF-8 bytes of
    the text plus 1, a null text has none and crc 0. A null id counts as 0.

    Slots run from 0 in each shard, in the order of an MD5 of id and text_crc32
    (then of both), whatever the number of rows. No shard is numbered in one task:
    the MD5's leading digits cut it into ranges of about ``rows_per_range`` rows,
    whatever the distribution of the ids; each is numbered by itself and begins at
    the sum of the counts before it. Rows that repeat both id and text are
    interchangeable and stay in one range. An empty table gives no rows.
    """
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    plain = [c for c in docs.columns if c not in added]
    key, order, place, number, before, s, p = free_names([*plain, *added], "key", "order", "place", "number", "before", "s", "p")
    rows = docs.select(*[F.col(f"`{c}`") for c in plain], F.col(f"`{text}`").alias(number), shard_key(docs, doc_id).alias(key), F.col(f"`{doc_id}`").cast("string").alias(s))
    rows = rows.withColumns(
        {
            "size": (F.coalesce(F.octet_length(F.col(number)), F.lit(0)) + 1).cast("long"),
            "text_crc32": F.coalesce(F.crc32(F.col(number).cast("binary")), F.lit(0).cast("long")),
            "law": F.lit("key"),
            "shard": jump_hash(F.col(key), n_shards),
            "grown_shard": jump_hash(F.col(key), n_shards + 1),
        }
    ).drop(number)
    rows = rows.withColumn(order, F.md5(F.concat_ws(":", F.coalesce(F.col(s), F.lit("")), F.col("text_crc32").cast("string")).cast("binary"))).drop(s)
    n_ranges = max(1, -(-docs.count() // (n_shards * rows_per_range)))
    # leading digits as a share of all, so that ranges need no bounds
    rows = rows.withColumn(place, F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("double") / float(1 << 32) * n_ranges).cast("int"))
    counts = rows.groupBy("shard", place).agg(F.count("*").alias(number))
    sums = F.expr(f"coalesce(sum({number}) over (partition by shard order by {place} rows between unbounded preceding and 1 preceding), 0)")
    offsets = counts.select(F.col("shard").alias(s), F.col(place).alias(p), sums.alias(before))
    numbered = rows.withColumn(number, F.expr(f"row_number() over (partition by shard, {place} order by {order}, {key}, text_crc32) - 1"))
    out = numbered.join(offsets, (F.col("shard") == F.col(s)) & (F.col(place) == F.col(p)))
    return out.select(
        *[F.col(f"`{c}`") for c in plain], "size", "text_crc32", "law", "shard", (F.col(number) + F.col(before)).cast("long").alias("slot"), "grown_shard"
    )

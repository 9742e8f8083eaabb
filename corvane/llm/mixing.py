"""Mixing sources to target weights by Poisson replication.

Each source has a target repetition rate: the share it should have of the mix,
times the size of the mix, over its rows. A row's uniform number comes from a
seeded hash of its id, and the Poisson distribution with that rate as mean,
inverted at the number, says how often the row occurs. No row looks at another
one, so the result doesn't depend on partitions and a lost task gives the same
rows again. The copies are dealt out by another seeded hash, which is a global
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import free_names
from corvane.session import cut

#: A rate above this is met by the sum of several independent Poisson numbers.
PART_RATE = 32.0
SEED = 17
#: Sources whose tables (about a kilobyte each) are broadcast; with more, documents and tables meet in a shuffle.
BROADCAST_SOURCES = 10_000


def uniform(seed: int, *parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the seed and the parts (null is empty)."""
    fields = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *fields).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(
    docs: DataFrame,
    source: str = "source",
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    size: float | None = None,
) -> DataFrame:
    """(source, n, rate): rows of each source over all of ``docs``, and its repetition rate.

    ``weights`` gives shares in any unit; a source that it doesn't name has weight
    zero. Without it a source weighs its row count to the power ``temperature``.
    ``size`` is the expected number of rows of the mix, by default that of
    ``docs``. Null is a source like any other. Rates have six decimals.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighed = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, w double")
        weighed = counts.join(given, F.col("source").cast("string").eqNullSafe(F.col("name")), "left").select(
            "source", "n", F.coalesce("w", F.lit(0.0)).alias("w")
        )
    totals = weighed.agg(F.sum("w").alias("all_w"), F.sum("n").alias("all_n"))
    target = F.lit(float(size)) if size is not None else F.col("all_n")
    rate = F.coalesce(F.try_divide(F.col("w") * target, F.col("all_w") * F.col("n")), F.lit(0.0))
    return weighed.crossJoin(F.broadcast(totals)).select("source", "n", F.round(rate, 6).alias("rate"))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """Adds parts (independent Poisson numbers to add up) and cdf (of one part, to where it is 1 in doubles)."""
    return (
        rates.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int"))
        .withColumn("mean", F.col("rate") / F.col("parts"))
        .withColumn(
            "cdf",
            F.expr(
                """aggregate(
                     sequence(1, cast(ceil(mean + 12 * sqrt(mean) + 30) as int)),
                     named_struct('p', exp(-mean), 'cdf', array(exp(-mean))),
                     (a, k) -> named_struct('p', a.p * mean / k, 'cdf', array_append(a.cdf, element_at(a.cdf, -1) + a.p * mean / k)),
                     a -> a.cdf)"""
            ),
        )
        .drop("mean")
    )


def _replicas(docs: DataFrame, doc_id: str, source: str, weights, temperature: float, size: float | None, seed: int) -> tuple[DataFrame, list[str]]:
    """All columns of ``docs`` and three more for each copy, and the names of those: its rate, replica and key."""
    name, rate, parts, cdf, n, replica, key = free_names(docs.columns, "of_source", "rate", "parts", "cdf", "n", "replica", "key")
    tables = cut(
        poisson_tables(source_rates(docs, source, weights, temperature, size)).select(
            F.col("source").alias(name), F.col("rate").alias(rate), F.col("parts").alias(parts), F.col("cdf").alias(cdf)
        )
    )
    if tables.count() <= BROADCAST_SOURCES:
        tables = F.broadcast(tables)
    # the numbers first: each is hashed once and not per entry of the table
    numbers = F.transform(F.sequence(F.lit(1), F.col(parts)), lambda part: uniform(seed, doc_id, part))
    drawn = F.aggregate(numbers, F.lit(0), lambda total, u: total + F.size(F.filter(cdf, lambda c: c <= u)))
    place = F.concat_ws(":", F.lit(f"{seed}-order"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.col(replica).cast("string"))
    out = (
        docs.join(tables, F.col(source).eqNullSafe(F.col(name)))
        .withColumn(n, drawn)
        .where(F.col(n) > 0)
        .withColumn(replica, F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
        .withColumn(key, F.md5(place.cast("binary")))
    )
    return out, [rate, replica, key]


def replicated(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    size: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with each row as often as its Poisson number says; adds rate, replica (from 0) and shuffle_key.

    Rows of equal id share their number. A null id is hashed as empty text. An
    empty table stays empty. The three added columns replace columns of their
    names. The table of sources is broadcast up to BROADCAST_SOURCES of them, and
    joined beyond.
    """
    plain = [c for c in docs.columns if c not in ("rate", "replica", "shuffle_key")]
    out, (rate, replica, key) = _replicas(docs, doc_id, source, weights, temperature, size, seed)
    return out.select(*[F.col(f"`{c}`") for c in plain], F.col(rate).alias("rate"), F.col(replica).alias("replica"), F.col(key).alias("shuffle_key"))


def shuffled(rows: DataFrame, key: str = "shuffle_key") -> DataFrame:
    """``rows`` in the order of a hexadecimal hash, over as many partitions as the session shuffles to.

    The hash is uniform, so its leading digits say the partition: the bounds need
    no sampling pass over the data.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / float(1 << 32) * n).cast("int")
    return rows.repartitionById(n, place).sortWithinPartitions(key)


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: dict[str | None, float] | None = None,
    temperature: float = 0.5,
    size: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """The copies in shuffled order, with the columns of ``docs`` as they are."""
    out, (_, _, key) = _replicas(docs, doc_id, source, weights, temperature, size, seed)
    return shuffled(out, key).select(*[F.col(f"`{c}`") for c in docs.columns])

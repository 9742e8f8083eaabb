"""Tables written to be looked up by key: parted into buckets, sorted, with Bloom filters, so that a lookup reads a few row groups.

A key's bucket is a folder, so a lookup lists and opens that folder's files
alone; inside, the sort order leaves one or two row groups whose bounds hold the
key, and their Bloom filters skip them where the key doesn't occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group, before compression: small, as a lookup reads whole ones.
ROW_GROUP_BYTES = 1 << 20


@dataclass(frozen=True)
class Lookup:
    """Where an indexed table is, its key, the key's type and the number of its buckets."""

    path: str
    key: str
    key_type: str
    buckets: int

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.key_type)), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table, with its ``bucket``."""
        return spark.read.parquet(self.path)

    def rows_of(self, spark: SparkSession, keys: list) -> DataFrame:
        """The rows of some keys: only their buckets' files, of these the row groups that may hold one. Null keys have no rows."""
        wanted = [k for k in keys if k is not None]
        buckets = spark.range(1).select(F.array(*[self.bucket(F.lit(k)) for k in wanted]).cast("array<int>").alias("b")).head().b
        table = self.read(spark)
        return table.where(F.col("bucket").isin(sorted(set(buckets))) & F.col(f"`{self.key}`").isin(wanted)).drop("bucket")

    def rows_of_all(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys in a table's column of the same name, by a join; the keys' buckets prune the scan where they are few."""
        wanted = keys.select(F.col(f"`{self.key}`")).where(F.col(f"`{self.key}`").isNotNull()).distinct().withColumn("bucket", self.bucket(F.col(f"`{self.key}`")))
        return self.read(keys.sparkSession).join(wanted, ["bucket", self.key], "left_semi").drop("bucket")


def write_lookup(rows: DataFrame, path: str, key: str, buckets: int = 64, files_a_bucket: int = 1) -> Lookup:
    """Writes ``rows``, which may not have a column ``bucket``, to be looked up by ``key``.

    Each bucket is ``files_a_bucket`` files, dealt by ranges of the key, so that a
    key with very many rows may fill several of them. Null keys are kept.
    """
    found = Lookup(path, key, rows.schema[key].dataType.simpleString(), buckets)
    column = F.col(f"`{key}`")
    placed = rows.withColumn("bucket", F.coalesce(found.bucket(column), F.lit(0)))
    dealt = placed.repartition(buckets, "bucket") if files_a_bucket == 1 else placed.repartitionByRange(buckets * files_a_bucket, "bucket", column, *[c for c in rows.columns if c != key])
    writer = dealt.sortWithinPartitions("bucket", column).write.partitionBy("bucket")
    for name, value in {f"parquet.bloom.filter.enabled#{key}": "true", "parquet.block.size": str(ROW_GROUP_BYTES), "parquet.page.size": str(ROW_GROUP_BYTES >> 3)}.items():
        writer = writer.option(name, value)
    writer.parquet(path)
    return found

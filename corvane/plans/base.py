"""The register of queries, and the roles that the given tables play in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.session import spread

Query = Callable[["Tables"], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The tables of one scale folder, read on demand, so that only needed columns are scanned."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def texts(self, name: str, *columns: str) -> DataFrame:
        """Columns of a table whose texts cost more to work on than to deal out."""
        return spread(getattr(self, name).select(*columns))

    def supply(self) -> DataFrame:
        """Edges of the trade graph: a line item leads from its supplier to its order's customer."""
        return self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_suppkey").alias("source"), F.col("o_custkey").alias("target"), F.col("l_quantity").alias("quantity"), F.col("l_partkey").alias("part")
        )

    def supplier_groups(self) -> DataFrame:
        return self.supplier.select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("grp"))

    def customer_groups(self) -> DataFrame:
        return self.customer.select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("grp"))


def query(sql: str | None = None):
    """Registers a function of ``Tables`` under its name, with the SQL that gives the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register

"""A register of constraints, checked together: each table is read once for all its checks, and one grouping answers them all."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``unique``: no key of ``table`` twice. ``present``: ``columns[1:]`` never null, in rows named by ``columns[0]``.

    ``reference``: each key of ``table`` is one of ``other_columns`` in ``other``.
    ``count``: a row of ``other`` has as many rows in ``table`` as its column ``declared`` says.
    """

    name: str
    kind: str
    table: str
    columns: tuple[str, ...]
    other: str | None = None
    other_columns: tuple[str, ...] = ()
    declared: str | None = None


def _key(columns: tuple[str, ...]) -> Column:
    """The key as text, parts joined by |; null if a part is, as a key with a null part refers to nothing."""
    return F.concat(*[p for k, c in enumerate(columns) for p in ((F.lit("|"),) if k else ()) + (F.col(f"`{c}`").cast("string"),)])


def _entry(check: Check, key: Column, rows: int, others: int, declared: Column | None = None) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"), key.alias("key"), F.lit(rows).cast("long").alias("rows"), F.lit(others).cast("long").alias("others"), (F.lit(None) if declared is None else declared).cast("long").alias("declared")
    )


def violations(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check, key, found, expected) of every key that breaks a constraint.

    found and expected count rows: those with the key (unique, count), those that
    it refers to (reference), those with a null (present). Rows with a null key
    break nothing. A referred table with a null ``declared`` expects nothing. Keys
    are counted before the shuffle, so a frequent key is no large group.
    """
    if len({c.name for c in checks}) < len(checks):
        raise ValueError("checks need names of their own")
    parts = []
    for name, table in tables.items():
        entries = []
        for c in checks:
            if c.table == name:
                holds = reduce(lambda a, b: a | b, [F.col(f"`{x}`").isNull() for x in c.columns[1:]]) if c.kind == "present" else F.lit(True)
                entries.append(F.when(holds, _entry(c, F.coalesce(_key(c.columns[:1]), F.lit("")) if c.kind == "present" else _key(c.columns), 1, 0)))
            if c.other == name:
                entries.append(_entry(c, _key(c.other_columns), 0, 1, F.col(f"`{c.declared}`") if c.declared else None))
        if entries:
            parts.append(table.select(F.explode(F.array(*entries)).alias("e")).where("e.key is not null").select("e.*"))
    sums = reduce(DataFrame.unionByName, parts).groupBy("check", "key").agg(F.sum("rows").alias("rows"), F.sum("others").alias("others"), F.max("declared").alias("declared"))
    of = {k: F.col("check").isin([c.name for c in checks if c.kind == k]) for k in ("unique", "reference", "count", "present")}
    rows, others = F.col("rows"), F.col("others")
    broken = (
        F.when(of["unique"] & (rows > 1), F.struct(rows.alias("found"), F.lit(1).cast("long").alias("expected")))
        .when(of["reference"] & (rows > 0) & (others == 0), F.struct(others.alias("found"), F.lit(1).cast("long").alias("expected")))
        .when(of["count"] & (others > 0) & (rows != F.col("declared")), F.struct(rows.alias("found"), F.col("declared").alias("expected")))
        .when(of["present"] & (rows > 0), F.struct(rows.alias("found"), F.lit(0).cast("long").alias("expected")))
    )
    return sums.withColumn("b", broken).where("b is not null").select("check", "key", "b.found", "b.expected")


def violation_counts(found: DataFrame, checks: list[Check]) -> DataFrame:
    """(check, kind, violations), also of checks that nothing breaks."""
    names = found.sparkSession.createDataFrame([(c.name, c.kind) for c in checks], "check string, kind string")
    return names.join(found.groupBy("check").agg(F.count("*").alias("violations")), "check", "left").withColumn("violations", F.coalesce("violations", F.lit(0).cast("long")))

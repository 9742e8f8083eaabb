"""Rollups, shares, prefix statistics, ordered selections and line rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.session import cut


def histogram(rows: DataFrame, by: list[Column], empty: str = "(empty)") -> DataFrame:
    """(by ..., n, share): blanks and nulls as ``(empty)``; shares of all rows."""
    keys = [F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit(empty)) for c in by]
    names = [f"k{i}" for i in range(len(by))]
    counts = rows.select(*[k.alias(n) for k, n in zip(keys, names, strict=True)]).groupBy(*names).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"))
    return counts.crossJoin(F.broadcast(total)).withColumn("share", F.try_divide("n", "all")).drop("all")


def label_pivot(members: DataFrame, grp: str, member: str, label: Column, values: list[str]) -> DataFrame:
    """(grp, one count per label, unclassified, total) of distinct members; an unknown label is unclassified."""
    known = label.cast("string").isin(*values)
    rows = members.select(F.col(grp).alias(grp), F.col(member).alias("m"), F.when(known, label.cast("string")).alias("l")).distinct()
    return rows.groupBy(grp).agg(
        *[F.count_distinct(F.when(F.col("l") == v, F.col("m"))).alias(f"n_{v}") for v in values],
        F.count_distinct(F.when(F.col("l").isNull(), F.col("m"))).alias("unclassified"),
        F.count_distinct("m").alias("total"),
    )


def prefixes(names: DataFrame, keys: list[str], name: str, lengths: list[int]) -> DataFrame:
    """(keys, name, length, prefix) for each length that the name has."""
    parts = F.transform(F.filter(F.array(*[F.lit(k) for k in lengths]), lambda k: F.char_length(name) >= k), lambda k: F.struct(k.alias("length"), F.substring(F.col(name), F.lit(1), k).alias("prefix")))
    return names.select(*keys, name, F.explode(parts).alias("p")).select(*keys, name, "p.length", "p.prefix")


def dominant_prefix(names: DataFrame, grp: str, name: str, lengths: list[int], share: float, order: str | None = None) -> DataFrame:
    """(grp, prefix, share): the prefix with the largest share of a group's names, if at least ``share``.

    Blank names and those that begin with % are left out. Ties go to the prefix
    that is seen first: with the least ``order`` (by default the name itself),
    and of one name the longest.
    """
    rows = names.where((F.col(name) != "") & ~F.col(name).startswith("%")).withColumn("seen", F.col(order or name))
    totals = rows.groupBy(grp).agg(F.count("*").alias("all"))
    counts = prefixes(rows, [grp, "seen"], name, lengths).groupBy(grp, "prefix").agg(F.count("*").alias("n"), F.min(F.struct("seen", -F.col("length"))).alias("first"))
    best = counts.groupBy(grp).agg(F.min(F.struct((-F.col("n")).alias("o"), "first", "prefix", "n")).alias("b"))
    return best.join(totals, grp).select(grp, "b.prefix", (F.col("b.n") / F.col("all")).alias("share")).where(F.col("share") >= share)


def prefix_clusters(names: DataFrame, name: str, lengths: list[int], least: int) -> DataFrame:
    """(name, prefix, size): the longest prefix of each distinct name that at least ``least`` names share."""
    parts = prefixes(names.select(name).distinct(), [], name, lengths)
    sizes = parts.groupBy("prefix").agg(F.count("*").alias("size")).where(F.col("size") >= least)
    return parts.join(sizes, "prefix").groupBy(name).agg(F.max_by(F.struct("prefix", "size"), "length").alias("b")).select(name, "b.prefix", "b.size")


def within_budget(rows: DataFrame, grp: str, order: list[Column], size: Column, budget: int) -> DataFrame:
    """Rows of each group in order while their running size stays within the budget, with that size (used).

    The first overflow ends the group; sizes aren't negative, a null one counts as
    0. Rows are dealt into ranges of group and order, so a large group is many
    tasks: sums of its ranges say where each begins, and only ranges that begin
    within the budget are summed row by row.
    """
    spark = rows.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(rows.withColumn("used", F.coalesce(size, F.lit(0))).repartitionByRange(ranges, F.col(grp), *order).withColumn("range_no", F.spark_partition_id()))
    sums = dealt.groupBy(grp, "range_no").agg(F.sum("used").alias("in_range"))
    begins = sums.withColumn("begin", F.coalesce(F.sum("in_range").over(Window.partitionBy(grp).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("begin") <= budget)
    inside = Window.partitionBy(grp, "range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = (F.col("r." + grp).eqNullSafe(F.col("b." + grp))) & (F.col("r.range_no") == F.col("b.range_no"))
    found = dealt.alias("r").join(begins.alias("b"), same).select("r.*", "b.begin").withColumn("used", F.col("begin") + F.sum("used").over(inside))
    return found.where(F.col("used") <= budget).drop("range_no", "begin")


def ranked(rows: DataFrame, grp: str, order: list[Column], rank: str = "rank") -> DataFrame:
    """All rows with their place in their group, from 1; make ``order`` total. A large group is many tasks, as in within_budget()."""
    return within_budget(rows, grp, order, F.lit(1), 1 << 62).withColumnRenamed("used", rank)


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One whole row per key, the first in ``order``: an aggregate with map-side combine, not a sort of each group."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("b")).select(*keys, "b.*")


def violations(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """(keys, rule) for each rule that a row breaks; rows are read once."""
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return rows.select(*keys, F.explode(broken).alias("rule"))


def line_rules(line: Column, limit: int = 245) -> dict[str, Column]:
    code = F.substring_index(line, ";", 1)
    return {"W-length": F.char_length(line) > limit, "W-trailing": line.rlike("[ \\t]$"), "W-tab": line.contains("\t"), "F-halt": code.rlike(r"(?:^|\s)(?:H|HALT)\s*$")}


def structure_rules(line: Column, line_no: Column) -> dict[str, Column]:
    """Rules for the first two lines and for label lines."""
    return {
        "E-first-empty": (line_no == 1) & (line == ""),
        "E-first-indented": (line_no == 1) & line.rlike(r"^[ \t]"),
        "E-first-comment": (line_no == 1) & ~line.contains(";"),
        "E-second-header": (line_no == 2) & ~line.rlike(r"^ ?;;"),
        "E-label": (line_no > 2) & line.rlike(r"^[^ \t;]") & ~line.rlike(r"^[A-Za-z%][A-Za-z0-9]*(?:\(|[ \t]|;|$)|^[0-9]+(?:[ \t]|;|$)"),
    }


def undocumented_labels(
    lines: DataFrame, unit: str, line_no: str, is_label: Column, is_comment: Column, has_marker: Column, own_marker: Column, exempt: Column | None = None
) -> DataFrame:
    """(unit, line_no) of label lines without a marker in the comment lines right above or in their own trailing comment.

    Gaps and islands: comment lines that touch form a run, numbered by the other
    lines before it; the line after a run sees whether the run had a marker. Line
    1 is exempt, and so are labels for which ``exempt`` holds (see X.structural_label).
    """
    order = Window.partitionBy(unit).orderBy(line_no)
    is_label = is_label & ~F.coalesce(exempt, F.lit(False)) if exempt is not None else is_label
    marked = lines.select(unit, line_no, is_label.alias("label"), is_comment.alias("comment"), has_marker.alias("marker"), own_marker.alias("own"))
    runs = marked.withColumn("run", F.sum(F.when(F.col("comment"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    seen = runs.withColumn("m", F.max(F.col("comment") & F.col("marker")).over(Window.partitionBy(unit, "run")))
    above = F.coalesce(F.lag("comment").over(order) & F.lag("m").over(order), F.lit(False))
    return seen.withColumn("above", above).where(F.col("label") & ~F.col("above") & ~F.col("own") & (F.col(line_no) > 1)).select(unit, line_no)


def metrics(rows: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """(metric, value) from one aggregation."""
    one = rows.agg(*[c.cast("double").alias(n) for n, c in measures.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in measures])).alias("m")).select("m.*")


def reconciled(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(measure, a, b, ok): the same total from two one-cell tables each."""
    rows = []
    for name, (a, b) in pairs.items():
        rows.append(a.toDF("a").crossJoin(b.toDF("b")).select(F.lit(name).alias("measure"), F.col("a").cast("double").alias("a"), F.col("b").cast("double").alias("b")))
    return reduce(lambda x, y: x.unionByName(y), rows).withColumn("ok", F.abs(F.col("a") - F.col("b")) <= F.lit(1e-6) * F.greatest(F.lit(1.0), F.abs("a")))


def sample_share(rows: DataFrame, key: str, item: str, reference: DataFrame, k: int, least: float) -> DataFrame:
    """(key, sampled, share, verdict): of the first ``k`` items of each key, the share in ``reference``; above ``least`` is YES.

    A key whose items are all null has none: sampled 0, a null share, N/A.
    """
    window = Window.partitionBy(key).orderBy(item)
    first = rows.select(key, item).where(F.col(item).isNotNull()).distinct().withColumn("r", F.row_number().over(window)).where(F.col("r") <= k)
    known = reference.select(F.col(reference.columns[0]).alias(item)).distinct().withColumn("hit", F.lit(1))
    shares = first.join(known, item, "left").groupBy(key).agg(F.count("*").alias("sampled"), F.avg(F.coalesce("hit", F.lit(0))).alias("share"))
    verdict = F.when(F.col("sampled") == 0, "N/A").when(F.col("share") > least, "YES").otherwise("NO")
    return rows.select(key).distinct().join(shares, key, "left").withColumn("sampled", F.coalesce("sampled", F.lit(0))).withColumn("verdict", verdict)

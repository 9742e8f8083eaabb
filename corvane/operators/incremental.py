"""Re-runs that only improve: automatic labels give way to better ones, manual ones stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged(old: DataFrame, new: DataFrame, key: str, label: str = "label", method: str = "method", force: bool = False) -> DataFrame:
    """(key, label, method, scenario): structure from the new run, labels by precedence.

    A blank or automatic (``H-``) label is rewritten where the new run has one; a
    manual label stays unless ``force``. Keys that only the old run has are
    retired with their old label.
    """
    o = old.select(key, F.col(label).alias("ol"), F.col(method).alias("om"), F.lit(True).alias("in_old"))
    n = new.select(key, F.col(label).alias("nl"), F.col(method).alias("nm"), F.lit(True).alias("in_new"))
    automatic = F.col("ol").isNull() | F.coalesce(F.col("om").startswith("H-"), F.lit(True))
    take = (automatic | F.lit(force)) & F.col("nl").isNotNull()
    scenario = (
        F.when(F.col("in_new").isNull(), "retired").when(F.col("in_old").isNull(), "added").when(~automatic & ~F.lit(force), "kept manual")
        .when(F.col("ol").eqNullSafe(F.col("nl")) & F.col("om").eqNullSafe(F.col("nm")), "same")
        .when(F.col("ol").eqNullSafe(F.col("nl")), "other rule").when(F.col("ol").isNull(), "newly labelled").when(F.col("nl").isNull(), "kept").otherwise("relabelled")
    )
    return o.join(n, key, "full").select(
        key, F.when(take, F.col("nl")).otherwise(F.col("ol")).alias(label), F.when(take, F.col("nm")).otherwise(F.col("om")).alias(method), scenario.alias("scenario")
    )


def run_log(result: DataFrame, mode: str, label: str = "label") -> DataFrame:
    """One row (mode, total, new, unchanged, unresolved) to append to the log of runs."""
    return result.agg(
        F.lit(mode).alias("mode"), F.count("*").alias("total"), F.count_if(F.col("scenario").isin("added", "newly labelled", "relabelled", "other rule")).alias("new"),
        F.count_if(F.col("scenario").isin("same", "kept", "kept manual")).alias("unchanged"), F.count_if(F.col(label).isNull()).alias("unresolved"),
    )


def compared(a: DataFrame, b: DataFrame, key: str, label: str = "label", method: str = "method") -> DataFrame:
    """(key, a_label, b_label, scenario): two systems' labels of the same keys."""
    x = a.select(key, F.col(label).alias("a_label"), F.col(method).alias("am"), F.lit(1).alias("ina"))
    y = b.select(key, F.col(label).alias("b_label"), F.col(method).alias("bm"), F.lit(1).alias("inb"))
    scenario = F.when(F.col("ina").isNull(), "only b").when(F.col("inb").isNull(), "only a").when(~F.col("a_label").eqNullSafe(F.col("b_label")), "label differs").when(~F.col("am").eqNullSafe(F.col("bm")), "rule differs").otherwise("same")
    return x.join(y, key, "full").select(key, "a_label", "b_label", scenario.alias("scenario"))


def triage(unlabelled: DataFrame) -> DataFrame:
    """Adds a bucket: vestigial (no records, no references), batch (a prefix that many share), mixed."""
    bucket = F.when((F.col("records") == 0) & (F.col("refs") == 0), "vestigial").when(F.col("prefix_size") >= 5, "batch").when(F.col("refs") == 0, "unused").otherwise("mixed")
    return unlabelled.withColumn("bucket", bucket)

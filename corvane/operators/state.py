"""Labels kept in a table between runs: only new, changed and open keys are classified again.

The table is Parquet, parted into buckets by a hash of the key. A row has the
digest of the features that its label was found with. A run classifies the rows
whose digest differs or that have no label, seeds inheritance and propagation
with all labels, those of people among them, and rewrites only the buckets in
which a row has changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from corvane.operators import rules as R
from corvane.operators.graph import nearest_labelled, propagate
from corvane.session import cut

_VALUES = ("label", "method", "confidence", "evidence")
LOG_SCHEMA = "run string, mode string, total bigint, newly_classified bigint, re_evaluated bigint, unchanged bigint, unresolved bigint"


@dataclass
class StateTable:
    """Where the table is, the type of its key, and the number of its buckets, which stays as it was first chosen."""

    path: str
    key_type: str = "string"
    buckets: int = 64

    @property
    def schema(self) -> str:
        return f"id {self.key_type}, parent {self.key_type}, digest string, label string, method string, confidence string, evidence string, run string, bucket int"

    def read(self, spark: SparkSession) -> DataFrame:
        """(id, parent, digest, label, method, confidence, evidence, run, bucket); empty before the first run."""
        try:
            return spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], self.schema)

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast(self.key_type)), F.lit(self.buckets)).cast("int")


def digest(columns: list[str]) -> Column:
    """A digest of a row's values in these columns; null differs from blank."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"}), 256)


def _put(rows: DataFrame, path: str, *parts: str) -> None:
    """Replaces the parts that ``rows`` have, and no others; a run that is repeated leaves the same rows."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def rerun(
    features: DataFrame, rules: list[R.Rule], table: StateTable, run: str, manual: DataFrame | None = None, pointers: DataFrame | None = None, force: bool = False, rounds: int = 6
) -> DataFrame:
    """Classifies what is new, changed or open, writes the table, and returns the run's row of the log (see LOG_SCHEMA).

    ``features`` has id, parent and what ``rules`` read, one row per id; ``manual``
    (id, label, method, evidence) what people have decided since the last run;
    ``pointers`` (id, target). A manual label (method ``manual...``) stays, unless
    ``force`` has its row classified again. A label is replaced, never cleared,
    and keys that ``features`` lack keep their rows, so the number of unlabelled
    keys never grows but by new ones. A weak label gives way to one inherited;
    open uppermost keys get labels by propagation; what is still open then
    inherits. newly_classified counts rows that had no label, re_evaluated those
    with a label that were classified again.
    """
    spark = features.sparkSession
    old = table.read(spark)
    first = old.isEmpty()
    names = [c for c in features.columns if c != "id"]
    known = old.select("id", F.col("digest").alias("old_digest"), *[F.col(c).alias(f"old_{c}") for c in _VALUES], F.col("run").alias("old_run"))
    now = features.select("id", "parent", digest(names).alias("digest")).join(known, "id", "left")
    if manual is not None:
        told = manual.select("id", *[F.col(c).alias(f"told_{c}") for c in ("label", "method", "evidence")])
        decided = F.col("told_label").isNotNull()
        now = now.join(told, "id", "left").withColumns({f"base_{c}": F.when(decided, F.col(f"told_{c}") if c != "confidence" else F.lit(None)).otherwise(F.col(f"old_{c}")) for c in _VALUES})
    else:
        now = now.withColumns({f"base_{c}": F.col(f"old_{c}") for c in _VALUES})
    by_hand = F.coalesce(F.col("base_method").startswith("manual"), F.lit(False))
    todo = (F.col("base_label").isNull() | F.col("old_digest").isNull() | (F.col("old_digest") != F.col("digest"))) & ~by_hand | F.lit(force)
    now = cut(now.withColumn("todo", todo))

    again = features.join(now.where("todo").select("id"), "id", "left_semi")
    fresh = R.labelled(again, rules).select("id", *[F.col(c).alias(f"new_{c}") for c in _VALUES])
    found = F.col("new_label").isNotNull()
    rows = now.join(fresh, "id", "left").select("id", "parent", "digest", "todo", *[F.when(found, F.col(f"new_{c}")).otherwise(F.col(f"base_{c}")).alias(c) for c in _VALUES])
    rows = cut(rows)
    up = R.inherited(rows.withColumn("confidence", F.when(~F.col("todo"), "certain").otherwise(F.col("confidence"))).select("id", "parent", *_VALUES))
    rows = cut(rows.join(up.select("id", *[F.col(c).alias(f"up_{c}") for c in _VALUES]), "id").select("id", "parent", "digest", "todo", *[F.when(F.col("todo"), F.col(f"up_{c}")).otherwise(F.col(c)).alias(c) for c in _VALUES]))
    open_ = rows.where("label is null")
    if pointers is not None and not open_.isEmpty():
        tops = open_.where("parent is null").select("id")
        reached = propagate(tops, pointers, rows.select("id", "label"), "P", "K", rounds, only_nodes=True).where("method <> 'seed'")
        more = reached.select("id", *[F.col(c).alias(f"new_{c}") for c in _VALUES])
        rows = cut(rows.join(more, "id", "left").select("id", "parent", "digest", "todo", *[F.coalesce(c, f"new_{c}").alias(c) for c in _VALUES]))
    late = nearest_labelled(rows.select("id", "parent"), rows.select("id", "label")).where("from_id <> id").select("id", F.col("label").alias("above"))
    takes = F.col("label").isNull() & F.col("above").isNotNull()
    values = {"label": F.col("above"), "method": F.lit("H-05"), "confidence": F.lit("certain"), "evidence": F.concat(F.lit("inherits(prop) from "), F.col("parent").cast("string"))}
    rows = rows.join(late, "id", "left").select("id", "parent", "digest", "todo", *[F.when(takes, values[c]).otherwise(F.col(c)).alias(c) for c in _VALUES])

    before = now.select("id", "old_digest", *[f"old_{c}" for c in _VALUES], "old_run")
    differs = F.col("old_digest").isNull() | (F.col("old_digest") != F.col("digest"))
    for c in _VALUES:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"old_{c}"))
    final = rows.join(before, "id").withColumn("changed", differs).withColumn("run", F.when(F.col("changed"), F.lit(run)).otherwise(F.col("old_run"))).withColumn("bucket", table.bucket(F.col("id")))
    final = cut(final)
    columns = [c.split()[0] for c in table.schema.split(", ")]
    touched = final.where("changed").select("bucket").distinct()
    gone = old.join(final.select("id"), "id", "left_anti")
    whole = cut(final.select(*columns).unionByName(gone.select(*columns)).join(F.broadcast(touched), "bucket", "left_semi"))
    if not whole.isEmpty():
        _put(whole.select(*columns).repartition("bucket"), table.path, "bucket")
    had, has = F.col("old_label").isNotNull(), F.col("label").isNotNull()
    return final.agg(
        F.lit(run).alias("run"), F.lit("force" if force else "fresh" if first else "incremental").alias("mode"), F.count("*").alias("total"), F.count_if(~had & has).alias("newly_classified"),
        F.count_if(F.col("todo") & had).alias("re_evaluated"), F.count_if(~F.col("changed")).alias("unchanged"), F.count_if(~has).alias("unresolved"),
    )


def append_log(path: str, row: DataFrame) -> None:
    """Adds a run's row to the log; the same run twice leaves one row."""
    _put(row.select(*[c.split()[0] for c in LOG_SCHEMA.split(", ")]).coalesce(1), path, "run")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)

"""Session helpers: one place that knows where shared intermediate data goes."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "corvane", **conf: str) -> SparkSession:
    """A session with the settings the queries are tested with; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k: str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Paths that scratch() has given out, per session folder.
_SCRATCH: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``; without that setting a
    cluster is an error. Only in local mode a folder of this machine is made and
    registered.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="spark-corvane-", dir=os.environ.get("TMPDIR"))
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def discard_scratch(spark: SparkSession) -> None:
    """Deletes what this process has written under scratch() and its checkpoints: for when no DataFrame made with them is needed any more."""
    context = spark.sparkContext
    paths = [*_SCRATCH]
    _SCRATCH.clear()
    if context.getCheckpointDir():  # Spark gives each application a folder of its own below the shared one
        top = context._jvm.org.apache.hadoop.fs.Path(context.getCheckpointDir())
        files = top.getFileSystem(context._jsc.hadoopConfiguration())
        paths += [x.getPath().toString() for x in (files.listStatus(top) if files.exists(top) else ())]
    for p in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a table that may be dealt out anew.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it is small and comes from fewer files than that, as a small file may be a single task.

    Larger tables stay as Spark splits them: a shuffle of their texts would cost
    more than it deals out, and their files aren't listed here.
    """
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > SPREAD_BYTES:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back, for loops of joins.

    A checkpoint hands on the size that Spark estimated for the plan before it, and
    a join's estimate is the product of its sides, so over some rounds that number
    grows to millions of digits with which the driver is busy. Files have their own.
    """
    path = scratch(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

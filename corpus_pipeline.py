"""From raw documents to shards of a training mix, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import decontaminate, mixing, quality, sharding, simhash
from corvane.llm.common import scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the discriminant fitted on the labelled ones rejects.

    Null and empty texts share one score and so one fate. Repeated rows are judged
    alike and all stay or go. Without labels that can be learned from, all stay.
    """
    model = quality.fit_on_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component, that with the smallest id.

    Null, empty and wordless texts are one component. Missing and repeated ids
    lose no text; rows that are equal in all columns count as one.
    """
    return simhash.near_duplicates_removed(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark window occurs. Null and empty texts stay, repeated rows share their fate."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by the target rates of their sources, in a global shuffle.

    A null source is a source of its own; rows of equal ids share their number, a
    null id counting as empty text. An empty table stays empty.
    """
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's size, text_crc32, law, shard, slot and grown_shard; null ids count as 0, null texts as empty."""
    return sharding.sharded(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Fingerprints and the discriminant have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each one's rows are written as Parquet and read by the next.

    All rows that the stages keep, with the columns of the last one. An empty
    table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

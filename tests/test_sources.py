"""Scans driven by a manifest, and tables that are looked up, with what is read."""

import os
import re

from pyspark.sql import functions as F

from corvane.session import scratch
from corvane.sources import corpus
from corvane.sources.lookup import write_lookup


def test_files_are_dealt_by_size(spark):
    sizes = [(f"p{k}", 1 + (k * 7919) % 1000 + (3000 if k % 97 == 0 else 0)) for k in range(2_000)] + [("none", None)]
    files = spark.createDataFrame(sizes, "path string, byte_size bigint")
    for tasks in (1, 8, 30):
        bins = corpus.dealt_by_size(files, tasks).groupBy("task").agg(F.sum("byte_size").alias("s"), F.count("*").alias("n")).collect()
        mean = sum(s or 0 for _, s in sizes) / tasks
        assert {b.task for b in bins} == set(range(tasks)) and sum(b.n for b in bins) == 2_001
        assert max(b.s for b in bins) < 2 * mean and min(b.s for b in bins) > 0
    assert corpus.dealt_by_size(files.limit(0), 3).count() == 0


def test_dealing_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(corpus, "FILES_A_RANGE", 50)
    files = spark.range(500).select(F.col("id").cast("string").alias("path"), (F.col("id") % 7 + 1).alias("byte_size"))
    bins = corpus.dealt_by_size(files, 10).groupBy("task").agg(F.sum("byte_size").alias("s")).collect()
    assert len(bins) == 10 and max(b.s for b in bins) < 1.2 * min(b.s for b in bins)


def test_manifest_drives_the_read(spark, tmp_path):
    texts = {f"A{k}": "x\n" * (k * k) for k in range(40)} | {"_PCT": "% unit", "EMPTY": ""}
    for unit, text in texts.items():
        folder = tmp_path / f"G#{len(unit) % 2}?" / "Routines"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{unit}.m").write_text(text)
    place = {u: str(tmp_path / f"G#{len(u) % 2}?" / "Routines" / f"{u}.m") for u in texts}
    rows = [(u, "g", place[u]) for u in texts if u != "A7"] + [("A1", "other", place["A1"]), ("GONE", "g", str(tmp_path / "gone.m"))]
    manifest = spark.createDataFrame(rows, "unit string, grp string, path string")
    read = corpus.read_by_manifest(spark, manifest, str(tmp_path), tasks=4)
    got = {r.unit: r.text for r in read.collect()}
    assert got == {u: t for u, t in texts.items() if u != "A7"}
    bytes_of = {r.task: r.s for r in read.groupBy("task").agg(F.sum("byte_size").alias("s")).collect()}
    assert max(bytes_of.values()) <= 2 * sum(bytes_of.values()) / 4
    # a task of the plan reads one bin and no other
    assert read.select("task", F.spark_partition_id().alias("p")).distinct().count() == len(bytes_of)
    broken = {tuple(r) for r in corpus.manifest_contract(spark, manifest, str(tmp_path)).collect()}
    assert broken == {("several groups", "A1"), ("missing file", "GONE"), ("not listed", place["A7"])}


def test_units_are_listed_and_read_by_tasks_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus, "FILES_A_BATCH", 7)
    monkeypatch.setattr(corpus, "BYTES_A_BATCH", 300)
    want = {}
    for k in range(60):  # files of a folder, of folders of its own each, at several depths
        folder = tmp_path.joinpath(*[f"d{k % j}" for j in range(2, 2 + k % 5)], f"G {k % 12}", "Routines")
        folder.mkdir(parents=True, exist_ok=True)
        name = f"_P{k}" if k % 10 == 0 else f"P{k}"
        (folder / f"{name}.m").write_text("" if k % 7 == 0 else f"P{k} ;\n" * k)
        (folder / f"{name}.txt").write_text("x")
        want[str(folder / f"{name}.m")] = (name, f"G {k % 12}", "" if k % 7 == 0 else f"P{k} ;\n" * k)
    (tmp_path / "top.m").write_text("T")
    read = corpus.read_units(spark, f"file://{tmp_path}")
    assert read.inputFiles() == []  # Spark's reader would hold the list of files in the driver
    got = {r.path: (r.unit, r.grp, r.text) for r in read.collect()}
    assert got == want | {str(tmp_path / "top.m"): ("top", str(tmp_path).split("/")[-2], "T")}
    assert corpus.listed(spark, str(tmp_path), "*.none").count() == 0


def scanned(df):
    """(files, rows) that the scan of an executed plan has read."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    text = plan.toString()
    assert "PushedFilters" in text or "FileScan" in text
    leaves = plan.collectLeaves()
    metrics = leaves.apply(0).metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()


def test_a_lookup_reads_a_few_row_groups(spark):
    rows = spark.range(400_000).select(F.concat(F.lit("k"), (F.col("id") % 50_000).cast("string")).alias("name"), "id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = scratch(spark, "lookup")
    table = write_lookup(rows, path, "name", buckets=4)
    files = [os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file://")) for f in names if f.endswith(".parquet")]
    import pyarrow.parquet as pq

    groups = sum(pq.ParquetFile(f).metadata.num_row_groups for f in files)
    assert len(files) == 4 and groups >= 12
    found = table.rows_of(spark, ["k77"])
    n_files, n_rows = scanned(found)
    assert sorted(r.id for r in found.collect()) == list(range(77, 400_000, 50_000))
    assert n_files == 1 and n_rows <= 3 * 400_000 / groups
    assert scanned(table.rows_of(spark, ["k77absent"])) == (1, 0)  # within the bounds of a row group, but not in its filter
    assert table.rows_of(spark, [None]).count() == 0
    keys = spark.createDataFrame([("k1",), ("k2",), (None,), ("absent",), ("k1",)], "name string")
    assert table.rows_of_all(keys).groupBy("name").count().orderBy("name").collect() == [("k1", 8), ("k2", 8)]


def test_keys_of_other_types_and_hot_keys(spark):
    rows = spark.createDataFrame([(5, k) for k in range(3_000)] + [(None, 1), (6, 2)], "key bigint, v int")
    table = write_lookup(rows, scratch(spark, "hot"), "key", buckets=2, files_a_bucket=4)
    assert table.rows_of(spark, [5]).count() == 3_000 and table.rows_of(spark, [6, 7]).collect() == [(6, 2)] and table.read(spark).count() == 3_002
    assert re.match("bigint", table.key_type)

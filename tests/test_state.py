"""Runs over a stored table of labels."""

import os

import pytest
from pyspark.sql import functions as F

from corvane.operators import rules as R
from corvane.operators import state as S
from corvane.session import scratch

@pytest.fixture
def rules(spark):
    return [
        R.Rule("H-01", F.col("kind") == "p", "P", "certain", F.lit("kind p")),
        R.Rule("H-14", F.col("kind") == "i", "I", "moderate", F.lit("kind i")),
        R.Rule("H-20", F.col("kind") == "k", "K", "low", F.concat(F.lit("kind "), F.col("kind"))),
    ]


def table_of(spark, rows):
    return spark.createDataFrame(rows, "id string, parent string, kind string")


def rows_of(table, spark):
    return {r.id: (r.label, r.method, r.run) for r in table.read(spark).collect()}


def files(path):
    folder = path.removeprefix("file://")
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.startswith("part-")}


@pytest.fixture
def table(spark):
    return S.StateTable(scratch(spark, "state"), buckets=16)


def test_second_run_classifies_what_changed_or_is_open(spark, table, rules, monkeypatch):
    first = [(str(k), None, "pik"[k % 3] if k % 7 else None) for k in range(1, 85)]
    log = S.rerun(table_of(spark, first), rules, table, "r1").head()
    assert (log.mode, log.total, log.newly_classified, log.unresolved, log.unchanged) == ("fresh", 84, 72, 12, 0)
    before = files(table.path)
    seen = []
    labelled = R.labelled
    monkeypatch.setattr(R, "labelled", lambda features, rules: seen.append(sorted(r.id for r in features.select("id").collect())) or labelled(features, rules))
    second = [(k, p, {"7": "k", "1": "p", "2": None}.get(k, x)) for k, p, x in first]
    log = S.rerun(table_of(spark, second), rules, table, "r2").head()
    assert seen == [sorted({*(str(k) for k in range(7, 85, 7)), "1", "2"})]
    assert (log.mode, log.newly_classified, log.re_evaluated, log.unresolved, log.unchanged) == ("incremental", 1, 2, 11, 81)
    got = rows_of(table, spark)
    assert got["7"] == ("K", "H-20", "r2") and got["1"] == ("P", "H-01", "r2") and got["2"] == ("K", "H-20", "r2") and got["3"] == ("P", "H-01", "r1") and len(got) == 84
    kept = before & files(table.path)
    touched = {r.bucket for r in spark.createDataFrame([(k,) for k in ("1", "2", "7")], "id string").select(table.bucket(F.col("id")).alias("bucket")).collect()}
    assert {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in touched} == kept and len(kept) >= 10
    again = S.rerun(table_of(spark, second), rules, table, "r3").head()
    assert (again.newly_classified, again.re_evaluated, again.unchanged) == (0, 0, 84) and rows_of(table, spark) == got


def test_manual_labels_stay_and_seed(spark, table, rules):
    rows = [("1", None, None), ("2", None, None), ("3", None, None), ("4", "3", None), ("5", None, "k"), ("6", "5", "i"), ("7", None, "i")]
    pointers = spark.createDataFrame([("3", "1"), ("3", "2"), ("1", "5")], "id string, target string")
    log = S.rerun(table_of(spark, rows), rules, table, "r1", pointers=pointers).head()
    assert log.unresolved == 4 and rows_of(table, spark)["6"][:2] == ("K", "H-05")
    manual = spark.createDataFrame([("1", "K", "manual", "note 1"), ("2", "K", "manual-package", "note 2"), ("7", "S", "manual", "note 3")], "id string, label string, method string, evidence string")
    log = S.rerun(table_of(spark, rows), rules, table, "r2", manual, pointers).head()
    got = rows_of(table, spark)
    assert log.unresolved == 0 and log.newly_classified == 4
    assert got["1"][:2] == ("K", "manual") and got["3"][:2] == ("K", "H-40") and got["4"][:2] == ("K", "H-05") and got["7"] == ("S", "manual", "r2")
    S.rerun(table_of(spark, [(k, p, "p" if k in "17" else x) for k, p, x in rows]), rules, table, "r3", pointers=pointers)
    assert rows_of(table, spark)["7"] == ("S", "manual", "r3") and rows_of(table, spark)["1"][:2] == ("K", "manual")
    S.rerun(table_of(spark, [(k, p, "p" if k in "17" else x) for k, p, x in rows]), rules, table, "r4", pointers=pointers, force=True)
    assert rows_of(table, spark)["7"][:2] == ("P", "H-01")


def test_labels_are_never_cleared_and_lost_keys_stay(spark, table, rules):
    S.rerun(table_of(spark, [("1", None, "p"), ("2", None, "k")]), rules, table, "r1")
    S.rerun(table_of(spark, [("1", None, None), ("3", None, "i")]), rules, table, "r2")
    got = rows_of(table, spark)
    assert got["1"][:2] == ("P", "H-01") and got["2"] == ("K", "H-20", "r1") and got["3"][:2] == ("I", "H-14")


def test_log_has_one_row_a_run(spark, table, rules):
    path = scratch(spark, "runs")
    for run in ("r1", "r1", "r2"):
        S.append_log(path, S.rerun(table_of(spark, [("1", None, "p"), ("2", None, None)]), rules, table, run))
    rows = {r.run: (r.total, r.unresolved) for r in S.read_log(spark, path).collect()}
    assert rows == {"r1": (2, 1), "r2": (2, 1)} and S.read_log(spark, path).count() == 2

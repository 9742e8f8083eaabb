"""Constraints on tables made by hand."""

import pytest

from corvane.operators.constraints import Check, violation_counts, violations

CHECKS = [
    Check("ref", "reference", "child", ("a", "b"), "parent", ("x", "y")), Check("one", "unique", "child", ("k",)), Check("all", "count", "child", ("a", "b"), "parent", ("x", "y"), "n"), Check("full", "present", "child", ("k", "v")),
    Check("self", "reference", "child", ("up",), "child", ("k",)),
]


def test_all_kinds(spark):
    child = spark.createDataFrame([(1, "p", 1, "v", None), (2, "p", 1, None, 1), (2, "q", 2, "v", 1), (3, "q", None, None, 9), (None, "z", 5, "v", 9), (7, "p", 1, "v", 2)], "k int, a string, b int, v string, up int")
    parent = spark.createDataFrame([("p", 1, 3), ("q", 3, 1), ("r", 1, 0), ("s", 1, 2), ("t", 1, None), (None, 1, 4)], "x string, y int, n int")
    found = violations({"child": child, "parent": parent, "idle": parent}, CHECKS)
    got = sorted((r.check, r.key, r.found, r.expected) for r in found.collect())
    assert got == sorted([("ref", "q|2", 0, 1), ("ref", "z|5", 0, 1), ("one", "2", 2, 1), ("all", "q|3", 0, 1), ("all", "s|1", 0, 2), ("full", "2", 1, 0), ("full", "3", 1, 0), ("self", "9", 0, 1)])
    assert {r.check: r.violations for r in violation_counts(found, CHECKS).collect()} == {"ref": 2, "one": 1, "all": 2, "full": 2, "self": 1}
    assert violations({"child": child.limit(0), "parent": parent.limit(0)}, CHECKS).collect() == []
    with pytest.raises(ValueError):
        violations({"child": child}, [CHECKS[0], CHECKS[0]])


def test_each_table_is_scanned_once(spark, sf):
    from corvane.plans.graph_queries import _violations
    from corvane.plans.base import Tables

    plan = _violations(Tables(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 9

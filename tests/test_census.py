"""Branches of stores against what a dictionary declares, by hand."""

import pytest

from corvane.operators import census as C
from corvane.operators import dictionary as D

NODES = [
    ("^DD", ["55", "0"], "PHARMACY"), ("^DD", ["55", ".01", "0"], "NAME^P2'^^0;1"), ("^DD", ["55", "1", "0"], "ORDERS^55.06^^5;0"), ("^DD", ["55", "2", "0"], "NOTE^F^^NT;1"), ("^DD", ["55", "3", "0"], "COMPUTED^C"), ("^DD", ["55", ".01", "1", "1", "0"], "55^B"),
    ("^DD", ["55.06", "0", "UP"], "55"), ("^DD", ["55.06", ".01", "0"], "ORDER^F^^0;1"), ("^DD", ["55.06", "7", "0"], "DOSES^55.07^^D;0"), ("^DD", ["55.07", "0", "UP"], "55.06"), ("^DD", ["55.07", ".01", "0"], "DOSE^F^^0;1"),
    ("^DIC", ["55", "0"], "PHARMACY"), ("^DIC", ["55", "0", "GL"], "^PS(55,"), ("^DD", ["2", "0"], "PATIENT"), ("^DD", ["2", ".01", "0"], "NAME^F^^0;1"), ("^DIC", ["2", "0", "GL"], "^DPT("),
]
STORES = [
    ("^PS(55,", ["7", "0"]), ("^PS(55,", ["8", "0"]), ("^PS(55,", ["7", "NT"]), ("^PS(55,", ["7", "5", "3", "0"]), ("^PS(55,", ["7", "5", "3", "D", "1", "0"]), ("^PS(55,", ["B", "NAME", "7"]), ("^PS(55,", ["7", "P", "1", "0"]), ("^PS(55,", ["7", "P", "2", "A"]), ("^PS(55,", ["7", "5", "3", "Q", "1"]), ("^PS(55,", ["AC", "7"]),
    ("^DPT(", ["7", "0"]), ("^DPT(", ["7.5", "0"]), ("^XYZ", ["7"]), ("^XYZ", ["8", "A"]), ("^XYZ", []),
]


@pytest.fixture(scope="module")
def got(spark):
    nodes = spark.createDataFrame(NODES, "root string, subs array<string>, value string")
    stores = spark.createDataFrame(STORES, "root string, subs array<string>")
    return {r.store: r for r in C.census(stores, nodes, D.record_type_facts(nodes)).collect()}


def test_partial(got):
    r = got["^PS(55"]
    assert (r.record_type, r.coverage, r.undeclared, r.undeclared_branches) == ("55", "partial", 3, "#,#,#,Q|#,P|AC")
    assert (r.record_count, r.depth, r.samples) == (4, 6, "#,#|#,#,#,#|#,#,#,D,#,#")


def test_full_and_none(got):
    assert (got["^DPT"].coverage, got["^DPT"].undeclared_branches, got["^DPT"].record_count) == ("full", "", 2)
    assert (got["^XYZ"].record_type, got["^XYZ"].coverage, got["^XYZ"].undeclared_branches, got["^XYZ"].branches) == (None, "none", "#", 2)


def test_types_that_hold_each_other_raise(spark):
    rows = [("^DD", ["5", "1", "0"], "A^5^^X;0"), ("^DIC", ["5", "0", "GL"], "^A(")]
    nodes = spark.createDataFrame(rows, "root string, subs array<string>, value string")
    with pytest.raises(RuntimeError):
        C.declared_paths(nodes, D.record_type_facts(nodes), max_depth=3)

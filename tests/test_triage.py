"""Rules that hold together, and what is left, on rows made by hand."""

import pytest
from pyspark.sql import functions as F

from corvane.operators import dictionary as D
from corvane.operators import triage as T
from corvane.operators.rules import Rule

SCHEMA = "id int, fire string, records int, fields int, print_templates int, input_templates int, forms int, xrefs array<string>, store_active boolean, owner string, prefix string, to_2 int, to_4 int, to_200 int, to_80 int, dated_subfiles int"


def rules():
    def rule(method, label, confidence, second=None):
        return Rule(method, F.array_contains(F.split("fire", ","), method), label, confidence, F.lit(f"because {method}"), second)

    return [rule("R1", "K", "high"), rule("R2", "P", "high"), rule("R3", "S", "low"), rule("R4", "I", "moderate", "P"), rule("R5", "I", "high"), rule("R6", "I", "moderate")]


def row(k, fire="", records=9, fields=9, templates=(0, 0, 0), xrefs=(), active=False, owner=None, to=(0, 0, 0, 0), dated=0):
    return (k, fire, records, fields, *templates, list(xrefs), active, owner, owner and owner[:2], *to, dated)


@pytest.fixture(scope="module")
def got(spark):
    rows = [
        row(1, "R3,R1"), row(2, "R1,R2,R3"), row(3, "R4"), row(4, "R4,R6"), row(5, "R5,R1,R2"),
        row(10, records=0, fields=4), row(11, records=0, fields=4, active=True), row(12, records=0, fields=4, xrefs=["B"]), row(13, records=0, fields=4, xrefs=["B", "C"]), row(14, records=0, fields=5), row(15, records=0, fields=1, templates=(0, 1, 0)), row(16, records=None, fields=None),
        row(20, owner="XX decided"), row(21, owner="YY open"), row(22, records=0, fields=1, owner="XX decided"),
        row(30, "R1,R5", to=(0, 1, 1, 0)), row(31, "R1,R5", to=(1, 0, 0, 1)), row(32, "R1,R5", xrefs=list("ABCDEFGH"), dated=1), row(33, "R1,R5", xrefs=list("ABCDEFGH")), row(34, "R1,R5", xrefs=list("ABCDEFGH"), dated=1, to=(0, 1, 0, 0)),
        row(40),
    ]
    decisions = spark.createDataFrame([("XX decided", "K")], "owner string, label string")
    return T.triaged(spark.createDataFrame(rows, SCHEMA), rules(), decisions)


@pytest.fixture(scope="module")
def by_id(got):
    return {r.id: r for r in got.collect()}


def test_conflicts_are_resolved_by_strength_and_sensitivity(by_id):
    assert (by_id[1].label, by_id[1].second, by_id[1].method, by_id[1].evidence, by_id[1].category) == ("K", None, "R1", "because R1", "matched")
    assert [f.method for f in by_id[1].fired] == ["R1", "R3"]
    assert (by_id[2].label, by_id[2].second, by_id[2].method, by_id[2].category) == ("P", "K", "R2", "D")
    assert (by_id[5].label, by_id[5].second, by_id[5].confidence) == ("P", "I", "high")


def test_a_rule_of_two_labels_gives_the_second(by_id):
    assert (by_id[3].label, by_id[3].second, by_id[3].category) == ("I", "P", "matched")
    assert (by_id[4].label, by_id[4].second) == ("I", "P")


def test_vestigial_types(by_id):
    assert {k for k, r in by_id.items() if r.category == "A"} == {10, 11, 12, 16, 22}
    assert (by_id[10].label, by_id[10].method, by_id[10].evidence) == ("S", "manual-vestigial", "record_count=0 field_count=4")
    assert (by_id[11].label, by_id[11].method) == (None, None)


def test_batches_by_group(by_id):
    assert (by_id[20].category, by_id[20].label, by_id[20].method, by_id[20].evidence) == ("B", "K", "manual-package", "package=XX")
    assert (by_id[21].category, by_id[21].label, by_id[21].method) == ("B", None, None)


def test_mixed_signals_with_an_answer(by_id):
    assert [(by_id[k].category, by_id[k].label, by_id[k].second) for k in (30, 31, 32, 33, 34)] == [("C", "I", None), ("C", "P", None), ("C", "P", None), ("D", "I", "K"), ("D", "I", "K")]
    assert by_id[30].evidence == "R1,R5"


def test_the_rest_is_unresolved_and_counts_add_up(got, by_id):
    assert {k for k, r in by_id.items() if r.label == "U"} == {13, 14, 15, 40} and by_id[40].method == "manual-unresolved"
    counts = {r.category: r.n for r in T.category_counts(got).collect()}
    assert counts == {"A": 5, "B": 2, "C": 3, "D": 4, "E": 4, "matched": 3, "all": 21}
    none = {r.category: (r.n, r.share) for r in T.category_counts(got.limit(0)).collect()}
    assert none == {c: (0, 0.0) for c in ("A", "B", "C", "D", "E", "matched", "all")}


def test_structure_of_a_dictionary(spark):
    rows = [
        ("^DD", ["5", "0"], "A"), ("^DD", ["5", ".01", "0"], "N^RF"), ("^DD", ["5", "1", "0"], "Date Entered^D"), ("^DD", ["5", "2", "0"], "S^S"), ("^DD", ["5", "3", "0"], "W^W"), ("^DD", ["5", "4", "0"], "C^Cm"), ("^DD", ["5", "5", "0"], "M^K"),
        ("^DD", ["5", "2", "AUDIT"], "y"), ("^DD", ["5", "3", "AUDIT"], ""), ("^DD", ["5", "2", "9"], "^"), ("^DD", ["5", "0", "DEL", "1"], ""), ("^DIC", ["5", "0"], "NAME^5^D"), ("^DIC", ["5", "0", "GL"], "^DPT(5,"), ("^DIC", ["5", "0", "LAYGO"], ""), ("^DIC", ["5", "0", "DEL"], "@"),
        ("^DD", ["5", ".01", "1", "1", "0"], "5^B"), ("^DD", ["5", "2", "1", "1", "0"], "5^B"), ("^DD", ["5", "2", "1", "2", "0"], "5^AX^TRIGGER^6^1"), ("^DD", ["6", "2", "1", "1", "0"], "6^^TRIGGER^5^1"),
        ("^DD", ["5.1", "0", "UP"], "5"), ("^DD", ["5.1", ".01", "0"], "D^RD"), ("^DD", ["5.11", "0", "UP"], "5.1"), ("^DD", ["6", "0"], "SIX"),
        ("^DIPT", ["1", "0"], "a^b^c^5"), ("^DIPT", ["2", "0"], "a^b^c^5"), ("^DIE", ["9", "0"], "a^b^c^6"), ("^DIST(.403", ["1", "0"], "a^^^^^^^5"),
        ("^DD", ["7", "1", "0"], "P^P6'"), ("^DD", ["8", "1", "0"], "P^P6'"), ("^DD", ["8", "2", "0"], "P^P6'"),
    ]
    nodes = spark.createDataFrame(rows, "root string, subs array<string>, value string")
    records = D.store_records(spark.createDataFrame([("^DPT(5", ["1"]), ("^DPT(5", ["2"])], "root string, subs array<string>"))
    labels = spark.createDataFrame([("7", "P"), ("8", "K")], "id string, label string")
    got = {r.id: r for r in D.structure_features(nodes, D.record_type_facts(nodes), records, labels).collect()}
    five = got["5"]
    assert (five.fields, five.audited, five.word_fields, five.computed, round(five.set_share, 4), five.records, five.store_active, five.dinum) == (6, 1, 1, 1, 0.1667, 2, True, True)
    assert (five.created, five.no_delete, five.no_write, five.open_laygo, five.delete_access, five.write_access, five.is_subfile) == (True, True, True, True, "@", "", False)
    assert (five.depth, five.dated_subfiles, sorted(five.xrefs), five.trigger_to_p, five.print_templates, five.input_templates, five.forms) == (2, 1, ["AX", "B"], False, 2, 0, 1)
    assert got["5.1"].first_is_date and got["5.1"].is_subfile and got["5.1"].depth == 0
    assert got["6"].trigger_to_p and got["6"].input_templates == 1 and got["6"].p_referrers == 0.5 and got["6"].set_share == 0.0 and not got["6"].no_write

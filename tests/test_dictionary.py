"""A small dictionary read by hand."""

import pytest

from corvane.operators import dictionary as D

ROWS = [
    ("^DD", ["2", "0"], "PATIENT FIELD^^.3^3"), ("^DD", ["2", ".01", "0"], "NAME^RF^^0;1"), ("^DD", ["2", "B", "NAME", ".01"], ""),
    ("^DD", ["50", "0"], "DRUG FIELD^^^12x"), ("^DD", ["50", ".01", "0"], "NAME^F"), ("^DD", ["50", "3", "0"], "WARD^P42'"), ("^DD", ["50", "20", "0"], "WHO^P200'"), ("^DD", ["50", "4", "0"], "NOTE^Px"),
    ("^DD", ["50.1", "0"], "SUB FIELD^^^"), ("^DD", ["50.1", "0", "UP"], "50"), ("^DD", ["50.1", "3", "0"], "FIRST^RP2'"), ("^DD", ["50.1", "12", "0"], "SECOND^*P02'"), ("^DD", ["50.1", ".5", "0"], "EARLY^P2'"),
    ("^DD", ["50.12", "0", "UP"], "50.1"), ("^DD", ["50.12", ".01", "0"], "D^D"),
    ("^DD", ["42", "0", "PT", "50", "3"], ""), ("^DD", ["42", "0", "PT", "50", "4"], ""), ("^DD", ["42", "0", "PT", "61", "1"], ""), ("^DD", ["42", "0", "PT"], ""),
    ("^DD", ["61", "1", "0"], "AT^P40.8'"), ("^DD", ["61", "x", "0"], "no field^P2'"), ("^DD", ["B", "NAME", "2"], ""), ("^DD", ["007", "0"], "no number"), ("^DD", [], ""),
    ("^DIC", ["2", "0"], "PATIENT^2I^ID"), ("^DIC", ["2", "0", "GL"], "^DPT("), ("^DIC", ["50", "0"], "DRUG\tNAME^50^I"), ("^DIC", ["50", "0", "GL"], "^DGXY(50,"), ("^DIC", ["99", "0"], "no type"), ("^DIC", ["B", "PATIENT", "2"], ""),
    ("^DIC(9.4", ["7", "0"], "SECOND^DG"), ("^DIC(9.4", ["10", "0"], "LONG^DGX"), ("^DIC(9.4", ["3", "0"], "FIRST^DGX"), ("^DIC(9.4", ["4", "0"], "NONE^"), ("^DIC(9.4", ["B", "LONG", "10"], ""),
]


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame(ROWS, "root string, subs array<string>, value string").repartition(3)


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_facts(nodes):
    facts = by(D.record_type_facts(nodes), "id")
    assert set(facts) == {"2", "50", "50.1", "50.12", "42", "61"}
    drug = facts["50"]
    assert (drug["name"], drug["root"], drug["field_count"], drug["ptr_out"], drug["p_fields"], drug["to_200"], drug["dinum"]) == ("DRUG\tNAME", "^DGXY(50,", 12, 2, 3, 1, "N")
    sub = facts["50.1"]
    assert (sub["parent"], sub["to_2"], sub["last_to_2"], sub["dinum"], sub["field_count"]) == ("50", 3, "12 SECOND", "", 0)
    assert facts["42"]["ptr_in"] == 2 and facts["42"]["name"] == "" and facts["2"]["dinum"] == "Y" and facts["2"]["parent"] is None
    assert facts["61"]["ptr_out"] == 1 and facts["61"]["to_2"] == 0


def test_targets_stop_at_points_by_default(nodes):
    assert {r.target for r in D.fields(nodes).where("id = '61'").collect()} == {"40"}
    assert {r.target for r in D.fields(nodes, decimals=True).where("id = '61'").collect()} == {"40.8"}


def test_owner_is_the_first_group_of_the_longest_prefix(nodes):
    features = by(D.record_type_features(D.record_type_facts(nodes), D.groups(nodes)), "id")
    assert (features["50"]["prefix"], features["50"]["owner"]) == ("DGX", "FIRST") and features["2"]["prefix"] is None and features["50.1"]["prefix"] is None
    assert features["50"]["number"] == "50"


def test_inventory_inherits_roots_and_counts_records(spark, nodes):
    stores = spark.createDataFrame([("^DPT", [str(k), "0"]) for k in range(5)] + [("^DPT", ["1", "1"]), ("^DGXY(50", ["9", "0"])], "root string, subs array<string>")
    got = by(D.inventory(D.record_type_facts(nodes), D.store_records(stores)), "file_number")
    assert got["2"]["record_count"] == 5 and got["50"]["record_count"] == 1 and got["42"]["record_count"] == 0
    assert got["50.12"]["global_root"] == "^DGXY(50," and got["50.12"]["record_count"] is None and got["50.12"]["parent_file"] == "50.1" and got["42"]["global_root"] == ""
    assert got["50"]["file_name"] == "DRUG NAME" and got["50"]["pointer_out"] == 3


def test_many_records_stop_at_the_limit(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_RECORDS", 3)
    stores = spark.createDataFrame([("^A", [str(k)]) for k in range(9)], "root string, subs array<string>")
    assert [tuple(r) for r in D.store_records(stores).collect()] == [("^A", 3)]


def test_referrers_are_in_numeric_order(spark):
    rows = [("^DD", [k, ".01", "0"], "X^P7'") for k in ("10", "9", "9.5")] + [("^DD", ["9", "1", "0"], "Y^P30'"), ("^DD", ["9", "2", "0"], "Z^P30'")]
    got = by(D.referrers(spark.createDataFrame(rows, "root string, subs array<string>, value string")), "id")
    assert got["7"]["pointer_in_files"] == "9|9.5|10" and got["9"]["pointer_out_files"] == "7|30" and got["7"]["pointer_out_files"] == ""


def test_nodes_in_labels_out(nodes):
    got = by(D.classified_dictionary(nodes), "id")
    assert (got["2"]["method"], got["2"]["evidence"]) == ("H-01", "global=^DPT(")
    assert (got["50"]["label"], got["50"]["method"]) == ("I", "H-09")
    assert (got["50.1"]["method"], got["50.1"]["evidence"]) == ("H-06", "field=12 SECOND points to file 2")
    assert (got["50.12"]["label"], got["50.12"]["evidence"]) == ("P", "inherits from 50.1")
    assert got["42"]["label"] is None and got["61"]["label"] is None


def test_wide_export_has_22_columns_and_types_without_fields(spark, nodes):
    records = D.store_records(spark.createDataFrame([("^DPT", ["1"])], "root string, subs array<string>"))
    got = D.wide_export(nodes, D.classified_dictionary(nodes), records)
    assert len(got.columns) == 22 and got.columns[21] == "sensitivity_flag" and got.columns[0] == "file_number"
    rows = {(r.file_number, r.field_number): r for r in got.collect()}
    assert ("42", "") in rows and ("50", ".01") in rows and len(rows) == 11
    cross = rows["50.1", "3"]
    assert (cross.field_piks, cross.ref_piks, cross.cross_piks, cross.pointer_target, cross.record_count, cross.volume) == ("P", "P", "", "2", None, "")
    assert rows["50", ".01"].sensitivity_flag == "Y" and rows["2", ".01"].sensitivity_flag == "" and rows["2", ".01"].volume == "reference"


def test_an_empty_dictionary(spark):
    none = spark.createDataFrame([], "root string, subs array<string>, value string")
    assert D.classified_dictionary(none).collect() == [] and D.referrers(none).collect() == []


def test_estimates_do_not_grow_with_the_rounds(spark):
    from corvane.operators import graph as G

    tree = spark.range(600).selectExpr("id", "case when id > 0 then id - 1 end as parent")
    found = G.nearest_labelled(tree, spark.range(1).selectExpr("id", "'x' as label"))
    assert int(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 1 << 60
    assert found.count() == 600


def test_fields_that_point_nowhere_are_dealt_out(spark):
    from corvane.operators import rules as R

    types = spark.createDataFrame([("1", "P"), ("2", "K"), ("", "S")], "record string, label string")
    fields = spark.createDataFrame([("1", ".01", "A", "F", ""), ("1", "2", "B", "P2'", "2"), ("2", "3", "C", "F", None), ("2", "4", "D", "P9'", "9")], "record string, field string, name string, spec string, target string")
    told = R.field_labels(fields, types)
    assert {(r.field, r.own, r.ref_label, r.cross) for r in told.collect()} == {(".01", "P", None, ""), ("2", "P", "K", "Y"), ("3", "K", None, ""), ("4", "K", None, "")}

"""Operators on small tables with known answers."""

import random

import pytest
from pyspark.sql import functions as F

from corvane.operators import edges as E
from corvane.operators import graph as G
from corvane.operators import incremental as I
from corvane.operators import joins as J
from corvane.operators import profile as P
from corvane.functions import text as X
from corvane.operators import rules as R
from corvane.operators import views as V
from corvane.sources import corpus, nodes, tables


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_text_and_store_edges(spark):
    units = table(spark, [("A", 'A ;x\n D EN^B,^C\n S X=$$F^B(1)+^DPT(0)\n D EN^B ; D ^Z\n S Y="^DPT(1"'), ("B", None)], "unit string, text string")
    lines = corpus.lines(units)
    assert {tuple(r) for r in E.text_edges(lines, ["unit"]).collect()} == {("A", "EN", "B", "do", 2), ("A", "F", "B", "func", 1)}
    assert {tuple(r) for r in E.store_edges(lines, ["unit"]).collect()} == {("A", "DPT", 1)}


def test_override_last_row_wins(spark):
    auto = table(spark, [("107.3", "P", 1), ("2", "S", 2), ("9", "K", 3)], "k string, label string, seq int")
    manual = table(spark, [("107.3", "I", 1), ("107.3", "K", 2)], "k string, label string, seq int")
    assert dict(r[:2] for r in J.override([auto, manual], "k", "seq").select("k", "label").collect()) == {"107.3": "K", "2": "S", "9": "K"}


def test_agreement_of_empty_sides(spark):
    a = table(spark, [(1, "x"), (1, "y"), (2, "x"), (1, "x")], "k int, i string")
    b = table(spark, [(1, "x"), (3, "z")], "k int, i string")
    got = {r.k: (r.n_match, r.left_only, r.right_only, r.ratio) for r in J.agreement(a, b, "k", "i").collect()}
    assert got == {1: (1, 1, 0, 0.5), 2: (0, 1, 0, 0.0), 3: (0, 0, 1, 0.0)}


def test_longest_prefix_and_ties(spark):
    names = table(spark, [("PSOX",), ("PS",), ("Q",), (None,)], "n string")
    prefixes = table(spark, [("PS", 1), ("PSO", 3), ("PSO", 2), ("P", 9)], "p string, o int")
    got = {r.n: (r.prefix, r.owner) for r in J.longest_prefix(names, "n", prefixes, "p", "o").collect()}
    assert got == {"PSOX": ("PSO", 2), "PS": ("PS", 1), "Q": (None, None), None: (None, None)}


def random_forest(seed, n):
    rng = random.Random(seed)
    parent = {k: rng.randrange(k) if k and rng.random() < 0.9 else None for k in range(n)}
    return parent, {k: rng.choice("PIKS") for k in range(n) if rng.random() < 0.2}


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_and_top_ancestor(spark, seed):
    parent, labels = random_forest(seed, 150)
    tree = table(spark, list(parent.items()), "id bigint, parent bigint")
    got = {r.id: (r.label, r.from_id, r.depth) for r in G.nearest_labelled(tree, table(spark, list(labels.items()), "id bigint, label string")).collect()}
    want, tops = {}, {}
    for k in parent:
        at, depth = k, 0
        while at is not None and at not in labels:
            at, depth = parent[at], depth + 1
        if at is not None:
            want[k] = (labels[at], at, depth)
        top = k
        while parent[top] is not None:
            top = parent[top]
        tops[k] = top
    assert got == want
    assert {r.id: r.top for r in G.top_ancestor(tree).collect()} == tops


def test_propagation_rules(spark):
    nodes_ = table(spark, [(k,) for k in range(11)], "id bigint")
    seeds = table(spark, [(0, "P"), (1, "I"), (2, "K"), (3, "K")], "id bigint, label string")
    edges = table(spark, [(4, 0), (4, 1), (4, 2), (5, 0), (5, 0), (6, 2), (6, 3), (7, 5), (7, 0), (8, 0), (8, 1), (10, 0)], "id bigint, target bigint")
    got = {r.id: (r.label, r.method, r.round, r.confidence, r.evidence) for r in G.propagate(nodes_, edges, seeds, "P", "K").collect()}
    assert got[4] == ("P", "H-38", 1, "moderate", "targets span 3 PIKS categories") and got[5] == ("P", "H-36", 1, "moderate", "2/2 targets classified P")
    assert got[6] == ("K", "H-40", 1, "moderate", "2 targets all classified K") and got[7] == ("P", "H-36", 2, "moderate", "2/2 targets classified P")
    assert got[9] == ("S", "H-39", 1, "moderate", "orphan: 0 ptrs in, 0 ptrs out")
    assert 8 not in got and 10 not in got  # a tie, and a single labelled target


def test_deep_chains_and_cycles(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(G, "cut", lambda df: calls.append(1) or df.checkpoint())
    chain = [(k, k - 1 if k else None) for k in range(1000)]
    odd = [(2000, 2001), (2001, 2000), (2002, 2001), (2003, 2003), (2004, 2005), (2005, 2006), (2006, 2005), (2007, 9999)]
    tree = table(spark, chain + odd, "id bigint, parent bigint")
    labels = table(spark, [(0, "x"), (500, "y"), (2006, "z"), (9999, "no node")], "id bigint, label string")
    got = {r.id: (r.label, r.from_id, r.depth) for r in G.nearest_labelled(tree, labels).collect()}
    want = {k: ("y", 500, k - 500) if k >= 500 else ("x", 0, k) for k in range(1000)}
    assert got == want | {2004: ("z", 2006, 2), 2005: ("z", 2006, 1), 2006: ("z", 2006, 0)} and len(calls) <= 12
    tops = {r.id: r.top for r in G.top_ancestor(tree).collect()}
    assert tops == {k: 0 for k in range(1000)} | {k: None for k in (2000, 2001, 2002, 2004, 2005, 2006)} | {2003: 2003, 2007: 2007}


def test_reachability_depths(spark):
    edges = table(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)], "source bigint, target bigint")
    got = {(r.node, r.depth) for r in G.reachable(edges, table(spark, [(1,)], "node bigint"), 3).collect()}
    assert got == {(1, 0), (2, 1), (3, 2), (4, 3)}


def test_record_type_cascade(spark):
    rows = [
        ("2", "PATIENT", "^DPT(", 0, 0, 0, None, None, None, 0, 0), ("1.5", "X", "^Q(", 0, 0, 0, None, None, None, 0, 0), ("4", "INST", "^DIC(4,", 0, 0, 0, None, None, None, 0, 0),
        ("500", "A", "^A(", 2, 1, 1, ".03 WHO", None, None, 0, 0), ("501", "A", "^A(", 0, 1, 1, None, None, None, 0, 0), ("502", "A", "^A(", 0, 0, 1, None, None, None, 0, 0),
        ("503", "A", "^PSDRUG(", 0, 0, 0, None, None, None, 0, 0), ("504", "A", "^ZZ(", 0, 0, 0, None, "DG", "REGISTRATION", 0, 0), ("505", "A", "^ZZ(", 0, 0, 0, None, None, None, 12, 1),
        ("506", "VISIT TYPE", "^ZZ(", 0, 0, 0, None, None, None, 0, 0), ("507", "NOTHING", "^ZZ(", 0, 0, 0, None, None, None, 0, 0),
    ]
    frame = table(spark, rows, "number string, name string, root string, to_2 int, to_4 int, to_200 int, last_to_2 string, prefix string, owner string, ptr_in int, ptr_out int")
    got = {r.number: (r.label, r.method, r.confidence) for r in R.labelled(frame, R.record_type_rules()).collect()}
    assert got["2"] == ("P", "H-01", "certain") and got["1.5"] == ("S", "H-02", "certain") and got["4"] == ("I", "H-04", "certain")
    assert got["500"] == ("P", "H-06", "high") and got["501"] == ("I", "H-08", "high") and got["502"] == ("I", "H-09", "low")
    assert got["503"] == ("K", "H-12", "high") and got["504"] == ("P", "H-14", "moderate") and got["505"] == ("K", "H-18", "moderate")
    assert got["506"] == ("K", "H-20", "low") and got["507"] == (None, None, None)


def test_specified_rules_compile(spark):
    kinds = {
        "records": "int", "ptr_in": "int", "ptr_out": "int", "audited": "int", "first_is_date": "boolean", "is_subfile": "boolean", "no_delete": "boolean", "created": "boolean", "no_write": "boolean",
        "depth": "int", "word_fields": "int", "set_share": "double", "fields": "int", "dinum": "boolean", "computed": "int", "p_referrers": "double", "xrefs": "array<string>", "trigger_to_p": "boolean",
        "write_access": "string", "delete_access": "string", "open_laygo": "boolean", "number": "string", "print_templates": "int", "input_templates": "int", "forms": "int",
    }
    blank = {"int": 1, "boolean": False, "double": 0.0, "string": "", "array<string>": ["B", "C"]}
    row = {k: blank[v] for k, v in kinds.items()} | {"number": "500", "records": 900, "forms": 0, "xrefs": ["B", "DFN"]}
    frame = table(spark, [tuple(row[k] for k in kinds)], ", ".join(f"{k} {v}" for k, v in kinds.items()))
    assert R.labelled(frame, R.specified_rules()).head().method == "H-41"
    stores = table(spark, [("TMPX", False, False, False, 0, None), ("%ZQ", False, False, False, 0, None), ("AB", False, False, False, 1, "K"), ("AB", True, True, False, 1, "K")], "store string, patient_namespace boolean, patient_subscripts boolean, partial_patient boolean, referrer_groups int, referrer_label string")
    assert sorted(r.method for r in R.labelled(stores, R.store_rules()).collect()) == ["G-01", "G-03", "G-04", "G-05"]


def test_inherited_labels(spark):
    types = table(spark, [(1, None, "P", "H-01", "certain", "e"), (2, 1, "K", "H-20", "low", "n"), (3, 2, None, None, None, None)], "id int, parent int, label string, method string, confidence string, evidence string")
    got = {r.id: (r.label, r.method, r.confidence, r.evidence) for r in R.inherited(types).collect()}
    assert got == {1: ("P", "H-01", "certain", "e"), 2: ("P", "H-05", "certain", "inherits from 1"), 3: ("P", "H-05", "certain", "inherits from 2")}


@pytest.mark.parametrize("seed", [3, 4])
def test_inheritance_equals_the_pass_from_the_top(spark, seed):
    parent, labels = random_forest(seed, 200)
    rng = random.Random(seed)
    strength = {k: rng.choice(["certain", "high", "moderate", "low"]) for k in labels}
    rows = [(k, p, labels.get(k), "H-x" if k in labels else None, strength.get(k), "e" if k in labels else None) for k, p in parent.items()]
    want = {}
    for k in sorted(parent):  # parents come before their children
        over = want[parent[k]][0] if parent[k] is not None else None
        weak = over is not None and strength.get(k) not in ("certain", "high")
        want[k] = (over, "H-05", "certain", f"inherits from {parent[k]}") if weak else (labels.get(k), *rows[k][3:])
    types = table(spark, rows, "id bigint, parent bigint, label string, method string, confidence string, evidence string")
    assert {r.id: (r.label, r.method, r.confidence, r.evidence) for r in R.inherited(types).collect()} == want


def test_structural_labels_need_no_documentation(spark):
    lines = table(spark, [("u", k + 1, x) for k, x in enumerate(["A ;x", "STARTUP Q", "SHUTDOWN Q", "RUN Q"])], "unit string, line_no int, line string")
    line = F.col("line")
    found = P.undocumented_labels(lines, "unit", "line_no", line.rlike("^[A-Z]"), line.rlike("^ *;"), line.contains("@doc"), line.contains("@doc"), X.structural_label(line))
    assert [r.line_no for r in found.collect()] == [4]


def test_budget_over_many_ranges(spark):
    rng = random.Random(6)
    rows = [(rng.choice("aab"), k, rng.randrange(20)) for k in range(600)] + [(None, 1, 5), ("c", 1, None), ("c", 2, 3)]
    got = {(r.g, r.r, r.used) for r in P.within_budget(table(spark, rows, "g string, r int, s int").repartition(5), "g", [F.col("r")], F.col("s"), 700).collect()}
    want = set()
    for g in ("a", "b", "c", None):
        used = 0
        for _, r, s in sorted((x for x in rows if x[0] == g), key=lambda x: x[1]):
            used += s or 0
            if used > 700:
                break
            want.add((g, r, used))
    assert got == want


def test_names_of_pointers_and_ambiguous_queries(spark):
    types = table(spark, [("2", "PATIENT"), ("4", "SITE")], "record string, name string")
    fields = table(spark, [("2", ".1", "A", "POINTER", "4"), ("2", ".2", "B", "POINTER", "9"), ("7", ".1", "C", "POINTER", "2"), ("2", ".3", "D", "FREE-TEXT", "")], "record string, field string, name string, data_type string, target string")
    labels = table(spark, [("2", "P")], "record string, piks string")
    got = {(r.record, r.section, r["rank"], r.item, r.name) for r in V.record_cards(types, fields, labels, ["name"]).collect()}
    assert {("2", "out", 2, "9", "(unknown)"), ("2", "in", 1, "7", "(unknown)"), ("4", "in", 1, "2", "PATIENT"), ("2", "attribute", 2, "piks", "P"), ("2", "field", 1, ".1", "A  POINTER -> #4")} <= got
    names = table(spark, [("Alpha",), ("ALPHA",), ("Beta",), ("Betamax",)], "n string")
    members = table(spark, [("XUA", "g"), ("XUB", "g"), ("XUC", "h"), ("ZZ", "h")], "m string, g string")
    asked = table(spark, [("Alpha",), ("alpha",), ("beta",), ("max",), ("xu",), ("none",), ("",), (None,)], "q string")
    found = {(r.query, r.tier, r.name, r.n) for r in J.resolved(asked, "q", names, "n", members, "m", "g").collect()}
    assert found == {("Alpha", 1, "Alpha", 1), ("alpha", 3, "Alpha", 2), ("alpha", 3, "ALPHA", 2), ("beta", 2, "Beta", 1), ("max", 3, "Betamax", 1), ("xu", 4, "g", 1)}


def test_doc_rule(spark):
    text = ["A ;x", "EN ; no marker", " ;; @doc", " ; more", "T1 Q", "T2 Q ; @doc", " ; @doc", " Q", "T3 Q"]
    lines = table(spark, [("u", k + 1, x) for k, x in enumerate(text)], "unit string, line_no int, line string")
    line = F.col("line")
    found = P.undocumented_labels(lines, "unit", "line_no", line.rlike("^[A-Z]"), line.rlike("^ *;"), line.contains("@doc"), line.contains("@doc"))
    assert sorted(r.line_no for r in found.collect()) == [2, 9]


def test_line_rules_and_budget(spark):
    lines = table(spark, [(1, " H"), (2, "a\tb "), (3, "x" * 246), (4, " S X=1 HALT ; c"), (5, " ; HALT")], "n int, line string")
    got = {(r.n, r.rule) for r in P.violations(lines, ["n"], P.line_rules(F.col("line"))).collect()}
    assert got == {(1, "F-halt"), (2, "W-tab"), (2, "W-trailing"), (3, "W-length"), (4, "F-halt")}
    rows = table(spark, [("g", k, s) for k, s in enumerate([50, 40, 30, 5])], "g string, r int, s int")
    assert sorted(r.r for r in P.within_budget(rows, "g", [F.col("r")], F.col("s"), 100).collect()) == [0, 1]


def test_incremental(spark):
    old = table(spark, [(1, "P", "manual"), (2, "K", "H-20"), (3, None, None), (4, "S", "H-01"), (5, "I", "H-02")], "k int, label string, method string")
    new = table(spark, [(1, "K", "H-20"), (2, "S", "H-10"), (3, "P", "H-06"), (5, "I", "H-02"), (6, "K", "H-12"), (7, None, None)], "k int, label string, method string")
    merged = I.merged(old, new, "k")
    got = {r.k: (r.label, r.scenario) for r in merged.collect()}
    assert got == {1: ("P", "kept manual"), 2: ("S", "relabelled"), 3: ("P", "newly labelled"), 4: ("S", "retired"), 5: ("I", "same"), 6: ("K", "added"), 7: (None, "added")}
    again = {r.k: r.label for r in I.merged(merged.drop("scenario"), new, "k").collect()}
    assert again == {k: v[0] for k, v in got.items()}
    assert tuple(I.run_log(merged, "full").head()) == ("full", 7, 4, 2, 1)


def test_registries_from_nodes(spark):
    rows = [
        ("^DIC(19", ["7", "0"], "XUMAIN^Main menu^x^R^^^^^^^^3"), ("^DIC(19", ["7", "25"], "EN^XUS"), ("^DIC(19", ["8", "0"], "B^b"), ("^DIC(19", ["8", "10", "1"], "z"), ("^DIC(19", ["B", "x", "7"], ""),
        ("^ORD", ["1", "0"], "P^i^^A"), ("^ORD", ["1", "20"], "D ^A\tx\n"),
    ]
    tree = table(spark, rows, "root string, subs array<string>, value string")
    groups = table(spark, [(3, "KERNEL")], "ien bigint, name string")
    got = {r.ien: (r.name, r.type, r.package, r.tag, r.routine) for r in nodes.options(tree, "^DIC(19", groups).collect()}
    assert got == {7: ("XUMAIN", "R", "KERNEL", "EN", "XUS"), 8: ("B", "", "", "", "")}
    assert nodes.registry(tree, "^ORD", nodes.PROTOCOLS_101).head().entry_action == "D ^A x"


def test_record_types_and_analysis(spark):
    rows = [
        ("^DD", ["2", "0"], "PATIENT^x"), ("^DD", ["2", ".01", "0"], "NAME^RF^"), ("^DD", ["2", ".02", "0"], "WARD^P42'^"), ("^DD", ["42", "0"], "WARD"), ("^DD", ["42", ".01", "0"], "N^F"),
        ("^DD", ["2.1", "0"], "SUB"), ("^DD", ["2.1", "0", "UP"], "2"),
    ]
    got = {r.file_number: (r.field_count, r.pointer_out, r.pointer_in, r.parent_file) for r in nodes.record_types(table(spark, rows, "root string, subs array<string>, value string"), table(spark, [("2", 9)], "file_number string, record_count bigint")).collect()}
    assert got == {"2": (2, 1, 0, ""), "42": (1, 0, 1, ""), "2.1": (0, 0, 0, "2")}
    results = table(spark, [("U", [("l", "t", "F - x")], {"R": ["b", "a"]}, {"T": "d"})], "unit string, errors array<struct<line: string, tag: string, text: string>>, xrefs map<string, array<string>>, tags map<string, string>")
    out = nodes.analysis(results)
    assert out["xrefs"].head().location_list == "a,b" and out["errors"].count() == 1 and out["tags"].head().data == "d" and out["units"].head().error_count == 1


def test_tab_separated_dialects(spark, tmp_path):
    rows = table(spark, [(2, 'say "hi"', None), (1, '"open', "x")], "k int, a string, b string")
    for dialect in ("csv", "raw"):
        path = f"file://{tmp_path}/{dialect}"
        tables.write_table(rows, path, ["k"], dialect)
        assert [tuple(r) for r in tables.read_table(spark, path, "k int, a string, b string", dialect).orderBy("k").collect()] == [(1, '"open', "x"), (2, 'say "hi"', None)]
    (tmp_path / "short.tsv").write_text('k\ta\tb\n1\t"open\n\n2\tx\ty\n')
    got = tables.read_table(spark, f"file://{tmp_path}/short.tsv", "k int, a string, b string", "raw").orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, '"open', None), (2, "x", "y")]
    assert tables.read_table(spark, f"file://{tmp_path}/none.tsv", "k int", missing_ok=True).count() == 0


def test_corpus_from_files(spark, tmp_path):
    folder = tmp_path / "Packages" / "Kernel" / "Routines"
    folder.mkdir(parents=True)
    (folder / "XUS.m").write_bytes(b"XUS ;x\n ;;8.0;KERNEL;**1,2**;\nEN Q\n\xff")
    (folder / "Z.m").write_bytes(b"")
    (folder / "_ZIS.m").write_bytes(b"%ZIS ;y\n Q\n")
    (folder / "_E.m").write_bytes(b"")
    units = corpus.read_units(spark, f"file://{tmp_path}", root=str(tmp_path), new_root="/corpus")
    got = {r.unit: (r.grp, r.line_count, r.tag_count, r.version_line, r.is_percent) for r in corpus.inventory(units).collect()}
    assert got["XUS"] == ("Kernel", 4, 2, ";;8.0;KERNEL;**1,2**;", "N") and got["Z"] == ("Kernel", 0, 0, "", "N")
    assert got["_ZIS"][1] == 2 and got["_ZIS"][4] == "Y" and got["_E"] == ("Kernel", 0, 0, "", "Y") and len(got) == 4
    assert {r.path for r in units.collect()} == {f"/corpus/Packages/Kernel/Routines/{n}.m" for n in ("XUS", "Z", "_ZIS", "_E")}
    data = tmp_path / "Packages" / "Kernel" / "Globals"
    data.mkdir()
    (data / "3.5+DEVICE.zwr").write_text("12345")
    (data / "80-3+ICD DIAGNOSIS.zwr").write_text("")
    (data / "PRCA.zwr").write_text("1")
    files = {r.name: (r.grp, r.byte_size, r.kind, r.number, r.chunk, r.entity) for r in corpus.list_files(spark, f"file://{tmp_path}").collect()}
    assert files == {
        "3.5+DEVICE.zwr": ("Kernel", 5, "file", "3.5", "", "DEVICE"), "80-3+ICD DIAGNOSIS.zwr": ("Kernel", 0, "file", "80", "3", "ICD DIAGNOSIS"), "PRCA.zwr": ("Kernel", 1, "global", "", "", "PRCA"),
    }
    manifest = table(spark, [("XUS", "Kernel"), ("XUS", "Other"), ("GONE", "Kernel"), ("_ZIS", "Kernel"), ("_E", "Kernel")], "unit string, grp string")
    assert {tuple(x) for x in corpus.unit_contract(manifest, units).collect()} == {("several groups", "XUS"), ("missing file", "GONE"), ("not listed", "Z")}
    assert corpus.read_units(spark, f"file://{data}").count() == 0


def test_tokens_resolve_in_order(spark):
    lines = table(spark, [(1, " D EN^XUS S X=^DPT(1)+^XUS,Y=^QQ")], "n int, line string")
    got = {(r.token, r.kind) for r in J.resolved_tokens(lines, ["n"], "line", table(spark, [("XUS",)], "unit string"), table(spark, [("DPT",)], "store string")).collect()}
    assert ("XUS", "tag call") in got and ("DPT", "store") in got and ("QQ", "unknown") in got


def test_small_measures(spark):
    rows = table(spark, [("g", "ABCD"), ("g", "ABCE"), ("g", "AX"), ("h", "Q")], "g string, n string")
    assert {(r.g, r.prefix) for r in P.dominant_prefix(rows, "g", "n", [2, 3, 4], 0.5).collect()} == {("g", "ABC")}
    assert {(r.k0, r.n) for r in P.histogram(table(spark, [("",), (None,), ("a",)], "x string"), [F.col("x")]).collect()} == {("(empty)", 2), ("a", 1)}
    empty = E.coupling(table(spark, [], "source_group int, dest_group int, edge_count bigint")).head()
    assert (empty.intra, empty.inter, empty.inter_share) == (0, 0, None)
    assert I.triage(table(spark, [(0, 0, 1), (5, 0, 9), (5, 3, 1)], "records int, refs int, prefix_size int")).select("bucket").collect()[0].bucket == "vestigial"
    pairs = table(spark, [(1, 2)], "source int, target int")
    assert E.skipped_targets(pairs, table(spark, [(1, 1)], "node int, grp int")).head().node == 2


def test_fill_blank_with_any_names_and_repeated_keys(spark):
    left = spark.createDataFrame([(1, "", "x", 7), (2, "kept", None, 8), (3, None, "", 9), (None, "", "y", 10)], "id int, c string, __c string, v int")
    right = spark.createDataFrame([(1, "a", "q", 0), (1, "b", "p", 0), (3, "d", "e", 0), (None, "no", "no", 0)], "id int, c string, __c string, v int")
    got = {tuple(r) for r in J.fill_blank(left, right, "id", ["c", "__c"]).select("id", "v", "c", "__c").collect()}
    assert got == {(1, 7, "b", "x"), (2, 8, "kept", None), (3, 9, "d", "e"), (None, 10, None, "y")}


def test_discarding_scratch_takes_checkpoints_along(spark):
    from pathlib import Path

    from corvane.session import cut, discard_scratch, scratch

    cut(spark.range(5))
    spark.range(5).write.parquet(path := scratch(spark, "x"))
    top = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    assert list(top.iterdir())
    discard_scratch(spark)
    assert not list(top.iterdir()) and not Path(path.removeprefix("file://")).exists()
    assert cut(spark.range(3)).count() == 3


def test_only_small_tables_are_dealt_out(spark, sf, monkeypatch):
    from corvane import session

    table = spark.read.parquet(f"{sf}/documents.parquet")
    assert session.spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "SPREAD_BYTES", 10)
    assert session.spread(table) is table

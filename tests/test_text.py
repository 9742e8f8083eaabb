"""Text expressions on the pinned lines, and their properties on random ones."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.sources import corpus

PINNED = [
    ("EN D EN^DIQ,A^R2", [("EN", "DIQ", "do")], []),
    (" S X=$$GET1^DIQ(2,DFN,.01) ; D ^XX", [("GET1", "DIQ", "func")], []),
    (" G:X>1 END^XUS", [("END", "XUS", "goto")], []),
    (' S Y="D ^FAKE" D ^REAL', [("", "REAL", "do")], []),
    (' S Y="a""b;c" D ^R1', [("", "R1", "do")], []),
    (' S Y="open ^DPT(1', [], []),
    (' S X=^DPT(DFN,0),Z=+^%ZOSF("TEST")', [], ["DPT", "%ZOSF"]),
    (" D ^ROU(1)", [("", "ROU", "do")], ["ROU"]),
    (" K ^FOO", [], []),
    (" D TAG+3^ROU", [], []),
    (" d EN^LOW", [], []),
    (" JOB ^TASK", [("", "TASK", "job")], []),
    (" D  EN^A D EN^A", [("EN", "A", "do"), ("EN", "A", "do")], []),
    (" D 1^NUM", [], []),
    (' I $T(+2^IBX)["9" Q', [], []),
    (" D:$$F^P  EN^B G:X^Y ^C", [("EN", "B", "do"), ("", "C", "goto"), ("F", "P", "func")], []),
]


def test_pinned_lines(spark):
    frame = spark.createDataFrame([(k, line) for k, (line, _, _) in enumerate(PINNED)], "k int, line string")
    clean = X.without_literals(F.col("line"))
    for r in frame.select("k", X.all_references(clean).alias("calls"), X.store_references(clean).alias("stores")).collect():
        assert [tuple(c) for c in r.calls] == PINNED[r.k][1] and r.stores == PINNED[r.k][2], PINNED[r.k]


def test_every_argument(spark):
    frame = spark.createDataFrame([("EN D EN^DIQ,A^R2 G ^X",)], "line string")
    calls = frame.select(X.call_references(F.col("line"), every_argument=True).alias("c")).head().c
    assert [tuple(c) for c in calls] == [("EN", "DIQ", "do"), ("A", "R2", "do"), ("", "X", "goto")]


def stripped(line):
    out, k = [], 0
    while k < len(line):
        c = line[k]
        if c == '"':
            k += 1
            while k < len(line):
                if line[k] == '"':
                    if line[k + 1 : k + 2] == '"':
                        k += 2
                        continue
                    break
                k += 1
            k += 1
        elif c == ";":
            break
        else:
            out.append(c)
            k += 1
    return "".join(out)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='ab";^ D', max_size=30), min_size=20, max_size=60))
def test_literals_and_comments_as_a_state_machine(spark, lines):
    frame = spark.createDataFrame([(x,) for x in lines], "line string")
    assert all(r.c == stripped(r.line) for r in frame.select("line", X.without_literals(F.col("line")).alias("c")).collect())


def test_long_literal(spark):
    frame = spark.createDataFrame([("x" + '"' + "a" * 200_000 + '"' + "y",)], "line string")
    assert frame.select(X.without_literals(F.col("line"))).head()[0] == "xy"


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a \t\r\n;", max_size=25), min_size=20, max_size=40))
def test_normalise_is_idempotent(spark, texts):
    frame = spark.createDataFrame([(x,) for x in texts], "t string").withColumn("a", X.normalised(F.col("t"))).withColumn("b", X.normalised(F.col("a")))
    for r in frame.collect():
        assert r.a == r.b and r.a.endswith("\n") and not re.search("[ \t]+$|\r", r.a, re.M) and not r.a.endswith("\n\n")


@pytest.mark.parametrize(("spec", "plain", "decimal"), [("P2'", "2", "2"), ("RP200", "200", "200"), ("P40.8'", "40", "40.8"), ("P20P4", "204", "20"), ("F", "", ""), ("", "", "")])
def test_pointer_target(spark, spec, plain, decimal):
    r = spark.createDataFrame([(spec,)], "s string").select(X.pointer_target(F.col("s")).alias("a"), X.pointer_target(F.col("s"), True).alias("b")).head()
    assert (r.a, r.b) == (plain, decimal)


def test_file_names(spark):
    rows = [("702+CP TRANSACTION.zwr", ("file", "702", "", "CP TRANSACTION")), ("80-3+ICD DIAGNOSIS.zwr", ("file", "80", "3", "ICD DIAGNOSIS")), ("PRCA.zwr", ("global", "", "", "PRCA"))]
    frame = spark.createDataFrame([(n,) for n, _ in rows], "n string")
    assert [tuple(r.c) for r in frame.select(X.file_class(F.col("n")).alias("c")).collect()] == [w for _, w in rows]
    with pytest.raises(Exception, match="unknown file name"):
        spark.createDataFrame([("a+b+.txt",)], "n string").select(X.file_class(F.col("n"))).collect()


def test_version_line(spark):
    text = "ABC ;site/x;title\n ;;4.5;Accounts Receivable;**14,79,153,302,409**;Mar 20, 1995;Build 78\n Q"
    r = spark.createDataFrame([(text,)], "t string").select(X.version_line(X.lines_of(F.col("t"))).alias("v")).select(F.size(X.patches(F.col("v"))).alias("n"), X.header_field(F.col("v"), 2).alias("g")).head()
    assert (r.n, r.g) == (5, "Accounts Receivable")


@pytest.mark.parametrize(("text", "n"), [(None, 0), ("", 0), ("a", 1), ("a\n", 1), ("a\n\n", 2), ("\n", 1)])
def test_line_counts(spark, text, n):
    frame = spark.createDataFrame([(1, text)], "unit int, text string")
    assert corpus.lines(frame).count() == n


def test_scan_breaks(spark):
    frame = spark.createDataFrame([(1, "a\rb\r\nc\x0bd\x85e f\x1cg")], "unit int, text string")
    assert [r.line for r in corpus.lines(frame, breaks=X.ANY_LINE_BREAK).orderBy("line_no").collect()] == list("abcdefg")


def test_small_expressions(spark):
    r = spark.createDataFrame([("x" * 130, "TAG^UNIT", "UNIT TAG", "^DPT(1,", "S P40", "W - warn", "a\tb\r\nc")], "l string, r string, x string, g string, s string, t string, a string").select(
        F.char_length(X.shortened(F.col("l"))).alias("n"), X.reference_tag(F.col("r")).alias("tag"), X.reference_unit(F.col("r")).alias("unit"), X.spaced_reference(F.col("x")).alias("sp"),
        X.store_name(F.col("g")).alias("store"), X.data_type(F.col("s")).alias("type"), X.severity(F.col("t")).alias("sev"), X.action_text(F.col("a")).alias("act"),
    ).head()
    assert (r.n, r.tag, r.unit, tuple(r.sp), r.store, r.type, r.sev, r.act) == (120, "TAG", "UNIT", ("UNIT", "TAG"), "DPT", "POINTER", "W", "a bc")
    with pytest.raises(Exception, match="below"):
        spark.createDataFrame([("/x/y",)], "p string").select(X.moved_path(F.col("p"), "/a/", "/b/")).collect()

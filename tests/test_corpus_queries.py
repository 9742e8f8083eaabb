"""Queries over the derived corpus where names are cut to one and the same, and where Spark takes many lines for few."""

import pytest
from test_queries import rows_of

from corvane.plans import code_queries  # noqa: F401
from corvane.plans.base import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def many_digits(spark, tmp_path_factory):
    """Parts whose test units' names are cut: TP1000000 and TP1000004 are called as the test of part 100000 is."""
    folder = tmp_path_factory.mktemp("digits")
    keys = [4, 5, 100_000, 100_001, 100_002, *range(1_000_000, 1_000_026)]
    rows = [(k, f"part {k}", f"Brand#{k % 5}", "TYPE", k % 7) for k in keys]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    return str(folder)


def check(spark, folder, name):
    c = duckdb.connect()
    c.execute(f"create view part as select * from '{folder}/part.parquet/*.parquet'")
    got, want = QUERIES[name](spark, folder), c.execute(ORACLE[name])
    assert rows_of(got.columns, got.collect()) == rows_of([d[0] for d in want.description], want.fetchall())


def test_where_tags_of_units_of_one_name(spark, many_digits):
    check(spark, many_digits, "where_tags")


def test_where_tags_sends_no_lines_to_the_driver(spark, sf):
    rows = QUERIES["where_tags"](spark, sf)
    assert "BroadcastHashJoin" not in rows._jdf.queryExecution().executedPlan().toString()
    rows.collect()
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()


def test_unit_health_of_units_whose_tests_share_a_name(spark, many_digits):
    check(spark, many_digits, "unit_health")


def test_a_test_counts_for_the_unit_that_it_names(spark):
    from corvane.operators import views as V

    names = {
        "P100000": "P100000 ;", "P1000001": "P1000001 ;", "P1000004": "P1000004 ;", "TP100000": "TP1000004 ;for one of them",
        "ABCDEFGH": "ABCDEFGH ;", "ABCDEFGX": "ABCDEFGX ;", "TABCDEFG": "TABCDEFG ;head cut as well, so for both",
        "Q": "Q ;", "TQ": " no head", "R": "R ;", "TX": "TR ;another file", "S": "S ;", "TS": "",
    }
    units = spark.createDataFrame([(u, "g", 1, line, "") for u, line in names.items()], "unit string, grp string, line_count bigint, first_line string, version_line string")
    none = units.select("unit").limit(0)
    got = {r.unit for r in V.unit_health(units, none, none).collect() if r.has_test}
    assert got == {"P1000004", "ABCDEFGH", "ABCDEFGX", "Q", "S"}

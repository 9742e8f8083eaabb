"""Each registered query against its SQL on the smallest tables."""

import math

import pytest

duckdb = pytest.importorskip("duckdb")

from corvane.plans import code_queries, dictionary_queries, graph_queries, state_queries, text_queries, view_queries  # noqa: E402, F401
from corvane.plans.base import ORACLE, QUERIES  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def connection(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.9g}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, connection, name):
    got = QUERIES[name](spark, sf)
    rows = got.collect()
    want = connection.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, rows) == rows_of(names, want.fetchall())


def test_entry_imports_and_runs(spark, sf):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["source_nation", "dest_nation", "edge_count", "distinct_suppliers", "distinct_customers"]
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())

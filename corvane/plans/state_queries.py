"""Queries over tables that are kept between runs, and over what is written to be looked up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import rules as R
from corvane.operators import state as S
from corvane.plans.base import Tables, query
from corvane.session import scratch
from corvane.sources import corpus
from corvane.sources.lookup import write_lookup


def _two_runs(t: Tables) -> tuple[S.StateTable, str]:
    """Customers as record types. The second run knows their orders, which the first hasn't extracted yet, and what people have decided in between."""
    key = F.col("c_custkey").cast("string")
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    full = t.customer.join(orders, "c_custkey", "left").select(key.alias("id"), F.lit(None).cast("string").alias("parent"), "c_acctbal", "c_mktsegment", F.coalesce("n", F.lit(0)).alias("n"))
    first = full.withColumn("n", F.lit(0).cast("long"))
    rules = [
        R.Rule("H-10", F.col("c_acctbal") < 0, "P", "high", F.lit("balance below 0")),
        R.Rule("H-18", F.col("n") > 11, "K", "moderate", F.concat(F.lit("orders="), F.col("n").cast("string"))),
        R.Rule("H-20", F.col("c_mktsegment") == "BUILDING", "I", "low", F.lit("segment")),
    ]
    manual = t.customer.where("c_custkey % 50 = 7").select(key.alias("id"), F.lit("S").alias("label"), F.lit("manual").alias("method"), F.lit("decided").alias("evidence"))
    table, log = S.StateTable(scratch(t.spark, "state"), buckets=16), scratch(t.spark, "runs")
    S.append_log(log, S.rerun(first, rules, table, "run 1"))
    second = S.rerun(full, rules, table, "run 2", manual).persist()
    for _ in range(2):  # a run that is logged twice is one run
        S.append_log(log, second)
    second.unpersist()
    return table, log


_RUNS = """c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS id, c_acctbal, c_mktsegment, coalesce(n, 0) AS n, c_custkey % 50 = 7 AS told FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey),
one AS (SELECT *, CASE WHEN c_acctbal < 0 THEN 'P|H-10|high|balance below 0' WHEN c_mktsegment = 'BUILDING' THEN 'I|H-20|low|segment' END AS r1 FROM c),
two AS (SELECT *, CASE WHEN told THEN 'S|manual||decided' WHEN n = 0 AND r1 IS NOT NULL THEN r1 ELSE coalesce(CASE WHEN c_acctbal < 0 THEN 'P|H-10|high|balance below 0' WHEN n > 11 THEN 'K|H-18|moderate|orders=' || n WHEN c_mktsegment = 'BUILDING' THEN 'I|H-20|low|segment' END, r1) END AS r2 FROM one)"""


@query(f"""WITH {_RUNS} SELECT id, split_part(r2, '|', 1) AS label, split_part(r2, '|', 2) AS method, nullif(split_part(r2, '|', 3), '') AS confidence, split_part(r2, '|', 4) AS evidence, CASE WHEN n > 0 OR told OR r1 IS DISTINCT FROM r2 THEN 'run 2' ELSE 'run 1' END AS run FROM two""")
def stored_labels(t: Tables) -> DataFrame:
    """The table of labels after two runs."""
    return _two_runs(t)[0].read(t.spark).select("id", "label", "method", "confidence", "evidence", "run")


@query(f"""WITH {_RUNS} SELECT 'run 1' AS run, 'fresh' AS mode, count(*) AS total, count(r1) AS newly_classified, 0 AS re_evaluated, 0 AS unchanged, count(*) FILTER (r1 IS NULL) AS unresolved FROM two
UNION ALL SELECT 'run 2', 'incremental', count(*), count(*) FILTER (r1 IS NULL AND r2 IS NOT NULL), count(*) FILTER (NOT told AND n > 0 AND r1 IS NOT NULL), count(*) FILTER (NOT (n > 0 OR told OR r1 IS DISTINCT FROM r2)), count(*) FILTER (r2 IS NULL) FROM two""")
def stored_runs(t: Tables) -> DataFrame:
    """The log of the two runs."""
    return S.read_log(t.spark, _two_runs(t)[1])


@query("""SELECT l_suppkey AS source, o_custkey AS target, count(*) AS refs FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey IN (3, 17, 42, 77, 1000000) GROUP BY 1, 2""")
def indexed_callers(t: Tables) -> DataFrame:
    """All edges written to be looked up, and those of five suppliers (one of which doesn't exist) looked up."""
    edges = t.supply().groupBy("source", "target").agg(F.count("*").alias("refs"))
    return write_lookup(edges, scratch(t.spark, "edges"), "source", 16).rows_of(t.spark, [3, 17, 42, 77, 1000000])


@query("""SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_brand IN (SELECT DISTINCT p_brand FROM part WHERE p_size = 1)""")
def indexed_cards(t: Tables) -> DataFrame:
    """Cards of parts by brand, and those of the brands that another table asks for."""
    cards = write_lookup(t.part.select("p_partkey", "p_name", "p_brand", "p_size"), scratch(t.spark, "cards"), "p_brand", 16)
    return cards.rows_of_all(t.part.where("p_size = 1").select("p_brand")).select("p_partkey", "p_name", "p_brand", "p_size")


@query("""WITH m AS (SELECT 'P' || p_partkey AS unit, p_brand AS grp, p_partkey AS k FROM part)
SELECT 'unit' AS kind, unit AS name, octet_length(encode(body)) AS bytes, md5(body) AS digest FROM (SELECT unit, k, 'P' || p_partkey || ' ;' || repeat(p_name || chr(10), p_size) AS body FROM m JOIN part ON p_partkey = k WHERE k % 50 <> 3)
UNION ALL SELECT 'missing file', unit, 0, '' FROM m WHERE k % 50 = 3""")
def manifest_scan(t: Tables) -> DataFrame:
    """A corpus of parts of very different sizes, read as its manifest lists it; some listed units were never written."""
    key = F.col("p_partkey").cast("string")
    text = F.concat(F.lit("P"), key, F.lit(" ;"), F.expr("repeat(p_name || '\\n', p_size)"))
    units = t.part.select(F.concat(F.lit("P"), key).alias("unit"), F.col("p_brand").alias("grp"), text.alias("text"), "p_partkey")
    path = scratch(t.spark, "corpus")
    corpus.write_units(units.where("p_partkey % 50 <> 3"), path)
    place = path.removeprefix("file://")
    manifest = units.select("unit", "grp", F.concat(F.lit(place + "/"), "grp", F.lit("/Routines/"), "unit", F.lit(".m")).alias("path"))
    read = corpus.read_by_manifest(t.spark, manifest, path).select(F.lit("unit").alias("kind"), F.col("unit").alias("name"), F.col("byte_size").alias("bytes"), F.md5(F.col("text").cast("binary")).alias("digest"))
    broken = corpus.manifest_contract(t.spark, manifest, path).select(F.col("check").alias("kind"), F.col("unit").alias("name"), F.lit(0).cast("long").alias("bytes"), F.lit("").alias("digest"))
    return read.unionByName(broken)

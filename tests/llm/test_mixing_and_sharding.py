import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corvane.llm import mixing as M
from corvane.llm import sharding as H


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_rates_and_counts(spark, make_docs):
    rows = [(k, f"t{k}", "en", "big" if k % 10 else "small") for k in range(4000)] + [(9000 + k, "x", "en", None) for k in range(200)]
    docs = make_docs(rows)
    rates = {r.source: (r.n, r.rate) for r in M.source_rates(docs, weights={"big": 1, "small": 1, None: 0}).collect()}
    assert rates["big"][0] == 3600 and math.isclose(rates["big"][1], 2100 / 3600, abs_tol=1e-6)
    assert math.isclose(rates["small"][1], 2100 / 400, abs_tol=1e-6) and rates[None][1] == 0
    mix = M.replicated(docs, weights={"big": 1, "small": 1, None: 0}).collect()
    sizes = Counter(r.source for r in mix)
    assert abs(sizes["big"] - 2100) < 200 and abs(sizes["small"] - 2100) < 250 and None not in sizes
    per = Counter(r.doc_id for r in mix if r.source == "small")
    share = [sum(v == k for v in per.values()) / 400 for k in range(12)]
    share[0] = 1 - len(per) / 400
    assert all(abs(share[k] - math.exp(-5.25) * 5.25**k / math.factorial(k)) < 0.08 for k in range(12))
    assert all(r.replica < per[r.doc_id] for r in mix if r.source == "small")


def test_large_rates_add_up_parts(spark, make_docs):
    docs = make_docs([(k, "x") for k in range(300)])
    mix = M.replicated(docs, size=300 * 100)
    n = mix.count()
    assert abs(n - 30_000) < 5 * math.sqrt(30_000)


def test_mix_is_repeatable_and_keeps_columns(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows).withColumn("rate", F.lit("mine")).withColumn("__n", F.lit(5)).withColumn("key", F.lit("k")).withColumn("N", F.lit("n"))
    a, b = M.mixed(docs, size=100), M.mixed(docs.repartition(7), size=100)
    assert a.columns == docs.columns
    assert {(r.rate, r["__n"], r.key, r.N) for r in a.collect()} == {("mine", 5, "k", "n")}
    assert Counter(r.doc_id for r in a.collect()) == Counter(r.doc_id for r in b.collect())
    assert M.mixed(docs.limit(0)).count() == 0
    keys = [r.shuffle_key for r in M.shuffled(M.replicated(docs, size=500)).collect()]
    assert keys == sorted(keys)


def test_jump_hash_equals_the_published_algorithm(spark):
    keys = [0, 1, -1, 7, 1 << 40, -(1 << 63), (1 << 63) - 1, *range(100, 400)]
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for n in (1, 2, 8, 9, 33):
        got = {r.k: r.s for r in frame.select("k", H.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_shards(spark, make_docs, hard_rows):
    docs = make_docs([*hard_rows, *((k, f"text {k}") for k in range(100, 900))]).withColumn("slot", F.lit("old")).withColumn("__id", F.lit("mine")).withColumn("place", F.lit("here"))
    placed = []
    for rows_per_range in (10**6, 10):
        found = H.sharded(docs, rows_per_range=rows_per_range)
        assert found.columns == [*(c for c in docs.columns if c != "slot"), "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
        rows = found.collect()
        assert len(rows) == docs.count()
        slots = {}
        for r in rows:
            assert r.shard == jump(r.doc_id or 0, 8) and r.grown_shard in (r.shard, 8) and r.law == "key"
            assert r["__id"] == "mine" and r.place == "here"
            data = (r.text or "").encode()
            assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
            order = hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{r.text_crc32}".encode()).hexdigest()
            slots.setdefault(r.shard, []).append((r.slot, order, r.doc_id or 0, r.text_crc32))
        for rows_of_shard in slots.values():
            assert sorted(s for s, *_ in rows_of_shard) == list(range(len(rows_of_shard)))
            assert [x[1:] for x in sorted(rows_of_shard)] == sorted(x[1:] for x in rows_of_shard)
        placed.append({k: sorted(v) for k, v in slots.items()})
    assert placed[0] == placed[1]
    assert H.sharded(docs.limit(0)).count() == 0


def test_slots_in_many_ranges_equal_the_sql(spark, sf):
    duckdb = pytest.importorskip("duckdb")
    from corvane.llm.queries import ORACLE

    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = {r[0]: r[1:] for r in c.execute(f"select doc_id, shard, slot from ({ORACLE['op7_sharding']})").fetchall()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert {r.doc_id: (r.shard, r.slot) for r in H.sharded(docs, rows_per_range=3).collect()} == want


def test_sharding_plan_has_no_python(spark, make_docs):
    plan = H.sharded(make_docs([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

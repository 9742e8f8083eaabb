import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corvane.llm import simhash as S
from corvane.llm.common import connected_components
from corvane.llm.queries import op4_simhash


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", lower) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """(id, fingerprint) to the smallest id reachable over at most two differing bits."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, low[find(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("text", ["", None, "One", "a b", "a b c", "A B C d e Été x", "x " * 3000, "tab\tsep\nline\x0bq r s t u"])
def test_fingerprint(text):
    assert S.majority_bits(S.shingle_hashes((text or "").encode())) == brute_fingerprint(text)


def test_close_fingerprints_lose_no_link(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(6):
            flipped = base
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                flipped ^= 1 << b
            prints.add(flipped)
    prints |= {0, 1, 3, (1 << 64) - 1, (1 << 64) - 2, 0xF, 0xE}
    rows = list(enumerate(sorted(prints)))
    want = {(min(a, b), max(a, b)) for a, x in rows for b, y in rows if a != b and (x ^ y).bit_count() <= 2}
    frame = spark.createDataFrame([(i, int(np.uint64(x).view(np.int64))) for i, x in rows], "node bigint, fp bigint")
    for segments in (8, 16):
        got = S.close_fingerprints(frame, "fp", "node", segments).collect()
        assert {(min(r), max(r)) for r in got} == want


def test_components_of_hard_rows(spark, make_docs, hard_rows):
    rows = S.simhash_components(make_docs(hard_rows)).collect()
    assert len(rows) == len(hard_rows)
    by_id = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert by_id[1] == by_id[2] == by_id[3] == 1  # wordless texts are alike
    assert by_id[5] == 4 and by_id[6] == 6
    assert S.simhash_components(make_docs(hard_rows).limit(0)).count() == 0


def test_removal_keeps_one_of_each(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit(None).cast("string"))
    kept = S.near_duplicates_removed(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 6, 7]
    assert ids.count(None) == 1  # the null id alone of its class


def test_removal_loses_no_text_without_an_id_or_under_a_repeated_one(spark, make_docs):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(500)]
    texts = [" ".join(rng.choices(words, k=30)) for _ in range(14)]
    rows = [(None, t) for t in texts[:10]] + [(None, texts[0]), (None, texts[12])]
    rows += [(5, texts[10]), (5, texts[11]), (3, texts[11]), (7, texts[12]), (8, texts[12]), (9, texts[13]), (9, texts[13])]
    want = sorted([(None, t) for t in texts[:10]] + [(5, texts[10]), (3, texts[11]), (7, texts[12]), (9, texts[13])], key=str)
    for order in (rows, rows[::-1]):
        kept = S.near_duplicates_removed(make_docs(order).repartition(3))
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want
    labels = {(r.doc_id, r.component_id) for r in S.simhash_components(make_docs(rows)).collect()}
    assert labels == {(None, None), (None, 7), (5, 5), (5, 3), (3, 3), (7, 7), (8, 7), (9, 9)}


def test_close_texts_without_ids_leave_one(spark, make_docs):
    base = " ".join(f"w{k}" for k in range(2000))
    close = next(t for t in (base + f" z{k}" for k in range(2000)) if 0 < (brute_fingerprint(base) ^ brute_fingerprint(t)).bit_count() <= 2)
    assert S.near_duplicates_removed(make_docs([(None, base), (None, close)])).count() == 1


def test_star_with_a_hub_and_a_chain(spark):
    edges = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert all(got[k] == 0 for k in range(300)) and all(got[1000 + k] == 1000 for k in range(61))
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_query(spark, sf):
    rows = op4_simhash(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows:
        assert r.fingerprint == f"{brute_fingerprint(texts[r.doc_id]):016x}"
    assert sorted((r.doc_id, r.component_id) for r in rows) == brute_components([(r.doc_id, int(r.fingerprint, 16)) for r in rows])

import random

from pyspark.sql import functions as F

from corvane.llm import decontaminate as D
from corvane.llm.queries import op2_decontamination


def brute(text, items, window=10):
    words = D.words_of((text or "").encode())
    hits, found = set(), set()
    for item, body in items:
        for w in D.windows_of((body or "").encode(), window):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hits.update(range(i, i + len(w)))
                    found.add(item)
    return len(words), sorted(hits), sorted(found)


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(6)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 7, 10, 12, 14])))) for k in range(12)]
    texts = []
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        if rng.random() < 0.6 and words:
            at = rng.randrange(len(words))
            words[at:at] = rng.choice(items)[1].split()
        texts.append(" ".join(words).upper() if rng.random() < 0.3 else ", ".join(words))
    return items, texts


def test_search_equals_brute_force():
    for seed in range(12):
        items, texts = random_case(seed)
        tables = D._tables([(i, b" ".join(w)) for i, body in items for w in set(D.windows_of(body.encode()))])
        for text in texts:
            words, hits, found = D.words_of(text.encode()), set(), set()
            for t in tables:
                t.search(words, hits, found)
            assert (len(words), sorted(hits), sorted(found)) == brute(text, items)


def test_sieve_and_join_give_the_same_as_tables(spark, make_docs, hard_rows):
    items, texts = random_case(99)
    docs = make_docs([*enumerate(texts, 100), *hard_rows, (900, "one one, TWO two two")]).withColumn("text_key", F.lit("mine"))
    bench = spark.createDataFrame([*items, (None, "one two"), (50, None), (51, "one two")], "item_id bigint, text string")
    one = D.with_hits(docs, bench, "h").collect()
    many = D.with_hits(docs, bench, "h", max_windows=9)
    assert many.columns == [*docs.columns, "h"]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.text_key, r.h.n_words, r.h.hits, r.h["items"])
    assert sorted(map(key, one)) == sorted(map(key, many.collect()))
    for r in one:
        if len(r.text or "") < 1000:
            assert (r.h.n_words, r.h.hits, r.h["items"]) == brute(r.text, [*items, (51, "one two")])


def test_a_million_windows(spark, make_docs):
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id"), k), F.lit(50_000)).cast("string"))
    bench = spark.range(2_500).select(F.col("id").alias("item_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(410)), word), " ").alias("text"))
    some = [r.text.split() for r in bench.where("item_id % 500 = 7").collect()]
    docs = make_docs([(k, f"before {' '.join(w[50 + k : 50 + k + n])} after") for k, w in enumerate(some) for n in (9, 10, 25)] + [(90, " ".join(f"w{k}" for k in range(5_000)))])
    found = {(r.doc_id, r.h.n_words): (r.h.hits, r.h["items"]) for r in D.with_hits(docs, bench, "h").collect()}
    assert len(found) == 16 and found[90, 5_000] == ([], [])
    for k in range(len(some)):
        assert found[k, 11] == ([], []) and found[k, 12] == (list(range(1, 11)), [7 + 500 * k]) and found[k, 27] == (list(range(1, 26)), [7 + 500 * k])


def test_filter_keeps_columns_and_clean_rows(spark, make_docs):
    docs = make_docs([(1, "a b c d e f g h i j k l"), (2, "x y z"), (3, None)]).withColumn("hits", F.lit(1)).withColumn("items", F.lit("q")).withColumn("__hits", F.lit(2))
    bench = spark.createDataFrame([(9, "b c d e f g h i j k")], "item_id bigint, text string")
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert D.decontaminate(docs, bench.limit(0)).count() == 3
    assert D.decontaminate(docs.limit(0), bench).count() == 0


def test_query(spark, sf):
    rows = op2_decontamination(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows[::7] + [r for r in rows if r.contaminated][:5]:
        n, hits, found = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items) == (n, len(hits), len(found))

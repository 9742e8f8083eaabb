from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvane.llm import language as L
from corvane.llm import quality as Q
from corvane.llm.queries import op5_language, op9_quality


def crc(doc_id, n):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % n


def test_filter_returns_all_languages_of_an_ngram(spark, make_docs):
    words = {"aa": "kala mala pala sala tala", "bb": "krolok drolok frolok kala mala", "cc": "zyx wyx vyx uyx"}
    rows = [(k, " ".join([words[lang]] * 5), lang, "s") for k, lang in enumerate(list(words) * 30)]
    model = L.learn(make_docs(rows))
    assert model.languages == ["aa", "bb", "cc"]
    shared, only = L.grams_of("kala mala"), L.grams_of("zyx wyx")
    for grams, bits in ((shared, 0b011), (only[2:3], 0b100)):
        masks = [int(np.bitwise_and.reduce([model.masks[0][L._slots(grams[k : k + 1], h)[0]] for h in L._HASHES])) for k in range(len(grams))]
        assert any(m & bits == bits for m in masks)
    assert model.predict("Zyx, wyx! 123")[0] == "cc" and model.predict("drolok frolok")[0] == "bb"
    assert model.predict("12 !? …") == (L.UNDETERMINED, 0.0) and model.predict("") == (L.UNDETERMINED, 0.0)
    assert 0 <= model.predict("q")[1] <= 1


def test_language_of_hard_rows(spark, make_docs, hard_rows):
    docs = make_docs([*hard_rows, (77, "abc def", None, "s")])
    model = L.learn(docs)
    found = docs.select("doc_id", L.predicted(spark, model, F.col("text")).alias("p")).collect()
    assert len(found) == docs.count() and {r.p.lang_pred for r in found} <= {"en", "und"}
    nothing = L.learn(docs.limit(0))
    assert nothing.languages == [] and nothing.predict("text")[0] == L.UNDETERMINED


def test_language_holds_out_and_is_right(spark, sf):
    rows = op5_language(spark, sf).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_filter_decides_as_exact_sets_do(spark, sf):
    """Brute force: the n-grams of each language as a set, without slots, masks or corrections."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = L.learn(docs)
    rows = docs.collect()
    sums = {}
    for r in rows:
        if r.lang is not None and crc(r.doc_id, 3) != 1 and r.text and L.has_letter(r.text):
            sums.setdefault(r.lang, Counter()).update(L.grams_of(r.text).tolist())
    sets = {k: {g for g, n in c.items() if n >= L.MIN_SHARE * c.total()} for k, c in sums.items()}
    assert model.languages == sorted(sets)
    same = 0
    for r in rows:
        grams = L.grams_of(r.text or "").tolist()
        exact = np.array([sum(g in sets[k] for g in grams) for k in model.languages], float)
        counts, n = model.counts(r.text or "")
        assert n == len(grams)
        # a set bit is never missing, and false positives are rare and mostly corrected
        assert (counts >= exact - n * 0.05 - 1).all() and (counts <= exact + n * 0.05 + 3).all()
        want = L.UNDETERMINED if not L.has_letter(r.text or "") else model.languages[int(exact.argmax())]
        same += model.predict(r.text or "")[0] == want
    assert same >= 0.99 * len(rows)


def test_discriminant_equals_the_formula(spark):
    rng = np.random.default_rng(3)
    d = len(Q.FEATURES)
    x = {0: rng.normal(0, 1, (80, d)), 1: rng.normal(0.5, 2, (120, d))}
    rows = [(k, [1e12, *v.tolist()]) for k, m in x.items() for v in m]  # so many words that nothing is drawn to the centre
    model = Q.fit(spark.createDataFrame(rows, "label int, features array<double>"), 0.3, 0.05)
    everything = np.vstack([x[0], x[1]])
    centre, scale = everything.mean(0), everything.std(0)
    logs = []
    z = {k: (v - centre) / scale for k, v in x.items()}
    covs = {k: np.cov(v.T, bias=True) for k, v in z.items()}
    pooled = 0.4 * covs[0] + 0.6 * covs[1]
    for k in (0, 1):
        c = 0.7 * covs[k] + 0.3 * pooled
        c = 0.95 * c + 0.05 * np.trace(c) / d * np.eye(d)
        gap = (everything - centre) / scale - z[k].mean(0)
        logs.append(np.log(len(x[k])) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(c), gap))
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    got = model.scores(np.hstack([np.full((200, 1), 1e12), everything]))
    assert np.allclose(got, want, atol=1e-9)


def test_quality_without_labels_or_with_one(spark):
    schema = "label int, features array<double>"
    row = [5.0] + [0.1] * len(Q.FEATURES)
    for rows, score in (([], 0.5), ([(1, row)], 1.0), ([(0, row), (0, row)], 0.0), ([(None, row)], 0.5)):
        assert Q.fit(spark.createDataFrame(rows, schema)).scores(np.array([row]))[0] == pytest.approx(score)


def test_quality_of_hard_rows(spark, make_docs, hard_rows):
    docs = make_docs(hard_rows).withColumn("features", F.lit("x")).withColumn("label", F.lit(1)).withColumn("score", F.lit(2)).withColumn("__score", F.lit(3))
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (7, 1, 1), (None, 1, 0), (4, None, 0)], "doc_id bigint, quality int, toxic int")
    model = Q.fit_on(Q.features_of(docs), labels)
    kept = Q.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(hard_rows)
    assert Q.accepted(docs.limit(0), model).count() == 0


def test_lessons_are_bounded_and_both_fits_are_one(spark, make_docs):
    docs = make_docs([(k, f"text number {k} " * (1 + k % 7) + "!" * (k % 3)) for k in range(500)])
    labels = spark.createDataFrame([*((k, k % 2, 0) for k in range(500)), (501, 7, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    learned = {r.doc_id for r in Q.lessons(labels).collect()}
    assert learned == {k for k in range(500) if crc(k, 5)}
    some = {r.doc_id for r in Q.lessons(labels, rows=100).collect()}
    assert some < learned and 60 < len(some) < 140
    a, b = Q.fit_on(Q.features_of(docs), labels, rows=100), Q.fit_on_texts(docs, labels, rows=100)
    assert np.allclose(a.means, b.means) and np.allclose(a.whiten, b.whiten) and a.bias == pytest.approx(b.bias)


def test_quality_holds_out_and_is_right(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in op9_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (crc(d, 5) == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for d, r in rows.items())
    held = [(rows[d].predicted, q) for d, q in labels.items() if rows[d].held_out]
    assert sum(p == q for p, q in held) >= 0.95 * len(held)

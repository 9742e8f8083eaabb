from collections import Counter

import corpus_pipeline as C
from corvane.llm import decontaminate, quality, sharding, simhash


def test_stages_and_run(spark, sf):
    names = [n for n, _ in C.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, left = docs, []
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, kept, sf)
        assert out.columns == docs.columns
        kept = spark.createDataFrame(out.collect(), docs.schema)
        left.append(Counter(r.doc_id for r in kept.collect()))
    quality_kept, one_each, clean, mix = left
    model = quality.fit_on(quality.features_of(docs), spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r.doc_id: model.scores(__import__("numpy").array([quality.statistics_of(r.text.encode())]))[0] for r in docs.collect()}
    assert set(quality_kept) == {d for d, s in scores.items() if s >= 0.3}
    prints = simhash.simhash_components(docs.where(docs.doc_id.isin(list(quality_kept)))).collect()
    assert set(one_each) == {r.component_id for r in prints}
    assert set(clean) < set(one_each) and max(one_each.values()) == 1
    assert set(mix) <= set(clean)
    rows = C.run(spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == mix
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert rows[0].law == "key" and sharding.N_SHARDS == 8 and decontaminate.WINDOW == 10


def test_stages_on_hard_rows(spark, sf, make_docs, hard_rows):
    docs = make_docs(hard_rows)
    given = Counter((r.doc_id, r.text) for r in docs.collect())
    fate = {}
    for name, stage in C.STAGES:
        rows = stage(spark, docs, sf).collect()
        left = Counter((r.doc_id, r.text) for r in rows)
        assert set(left) <= set(given), name
        fate[name] = left
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    texts = {t or "" for _, t in fate["quality"]}  # equal texts are judged alike, null as empty
    assert fate["quality"] == Counter({k: n for k, n in given.items() if (k[1] or "") in texts})
    wordless = [k for k in fate["near_duplicates"] if not (k[1] or "").split()]
    assert len(wordless) == 1 and sum(fate["near_duplicates"].values()) == 5
    assert {t for _, t in fate["near_duplicates"] if (t or "").split()} == {t for _, t in given if (t or "").split()}
    assert fate["decontamination"] == given and fate["sharding"] == given
    assert all(n % given[k] == 0 for k, n in fate["mixing"].items())  # rows that repeat share their number of copies

"""The registered queries of the numbered operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import bpe_trees as _bpe_trees
from corvane.llm import collocations as _collocations
from corvane.llm import decontaminate as _decontaminate
from corvane.llm import language as _language
from corvane.llm import mixing as _mixing
from corvane.llm import pages as _pages
from corvane.llm import personal as _personal
from corvane.llm import prefix_tries as _prefix_tries
from corvane.llm import quality as _quality
from corvane.llm import sharding as _sharding
from corvane.llm import simhash as _simhash
from corvane.llm import token_packs as _token_packs
from corvane.llm import vectors as _vectors
from corvane.llm.common import crc_mod, scratch, stored, table


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _pages.extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_outside", "n_repeated", "n_by_repeats", "n_by_markup", "n_by_both")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = _decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort(F.transform("found.items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "found.n_words",
        F.size("found.hits").cast("long").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        (F.size("found.hits") > 0).alias("contaminated"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature 0.5 over the sources, as many rows as the table has on average."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return _mixing.shuffled(_mixing.replicated(docs))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = _language.learn(docs)
    held_out = F.coalesce(crc_mod("doc_id", _language.FOLDS) == _language.HELD_OUT, F.lit(False))
    found = docs.select("doc_id", held_out.alias("held_out"), _language.predicted(spark, model, F.col("text")).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op6_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts are those of the base spans; ``spans`` also has what the bootstrapping found."""
    found = _personal.personal_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.expr(f"size(filter(base, m -> m.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in _personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(_personal.digest("base"), 256).alias("base_sha256"), _personal.digest("all").alias("spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sharding.sharded(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors.vector_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of all texts are made once and stored; fitting and scoring read those."""
    features = stored(_quality.features_of(table(spark, sf_dir, "documents")), "features")
    model = _quality.fit_on(features, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(crc_mod("doc_id", _quality.FOLDS) == 0, F.lit(False))
    scored = features.select("doc_id", held_out.alias("held_out"), _quality.score_of_features(model, F.col("features")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= _quality.THRESHOLD).cast("int"))


def op10_token_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs are written to the shared folder, and the result is made of what is read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packs = _token_packs.write_packs(docs, scratch(spark, "packs"), public_tokenizers.path("word_bpe_49k.json"))
    read = _token_packs.read_documents(spark, packs, checksums=True)
    return read.join(_token_packs.pack_starts(spark, packs), ["part", "pack"]).select(
        "doc_id", (F.col("at") + F.col("before")).cast("long").alias("start"), "n_tokens", "ids_crc32"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prefix_tries.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_bpe_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    found = _bpe_trees.decoded(_bpe_trees.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_decontamination": op2_decontamination,
    "op3_mixing": op3_mixing,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_personal": op6_personal,
    "op7_sharding": op7_sharding,
    "op8_vectors": op8_vectors,
    "op9_quality": op9_quality,
    "op10_token_packs": op10_token_packs,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe_trees": op12_bpe_trees,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {}

ORACLE["op2_decontamination"] = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT l FROM win),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
spot AS (
  SELECT doc_id, l, i, array_to_string(list_slice(w, i, i + l - 1), ' ') AS p
  FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM doc, lens WHERE len(w) >= l)),
occ AS (SELECT spot.doc_id, spot.i, spot.l, win.item_id FROM spot JOIN win ON spot.p = win.p AND spot.l = win.l),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS pos FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM occ) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ks, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

ORACLE["op3_mixing"] = """
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
w AS (SELECT source, n, pow(CAST(n AS DOUBLE), 0.5) AS w FROM c),
r AS (SELECT source, round(w * (SELECT sum(n) FROM w) / ((SELECT sum(w) FROM w) * n), 6) AS rate FROM w),
p AS (SELECT source, rate, greatest(CAST(ceil(rate / 32.0) AS INTEGER), 1) AS parts FROM r),
k AS (SELECT source, rate, parts, rate / parts AS mean, unnest(generate_series(0, 250)) AS k FROM p),
cdf AS (
  SELECT source, k, sum(CASE WHEN mean = 0 THEN CASE WHEN k = 0 THEN 1.0 ELSE 0.0 END ELSE exp(-mean + k * ln(mean) - lgamma(k + 1.0)) END)
         OVER (PARTITION BY source ORDER BY k) AS c
  FROM k),
u AS (
  SELECT doc_id, source, rate, CAST(CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(part AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM (SELECT doc_id, d.source, rate, unnest(generate_series(1, parts)) AS part FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source)),
n AS (
  SELECT u.doc_id, u.source, u.rate, count(*) AS n FROM u JOIN cdf ON u.source IS NOT DISTINCT FROM cdf.source AND cdf.c <= u.u
  GROUP BY u.doc_id, u.source, u.rate)
SELECT doc_id, source, rate, CAST(replica AS INTEGER) AS replica,
       md5('17-order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || CAST(replica AS VARCHAR)) AS shuffle_key
FROM (SELECT doc_id, source, rate, unnest(generate_series(0, n - 1)) AS replica FROM n)
"""

ORACLE["op7_sharding"] = """
WITH RECURSIVE jump(doc_id, n, b, j, k) AS (
  SELECT doc_id, n, CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(coalesce(doc_id, 0) AS UHUGEINT)
  FROM documents, (VALUES (8), (9)) AS v(n)
  UNION ALL
  SELECT doc_id, n, j, CAST(floor(CAST(j + 1 AS DOUBLE) * (2147483648.0::DOUBLE / CAST((k2 >> 33) + 1 AS DOUBLE))) AS BIGINT), k2
  FROM (SELECT doc_id, n, j, (k * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS k2 FROM jump WHERE j < n)),
placed AS (SELECT doc_id, CAST(max(b) FILTER (n = 8) AS INTEGER) AS shard, CAST(max(b) FILTER (n = 9) AS INTEGER) AS grown_shard FROM jump GROUP BY doc_id),
step(i, b, c) AS (
  SELECT i, 0, i FROM (SELECT unnest(generate_series(0, 255)) AS i)
  UNION ALL
  SELECT i, b + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM step WHERE b < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM step WHERE b = 8),
hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
byte AS (SELECT doc_id, list_transform(generate_series(1, len(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k - 1, 2) AS BIGINT)) AS l FROM hexed),
sized AS (
  SELECT doc_id, CAST(len(l) + 1 AS BIGINT) AS size,
         xor(list_reduce(l, lambda c, x: xor(t[xor(c % 256, x) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
  FROM byte, tab)
SELECT s.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY md5(coalesce(CAST(s.doc_id AS VARCHAR), '') || ':' || CAST(text_crc32 AS VARCHAR)), coalesce(s.doc_id, 0), text_crc32) - 1 AS slot, grown_shard
FROM sized s JOIN placed p ON s.doc_id IS NOT DISTINCT FROM p.doc_id
"""

ORACLE["op8_vectors"] = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN low ON vec_id = low.a LEFT JOIN n ON vec_id = n.a
"""

ORACLE["op11_prefix_trie"] = """
WITH RECURSIVE step(i, b, c) AS (
  SELECT i, 0, i FROM (SELECT unnest(generate_series(0, 255)) AS i)
  UNION ALL
  SELECT i, b + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM step WHERE b < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM step WHERE b = 8),
conv AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (
  SELECT c, xor(list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda s, x: xor(t[xor(s % 256, x) + 1], s >> 8), 4294967295::BIGINT), 4294967295::BIGINT) % 4 AS h
  FROM conv, tab),
turn AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
item AS (
  SELECT h.c, 0 AS own, pos, struct_pack(role := role, text := text) AS v FROM hashed h JOIN turn ON turn.c = h.c - h.c % 20 AND pos < h
  UNION ALL
  SELECT h.c, 1, pos, struct_pack(role := role, text := text) FROM hashed h JOIN turn ON turn.c = h.c AND pos >= h),
seq AS (SELECT conv.c, coalesce(s, []) AS s FROM conv LEFT JOIN (SELECT c, list(v ORDER BY own, pos) AS s FROM item GROUP BY c) x ON x.c = conv.c),
pre AS (SELECT c, d, sha256(CAST(list_slice(s, 1, d) AS VARCHAR)) AS p, d = len(s) AS ends, CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
        FROM (SELECT c, s, unnest(generate_series(0, len(s))) AS d FROM seq)),
node AS (SELECT d, p, min(c) AS name, count(*) AS n, any_value(w) AS w, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends) AS e FROM pre GROUP BY d, p),
named AS (SELECT pre.c, pre.d, node.name FROM pre JOIN node ON pre.d = node.d AND pre.p = node.p),
full_node AS (SELECT node.*, up.name AS parent FROM node LEFT JOIN named up ON up.c = node.name AND up.d = node.d - 1),
kids AS (SELECT d - 1 AS d, parent AS name, count(*) AS k FROM full_node WHERE d > 0 GROUP BY 1, 2),
fact AS (SELECT f.*, coalesce(k, 0) AS k FROM full_node f LEFT JOIN kids ON kids.d = f.d AND kids.name = f.name),
total AS (
  SELECT up.d, up.name, count(*) FILTER (x.k = 0) AS n_leaves, sum((x.n - 1) * x.w) AS saved
  FROM fact x JOIN named up ON up.c = x.name AND up.d <= x.d GROUP BY 1, 2)
SELECT fact.name AS conv_id, CAST(fact.d AS BIGINT) AS depth, parent AS parent_conv_id, CAST(n AS BIGINT) AS n_convs, CAST(k AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(e, '')) AS ends_sha256
FROM fact JOIN total ON total.d = fact.d AND total.name = fact.name
"""

ORACLE["op13_collocations"] = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM piece GROUP BY lang),
f AS (
  SELECT lang, size, phrase, count(*) AS c
  FROM (SELECT lang, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS phrase
        FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM piece, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size))
  GROUP BY lang, size, phrase HAVING count(*) >= 100),
cand AS (SELECT lang, size, phrase, c, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cut AS (
  SELECT lang, size, phrase, c, k, array_to_string(list_slice(w, 1, k), ' ') AS lp, array_to_string(list_slice(w, k + 1, size), ' ') AS rp
  FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM cand)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.c AS a, k, x.c AS l, y.c AS r, n, (1000::HUGEINT * cut.c * n) // (x.c::HUGEINT * y.c) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp JOIN total ON total.lang = cut.lang),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
part AS (
  SELECT lang, array_to_string(list_slice(w, b, b + m - 1), ' ') AS phrase, max(c) AS longer
  FROM (SELECT *, unnest(generate_series(1, size - m + 1)) AS b FROM (SELECT *, unnest(generate_series(2, size - 1)) AS m FROM cand WHERE size > 2)) GROUP BY 1, 2),
ranked AS (
  SELECT low.lang, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, low.phrase) AS rank, low.phrase, a, l, r, n, score
  FROM low LEFT JOIN part ON part.lang = low.lang AND part.phrase = low.phrase WHERE place = 1 AND (longer IS NULL OR longer < a))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

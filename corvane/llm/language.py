"""Language identification with a bit-sliced Bloom filter of n-grams.

Each slot of the filter is a mask with a bit per language. An n-gram sets its
languages' bits in a few hashed slots; the AND of those slots returns, at once,
all languages that contain it. A text's n-grams give a count per language, from
which the expected false positives are taken; the largest corrected count wins.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import as_texts, bounded_batches, crc_mod, cut

FOLDS, HELD_OUT = 3, 1
UNDETERMINED = "und"
GRAM = 5
#: Rows of a language that n-grams are learned from: those with the smallest hashes of their ids.
SAMPLE_ROWS = 2000
#: Languages up to which their row counts and sampled ids are broadcast; with more, they meet the documents in a shuffle.
BROADCAST_LANGUAGES = 200
#: The least share of a language's n-grams that puts one into the filter; so at most 1 / MIN_SHARE are.
MIN_SHARE = 1e-5
SLOT_BITS = 20
#: Odd 64-bit multipliers, one per hash function.
_HASHES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

_FOLD = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def grams_of(text: str) -> np.ndarray:
    """All windows of five UTF-8 bytes of the lower-cased text, ASCII non-letters as spaces; none across two spaces."""
    octets = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_FOLD) + b" ", np.uint8)
    gap = np.concatenate([[False], (octets[1:] == 32) & (octets[:-1] == 32)])
    octets = octets[~gap].astype(np.uint64)
    if len(octets) < GRAM:
        octets = np.concatenate([octets, np.full(GRAM - len(octets), 32, np.uint64)])
    n = len(octets) - GRAM + 1
    grams = octets[:n].copy()
    for k in range(1, GRAM):
        grams |= octets[k : k + n] << np.uint64(8 * k)
    return grams


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _slots(grams: np.ndarray, h: np.uint64) -> np.ndarray:
    return ((grams + np.uint64(1)) * h) >> np.uint64(64 - SLOT_BITS)


@dataclass
class LanguageFilter:
    """``masks``: a word of 64 languages per slot and plane. ``false_rate``: per language, of a foreign n-gram."""

    languages: list[str]
    masks: np.ndarray  # planes x slots
    false_rate: np.ndarray

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """The corrected number of n-grams per language, and the number of all."""
        grams = grams_of(text)
        slots = [_slots(grams, h) for h in _HASHES]
        out = np.zeros(len(self.languages))
        for plane, words in enumerate(self.masks):
            found = words[slots[0]]
            for s in slots[1:]:
                found = found & words[s]
            for bit, k in enumerate(range(plane * 64, min(len(out), plane * 64 + 64))):
                out[k] = np.count_nonzero(found & np.uint64(1 << bit))
        n = len(grams)
        return np.maximum(0.0, (out - n * self.false_rate) / (1 - self.false_rate)), n

    def predict(self, text: str) -> tuple[str, float]:
        """The language and the winner's margin over the next one, as a share of the n-grams it has."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        counts, _ = self.counts(text)
        order = np.argsort(-counts, kind="stable")
        best, second = counts[order[0]], counts[order[1]] if len(order) > 1 else 0.0
        return self.languages[order[0]], float((best - second) / best) if best > 0 else 0.0


def sampled(docs: DataFrame, doc_id: str, lang: str, rows: int) -> DataFrame:
    """Ids of at most ``rows`` training rows of each language, those with the smallest hashes."""
    known = docs.where(F.col(lang).isNotNull() & (F.coalesce(crc_mod(doc_id, FOLDS), F.lit(0)) != HELD_OUT)).select(
        F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(doc_id)).alias("hash")
    )
    # a share of the hashes that holds somewhat more rows than wanted, so that what is ranked is bounded too
    sizes = cut(known.groupBy("lang").agg(F.count("*").alias("n")))
    if sizes.count() <= BROADCAST_LANGUAGES:
        sizes = F.broadcast(sizes)
    low = (F.col("hash") / float(1 << 64) + 0.5) * F.col("n") <= rows + 10 * rows**0.5
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    return (
        known.join(sizes, "lang")
        .where(low)
        .withColumn("place", place)
        .where(F.col("place") <= rows)
        .select("lang", "doc_id")
        .distinct()
    )


def learn(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, min_share: float = MIN_SHARE
) -> LanguageFilter:
    """The filter of the languages in ``docs``, from rows outside the held-out fold.

    A bounded sample of rows per language (a documented parameter) is counted in
    Spark, in partial sums per task. An n-gram belongs to a language where it has
    ``min_share`` of that language's n-grams, which bounds what the driver gets.
    Languages are ordered by name, so ties go to the first one. Null texts and
    languages are left out; without any training row there are no languages, and
    all predictions are undetermined.
    """
    bounded_batches(docs.sparkSession)
    chosen = cut(sampled(docs, doc_id, lang, rows))
    if chosen.count() <= BROADCAST_LANGUAGES * rows:
        chosen = F.broadcast(chosen)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")).join(
        chosen, ["doc_id", "lang"], "left_semi"
    )

    def counted(batches):
        sums: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), as_texts(batch.column(1)), strict=True):
                if has_letter(body):
                    grams, n = np.unique(grams_of(body), return_counts=True)
                    sums[name].update(dict(zip(grams.tolist(), n.tolist(), strict=True)))
        for name, found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found), pa.string()), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())],
                ["lang", "gram", "n"],
            )

    sums = (
        texts.select("lang", "text")
        .mapInArrow(counted, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = sums.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = sums.join(totals, "lang").where(F.col("n") >= F.col("total") * min_share).select("lang", "gram")
    by_language: dict[str, list[int]] = defaultdict(list)
    for r in frequent.toLocalIterator():
        by_language[r.lang].append(r.gram)
    languages = sorted(by_language)
    masks = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOT_BITS), np.uint64)
    rate = np.zeros(len(languages))
    for k, name in enumerate(languages):
        grams = np.array(by_language[name], np.int64).astype(np.uint64)
        set_ = np.zeros(1 << SLOT_BITS, bool)
        for h in _HASHES:
            set_[_slots(grams, h)] = True
        masks[k // 64][set_] |= np.uint64(1 << (k % 64))
        rate[k] = set_.mean() ** len(_HASHES)
    return LanguageFilter(languages, masks, rate)


_TYPE = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predicted(spark, model: LanguageFilter, text: Column) -> Column:
    """A struct column: lang_pred and score (0 to 1) of each whole text. Null or without a letter: und, 0."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf(_TYPE)
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t) for t in as_texts(texts)]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"]
        )

    return predict(text)

"""Phrases whose words keep company, mined from a prefix-free parse of all texts.

A text's words are parted into chunks wherever a pair of words has a hash that
the modulus divides, so equal passages are parted alike in whatever text they
stand. Each chunk runs on over the first words of the next, so that every phrase
of up to five words lies whole in the chunk in which it begins; there, and only
there, it is counted. Distinct chunks with the number of their occurrences are
the dictionary. Phrases are counted inside distinct chunks, weighted, so a copy
costs no second count.

Longer phrases are only built from frequent shorter ones, as no phrase is more
frequent than its parts. Which parts are frequent is known to the workers by a
filter of hashed phrases, which never says no to a frequent one. Pairs are first
counted by hash alone, which is cheap to shuffle and never too low; then pairs
that may be frequent, and longer phrases of such pairs, are counted exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm.common import bounded_batches, stored

#: Words of the longest phrase, occurrences of the rarest, phrases listed for each language.
LONGEST, MIN_COUNT, TOP = 5, 100, 2_000
#: Words in a chunk, on average.
MODULUS = 48
#: Bits for each frequent phrase in a filter, and the bits of the smallest and the largest filter (16 MB). Beyond that
#: more phrases pass, and are counted without need.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 1 << 16, 1 << 27
#: Tasks that each make a filter of their share of the frequent phrases, in blocks of so many bytes.
FILTER_TASKS, BLOCK = 8, 4_096

# A-Z to a-z; what ends a piece to a line feed; tabs to spaces
_TO = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256))
_BOTH = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


class Words:
    """The words of some texts: each one's text, piece, distinct word and hash, all as arrays."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes().translate(_TO) if data else b"", np.uint8)
        offsets = offsets - offsets[0]
        feeds = raw == 10
        inside = ~(feeds | (raw == 32))
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[firsts] = inside[firsts]
        at = np.flatnonzero(begins)
        self.n = len(at)
        self.text = np.searchsorted(offsets, at, "right") - 1
        self.piece = np.cumsum(feeds)[at] if self.n else np.zeros(0, np.int64)
        compact = np.cumsum(inside)
        self.ends = np.append(compact[at] - 1, compact[-1] if len(raw) else 0)
        self.letters = raw[inside]
        each = pa.Array.from_buffers(pa.string(), self.n, [None, pa.py_buffer(self.ends.astype(np.int32)), pa.py_buffer(self.letters)])
        coded = each.dictionary_encode()
        self.distinct, self.code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.distinct.cast(pa.binary()).to_pylist()), np.uint64, len(self.distinct))
        self.hash = hashes[self.code]
        #: Whether the next word is one of the same text, of the same piece.
        self.goes_on = np.append(self.text[1:] == self.text[:-1], False)[: self.n]
        self.same_piece = self.goes_on & np.append(self.piece[1:] == self.piece[:-1], False)[: self.n]


def _mixed(*columns: np.ndarray) -> np.ndarray:
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        out = (out ^ (out >> np.uint64(31))) * _BOTH[0] + c
    return (out ^ (out >> np.uint64(29))) * _BOTH[1]


def _parse(words: Words, modulus: int, overlap: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of each chunk: its first word, the words that begin in it, and its text, a space after each word or a line feed where a piece ends."""
    follows = np.append(words.hash[1:], np.uint64(0))[: words.n]
    # a chunk begins with a triggering pair, or with a text
    first = np.flatnonzero((words.goes_on & ((_mixed(words.hash, follows) >> np.uint64(33)) % np.uint64(modulus) == 0)) | ~np.append(False, words.goes_on[:-1])[: words.n])
    after = np.append(first[1:], words.n)
    last_of_text = np.append(np.flatnonzero(~words.goes_on), words.n)
    ends = np.minimum(after + overlap, last_of_text[np.searchsorted(last_of_text, first)] + 1)
    lengths = np.diff(words.ends)
    out = np.empty(len(words.letters) + words.n, np.uint8)
    place = np.append(0, np.cumsum(lengths + 1))
    out[np.arange(len(words.letters)) + np.repeat(np.arange(words.n), lengths)] = words.letters
    out[place[1:] - 1] = np.where(words.same_piece, 32, 10)
    body = out.tobytes()
    return first, after - first, [body[a : b - 1] for a, b in zip(place[first].tolist(), place[ends].tolist(), strict=True)]


def chunk_dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", modulus: int = MODULUS, longest: int = LONGEST) -> DataFrame:
    """(lang, chunk, own, times): the distinct chunks of all texts, how many of their words begin phrases of theirs, and their occurrences."""

    def parsed(batches):
        for batch in batches:
            words = Words(batch.column(1))
            first, own, chunks = _parse(words, modulus, longest - 1)
            langs = batch.column(0).take(pa.array(words.text[first], pa.int64()))
            yield pa.RecordBatch.from_arrays([langs, pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(own, pa.int32())], ["lang", "chunk", "own"])

    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(parsed, "lang string, chunk string, own int").groupBy("lang", "chunk", "own").agg(F.count("*").alias("times"))


class PhraseFilter:
    """Bits by hashed language and words."""

    def __init__(self, bits: np.ndarray | int):
        self.bits = np.zeros(bits >> 3, np.uint8) if isinstance(bits, int) else bits

    def of_hashes(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - (len(self.bits) << 3).bit_length() + 1)

    def has(self, *columns: np.ndarray) -> np.ndarray:
        slots = self.of_hashes(_mixed(*columns))
        return self.bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1 == 1


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(x) for x in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return hashes[coded.indices.to_numpy()]


def hashed(phrases: DataFrame) -> DataFrame:
    """(hash) of (lang, phrase), a row each, all of one number of words."""

    def made(batches):
        for batch in batches:
            words = Words(batch.column(1))
            size = words.n // max(batch.num_rows, 1)
            out = _mixed(_lang_hashes(batch.column(0)), *words.hash.reshape(batch.num_rows, size).T) if size else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["hash"])

    return phrases.select("lang", "phrase").mapInArrow(made, "hash bigint")


def phrase_filter(hashes: DataFrame) -> PhraseFilter:
    """The filter of (hash), a row each: each of a few tasks sets the bits of its share, and the driver merges blocks of fixed number."""
    n, most = hashes.count(), LEAST_BITS
    while most < min(n * BITS_EACH, MOST_BITS):
        most *= 2

    def made(batches):
        own = PhraseFilter(most)
        for batch in batches:
            slots = own.of_hashes(batch.column(0).to_numpy().view(np.uint64))
            np.bitwise_or.at(own.bits, slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8))
        used = np.flatnonzero(own.bits.reshape(-1, BLOCK).any(axis=1))
        for k in used.tolist():
            yield pa.RecordBatch.from_pydict({"block": [k], "bits": [own.bits[k * BLOCK : (k + 1) * BLOCK].tobytes()]}, schema=pa.schema([("block", pa.int32()), ("bits", pa.binary())]))

    whole = PhraseFilter(most)
    for r in hashes.select("hash").repartition(FILTER_TASKS).mapInArrow(made, "block int, bits binary").toLocalIterator():
        whole.bits[r.block * BLOCK : (r.block + 1) * BLOCK] |= np.frombuffer(r.bits, np.uint8)
    return whole


def _sums(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of one row of each distinct key, the sum of its weights, and each row's number among the distinct keys."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[: len(key)]
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return order[first], np.add.reduceat(weight[order], first) if len(first) else weight[:0], number


class _Chunks:
    """The words of a batch of the dictionary, with what counting needs of each: language, whether it begins phrases, occurrences."""

    def __init__(self, batch: pa.RecordBatch):
        self.words = words = Words(batch.column(1))
        langs = batch.column(0).dictionary_encode()
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy().astype(np.int64)[words.text]
        self.lang_hash = _lang_hashes(batch.column(0))[words.text]
        begin = np.searchsorted(words.text, np.arange(batch.num_rows))
        self.own = batch.column(2).to_numpy()[words.text] > np.arange(words.n) - begin[words.text]
        self.weight = batch.column(3).to_numpy()[words.text]
        self.n_distinct = len(words.distinct) + 1
        #: Each word's number among the words of the batch's languages.
        self.number = self.lang * self.n_distinct + words.code


def frequent_pair_hashes(dictionary: DataFrame, words: PhraseFilter, min_count: int) -> DataFrame:
    """(hash) of pairs of words that may occur ``min_count`` times: all that do, as pairs that share a hash are counted together."""
    shared = dictionary.sparkSession.sparkContext.broadcast(words.bits)

    def counts(batches):
        sieve = PhraseFilter(shared.value)
        for batch in batches:
            c = _Chunks(batch)
            w = c.words
            passes = sieve.has(c.lang_hash, w.hash)
            at = np.flatnonzero((w.same_piece & passes & c.own)[:-1] & passes[1:]) if w.n > 1 else np.zeros(0, np.int64)
            place, sums, _ = _sums(c.number[at] * c.n_distinct + w.code[at + 1], c.weight[at])
            one = at[place]
            yield pa.RecordBatch.from_arrays([pa.array(_mixed(c.lang_hash[one], w.hash[one], w.hash[one + 1]).view(np.int64)), pa.array(sums, pa.int64())], ["hash", "times"])

    rows = dictionary.select("lang", "chunk", "own", "times").mapInArrow(counts, "hash bigint, times bigint")
    return rows.groupBy("hash").agg(F.sum("times").alias("times")).where(F.col("times") >= min_count).select("hash")


def counted(dictionary: DataFrame, sizes: tuple[int, ...], pairs: PhraseFilter | None = None) -> DataFrame:
    """(lang, phrase, size, times): how often phrases of the given numbers of words occur, those of two or more where all pairs in them pass ``pairs``.

    A batch's phrases are added up before they leave the worker.
    """
    shared = dictionary.sparkSession.sparkContext.broadcast(pairs.bits) if pairs is not None else None
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("times", pa.int64())])

    def counts(batches):
        sieve = PhraseFilter(shared.value) if shared is not None else None
        for batch in batches:
            c = _Chunks(batch)
            w = c.words
            # phrases that begin at ``at``, numbered by ``number`` among the batch's; ``joins``: a word and the next are a pair
            at, number, joins = np.arange(w.n), c.number, w.same_piece
            if sieve is not None and w.n:
                joins = joins & np.append(sieve.has(c.lang_hash[:-1], w.hash[:-1], w.hash[1:]), False)
            for reach in range(1, max(sizes) + 1):
                if reach > 1:
                    good = joins[at + reach - 2]
                    _, _, dense = _sums(number[good], c.weight[at[good]])
                    at = at[good]
                    number = dense * c.n_distinct + w.code[at + reach - 1]
                if reach in sizes:
                    mine = at[c.own[at]]
                    place, sums, _ = _sums(number[c.own[at]], c.weight[mine])
                    one = mine[place]
                    columns = [w.distinct.take(pa.array(w.code[one + k])) for k in range(reach)]
                    phrase = pc.binary_join_element_wise(*columns, " ") if reach > 1 else columns[0]
                    yield pa.RecordBatch.from_arrays([c.langs.take(pa.array(c.lang[one])), phrase, pa.array(np.full(len(one), reach, np.int32)), pa.array(sums, pa.int64())], schema=schema)

    rows = dictionary.select("lang", "chunk", "own", "times").mapInArrow(counts, "lang string, phrase string, size int, times bigint")
    return rows.groupBy("lang", "phrase", "size").agg(F.sum("times").alias("times"))


def frequent_phrases(dictionary: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, times): all phrases of up to ``longest`` words that occur ``min_count`` times or more, counted exactly."""
    enough = F.col("times") >= min_count
    ones = stored(counted(dictionary, (1,)).where(enough), "words")
    if longest == 1:
        return ones
    pairs = stored(frequent_pair_hashes(dictionary, phrase_filter(hashed(ones)), min_count), "pairs")
    return ones.unionByName(stored(counted(dictionary, tuple(range(2, longest + 1)), phrase_filter(pairs)).where(enough), "phrases"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, top: int = TOP, modulus: int = MODULUS, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases by the score of their weakest cut.

    A null language is ``und``; null and empty texts have no words. n counts all
    words of the language, a the phrase's occurrences, l and r those of the parts
    on both sides of the cut with the least floor(1000 a n / (l r)), the first of
    equals. A phrase inside a longer one with as many occurrences is left out. All
    arithmetic is in whole numbers of up to 38 digits. Equal scores are ordered by
    a, then by the phrase's bytes. Repeated rows count each; an empty table, or
    one without frequent phrases, gives no rows. Both frequent parts of a phrase
    are frequent, so the joins lose none.
    """
    spark: SparkSession = docs.sparkSession
    bounded_batches(spark)
    dictionary = stored(chunk_dictionary(docs, text, lang, modulus, longest), "chunks")
    known = frequent_phrases(dictionary, min_count, longest)
    totals = dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("times")).alias("n"))
    phrases = known.where("size > 1").withColumn("w", F.split("phrase", " "))

    def part(begin, length):
        return F.array_join(F.slice("w", begin, length), " ")

    cuts = phrases.select("lang", "phrase", F.col("times").alias("a"), "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    times = known.select("lang", F.col("phrase").alias("part"), "times")
    cuts = (
        cuts.join(times.select("lang", F.col("part").alias("left"), F.col("times").alias("l")), ["lang", "left"])
        .join(times.select("lang", F.col("part").alias("right"), F.col("times").alias("r")), ["lang", "right"])
        .join(totals, "lang")
    )
    score = F.expr("cast((cast(a as decimal(18,0)) * cast(n as decimal(18,0)) * 1000) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as bigint)")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda b: F.array_join(F.slice("w", b, m), " "))))
    within = phrases.where("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("times").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = weakest.join(within, ["lang", "phrase"], "left").where("longer is null or longer < a")
    order = Window.partitionBy("lang").orderBy(F.col("c.score").desc(), F.col("a").desc(), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "c.l", "c.r", "n", "c.score")

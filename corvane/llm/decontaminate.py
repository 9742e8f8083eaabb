"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive benchmark words. The search slides over a
text's words. The last two words of the window under the cursor are a block; the
shift table says how far the cursor may jump before any pattern can end. Where
the shift is zero, the block's bucket names the candidate patterns, and a direct
comparison confirms an occurrence. Patterns of one length share one set of
tables, so a short item (one window of its own length) doesn't shorten the jumps
of the others.

Where the patterns are too many for one task's memory, shift values and a filter
of hashed windows are kept in tables of fixed size, which skip impossible
positions everywhere; the buckets are then the keys of a join, which compares the
words directly.
"""

from __future__ import annotations

import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import WORD_BYTES, as_bytes, bounded_batches, free_names, stored

WINDOW = 10
#: Windows (about 15 MB of text) that are broadcast and whose tables a worker holds. Larger benchmarks are sieved and joined.
MAX_WINDOWS = 200_000
#: Bits of the number of slots of a sieve's shift values (a byte each) and of its filter (a bit each): 4 MB and 16 MB.
SHIFT_BITS, FILTER_BITS = 22, 27
#: Tasks that each make a sieve of their share of the windows.
SIEVE_TASKS = 8

_FOUND = "struct<n_words: bigint, hits: array<int>, items: array<bigint>>"


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of digits, letters and code points from 0x80 on."""
    return text.translate(WORD_BYTES).split()


def windows_of(text: bytes, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All windows of ``window`` words; a shorter text is one window, one without words has none."""
    words = words_of(text)
    if not words:
        return []
    return [tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


class WuManber:
    """Shift and bucket tables for patterns of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], set[int]]):
        self.items = patterns
        self.length = len(next(iter(patterns)))
        self.block = min(2, self.length)
        self.jump = self.length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], set[tuple[bytes, ...]]] = defaultdict(set)
        for p in patterns:
            for end in range(self.block, self.length + 1):
                key = p[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.jump), self.length - end)
            self.bucket[p[-self.block :]].add(p)

    def search(self, words: list[bytes], hits: set[int], items: set[int]) -> None:
        length, jump, shift, n = self.length, self.jump, self.shift.get, len(words)
        at = length  # the window is words[at - length:at]
        while at <= n:
            key = (words[at - 2], words[at - 1]) if self.block == 2 else (words[at - 1],)
            step = shift(key, jump)
            if step:
                at += step
                continue
            found = tuple(words[at - length : at])
            if found in self.bucket[key]:
                hits.update(range(at - length, at))
                items |= self.items[found]
            at += 1


def _tables(rows: list[tuple[int, bytes]]) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], set[int]]] = defaultdict(lambda: defaultdict(set))
    for item, pattern in rows:
        words = tuple(pattern.split(b" "))
        by_length[len(words)][words].add(item)
    return [WuManber(dict(p)) for _, p in sorted(by_length.items())]


def _searcher(rows):
    """A column function that searches texts for one block of patterns."""

    @arrow_udf(_FOUND)
    def search(texts: pa.Array) -> pa.Array:
        tables = _cached_tables(rows)
        n_words, hit_lists, item_lists = [], [], []
        for text in as_bytes(texts):
            words = words_of(text)
            hits: set[int] = set()
            items: set[int] = set()
            for t in tables:
                t.search(words, hits, items)
            n_words.append(len(words))
            hit_lists.append(sorted(hits))
            item_lists.append(sorted(items))
        return pa.StructArray.from_arrays(
            [
                pa.array(n_words, pa.int64()),
                pa.array(hit_lists, pa.list_(pa.int32())),
                pa.array(item_lists, pa.list_(pa.int64())),
            ],
            ["n_words", "hits", "items"],
        )

    return search


_TABLES: dict[int, list[WuManber]] = {}


def _cached_tables(rows) -> list[WuManber]:
    """The tables of a broadcast block, built once in a worker."""
    if rows.id not in _TABLES:
        _TABLES.clear()
        _TABLES[rows.id] = _tables(rows.value)
    return _TABLES[rows.id]


class _Block:
    """A broadcast block of patterns with an id that workers can cache tables by."""

    def __init__(self, spark, rows):
        self.broadcast = spark.sparkContext.broadcast(rows)
        self.id = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "id": self.id}

    @property
    def value(self):
        return self.broadcast.value


def pattern_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, pattern) of each distinct window, words joined by a space."""

    @arrow_udf("array<binary>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([[b" ".join(w) for w in windows_of(t, window)] for t in as_bytes(texts)], pa.list_(pa.binary()))

    return (
        benchmark.where(F.col(item_id).isNotNull())
        .select(F.col(item_id).cast("long").alias("item_id"), F.explode(split(F.col(text))).alias("pattern"))
        .distinct()
    )


class Sieve:
    """What is small enough to be everywhere when the windows aren't: shift values by hashed block and bits by hashed window.

    A hash collision lowers a shift or sets a bit, so it only lets an impossible
    position through. The sizes are fixed, whatever the number of windows.
    """

    def __init__(self, window: int):
        self.window, self.lengths = window, np.zeros(window + 1, bool)
        self.shift = np.full(1 << SHIFT_BITS, min(window, 255), np.uint8)
        self.bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)

    @staticmethod
    def word_hashes(words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))

    @staticmethod
    def block_slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each block of two words."""
        return ((left * np.uint64(0x9E3779B97F4A7C15)) ^ (right * np.uint64(0xC2B2AE3D27D4EB4F))) >> np.uint64(64 - SHIFT_BITS)

    @staticmethod
    def window_slots(columns: list[np.ndarray]) -> np.ndarray:
        """The bit of each window; a column holds the hashes of the windows' words at one place."""
        mixed = np.full(len(columns[0]), len(columns), np.uint64)
        for hashes in columns:
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes
        return (mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - FILTER_BITS)

    def add(self, patterns: list[bytes]) -> None:
        by_length: dict[int, list[bytes]] = defaultdict(list)
        for pattern in patterns:
            words = pattern.split(b" ")
            by_length[len(words)] += words
        for length, words in by_length.items():
            self.lengths[length] = True
            columns = list(self.word_hashes(words).reshape(-1, length).T)
            slots = self.window_slots(columns)
            np.bitwise_or.at(self.bits, slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8))
            if length == self.window > 1:
                for k in range(length - 1):
                    np.minimum.at(self.shift, self.block_slots(columns[k], columns[k + 1]), np.uint8(min(length - 2 - k, 255)))

    def merge(self, other: Sieve) -> None:
        self.lengths |= other.lengths
        np.minimum(self.shift, other.shift, out=self.shift)
        self.bits |= other.bits

    def places(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, length) of each window that may be a pattern."""
        hashes, out = self.word_hashes(words), []
        for length in np.nonzero(self.lengths)[0].tolist():
            if len(words) < length:
                break
            at = np.arange(len(words) - length + 1)
            if length == self.window > 1:
                at = at[self.shift[self.block_slots(hashes[length - 2 : -1], hashes[length - 1 :])] == 0]
            slots = self.window_slots([hashes[at + k] for k in range(length)])
            out += [(k, length) for k in at[self.bits[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1 == 1].tolist()]
        return out


def sieve_of(windows: DataFrame, window: int) -> Sieve:
    """The sieve of all windows: each of a few tasks makes one of its share, and the driver merges those."""

    def made(batches):
        own = Sieve(window)
        for batch in batches:
            own.add(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_pydict({"sieve": [pickle.dumps(own)]})

    whole = Sieve(window)
    for r in windows.select("pattern").repartition(SIEVE_TASKS).mapInArrow(made, "sieve binary").toLocalIterator():
        whole.merge(pickle.loads(r.sieve))
    return whole


def _joined_hits(docs: DataFrame, windows: DataFrame, text: str, name: str, window: int) -> DataFrame:
    """As with_hits(), for any number of windows: what passes the sieve meets the windows in an equi-join on their words.

    Occurrences are found per distinct text, by its MD5, so groups of copies give
    no more rows than one of them. Adaptive execution splits a window that occurs
    in very many texts.
    """
    sieve = docs.sparkSession.sparkContext.broadcast(sieve_of(windows, window))

    @arrow_udf("array<struct<first: int, length: int, pattern: binary>>")
    def places(texts: pa.Array) -> pa.Array:
        out = []
        for body in as_bytes(texts):
            words = words_of(body)
            out.append([{"first": at, "length": n, "pattern": b" ".join(words[at : at + n])} for at, n in sieve.value.places(words)])
        return pa.array(out, pa.list_(pa.struct([("first", pa.int32()), ("length", pa.int32()), ("pattern", pa.binary())])))

    key, other = free_names([*docs.columns, name], "text_key", "hit_key")
    digest = F.md5(F.col(text).cast("binary"))
    spots = docs.select(digest.alias("key"), F.explode(places(F.col(text))).alias("p")).select("key", "p.first", "p.length", "p.pattern").distinct()
    found = (
        spots.join(windows, "pattern")
        .groupBy(F.col("key").alias(other))
        .agg(F.collect_set(F.struct("first", "length")).alias("spots"), F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(other, "items", F.array_sort(F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s["first"], s["first"] + s["length"] - 1))))).alias("hits"))
    )
    n_words = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")), F.lit(0)).cast("long")
    empty = "cast(array() as array<{}>)"
    joined = docs.withColumn(key, digest).join(found.select(other, F.struct("hits", "items").alias(name)), F.col(key) == F.col(other), "left")
    made = F.struct(n_words.alias("n_words"), *[F.coalesce(F.col(name)[c], F.expr(empty.format(t))).alias(c) for c, t in (("hits", "int"), ("items", "bigint"))])
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], made.alias(name))


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    name: str = "found",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` and a struct column ``name``: n_words, hits (word positions inside occurrences), items (ids).

    The distinct windows are stored and counted first. Up to ``max_windows`` of
    them go to the executors as one broadcast, whose tables a worker builds once;
    beyond that only a sieve of fixed size is broadcast, and the windows stay in
    Spark. Both give the same rows. Null and empty texts have no words; an item
    without words or with a null id matches nothing; repeated items each count by
    their id. Empty tables give no rows or no hits.
    """
    bounded_batches(docs.sparkSession)
    windows = stored(pattern_windows(benchmark, item_id, item_text, window), "windows")
    if windows.count() > max_windows:
        return _joined_hits(docs, windows, text, name, window)
    rows = [(r.item_id, bytes(r.pattern)) for r in windows.toLocalIterator()]
    return docs.withColumn(name, _searcher(_Block(docs.sparkSession, rows))(F.col(f"`{text}`")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in whose text a benchmark window occurs. Columns stay as they are, whatever their names.

    Null and empty texts stay, repeated rows share their fate, and an empty
    benchmark leaves all rows.
    """
    (name,) = free_names(docs.columns, "hits")
    found = with_hits(docs, benchmark, name, text, **options)
    return found.where(F.size(F.col(name)["hits"]) == 0).drop(name)

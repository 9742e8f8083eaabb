"""Token ids in packs: documents compressed one by one with a shared zstandard dictionary.

A pack is a Parquet row: the frames of consecutive documents end to end, and
arrays with each document's id, the end of its frame, its number of ids and its
place. A short document is read by its pack's id range, its offset and the
dictionary, without touching its neighbours. The dictionary is trained once on
serialized id arrays and stored beside the packs under its SHA-256, which each
pack names. Parquet rows rather than loose files let Spark commit each task's
output, so a lost executor leaves no half-written pack, and any store works.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import BATCH_BYTES, bounded_batches, stored

END_ID = 2
#: Documents (whole) that the dictionary is trained on, those with the smallest hashes of their ids, as far as their
#: bytes fit, and its size.
TRAINING_DOCUMENTS, TRAINING_BYTES, DICTIONARY_BYTES = 512, 32 << 20, 65_536
LEVEL = 3
#: Bytes of frames after which a pack is closed.
PACK_BYTES = 1 << 18
#: Bytes of frames in an id range, which one task orders and packs; and the most ranges, beyond which each holds more.
#: A task sorts its range with spilling and leaves it pack by pack, so its memory doesn't grow with the range.
RANGE_BYTES, MAX_RANGES = 16 << 20, 20_000
#: Pieces whose ids a worker remembers before it drops the older half: about 60 MB.
REMEMBERED_PIECES = 300_000
#: Bytes of texts that are parted into pieces at once (one text at least), and pieces that are encoded in one call.
PARTED_BYTES, CALL_PIECES = 3 << 20, 2_000

# The settings of a tokenizer under which texts may be encoded piece by piece.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PRETOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

#: Precomposed Latin letters whose lower case is one letter of them, ASCII digits, marks and white space: in texts of
#: these alone, what the normalizers and _SPLIT do is to lower, to set off _SET_OFF and to part at white space.
_LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}"
_MARKS = r"\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e"
_NOT_PLAIN = rf"[^{_LETTERS}0-9{_MARKS}\t-\r ]"
_SET_OFF = rf"('(?:s|t|re|ve|m|ll|d)|[0-9]|[{_MARKS}]+)"


def _halved(known: dict, limit: int) -> None:
    if len(known) > limit:
        for key in list(islice(known, len(known) // 2)):
            del known[key]


class PieceEncoder:
    """Ids of whole texts as bytes, with the ids of pieces remembered.

    Where the tokenizer's own settings are those above, it never joins tokens
    across the edges of pieces, so a plain text's ids are those of its pieces end
    to end, and only pieces that the worker hasn't met are encoded, many in a
    call; the last id of a piece is one that ends a piece, which parts them
    again. Texts with other characters, texts that hold an added token, and all
    texts of other tokenizers are encoded whole.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        top = max(vocabulary.values(), default=0)
        self.kind = np.dtype("<u4" if max(top, end_id) > 0xFFFF else "<u2")
        self.end = np.array([end_id], self.kind).tobytes()
        settings = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in settings["added_tokens"]]
        model, suffix = settings["model"], settings["model"].get("end_of_word_suffix")
        self.by_piece = (
            (settings["normalizer"] or {}).get("normalizers") == _NORMALIZERS
            and (settings["pre_tokenizer"] or {}).get("pretokenizers") == _PRETOKENIZERS
            and model.get("type") == "BPE" and bool(suffix) and not model.get("dropout")
        )
        self.ends_piece = np.zeros(top + 1, bool)
        if self.by_piece:
            self.ends_piece[[k for word, k in vocabulary.items() if word.endswith(suffix)]] = True
        self.pieces: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        width = self.kind.itemsize
        for k in range(0, len(pieces), CALL_PIECES):
            part = pieces[k : k + CALL_PIECES]
            data = self._whole([" ".join(part)])[0]
            ends = ((np.nonzero(self.ends_piece[np.frombuffer(data, self.kind)])[0] + 1) * width).tolist()
            if len(ends) != len(part):
                raise ValueError("a piece has no single id that ends it")
            self.pieces.update(zip(part, map(data.__getitem__, map(slice, [0, *ends], ends)), strict=True))

    def _by_pieces(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of plain texts, from their distinct pieces."""
        parted = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), _SET_OFF, r" \1 "))
        at = parted.offsets.to_numpy()
        coded = parted.values[at[0] : at[-1]].dictionary_encode()
        # one text of all distinct pieces is much cheaper to hand over than each by itself
        distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "\n")[0].as_py().split("\n")
        _halved(self.pieces, REMEMBERED_PIECES)
        known = self.pieces
        known[""] = b""
        self._learn([p for p in distinct if p not in known])
        ids = [known[p] for p in distinct]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        starts, store = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(ids), self.kind)
        which = coded.indices.to_numpy()
        n = lengths[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        index = np.int32 if max(len(store), ends[-1]) < 1 << 31 else np.int64
        place = np.repeat((starts[which] - ends[:-1]).astype(index), n)
        place += np.arange(ends[-1], dtype=index)
        return np.split(store[place], ends[at[1:-1] - at[0]])

    def encode_texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, the end id last; null counts as empty."""
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(texts, _NOT_PLAIN) if self.by_piece else pa.array([True] * len(texts), pa.bool_())
        for token in self.added:
            apart = pc.or_(apart, pc.match_substring(texts, token))
        plain = texts.filter(pc.invert(apart))
        sizes = np.cumsum(pc.binary_length(plain).to_numpy(zero_copy_only=False))

        def by_pieces():
            row = 0
            while row < len(plain):
                stop = max(row + 1, int(np.searchsorted(sizes, (sizes[row - 1] if row else 0) + PARTED_BYTES, "right")))
                yield from self._by_pieces(plain.slice(row, stop - row))
                row = stop

        done = by_pieces()
        for k, is_apart in enumerate(apart.to_pylist()):
            yield (self._whole([texts[k].as_py()])[0] if is_apart else next(done).tobytes()) + self.end

    def encode(self, text: str) -> bytes:
        return next(self.encode_texts(pa.array([text], pa.string())))


_ENCODERS: dict[tuple[str, int], PieceEncoder] = {}


def encoder(path: str, end_id: int) -> PieceEncoder:
    """The worker's encoder; the tokenizer's own threads stay off, as Spark's tasks use the cores."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = PieceEncoder(path, end_id)
    return _ENCODERS[path, end_id]


@dataclass
class TokenPacks:
    """Where a written data set is, and the width of its ids."""

    path: str
    dictionary_sha256: str
    id_type: str


def train_dictionary(docs: DataFrame, tokenizer: str, doc_id: str, text: str, end_id: int = END_ID) -> bytes:
    """A dictionary from a sample bounded in rows and bytes; empty where there is too little to train on.

    The sample is chosen on the ids alone: those below a bound on their hashes,
    which about twice as many distinct ids as needed fall under, are made distinct
    and put in order. Texts are read once, for the chosen ids, and the few that are
    chosen are stored, so that their sizes and ids come from the same rows.
    """
    ids = docs.where(F.col(doc_id).isNotNull()).select(doc_id)
    share = 2 * TRAINING_DOCUMENTS / max(1, ids.agg(F.approx_count_distinct(doc_id)).head()[0])
    place = F.xxhash64(doc_id)
    near = ids.where(place < F.lit(-(1 << 63) + int(share * (1 << 64)))) if share < 1 else ids
    chosen = [r[0] for r in near.distinct().orderBy(place, doc_id).limit(TRAINING_DOCUMENTS).collect()]
    few = stored(docs.where(F.col(doc_id).isin(chosen)).select(doc_id, text).dropDuplicates([doc_id]), "sample")
    ids, held = [], 0
    for r in few.select(doc_id, F.coalesce(F.octet_length(F.col(text)), F.lit(0)).alias("n")).orderBy(place, doc_id).collect():
        if held + r.n <= TRAINING_BYTES:
            ids.append(r[0])
            held += r.n

    @arrow_udf(T.BinaryType())
    def serialized(texts: pa.Array) -> pa.Array:
        enc = encoder(tokenizer, end_id)
        return pa.array(list(enc.encode_texts(texts)), pa.binary())

    sample = few.where(F.col(doc_id).isin(ids)).orderBy(doc_id).select(serialized(F.col(text)).alias("b"))
    samples = [bytes(r.b) for r in sample.toLocalIterator()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def write_packs(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    range_bytes: int = RANGE_BYTES,
    pack_bytes: int = PACK_BYTES,
) -> TokenPacks:
    """Encodes every whole text (null: empty), appends ``end_id`` and writes packs in ascending order of the id.

    ``doc_id`` is a whole number; null ids come first, and repeated ids follow
    each other. Texts are encoded and compressed where they are read. The frames
    are stored, so that the sampling of ranges reads ids alone and encodes nothing
    twice; then a range sort by id orders them, and each task leaves its range
    pack by pack. Rows of one id may fall into several ranges.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    dictionary = train_dictionary(docs, tokenizer, doc_id, text, end_id)
    sha = hashlib.sha256(dictionary).hexdigest()
    shared = spark.sparkContext.broadcast(dictionary)
    spark.range(1).coalesce(1).select(F.lit(sha).alias("dictionary_sha256"), F.lit(bytearray(dictionary)).alias("dictionary")).write.parquet(f"{path}/dictionary")

    frame = T.StructType([T.StructField("frame", T.BinaryType()), T.StructField("n", T.LongType())])

    @arrow_udf(frame)
    def framed(texts: pa.Array) -> pa.Array:
        enc = encoder(tokenizer, end_id)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        frames, counts = [], []
        for body in enc.encode_texts(texts):
            frames.append(press.compress(body))
            counts.append(len(body) // enc.kind.itemsize)
        return pa.StructArray.from_arrays([pa.array(frames, pa.binary()), pa.array(counts, pa.int64())], ["frame", "n"])

    rows = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), framed(F.col(text)).alias("f")).select("doc_id", "f.frame", "f.n", F.xxhash64("f.frame").alias("tie")), "frames")
    n_ranges = min(MAX_RANGES, max(1, -(-(rows.agg(F.sum(F.octet_length("frame"))).head()[0] or 0) // range_bytes)))

    def packed(batches):
        ids: list = []
        counts: list = []
        frames: list = []
        held, number, part = 0, 0, None

        def pack():
            ends = np.cumsum([len(x) for x in frames], dtype=np.int64).tolist()
            return pa.RecordBatch.from_pydict(
                {"part": [part], "pack": [number], "dictionary_sha256": [sha], "doc_ids": [list(ids)], "ends": [ends], "counts": [list(counts)], "frames": [b"".join(frames)]},
                schema=pack_schema,
            )

        pack_schema = pa.schema(
            [("part", pa.int32()), ("pack", pa.int32()), ("dictionary_sha256", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("frames", pa.binary())]
        )
        for batch in batches:
            for p, d, f, n in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if frames and (p != part or held >= pack_bytes):
                    yield pack()
                    number = number + 1 if p == part else 0
                    ids, counts, frames, held = [], [], [], 0
                part = p
                ids.append(d)
                counts.append(n)
                frames.append(f)
                held += len(f)
        if frames:
            yield pack()

    order = ("doc_id", "tie")
    packs = (
        rows.repartitionByRange(n_ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .select("part", "doc_id", "frame", "n")
        .mapInArrow(packed, "part int, pack int, dictionary_sha256 string, doc_ids array<bigint>, ends array<bigint>, counts array<bigint>, frames binary")
    )
    # the index of a pack is small beside its frames; the range of ids lets Parquet skip whole packs
    packs.withColumns({"first_id": F.array_min("doc_ids"), "last_id": F.array_max("doc_ids"), "n_ids": F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)}).write.option(
        "compression", "uncompressed"
    ).option("parquet.block.size", 16 * pack_bytes).parquet(f"{path}/packs")
    return TokenPacks(path, sha, encoder(tokenizer, end_id).kind.str)


def _load_dictionary(spark: SparkSession, packs: TokenPacks) -> bytes:
    data = bytes(spark.read.parquet(f"{packs.path}/dictionary").where(F.col("dictionary_sha256") == packs.dictionary_sha256).head().dictionary)
    if hashlib.sha256(data).hexdigest() != packs.dictionary_sha256:
        raise ValueError("the dictionary's content doesn't match its hash")
    return data


def read_documents(spark: SparkSession, packs: TokenPacks, doc_ids: list[int] | None = None, checksums: bool = False) -> DataFrame:
    """(doc_id, part, pack, before, n_tokens, ids binary) of all documents, or of those with the given ids.

    ``before`` counts the ids of the pack's earlier documents. For given ids only
    packs whose range may hold them are read, and only the frames at their
    offsets are decompressed. ids are little-endian unsigned 32-bit integers;
    ``checksums`` gives ids_crc32 (unsigned, of all those bytes) in their place.
    """
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(_load_dictionary(spark, packs))
    packed = spark.read.parquet(f"{packs.path}/packs")
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if doc_ids is not None:
        hit = F.lit(False)
        for d in doc_ids:
            hit = hit | ((F.col("first_id") <= d) & (F.col("last_id") >= d))
        packed = packed.where(hit)
    last = pa.field("ids_crc32", pa.int64()) if checksums else pa.field("ids", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("pack", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), last])

    def unpacked(batches):
        press = zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))
        for batch in batches:
            for r in range(batch.num_rows):
                part, number, sha, ids, ends, counts = (batch.column(k)[r].as_py() for k in range(6))
                if sha != packs.dictionary_sha256:
                    raise ValueError("a pack names another dictionary")
                body, begin, before, rows, held = memoryview(batch.column(6)[r].as_buffer()), 0, 0, [], 0
                for d, end, n in zip(ids, ends, counts, strict=True):
                    if wanted is None or d in wanted:
                        data = np.frombuffer(press.decompress(body[begin:end]), packs.id_type).astype("<u4").tobytes()
                        rows.append((d, part, number, before, n, zlib.crc32(data) if checksums else data))
                        held += 0 if checksums else len(data)
                    begin, before = end, before + n
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    columns = ["part", "pack", "dictionary_sha256", "doc_ids", "ends", "counts", "frames"]
    kind = "ids_crc32 bigint" if checksums else "ids binary"
    return packed.select(*columns).mapInArrow(unpacked, f"doc_id bigint, part int, pack int, before bigint, n_tokens bigint, {kind}")


def pack_starts(spark: SparkSession, packs: TokenPacks) -> DataFrame:
    """(part, pack, at): the ids of all documents before each pack, from the packs' indexes alone.

    One running sum goes over a small row per range, another within each range.
    """
    index = spark.read.parquet(f"{packs.path}/packs").select("part", "pack", "n_ids")
    ranges = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = ranges.select(
        "part", F.expr("coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0)").alias("range_at")
    )
    inside = F.expr("coalesce(sum(n_ids) over (partition by part order by pack rows between unbounded preceding and 1 preceding), 0)")
    return index.withColumn("pack_at", inside).join(before, "part").select("part", "pack", (F.col("range_at") + F.col("pack_at")).alias("at"))

"""Byte-pair encoding of whole texts as a tree of halves, and decoding.

A long text is cut in half until its leaves are short, wherever the middle falls,
inside words too. The leaves are rows that Spark deals over all tasks, so a long
text is no single task's work. Neighbours are then joined, level by level: the
piece that a cut went through is encoded anew in a window around the join, which
grows until it holds a token of the left half and a token of the right half as
these had them. Two tokens may stand side by side in an encoding exactly if they
are what their own text gives, whatever is around them, so from the agreed tokens
outwards both halves stand as they are, and the result equals the encoding of the
whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import bounded_batches, free_names
from corvane.llm.token_packs import _NOT_PLAIN, PARTED_BYTES, REMEMBERED_PIECES, PieceEncoder, _halved

#: Code points of a leaf: longer texts are cut.
LEAF_CHARS = 8_192
#: Tokens on each side of a join that the first window holds.
FIRST_WINDOW = 4

_LEAVES = "array<struct<text: string, special: int, inside: boolean>>"


class TreeEncoder(PieceEncoder):
    """Encodes leaves of normalized text and joins the ids of halves."""

    def __init__(self, path: str):
        super().__init__(path)
        self.end = b""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values(), default=0) + 1
        self.token = [None] * size
        for word, k in vocabulary.items():
            self.token[k] = word
        self.closes = np.zeros(size, bool)
        self.closes[: len(self.ends_piece)] = self.ends_piece[:size]
        self.added_ids = {t: vocabulary[t] for t in self.added}
        self.closes[list(self.added_ids.values())] = True
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.at_added = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.piece_ids: dict[str, bytes] = {}
        self.arrow_tokens = pa.array(self.token, pa.string())
        self.plain_join = self.tokenizer.decoder is None

    # cutting

    def leaves(self, text: str, leaf_chars: int) -> list[dict]:
        """The leaves of a text in order: its normalized parts, or an added token's id; ``inside`` where the cut before a leaf parts a piece.

        A cut keeps three characters away from apostrophes, so that no contraction
        reaches across it; a stretch without such a place isn't cut.
        """
        out: list[dict] = []
        at = 0
        for m in self.at_added.finditer(text) if self.at_added else ():
            self._cut(text[at : m.start()], leaf_chars, out)
            out.append({"text": None, "special": self.added_ids[m[0]], "inside": False})
            at = m.end()
        self._cut(text[at:], leaf_chars, out)
        return out

    def _cut(self, text: str, leaf_chars: int, out: list[dict]) -> None:
        if not text:
            return
        whole = self.tokenizer.normalizer.normalize_str(text)
        begin, todo = 0, [(0, len(whole))]
        while todo:
            lo, hi = todo.pop()
            p = self._middle(whole, lo, hi) if hi - lo > max(leaf_chars, 1) else None
            if p is None:
                part = whole[begin:hi]
                around = whole[begin - 1 : begin + 1] if begin else ""
                inside = [at for _, at in self.tokenizer.pre_tokenizer.pre_tokenize_str(around)] == [(0, 2)]
                out.append({"text": part, "special": None, "inside": inside})
                begin = hi
            else:
                todo += [(p, hi), (lo, p)]

    @staticmethod
    def _middle(text: str, lo: int, hi: int) -> int | None:
        middle = (lo + hi) // 2
        for away in range((hi - lo) // 4 + 1):
            for p in (middle - away, middle + away):
                if lo < p < hi and "'" not in text[max(p - 3, 0) : p + 3]:
                    return p
        return None

    # encoding

    def _normalized(self, text: str) -> np.ndarray:
        """The ids of a normalized text, piece by piece; it is not normalized again, and added tokens aren't looked for."""
        _halved(self.piece_ids, REMEMBERED_PIECES)
        known, out = self.piece_ids, []
        for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            if piece not in known:
                known[piece] = np.array([t.id for t in self.tokenizer.model.tokenize(piece)], self.kind).tobytes()
            out.append(known[piece])
        return np.frombuffer(b"".join(out), self.kind)

    def encode_leaves(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each normalized leaf."""
        apart = pc.match_substring_regex(texts, _NOT_PLAIN)
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
            yield self._normalized(texts[k].as_py()) if is_apart else next(done)

    # joining

    def _surface(self, k: int) -> str:
        return self.token[k].removesuffix(self.suffix) if self.closes[k] else self.token[k]

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of the text whose halves have the ids ``left`` and ``right``, where the cut parts a piece."""
        before = np.nonzero(self.closes[left[:-1]])[0]
        first = int(before[-1]) + 1 if len(before) else 0  # the parted piece is left[first:] and right[:last]
        last = int(np.argmax(self.closes[right])) + 1
        n_left, n_right = len(left) - first, last
        a = b = FIRST_WINDOW
        while True:
            a, b = min(a, n_left), min(b, n_right)
            tokens = [*left[len(left) - a :].tolist(), *right[:b].tolist()]
            texts = [self._surface(k) for k in tokens]
            starts = np.cumsum([0, *map(len, texts)]).tolist()
            window = [t.id for t in self.tokenizer.model.tokenize("".join(texts))]
            at = np.cumsum([0, *(len(self._surface(k)) for k in window)]).tolist()
            # the half's own last token, and the window's, carry the mark of an end that isn't there
            lefts = {(starts[i], tokens[i]): i for i in range(a - 1)}
            rights = {(starts[i], tokens[i]): i for i in range(a, a + b)}
            head = (0, 0) if a == n_left else next(((m, lefts[at[m], k]) for m, k in enumerate(window) if (at[m], k) in lefts), None)
            n = len(window)
            tail = (n - 1, a + b - 1) if b == n_right else next(((m, rights[at[m], window[m]]) for m in range(n - 2, -1, -1) if (at[m], window[m]) in rights), None)
            if head and tail:
                break
            a, b = a if head else 2 * a, b if tail else 2 * b
        return np.concatenate([left[: len(left) - a + head[1]], np.array(window[head[0] : tail[0] + 1], self.kind), right[tail[1] - a + 1 :]])

    def concatenated(self, leaves: list[tuple[bool, np.ndarray]]) -> np.ndarray:
        """The ids of a text from those of its leaves in order, neighbours joined level by level."""
        while len(leaves) > 1:
            up = []
            for k in range(0, len(leaves) - 1, 2):
                (inside, left), (parted, right) = leaves[k], leaves[k + 1]
                up.append((inside, self.joined(left, right) if parted else np.concatenate([left, right])))
            leaves = up + leaves[len(leaves) // 2 * 2 :]
        return leaves[0][1] if leaves else np.array([], self.kind)

    # decoding

    def decode_lists(self, ids: pa.Array) -> pa.Array:
        """The text of each list of ids, as the library decodes it with special tokens kept; null is empty."""
        lists = pc.fill_null(ids, pa.scalar([], ids.type))
        values = pc.list_flatten(lists)
        numbers = values.to_numpy(zero_copy_only=False)
        known = not values.null_count and (not len(numbers) or (numbers.min() >= 0 and numbers.max() < len(self.token)))
        if self.plain_join and known:
            words = self.arrow_tokens.take(values)
            if not words.null_count:
                counts = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int32)
                return pc.binary_join(pa.ListArray.from_arrays(pa.array(counts, pa.int32()), words), " ")
        return pa.array([self.tokenizer.decode([k for k in x if k is not None and k >= 0], skip_special_tokens=False) for x in lists.to_pylist()], pa.string())


_ENCODERS: dict[str, TreeEncoder] = {}


def encoder(path: str) -> TreeEncoder:
    """The worker's encoder; the tokenizer's own threads stay off, as Spark's tasks use the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = TreeEncoder(path)
    return _ENCODERS[path]


def _id_lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays], dtype=np.int64)]).astype(np.int32)
    values = np.concatenate(arrays).astype(np.int32) if arrays else np.array([], np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encoded(docs: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), name: str = "ids", leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """The columns ``keep`` of every row and ``name``: the ids of its whole text, as the library gives them without special tokens added.

    Texts of up to ``leaf_chars`` code points are encoded where they are read. Of
    longer ones the leaves are dealt over the tasks by a hash of row and place,
    encoded there, and meet again by row, where their ids are joined; what meets
    is one row's, so no bigger than what is returned for it. Rows are told apart
    by their place in the input, so repeated rows and ids stay apart. Null and
    empty texts have no ids. Tokenizers whose settings are other than the known
    ones encode each text whole, where it is read.
    """
    bounded_batches(docs.sparkSession)
    row, leaf, place, own = free_names([*docs.columns, name, "inside", "ids"], "row", "leaf", "place", "own")
    kept = [F.col(f"`{c}`") for c in keep]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    cuts = encoder(tokenizer).by_piece

    @arrow_udf("array<int>")
    def whole(texts: pa.Array) -> pa.Array:
        enc = encoder(tokenizer)
        return _id_lists([np.frombuffer(x, enc.kind) for x in enc.encode_texts(texts)])

    @arrow_udf(_LEAVES)
    def halved(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("text", pa.string()), ("special", pa.int32()), ("inside", pa.bool_())]))
        return pa.array([encoder(tokenizer).leaves(t.as_py(), leaf_chars) for t in texts], kind)

    @arrow_udf("array<int>")
    def of_leaf(texts: pa.Array, specials: pa.Array) -> pa.Array:
        enc = encoder(tokenizer)
        done = list(enc.encode_leaves(pc.fill_null(texts, "")))
        return _id_lists([x if s is None else np.array([s], enc.kind) for x, s in zip(done, specials.to_pylist(), strict=True)])

    @arrow_udf("array<int>")
    def together(leaves: pa.Array) -> pa.Array:
        enc, out = encoder(tokenizer), []
        for x in leaves:
            parts = x.values
            flags, lists = parts.field("inside").to_pylist(), parts.field("ids")
            out.append(enc.concatenated([(f, lists[k].values.to_numpy().astype(enc.kind)) for k, f in enumerate(flags)]))
        return _id_lists(out)

    if not cuts:
        return docs.select(*kept, whole(value).alias(name))
    long = F.char_length(value) > leaf_chars
    short_ids = docs.where(~long).select(*kept, whole(value).alias(name))
    numbered = docs.where(long).select(F.monotonically_increasing_id().alias(row), F.struct(*kept).alias(own), halved(value).alias(leaf))
    cut = numbered.select(row, own, F.posexplode_outer(leaf).alias(place, leaf))
    # the first leaf takes the row's columns along
    cut = cut.withColumn(own, F.when(F.coalesce(F.col(place), F.lit(0)) == 0, F.col(own)))
    dealt = cut.repartition(F.col(row), F.col(place))
    ids = dealt.select(row, own, place, F.col(leaf)["inside"].alias("inside"), of_leaf(F.col(leaf)["text"], F.col(leaf)["special"]).alias(leaf))
    parts = F.array_sort(F.collect_list(F.struct(F.col(place), F.col("inside"), F.col(leaf).alias("ids"))))
    gathered = ids.groupBy(row).agg(F.first(own, ignorenulls=True).alias(own), parts.alias(leaf))
    return short_ids.unionByName(gathered.select(*[F.col(own)[c].alias(c) for c in keep], together(F.col(leaf)).alias(name)))


def decoded(rows: DataFrame, tokenizer: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with ``name``: the text that the library gives for the ids, special tokens kept; null and empty lists give empty texts."""
    bounded_batches(rows.sparkSession)

    @arrow_udf("string")
    def text_of(lists: pa.Array) -> pa.Array:
        return encoder(tokenizer).decode_lists(lists)

    return rows.withColumn(name, text_of(F.col(f"`{ids}`")))

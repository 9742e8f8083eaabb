import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from corvane.llm import token_packs as K  # noqa: E402
from corvane.llm.common import scratch  # noqa: E402
from corvane.llm.queries import op10_token_packs  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def plain_ids(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("text", ["", "a<|endoftext|>b", "  \t a b\nc  ", "É ́e", "ΣΑΣ ΟΔΟΣ.", "don't DON'T", "\U0001f600 x‍y", "\x1c a\x1fb", "a  b c", "x" * 5000, "ÀÉ×÷ß_^~`|{}", "İstanbul ſtraße Ǆ ŉ", "A.b,C...d--e!!?!", "mix\u2026. o'clock 's ''ll"])
def test_words_end_to_end_equal_the_text(text):
    e = K.PieceEncoder(PATH)
    assert np.frombuffer(e.encode(text), e.kind).tolist() == plain_ids(text)


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(K, "REMEMBERED_PIECES", 3)
    e = K.PieceEncoder(PATH)
    for k in range(20):
        assert np.frombuffer(e.encode(f"a{k} b{k} it's"), e.kind).tolist() == plain_ids(f"a{k} b{k} it's")
    assert len(e.pieces) <= 3 + 12


def test_round_trip(spark, make_docs, hard_rows):
    docs = make_docs([*hard_rows, *((k, f"text number {k} " * (k % 9)) for k in range(100, 400))])
    for ranges, pack in ((64 << 20, 1 << 20), (2_000, 300)):
        packs = K.write_packs(docs, scratch(spark, "packs"), PATH, range_bytes=ranges, pack_bytes=pack)
        read = K.read_documents(spark, packs).join(K.pack_starts(spark, packs), ["part", "pack"]).collect()
        assert len(read) == docs.count()
        read.sort(key=lambda r: r["at"] + r.before)
        ids = [r.doc_id if r.doc_id is not None else -1 for r in read]
        assert ids == sorted(ids)
        start = 0
        for r in read:
            assert r["at"] + r.before == start and len(r.ids) == 4 * r.n_tokens
            start += r.n_tokens
        texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None and len(r.text or "") < 1000}
        for r in read:
            if r.doc_id in texts:
                assert np.frombuffer(r.ids, "<u4").tolist() == plain_ids(texts[r.doc_id])
        some = K.read_documents(spark, packs, [150, 301, 999]).collect()
        assert sorted(r.doc_id for r in some) == [150, 301]
    empty = K.write_packs(docs.limit(0), scratch(spark, "packs"), PATH)
    assert K.read_documents(spark, empty).count() == 0


def test_changed_dictionary_is_noticed(spark, make_docs):
    packs = K.write_packs(make_docs([(k, f"some words {k}") for k in range(50)]), scratch(spark, "packs"), PATH)
    other = K.TokenPacks(packs.path, "0" * 64, packs.id_type)
    with pytest.raises(Exception):  # noqa: B017
        K.read_documents(spark, other).collect()


def test_dictionary_sample_is_bounded_and_stays(spark, make_docs, monkeypatch):
    """More distinct ids than the sample takes, and one id that holds most rows; texts that don't fit are passed over."""
    monkeypatch.setattr(K, "TRAINING_DOCUMENTS", 40)
    rows = [(k, f"text number {k} of the sample " * 20) for k in range(600)]
    docs = make_docs([*rows, *[(7, rows[7][1])] * 2000, (None, "no id")])
    one = K.train_dictionary(docs, PATH, "doc_id", "text")
    assert one and one == K.train_dictionary(docs.repartition(5), PATH, "doc_id", "text")
    assert one == K.train_dictionary(docs.dropDuplicates(), PATH, "doc_id", "text")
    monkeypatch.setattr(K, "TRAINING_BYTES", 10)
    assert K.train_dictionary(docs, PATH, "doc_id", "text") == b""


def test_query(spark, sf):
    rows = sorted(op10_token_packs(spark, sf).collect())
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    start = 0
    for r, d in zip(rows, sorted(texts), strict=True):
        ids = np.array(plain_ids(texts[d]) if d % 10 == 0 else [0], "<u4")
        if d % 10 == 0:
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += r.n_tokens


def test_all_plain_characters():
    e = K.PieceEncoder(PATH)
    letters = [chr(c) for c in range(0x21, 0x180) if not pc.match_substring_regex(pa.array([chr(c)]), K._NOT_PLAIN)[0].as_py()]
    text = " ".join(a + b for a in letters for b in "aZ9.!é") + " ".join(letters) + "".join(letters)
    assert np.frombuffer(e.encode(text), e.kind).tolist() == plain_ids(text)


def test_batches_with_nulls_slices_and_special_tokens(monkeypatch):
    monkeypatch.setattr(K, "CALL_PIECES", 4)
    texts = ["drop", None, "", "a b  c", "x <|endoftext|> y", "one two three four five six", "it's", "\u00e9t\u00e9\nz", "last"]
    e = K.PieceEncoder(PATH)
    got = [np.frombuffer(b, e.kind).tolist() for b in e.encode_texts(pa.array(texts)[1:])]
    assert got == [plain_ids(t) for t in texts[1:]]
    assert list(e.encode_texts(pa.array([], pa.string()))) == []


def test_other_settings_are_encoded_whole(tmp_path):
    import json

    from tokenizers import Tokenizer

    settings = json.load(open(PATH))
    settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]+"
    settings["added_tokens"].append({**settings["added_tokens"][0], "id": 49408, "content": "two words"})
    (path := tmp_path / "other.json").write_text(json.dumps(settings))
    e, whole = K.PieceEncoder(str(path)), Tokenizer.from_file(str(path))
    texts = ["room 101b, two words", "it's 12:30", "a two  words"]
    assert not e.by_piece and K.PieceEncoder(PATH).by_piece
    got = [np.frombuffer(b, e.kind).tolist() for b in e.encode_texts(pa.array(texts))]
    assert got == [[*whole.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_random_texts_equal_the_library():
    import random

    rng = random.Random(3)
    alphabet = "abcdefgxyzABZ0189 ''.,-!\n\t\u00e9\u00c9\u0301\u0130\u0131\u03a3\u4e2d\U0001f600\x1c\xa0<|>stmdlrve"
    texts = ["".join(rng.choice(alphabet[: rng.choice((24, 30, len(alphabet)))]) for _ in range(rng.randrange(60))) for _ in range(3000)]
    e = K.PieceEncoder(PATH)
    for text, got in zip(texts, e.encode_texts(pa.array(texts)), strict=True):
        assert np.frombuffer(got, e.kind).tolist() == plain_ids(text)

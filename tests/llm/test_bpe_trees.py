import hashlib
import random
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from corvane.llm import bpe_trees as B  # noqa: E402
from corvane.llm.queries import op12_bpe_trees  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@cache
def library(path=PATH):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def trees():
    return B.TreeEncoder(PATH)


def plain_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


def by_tree(text, leaf_chars):
    e = trees()
    leaves = e.leaves(text, leaf_chars)
    ids = e.encode_leaves(pa.array([x["text"] or "" for x in leaves], pa.string()))
    return e.concatenated([(x["inside"], i if x["special"] is None else np.array([x["special"]], e.kind)) for x, i in zip(leaves, ids, strict=True)]).tolist()


ODD = ["", "a<|endoftext|>b", "<|ENDOFTEXT|>abc", "  \t a b\nc  ", "É ́e", "don't DON'T 'll're", "\U0001f600 x‍y", "''''''''''''", "x" * 500, "the" * 300, "J̌ İstanbul ſ", "日本語の文章" * 40, "A.b,C...d--e!!?!" * 20]


@pytest.mark.parametrize("leaf_chars", [1, 2, 5, 16, 100])
@pytest.mark.parametrize("text", ODD)
def test_a_tree_equals_the_whole(text, leaf_chars):
    assert by_tree(text, leaf_chars) == plain_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("abet'in oé! "), st.characters(exclude_categories=["Cs"])), max_size=60), st.integers(1, 12))
def test_any_text(text, leaf_chars):
    assert by_tree(text, leaf_chars) == plain_ids(text)


def test_windows_grow_only_as_far_as_needed(monkeypatch):
    random.seed(5)
    text = "".join(random.choice("etaoinshrdlu") for _ in range(20_000))
    e, seen = B.TreeEncoder(PATH), []
    model = e.tokenizer.model
    halves = [np.array([t.id for t in model.tokenize(x)], e.kind) for x in (text[:9_777], text[9_777:])]

    class Spy:
        def tokenize(self, piece):
            seen.append(len(piece))
            return model.tokenize(piece)

    class Shell:
        model = Spy()

    monkeypatch.setattr(e, "tokenizer", Shell())
    assert e.joined(*halves).tolist() == plain_ids(text)
    assert max(seen) < 400


def test_decoding_equals_the_library():
    ids = [plain_ids(t) for t in ODD] + [[], [49407, 5], [49406, 10**6, 7]]
    assert trees().decode_lists(B._id_lists([np.array(x, np.int64) for x in ids])).to_pylist() == [library().decode(x, skip_special_tokens=False) for x in ids]
    assert trees().decode_lists(pa.array([None], pa.list_(pa.int32()))).to_pylist() == [""]


def test_documents_of_all_kinds(spark, make_docs, hard_rows):
    docs = make_docs([*hard_rows, *((100 + k, t * 3) for k, t in enumerate(ODD))]).selectExpr("*", "text as ids", "1 as row", "2 as leaf", "3 as place")
    texts = [r.text for r in docs.orderBy("doc_id", "text").collect()]
    got = B.decoded(B.encoded(docs, PATH, keep=("doc_id", "text", "row"), name="found", leaf_chars=64), PATH, "found", "back").orderBy("doc_id", "text").collect()
    assert [r.text for r in got] == texts and {r.row for r in got} == {1}
    for r in got:
        assert r.found == plain_ids(r.text) and r.back == library().decode(r.found, skip_special_tokens=False)
    assert B.encoded(docs.limit(0), PATH).collect() == []


def test_other_tokenizers_are_encoded_whole(spark, make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = make_docs([(1, "It's one text. " * 9), (2, None)])
    got = {r.doc_id: r for r in B.decoded(B.encoded(docs, path, leaf_chars=16), path).collect()}
    want = library(path).encode("It's one text. " * 9, add_special_tokens=False).ids
    assert got[1].ids == want and got[1].decoded == library(path).decode(want, skip_special_tokens=False) and got[2].ids == []


def test_query(spark, sf):
    got = {r.doc_id: r for r in op12_bpe_trees(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = plain_ids(d.text)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library().decode(ids, skip_special_tokens=False).encode()).hexdigest()

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from corvane.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top, longest=5):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        known = {g: a for g, a in counts.items() if a >= min_count and len(g) > 1}
        found = []
        for g, a in known.items():
            if any(a <= b and len(x) > len(g) and any(x[i : i + len(g)] == g for i in range(len(x))) for x, b in known.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        found.sort()
        out += [(lang, k + 1, p.decode(), -a, left, right, n[lang], -s) for k, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def mined(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, chunk string, times int")
    got = C.collocations(docs, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed, n_texts, words=12):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "The", "a b", "\x00"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ! "]
    texts = ["".join(random.choice(vocabulary) + random.choice(marks) for _ in range(random.randint(0, 60))) for _ in range(n_texts)]
    return [(random.choice(["en", "fr", None, "und"]), t) for t in texts]


@pytest.mark.parametrize("modulus", [1, 3, 48, 10**6])
def test_equals_brute_force(spark, modulus):
    rows = corpus(modulus, 120) + [("en", "in the end of it all. " * 30)] * 3
    for min_count, top in ((2, 10_000), (12, 9)):
        assert mined(spark, rows, min_count=min_count, top=top, modulus=modulus) == brute(rows, min_count, top)


def test_hard_rows(spark, hard_rows):
    rows = [("en", t) for _, t in hard_rows] + [(None, None), ("", "a b"), ("und", "x " * 50), (None, "x " * 50)]
    assert mined(spark, rows, min_count=2) == brute(rows, 2, 2_000)
    assert mined(spark, rows[:0]) == []
    assert mined(spark, [("en", "a b c")]) == []
    longest3 = dict(min_count=2, top=50)
    assert mined(spark, rows, longest=3, **longest3) == brute(rows, 2, 50, 3)


def test_products_beyond_64_bits(spark, monkeypatch):
    """Counts of 4e9 in a dictionary that stands for very many texts."""
    big = 4_000_000_000
    made = spark.createDataFrame([("en", "a b c", 3, big), ("en", "a b", 2, big // 3), ("en", "d", 1, 17)], "lang string, chunk string, own int, times bigint")
    monkeypatch.setattr(C, "chunk_dictionary", lambda *a: made)
    got = {r.phrase: r for r in C.collocations(spark.createDataFrame([], "text string, lang string")).collect()}
    n, ab = 3 * big + 2 * (big // 3) + 17, big + big // 3
    assert got["a b"].score == 1000 * ab * n // (ab * ab) and got["a b c"].score == min(1000 * big * n // (ab * big), 1000 * big * n // (ab * big))
    assert set(got) == {"a b", "a b c"}


def test_each_phrase_begins_in_one_chunk():
    """Own words of all chunks are all words, and chunks overlap by the words of the longest phrase but one."""
    random.seed(1)
    texts = [" ".join(random.choice("abcdefgh") for _ in range(k)) for k in (0, 1, 3, 40, 400)]
    words = C.Words(pa.array([*texts, None]))
    first, own, chunks = C._parse(words, 5, 4)
    assert own.sum() == words.n == sum(len(t.split()) for t in texts)
    for f, o, c in zip(first.tolist(), own.tolist(), chunks, strict=True):
        text = texts[words.text[f]].split()
        begin = f - int(np.searchsorted(words.text, words.text[f]))
        assert c.decode().split() == text[begin : begin + o + 4]


def test_equal_passages_share_chunks(spark):
    random.seed(2)
    passage = " ".join(f"p{k}" for k in range(2_000))
    docs = spark.createDataFrame([("en", f"{' '.join(str(random.getrandbits(40)) for _ in range(9))} {passage}") for _ in range(40)], "lang string, text string")
    chunks = C.chunk_dictionary(docs).collect()
    assert sum(r.own * r.times for r in chunks) == 40 * 2_009
    assert sum(r.own for r in chunks) < 40 * 9 + 2_000 + 40 * 200


def test_a_full_filter_changes_no_row(spark, monkeypatch):
    rows = corpus(9, 80)
    monkeypatch.setattr(C, "MOST_BITS", 1 << 16)
    monkeypatch.setattr(C.PhraseFilter, "has", lambda self, *columns: np.ones(len(columns[0]), bool))
    assert mined(spark, rows, min_count=5) == brute(rows, 5, 2_000)

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from corvane.llm import prefix_tries as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = abs(c) - abs(c) % 20
        whole[c] = tuple(own.get(base if c >= 0 else -base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    words = lambda s: len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
    children = defaultdict(int)
    for s in members:
        if s:
            children[s[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += children[s] == 0
            saved[s[:d]] += (len(m) - 1) * words(s)
    out = []
    for s, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(s))))
        out.append((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), children[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def built(spark, rows):
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id bigint, turn bigint, role string, text string, name string, depth int")
    got = P.conversation_trie(table)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0]))


def grown(seed, n, longest, kinds, ids=200):
    random.seed(seed)
    rows = []
    for c in random.sample(range(ids), n):
        like = random.Random(random.randint(0, kinds))
        for t in range(random.randint(1, longest)):
            rows.append((c, t, "user" if t % 2 else "assistant", " ".join(["w"] * like.randint(0, 3))))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "longest", "kinds"), [(40, 17, 2), (90, 1, 0)])
def test_equals_brute_force(spark, n, longest, kinds):
    rows = grown(n, n, longest, kinds)
    assert built(spark, rows) == brute(rows)


def test_hard_rows(spark):
    long = "very long " * 20_000
    rows = [
        (40, 0, "user", long), (40, 1, "a", long), (41, 0, "user", long), (41, 1, "a", long), (41, 1, "a", long), (42, None, "user", "null turn first"), (42, 0, None, None), (42, 0, "", ""),
        (43, 5, "b", "tie"), (43, 5, "a", "tie"), (43, 5, "a", None), (None, 0, "user", "nobody"), (-5, 0, "user", "below zero"), (-25, 0, "user", "x"), (-25, 1, "user", "y"), (0, 0, "r:1", "t"), (0, 1, "r", "1:t"),
        (10**15 + 7, 0, "user", " \t\x0b words\x85of\xa0one "), (65, 0, "u", "turnless when rebuilt"),
    ]
    assert built(spark, rows) == brute(rows)
    assert built(spark, rows[:0]) == [] and built(spark, [(None, 0, "a", "b")]) == []
    turnless = [(c, 0, "u", "t") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4]
    assert built(spark, turnless) == brute(turnless) and len(built(spark, turnless)) == 1


def test_one_conversation_and_one_turn_that_hold_most_rows(spark):
    rows = [(7, t, "u", f"t{t % 3}") for t in range(300)] + [(1000 + c, 0, "u", "hello") for c in range(400)] + [(3000 + c, t, "u", f"t{t % 3}") for c in range(4) for t in range(60 + c)]
    assert built(spark, rows) == brute(rows)


def test_pieces_of_a_digest(spark, monkeypatch):
    monkeypatch.setattr(P, "PIECE_IDS", 7)
    ends = spark.createDataFrame([(c, 1 + c % 2, 5) for c in range(-50, 200)], "c bigint, depth bigint, name bigint")
    got = {r.depth: r.ends_sha256 for r in P.digests_of_ends(ends).collect()}
    assert got == {d: hashlib.sha256(",".join(str(c) for c in range(-50, 200) if 1 + c % 2 == d).encode()).hexdigest() for d in (1, 2)}
    assert P.EMPTY_SHA256 == hashlib.sha256(b"").hexdigest()


def test_positions_over_several_ranges(spark):
    random.seed(4)
    values = [(k % 3 if k % 7 else 1, random.randint(0, 50)) for k in range(3_000)]
    got = P.positions(spark.createDataFrame(values, "k int, v int").withColumn("w", __import__("pyspark").sql.functions.col("v")).repartition(5), "k", ["v"], ["v"], "at").collect()
    for k in range(3):
        mine = sorted((r["at"], r.w) for r in got if r.k == k)
        assert [a for a, _ in mine] == list(range(len(mine))) and [w for _, w in mine] == sorted(v for x, v in values if x == k)

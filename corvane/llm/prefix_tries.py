"""A trie of conversations by recursion on depth.

Sequences are cut at half of a depth that is a power of two. Equal first halves
get one name, that of their smallest member: a cut prefix. The upper trie is that
of the distinct first halves; the lower forests are those of the second halves,
each under its cut prefix. Both are cut again in the same round, all of them at
once, so a trie of depth d takes log2(d) rounds, whatever its shape, and a very
long sequence is never walked turn by turn. Totals go back up from the coarsest
cuts to the finest: what a cut prefix knows of its lower forest is grafted on it.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import stored
from corvane.session import cut

#: Digits of a text by which the turns of one place are dealt over tasks before they are put in full order.
DEALT_CHARS = 32
#: Ids of members that are joined into one piece of a digest's input.
PIECE_IDS = 10_000

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def positions(rows: DataFrame, key: str, order: list[str], dealt: list[str], name: str) -> DataFrame:
    """``rows`` without the order columns and with ``name``: each row's number from 0 in the order of its key.

    No key is numbered in one task: rows are dealt by ranges of key and the
    ``dealt`` columns, which must order rows as ``order`` does, are counted in
    each range, and begin at the sum of the counts of their key's ranges before.
    """
    plain = [c for c in rows.columns if c not in order and c not in dealt]
    ranged = rows.repartitionByRange(key, *dealt).sortWithinPartitions(key, *order)
    local = F.monotonically_increasing_id()
    # which range a row fell into must not change between the count and its use, so the numbers are stored
    ranged = stored(ranged.select(*plain, F.shiftright(local, 33).cast("int").alias("range"), (local.bitwiseAND((1 << 33) - 1)).alias("at")), "positions")
    spans = ranged.groupBy(key, "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(key).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(key, "range", (before - F.col("first")).alias("shift"))
    return ranged.join(spans, [key, "range"]).select(*plain, (F.col("at") + F.col("shift")).alias(name))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (c, at, id, words) of rebuilt conversations, and (c, n, words) of each, also of those without turns.

    Turns are ordered by turn, null first; equal ones by role and text. ``id`` is
    the SHA-256 of role and text, null being empty. The first h turns of c - c % 20
    come first, h being crc32 of the id's digits modulo 4, then the conversation's
    own after its first h. Rows without a conversation id belong to none.
    """
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.substring(text, 1, DEALT_CHARS).alias("head"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("id"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("words"),
    )
    own = positions(rows, "c", ["turn", "role", "text"], ["turn", "role", "head"], "at")
    own = stored(own.withColumn("h", F.crc32(F.col("c").cast("string").cast("binary")) % 4), "turns")
    ids = own.groupBy("c", "h").agg(F.count("*").alias("n_own"))
    first = own.where("at < 3").select(F.col("c").alias("base"), "at", "id", "words")
    lent = ids.withColumn("base", F.expr("c - c % 20")).join(first, "base").where("at < h").select("c", "at", "id", "words")
    n_lent = lent.groupBy("c").agg(F.count("*").alias("n_lent"))
    after = own.where("at >= h").join(n_lent, "c", "left").select("c", (F.col("at") - F.col("h") + F.coalesce("n_lent", F.lit(0))).alias("at"), "id", "words")
    turns = stored(lent.unionByName(after), "rebuilt")
    sums = turns.groupBy("c").agg(F.count("*").alias("n"), F.sum("words").alias("words"))
    none = F.lit(0).cast("long")
    whole = ids.select("c").join(sums, "c", "left").select("c", F.coalesce("n", none).alias("n"), F.coalesce("words", none).alias("words"))
    return turns, stored(whole, "conversations")


def _blocks(turns: DataFrame, depth: int) -> dict[int, DataFrame]:
    """By size (1, 2, 4, ... below ``depth``): (c, k, block, words) of the full blocks of turns k size to (k + 1) size, named by the SHA-256 of their halves' names."""
    out, size = {1: turns.select("c", F.col("at").alias("k"), F.col("id").alias("block"), "words")}, 1
    while 2 * size < depth:
        half = F.col("k") % 2 == 0
        pairs = out[size].groupBy("c", F.floor(F.col("k") / 2).cast("long").alias("k")).agg(
            F.max(F.when(half, F.col("block"))).alias("a"), F.max(F.when(~half, F.col("block"))).alias("b"), F.sum("words").alias("words")
        )
        size *= 2
        out[size] = cut(pairs.where("a is not null and b is not null").select("c", "k", F.unhex(F.sha2(F.concat("a", "b"), 256)).alias("block"), "words"))
    return out


def _struct_list(*pairs: tuple[Column, Column]) -> Column:
    return F.array(*[F.struct(a.cast("long").alias("depth"), b.cast("long").alias("name")) for a, b in pairs])


def trie_nodes(turns: DataFrame, whole: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of the trie over sequences of turns.

    nodes: (depth, name, parent, path_words, roots), a row per distinct prefix but
    the empty one; name is the smallest member, path_words the words down to it,
    roots the cut prefixes above it, of which there are log2(depth) at most.
    ends: (c, depth, name), where each sequence with turns ends.
    """
    longest = whole.agg(F.max("n")).head()[0] or 0
    depth = 1
    while depth <= longest:
        depth *= 2
    blocks = _blocks(turns, depth)
    top = whole.agg(F.min("c")).head()[0]
    none = F.array().cast("array<struct<depth: bigint, name: bigint>>")
    # a problem is a sequence's turns lo to lo + 2 size under the cut prefix root; part is true where it stands for a cut prefix above which it ends
    state = cut(
        whole.where("n > 0").select("c", F.lit(0).cast("long").alias("lo"), F.lit(top).cast("long").alias("root"), F.col("n").alias("stop"), F.lit(False).alias("part"), F.lit(0).cast("long").alias("above"), none.alias("roots"), F.lit(None).cast("long").alias("path"))
    )
    nodes, ends, size = [], [], depth // 2
    while size >= 1:
        reaches = F.col("stop") >= F.col("lo") + size
        block = blocks[size].withColumn("lo", F.col("k") * size).drop("k")
        inside = state.where(reaches).join(block, ["c", "lo"])
        named = inside.groupBy("lo", "root", "block").agg(F.min("c").alias("name"))
        step = cut(inside.join(named, ["lo", "root", "block"]).drop("block"))
        middle = (F.col("lo") + size).alias("lo")
        through = (F.col("above") + F.col("words")).alias("above")
        # the lower forests
        lower = step.where(F.col("stop") > F.col("lo") + size).select(
            "c", middle, F.col("name").alias("root"), "stop", "part", through, F.concat("roots", _struct_list((F.col("lo") + size, F.col("name")))).alias("roots"), "path"
        )
        here = step.where(F.col("stop") == F.col("lo") + size)
        found = F.concat("roots", _struct_list((F.col("lo") + size, F.col("name"))))
        ends.append(here.where("not part").select("c", (F.col("lo") + size).alias("depth"), "name"))
        nodes.append(here.where("part").select((F.col("lo") + size + 1).alias("depth"), F.col("c").alias("name"), F.col("name").alias("parent"), F.col("path").alias("path_words"), found.alias("roots")))
        # the upper trie: each distinct first half once, as its smallest member, which ends above its last turn
        upper = step.where("c = name").select(
            "c", "lo", "root", (F.col("lo") + size - 1).alias("stop"), F.lit(True).alias("part"), "above", "roots", (F.col("above") + F.col("words")).alias("path")
        )
        if size == 1:
            nodes.append(upper.select((F.col("lo") + 1).alias("depth"), F.col("c").alias("name"), F.col("root").alias("parent"), F.col("path").alias("path_words"), "roots"))
            break
        state = state.where(~reaches).unionByName(upper).unionByName(lower)
        size //= 2
    if not nodes:
        nodes, ends = [spark_empty(whole, "depth bigint, name bigint, parent bigint, path_words bigint, roots array<struct<depth: bigint, name: bigint>>")], [spark_empty(whole, "c bigint, depth bigint, name bigint")]
    return stored(reduce(DataFrame.unionByName, nodes), "nodes"), stored(reduce(DataFrame.unionByName, ends), "ends")


def spark_empty(like: DataFrame, schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame([], schema)


def _lowest_bit(c: Column) -> Column:
    return c.bitwiseAND(-c)


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(depth, name, ``values``): sums over each node and all below it; ``nodes`` has depth, name, roots and the values.

    What lies between a cut prefix and the next cut on its level is summed for
    all cuts at once. What lies below that next cut is grafted in rounds, from the
    coarsest cuts, of which the sums are known first, to the finest.
    """
    at = F.col("r.depth")
    reach = at + _lowest_bit(at)
    roots = nodes.select("depth", "name", *values, F.explode("roots").alias("r"))
    near = roots.where(F.col("depth") < reach).select(at.alias("depth"), F.col("r.name").alias("name"), *values)
    flat = near.unionByName(nodes.select("depth", "name", *values)).groupBy("depth", "name").agg(*[F.sum(v).alias(v) for v in values])
    # the cuts right above a node that itself is a cut of a coarser level
    above = nodes.select("depth", "name", F.filter("roots", lambda r: r["depth"] + _lowest_bit(r["depth"]) == F.col("depth")).alias("above"))
    base = cut(flat.join(above, ["depth", "name"]).withColumn("level", _lowest_bit(F.col("depth"))))
    done, size = [], base.agg(F.max("level")).head()[0] or 0
    while size >= 1:
        now = base.where(F.col("level") == size)
        if done:
            sent = [d.select(F.explode("above").alias("r"), *values).where(_lowest_bit(at) == size).select(at.alias("depth"), F.col("r.name").alias("name"), *values) for d in done]
            sums = reduce(DataFrame.unionByName, sent).groupBy("depth", "name").agg(*[F.sum(v).alias(f"more_{v}") for v in values])
            now = now.join(sums, ["depth", "name"], "left").select("depth", "name", "above", "level", *[(F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values])
        done.append(cut(now) if size > 1 else now)
        size //= 2
    return reduce(DataFrame.unionByName, [d.select("depth", "name", *values) for d in done]) if done else base.select("depth", "name", *values)


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256): the SHA-256 of the comma-joined ids, ascending, of the sequences that end at each node where any do.

    A range of ids becomes a piece of text in one task; only pieces meet, in
    order, and are hashed one after the other, so no task holds a node's ids.
    """
    pieces_schema = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    digest_schema = pa.schema([("depth", pa.int64()), ("name", pa.int64()), ("ends_sha256", pa.string())])

    def pieces(batches):
        now, held = None, []
        for batch in batches:
            rows = []
            for d, n, c in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if held and ((d, n) != now or len(held) >= PIECE_IDS):
                    rows.append((*now, held[0], ",".join(map(str, held))))
                    held = []
                now = (d, n)
                held.append(c)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), pieces_schema, strict=True)], schema=pieces_schema)
        if held:
            yield pa.RecordBatch.from_pylist([{"depth": now[0], "name": now[1], "first": held[0], "ids": ",".join(map(str, held))}], schema=pieces_schema)

    def hashed(batches):
        now, state = None, None
        for batch in batches:
            rows = []
            for d, n, ids in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if (d, n) != now:
                    if now:
                        rows.append((*now, state.hexdigest()))
                    now, state = (d, n), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), digest_schema, strict=True)], schema=digest_schema)
        if now:
            yield pa.RecordBatch.from_pylist([{"depth": now[0], "name": now[1], "ends_sha256": state.hexdigest()}], schema=digest_schema)

    ordered = ends.select("depth", "name", "c").repartitionByRange("depth", "name", "c").sortWithinPartitions("depth", "name", "c")
    parts = ordered.mapInArrow(pieces, "depth bigint, name bigint, first bigint, ids string").repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return parts.select("depth", "name", "ids").mapInArrow(hashed, "depth bigint, name bigint, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role and text; other columns aren't used.
    Null roles and texts count as empty, null turns come first, turns that are
    equal go by role and text, and repeated rows are turns of their own. Rows
    without a conv_id are left out. The root stands for the empty sequence; an
    empty table has no root.

    saved_tokens needs no second pass: over a subtree, a node's members times its
    words add up to the words that the ending members have below the subtree's top.
    """
    turns, whole = rebuilt_turns(conversations.select("conv_id", "turn", "role", "text"))
    nodes, ends = trie_nodes(turns, whole)
    top = whole.agg(F.min("c").alias("name"), F.count("*").alias("n"), F.sum("words").alias("words"))
    no_turns = whole.where("n = 0").crossJoin(top.select("name")).select("c", F.lit(0).cast("long").alias("depth"), "name")
    ended = ends.join(whole.select("c", "words"), "c").groupBy("depth", "name").agg(F.count("*").alias("n_convs"), F.sum("words").alias("end_words"))
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    own = turns.select(F.col("c").alias("name"), (F.col("at") + 1).alias("depth"), F.col("words").alias("node_words"))
    none = F.lit(0).cast("long")
    known = cut(
        nodes.join(ended, ["depth", "name"], "left").join(children, ["depth", "name"], "left").join(own, ["depth", "name"])
        .withColumns({c: F.coalesce(c, none) for c in ("n_convs", "end_words", "n_children")})
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long"))
    )
    sums = subtree_sums(known, ["n_convs", "n_leaves", "end_words", "node_words"])
    facts = known.select("depth", "name", "parent", "n_children", (F.col("path_words") - F.col("node_words")).alias("words_above"))
    saved = F.col("end_words") - F.col("n_convs") * F.col("words_above") - F.col("node_words")
    columns = ["depth", "name", "parent", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens")]
    below = known.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.coalesce(F.sum("n_leaves"), none).alias("n_leaves"), F.coalesce(F.sum("node_words"), none).alias("node_words"))
    root = top.where("n > 0").crossJoin(below).select(
        none.alias("depth"), "name", F.lit(None).cast("long").alias("parent"), F.col("n").alias("n_convs"), "n_children",
        F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), (F.col("words") - F.col("node_words")).alias("saved_tokens"),
    )
    rows = sums.join(facts, ["depth", "name"]).select(*columns).unionByName(root)
    digests = digests_of_ends(ends.unionByName(no_turns))
    return rows.join(digests, ["depth", "name"], "left").select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")
    )

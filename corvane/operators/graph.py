"""Loops over hierarchies and graphs. Each round ends in files or a reliable checkpoint in the shared folder, and an empty delta stops it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.session import cut, stored


def _climbed(tree: DataFrame, stops: DataFrame) -> DataFrame:
    """(id, stop, depth, value): the nearest node at or above each node that ``stops`` (id, value) names; a line without one gives null.

    Pointer doubling: an open node points to an ancestor, and all nodes in
    between are open. If that ancestor has stopped or ended, so has the node;
    else the node takes over the ancestor's pointer, so distances double a round
    and depth d takes log2(d) rounds. A pointer that is longer than the number of
    nodes goes around a cycle without a stop, which ends nowhere. Each round
    writes the nodes that settle in it, once, and those still open.
    """
    up = tree.select("id", F.when(F.col("parent") != F.col("id"), F.col("parent")).alias("next"))
    state = stored(
        up.join(stops, "id", "left").join(up.select(F.col("id").alias("next"), F.lit(True).alias("is_node")), "next", "left").select(
            "id", "value", F.when(F.col("value").isNull() & F.col("is_node"), F.col("next")).alias("next"), F.lit(1).cast("long").alias("steps")
        )
    )
    first = state.where("next is null").select("id", F.when(F.col("value").isNotNull(), F.col("id")).alias("stop"), F.lit(0).cast("long").alias("depth"), "value")
    settled, open_ = [first], state.where("next is not null").select("id", "next", "steps")
    limit, reach = state.count(), 1
    while not open_.isEmpty() and reach <= limit:
        done = reduce(DataFrame.unionByName, settled).select(F.col("id").alias("next"), "stop", F.col("depth").alias("more"), "value", F.lit(True).alias("ended"))
        ahead = open_.select(F.col("id").alias("next"), F.col("next").alias("beyond"), F.col("steps").alias("further"))
        step = stored(open_.join(done, "next", "left").join(ahead, "next", "left"))
        settled.append(step.where("ended").select("id", "stop", (F.col("steps") + F.col("more")).alias("depth"), "value"))
        open_ = step.where("ended is null").select("id", F.col("beyond").alias("next"), (F.col("steps") + F.col("further")).alias("steps"))
        reach *= 2
    around = open_.select("id", F.lit(None).cast(state.schema["id"].dataType).alias("stop"), F.lit(None).cast("long").alias("depth"), F.lit(None).cast(state.schema["value"].dataType).alias("value"))
    return reduce(DataFrame.unionByName, [*settled, around])


def nearest_labelled(tree: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, label, from_id, depth): every node's own label, else that of its nearest labelled ancestor; unlabelled lines give no row.

    ``tree`` is (id, parent) with a row per id, ``labels`` (id, label), null
    labels counting as none. A node whose parent is null, absent or itself is a
    root. A line that runs into a cycle without a label gives no row. Any depth is
    reached. Equal to the sequential pass wherever a parent's number is below its
    child's.
    """
    found = _climbed(tree.select("id", "parent"), labels.where("label is not null").select("id", F.col("label").alias("value")))
    return found.where("stop is not null").select("id", F.col("value").alias("label"), F.col("stop").alias("from_id"), F.col("depth").cast("int").alias("depth"))


def top_ancestor(tree: DataFrame) -> DataFrame:
    """(id, top): the root of each node's tree; null where the line runs into a cycle. Any depth is reached."""
    tree = tree.select("id", "parent")
    known = tree.select(F.col("id").alias("parent"), F.lit(True).alias("is_node")).distinct()
    over = F.col("is_node").isNull() | (F.col("parent") == F.col("id"))
    roots = tree.join(known, "parent", "left").where(over).select("id", F.lit(True).alias("value"))
    return _climbed(tree, roots).select("id", F.col("stop").alias("top"))


def propagate(
    nodes: DataFrame, edges: DataFrame, labels: DataFrame, majority: str, spread: str, rounds: int = 6, share: float = 0.7, only_nodes: bool = False,
    linked: DataFrame | None = None,
) -> DataFrame:
    """(id, label, method, confidence, evidence, round): labels spread against the direction of edges, in synchronous rounds.

    ``edges`` is (id, target), a row per pointer; repeated ones count each. Per
    round a node without a label looks at its labelled targets. No edges at all in
    or out is an orphan (``S``, H-39). Otherwise two labelled targets are needed:
    three or more labels among them give ``majority`` (H-38); more than ``share``
    of them labelled ``majority`` too (H-36); all labelled ``spread`` give that
    (H-40). Labels of a round count from the next. Seeds have neither confidence
    nor evidence here. Synchronous rounds needn't equal an in-place pass over the
    nodes in order. A round writes its own labels only.
    """
    mine = nodes.select("id").distinct()
    if only_nodes and linked is not None:  # all edges are needed for the links alone
        edges = edges.join(mine, "id", "left_semi")
    edges = stored(edges.select("id", "target"))
    known = stored(labels.where("label is not null").select("id", "label"))
    text = F.lit(None).cast("string")
    parts = [known.select("id", "label", F.lit("seed").alias("method"), text.alias("confidence"), text.alias("evidence"), F.lit(0).alias("round"))]
    if linked is None:
        linked = edges.select("id").unionByName(edges.select(F.col("target").alias("id"))).distinct()
        edges = stored(edges.join(mine, "id", "left_semi")) if only_nodes else edges
    alone = stored(mine.join(known, "id", "left_anti").join(linked, "id", "left_anti"))
    # fixed values: confidence and the texts of evidence
    parts.append(
        alone.select("id", F.lit("S").alias("label"), F.lit("H-39").alias("method"), F.lit("moderate").alias("confidence"), F.lit("orphan: 0 ptrs in, 0 ptrs out").alias("evidence"), F.lit(1).alias("round"))
    )
    have = [known]
    for k in range(1, rounds + 1):
        seen = reduce(DataFrame.unionByName, have)
        counts = (
            edges.join(seen.select("id"), "id", "left_anti").join(seen.withColumnRenamed("id", "target"), "target")
            .groupBy("id")
            .agg(
                F.count("*").alias("n"), F.count_distinct("label").alias("kinds"), F.count_if(F.col("label") == majority).alias("major"),
                F.count_if(F.col("label") == spread).alias("same"),
            )
            .where("n >= 2")
        )
        new = stored(_told(counts, majority, spread, share, k))
        if k == 1:
            have.append(alone.select("id", F.lit("S").alias("label")))
        if new.isEmpty():
            break
        parts.append(new)
        have.append(new.select("id", "label"))
    return reduce(DataFrame.unionByName, parts)


#: Nodes that a step brings to one row, before what is reached already goes.
NODES_A_ROW = 100_000


def _sets(rows: DataFrame, by: list[str], node: str) -> DataFrame:
    """(by ..., nodes): the nodes of each key as one array; a null among them counts as a node."""
    null = F.when(F.count_if(F.col(node).isNull()) > 0, F.array(F.lit(None).cast(rows.schema[node].dataType))).otherwise(F.array().cast(f"array<{rows.schema[node].dataType.simpleString()}>"))
    return rows.groupBy(*by).agg(F.concat(F.collect_list(node), null).alias("nodes"))


def reachable(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    """(start, node, depth): nodes within ``depth`` steps of each start, with the least number of steps.

    ``edges`` is (source, target), ``starts`` (node). A round joins the frontier
    with the edges and drops what is reached already. Pairs are many, so they are
    written and dealt out as arrays: a node's targets go to a start as one array,
    and what comes to a start is one row, or several by a hash of the nodes where it
    is more than ``NODES_A_ROW``. The last round is written nowhere but in the result.
    """
    edges = cut(edges.select("source", "target").distinct())
    degrees = edges.groupBy("source").agg(F.count("*").alias("n"))
    degree = degrees.agg(F.max("n")).head()[0] or 0
    frontier = cut(starts.select(F.col("node").alias("start"), F.lit(0).alias("depth"), F.array("node").alias("nodes")).distinct())
    parts, ahead, rows, reached = [frontier], {}, 1, 0
    for k in range(1, depth + 1):
        width = (frontier.agg(F.max(F.size("nodes"))).head()[0] or 0) * rows
        if not width:
            break
        reached += width
        pairs = frontier.select("start", F.explode("nodes").alias("source"))
        most = width * degree + reached
        if most > NODES_A_ROW:  # counted where the bound doesn't do
            come = pairs.join(degrees, "source").select("start", "n").unionByName(reduce(DataFrame.unionByName, parts).select("start", F.size("nodes").cast("long").alias("n")))
            most = come.groupBy("start").agg(F.sum("n").alias("n")).agg(F.max("n")).head()[0]
        rows = -(-most // NODES_A_ROW)
        row = lambda c, n=rows: F.pmod(F.xxhash64(c), F.lit(n)) if n > 1 else F.lit(0).cast("long")
        if rows not in ahead:
            ahead[rows] = cut(_sets(edges.withColumn("row", row("target")), ["source", "row"], "target"))
        step = pairs.join(ahead[rows], "source").select("start", "row", "nodes", F.lit(True).alias("new"))
        old = reduce(DataFrame.unionByName, parts).select("start", "nodes")
        if rows > 1:
            old = _sets(old.select("start", F.explode("nodes").alias("node")).withColumn("row", row("node")), ["start", "row"], "node")
        else:
            old = old.withColumn("row", row("start"))
        both = step.unionByName(old.select("start", "row", "nodes", F.lit(False).alias("new"))).repartition("start", "row")
        met = both.groupBy("start", "row").agg(*[F.flatten(F.collect_list(F.when(F.col("new") == x, F.col("nodes")))).alias(name) for x, name in ((True, "got"), (False, "had"))])
        frontier = met.select("start", F.lit(k).alias("depth"), F.array_except("got", "had").alias("nodes")).where(F.size("nodes") > 0)
        if k < depth:
            frontier = cut(frontier)
        parts.append(frontier)
    return reduce(DataFrame.unionByName, parts).select("start", F.explode("nodes").alias("node"), "depth")


def reached_masks(edges: DataFrame, own: DataFrame) -> DataFrame:
    """(node, mask): the bits of every node from which a node with bits is reached, itself included, over any number of steps.

    ``edges`` is (source, target), ``own`` (node, mask) with several rows per node
    if need be. No pairs of nodes are made: a mask is as large as the number of
    labels. Lines of nodes with a single successor are folded first, by pointer
    doubling, and so are the cycles that they form: their bits are those of all
    nodes on the way. Between the nodes that branch, bits then go back over the
    edges, in each round only those that a node has newly got, so a node sends on
    as often as there are labels at most. Rounds end when nothing is new; in
    cycles, too, as masks only grow. Their number is the length of the longest
    shortest way between a branching node and a label.
    """
    edges = cut(edges.select("source", "target").where("source is not null and target is not null and source <> target").distinct())
    zero = F.lit(0).cast("long")
    own = own.where("node is not null").groupBy("node").agg(F.bit_or(F.col("mask").cast("long")).alias("mask"))
    single = edges.groupBy(F.col("source").alias("node")).agg(F.count("*").alias("n"), F.min("target").alias("next")).where("n = 1").drop("n")
    single = cut(single.join(own, "node", "left").select("node", "next", F.coalesce("mask", zero).alias("mask")))
    folded, open_, limit, reach = [], single, single.count(), 1
    while reach <= 2 * limit and not open_.isEmpty():
        # an open line goes on at the node where it ends so far, if that one has a single successor
        ahead = reduce(DataFrame.unionByName, [*folded, open_]).select(F.col("node").alias("next"), F.col("next").alias("beyond"), F.col("mask").alias("more"), F.lit(True).alias("on"))
        step = cut(open_.join(ahead, "next", "left"))
        folded.append(step.where("on is null").select("node", "next", "mask"))
        open_ = step.where("on").select("node", F.col("beyond").alias("next"), F.col("mask").bitwiseOR(F.col("more")).alias("mask"))
        reach *= 2
    # what is open still goes around a cycle, all of which it has seen
    around = open_.select("node", F.lit(None).cast(single.schema["next"].dataType).alias("next"), "mask")
    lines = cut(reduce(DataFrame.unionByName, [*folded, around]))

    branching = edges.join(single.select(F.col("node").alias("source")), "source", "left_anti")
    via = lines.select(F.col("node").alias("target"), "next", "mask", F.lit(True).alias("folded"))
    over = cut(branching.join(via, "target", "left").select("source", F.when(F.col("folded"), F.col("next")).otherwise(F.col("target")).alias("target"), F.coalesce("mask", zero).alias("mask")))
    back = cut(over.where("target is not null and target <> source").select("source", "target").distinct())
    ends = own.join(single.select("node"), "node", "left_anti")
    first = ends.unionByName(over.select(F.col("source").alias("node"), "mask")).groupBy("node").agg(F.bit_or("mask").alias("mask")).where("mask <> 0")
    new = cut(first)
    parts = [new]
    while not new.isEmpty():
        sent = new.join(back, F.col("node") == F.col("target")).groupBy("source").agg(F.bit_or("mask").alias("got"))
        known = reduce(DataFrame.unionByName, parts).groupBy("node").agg(F.bit_or("mask").alias("had"))
        fresh = F.col("got").bitwiseAND(F.bitwise_not(F.coalesce("had", zero)))
        new = cut(sent.join(known, F.col("source") == F.col("node"), "left").select(F.col("source").alias("node"), fresh.alias("mask")).where("mask <> 0"))
        parts.append(new)
    core = cut(reduce(DataFrame.unionByName, parts).groupBy("node").agg(F.bit_or("mask").alias("mask")))
    told = lines.join(core.select(F.col("node").alias("next"), F.col("mask").alias("more")), "next", "left").select("node", F.col("mask").bitwiseOR(F.coalesce("more", zero)).alias("mask"))
    return core.unionByName(told.where("mask <> 0"))


def label_reach(entries: DataFrame, calls: DataFrame, references: DataFrame, stores: DataFrame, labels: DataFrame, kinds: list[str]) -> DataFrame:
    """(kind, entry, unit, labels, n_labels): which labels of data each entry point touches in the end.

    ``entries`` is (kind, entry, unit), ``calls`` (source, target) between units,
    ``references`` (unit, store), ``stores`` (store, record), ``labels`` (record,
    label). ``labels`` of the result lists those of ``kinds`` (63 at most) that the
    unit or any unit that it calls, directly or not, reaches through a store, in
    the order of ``kinds``, joined by commas; blank if none. Units without calls
    and unknown units have what they touch themselves.
    """
    bit = None
    for k, kind in enumerate(kinds):
        bit = F.when(F.col("label") == kind, F.lit(1 << k)) if bit is None else bit.when(F.col("label") == kind, F.lit(1 << k))
    behind = stores.select("store", "record").distinct().join(labels.select("record", bit.cast("long").alias("mask")).where("mask is not null"), "record").groupBy("store").agg(F.bit_or("mask").alias("mask"))
    own = references.select("unit", "store").distinct().join(behind, "store").groupBy(F.col("unit").alias("node")).agg(F.bit_or("mask").alias("mask"))
    masks = reached_masks(calls, own).select(F.col("node").alias("unit"), "mask")
    names = F.array_compact(F.array(*[F.when(F.col("mask").bitwiseAND(F.lit(1 << k)) != 0, F.lit(kind)) for k, kind in enumerate(kinds)]))
    out = entries.select("kind", "entry", "unit").join(masks, "unit", "left").withColumn("mask", F.coalesce("mask", F.lit(0).cast("long")))
    return out.select("kind", "entry", "unit", F.array_join(names, ",").alias("labels"), F.bit_count("mask").cast("long").alias("n_labels"))


def propagate_in_place(
    nodes: DataFrame, edges: DataFrame, labels: DataFrame, majority: str, spread: str, rounds: int = 6, share: float = 0.7, order: str = "bigint", linked: DataFrame | None = None
) -> DataFrame:
    """(id, label, method, confidence, evidence, round) of the nodes that get a label, as a pass over them in order gives them.

    As propagate(), but a round goes through the open nodes by number (the id cast
    to ``order``), and a label that a smaller number has got in the same round
    counts already. A node waits for the open targets with smaller numbers alone,
    so a round goes in waves: all nodes at once whose such targets are decided,
    whether they got a label or not. Waves are as many as the longest line of open
    nodes with falling numbers; no node is seen twice in a round. ``nodes`` are the
    open ones that may get a label, ``labels`` (id, label) what is known; pointers
    of a node to itself and to unknown ids count for nothing.
    """
    known = cut(labels.where("label is not null").select("id", "label", F.lit(0).alias("round")))
    edges = cut(edges.select("id", "target"))
    open_ = cut(nodes.select("id").distinct().join(known, "id", "left_anti"))
    if linked is None:
        linked = edges.select("id").unionByName(edges.select(F.col("target").alias("id"))).distinct()
    alone = open_.join(linked.select("id").distinct(), "id", "left_anti")
    # fixed values: confidence and the texts of evidence
    orphans = cut(alone.select("id", F.lit("S").alias("label"), F.lit("H-39").alias("method"), F.lit("moderate").alias("confidence"), F.lit("orphan: 0 ptrs in, 0 ptrs out").alias("evidence"), F.lit(1).alias("round")))
    parts = [orphans]
    open_ = cut(open_.join(orphans, "id", "left_anti"))
    mine = cut(edges.join(open_, "id", "left_semi"))
    number = lambda c: F.col(c).try_cast(order)
    for k in range(1, rounds + 1):
        pending, fresh = open_, []
        waits = cut(mine.where(number("target") < number("id")).join(open_.select(F.col("id").alias("target")), "target", "left_semi").join(open_, "id", "left_semi").distinct())
        while not pending.isEmpty():
            held = waits.join(pending.select(F.col("id").alias("target")), "target", "left_semi").select("id").distinct()
            ready = cut(pending.join(held, "id", "left_anti"))
            seen = reduce(DataFrame.unionByName, [known, *[p.select("id", "label", "round") for p in [*parts, *fresh]]]).select(F.col("id").alias("target"), "label", "round")
            facts = (
                mine.join(ready, "id", "left_semi").join(seen, "target").where((F.col("round") < k) | (number("target") < number("id"))).groupBy("id")
                .agg(F.count("*").alias("n"), F.count_distinct("label").alias("kinds"), F.count_if(F.col("label") == majority).alias("major"), F.count_if(F.col("label") == spread).alias("same"))
                .where("n >= 2")
            )
            new = cut(_told(facts, majority, spread, share, k))
            if not new.isEmpty():
                fresh.append(new)
            pending = cut(pending.join(ready, "id", "left_anti"))
            waits = waits.join(pending, "id", "left_semi")
        if not fresh:
            break
        parts += fresh
        open_ = cut(open_.join(reduce(DataFrame.unionByName, fresh), "id", "left_anti"))
    return reduce(DataFrame.unionByName, parts)


def _told(facts: DataFrame, majority: str, spread: str, share: float, k: int) -> DataFrame:
    """What the rules say of nodes whose labelled targets are counted in n, kinds, major and same."""

    def says(label: str, method: str, *evidence: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), F.lit(method).alias("method"), F.concat(*[e.cast("string") for e in evidence]).alias("evidence"))

    rule = (
        F.when(F.col("kinds") >= 3, says(majority, "H-38", F.lit("targets span "), F.col("kinds"), F.lit(" PIKS categories")))
        .when(F.col("major") / F.col("n") > share, says(majority, "H-36", F.col("major"), F.lit("/"), F.col("n"), F.lit(f" targets classified {majority}")))
        .when(F.col("same") == F.col("n"), says(spread, "H-40", F.col("same"), F.lit(f" targets all classified {spread}")))
    )
    return facts.withColumn("r", rule).where(F.col("r").isNotNull()).select("id", "r.label", "r.method", F.lit("moderate").alias("confidence"), "r.evidence", F.lit(k).alias("round"))

"""Reference edges from text, and the measures that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as X


def text_edges(lines: DataFrame, source: list[str], line: str = "line", every_argument: bool = False) -> DataFrame:
    """(source columns, tag, target, kind, ref_count): call and function references of cleaned lines.

    A line is cleaned once; both patterns read the same column and their matches
    are exploded together, as texts, which are taken apart by generated code. Null
    lines have none, nor have lines without a caret, which are left out before any
    pattern is tried.
    """
    clean = lines.where(F.col(line).contains("^")).select(*source, X.without_literals(F.col(line)).alias("clean"))
    texts = F.concat(X.call_texts(F.col("clean"), every_argument), X.function_texts(F.col("clean")))
    found = clean.select(*source, F.explode(texts).alias("m")).select(*source, X.reference_parts(F.col("m")).alias("r"))
    return found.groupBy(*source, F.col("r.tag").alias("tag"), F.col("r.unit").alias("target"), F.col("r.kind").alias("kind")).agg(F.count("*").alias("ref_count"))


def store_edges(lines: DataFrame, source: list[str], line: str = "line") -> DataFrame:
    """(source columns, store, ref_count): store references of cleaned lines that hold a caret."""
    found = lines.where(F.col(line).contains("^")).select(*source, F.explode(X.store_references(X.without_literals(F.col(line)))).alias("store"))
    return found.groupBy(*source, "store").agg(F.count("*").alias("ref_count"))


def pattern_edges(rows: DataFrame, source: list[str], text: Column, pattern: str, target: str, group: int = 1) -> DataFrame:
    """(source columns, target, ref_count) for any pattern over a text expression."""
    found = rows.select(*source, F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias(target))
    return found.groupBy(*source, target).agg(F.count("*").alias("ref_count"))


def action_edges(registry: DataFrame, keys: list[str], actions: dict[str, str], pattern: str, group: int = 1) -> DataFrame:
    """(keys, action_kind, target, ref_count): references in several text columns of a registry, tagged by column."""
    tall = registry.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(kind).alias("action_kind"), F.col(c).alias("body")) for kind, c in actions.items()])).alias("a")
    ).select(*keys, "a.action_kind", "a.body")
    return pattern_edges(tall, [*keys, "action_kind"], F.col("body"), pattern, "target", group)


def group_matrix(edges: DataFrame, groups: DataFrame, source: str = "source", target: str = "target", target_groups: DataFrame | None = None) -> DataFrame:
    """(source_group, dest_group, edge_count, distinct_sources, distinct_targets) over edge rows.

    ``groups`` is (node, grp); ends without a group are skipped. Edges are first
    counted per pair of ends, so a hub's rows are combined before any distinct.
    """
    other = groups if target_groups is None else target_groups
    pairs = edges.groupBy(F.col(source).alias("s"), F.col(target).alias("t")).agg(F.count("*").alias("n"))
    return (
        pairs.join(groups.select(F.col("node").alias("s"), F.col("grp").alias("source_group")), "s")
        .join(other.select(F.col("node").alias("t"), F.col("grp").alias("dest_group")), "t")
        .groupBy("source_group", "dest_group")
        .agg(F.sum("n").alias("edge_count"), F.count_distinct("s").alias("distinct_sources"), F.count_distinct("t").alias("distinct_targets"))
    )


def skipped_targets(edges: DataFrame, groups: DataFrame, target: str = "target") -> DataFrame:
    """Targets that have no group, with their edge rows."""
    return edges.groupBy(F.col(target).alias("node")).agg(F.count("*").alias("n")).join(groups.select("node"), "node", "left_anti")


def coupling(matrix: DataFrame) -> DataFrame:
    """One row: intra and inter edges, their share (null without edges), and numbers of pairs and groups."""
    same = F.col("source_group") == F.col("dest_group")
    return matrix.agg(
        F.coalesce(F.sum(F.when(same, F.col("edge_count"))), F.lit(0)).alias("intra"),
        F.coalesce(F.sum(F.when(~same, F.col("edge_count"))), F.lit(0)).alias("inter"),
        F.try_divide(F.sum(F.when(~same, F.col("edge_count"))), F.sum("edge_count")).alias("inter_share"),
        F.count("*").alias("pairs"),
        F.count_distinct("source_group").alias("source_groups"),
        F.count_distinct("dest_group").alias("dest_groups"),
    )


def degrees(edges: DataFrame, source: str, target: str, weight: str | None = None) -> DataFrame:
    """(node, out_degree, out_total, in_degree, in_total): distinct partners and summed weight each way."""
    w = F.col(weight) if weight else F.lit(1)
    pairs = edges.groupBy(F.col(source).alias("s"), F.col(target).alias("t")).agg(F.sum(w).alias("w"))
    out = pairs.groupBy(F.col("s").alias("node")).agg(F.count("*").alias("out_degree"), F.sum("w").alias("out_total"))
    into = pairs.groupBy(F.col("t").alias("node")).agg(F.count("*").alias("in_degree"), F.sum("w").alias("in_total"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("out_degree", "out_total", "in_degree", "in_total")]
    return out.join(into, "node", "full").select("node", *zero)


def callers_of(edges: DataFrame, targets: list[str], source: str, part: str, weight: Column) -> DataFrame:
    """(targets, source, total, parts): who refers to each target, with the references by part in one text."""
    by_part = edges.groupBy(*targets, source, part).agg(F.sum(weight).alias("n"))
    listed = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(part).alias("p"), F.col("n").alias("n")))),
            lambda x: F.concat(x["p"].cast("string"), F.lit(":"), x["n"].cast("string")),
        ),
        ",",
    )
    return by_part.groupBy(*targets, source).agg(F.sum("n").alias("total"), listed.alias("parts"))


def top_k(rows: DataFrame, within: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; make ``order`` total, or ties fall by chance."""
    window = Window.partitionBy(*within).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def consumers(edges: DataFrame, item: str, user: str, weight: Column, k: int) -> DataFrame:
    """(item, users, total, top_users): who uses an item, how much, and the ``k`` heaviest users in one text."""
    by_user = edges.groupBy(item, user).agg(F.sum(weight).alias("n"))
    totals = by_user.groupBy(item).agg(F.count("*").alias("users"), F.sum("n").alias("total"))
    ranked = top_k(by_user, [item], [F.desc("n"), F.col(user)], k)
    tops = ranked.groupBy(item).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(user).alias("u")))), lambda x: x["u"].cast("string")), ",").alias("top_users"))
    return totals.join(tops, item)


def external_share(edges: DataFrame, groups: DataFrame, source: str, target: str) -> DataFrame:
    """(node, total, external, share): edge rows of each source that leave its group."""
    s = groups.select(F.col("node").alias(source), F.col("grp").alias("sg"))
    t = groups.select(F.col("node").alias(target), F.col("grp").alias("tg"))
    return (
        edges.select(source, target).join(s, source).join(t, target, "left")
        .groupBy(F.col(source).alias("node"))
        .agg(F.count("*").alias("total"), F.count_if(~F.col("sg").eqNullSafe(F.col("tg"))).alias("external"))
        .withColumn("share", F.try_divide("external", "total"))
    )


def bounded_group_graph(edges: DataFrame, groups: DataFrame, n: int = 50, weight: str | None = None) -> DataFrame:
    """(grp, kind, source, target, refs): a graph of each group with ``n`` nodes at most, for all groups at once.

    ``edges`` is (source, target) with several rows or a ``weight`` per reference,
    ``groups`` (node, grp). A group keeps its nodes with the most distinct callers
    inside the group, other than themselves; ties go to the smaller node, and
    nodes without such callers come last. ``inside``: references between kept
    nodes, their own included. ``out`` and ``in``: those of a kept node to and from
    another group, folded into one node for that group, ``group:`` and its name.
    References from or to nodes without a group are left out.
    """
    refs = F.sum(weight) if weight else F.count("*")
    counted = edges.where("source is not null and target is not null").groupBy("source", "target").agg(refs.cast("long").alias("refs"))
    known = groups.select("node", "grp").where("node is not null and grp is not null")
    both = counted.join(known.select(F.col("node").alias("source"), F.col("grp").alias("from_grp")), "source").join(known.select(F.col("node").alias("target"), F.col("grp").alias("to_grp")), "target")
    home = F.col("from_grp") == F.col("to_grp")
    callers = both.where(home & (F.col("source") != F.col("target"))).groupBy(F.col("target").alias("node")).agg(F.count("*").alias("callers"))
    ranked = top_k(known.join(callers, "node", "left"), ["grp"], [F.coalesce("callers", F.lit(0)).desc(), F.col("node")], n)
    kept = ranked.select("node")
    from_kept = both.join(kept.select(F.col("node").alias("source")), "source", "left_semi")
    to_kept = both.join(kept.select(F.col("node").alias("target")), "target", "left_semi")

    def text(c: str):
        return F.col(c).cast("string").alias(c)

    folded = lambda c: F.concat(F.lit("group:"), F.col(c).cast("string"))
    inside = from_kept.where(home).join(kept.select(F.col("node").alias("target")), "target", "left_semi").select(F.col("from_grp").alias("grp"), F.lit("inside").alias("kind"), text("source"), text("target"), "refs")
    out = from_kept.where(~home).groupBy(F.col("from_grp").alias("grp"), F.lit("out").alias("kind"), text("source"), folded("to_grp").alias("target")).agg(F.sum("refs").alias("refs"))
    into = to_kept.where(~home).groupBy(F.col("to_grp").alias("grp"), F.lit("in").alias("kind"), folded("from_grp").alias("source"), text("target")).agg(F.sum("refs").alias("refs"))
    return inside.unionByName(out).unionByName(into)

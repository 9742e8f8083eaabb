"""Joins with a fixed meaning: overrides, seeded unions, set agreement, prefixes, bridges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators.edges import top_k


def star(base: DataFrame, key: str, sources: list[DataFrame], zero: list[str] = (), blank: list[str] = ()) -> DataFrame:
    """``base`` with the columns of tables that are reduced to one row per key; numbers default to 0, texts to blank."""
    out = reduce(lambda left, right: left.join(right, key, "left"), sources, base)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero} | {c: F.coalesce(F.col(c), F.lit("")) for c in blank})


def seeded_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """All keys of either side; numbers that a side lacks are 0."""
    out = left.join(right, key, "full")
    numbers = [f.name for f in out.schema.fields if f.name != key and f.dataType.typeName() in ("long", "integer", "double")]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in numbers})


def override(sources: list[DataFrame], key: str, seq: str, rank: str = "priority") -> DataFrame:
    """One row per key: of the last source that has it, its last row by ``seq``. Sources go from weakest to strongest."""
    tagged = [s.withColumn(rank, F.lit(k)) for k, s in enumerate(sources)]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    best = F.max_by(F.struct(*[F.col(c) for c in rows.columns if c != key]), F.struct(rank, seq))
    return rows.groupBy(key).agg(best.alias("b")).select(key, "b.*")


def anti_both(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, key): keys of one population that the other lacks."""
    left = a.select(key).distinct().join(b.select(key), key, "left_anti").select(F.lit("left only").alias("side"), key)
    right = b.select(key).distinct().join(a.select(key), key, "left_anti").select(F.lit("right only").alias("side"), key)
    return left.unionByName(right)


def agreement(a: DataFrame, b: DataFrame, key: str, item: str) -> DataFrame:
    """(key, n_left, n_right, n_match, left_only, right_only, ratio) of two sets of items per key.

    Pairs are distinct on both sides and meet in a full join, so a key with many
    items is no array. ratio is matches over the union, 1 where both are empty.
    """
    l = a.select(key, item).distinct().withColumn("l", F.lit(1))
    r = b.select(key, item).distinct().withColumn("r", F.lit(1))
    both = l.join(r, [key, item], "full")
    return (
        both.groupBy(key)
        .agg(
            F.count("l").alias("n_left"), F.count("r").alias("n_right"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("n_match"),
            F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"), F.count("*").alias("n"),
        )
        .withColumn("ratio", F.coalesce(F.try_divide("n_match", "n"), F.lit(1.0)))
        .drop("n")
    )


def longest_prefix(names: DataFrame, name: str, prefixes: DataFrame, prefix: str, owner: str) -> DataFrame:
    """``names`` with the longest prefix that is a prefix of the name, and its owner (ties: the smallest owner); null where none is.

    Prefixes of the name are exploded up to the longest known length and meet the
    table in an equi-join, so no pair of name and prefix is tested in vain.
    """
    owners = prefixes.groupBy(F.col(prefix).alias("prefix")).agg(F.min(owner).alias("owner"))
    longest = owners.agg(F.max(F.char_length("prefix"))).head()[0] or 0
    parts = names.select(name).distinct().select(
        name, F.explode(F.transform(F.filter(F.sequence(F.lit(0), F.least(F.char_length(name), F.lit(longest))), lambda k: k > 0), lambda k: F.substring(F.col(name), F.lit(1), k))).alias("prefix")
    )
    best = parts.join(owners, "prefix").groupBy(name).agg(F.max_by(F.struct("prefix", "owner"), F.char_length("prefix")).alias("b"))
    return names.join(best, name, "left").select(*names.columns, F.col("b.prefix").alias("prefix"), F.col("b.owner").alias("owner"))


def fill_blank(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``left`` with blank or null cells of ``columns`` taken from ``right``; of rows with one key there, the largest by these columns in order.

    Rows, other columns and their names stay as they are; a null key takes nothing.
    """
    given = right.select(F.col(f"`{key}`").alias("k"), F.struct(*[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(columns)]).alias("v"))
    best = given.where("k is not null").groupBy("k").agg(F.max("v").alias("v"))
    one = left.select(F.struct("*").alias("l"), F.col(f"`{key}`").alias("k")).join(best, "k", "left")

    def cell(name: str) -> Column:
        own = F.col("l")[name]
        return (F.coalesce(F.nullif(own, F.lit("")), F.col("v")[f"c{columns.index(name)}"]) if name in columns else own).alias(name)

    rest = [c for c in left.columns if c not in columns]
    return one.select(*[cell(c) for c in [*rest, *columns]])


def resolved(queries: DataFrame, query: str, names: DataFrame, name: str, members: DataFrame, member: str, grp: str, least: float = 0.4) -> DataFrame:
    """(query, tier, name, n): what each distinct query names, by the first tier that answers; none gives no row.

    1: exactly; 2: the only name equal but for case; 3: the only name that
    contains it but for case, or with n > 1 all that do (ambiguous); 4: where no
    name contains it, the group with the most ``members`` that begin with the
    query in upper case, if it has ``least`` of those (ties: the smallest group).
    Parts of names as long as some query meet the queries in an equi-join, and so
    do the beginnings of members.
    """
    asked = queries.select(F.col(query).alias("query")).where("query <> ''").distinct().withColumn("u", F.upper("query"))
    known = names.select(F.col(name).alias("name")).where("name is not null").distinct().withColumn("nu", F.upper("name"))
    lengths = F.broadcast(asked.agg(F.collect_set(F.char_length("u")).alias("lengths")))  # as many as the longest query at most

    def cut_out(rows: DataFrame, of: str, starts: Column) -> DataFrame:
        fit = F.filter("lengths", lambda k: k <= F.char_length(of))
        return rows.crossJoin(lengths).select(*rows.columns, F.explode(fit).alias("k")).select(*rows.columns, F.explode(starts).alias("at"), "k").select(*rows.columns, F.substring(F.col(of), F.col("at"), F.col("k")).alias("u")).distinct()

    holds = asked.join(cut_out(known, "nu", F.sequence(F.lit(1), F.char_length("nu") - F.col("k") + 1)), "u")
    found = holds.select("query", "name", F.when(F.col("query") == F.col("name"), 1).when(F.col("u") == F.col("nu"), 2).otherwise(3).alias("tier"))
    per = found.groupBy("query").agg(
        F.max(F.when(F.col("tier") == 1, F.col("name"))).alias("exact"), F.count_if(F.col("tier") <= 2).alias("n_equal"), F.max(F.when(F.col("tier") == 2, F.col("name"))).alias("equal"), F.count("*").alias("n_holding")
    )
    one = F.when(F.col("exact").isNotNull(), F.struct(F.lit(1).alias("tier"), F.col("exact").alias("name"))).when(F.col("n_equal") == 1, F.struct(F.lit(2).alias("tier"), F.col("equal").alias("name")))
    per = per.withColumn("one", one)
    direct = per.where("one is not null").select("query", "one.tier", "one.name", F.lit(1).cast("long").alias("n"))
    several = per.where("one is null").select("query", "n_holding").join(found, "query").select("query", F.lit(3).alias("tier"), "name", F.col("n_holding").alias("n"))
    rest = asked.join(per, "query", "left_anti")
    begins = cut_out(members.select(F.col(member).alias("m"), F.col(grp).alias("g")).where("m is not null"), "m", F.sequence(F.lit(1), F.lit(1)))
    counts = rest.join(begins, "u").groupBy("query", "g").agg(F.count("*").alias("c"))
    owner = counts.groupBy("query").agg(F.sum("c").alias("of"), F.min(F.struct((-F.col("c")).alias("o"), "g", "c")).alias("b")).where(F.col("b.c") / F.col("of") >= least)
    return direct.unionByName(several).unionByName(owner.select("query", F.lit(4).alias("tier"), F.col("b.g").cast("string").alias("name"), F.lit(1).cast("long").alias("n")))


def bridge(unit_store: DataFrame, store_record: DataFrame, labels: DataFrame, unit: str, store: str, record: str, label: str) -> DataFrame:
    """(unit, label, records, refs): what labels of records a unit touches through stores; unlabelled ones are ``none``."""
    touched = unit_store.join(store_record, store).join(labels.select(record, label), record, "left")
    per = touched.groupBy(unit, F.coalesce(F.col(label), F.lit("none")).alias(label), record).agg(F.sum("ref_count").alias("r"))
    return per.groupBy(unit, label).agg(F.count("*").alias("records"), F.sum("r").alias("refs"))


def ownership(refs: DataFrame, owners: DataFrame, grp: str, item: str) -> DataFrame:
    """(grp, item, owned, users, refs): the items a group touches and whether it owns them."""
    own = owners.select(grp, item).distinct().withColumn("o", F.lit(True))
    return (
        refs.groupBy(grp, item, "user").agg(F.sum("ref_count").alias("r")).groupBy(grp, item).agg(F.count("*").alias("users"), F.sum("r").alias("refs"))
        .join(own, [grp, item], "left")
        .select(grp, item, F.coalesce("o", F.lit(False)).alias("owned"), "users", "refs")
    )


def named(items: DataFrame, item: str, names: DataFrame, key: str, name: str) -> DataFrame:
    """``items`` with each item's name; ``(unknown)`` where it has none."""
    dim = names.select(F.col(key).alias(item), F.col(name).alias("name"))
    return items.join(dim, item, "left").withColumn("name", F.coalesce("name", F.lit("(unknown)")))


def cards(sections: dict[str, DataFrame], entity: str, k: int) -> DataFrame:
    """(entity, section, rank, item, n): the ``k`` heaviest items of each section for every entity, from (entity, item, n) tables."""
    rows = [d.select(entity, F.lit(s).alias("section"), F.col("item").cast("string").alias("item"), F.col("n").cast("long").alias("n")) for s, d in sections.items()]
    return top_k(reduce(lambda a, b: a.unionByName(b), rows), [entity, "section"], [F.desc("n"), F.col("item")], k)


def resolved_tokens(lines: DataFrame, keys: list[str], line: str, units: DataFrame, stores: DataFrame) -> DataFrame:
    """(keys, token, kind): what each distinct name in a line refers to: tag call, store or unit, in this precedence.

    A name behind a caret is a tag call after a verb or a tag, a store before a
    parenthesis, else whichever of the two dimensions has it (units first).
    """
    pattern = r"((?:\b(?:D|DO|G|GOTO|J|JOB) +)?(?:\$\$)?[A-Z%]?[A-Z0-9]*)\^(%?[A-Z][A-Z0-9]*)(\(?)"
    found = lines.select(*keys, F.explode(F.regexp_extract_all(F.col(line), F.lit(pattern), F.lit(0))).alias("m")).select(
        *keys, F.regexp_extract("m", pattern, 1).alias("before"), F.regexp_extract("m", pattern, 2).alias("token"), F.regexp_extract("m", pattern, 3).alias("after")
    )
    u = units.select(F.col("unit").alias("token"), F.lit(True).alias("is_unit")).distinct()
    s = stores.select(F.col("store").alias("token"), F.lit(True).alias("is_store")).distinct()
    kind: Column = (
        F.when((F.col("before") != "") & F.col("is_unit"), "tag call").when((F.col("after") == "(") & F.col("is_store"), "store").when(F.col("is_unit"), "unit").when(F.col("is_store"), "store").otherwise("unknown")
    )
    return found.join(u, "token", "left").join(s, "token", "left").select(*keys, "token", kind.alias("kind")).distinct()


def same_name(left: DataFrame, right: DataFrame, name: str, other: str) -> DataFrame:
    """Rows of both sides whose names are equal in upper case; null names match nothing."""
    return left.join(right, F.upper(F.col(name)) == F.upper(F.col(other)))

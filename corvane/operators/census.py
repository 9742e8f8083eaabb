"""A census of stores from node tables: which branches occur, and which of them the dictionary declares.

Subscripts that are numbers become a mark, so that the nodes of all records fall
on a few templates; the first grouping leaves only those. Their prefixes form a
trie, rolled up by grouping exploded prefixes, and so do the declared ones. An
undeclared branch is an observed prefix that no declaration leads to while the
prefix before it is declared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.operators.dictionary import CANONICAL, MOST_RECORDS, _sub
from corvane.session import cut
from corvane.sources.nodes import piece

MARK = "#"
#: Templates that are shown of each store.
SAMPLES = 3


def template(subs: Column) -> Column:
    """Subscripts with numbers marked."""
    return F.transform(subs, lambda s: F.when(s.rlike(CANONICAL), F.lit(MARK)).otherwise(s))


def _prefixes(path: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(path)), lambda k: F.slice(path, 1, k))


def declared_paths(nodes: DataFrame, facts: DataFrame, dd: str = "^DD", max_depth: int = 32) -> tuple[DataFrame, DataFrame]:
    """(root, path) of what the fields of each root's types declare, and (root, name) of their indexes.

    A field's place is piece 4 of its node 0, ``subscript;piece``; fields of the
    type below, named by the number that a field's specification begins with, lie
    under that field's subscript and a record number. Roots are written without
    their last bracket or comma.
    """
    rows = nodes.where((F.col("root") == dd) & _sub(0).rlike(CANONICAL) & _sub(1).rlike(CANONICAL))
    field = cut(
        rows.where((F.size("subs") == 3) & (_sub(2) == "0")).select(
            _sub(0).alias("id"), F.split_part(piece(F.col("value"), 4), F.lit(";"), F.lit(1)).alias("place"), F.regexp_extract(piece(F.col("value"), 2), r"^([0-9]*\.?[0-9]+)", 1).alias("below")
        )
    )
    field = field.where("place <> ''").withColumn("place", F.when(F.col("place").rlike(CANONICAL), MARK).otherwise(F.col("place")))
    bases = cut(facts.where("root <> ''").select("id", F.regexp_replace("root", "[,(]$", "").alias("root"), F.array(F.lit(MARK)).alias("base")))
    parts = []
    for _ in range(max_depth):
        here = bases.join(field, "id").select("root", "below", F.concat("base", F.array("place")).alias("path"))
        parts.append(here.select("root", "path"))
        bases = cut(here.where("below <> ''").select(F.col("below").alias("id"), "root", F.concat("path", F.array(F.lit(MARK))).alias("base")))
        if bases.isEmpty():
            break
        parts.append(bases.select("root", F.col("base").alias("path")))
    else:
        raise RuntimeError(f"types below types go on after {max_depth} levels")
    paths = parts[0]
    for p in parts[1:]:
        paths = paths.unionByName(p)
    own = facts.where("root <> ''").select("id", F.regexp_replace("root", "[,(]$", "").alias("root"))
    indexes = rows.where((F.size("subs") == 5) & (_sub(2) == "1") & (_sub(4) == "0")).select(_sub(0).alias("id"), piece(F.col("value"), 2).alias("name")).where("name <> ''").distinct()
    return paths.distinct(), own.join(indexes, "id").select("root", "name").distinct()


def census(stores: DataFrame, nodes: DataFrame, facts: DataFrame) -> DataFrame:
    """(store, record_type, coverage, branches, undeclared, undeclared_branches, record_count, depth, samples), a row per store of ``stores`` (root, subs).

    coverage is none for stores that are no type's root, full where every branch
    is declared, else partial. branches counts the distinct prefixes of templates.
    undeclared_branches lists the branches' subscripts joined by commas, in order,
    parted by |; what an index of the type holds is declared. record_count counts
    distinct first subscripts, up to a million. depth is the largest number of
    subscripts, samples the first templates. A type's own numbers among the
    subscripts can't be told from record numbers.
    """
    place = F.regexp_replace("root", "[,(]$", "").alias("store")
    rows = stores.where(F.size("subs") > 0).select(place, template(F.col("subs")).alias("path"), F.size("subs").alias("n"))
    templates = cut(rows.groupBy("store", "path").agg(F.count("*").alias("nodes"), F.max("n").alias("depth")))
    firsts = stores.where(F.size("subs") > 0).select(place, _sub(0).alias("s")).distinct().groupBy("store").agg(F.least(F.count("*"), F.lit(MOST_RECORDS)).alias("record_count"))
    seen = templates.select("store", F.explode(_prefixes(F.col("path"))).alias("path")).distinct()
    paths, indexes = declared_paths(nodes, facts)
    known = paths.select(F.col("root").alias("store"), F.explode(_prefixes(F.col("path"))).alias("path")).distinct()
    indexed = indexes.select(F.col("root").alias("store"), F.array("name").alias("head"), F.lit(True).alias("indexed"))
    told = seen.withColumn("head", F.slice("path", 1, 1)).join(known.withColumn("declared", F.lit(True)), ["store", "path"], "left").join(indexed, ["store", "head"], "left")
    told = cut(told.select("store", "path", F.coalesce("declared", "indexed", F.lit(False)).alias("declared")))
    # the branch begins where the prefix before it is declared, or is none
    above = told.select("store", F.col("path").alias("up"), F.col("declared").alias("up_declared"))
    branch = told.where("not declared").withColumn("up", F.slice("path", 1, F.size("path") - 1)).join(above, ["store", "up"], "left").where("up_declared or size(up) = 0")
    named = branch.groupBy("store").agg(F.count("*").alias("undeclared"), F.array_join(F.array_sort(F.collect_list(F.array_join("path", ","))), "|").alias("undeclared_branches"))
    order = Window.partitionBy("store").orderBy(F.array_join("path", ","))
    first = templates.withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLES)
    samples = first.groupBy("store").agg(F.array_join(F.array_sort(F.collect_list(F.array_join("path", ","))), "|").alias("samples"))
    types = facts.where("root <> ''").groupBy(F.regexp_replace("root", "[,(]$", "").alias("store")).agg(F.max_by("id", F.col("id").try_cast("decimal(38,18)")).alias("record_type"))
    sizes = templates.groupBy("store").agg(F.max("depth").cast("long").alias("depth"))
    counts = told.groupBy("store").agg(F.count("*").alias("branches"))
    out = sizes.join(counts, "store").join(firsts, "store").join(samples, "store").join(named, "store", "left").join(types, "store", "left")
    undeclared = F.coalesce("undeclared", F.lit(0).cast("long"))
    coverage = F.when(F.col("record_type").isNull(), "none").when(undeclared == 0, "full").otherwise("partial")
    return out.select("store", "record_type", coverage.alias("coverage"), "branches", undeclared.alias("undeclared"), X.null_to_blank(F.col("undeclared_branches")).alias("undeclared_branches"), "record_count", "depth", "samples")


def store_features(found: DataFrame, stores: DataFrame, patients: DataFrame, references: DataFrame, unit_groups: DataFrame, group_labels: DataFrame, share: float = 0.6) -> DataFrame:
    """What the rules for stores read, from the census: store (the name), patient_namespace, patient_subscripts, partial_patient, referrer_groups, referrer_label.

    ``patients`` (id) are the record numbers of patients, ``references`` (unit,
    store), ``unit_groups`` (unit, grp), ``group_labels`` (grp, label).
    patient_subscripts holds where more than ``share`` of the distinct first
    subscripts that are numbers are patients; partial_patient where they are, the
    store is partly declared, and an undeclared branch lies under a record.
    patient_namespace holds if all referring units are of groups labelled P.
    """
    heads = stores.where(F.size("subs") > 0).select(F.regexp_replace("root", "[,(]$", "").alias("store"), _sub(0).alias("id")).where(F.col("id").rlike(CANONICAL)).distinct()
    told = heads.join(patients.select(F.col("id").cast("string").alias("id"), F.lit(1).alias("p")).distinct(), "id", "left").groupBy("store").agg((F.count("p") / F.count("*")).alias("of_patients"))
    refs = references.select("unit", "store").distinct().join(unit_groups.select("unit", "grp"), "unit").select("store", "grp").distinct().join(group_labels.select("grp", "label"), "grp", "left")
    named = refs.groupBy(F.col("store").alias("name")).agg(F.count("*").cast("int").alias("referrer_groups"), F.max("label").alias("referrer_label"), F.min(F.coalesce(F.col("label") == "P", F.lit(False))).alias("patient_namespace"))
    out = found.join(told, "store", "left").withColumn("name", F.regexp_replace("store", r"^\^", "")).join(named, "name", "left")
    by_patient = F.coalesce(F.col("of_patients") > share, F.lit(False))
    under = F.exists(F.split("undeclared_branches", r"\|"), lambda b: b.startswith(f"{MARK},"))
    return out.select(
        F.col("name").alias("store"), "coverage", F.coalesce("patient_namespace", F.lit(False)).alias("patient_namespace"), (by_patient & (F.col("coverage") == "none")).alias("patient_subscripts"), (by_patient & (F.col("coverage") == "partial") & under).alias("partial_patient"),
        F.coalesce("referrer_groups", F.lit(0)).alias("referrer_groups"), F.col("referrer_label"),
    )

"""Flattened trees: a table (root, subs array<string>, value) whose values are records split at ^.

The number of a record is its first subscript after the root's fixed ones, its
node the rest. Each registry names where its fields are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as X

# Fixed values: (node, piece) of each field; piece 0 is the whole value.
UNITS_9_8 = {"name": ("0", 1), "type": ("0", 2), "size_bytes": ("0", 3), "rsum_value": ("0", 5), "checksum_value": ("4", 2)}
CALLS_8994 = {"name": ("0", 1), "tag": ("0", 2), "routine": ("0", 3), "return_type": ("0", 4), "availability": ("0", 5), "inactive": ("0", 6), "version": ("0", 9)}
OPTIONS_19 = {"name": ("0", 1), "menu_text": ("0", 2), "type": ("0", 4), "package_id": ("0", 12), "routine_raw": ("25", 0)}
PROTOCOLS_101 = {"name": ("0", 1), "item_text": ("0", 2), "type": ("0", 4), "package_id": ("0", 12), "entry_action": ("20", 0), "exit_action": ("15", 0)}


def piece(value: Column, k: int) -> Column:
    return value if k == 0 else F.coalesce(F.get(F.split(value, r"\^"), F.lit(k - 1)), F.lit(""))


def registry(nodes: DataFrame, root: str, fields: dict[str, tuple[str, int]]) -> DataFrame:
    """(ien, one column per field) of the records under ``root``; missing nodes give blanks.

    One pass groups the wanted nodes of a record, so there is no self-join.
    """
    wanted = sorted({node for node, _ in fields.values()})
    rows = nodes.where((F.col("root") == root) & (F.size("subs") >= 2)).select(
        F.get("subs", F.lit(0)).try_cast("bigint").alias("ien"), F.array_join(F.slice("subs", 2, 100), ",").alias("node"), "value"
    )
    grouped = rows.where(F.col("ien").isNotNull() & F.col("node").isin(wanted)).groupBy("ien").agg(
        *[F.max(F.when(F.col("node") == n, F.col("value"))).alias(f"n{k}") for k, n in enumerate(wanted)]
    )
    columns = [X.action_text(piece(F.coalesce(F.col(f"n{wanted.index(n)}"), F.lit("")), k)).alias(name) for name, (n, k) in fields.items()]
    return grouped.where(F.col(f"n{wanted.index('0')}").isNotNull()).select("ien", *columns)


def options(nodes: DataFrame, root: str, groups: DataFrame) -> DataFrame:
    """Options with the group's name for its number and the entry point split at ^."""
    rows = registry(nodes, root, OPTIONS_19)
    names = groups.select(F.col("ien").cast("string").alias("package_id"), F.col("name").alias("package"))
    return rows.join(names, "package_id", "left").withColumns(
        {"tag": X.reference_tag(F.col("routine_raw")), "routine": X.reference_unit(F.col("routine_raw")), "package": X.null_to_blank(F.col("package"))}
    )


def analysis(results: DataFrame) -> dict[str, DataFrame]:
    """Four tables from rows of (unit, errors array<struct>, xrefs map<string, array<string>>, tags map<string, string>)."""
    return {
        "units": results.select("unit", F.size("errors").alias("error_count"), F.size("xrefs").alias("xref_count"), F.size("tags").alias("tag_count")),
        "errors": results.select("unit", F.posexplode("errors").alias("entry_index", "e")).select("unit", "entry_index", "e.*"),
        "xrefs": results.select("unit", F.explode("xrefs").alias("ref", "places")).select("unit", "ref", F.array_join(F.sort_array("places"), ",").alias("location_list")),
        "tags": results.select("unit", F.explode("tags").alias("tag", "data")),
    }


def record_types(nodes: DataFrame, records: DataFrame, root: str = "^DD") -> DataFrame:
    """(file_number, file_name, parent_file, field_count, pointer_out, pointer_in, record_count) of a dictionary's node table.

    A field's specification is piece 2 of its node 0; pointers out are the fields
    whose specification holds a P, pointers in those of other types that name this one.
    """
    dd = nodes.where(F.col("root") == root)
    field = dd.where((F.size("subs") == 3) & (F.get("subs", F.lit(2)) == "0")).select(
        F.get("subs", F.lit(0)).alias("file_number"), F.get("subs", F.lit(1)).alias("field_number"), piece(F.col("value"), 2).alias("spec")
    )
    field = field.where("field_number <> '0'")
    counts = field.groupBy("file_number").agg(F.count("*").alias("field_count"), F.count_if(F.col("spec").contains("P")).alias("pointer_out"))
    into = field.select(X.pointer_target(F.col("spec"), True).alias("file_number")).where("file_number <> ''").groupBy("file_number").agg(F.count("*").alias("pointer_in"))
    parent = dd.where((F.size("subs") == 3) & (F.get("subs", F.lit(2)) == "UP")).select(F.get("subs", F.lit(0)).alias("file_number"), F.col("value").alias("parent_file"))
    name = dd.where((F.size("subs") == 2) & (F.get("subs", F.lit(1)) == "0")).select(F.get("subs", F.lit(0)).alias("file_number"), piece(F.col("value"), 1).alias("file_name"))
    out = name
    for other in (parent, counts, into, records):
        out = out.join(other, "file_number", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("field_count", "pointer_out", "pointer_in", "record_count")}
    return out.withColumns(zero | {"parent_file": X.null_to_blank(F.col("parent_file"))})

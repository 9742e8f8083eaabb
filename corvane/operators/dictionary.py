"""A data dictionary as a flattened node table, read into what classification needs.

Nodes are (root, subs array<string>, value). Under the dictionary's root stand
record types by number, their fields and, in an index, who points to them; under
the directory's root their names, flags and places of storage; under the groups'
root the groups' names and prefixes. Everything about a type comes from one
grouping of its nodes, with partial sums before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.config import labels as L
from corvane.functions import text as X
from corvane.operators import joins as J
from corvane.operators import rules as R
from corvane.operators.graph import nearest_labelled, top_ancestor
from corvane.session import stored
from corvane.sources.nodes import piece

#: A number as it is written when it is a subscript: no leading or trailing zeros, no plus sign.
CANONICAL = r"^-?(?:0|[1-9][0-9]*|(?:[1-9][0-9]*)?\.[0-9]*[1-9])$"
#: Types that many others point to, and what pointing to them says.
ANCHORS = ("2", "4", "200", "80")
#: Roots and pieces of the templates and forms that name a type.
TEMPLATES = {"print_templates": ("^DIPT", 4), "input_templates": ("^DIE", 4), "forms": ("^DIST(.403", 8)}
#: Records of a store are counted up to this number.
MOST_RECORDS = 1_000_000


def _sub(k: int) -> Column:
    return F.get("subs", F.lit(k))


def target_number(spec: Column, decimals: bool = False) -> Column:
    """The number that a specification points to, without leading zeros; blank if none."""
    return F.regexp_replace(X.pointer_target(spec, decimals), "^0+(?=[0-9])", "")


def fields(nodes: DataFrame, dd: str = "^DD", decimals: bool = False) -> DataFrame:
    """(id, field, name, spec, target) of every field of every record type: numbers as text, target blank where a field points nowhere."""
    rows = nodes.where((F.col("root") == dd) & (F.size("subs") == 3) & (_sub(2) == "0") & _sub(0).rlike(CANONICAL) & _sub(1).rlike(CANONICAL))
    out = rows.select(_sub(0).alias("id"), _sub(1).alias("field"), piece(F.col("value"), 1).alias("name"), piece(F.col("value"), 2).alias("spec"))
    return out.withColumn("target", target_number(F.col("spec"), decimals))


def groups(nodes: DataFrame, root: str = "^DIC(9.4") -> DataFrame:
    """(ien, owner, prefix) of the groups that have a prefix."""
    rows = nodes.where((F.col("root") == root) & (F.size("subs") == 2) & (_sub(1) == "0"))
    return rows.select(_sub(0).alias("ien"), piece(F.col("value"), 1).alias("owner"), piece(F.col("value"), 2).alias("prefix")).where("prefix <> ''")


def record_type_facts(nodes: DataFrame, dd: str = "^DD", dic: str = "^DIC", decimals: bool = False) -> DataFrame:
    """A row per record type: what its own nodes say.

    id (text), parent (null if none), name, root (its own, blank if none),
    field_count (as declared), ptr_in (types that the index names), ptr_out (fields
    with a target), p_fields (fields whose specification holds a P), to_2, to_4,
    to_200, to_80 (fields to these types), last_to_2 (number and name of the last field to
    type 2), dinum (Y, N, or blank for types that the directory lacks).

    Every number under ``dd`` is a type, also one that only the index of pointers
    names; other subscripts are indexes. Missing nodes give blanks and zeros. A
    repeated node counts once in ptr_in, and as a field of its own elsewhere; of
    fields with one number the name that sorts last is the last.
    """
    own = nodes.where(F.col("root").isin(dd, dic) & _sub(0).rlike(CANONICAL)).select(
        _sub(0).alias("id"), (F.col("root") == dd).alias("d"), F.size("subs").alias("n"), _sub(1).alias("a"), _sub(2).alias("b"), _sub(3).alias("c"), "value"
    )
    d, n, a, b, value = (F.col(c) for c in ("d", "n", "a", "b", "value"))

    def at(holds: Column, out: Column = value) -> Column:
        return F.max(F.when(holds, out))

    is_field = d & (n == 3) & (b == "0") & a.rlike(CANONICAL)
    spec = F.when(is_field, piece(value, 2))
    own = own.withColumns({"spec": spec, "target": target_number(spec, decimals)})
    to_2 = F.when(F.col("target") == "2", F.struct(a.cast("decimal(38,18)").alias("o"), F.concat_ws(" ", a, piece(value, 1)).alias("e")))
    facts = own.groupBy("id").agg(
        F.max("d").alias("is_type"),
        at(d & (n == 2) & (a == "0")).alias("dd_0"),
        at(~d & (n == 2) & (a == "0")).alias("dic_0"),
        at(d & (n == 3) & (a == "0") & (b == "UP")).alias("up"),
        at(~d & (n == 3) & (a == "0") & (b == "GL")).alias("root"),
        F.count_distinct(F.when(d & (n >= 4) & (a == "0") & (b == "PT"), F.col("c"))).alias("ptr_in"),
        F.count_if(F.col("target") != "").alias("ptr_out"),
        F.count_if(F.col("spec").contains("P")).alias("p_fields"),
        *[F.count_if(F.col("target") == t).alias(f"to_{t}") for t in ANCHORS],
        F.max(to_2).alias("last"),
    )
    dd_0, dic_0 = F.coalesce("dd_0", F.lit("")), F.col("dic_0")
    declared = F.regexp_extract(piece(dd_0, 4), r"^[+-]?[0-9]*", 0).try_cast("bigint")
    return facts.where("is_type").select(
        "id",
        F.nullif("up", F.lit("")).alias("parent"),
        F.when(dic_0.isNotNull(), piece(dic_0, 1)).otherwise(piece(dd_0, 1)).alias("name"),
        F.coalesce("root", F.lit("")).alias("root"),
        F.coalesce(declared, F.lit(0).cast("long")).alias("field_count"),
        "ptr_in", "ptr_out", "p_fields", *[f"to_{t}" for t in ANCHORS],
        F.col("last.e").alias("last_to_2"),
        F.when(dic_0.isNull(), "").when(piece(dic_0, 3).contains("D"), "Y").otherwise("N").alias("dinum"),
    )


def record_type_features(facts: DataFrame, owners: DataFrame) -> DataFrame:
    """``facts`` with number, prefix and owner: the group with the longest prefix that the store of the type's own root begins with (ties: the first group)."""
    order = F.struct(F.col("ien").try_cast("decimal(38,18)").alias("number"), "ien", "owner")
    named = J.longest_prefix(facts.withColumn("store", X.store_name(F.col("root"))), "store", owners.select("prefix", order.alias("who")), "prefix", "who")
    return named.select(*facts.columns, F.col("id").alias("number"), "prefix", F.col("owner.owner").alias("owner"))


def inherited_roots(facts: DataFrame) -> DataFrame:
    """(id, global_root): a type's own root, else that of the nearest type above that has one; types without one give no row."""
    return nearest_labelled(facts, facts.where("root <> ''").select("id", F.col("root").alias("label"))).select("id", F.col("label").alias("global_root"))


def store_records(stores: DataFrame) -> DataFrame:
    """(global_root, record_count) of node tables of stores: distinct first subscripts below each root, up to a million.

    A root is written as a type's root without its last bracket or comma.
    """
    distinct = stores.where(F.size("subs") > 0).select("root", _sub(0).alias("s")).distinct()
    counts = distinct.groupBy("root").agg(F.least(F.count("*"), F.lit(MOST_RECORDS)).alias("record_count"))
    return counts.select(F.col("root").alias("place"), "record_count")


def inventory(facts: DataFrame, records: DataFrame) -> DataFrame:
    """(file_number, file_name, global_root, parent_file, field_count, pointer_in, pointer_out, record_count, is_dinum, status) of every record type.

    Types below others have no record_count; those without a root or a counted
    store have 0. pointer_out is the number of fields whose specification holds a P.
    """
    out = facts.join(inherited_roots(facts), "id", "left").withColumn("global_root", F.coalesce("global_root", F.lit("")))
    out = out.withColumn("place", F.regexp_replace("global_root", "[,(]$", "")).join(records, "place", "left")
    count = F.when(F.col("parent").isNull(), F.coalesce("record_count", F.lit(0).cast("long")))
    return out.select(
        F.col("id").alias("file_number"), X.action_text(F.col("name")).alias("file_name"), "global_root", X.null_to_blank(F.col("parent")).alias("parent_file"), "field_count", F.col("ptr_in").alias("pointer_in"),
        F.col("p_fields").alias("pointer_out"), count.alias("record_count"), F.col("dinum").alias("is_dinum"), F.lit("extracted").alias("status"),
    )


def referrers(nodes: DataFrame, dd: str = "^DD", decimals: bool = False) -> DataFrame:
    """(id, pointer_in_files, pointer_out_files): the distinct types that point to each type, and those it points to, in numeric order, parted by |.

    A type's list is as long as what is returned for it; types without either give no row.
    """
    pairs = fields(nodes, dd, decimals).where("target <> ''").select("id", "target").distinct()
    both = pairs.select("id", F.lit("out").alias("way"), F.col("target").alias("other")).unionByName(pairs.select(F.col("target").alias("id"), F.lit("in").alias("way"), F.col("id").alias("other")))
    entry = F.struct(F.col("other").try_cast("decimal(38,18)").alias("o"), "other")

    def listed(way: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("way") == way, entry))), lambda e: e["other"]), "|")

    return both.groupBy("id").agg(listed("in").alias("pointer_in_files"), listed("out").alias("pointer_out_files"))


def classified_dictionary(nodes: DataFrame, rounds: int = 6, decimals: bool = False, facts: DataFrame | None = None) -> DataFrame:
    """(id, parent, label, method, confidence, evidence) of every record type of a node table: features, then the four passes.

    ``facts`` are those of record_type_facts() where they are at hand.
    """
    facts = stored(record_type_facts(nodes, decimals=decimals)) if facts is None else facts
    features = record_type_features(facts, groups(nodes))
    pointers = fields(nodes, decimals=decimals).where("target <> ''").select("id", "target")
    linked = facts.where("ptr_in > 0 or ptr_out > 0").select("id")
    return R.classified(features, pointers, rounds=rounds, linked=linked)


def wide_export(nodes: DataFrame, labels: DataFrame, records: DataFrame, decimals: bool = False, facts: DataFrame | None = None) -> DataFrame:
    """22 columns, a row per field of every record type, and one with blank field columns for types without fields.

    ``labels`` has id, label, method, confidence and evidence. field_piks is the
    type's label, else that of its top ancestor; ref_piks the label of the type
    that the field points to; cross_piks and sensitivity_flag are Y or blank.
    ``facts`` are those of record_type_facts() where they are at hand.
    """
    facts = stored(record_type_facts(nodes, decimals=decimals)) if facts is None else facts
    types = inventory(facts, records).withColumnRenamed("file_number", "record")
    tops = top_ancestor(facts).select(F.col("id").alias("record"), "top")
    named = labels.select(F.col("id").alias("record"), "label", F.col("method").alias("file_piks_method"), F.col("confidence").alias("file_piks_confidence"), F.col("evidence").alias("piks_evidence"))
    rows = facts.select(F.col("id").alias("record")).join(fields(nodes, decimals=decimals).withColumnRenamed("id", "record"), "record", "left")
    told = R.field_labels(rows, named.select("record", "label"), tops)
    volume = R.properties(F.col("record_count"), F.col("label"), F.lit(False), F.lit(False))["volume"]
    out = told.join(types, "record").join(named, "record", "left").withColumn("volume", F.when(F.col("record_count").isNotNull(), volume))
    blank = X.null_to_blank
    return out.select(
        F.col("record").alias("file_number"), blank(F.col("field")).alias("field_number"), blank(X.action_text(F.col("name"))).alias("field_name"),
        F.when(F.col("field").isNull(), "").otherwise(F.col("data_type")).alias("data_type"), blank(F.col("own")).alias("field_piks"), blank(F.col("label")).alias("file_piks"),
        blank(F.col("file_piks_method")).alias("file_piks_method"), blank(F.col("file_piks_confidence")).alias("file_piks_confidence"), blank(F.col("ref_label")).alias("ref_piks"), F.col("cross").alias("cross_piks"),
        "file_name", "global_root", "parent_file", "field_count", "pointer_in", "pointer_out", "record_count", "is_dinum", blank(F.col("volume")).alias("volume"),
        blank(F.col("piks_evidence")).alias("piks_evidence"), blank(F.col("target")).alias("pointer_target"), F.coalesce("sensitivity", F.lit("")).alias("sensitivity_flag"),
    )


def _depths(facts: DataFrame) -> DataFrame:
    """(id, depth): of each uppermost type, how many levels of types lie below it."""
    tops = top_ancestor(facts).where("top is not null")
    steps = nearest_labelled(facts, facts.join(tops.where("top = id").select("id"), "id", "left_semi").select("id", F.lit(True).alias("label")))
    return tops.join(steps.select("id", F.col("depth").alias("steps")), "id").groupBy(F.col("top").alias("id")).agg(F.max("steps").alias("depth"))


def structure_features(nodes: DataFrame, facts: DataFrame, records: DataFrame, labels: DataFrame | None = None, dd: str = "^DD", dic: str = "^DIC", decimals: bool = False) -> DataFrame:
    """What the rules that are specified alone read, a row per type of ``facts``: from the same nodes, in one grouping, and from the types below and around.

    id, number, ptr_in, ptr_out, records, fields, audited (fields), first_is_date,
    is_subfile, no_delete, created, no_write, depth (levels below an uppermost
    type), word_fields, set_share, dinum, computed, p_referrers (share of the
    referring types that ``labels`` (id, label) calls P), xrefs (distinct names),
    trigger_to_p, write_access, delete_access, open_laygo, print_templates,
    input_templates, forms, dated_subfiles, store_active (the store has nodes).
    What isn't said is 0, false or blank.
    """
    own = nodes.where(F.col("root").isin(dd, dic) & _sub(0).rlike(CANONICAL)).select(
        _sub(0).alias("id"), (F.col("root") == dd).alias("d"), F.size("subs").alias("n"), _sub(1).alias("a"), _sub(2).alias("b"), _sub(4).alias("e"), "value"
    )
    d, n, a, b, value = (F.col(c) for c in ("d", "n", "a", "b", "value"))
    a_field = d & a.rlike(CANONICAL)
    is_field = a_field & (n == 3) & (b == "0")
    is_xref = a_field & (n == 5) & (b == "1") & (F.col("e") == "0")
    kind = F.when(is_field, X.data_type(piece(value, 2)))
    said = ~d & (a == "0") & (n == 3)

    def of_kind(*kinds: str) -> Column:
        return F.count_if(F.col("kind").isin(*kinds))

    def flag(holds: Column) -> Column:
        return F.coalesce(F.max(holds), F.lit(False))

    own = own.withColumn("kind", kind)
    made = own.groupBy("id").agg(
        F.count_if(is_field).alias("fields"), F.count_if(a_field & (n == 3) & (b == "AUDIT") & (value != "")).alias("audited"), flag(is_field & (a == ".01") & (F.col("kind") == "DATE")).alias("first_is_date"),
        flag(d & (a == "0") & (b == "DEL")).alias("no_delete"), flag(is_field & F.upper(piece(value, 1)).isin("DATE ENTERED", "DATE/TIME ENTERED", "DATE CREATED")).alias("created"),
        flag((a_field & (n == 3) & (b == "9") & (value != "")) | (said & (b == "WR") & (value != ""))).alias("no_write"), of_kind("WORD-PROCESSING").alias("word_fields"), of_kind("SET").alias("sets"), of_kind("COMPUTED", "MUMPS").alias("computed"),
        F.collect_set(F.when(is_xref, piece(value, 2))).alias("xrefs"), F.max(F.when(said & (b == "WR"), value)).alias("write_access"), F.max(F.when(said & (b == "DEL"), value)).alias("delete_access"),
        flag(said & (b == "LAYGO") & (value == "")).alias("open_laygo"),
    )
    patient = facts.where(X.store_name(F.col("root")).isin(L.STORES["P"])).select(F.col("id").alias("target"))
    triggers = own.where(is_xref & (piece(value, 3) == "TRIGGER")).select("id", piece(value, 4).alias("target")).join(patient, "target", "left_semi").select("id", F.lit(True).alias("trigger_to_p")).distinct()
    out = facts.select("id", F.col("id").alias("number"), "parent", "root", "ptr_in", "ptr_out", (F.col("dinum") == "Y").alias("dinum")).join(made, "id", "left").join(triggers, "id", "left").join(_depths(facts), "id", "left")
    for name, (root, k) in TEMPLATES.items():
        found = nodes.where((F.col("root") == root) & (F.size("subs") == 2) & (_sub(1) == "0")).groupBy(piece(value, k).alias("id")).agg(F.count("*").alias(name))
        out = out.join(found, "id", "left")
    dated = out.where("first_is_date").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("dated_subfiles"))
    out = out.join(dated, "id", "left")
    out = out.withColumn("place", F.regexp_replace("root", "[,(]$", "")).join(records, "place", "left").withColumn("store_active", F.coalesce(F.col("record_count") > 0, F.lit(False)))
    if labels is None:
        out = out.withColumn("p_referrers", F.lit(0.0))
    else:
        pairs = fields(nodes, dd, decimals).where("target <> ''").select("id", "target").distinct().join(labels.select("id", "label"), "id", "left")
        share = pairs.groupBy(F.col("target").alias("id")).agg((F.count_if(F.col("label") == "P") / F.count("*")).alias("p_referrers"))
        out = out.join(share, "id", "left").withColumn("p_referrers", F.coalesce("p_referrers", F.lit(0.0)))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("fields", "audited", "word_fields", "computed", "depth", "dated_subfiles", *TEMPLATES)}
    false = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("first_is_date", "no_delete", "created", "no_write", "open_laygo", "trigger_to_p")}
    rest = {
        "records": F.coalesce("record_count", F.lit(0)).cast("long"), "is_subfile": F.col("parent").isNotNull(), "set_share": F.coalesce(F.try_divide("sets", "fields"), F.lit(0.0)),
        "xrefs": F.coalesce("xrefs", F.array().cast("array<string>")), "write_access": X.null_to_blank(F.col("write_access")), "delete_access": X.null_to_blank(F.col("delete_access")),
    }
    return out.withColumns(zero | false | rest).drop("place", "record_count", "sets", "parent", "root")

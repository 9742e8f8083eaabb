"""Ordered rules over features: one ``when`` chain per cascade, carrying method, confidence and evidence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.config import labels as L
from corvane.functions import text as X
from corvane.operators.graph import nearest_labelled, propagate
from corvane.session import stored as cut


@dataclass
class Rule:
    method: str
    when: Column
    label: str
    confidence: str
    evidence: Column
    second: str | None = None


#: From the strongest on, and from the most sensitive on.
CONFIDENCES, SENSITIVITY = ("certain", "high", "moderate", "low"), ("P", "I", "K", "S")


def cascade(rules: list[Rule]) -> Column:
    """A struct (label, method, confidence, evidence) of the first rule that holds; null if none does."""
    out = None
    for r in rules:
        value = F.struct(F.lit(r.label).alias("label"), F.lit(r.method).alias("method"), F.lit(r.confidence).alias("confidence"), r.evidence.alias("evidence"))
        out = F.when(r.when, value) if out is None else out.when(r.when, value)
    return out


def labelled(features: DataFrame, rules: list[Rule]) -> DataFrame:
    return features.withColumn("r", cascade(rules)).select(*features.columns, "r.label", "r.method", "r.confidence", "r.evidence")


def record_type_rules() -> list[Rule]:
    """The coded rules for record types, in order.

    Features: number (text), name, root, to_2 / to_4 / to_200 (pointer fields to
    these types), last_to_2 (number and name of the last such field), prefix and
    owner (of the longest group prefix), ptr_in, ptr_out.
    """
    number = F.col("number").try_cast("double")
    store = X.store_name(F.col("root"))
    at = F.concat(F.lit("global="), F.col("root"))
    # fixed values: the texts of evidence
    rules = [
        Rule("H-01", F.col("root") == "^DPT(", "P", "certain", at),
        Rule("H-02", F.col("root") == "^DD(", "S", "certain", at),
        Rule("H-02", (number >= 0) & (number < 2), "S", "certain", F.concat(F.lit("file#="), F.col("number"))),
        Rule("H-03", number == 2, "P", "certain", F.lit("file=2 PATIENT")),
        Rule("H-04", number == 4, "I", "certain", F.lit("file=4 INSTITUTION")),
        Rule("H-04b", number == 200, "I", "certain", F.lit("file=200 NEW PERSON (staff/provider PII, RF-008)")),
        Rule("H-06", F.col("to_2") > 0, "P", "high", F.concat(F.lit("field="), F.col("last_to_2"), F.lit(" points to file 2"))),
        Rule("H-08", F.col("to_4") > 0, "I", "high", F.lit("has ptr to file 4; no ptr to file 2")),
        Rule("H-09", F.col("to_200") > 0, "I", "low", F.lit("has ptr to file 200 (staff/provider); no ptr to file 2 or 4")),
    ]
    for method, (label, names) in zip(("H-10", "H-11", "H-12", "H-13"), L.STORES.items(), strict=True):
        rules.append(Rule(method, store.isin(names), label, "high", F.concat(at, F.lit(f" in {label}-list"))))
    for method, (label, names) in zip(("H-14", "H-15", "H-16", "H-17"), L.PREFIXES.items(), strict=True):
        rules.append(Rule(method, F.col("prefix").isin(names), label, "moderate", F.concat(F.lit("package="), F.col("owner"), F.lit(" ("), F.col("prefix"), F.lit(")"))))
    rules.append(Rule("H-18", (F.col("ptr_in") >= 10) & (F.col("ptr_out") <= 2) & (F.col("to_2") == 0), "K", "moderate", F.format_string("ptr_in=%d ptr_out=%d", "ptr_in", "ptr_out")))
    for method, (label, words) in zip(("H-20", "H-21", "H-22", "H-23"), L.NAME_WORDS.items(), strict=True):
        rules.append(Rule(method, F.upper("name").rlike("|".join(words)), label, "low", F.lit(f"name contains {label}-pattern")))
    return rules


def specified_rules() -> list[Rule]:
    """Rules that are specified without code, in order of number. Where two labels are named, the first is the default here and the other one ``second``.

    Features: records, ptr_in, ptr_out, audited, first_is_date, is_subfile, no_delete,
    created, no_write, depth, word_fields, set_share, fields, dinum, computed,
    p_referrers (share of referring types labelled P), xrefs (array of names),
    trigger_to_p, write_access, delete_access, open_laygo, number, print_templates,
    input_templates, forms.
    """
    n = F.col("number").try_cast("double")
    c = F.col
    rows = [
        ("H-19", (c("ptr_in") == 0) & (c("ptr_out") == 0) & (c("records") < 100), "S", "low", "no pointers, few records"),
        ("H-24", c("audited") >= 3, "P", "moderate", "audited fields"),
        ("H-25", c("first_is_date") & c("is_subfile"), "P", "moderate", "dated subfile"),
        ("H-26", c("no_delete"), "P", "moderate", "deletion restricted"),
        ("H-27", c("created"), "P", "low", "creation date field"),
        ("H-28", c("no_write"), "P", "low", "write restricted"),
        ("H-29", (c("audited") == 0) & ~c("no_delete") & ~c("created") & (c("records") < 500), "K", "low", "no audit, delete or date fields"),
        ("H-30", c("depth") >= 3, "P", "moderate", "deep structure"),
        ("H-31", c("word_fields") >= 3, "P", "moderate", "word-processing fields"),
        ("H-32", c("set_share") > 0.5, "K", "moderate", "mostly set fields"),
        ("H-33", c("fields") > 50, "P", "low", "many fields"),
        ("H-34", c("dinum") & (c("records") < 1000), "K", "moderate", "number is the key, few records"),
        ("H-35", c("computed") >= 3, "S", "low", "computed fields"),
        ("H-37", c("p_referrers") > 0.7, "K", "moderate", "referrers are P"),
        ("H-41", F.arrays_overlap(c("xrefs"), F.array(F.lit("ADFN"), F.lit("DFN"), F.lit("ADFN2"))), "P", "high", "patient cross-reference"),
        ("H-42", c("trigger_to_p"), "P", "moderate", "trigger into a P store"),
        ("H-43", F.size(c("xrefs")) >= 8, "P", "low", "many cross-references"),
        ("H-44", (F.size(c("xrefs")) == 1) & F.array_contains(c("xrefs"), "B") & (c("records") < 5000), "K", "low", "only cross-reference B"),
        ("H-45", (c("write_access") == "@") | (c("delete_access") == "@"), "S", "moderate", "programmer access"),
        ("H-46", c("open_laygo") & (c("ptr_in") > 5), "K", "low", "open additions, referred to"),
        ("H-47", (n >= 9000000) & (n < 9000100), "P", "moderate", "number range"),
        ("H-48", (n >= 9999999) & (n < 10000000), "K", "moderate", "number range"),
        ("H-49", (n >= 0) & (n < 2), "S", "certain", "number range"),
        ("H-50", c("print_templates") >= 5, "P", "low", "print templates"),
        ("H-51", c("input_templates") >= 2, "P", "low", "input templates"),
        ("H-52", c("forms") >= 1, "P", "low", "forms"),
    ]
    second = {"H-27": "I", "H-28": "S", "H-29": "S", "H-33": "I", "H-37": "I", "H-43": "I", "H-50": "I", "H-52": "I"}
    return [Rule(m, w, label, conf, F.lit(e), second.get(m)) for m, w, label, conf, e in rows]


def store_rules() -> list[Rule]:
    """Rules for stores without a description. Features: store, patient_namespace, patient_subscripts, referrer_groups, referrer_label, partial_patient."""
    c = F.col
    scratch = c("store").rlike("^(?:" + "|".join(L.SCRATCH) + ")")
    rules = [
        Rule("G-01", c("patient_namespace"), "P", "moderate", F.lit("namespace of a patient group")),
        Rule("G-02", c("patient_subscripts"), "P", "high", F.lit("subscripts are patient numbers")),
        Rule("G-03", scratch, "S", "certain", F.lit("scratch store")),
        Rule("G-04", c("store").startswith("%Z"), "S", "high", F.lit("site store")),
        Rule("G-06", c("partial_patient"), "P", "moderate", F.lit("undescribed branches by patient")),
    ]
    for label in "PIKS":
        rules.append(Rule("G-05", (c("referrer_groups") == 1) & (c("referrer_label") == label), label, "low", F.lit("all referrers in one group")))
    return rules


def inherited(cascaded: DataFrame) -> DataFrame:
    """Types without a certain or high label take the label of the types above them, as H-05, certain.

    ``cascaded`` has id, parent, label, method, confidence and evidence. From the
    root down, a weak or missing label gives way to whatever its parent ends up
    with. That is the label of the nearest certain or high one above, and where
    none is, that of the uppermost labelled one; so both are found by climbing,
    in rounds that grow with the logarithm of the depth. A line that runs into a
    cycle counts as far as the cycle's first return.
    """
    cascaded = cut(cascaded)
    tree = cascaded.select("id", "parent", "label", F.coalesce(F.col("confidence").isin("certain", "high"), F.lit(False)).alias("strong"))
    named = tree.where("label is not null").select("id", "label")
    near = nearest_labelled(tree, named).select(F.col("id").alias("parent"), F.col("label").alias("over"))
    uppermost = tree.where("label is not null").join(near, "parent", "left").where("over is null or parent = id").select("id", "label")
    by_strong = nearest_labelled(tree, tree.where("strong and label is not null").select("id", "label")).select("id", F.col("label").alias("of_strong"), F.col("from_id").alias("strong_id"))
    by_top = nearest_labelled(tree, uppermost).select("id", F.col("label").alias("of_top"), F.col("from_id").alias("top_id"))
    found = tree.select("id", "strong").join(by_strong, "id", "left").join(by_top, "id", "left").select(
        "id", F.when(~F.col("strong"), F.coalesce(F.when(F.col("strong_id") != F.col("id"), F.col("of_strong")), F.when(F.col("top_id") != F.col("id"), F.col("of_top")))).alias("up")
    )
    weak = F.col("up").isNotNull()
    new = {
        "label": F.when(weak, F.col("up")).otherwise(F.col("label")),
        "evidence": F.when(weak, F.concat(F.lit("inherits from "), F.col("parent").cast("string"))).otherwise(F.col("evidence")),
        "method": F.when(weak, F.lit("H-05")).otherwise(F.col("method")),
        "confidence": F.when(weak, F.lit("certain")).otherwise(F.col("confidence")),
    }
    return cascaded.join(found, "id", "left").withColumns(new).drop("up")


def classified(features: DataFrame, pointers: DataFrame, rules: list[Rule] | None = None, rounds: int = 6, linked: DataFrame | None = None) -> DataFrame:
    """(id, parent, label, method, confidence, evidence): the four passes over record types.

    The rules in order (the coded ones by default); inheritance; propagation along
    ``pointers`` (id, target) to types without a parent that are still open; and
    inheritance by open types from the nearest labelled one above, which says that
    it came after propagation. ``features`` has id, parent and what the rules read;
    ``linked`` (id) names those that aren't orphans, by default the ends of
    ``pointers``.
    """
    columns = ("label", "method", "confidence", "evidence")
    first = cut(inherited(labelled(features, rules or record_type_rules()).select("id", "parent", *columns)))
    open_ = first.where("label is null and parent is null").select("id")
    reached = propagate(open_, pointers, first.select("id", "label"), "P", "K", rounds, only_nodes=True, linked=linked).where("method <> 'seed'")
    new = reached.select("id", *[F.col(c).alias(f"new_{c}") for c in columns])
    merged = cut(first.join(new, "id", "left").select("id", "parent", *[F.coalesce(c, f"new_{c}").alias(c) for c in columns]))
    up = nearest_labelled(merged.select("id", "parent"), merged.select("id", "label")).where("from_id <> id").select("id", F.col("label").alias("up"))
    late = F.col("label").isNull() & F.col("up").isNotNull()
    values = {
        "label": F.col("up"), "method": F.lit("H-05"), "confidence": F.lit("certain"), "evidence": F.concat(F.lit("inherits(prop) from "), F.col("parent").cast("string")),
    }
    return merged.join(up, "id", "left").select("id", "parent", *[F.when(late, values[c]).otherwise(F.col(c)).alias(c) for c in columns])


def field_labels(fields: DataFrame, types: DataFrame, tops: DataFrame | None = None) -> DataFrame:
    """Fields (record, field, name, spec, target) with their type's label, their target's, a cross flag and a sensitivity flag.

    A type without a label takes its top ancestor's (``tops``: record, top).
    """
    own = types.select("record", F.col("label").alias("own"))
    out = fields.join(own, "record", "left")
    if tops is not None:
        out = out.join(tops, "record", "left").join(types.select(F.col("record").alias("top"), F.col("label").alias("top_label")), "top", "left")
        out = out.withColumn("own", F.coalesce("own", "top_label")).drop("top", "top_label")
    # fields that point nowhere meet no type, and are dealt out by their own record
    points = X.null_to_blank(F.col("target").cast("string")) != ""
    named = types.select(F.col("record").alias("to"), F.lit(True).alias("points"), F.col("label").alias("ref_label"))
    out = out.withColumns({"points": points, "to": F.when(points, F.col("target")).otherwise(F.col("record"))}).join(named, ["to", "points"], "left").drop("to", "points")
    name = F.upper(F.col("name"))
    says = name.rlike("|".join(L.SENSITIVE)) | (name == "DOB") | ((name == "NAME") & (F.col("field") == ".01"))
    return out.withColumns(
        {
            "data_type": X.data_type(F.col("spec")),
            "cross": F.when(F.col("own").isNotNull() & F.col("ref_label").isNotNull() & (F.col("own") != F.col("ref_label")), "Y").otherwise(""),
            "sensitivity": F.when(F.col("own").isNotNull() & (F.col("own") != "P") & says, "Y").otherwise(""),
        }
    )


def properties(records: Column, label: Column, template: Column, ephemeral: Column) -> dict[str, Column]:
    """Volume, sensitivity, volatility and portability of a record type."""
    volume = F.when(records < 1000, "reference").when(records <= 100_000, "moderate").otherwise("high-volume")
    return {
        "volume": volume,
        "sensitivity": F.when(label == "P", "protected").when(label == "K", "public").when(label.isin("I", "S"), "operational"),
        "volatility": F.when((records == 0) | template, "static").when((label == "P") & (volume == "high-volume"), "dynamic").when((label == "S") & ephemeral, "ephemeral").otherwise("slow"),
        "portability": F.when(label == "K", "universal").otherwise("site-specific"),
    }


def quadrant(in_degree: Column, out_degree: Column, many_in: int, many_out: int) -> Column:
    """hub (both high), framework (referred to), orchestrator (refers) or leaf."""
    return (
        F.when((in_degree >= many_in) & (out_degree >= many_out), "hub").when(in_degree >= many_in, "framework").when(out_degree >= many_out, "orchestrator").otherwise("leaf")
    )


def coverage_class(observed: DataFrame, declared: DataFrame, key: str, branch: str) -> DataFrame:
    """(key, branches, undeclared, coverage): full, partial or none of a store's branches are declared."""
    d = declared.select(key, branch).distinct().withColumn("d", F.lit(1))
    return (
        observed.select(key, branch).distinct().join(d, [key, branch], "left").groupBy(key)
        .agg(F.count("*").alias("branches"), F.count_if(F.col("d").isNull()).alias("undeclared"))
        .withColumn("coverage", F.when(F.col("undeclared") == 0, "full").when(F.col("undeclared") == F.col("branches"), "none").otherwise("partial"))
    )

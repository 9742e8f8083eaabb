"""All rules that hold, conflicts between them, second labels, and what is left sorted into five categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.operators.rules import CONFIDENCES, SENSITIVITY, Rule

#: Categories: empty types, those that their group tells, conflicts with a known answer, types of two audiences, and no signal.
CATEGORIES = ("A", "B", "C", "D", "E")
MATCHED = "matched"
#: A type of fewer fields may be empty for good; from so many cross-references on, structure tells more than pointers.
FEW_FIELDS, MANY_XREFS = 5, 8


def firings(rules: list[Rule]) -> Column:
    """An array of (label, second, method, confidence, rank, evidence) of every rule that holds, in the order of the rules."""
    made = [
        F.when(
            r.when,
            F.struct(
                F.lit(r.label).alias("label"), F.lit(r.second).cast("string").alias("second"), F.lit(r.method).alias("method"), F.lit(r.confidence).alias("confidence"),
                F.lit(CONFIDENCES.index(r.confidence)).alias("rank"), r.evidence.alias("evidence"),
            ),
        )
        for r in rules
    ]
    return F.array_compact(F.array(*made))


def resolved(features: DataFrame, rules: list[Rule]) -> DataFrame:
    """``features`` with fired, label, second, method, confidence, evidence and conflict.

    Only the rules of the strongest confidence that fired decide. If they name
    several labels, there is a conflict: the most sensitive one (P, I, K, S) is
    the label and the next the second one. If they agree, a rule that is specified
    with two labels gives the second. Method and evidence are those of the first
    deciding rule with the label. No rule gives nulls and no conflict.
    """
    fired = F.col("fired")
    top = F.filter(fired, lambda f: f["rank"] == F.array_min(F.transform(fired, lambda g: g["rank"])))
    out = features.withColumn("fired", firings(rules)).withColumn("top", top)
    named = F.filter(F.array(*[F.lit(s) for s in SENSITIVITY]), lambda s: F.exists("top", lambda f: f["label"] == s))
    out = out.withColumn("named", named).withColumn("first", F.get(F.filter("top", lambda f: f["label"] == F.get("named", F.lit(0))), F.lit(0)))
    alternative = F.get(F.filter(F.transform("top", lambda f: f["second"]), lambda s: s.isNotNull() & (s != F.col("first.label"))), F.lit(0))
    return out.select(
        *features.columns, "fired", "first.label", F.coalesce(F.get("named", F.lit(1)), alternative).alias("second"), "first.method", "first.confidence", "first.evidence", (F.size("named") > 1).alias("conflict")
    )


def triaged(features: DataFrame, rules: list[Rule], decisions: DataFrame) -> DataFrame:
    """(id, category, label, second, method, confidence, evidence, fired) of every type.

    ``features`` has id, what the rules read, and records, fields, xrefs, the
    counts of templates and forms, store_active, owner, prefix, to_2, to_4, to_200,
    to_80 and dated_subfiles. ``decisions`` (owner, label) says what people have
    decided for whole groups, a row per group.

    No rule: A if the type has no records, few fields, no templates and no
    cross-reference but B (S, unless its store holds nodes, which leaves it open);
    B if its group is known (the group's label, once decided); else E, which is
    labelled U. Rules in conflict: C where what the type points to, or its
    structure, has a known answer; else D, with two labels. All others are matched.
    """
    told = resolved(features, rules).join(decisions.select("owner", F.col("label").alias("decided")), "owner", "left")
    none, count = F.size("fired") == 0, lambda c: F.coalesce(F.col(c), F.lit(0))
    empty = (count("records") == 0) & (count("fields") < FEW_FIELDS) & (count("print_templates") + count("input_templates") + count("forms") == 0) & (F.size(F.array_except("xrefs", F.array(F.lit("B")))) <= 0)
    anchors = (count("to_2") + count("to_4") + count("to_200")) > 0
    answer = (
        F.when((count("to_2") > 0) & (count("to_80") > 0), "P")
        .when((count("to_4") > 0) & (count("to_200") > 0) & (count("to_2") == 0), "I")
        .when(~anchors & (F.size("xrefs") >= MANY_XREFS) & (count("dated_subfiles") > 0), "P")
    )
    told = told.withColumn("answer", answer)
    category = (
        F.when(none & empty, "A").when(none & F.col("owner").isNotNull(), "B").when(none, "E").when(F.col("conflict") & F.col("answer").isNotNull(), "C").when(F.col("conflict"), "D").otherwise(MATCHED)
    )
    is_ = F.col("category")
    told = told.withColumn("category", category)
    vestigial = (is_ == "A") & ~F.coalesce("store_active", F.lit(False))
    batch = (is_ == "B") & F.col("decided").isNotNull()

    def chosen(a: str | Column | None, b: str | Column | None, c: str | Column | None, e: str | Column | None, other: str) -> Column:
        return F.when(vestigial, a).when(batch, b).when(is_ == "C", c).when(is_ == "E", e).otherwise(F.col(other))

    facts = F.concat(F.lit("record_count=0 field_count="), count("fields").cast("string"))
    return told.select(
        "id", "category", chosen("S", F.col("decided"), F.col("answer"), "U", "label").alias("label"), F.when(is_.isin("D", MATCHED), F.col("second")).alias("second"),
        chosen("manual-vestigial", "manual-package", F.col("method"), "manual-unresolved", "method").alias("method"), chosen(None, None, F.col("confidence"), None, "confidence").alias("confidence"),
        chosen(facts, F.concat(F.lit("package="), F.col("prefix")), F.array_join(F.transform("fired", lambda f: f["method"]), ","), "no rule fired", "evidence").alias("evidence"), "fired",
    )


def category_counts(rows: DataFrame) -> DataFrame:
    """(category, n, share) of all categories, also empty ones; ``all`` is their sum."""
    counts = rows.groupBy("category").agg(F.count("*").alias("n"))
    known = [F.struct(F.lit(c).alias("category")) for c in (*CATEGORIES, MATCHED)]
    names = rows.sparkSession.range(1).select(F.inline(F.array(*known)))
    full = names.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
    total = rows.agg(F.lit("all").alias("category"), F.count("*").alias("n"))
    whole = total.select(F.col("n").alias("of"))
    return reduce(DataFrame.unionByName, [full, total]).crossJoin(F.broadcast(whole)).select("category", "n", F.coalesce(F.try_divide("n", "of"), F.lit(0.0)).alias("share"))

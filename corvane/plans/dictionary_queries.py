"""Queries over a data dictionary: orders become record types, line items their fields, nations the groups that own stores, all of them first as nodes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.config import labels as L
from corvane.operators import census as C
from corvane.operators import dictionary as D
from corvane.operators import rules as R
from corvane.operators import triage as T
from corvane.plans.base import Tables, query
from corvane.plans.code_queries import _INHERITED, passes_sql
from corvane.session import cut, stored

#: What the nodes say about order k, by the first divisor that k has; (divisor, remainder, text).
_ROOTS = [(97, 5, "^DPT("), (89, 5, "^DD("), (13, 0, "^LR("), (17, 0, "^SC("), (19, 0, "^PSDRUG("), (23, 0, "^XTV("), (29, 0, "^DGX("), (31, 0, "^PRCQ("), (37, 0, "^LEXA("), (41, 0, "^XUZ("), (43, 0, "^DGBT(")]
_NAMES = [(11, 0, "Visit type"), (11, 1, "Error log"), (11, 2, "Ward"), (11, 3, "Patient")]
_PREFIXES = ["DG", "PRC", "LEX", "XU", "", "DG", "DGB"]


def _chosen(key: Column, cases: list[tuple[int, int, str]], other: Column | None) -> Column:
    out = F.when(key % cases[0][0] == cases[0][1], cases[0][2])
    for by, rest, text in cases[1:]:
        out = out.when(key % by == rest, text)
    return out.otherwise(other)


def _case(key: str, cases: list[tuple[int, int, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {key} % {by} = {rest} THEN '{text}'" for by, rest, text in cases) + f" ELSE {other} END"


_FIELD_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS k, CASE WHEN l_linenumber % 2 = 1 THEN '.0' || l_linenumber ELSE CAST(l_linenumber AS VARCHAR) END AS f,
    CASE WHEN l_suppkey = 2 THEN '2' WHEN l_suppkey = 4 THEN '4' WHEN l_suppkey = 20 THEN '200' WHEN l_suppkey = 3 THEN '40.8' WHEN l_suppkey % 2 = 0 THEN CAST(l_partkey * 5 AS VARCHAR) ELSE '' END AS t,
    CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'Name' WHEN l_returnflag = 'R' THEN 'Home street' ELSE 'F' || l_linenumber END AS nm, CASE WHEN l_suppkey % 7 = 1 THEN 'S' WHEN l_returnflag = 'N' THEN 'RD' ELSE 'F' END AS other FROM lineitem"""

_NODES_SQL = f"""o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS s, o_custkey, o_orderstatus, o_orderkey % 5 = 0 AND o_orderkey > 0 AS below FROM orders),
g AS ({_FIELD_SQL}),
n(root, subs, value) AS (
  SELECT '^DD', [s, '0'], 'DD ' || s || '^x^y^' || o_custkey % 60 || 'n' FROM o UNION ALL SELECT '^DD', [s, '0', 'UP'], CAST(k // 3 AS VARCHAR) FROM o WHERE below
  UNION ALL SELECT '^DD', ['B', n_name, CAST(n_nationkey AS VARCHAR)], '' FROM nation
  UNION ALL SELECT '^DD', [k, f, '0'], nm || '^' || CASE WHEN t = '' THEN other ELSE '*P' || t || '''' END || '^x' FROM g UNION ALL SELECT '^DD', [t, '0', 'PT', k, f], '' FROM g WHERE t <> ''
  UNION ALL SELECT '^DIC', [s, '0'], {_case("k", _NAMES, "'Nothing'")} || '^x^' || CASE WHEN o_orderstatus = 'F' THEN 'ID' ELSE 'I' END FROM o WHERE NOT below
  UNION ALL SELECT '^DIC', [s, '0', 'GL'], {_case("k", _ROOTS, "'^ZZ' || s || '('")} FROM o WHERE NOT below AND k % 47 <> 0
  UNION ALL SELECT '^DIC(9.4', [CAST(n_nationkey AS VARCHAR), '0'], 'OWNER ' || n_name || '^' || {_case("n_nationkey", [(25, k, p) for k, p in enumerate(_PREFIXES)], "'N' || n_nationkey")} FROM nation)"""

_CANON = "^(-?(0|[1-9][0-9]*|([1-9][0-9]*)?\\.[0-9]*[1-9]))$"

_FACTS_SQL = f"""{_NODES_SQL},
dd AS (SELECT subs, value FROM n WHERE root = '^DD' AND regexp_matches(subs[1], '{_CANON}')), di AS (SELECT subs[1] AS id, len(subs) AS l, value FROM n WHERE root = '^DIC'),
f AS (SELECT id, field, name, spec, regexp_replace(translate(regexp_extract(spec, '[Pp]([0-9][0-9Pp]*)', 1), 'Pp', ''), '^0+([0-9])', '\\1') AS target
  FROM (SELECT subs[1] AS id, subs[2] AS field, split_part(value, '^', 1) AS name, split_part(value, '^', 2) AS spec FROM dd WHERE len(subs) = 3 AND subs[3] = '0' AND regexp_matches(subs[2], '{_CANON}'))),
fa AS (SELECT id, count(*) FILTER (target <> '') AS ptr_out, count(*) FILTER (contains(spec, 'P')) AS p_fields, count(*) FILTER (target = '2') AS to_2, count(*) FILTER (target = '4') AS to_4, count(*) FILTER (target = '200') AS to_200,
  arg_max(field || ' ' || name, (CAST(field AS DECIMAL(18, 4)), field || ' ' || name)) FILTER (target = '2') AS last_2 FROM f GROUP BY 1),
pt AS (SELECT subs[1] AS id, count(DISTINCT subs[4]) AS ptr_in FROM dd WHERE len(subs) >= 4 AND subs[2] = '0' AND subs[3] = 'PT' GROUP BY 1),
fact AS (
  SELECT t.id, nullif(up.value, '') AS parent, CASE WHEN d0.id IS NOT NULL THEN split_part(d0.value, '^', 1) ELSE split_part(coalesce(z.value, ''), '^', 1) END AS name, coalesce(gl.value, '') AS root,
    coalesce(TRY_CAST(regexp_extract(split_part(z.value, '^', 4), '^[0-9]*') AS BIGINT), 0) AS field_count, coalesce(ptr_in, 0) AS ptr_in, coalesce(ptr_out, 0) AS ptr_out, coalesce(p_fields, 0) AS p_fields,
    coalesce(to_2, 0) AS to_2, coalesce(to_4, 0) AS to_4, coalesce(to_200, 0) AS to_200, last_2, CASE WHEN d0.id IS NULL THEN '' WHEN contains(split_part(d0.value, '^', 3), 'D') THEN 'Y' ELSE 'N' END AS dinum
  FROM (SELECT DISTINCT subs[1] AS id FROM dd) t LEFT JOIN dd z ON z.subs = [t.id, '0'] LEFT JOIN dd up ON up.subs = [t.id, '0', 'UP'] LEFT JOIN di d0 ON d0.id = t.id AND d0.l = 2 LEFT JOIN di gl ON gl.id = t.id AND gl.l = 3
  LEFT JOIN fa ON fa.id = t.id LEFT JOIN pt ON pt.id = t.id),
own AS (SELECT CAST(subs[1] AS INTEGER) AS ien, split_part(value, '^', 1) AS owner, split_part(value, '^', 2) AS prefix FROM n WHERE root = '^DIC(9.4' AND split_part(value, '^', 2) <> ''),
best AS (SELECT store, arg_min(owner, (-len(prefix), ien)) AS owner, arg_min(prefix, (-len(prefix), ien)) AS prefix FROM (SELECT DISTINCT regexp_extract(root, '\\^([^(^]*)', 1) AS store FROM fact) s JOIN own ON starts_with(store, prefix) GROUP BY 1),
feature AS (SELECT fact.*, owner, prefix, regexp_extract(root, '\\^([^(^]*)', 1) AS st FROM fact LEFT JOIN best ON store = regexp_extract(root, '\\^([^(^]*)', 1))"""


def _in(names: list[str]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


_STORE_RULES = " ".join(f"WHEN st IN {_in(names)} THEN '{label}|H-1{k}|high|global=' || root || ' in {label}-list'" for k, (label, names) in enumerate(L.STORES.items()))
_PREFIX_RULES = " ".join(f"WHEN prefix IN {_in(names)} THEN '{label}|H-1{k + 4}|moderate|package=' || owner || ' (' || prefix || ')'" for k, (label, names) in enumerate(L.PREFIXES.items()))
_NAME_RULES = " ".join(f"WHEN regexp_matches(upper(name), '{'|'.join(words)}') THEN '{label}|H-2{k}|low|name contains {label}-pattern'" for k, (label, words) in enumerate(L.NAME_WORDS.items()))

_RULES_SQL = f"""r AS (SELECT id, parent, CASE WHEN root = '^DPT(' THEN 'P|H-01|certain|global=^DPT(' WHEN root = '^DD(' THEN 'S|H-02|certain|global=^DD(' WHEN CAST(id AS DOUBLE) >= 0 AND CAST(id AS DOUBLE) < 2 THEN 'S|H-02|certain|file#=' || id
  WHEN id = '2' THEN 'P|H-03|certain|file=2 PATIENT' WHEN id = '4' THEN 'I|H-04|certain|file=4 INSTITUTION' WHEN id = '200' THEN 'I|H-04b|certain|file=200 NEW PERSON (staff/provider PII, RF-008)'
  WHEN to_2 > 0 THEN 'P|H-06|high|field=' || last_2 || ' points to file 2' WHEN to_4 > 0 THEN 'I|H-08|high|has ptr to file 4; no ptr to file 2' WHEN to_200 > 0 THEN 'I|H-09|low|has ptr to file 200 (staff/provider); no ptr to file 2 or 4'
  {_STORE_RULES} {_PREFIX_RULES} WHEN ptr_in >= 10 AND ptr_out <= 2 THEN 'K|H-18|moderate|ptr_in=' || ptr_in || ' ptr_out=' || ptr_out {_NAME_RULES} END AS r FROM feature)"""

_LABELS_SQL = f"""{_FACTS_SQL}, {_RULES_SQL}, {_INHERITED}, {passes_sql("SELECT id, target FROM f WHERE target <> ''", "SELECT id FROM fact WHERE ptr_in > 0 OR ptr_out > 0")}"""

_ROOT_SQL = """tree(id, parent, top, gl) AS (SELECT id, parent, id, nullif(root, '') FROM fact WHERE parent IS NULL UNION ALL SELECT c.id, c.parent, tree.top, coalesce(nullif(c.root, ''), tree.gl) FROM tree JOIN fact c ON c.parent = tree.id),
rec AS (SELECT root, least(count(*), 1000000) AS c FROM (SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN '^LR' WHEN 1 THEN '^SC' WHEN 2 THEN '^DPT' ELSE '^ZZ1' END AS root, c_custkey AS x FROM customer) GROUP BY 1),
inv AS (SELECT fact.id AS file_number, name AS file_name, coalesce(gl, '') AS global_root, coalesce(fact.parent, '') AS parent_file, field_count, ptr_in AS pointer_in, p_fields AS pointer_out,
  CASE WHEN fact.parent IS NULL THEN coalesce(c, 0) END AS record_count, dinum AS is_dinum, 'extracted' AS status FROM fact JOIN tree ON tree.id = fact.id LEFT JOIN rec ON rec.root = regexp_replace(coalesce(gl, ''), '[,(]$', ''))"""


def _nodes(t: Tables) -> DataFrame:
    """The node table that _NODES_SQL makes too."""
    k, key = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    below = (k % 5 == 0) & (k > 0)

    def rows(df: DataFrame, root: str, subs: list[Column | str], value: Column | str) -> DataFrame:
        as_column = lambda x: F.lit(x) if isinstance(x, str) else x
        return df.select(F.lit(root).alias("root"), F.array(*[as_column(s) for s in subs]).alias("subs"), as_column(value).alias("value"))

    n, s, flag = F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_returnflag")
    target = F.when(s == 2, "2").when(s == 4, "4").when(s == 20, "200").when(s == 3, "40.8").when(s % 2 == 0, (F.col("l_partkey") * 5).cast("string")).otherwise("")
    lines = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("k"), F.when(n % 2 == 1, F.concat(F.lit(".0"), n.cast("string"))).otherwise(n.cast("string")).alias("f"), target.alias("t"),
        F.when((flag == "A") & (n == 1), "Name").when(flag == "R", "Home street").otherwise(F.concat(F.lit("F"), n.cast("string"))).alias("nm"), F.when(s % 7 == 1, "S").when(flag == "N", "RD").otherwise("F").alias("other"),
    )
    spec = F.when(F.col("t") == "", F.col("other")).otherwise(F.concat(F.lit("*P"), F.col("t"), F.lit("'")))
    top = t.orders.where(~below)
    nation = F.col("n_nationkey").cast("string")
    prefix = _chosen(F.col("n_nationkey"), [(25, k, p) for k, p in enumerate(_PREFIXES)], F.concat(F.lit("N"), nation))
    parts = [
        rows(t.orders, "^DD", [key, "0"], F.concat(F.lit("DD "), key, F.lit("^x^y^"), (F.col("o_custkey") % 60).cast("string"), F.lit("n"))),
        rows(t.orders.where(below), "^DD", [key, "0", "UP"], F.floor(k / 3).cast("string")),
        rows(t.nation, "^DD", ["B", F.col("n_name"), nation], ""),
        rows(lines, "^DD", [F.col("k"), F.col("f"), "0"], F.concat("nm", F.lit("^"), spec, F.lit("^x"))),
        rows(lines.where("t <> ''"), "^DD", [F.col("t"), "0", "PT", F.col("k"), F.col("f")], ""),
        rows(top, "^DIC", [key, "0"], F.concat(_chosen(k, _NAMES, F.lit("Nothing")), F.lit("^x^"), F.when(F.col("o_orderstatus") == "F", "ID").otherwise("I"))),
        rows(top.where("o_orderkey % 47 <> 0"), "^DIC", [key, "0", "GL"], _chosen(k, _ROOTS, F.concat(F.lit("^ZZ"), key, F.lit("(")))),
        rows(t.nation, "^DIC(9.4", [nation, "0"], F.concat(F.lit("OWNER "), F.col("n_name"), F.lit("^"), prefix)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _records(t: Tables) -> DataFrame:
    """Stores in which every customer is a record of two nodes."""
    key = F.col("c_custkey")
    root = F.when(key % 4 == 0, "^LR").when(key % 4 == 1, "^SC").when(key % 4 == 2, "^DPT").otherwise("^ZZ1")
    return D.store_records(t.customer.select(root.alias("root"), F.explode(F.array(*[F.array(key.cast("string"), F.lit(x)) for x in ("0", "1")])).alias("subs")))


@query(f"WITH {_FACTS_SQL} SELECT id, parent, name, root, field_count, ptr_in, ptr_out, to_2, to_4, to_200, last_2 AS last_to_2, dinum, prefix, owner FROM feature")
def dictionary_features(t: Tables) -> DataFrame:
    """What the rules read, from the nodes of a dictionary."""
    nodes = _nodes(t)
    return D.record_type_features(D.record_type_facts(nodes), D.groups(nodes)).drop("number", "p_fields", "to_80")


@query(f"WITH RECURSIVE {_LABELS_SQL} SELECT id, parent, label, method, confidence, evidence FROM z")
def dictionary_labels(t: Tables) -> DataFrame:
    """Nodes in, labels out: features, rules, inheritance, six rounds of propagation, late inheritance."""
    return D.classified_dictionary(_nodes(t))


@query(f"WITH RECURSIVE {_FACTS_SQL}, {_ROOT_SQL} SELECT * FROM inv")
def record_type_inventory(t: Tables) -> DataFrame:
    """Every record type with its own or inherited root, counts and flags."""
    return D.inventory(D.record_type_facts(_nodes(t)), _records(t))


@query(f"""WITH {_FACTS_SQL}, p AS (SELECT DISTINCT id, target FROM f WHERE target <> ''), a AS (SELECT target AS id, string_agg(id, '|' ORDER BY CAST(id AS DOUBLE)) AS i FROM p GROUP BY 1), b AS (SELECT id, string_agg(target, '|' ORDER BY CAST(target AS DOUBLE)) AS o FROM p GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, coalesce(i, '') AS pointer_in_files, coalesce(o, '') AS pointer_out_files FROM a FULL JOIN b ON a.id = b.id""")
def record_type_referrers(t: Tables) -> DataFrame:
    return D.referrers(_nodes(t))


@query(f"""WITH RECURSIVE {_LABELS_SQL}, {_ROOT_SQL}
SELECT inv.file_number, coalesce(f.field, '') AS field_number, coalesce(f.name, '') AS field_name,
  CASE WHEN f.field IS NULL THEN '' WHEN contains(spec, 'P') THEN 'POINTER' WHEN contains(spec, 'D') THEN 'DATE' WHEN contains(spec, 'S') THEN 'SET' ELSE 'FREE-TEXT' END AS data_type, coalesce(own_label, '') AS field_piks, coalesce(z.label, '') AS file_piks,
  coalesce(z.method, '') AS file_piks_method, coalesce(z.confidence, '') AS file_piks_confidence, coalesce(q.label, '') AS ref_piks, CASE WHEN own_label <> q.label THEN 'Y' ELSE '' END AS cross_piks,
  inv.* EXCLUDE (file_number, status), CASE WHEN record_count < 1000 THEN 'reference' WHEN record_count <= 100000 THEN 'moderate' WHEN record_count > 100000 THEN 'high-volume' ELSE '' END AS volume, coalesce(z.evidence, '') AS piks_evidence, coalesce(f.target, '') AS pointer_target,
  CASE WHEN own_label <> 'P' AND (contains(upper(f.name), 'STREET') OR (upper(f.name) = 'NAME' AND f.field = '.01')) THEN 'Y' ELSE '' END AS sensitivity_flag
FROM inv JOIN z ON z.id = inv.file_number LEFT JOIN tree ON tree.id = z.id LEFT JOIN z y ON y.id = tree.top, LATERAL (SELECT coalesce(z.label, y.label) AS own_label) LEFT JOIN f ON f.id = inv.file_number LEFT JOIN z q ON q.id = f.target""")
def dictionary_export(t: Tables) -> DataFrame:
    """22 columns per field, with the labels that the dictionary itself gives."""
    nodes = _nodes(t)
    facts = stored(D.record_type_facts(nodes))
    return D.wide_export(nodes, D.classified_dictionary(nodes, facts=facts), _records(t), facts=facts)


def _structure_nodes(t: Tables) -> DataFrame:
    """_nodes() and what design says beyond pointers: audits, cross-references, access, templates and forms."""
    lines, key = t.lineitem, F.col("l_orderkey").cast("string")
    n = F.col("l_linenumber")
    field = F.when(n % 2 == 1, F.concat(F.lit(".0"), n.cast("string"))).otherwise(n.cast("string"))
    names = F.when(n == 1, "B").when((n == 2) & (F.col("l_tax") >= 0.07), "DFN").otherwise(F.concat(F.lit("X"), n.cast("string")))
    kind = F.when(n == 4, F.concat(F.lit("TRIGGER^"), (F.col("l_partkey") * 5).cast("string"), F.lit("^3"))).otherwise("REGULAR")

    def rows(df: DataFrame, root: str, value: Column | str, *subs: Column | str) -> DataFrame:
        as_column = lambda x: F.lit(x) if isinstance(x, str) else x
        return df.select(F.lit(root).alias("root"), F.array(*[as_column(s) for s in subs]).alias("subs"), as_column(value).alias("value"))

    order, c = F.col("o_orderkey").cast("string"), F.col("c_custkey")
    access = t.orders
    parts = [
        _nodes(t),
        rows(lines.where("l_tax >= 0.06"), "^DD", "y", key, field, "AUDIT"),
        rows(lines.where("l_discount >= 0.1"), "^DD", "^", key, field, "9"),
        rows(lines.where("l_linestatus = 'O'"), "^DD", F.concat(key, F.lit("^"), names, F.lit("^"), kind), key, field, "1", "1", "0"),
        rows(access.where("o_orderpriority like '1%'"), "^DIC", "@", order, "0", "WR"),
        rows(access.where("o_orderpriority like '2%'"), "^DIC", "", order, "0", "LAYGO"),
        rows(access.where("o_orderpriority like '5%' and o_orderstatus = 'P'"), "^DIC", "@", order, "0", "DEL"),
        rows(access.where("o_custkey % 40 = 7"), "^DD", "no", order, "0", "DEL", "1"),
        rows(t.customer, "^DIPT", F.concat(F.lit("T^^^"), (c % 300).cast("string")), c.cast("string"), "0"),
        rows(t.supplier, "^DIE", F.concat(F.lit("T^^^"), (F.col("s_suppkey") % 40 * 11).cast("string")), F.col("s_suppkey").cast("string"), "0"),
        rows(t.part, "^DIST(.403", F.concat(F.lit("F^^^^^^^"), (F.col("p_partkey") * 7).cast("string")), F.col("p_partkey").cast("string"), "0"),
    ]
    return reduce(DataFrame.unionByName, parts)


_STRUCTURE_SQL = f"""{_FACTS_SQL}, {_ROOT_SQL},
ln AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, CASE WHEN l_linenumber % 2 = 1 THEN '.0' || l_linenumber ELSE CAST(l_linenumber AS VARCHAR) END AS field, l_linenumber AS k, l_tax, l_discount, l_linestatus, l_partkey FROM lineitem),
fk AS (SELECT id, count(*) AS fields, count(*) FILTER (kind = 'SET') AS sets, max(CASE WHEN field = '.01' AND kind = 'DATE' THEN 1 ELSE 0 END) = 1 AS first_is_date
  FROM (SELECT id, field, CASE WHEN contains(spec, 'P') THEN 'POINTER' WHEN contains(spec, 'D') THEN 'DATE' WHEN contains(spec, 'S') THEN 'SET' ELSE 'FREE-TEXT' END AS kind FROM f) GROUP BY 1),
lk AS (SELECT id, count(*) FILTER (l_tax >= 0.06) AS audited, count(*) FILTER (l_discount >= 0.1) > 0 AS locked, list_sort(list(DISTINCT CASE WHEN k = 1 THEN 'B' WHEN k = 2 AND l_tax >= 0.07 THEN 'DFN' ELSE 'X' || k END) FILTER (l_linestatus = 'O')) AS xrefs FROM ln GROUP BY 1),
tr AS (SELECT DISTINCT ln.id FROM ln JOIN fact ON fact.id = CAST(l_partkey * 5 AS VARCHAR) WHERE k = 4 AND l_linestatus = 'O' AND regexp_extract(root, '\\^([^(^]*)', 1) IN {_in(L.STORES["P"])}),
steps(id, top, k) AS (SELECT id, id, 0 FROM fact WHERE parent IS NULL UNION ALL SELECT c.id, steps.top, k + 1 FROM steps JOIN fact c ON c.parent = steps.id), dp AS (SELECT top AS id, max(k) AS depth FROM steps GROUP BY 1),
dated AS (SELECT parent AS id, count(*) AS dated_subfiles FROM fact JOIN fk ON fk.id = fact.id WHERE first_is_date AND parent IS NOT NULL GROUP BY 1),
p1 AS (SELECT CAST(c_custkey % 300 AS VARCHAR) AS id, count(*) AS print_templates FROM customer GROUP BY 1), p2 AS (SELECT CAST(s_suppkey % 40 * 11 AS VARCHAR) AS id, count(*) AS input_templates FROM supplier GROUP BY 1), p3 AS (SELECT CAST(p_partkey * 7 AS VARCHAR) AS id, count(*) AS forms FROM part GROUP BY 1),
sf AS (
  SELECT x.*, coalesce(fk.fields, 0) AS fields, coalesce(sets, 0) / greatest(coalesce(fk.fields, 0), 1) AS set_share, coalesce(first_is_date, false) AS first_is_date, coalesce(audited, 0) AS audited, coalesce(xrefs, []) AS xrefs, tr.id IS NOT NULL AS trigger_to_p, coalesce(depth, 0) AS depth, coalesce(dated_subfiles, 0) AS dated_subfiles,
    coalesce(print_templates, 0) AS print_templates, coalesce(input_templates, 0) AS input_templates, coalesce(forms, 0) AS forms, coalesce(rec.c, 0) AS records, coalesce(o.o_custkey % 40 = 7, false) AS no_delete,
    coalesce(locked, false) OR coalesce(o.o_orderpriority LIKE '1%', false) AS no_write, coalesce(o.o_orderpriority LIKE '1%', false) OR coalesce(o.o_orderpriority LIKE '5%' AND o.o_orderstatus = 'P', false) AS locked_down, coalesce(o.o_orderpriority LIKE '2%', false) AS open_laygo
  FROM (SELECT feature.*, coalesce(t80, 0) AS to_80 FROM feature LEFT JOIN (SELECT id, count(*) AS t80 FROM f WHERE target = '80' GROUP BY 1) e ON e.id = feature.id) x LEFT JOIN fk ON fk.id = x.id LEFT JOIN lk ON lk.id = x.id LEFT JOIN tr ON tr.id = x.id LEFT JOIN dp ON dp.id = x.id LEFT JOIN dated ON dated.id = x.id
  LEFT JOIN p1 ON p1.id = x.id LEFT JOIN p2 ON p2.id = x.id LEFT JOIN p3 ON p3.id = x.id LEFT JOIN rec ON rec.root = regexp_replace(x.root, '[,(]$', '') LEFT JOIN orders o ON CAST(o.o_orderkey AS VARCHAR) = x.id)"""

_NUMBER = "CAST(id AS DOUBLE)"
#: (method, label, second, rank of the confidence, condition) of every rule, in order.
_ALL_RULES = [
    ("H-01", "P", None, 0, "root = '^DPT('"), ("H-02", "S", None, 0, "root = '^DD('"), ("H-02", "S", None, 0, f"{_NUMBER} >= 0 AND {_NUMBER} < 2"), ("H-03", "P", None, 0, "id = '2'"), ("H-04", "I", None, 0, "id = '4'"), ("H-04b", "I", None, 0, "id = '200'"),
    ("H-06", "P", None, 1, "to_2 > 0"), ("H-08", "I", None, 1, "to_4 > 0"), ("H-09", "I", None, 3, "to_200 > 0"),
    *[(f"H-1{k}", label, None, 1, f"st IN {_in(names)}") for k, (label, names) in enumerate(L.STORES.items())], *[(f"H-1{k + 4}", label, None, 2, f"prefix IN {_in(names)}") for k, (label, names) in enumerate(L.PREFIXES.items())],
    ("H-18", "K", None, 2, "ptr_in >= 10 AND ptr_out <= 2 AND to_2 = 0"), *[(f"H-2{k}", label, None, 3, f"regexp_matches(upper(name), '{'|'.join(words)}')") for k, (label, words) in enumerate(L.NAME_WORDS.items())],
    ("H-19", "S", None, 3, "ptr_in = 0 AND ptr_out = 0 AND records < 100"), ("H-24", "P", None, 2, "audited >= 3"), ("H-25", "P", None, 2, "first_is_date AND parent IS NOT NULL"), ("H-26", "P", None, 2, "no_delete"), ("H-28", "P", "S", 3, "no_write"),
    ("H-29", "K", "S", 3, "audited = 0 AND NOT no_delete AND records < 500"), ("H-30", "P", None, 2, "depth >= 3"), ("H-32", "K", None, 2, "set_share > 0.5"), ("H-33", "P", "I", 3, "fields > 50"), ("H-34", "K", None, 2, "dinum = 'Y' AND records < 1000"),
    ("H-41", "P", None, 1, "list_contains(xrefs, 'DFN')"), ("H-42", "P", None, 2, "trigger_to_p"), ("H-43", "P", "I", 3, "len(xrefs) >= 8"), ("H-44", "K", None, 3, "xrefs = ['B'] AND records < 5000"), ("H-45", "S", None, 2, "locked_down"), ("H-46", "K", None, 3, "open_laygo AND ptr_in > 5"),
    ("H-49", "S", None, 0, f"{_NUMBER} >= 0 AND {_NUMBER} < 2"), ("H-50", "P", "I", 3, "print_templates >= 5"), ("H-51", "P", None, 3, "input_templates >= 2"), ("H-52", "P", "I", 3, "forms >= 1"),
]


def _triage_sql(rules: list[tuple]) -> str:
    fired = " UNION ALL ".join(f"SELECT id, {k} AS ord, '{m}' AS method, '{label}' AS label, {'NULL' if second is None else repr(second)} AS second, {rank} AS rank FROM sf WHERE {when}" for k, (m, label, second, rank, when) in enumerate(rules))
    return f"""{_STRUCTURE_SQL}, fired AS MATERIALIZED ({fired}),
strong AS (SELECT id, min(rank) AS rank, string_agg(method, ',' ORDER BY ord) AS methods FROM fired GROUP BY 1),
lead AS (SELECT fired.* FROM fired JOIN strong w ON w.id = fired.id AND w.rank = fired.rank),
named AS (SELECT id, list_sort(list(DISTINCT instr('PIKS', label))) AS l FROM lead GROUP BY 1),
told AS (SELECT n.id, substr('PIKS', l[1], 1) AS label, substr('PIKS', l[2], 1) AS next, len(l) > 1 AS conflict FROM named n),
res AS (SELECT told.id, told.label, conflict, CASE WHEN conflict THEN next ELSE arg_min(top.second, top.ord) FILTER (top.second IS NOT NULL AND top.second <> told.label) END AS second, arg_min(top.method, top.ord) FILTER (top.label = told.label) AS method FROM told JOIN lead top ON top.id = told.id GROUP BY told.id, told.label, conflict, next),
dec AS (SELECT 'OWNER ' || n_name AS who, CASE n_regionkey WHEN 0 THEN 'K' ELSE 'S' END AS decided FROM nation WHERE n_regionkey < 2),
y AS (SELECT sf.*, res.label, res.second, res.method, coalesce(conflict, false) AS conflict, res.id IS NULL AS silent, decided, methods,
  CASE WHEN to_2 > 0 AND to_80 > 0 THEN 'P' WHEN to_4 > 0 AND to_200 > 0 AND to_2 = 0 THEN 'I' WHEN to_2 + to_4 + to_200 = 0 AND len(xrefs) >= 8 AND dated_subfiles > 0 THEN 'P' END AS answer
  FROM sf LEFT JOIN res ON res.id = sf.id LEFT JOIN strong w ON w.id = sf.id LEFT JOIN dec ON who = owner),
c AS (SELECT *, CASE WHEN silent AND records = 0 AND fields < 5 AND print_templates + input_templates + forms = 0 AND len(list_filter(xrefs, lambda x: x <> 'B')) = 0 THEN 'A' WHEN silent AND owner IS NOT NULL THEN 'B' WHEN silent THEN 'E' WHEN conflict AND answer IS NOT NULL THEN 'C' WHEN conflict THEN 'D' ELSE 'matched' END AS category FROM y),
tri AS (SELECT id, category, CASE WHEN category = 'A' THEN 'S' WHEN category = 'B' THEN decided WHEN category = 'C' THEN answer WHEN category = 'E' THEN 'U' ELSE label END AS label, CASE WHEN category IN ('D', 'matched') THEN second END AS second,
  CASE WHEN category = 'A' THEN 'manual-vestigial' WHEN category = 'B' THEN CASE WHEN decided IS NOT NULL THEN 'manual-package' END WHEN category = 'E' THEN 'manual-unresolved' ELSE method END AS method, coalesce(methods, '') AS methods FROM c)"""


#: H-29 asks for nothing but the absence of signals, so with it nothing is left to sort out; here it isn't among the rules.
_TRIAGE_RULES = [r for r in _ALL_RULES if r[0] not in ("H-19", "H-29", "H-34")]


def _triaged(t: Tables) -> DataFrame:
    """Every rule but H-19, H-29 and H-34, which leave no type without a rule here; what people decided for the groups of two regions."""
    nodes = _structure_nodes(t)
    facts = cut(D.record_type_facts(nodes))
    features = D.record_type_features(facts, D.groups(nodes)).drop("number", "ptr_in", "ptr_out", "parent", "dinum").join(D.structure_features(nodes, facts, _records(t)), "id")
    rules = [r for r in [*R.record_type_rules(), *R.specified_rules()] if r.method not in ("H-19", "H-29", "H-34")]
    region = F.col("n_regionkey")
    decisions = t.nation.where("n_regionkey < 2").select(F.concat(F.lit("OWNER "), F.col("n_name")).alias("owner"), F.when(region == 0, "K").otherwise("S").alias("label"))
    return T.triaged(features, rules, decisions)


@query(f"WITH RECURSIVE {_triage_sql(_TRIAGE_RULES)} SELECT * FROM tri")
def dictionary_triage(t: Tables) -> DataFrame:
    """All rules that hold, one label and maybe a second, and a category for what is left or in conflict."""
    methods = F.array_join(F.transform("fired", lambda f: f["method"]), ",").alias("methods")
    return _triaged(t).select("id", "category", "label", "second", "method", methods)


@query(f"WITH RECURSIVE {_triage_sql(_TRIAGE_RULES)}, kinds AS (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'matched']) AS category), num AS (SELECT category, count(*) AS n FROM tri GROUP BY 1), whole AS (SELECT count(*) AS al FROM tri) SELECT kinds.category, coalesce(n, 0) AS n, coalesce(n, 0) / al AS share FROM whole, kinds LEFT JOIN num ON num.category = kinds.category UNION ALL SELECT 'all', al, 1.0 FROM whole")
def triage_counts(t: Tables) -> DataFrame:
    return T.category_counts(_triaged(t))


@query(f"WITH RECURSIVE {_STRUCTURE_SQL} SELECT id, fields, audited, first_is_date, no_delete, no_write, depth, set_share, array_to_string(xrefs, ',') AS xrefs, trigger_to_p, locked_down, open_laygo, print_templates, input_templates, forms, dated_subfiles, records FROM sf")
def structure_features(t: Tables) -> DataFrame:
    """What the rules read that are specified alone, from the nodes."""
    nodes = _structure_nodes(t)
    found = D.structure_features(nodes, cut(D.record_type_facts(nodes)), _records(t))
    locked = (F.col("write_access") == "@") | (F.col("delete_access") == "@")
    return found.withColumn("locked_down", locked).select(
        "id", "fields", "audited", "first_is_date", "no_delete", "no_write", "depth", "set_share", F.array_join(F.array_sort("xrefs"), ",").alias("xrefs"), "trigger_to_p", "locked_down", "open_laygo", "print_templates", "input_templates", "forms", "dated_subfiles", "records"
    )


def _stores(t: Tables) -> DataFrame:
    """A store for each nation: its customers are the records, with their orders below, an index by name, and for every fifth nation a node of its own."""
    root = F.concat(F.lit("^N"), F.col("c_nationkey").cast("string"))
    c = F.col("c_custkey").cast("string")
    below = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    parts = [
        t.customer.select(root.alias("root"), F.array(c, F.lit("0")).alias("subs")),
        below.select(root.alias("root"), F.array(c, F.lit("P"), F.col("o_orderkey").cast("string"), F.lit("0")).alias("subs")),
        t.customer.select(root.alias("root"), F.array(F.lit("B"), F.col("c_name"), c).alias("subs")),
        t.customer.where("c_nationkey % 5 = 0").select(root.alias("root"), F.array(c, F.lit("X")).alias("subs")),
    ]
    return reduce(DataFrame.unionByName, parts)


def _store_dictionary(t: Tables) -> DataFrame:
    """Types for nations below 20; every other one declares the orders, two of three the index."""
    k = F.col("n_nationkey")
    key = k.cast("string")
    some = t.nation.where("n_nationkey < 20")

    def rows(df: DataFrame, root: str, value: Column, *subs) -> DataFrame:
        return df.select(F.lit(root).alias("root"), F.array(*[F.lit(s) if isinstance(s, str) else s for s in subs]).alias("subs"), value.alias("value"))

    sub = F.when(k == 0, ".1").otherwise(F.concat(key, F.lit(".1")))
    parts = [
        rows(some, "^DD", F.col("n_name"), key, "0"), rows(some, "^DD", F.lit("NAME^RF^^0;1"), key, ".01", "0"), rows(some, "^DIC", F.col("n_name"), key, "0"), rows(some, "^DIC", F.concat(F.lit("^N"), key, F.lit("(")), key, "0", "GL"),
        rows(some.where("n_nationkey % 2 = 0"), "^DD", F.concat(F.lit("ORDERS^"), sub, F.lit("P^^P;0")), key, "1", "0"), rows(some.where("n_nationkey % 2 = 0"), "^DD", key, sub, "0", "UP"),
        rows(some.where("n_nationkey % 2 = 0"), "^DD", F.lit("ORDER^F^^0;1"), sub, ".01", "0"), rows(some.where("n_nationkey % 3 < 2"), "^DD", F.concat(key, F.lit("^B")), key, ".01", "1", "1", "0"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _census(t: Tables) -> DataFrame:
    nodes = _store_dictionary(t)
    return C.census(_stores(t), nodes, cut(D.record_type_facts(nodes)))


_CENSUS_SQL = """s AS (SELECT c_nationkey AS k, count(*) AS customers, count(o.o_custkey) > 0 AS has_orders FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) o ON o.o_custkey = c_custkey GROUP BY 1),
p AS (SELECT k, customers, unnest(list_filter(['#', '#,#', CASE WHEN has_orders THEN '#,P' END, CASE WHEN has_orders THEN '#,P,#' END, CASE WHEN has_orders THEN '#,P,#,#' END, CASE WHEN k % 5 = 0 THEN '#,X' END, 'B'], lambda x: x IS NOT NULL)) AS path, has_orders FROM s),
u AS (SELECT k, path FROM p WHERE CASE WHEN k >= 20 THEN path IN ('#', 'B') ELSE path = '#,P' AND k % 2 = 1 OR path = 'B' AND k % 3 = 2 OR path = '#,X' END),
un AS (SELECT k, count(*) AS n, string_agg(path, '|' ORDER BY path) AS l FROM u GROUP BY 1),
cen AS (SELECT '^N' || s.k AS store, CASE WHEN s.k < 20 THEN CAST(s.k AS VARCHAR) END AS record_type, CASE WHEN s.k >= 20 THEN 'none' WHEN un.k IS NULL THEN 'full' ELSE 'partial' END AS coverage, (SELECT count(*) FROM p WHERE p.k = s.k) + names + customer_names AS branches, coalesce(n, 0) AS undeclared, coalesce(l, '') AS undeclared_branches,
  least(s.customers + 1, 1000000) AS record_count, CASE WHEN has_orders THEN 4 ELSE 3 END AS depth, s.k AS k
  FROM s LEFT JOIN un ON un.k = s.k JOIN (SELECT c_nationkey AS k, count(DISTINCT c_name) AS names, count(DISTINCT c_name) AS customer_names FROM customer GROUP BY 1) m ON m.k = s.k)"""


@query(f"WITH {_CENSUS_SQL} SELECT store, record_type, coverage, branches, undeclared, undeclared_branches, record_count, depth FROM cen")
def store_coverage(t: Tables) -> DataFrame:
    """Full, partial and none, from node tables alone."""
    return _census(t).drop("samples")


@query(f"""WITH {_CENSUS_SQL}, lab AS (SELECT n_nationkey AS k, CASE n_regionkey WHEN 0 THEN 'P' WHEN 1 THEN 'K' WHEN 2 THEN 'S' END AS label FROM nation),
ref AS (SELECT DISTINCT c_nationkey AS k, s_nationkey AS g FROM supplier JOIN customer ON c_custkey = s_suppkey), gr AS (SELECT ref.k, count(*) AS groups, max(label) AS label, bool_and(coalesce(label = 'P', false)) AS ns FROM ref JOIN lab ON lab.k = g GROUP BY 1),
pat AS (SELECT c_nationkey AS k, count(*) FILTER (c_custkey % 10 < 9 AND c_nationkey % 2 = 0 OR c_custkey % 10 < 2) / count(*) > 0.6 AS mine FROM customer GROUP BY 1)
SELECT substr(store, 2) AS store, coverage, CASE WHEN ns THEN 'G-01' WHEN mine AND coverage = 'none' THEN 'G-02' WHEN mine AND coverage = 'partial' AND contains('|' || undeclared_branches, '|#,') THEN 'G-06' WHEN groups = 1 AND label IS NOT NULL THEN 'G-05' END AS method
FROM cen LEFT JOIN gr ON gr.k = cen.k LEFT JOIN pat ON pat.k = cen.k""")
def census_rules(t: Tables) -> DataFrame:
    """The rules for stores, over features that the census gives. Suppliers are units that refer to the store of the customer of their number."""
    label = F.when(F.col("n_regionkey") == 0, "P").when(F.col("n_regionkey") == 1, "K").when(F.col("n_regionkey") == 2, "S")
    refs = t.supplier.join(t.customer, F.col("s_suppkey") == F.col("c_custkey")).select(F.col("s_suppkey").alias("unit"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("store"))
    patients = t.customer.where("c_custkey % 10 < 9 and c_nationkey % 2 = 0 or c_custkey % 10 < 2").select(F.col("c_custkey").alias("id"))
    features = C.store_features(_census(t), _stores(t), patients, refs, t.supplier.select(F.col("s_suppkey").alias("unit"), F.col("s_nationkey").alias("grp")), t.nation.select(F.col("n_nationkey").alias("grp"), label.alias("label")))
    return R.labelled(features, R.store_rules()).select("store", "coverage", "method")

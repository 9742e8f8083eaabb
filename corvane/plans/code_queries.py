"""Queries over a corpus of code that is derived from the parts, over registries, and over cards, entry points and names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.operators import edges as E
from corvane.operators import joins as J
from corvane.operators import profile as P
from corvane.operators import rules as R
from corvane.operators import views as V
from corvane.plans.base import Tables, query
from corvane.plans.view_queries import registry_options
from corvane.session import scratch
from corvane.sources import corpus, nodes

#: Units and their lines, in SQL, as _units() and corpus.lines() make them.
_UNITS = """u AS (
  SELECT 'P' || p_partkey AS unit, p_brand AS grp, [
    'P' || p_partkey || ' ;' || p_name,
    ' ;;' || p_size || ';' || p_type || ';**14, ,79' || CASE WHEN p_size % 2 = 1 THEN ',153' ELSE '' END || '**;Mar 20, 1995;Build 7',
    CASE WHEN p_partkey % 2 = 0 THEN 'EN ; @summary start' ELSE 'EN' END,
    ' D EN^P' || (p_partkey + 1) || ',T^Q',
    ' G:X>1 END^R' || (p_partkey % 50),
    ' S Y="a""b D ^NO;" J ^TASK D:X ^DEEP ; D ^GONE',
    CASE WHEN p_partkey % 3 = 0 THEN ' ; @param x' ELSE ' ; text' END,
    'STARTUP Q',
    CASE WHEN p_partkey % 5 = 0 THEN ' ; @test' ELSE ' Q' END,
    'SUB(A) S X=$$F^P' || (p_partkey % 7) || '(1),Z=^DPT(A)+^%ZOSF("X") Q' || CASE WHEN p_partkey % 4 = 0 THEN ' ' ELSE '' END] AS ls FROM part
  UNION ALL SELECT left('TP' || p_partkey, 8), p_brand, ['TP' || p_partkey || ' ;test'] FROM part WHERE p_partkey % 4 = 0),
l AS (SELECT unit, grp, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS line_no FROM u)"""


def _units(t: Tables) -> DataFrame:
    """(unit, grp, text): a unit of ten lines for each part, and a test unit for every fourth."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def either(k: int, yes: str, no: str) -> Column:
        return F.when(key % k == 0, yes).otherwise(no)

    lines = [
        text("P", key, " ;", F.col("p_name")),
        text(" ;;", size, ";", F.col("p_type"), ";**14, ,79", F.when(size % 2 == 1, ",153").otherwise(""), "**;Mar 20, 1995;Build 7"),
        either(2, "EN ; @summary start", "EN"),
        text(" D EN^P", key + 1, ",T^Q"),
        text(" G:X>1 END^R", key % 50),
        F.lit(' S Y="a""b D ^NO;" J ^TASK D:X ^DEEP ; D ^GONE'),
        either(3, " ; @param x", " ; text"),
        F.lit("STARTUP Q"),
        either(5, " ; @test", " Q"),
        text("SUB(A) S X=$$F^P", key % 7, '(1),Z=^DPT(A)+^%ZOSF("X") Q', either(4, " ", "")),
    ]
    units = t.part.select(text("P", key).alias("unit"), F.col("p_brand").alias("grp"), F.concat_ws("\n", *lines).alias("text"))
    tests = t.part.where(key % 4 == 0).select(F.substring(text("TP", key), 1, 8).alias("unit"), F.col("p_brand").alias("grp"), text("TP", key, " ;test\n").alias("text"))
    return units.unionByName(tests)


def _lines(t: Tables) -> DataFrame:
    return corpus.lines(_units(t))


@query("""SELECT 'P' || p_partkey AS unit, 'EN' AS tag, 'P' || (p_partkey + 1) AS target, 'do' AS kind, CAST(1 AS BIGINT) AS ref_count FROM part UNION ALL SELECT 'P' || p_partkey, 'END', 'R' || (p_partkey % 50), 'goto', 1 FROM part
UNION ALL SELECT 'P' || p_partkey, '', 'TASK', 'job', 1 FROM part UNION ALL SELECT 'P' || p_partkey, '', 'DEEP', 'do', 1 FROM part UNION ALL SELECT 'P' || p_partkey, 'F', 'P' || (p_partkey % 7), 'func', 1 FROM part""")
def code_edges(t: Tables) -> DataFrame:
    """All kinds of references, with conditions behind verbs, doubled quotes and comments."""
    return E.text_edges(_lines(t), ["unit"])


@query("""WITH e AS (SELECT 'P' || (p_partkey + 1) AS target, 'EN' AS tag FROM part UNION ALL SELECT 'R' || (p_partkey % 50), 'END' FROM part UNION ALL SELECT 'TASK', '' FROM part UNION ALL SELECT 'DEEP', '' FROM part UNION ALL SELECT 'P' || (p_partkey % 7), 'F' FROM part)
SELECT target, tag, count(*) AS callers, count(*) AS refs FROM e GROUP BY 1, 2""")
def tag_facts(t: Tables) -> DataFrame:
    """What hovering over TAG^UNIT shows: callers and references of each entry."""
    edges = E.text_edges(_lines(t), ["unit"])
    return edges.groupBy("target", "tag", "unit").agg(F.sum("ref_count").alias("n")).groupBy("target", "tag").agg(F.count("*").alias("callers"), F.sum("n").alias("refs"))


@query("""SELECT 'P' || p_partkey AS unit, p_brand AS grp, CAST(10 AS BIGINT) AS line_count, CAST(2 + p_size % 2 AS BIGINT) AS patches, CAST(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS findings,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 1 END + CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE 1 END AS BIGINT) AS lint, p_partkey % 4 = 0 AS has_test FROM part
UNION ALL SELECT left('TP' || p_partkey, 8), p_brand, 1, 0, 0, 0, false FROM part WHERE p_partkey % 4 = 0""")
def unit_health(t: Tables) -> DataFrame:
    """Lines, patches, findings, missing documentation and tests of every unit."""
    line, marker = F.col("line"), r"(?i);\s*@(summary|param|returns|deprecated|test)\b"
    lines = _lines(t)
    lint = P.undocumented_labels(
        lines, "unit", "line_no", line.rlike(r"^[A-Za-z%]"), line.rlike(r"^\s*;"), line.rlike(marker), F.regexp_extract(line, r"(;.*)", 1).rlike(marker), X.structural_label(line)
    )
    findings = P.violations(lines, ["unit"], P.line_rules(line))
    return V.unit_health(corpus.inventory(_units(t)).select("unit", "grp", "line_count", "first_line", "version_line"), findings.select("unit"), lint.select("unit"))


@query(f"""WITH {_UNITS}, w AS (SELECT unit, unnest(['EN', 'SUB', 'NONE', '']) AS tag FROM u),
h AS (SELECT unit, regexp_extract(line, '^([^( \\t]*)', 1) AS tag, min(line_no) AS line_no FROM l WHERE NOT regexp_matches(line, '^[ \\t;]') GROUP BY 1, 2),
p AS (SELECT w.unit, w.tag, CASE WHEN w.tag = '' THEN 1 ELSE h.line_no END AS hit FROM w LEFT JOIN h ON h.unit = w.unit AND h.tag = w.tag)
SELECT p.unit, tag, line_no, line_no = hit AS is_hit, rtrim(line, ' ') AS line FROM p JOIN l ON l.unit = p.unit AND line_no BETWEEN hit AND hit + 5""")
def where_tags(t: Tables) -> DataFrame:
    """Where TAG^UNIT is, with the lines from there on, for many references at once; a reference without a tag is the unit's first line."""
    wanted = _units(t).select("unit", F.explode(F.array(*[F.lit(x) for x in ("EN", "SUB", "NONE", "")])).alias("tag"))
    lines = _lines(t)
    return V.snippets(V.located(wanted, lines), lines)


@query("""WITH f AS (SELECT replace(p_brand, '#', '') AS grp, CASE WHEN p_partkey % 10 = 0 THEN '_P' ELSE 'P' END || p_partkey AS unit, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'P' || p_partkey || ' ;' || p_name || chr(10) || ' Q' END AS text, p_partkey AS k, p_size, p_name FROM part)
SELECT 'unit' AS kind, '/corpus/' || grp || '/Routines/' || unit || '.m' AS path, unit AS name, grp, CAST(strlen(text) AS BIGINT) AS byte_size, '' AS number, '' AS chunk, '' AS entity FROM f
UNION ALL SELECT CASE WHEN k % 3 = 2 THEN 'global' ELSE 'file' END, '/corpus/' || grp || '/Globals/' || n, n, grp, CAST(strlen(text) AS BIGINT), CASE WHEN k % 3 < 2 THEN k || '.' || p_size ELSE '' END, CASE WHEN k % 3 = 1 THEN '3' ELSE '' END, CASE WHEN k % 3 = 2 THEN 'G' || k ELSE p_name END
FROM (SELECT *, CASE k % 3 WHEN 0 THEN k || '.' || p_size || '+' || p_name WHEN 1 THEN k || '.' || p_size || '-3+' || p_name ELSE 'G' || k END || '.zwr' AS n FROM f)""")
def corpus_files(t: Tables) -> DataFrame:
    """A corpus written as files and read back: empty units, names with an underscore, and data files by name and size."""
    key, root = F.col("p_partkey"), scratch(t.spark, "corpus")
    text = F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("P"), key.cast("string"), F.lit(" ;"), F.col("p_name"), F.lit("\n Q")))
    number = F.concat(key.cast("string"), F.lit("."), F.col("p_size").cast("string"))
    data = F.when(key % 3 == 0, F.concat(number, F.lit("+"), "p_name")).when(key % 3 == 1, F.concat(number, F.lit("-3+"), "p_name")).otherwise(F.concat(F.lit("G"), key.cast("string")))
    files = t.texts("part", "p_partkey", "p_name", "p_brand", "p_size").select(F.regexp_replace("p_brand", "#", "").alias("grp"), F.concat(F.when(key % 10 == 0, "_P").otherwise("P"), key.cast("string")).alias("unit"), data.alias("data"), text.alias("text"))
    corpus.write_units(files, root)
    corpus.write_units(files.select(F.col("data").alias("unit"), "grp", "text"), root, "Globals", ".zwr")
    plain = re.sub("^file:/+", "/", root)
    units = corpus.read_units(t.spark, root, root=plain, new_root="/corpus").select(F.lit("unit").alias("kind"), "path", F.col("unit").alias("name"), "grp", "byte_size", *[F.lit("").alias(c) for c in ("number", "chunk", "entity")])
    listed = corpus.list_files(t.spark, root).select("kind", X.moved_path(F.col("path"), plain, "/corpus").alias("path"), "name", "grp", "byte_size", "number", "chunk", "entity")
    return units.unionByName(listed)


def _calls(t: Tables) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    value = F.concat_ws("^", F.concat(F.lit("ORW "), F.col("s_name")), F.when(F.col("s_suppkey") % 2 == 0, "EN").otherwise(""), F.concat(F.lit("R"), key), (F.col("s_suppkey") % 5).cast("string"), F.lit("S"), F.lit(""), F.lit(""), F.lit(""), F.lit("1.2"))
    tree = t.supplier.select(F.lit("^XWB(8994").alias("root"), F.array(key, F.lit("0")).alias("subs"), value.alias("value"))
    index = t.supplier.select(F.lit("^XWB(8994").alias("root"), F.array(F.lit("B"), "s_name", key).alias("subs"), F.lit("").alias("value"))
    return nodes.registry(tree.unionByName(index), "^XWB(8994", nodes.CALLS_8994)


@query("""SELECT s_suppkey AS ien, 'ORW ' || s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'EN' ELSE '' END AS tag, 'R' || s_suppkey AS routine, CAST(s_suppkey % 5 AS VARCHAR) AS return_type, 'S' AS availability, '' AS inactive, '1.2' AS version FROM supplier""")
def registry_calls(t: Tables) -> DataFrame:
    return _calls(t)


def _protocols(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    root = F.lit("^ORD(101").alias("root")
    blanks = F.lit("^^^^^^^")
    main = t.part.select(root, F.array(key, F.lit("0")).alias("subs"), F.concat(F.lit("PR "), key, F.lit("^"), F.col("p_name"), F.lit("^^"), F.col("p_type"), blanks, F.lit("^"), F.regexp_extract("p_brand", "([0-9]+)", 1)).alias("value"))
    entry = t.part.select(root, F.array(key, F.lit("20")).alias("subs"), F.concat(F.lit('D EN^P'), key, F.lit('\tS Y="D ^NO"\r\n')).alias("value"))
    leave = t.part.where("p_partkey % 3 = 0").select(root, F.array(key, F.lit("15")).alias("subs"), F.concat(F.lit("D EX^P"), key).alias("value"))
    return nodes.registry(main.unionByName(entry).unionByName(leave), "^ORD(101", nodes.PROTOCOLS_101)


@query("""SELECT p_partkey AS ien, 'PR ' || p_partkey AS name, p_name AS item_text, p_type AS type, regexp_extract(p_brand, '([0-9]+)', 1) AS package_id, 'D EN^P' || p_partkey || ' S Y="D ^NO"' AS entry_action, CASE WHEN p_partkey % 3 = 0 THEN 'D EX^P' || p_partkey ELSE '' END AS exit_action FROM part""")
def registry_protocols(t: Tables) -> DataFrame:
    return _protocols(t)


@query("""SELECT n_name AS grp, 'call' AS surface, 'ORW ' || s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'EN^' ELSE '' END || 'R' || s_suppkey AS entry, CAST(s_suppkey % 5 AS VARCHAR) AS detail FROM supplier JOIN nation ON n_nationkey = s_nationkey
UNION ALL SELECT n_name, 'option', 'O' || o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'EN^' ELSE '' END || 'R' || o_custkey, o_orderstatus FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'NATION_' || regexp_extract(p_brand, '([0-9]+)', 1), 'protocol', 'PR ' || p_partkey, 'EN^P' || p_partkey, p_type FROM part""")
def entry_point_matrix(t: Tables) -> DataFrame:
    """Calls, options and protocols of every group with their entries; a protocol's is the first reference of its action."""
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("grp"))
    owner = t.supplier.join(nation, "s_nationkey").select(F.col("s_suppkey").alias("ien"), "grp")
    calls = _calls(t).join(owner, "ien").select("grp", "name", "tag", F.col("routine").alias("unit"), F.col("return_type").alias("detail"))
    options = registry_options(t).select(F.col("package").alias("grp"), "name", "tag", F.col("routine").alias("unit"), F.col("type").alias("detail"))
    first = F.get(X.all_references(X.without_literals(F.col("entry_action"))), F.lit(0))
    protocols = _protocols(t).withColumn("r", first).select(F.concat(F.lit("NATION_"), "package_id").alias("grp"), "name", F.col("r.tag").alias("tag"), F.col("r.unit").alias("unit"), F.col("type").alias("detail"))
    return V.entry_points({"call": calls, "option": options, "protocol": protocols})


@query("""WITH f AS (SELECT CAST(l_orderkey AS VARCHAR) AS record, '.' || l_linenumber AS field, l_linenumber AS no, CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey * 8 AS VARCHAR) ELSE '' END AS target FROM lineitem),
t AS (SELECT CAST(o_orderkey AS VARCHAR) AS record, 'T' || o_orderkey AS name FROM orders),
a AS (SELECT CAST(o_orderkey AS VARCHAR) AS record, 1 AS rank, 'name' AS item, 'T' || o_orderkey AS name FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 2, 'root', '^T(' || o_orderkey || ',' FROM orders WHERE o_orderkey % 3 > 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 3, 'piks', CASE WHEN o_orderkey % 4 = 0 THEN 'P' ELSE 'K' END FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 4, 'method', 'H-06' FROM orders WHERE o_orderkey % 2 = 0),
c AS (SELECT record, target, count(*) AS n FROM f WHERE target <> '' GROUP BY 1, 2),
p AS (SELECT record, 'out' AS section, target AS item, n FROM c UNION ALL SELECT target, 'in', record, n FROM c),
r AS (SELECT p.*, coalesce(t.name, '(unknown)') AS name, row_number() OVER (PARTITION BY p.record, section ORDER BY n DESC, CAST(item AS DOUBLE), item) AS k FROM p LEFT JOIN t ON t.record = p.item WHERE p.record IN (SELECT record FROM t)),
g AS (SELECT record, field, target, row_number() OVER (PARTITION BY record ORDER BY CAST(field AS DOUBLE), target) AS k, no FROM f WHERE record IN (SELECT record FROM t))
SELECT record, 'attribute' AS section, CAST(rank AS INTEGER) AS rank, item, name, CAST(NULL AS BIGINT) AS n FROM a UNION ALL SELECT record, section, k, item, name, n FROM r WHERE k <= 15
UNION ALL SELECT record, 'field', k, field, 'F' || no || '  ' || CASE WHEN target <> '' THEN 'POINTER -> #' || target ELSE 'FREE-TEXT' END, NULL FROM g WHERE k <= 10""")
def record_cards(t: Tables) -> DataFrame:
    """Orders as record types whose even lines point to the type with eight times their part's number, which may be missing."""
    key, n = F.col("o_orderkey"), F.col("l_linenumber")
    types = t.orders.select(key.cast("string").alias("record"), F.concat(F.lit("T"), key.cast("string")).alias("name"), F.when(key % 3 > 0, F.concat(F.lit("^T("), key.cast("string"), F.lit(","))).otherwise("").alias("root"))
    labels = t.orders.where("o_orderkey % 2 = 0").select(key.cast("string").alias("record"), F.when(key % 4 == 0, "P").otherwise("K").alias("piks"), F.lit("H-06").alias("method"))
    target = F.when(n % 2 == 0, (F.col("l_partkey") * 8).cast("string")).otherwise("")
    fields = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("record"), F.concat(F.lit("."), n.cast("string")).alias("field"), F.concat(F.lit("F"), n.cast("string")).alias("name"), F.when(n % 2 == 0, "POINTER").otherwise("FREE-TEXT").alias("data_type"), target.alias("target")
    )
    return V.record_cards(types, fields, labels, ["name", "root"])


_FEATURES = """x AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey > 0 THEN o_orderkey // 3 END AS parent,
  CASE WHEN o_orderkey % 97 = 5 THEN '^DPT(' WHEN o_orderkey % 89 = 5 THEN '^DD(' WHEN o_orderkey % 13 = 0 THEN '^LR(' WHEN o_orderkey % 17 = 0 THEN '^SC(' WHEN o_orderkey % 19 = 0 THEN '^PSDRUG(' WHEN o_orderkey % 23 = 0 THEN '^XTV(' ELSE '^ZZ(' END AS root,
  CASE WHEN o_orderkey % 29 = 0 THEN 'DG' WHEN o_orderkey % 31 = 0 THEN 'PRC' WHEN o_orderkey % 37 = 0 THEN 'LEX' WHEN o_orderkey % 41 = 0 THEN 'XU' END AS prefix,
  CASE o_orderkey % 11 WHEN 0 THEN 'Visit type' WHEN 1 THEN 'Error log' WHEN 2 THEN 'Ward' WHEN 3 THEN 'Patient' ELSE 'Nothing' END AS name,
  coalesce(to_2, 0) AS to_2, coalesce(to_4, 0) AS to_4, coalesce(to_200, 0) AS to_200, coalesce(ptr_out, 0) AS ptr_out, last_2, coalesce(ptr_in, 0) AS ptr_in
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) FILTER (l_suppkey = 2) AS to_2, count(*) FILTER (l_suppkey = 4) AS to_4, count(*) FILTER (l_suppkey = 20) AS to_200, count(*) FILTER (l_suppkey % 2 = 0) AS ptr_out, max(l_linenumber) FILTER (l_suppkey = 2) AS last_2 FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
  LEFT JOIN (SELECT l_partkey, count(*) AS ptr_in FROM lineitem GROUP BY 1) ON l_partkey = o_orderkey),
r AS (SELECT id, parent, CASE WHEN root = '^DPT(' THEN 'P|H-01|certain|global=^DPT(' WHEN root = '^DD(' THEN 'S|H-02|certain|global=^DD(' WHEN id < 2 THEN 'S|H-02|certain|file#=' || id WHEN id = 2 THEN 'P|H-03|certain|file=2 PATIENT'
  WHEN id = 4 THEN 'I|H-04|certain|file=4 INSTITUTION' WHEN id = 200 THEN 'I|H-04b|certain|file=200 NEW PERSON (staff/provider PII, RF-008)' WHEN to_2 > 0 THEN 'P|H-06|high|field=.' || last_2 || ' F' || last_2 || ' points to file 2'
  WHEN to_4 > 0 THEN 'I|H-08|high|has ptr to file 4; no ptr to file 2' WHEN to_200 > 0 THEN 'I|H-09|low|has ptr to file 200 (staff/provider); no ptr to file 2 or 4'
  WHEN root = '^LR(' THEN 'P|H-10|high|global=^LR( in P-list' WHEN root = '^SC(' THEN 'I|H-11|high|global=^SC( in I-list' WHEN root = '^PSDRUG(' THEN 'K|H-12|high|global=^PSDRUG( in K-list' WHEN root = '^XTV(' THEN 'S|H-13|high|global=^XTV( in S-list'
  WHEN prefix = 'DG' THEN 'P|H-14|moderate|package=OWNER DG (DG)' WHEN prefix = 'PRC' THEN 'I|H-15|moderate|package=OWNER PRC (PRC)' WHEN prefix = 'LEX' THEN 'K|H-16|moderate|package=OWNER LEX (LEX)' WHEN prefix = 'XU' THEN 'S|H-17|moderate|package=OWNER XU (XU)'
  WHEN ptr_in >= 10 AND ptr_out <= 2 THEN 'K|H-18|moderate|ptr_in=' || ptr_in || ' ptr_out=' || ptr_out WHEN name = 'Visit type' THEN 'K|H-20|low|name contains K-pattern' WHEN name = 'Error log' THEN 'S|H-21|low|name contains S-pattern'
  WHEN name = 'Ward' THEN 'I|H-22|low|name contains I-pattern' WHEN name = 'Patient' THEN 'P|H-23|low|name contains P-pattern' END AS r FROM x)"""


_INHERITED = """w(id, parent, label, method, confidence, evidence) AS (SELECT id, parent, nullif(split_part(r, '|', 1), ''), nullif(split_part(r, '|', 2), ''), nullif(split_part(r, '|', 3), ''), nullif(split_part(r, '|', 4), '') FROM r WHERE parent IS NULL
  UNION ALL SELECT r.id, r.parent, CASE WHEN weak THEN w.label ELSE nullif(split_part(r, '|', 1), '') END, CASE WHEN weak THEN 'H-05' ELSE nullif(split_part(r, '|', 2), '') END, CASE WHEN weak THEN 'certain' ELSE nullif(split_part(r, '|', 3), '') END,
    CASE WHEN weak THEN 'inherits from ' || r.parent ELSE nullif(split_part(r, '|', 4), '') END
  FROM (SELECT *, coalesce(split_part(r, '|', 3), '') NOT IN ('certain', 'high') AS open FROM r) r JOIN w ON w.id = r.parent, LATERAL (SELECT open AND w.label IS NOT NULL AS weak))"""


@query(f"""WITH RECURSIVE {_FEATURES}, {_INHERITED} SELECT id, label, method, confidence, evidence FROM w""")
def record_type_labels(t: Tables) -> DataFrame:
    """The coded rules in order over derived features, and then inheritance from the types above."""
    return R.inherited(R.labelled(_features(t), R.record_type_rules()).select("id", "parent", "label", "method", "confidence", "evidence")).drop("parent")


_ROUND = """SELECT id, CASE WHEN kinds >= 3 THEN 'P|H-38|targets span ' || kinds || ' PIKS categories' WHEN CAST(p AS DOUBLE) / n > 0.7 THEN 'P|H-36|' || p || '/' || n || ' targets classified P' WHEN k = n THEN 'K|H-40|' || k || ' targets all classified K' END AS r
  FROM (SELECT e.id, count(*) AS n, count(DISTINCT h.label) AS kinds, count(*) FILTER (h.label = 'P') AS p, count(*) FILTER (h.label = 'K') AS k FROM e JOIN {known} h ON h.id = e.target WHERE e.id IN (SELECT id FROM free) AND e.id NOT IN (SELECT id FROM {known}) GROUP BY e.id) WHERE n >= 2"""


def passes_sql(edges: str, linked: str, rounds: int = 6) -> str:
    """The last CTEs of all passes, after w: ``edges`` gives (id, target), ``linked`` ids that are no orphans; z has the labels."""
    parts = [
        f"e AS MATERIALIZED ({edges})",
        "free AS MATERIALIZED (SELECT id FROM w WHERE label IS NULL AND parent IS NULL)",
        f"alone AS MATERIALIZED (SELECT id FROM free WHERE id NOT IN ({linked}))",
        "k0 AS MATERIALIZED (SELECT id, label FROM w WHERE label IS NOT NULL)",
    ]
    for k in range(1, rounds + 1):
        parts.append(f"r{k} AS MATERIALIZED ({_ROUND.format(known=f'k{k - 1}')})")
        orphans = "UNION ALL SELECT id, 'S' FROM alone" if k == 1 else ""
        parts.append(f"k{k} AS MATERIALIZED (SELECT * FROM k{k - 1} {orphans} UNION ALL SELECT id, split_part(r, '|', 1) FROM r{k} WHERE r IS NOT NULL)")
    found = " UNION ALL ".join(f"SELECT * FROM r{k}" for k in range(1, rounds + 1))
    parts.append(f"""m AS MATERIALIZED (SELECT id, label, method, confidence, evidence FROM w WHERE label IS NOT NULL UNION ALL SELECT id, 'S', 'H-39', 'moderate', 'orphan: 0 ptrs in, 0 ptrs out' FROM alone
  UNION ALL SELECT id, split_part(r, '|', 1), split_part(r, '|', 2), 'moderate', split_part(r, '|', 3) FROM ({found}) WHERE r IS NOT NULL)""")
    parts.append("""z(id, parent, label, method, confidence, evidence) AS (SELECT w.id, w.parent, m.label, m.method, m.confidence, m.evidence FROM w LEFT JOIN m ON m.id = w.id WHERE parent IS NULL
  UNION ALL SELECT w.id, w.parent, coalesce(m.label, z.label), CASE WHEN m.label IS NOT NULL THEN m.method WHEN z.label IS NOT NULL THEN 'H-05' END, CASE WHEN m.label IS NOT NULL THEN m.confidence WHEN z.label IS NOT NULL THEN 'certain' END,
    CASE WHEN m.label IS NOT NULL THEN m.evidence WHEN z.label IS NOT NULL THEN 'inherits(prop) from ' || w.parent END FROM z JOIN w ON w.parent = z.id LEFT JOIN m ON m.id = w.id)""")
    return ",\n".join(parts)


_POINTERS = "SELECT l_orderkey AS id, l_partkey * 5 AS target FROM lineitem"


@query(f"""WITH RECURSIVE {_FEATURES}, {_INHERITED}, {passes_sql(_POINTERS, "SELECT id FROM e UNION ALL SELECT target FROM e")} SELECT id, label, method, confidence, evidence FROM z""")
def record_type_passes(t: Tables) -> DataFrame:
    """All passes over all pointers: rules, inheritance, six rounds of propagation, and inheritance again."""
    pointers = t.lineitem.select(F.col("l_orderkey").alias("id"), (F.col("l_partkey") * 5).alias("target"))
    return R.classified(_features(t), pointers).drop("parent")


def _features(t: Tables) -> DataFrame:
    """Orders as record types with what the coded rules read."""
    key, s = F.col("o_orderkey"), F.col("l_suppkey")

    def chosen(pairs: list[tuple[Column, str]], other: str | None) -> Column:
        out = F.when(*pairs[0])
        for p in pairs[1:]:
            out = out.when(*p)
        return out.otherwise(other)

    last = F.max(F.when(s == 2, F.col("l_linenumber"))).cast("string")
    out = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(
        *[F.count_if(s == k).alias(c) for c, k in (("to_2", 2), ("to_4", 4), ("to_200", 20))], F.count_if(s % 2 == 0).alias("ptr_out"), F.concat(F.lit("."), last, F.lit(" F"), last).alias("last_to_2")
    )
    into = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(F.count("*").alias("ptr_in"))
    roots = chosen([(key % 97 == 5, "^DPT("), (key % 89 == 5, "^DD("), (key % 13 == 0, "^LR("), (key % 17 == 0, "^SC("), (key % 19 == 0, "^PSDRUG("), (key % 23 == 0, "^XTV(")], "^ZZ(")
    prefix = chosen([(key % 29 == 0, "DG"), (key % 31 == 0, "PRC"), (key % 37 == 0, "LEX"), (key % 41 == 0, "XU")], None)
    name = chosen([(key % 11 == 0, "Visit type"), (key % 11 == 1, "Error log"), (key % 11 == 2, "Ward"), (key % 11 == 3, "Patient")], "Nothing")
    base = t.orders.select(
        key.alias("id"), key.cast("string").alias("number"), F.when((key % 5 == 0) & (key > 0), F.floor(key / 3)).alias("parent"), roots.alias("root"), prefix.alias("prefix"), F.concat(F.lit("OWNER "), prefix).alias("owner"), name.alias("name")
    )
    return J.star(base, "id", [out, into], zero=["to_2", "to_4", "to_200", "ptr_out", "ptr_in"])


@query("""WITH n AS (SELECT DISTINCT p_name AS name FROM part), m AS (SELECT upper(s_name) AS m, CASE WHEN s_suppkey % 10 < 5 THEN 'low' ELSE 'g' || s_suppkey % 10 END AS g FROM supplier),
q AS (SELECT DISTINCT CASE p_partkey % 6 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN split_part(p_name, ' ', 1) WHEN 3 THEN substr(p_name, 4) WHEN 4 THEN 'Supplier#0000000' || p_partkey % 10 ELSE 'nothing ' || p_partkey END AS query FROM part),
h AS (SELECT query, name, CASE WHEN query = name THEN 1 WHEN upper(query) = upper(name) THEN 2 ELSE 3 END AS tier FROM q JOIN n ON contains(upper(name), upper(query)) WHERE query <> ''),
c AS (SELECT query, max(name) FILTER (tier = 1) AS e, count(*) FILTER (tier <= 2) AS ne, max(name) FILTER (tier = 2) AS eq, count(*) AS nh FROM h GROUP BY 1),
o AS (SELECT query, g, count(*) AS k FROM q JOIN m ON starts_with(m, upper(query)) WHERE query NOT IN (SELECT query FROM c) AND query <> '' GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY k DESC, g) AS r, sum(k) OVER (PARTITION BY query) AS a FROM o)
SELECT query, 1 AS tier, e AS name, CAST(1 AS BIGINT) AS n FROM c WHERE e IS NOT NULL UNION ALL SELECT query, 2, eq, 1 FROM c WHERE e IS NULL AND ne = 1
UNION ALL SELECT h.query, 3, h.name, nh FROM h JOIN c ON c.query = h.query WHERE e IS NULL AND ne <> 1 UNION ALL SELECT query, 4, g, 1 FROM b WHERE r = 1 AND k / a >= 0.4""")
def name_resolution(t: Tables) -> DataFrame:
    """Many names at once: exact, equal but for case, contained, ambiguous, and by the owner of a prefix."""
    key, name, s = F.col("p_partkey"), F.col("p_name"), F.col("s_suppkey")
    asked = (
        F.when(key % 6 == 0, name).when(key % 6 == 1, F.upper(name)).when(key % 6 == 2, F.split_part(name, F.lit(" "), F.lit(1))).when(key % 6 == 3, F.substring(name, 4, 99))
        .when(key % 6 == 4, F.concat(F.lit("Supplier#0000000"), (key % 10).cast("string"))).otherwise(F.concat(F.lit("nothing "), key.cast("string")))
    )
    members = t.supplier.select(F.upper("s_name").alias("m"), F.when(s % 10 < 5, "low").otherwise(F.concat(F.lit("g"), (s % 10).cast("string"))).alias("g"))
    return J.resolved(t.part.select(asked.alias("q")), "q", t.part, "p_name", members, "m", "g")


@query(f"""WITH {_UNITS} SELECT unit, line_no, line FROM l WHERE line <> '' AND NOT regexp_matches(line, '^[ \\t;]') AND regexp_matches(line, '(?i)start|sub')""")
def label_search(t: Tables) -> DataFrame:
    """A search over label lines alone."""
    return _lines(t).where(X.is_label_line(F.col("line")) & F.col("line").rlike("(?i)start|sub"))


@query("""SELECT p_partkey, split_part(p_name, ' ', 1) AS unit, CASE WHEN contains(p_name, ' ') THEN substr(p_name, instr(p_name, ' ') + 1) ELSE '' END AS tag, upper(split_part(p_name, ' ', 1)) AS store FROM part""")
def reference_parts(t: Tables) -> DataFrame:
    """``UNIT TAG`` references parted, and the store's name of a root."""
    root = F.concat(F.lit("^"), F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))), F.lit("("), F.col("p_partkey").cast("string"), F.lit(","))
    return t.part.select("p_partkey", X.spaced_reference(F.col("p_name")).alias("r"), X.store_name(root).alias("store")).select("p_partkey", "r.unit", "r.tag", "store")


@query("""SELECT p_type, id, CAST(row_number() OVER (PARTITION BY p_type ORDER BY CAST(id AS DECIMAL(18, 4)), id) AS INTEGER) AS rank FROM (SELECT p_type, p_partkey || '.' || p_size AS id FROM part)""")
def numeric_order(t: Tables) -> DataFrame:
    """Decimal ids as text in numeric order within their groups."""
    rows = t.part.select("p_type", F.concat(F.col("p_partkey").cast("string"), F.lit("."), F.col("p_size").cast("string")).alias("id"))
    return P.ranked(rows, "p_type", [F.col("id").cast("decimal(18,4)"), F.col("id")])

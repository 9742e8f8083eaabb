"""Edges, group rollups, measures, labels and walks, on the trade tables and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators import edges as E
from corvane.operators import graph as G
from corvane.operators import incremental as I
from corvane.operators import joins as J
from corvane.operators import profile as P
from corvane.operators import rules as R
from corvane.operators.constraints import Check, violation_counts, violations
from corvane.plans.base import Tables, query

_SUPPLY = "SELECT l_suppkey AS source, o_custkey AS target, l_quantity AS quantity, l_partkey AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_MATRIX = f"""SELECT s.s_nationkey AS sg, c.c_nationkey AS dg, count(*) AS n, count(DISTINCT e.source) AS ds, count(DISTINCT e.target) AS dt
  FROM ({_SUPPLY}) e JOIN supplier s ON s.s_suppkey = e.source JOIN customer c ON c.c_custkey = e.target GROUP BY 1, 2"""


def _matrix(t: Tables) -> DataFrame:
    return E.group_matrix(t.supply().select("source", "target"), t.supplier_groups(), target_groups=t.customer_groups())


@query(f"""WITH m AS ({_MATRIX})
SELECT a.n_name AS source_nation, b.n_name AS dest_nation, CAST(n AS BIGINT) AS edge_count, ds AS distinct_suppliers, dt AS distinct_customers
FROM m JOIN nation a ON a.n_nationkey = sg JOIN nation b ON b.n_nationkey = dg ORDER BY edge_count DESC, 1, 2""")
def edge_matrix(t: Tables) -> DataFrame:
    a = t.nation.select(F.col("n_nationkey").alias("source_group"), F.col("n_name").alias("source_nation"))
    b = t.nation.select(F.col("n_nationkey").alias("dest_group"), F.col("n_name").alias("dest_nation"))
    named = _matrix(t).join(a, "source_group").join(b, "dest_group")
    return named.select(
        "source_nation", "dest_nation", "edge_count", F.col("distinct_sources").alias("distinct_suppliers"), F.col("distinct_targets").alias("distinct_customers")
    ).orderBy(F.desc("edge_count"), "source_nation", "dest_nation")


@query(f"""WITH m AS ({_MATRIX})
SELECT CAST(coalesce(sum(n) FILTER (sg = dg), 0) AS BIGINT) AS intra, CAST(coalesce(sum(n) FILTER (sg <> dg), 0) AS BIGINT) AS inter,
       CAST(sum(n) FILTER (sg <> dg) AS DOUBLE) / sum(n) AS inter_share, count(*) AS pairs, count(DISTINCT sg) AS source_groups, count(DISTINCT dg) AS dest_groups FROM m""")
def coupling_summary(t: Tables) -> DataFrame:
    return E.coupling(_matrix(t))


@query(f"""WITH e AS ({_SUPPLY}),
o AS (SELECT l_suppkey AS k, count(DISTINCT l_partkey) AS out_degree, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS out_total FROM lineitem GROUP BY 1),
i AS (SELECT source AS k, count(DISTINCT target) AS in_degree, count(*) AS in_total FROM e GROUP BY 1)
SELECT s_suppkey AS unit, s_nationkey AS grp, CAST(coalesce(out_degree, 0) AS BIGINT) AS out_degree, CAST(coalesce(out_total, 0) AS BIGINT) AS out_total,
       CAST(coalesce(in_degree, 0) AS BIGINT) AS in_degree, CAST(coalesce(in_total, 0) AS BIGINT) AS in_total
FROM supplier LEFT JOIN o ON o.k = s_suppkey LEFT JOIN i ON i.k = s_suppkey""")
def unit_measures(t: Tables) -> DataFrame:
    return _measures(t)


def _measures(t: Tables) -> DataFrame:
    out = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("w"))
    out = out.groupBy(F.col("l_suppkey").alias("unit")).agg(F.count("*").alias("out_degree"), F.sum("w").alias("out_total"))
    into = t.supply().groupBy("source", "target").agg(F.count("*").alias("w")).groupBy(F.col("source").alias("unit")).agg(F.count("*").alias("in_degree"), F.sum("w").alias("in_total"))
    base = t.supplier.select(F.col("s_suppkey").alias("unit"), F.col("s_nationkey").alias("grp"))
    return J.star(base, "unit", [out, into], zero=["out_degree", "out_total", "in_degree", "in_total"])


@query("""WITH e AS (SELECT CAST(c_nationkey AS BIGINT) AS s, CAST(s_nationkey AS BIGINT) + 1000 AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey),
p AS (SELECT s, t, count(*) AS w FROM e GROUP BY 1, 2),
o AS (SELECT s AS node, count(*) AS d, sum(w) AS v FROM p GROUP BY 1), i AS (SELECT t AS node, count(*) AS d, sum(w) AS v FROM p GROUP BY 1)
SELECT coalesce(o.node, i.node) AS node, CAST(coalesce(o.d, 0) AS BIGINT) AS out_degree, CAST(coalesce(o.v, 0) AS BIGINT) AS out_total, CAST(coalesce(i.d, 0) AS BIGINT) AS in_degree, CAST(coalesce(i.v, 0) AS BIGINT) AS in_total
FROM o FULL JOIN i ON o.node = i.node""")
def node_degrees(t: Tables) -> DataFrame:
    c = t.customer_groups().select(F.col("node").alias("target"), F.col("grp").cast("long").alias("s"))
    s = t.supplier_groups().select(F.col("node").alias("source"), (F.col("grp").cast("long") + 1000).alias("t"))
    return E.degrees(t.supply().select("source", "target").join(c, "target").join(s, "source"), "s", "t")


@query(f"""WITH e AS ({_SUPPLY}), x AS (SELECT s_nationkey AS g, c_nationkey AS h, part FROM e JOIN supplier ON s_suppkey = source JOIN customer ON c_custkey = target)
SELECT n_name AS nation, CAST(coalesce(c.n, 0) AS BIGINT) AS customers, CAST(coalesce(s.n, 0) AS BIGINT) AS suppliers, CAST(coalesce(o.n, 0) AS BIGINT) AS orders,
       CAST(coalesce(x.p, 0) AS BIGINT) AS distinct_parts, CAST(coalesce(x.n, 0) AS BIGINT) AS edges, CAST(coalesce(x.c, 0) AS BIGINT) AS cross_edges
FROM nation LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) c ON c.k = n_nationkey
LEFT JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) s ON s.k = n_nationkey
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1) o ON o.k = n_nationkey
LEFT JOIN (SELECT g AS k, count(DISTINCT part) AS p, count(*) AS n, count(*) FILTER (g <> h) AS c FROM x GROUP BY 1) x ON x.k = n_nationkey
WHERE c.n IS NOT NULL OR s.n IS NOT NULL""")
def group_manifest(t: Tables) -> DataFrame:
    customers = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("orders"))
    ends = t.supply().join(t.supplier_groups().toDF("source", "k"), "source").join(t.customer_groups().toDF("target", "h"), "target")
    edges = ends.groupBy("k").agg(F.count_distinct("part").alias("distinct_parts"), F.count("*").alias("edges"), F.count_if(F.col("k") != F.col("h")).alias("cross_edges"))
    seeded = J.seeded_union(customers, suppliers, "k")
    out = J.star(seeded, "k", [orders, edges], zero=["orders", "distinct_parts", "edges", "cross_edges"])
    return out.join(t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("nation")), "k").drop("k")


@query("""SELECT source, count(*) AS unit_count, count(*) FILTER (starts_with(lang, 'e')) AS e_count, CAST(sum(n_chars) AS BIGINT) AS total_chars,
  CAST(sum(strlen(text)) AS BIGINT) AS total_bytes FROM documents GROUP BY source""")
def group_rollup(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(
        F.count("*").alias("unit_count"), F.count_if(F.col("lang").startswith("e")).alias("e_count"), F.sum("n_chars").alias("total_chars"), F.sum(F.octet_length("text")).cast("long").alias("total_bytes")
    )


@query("""SELECT source, count(DISTINCT d.doc_id) FILTER (quality = 0) AS n_0, count(DISTINCT d.doc_id) FILTER (quality = 1) AS n_1,
  count(DISTINCT d.doc_id) FILTER (quality IS NULL) AS unclassified, count(DISTINCT d.doc_id) AS total
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY source""")
def label_pivot(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")
    return P.label_pivot(rows, "source", "doc_id", F.col("quality"), ["0", "1"])


_AUTO = "SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS label, 'H-size' AS method, 0 AS seq FROM documents"


def _automatic(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("label"), F.lit("H-size").alias("method"), F.lit(0).alias("seq"))


def _manual(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", F.col("quality").alias("label"), F.lit("manual").alias("method"), F.lit(1).alias("seq"))


@query(f"""WITH a AS ({_AUTO})
SELECT a.doc_id, coalesce(l.quality, a.label) AS label, CASE WHEN l.doc_id IS NULL THEN 'H-size' ELSE 'manual' END AS method FROM a LEFT JOIN labels l ON l.doc_id = a.doc_id""")
def override_labels(t: Tables) -> DataFrame:
    return J.override([_automatic(t), _manual(t)], "doc_id", "seq").select("doc_id", "label", "method")


@query("""WITH u AS (SELECT doc_id, quality AS label, 'first' AS method, 1 AS seq FROM labels UNION ALL SELECT doc_id, toxic, 'second', 2 FROM labels WHERE toxic = 1)
SELECT doc_id, arg_max(label, seq) AS label, arg_max(method, seq) AS method FROM u GROUP BY doc_id""")
def label_priority_dupes(t: Tables) -> DataFrame:
    first = t.labels.select("doc_id", F.col("quality").alias("label"), F.lit("first").alias("method"), F.lit(1).alias("seq"))
    second = t.labels.where("toxic = 1").select("doc_id", F.col("toxic").alias("label"), F.lit("second").alias("method"), F.lit(2).alias("seq"))
    return J.override([first.unionByName(second)], "doc_id", "seq").select("doc_id", "label", "method")


@query("""WITH f AS (SELECT c_custkey, c_mktsegment AS segment, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%') AS has_urgent, c_acctbal < 0 AS in_debt FROM customer)
SELECT segment, has_orders, has_urgent, in_debt, count(*) AS n FROM f GROUP BY ALL""")
def cohort_counts(t: Tables) -> DataFrame:
    flags = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.lit(True).alias("has_orders"), F.bool_or(F.col("o_orderpriority").startswith("1")).alias("has_urgent"))
    rows = t.customer.join(flags, "c_custkey", "left").select(
        F.col("c_mktsegment").alias("segment"), F.coalesce("has_orders", F.lit(False)).alias("has_orders"), F.coalesce("has_urgent", F.lit(False)).alias("has_urgent"), (F.col("c_acctbal") < 0).alias("in_debt")
    )
    return rows.groupBy("segment", "has_orders", "has_urgent", "in_debt").agg(F.count("*").alias("n"))


@query("""SELECT in_documents, in_labels, count(*) AS n FROM (
  SELECT d.doc_id IS NOT NULL AS in_documents, l.doc_id IS NOT NULL AS in_labels FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id) GROUP BY 1, 2""")
def population_cohorts(t: Tables) -> DataFrame:
    a = t.documents.select("doc_id").distinct().withColumn("a", F.lit(True))
    b = t.labels.select("doc_id").distinct().withColumn("b", F.lit(True))
    both = a.join(b, "doc_id", "full").select(F.col("a").isNotNull().alias("in_documents"), F.col("b").isNotNull().alias("in_labels"))
    return both.groupBy("in_documents", "in_labels").agg(F.count("*").alias("n"))


@query("""SELECT 'left only' AS side, CAST(doc_id AS VARCHAR) AS key FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT 'right only', CAST(doc_id AS VARCHAR) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT DISTINCT 'right only', 'p' || l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25) UNION ALL SELECT 'left only', 'p' || p_partkey FROM part WHERE p_size <= 25 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem)""")
def population_diff(t: Tables) -> DataFrame:
    """Documents without labels, and ordered parts that aren't small."""
    docs = J.anti_both(t.documents.select(F.col("doc_id").cast("string").alias("key")), t.labels.select(F.col("doc_id").cast("string").alias("key")), "key")
    part = lambda c: F.concat(F.lit("p"), F.col(c).cast("string")).alias("key")
    return docs.unionByName(J.anti_both(t.part.where("p_size <= 25").select(part("p_partkey")), t.lineitem.select(part("l_partkey")), "key"))


@query("""WITH l AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS i FROM lineitem WHERE l_returnflag = 'R'), r AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS i FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT coalesce(l.k, r.k) AS supplier, l.i IS NOT NULL AS x, r.i IS NOT NULL AS y FROM l FULL JOIN r ON l.k = r.k AND l.i = r.i)
SELECT supplier, count(*) FILTER (x) AS n_left, count(*) FILTER (y) AS n_right, count(*) FILTER (x AND y) AS n_match, count(*) FILTER (NOT y) AS left_only, count(*) FILTER (NOT x) AS right_only,
  CAST(count(*) FILTER (x AND y) AS DOUBLE) / count(*) AS ratio FROM b GROUP BY 1""")
def set_agreement(t: Tables) -> DataFrame:
    return _agreement(t)


def _agreement(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("part"), "l_returnflag")
    return J.agreement(rows.where("l_returnflag = 'R'"), rows.where("l_returnflag = 'A'"), "supplier", "part")


@query("""WITH l AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS i FROM lineitem WHERE l_returnflag = 'R'), r AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS i FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT coalesce(l.k, r.k) AS k, l.i IS NOT NULL AS x, r.i IS NOT NULL AS y FROM l FULL JOIN r ON l.k = r.k AND l.i = r.i),
s AS (SELECT k, count(*) FILTER (x) AS a, count(*) FILTER (y) AS b, count(*) FILTER (x AND y) AS m, CAST(count(*) FILTER (x AND y) AS DOUBLE) / count(*) AS q FROM b GROUP BY 1)
SELECT count(*) AS keys, count(*) FILTER (a = b) AS equal_counts, CAST(sum(m) AS BIGINT) AS matches, round(avg(q), 9) AS mean_ratio FROM s""")
def agreement_summary(t: Tables) -> DataFrame:
    return _agreement(t).agg(
        F.count("*").alias("keys"), F.count_if(F.col("n_left") == F.col("n_right")).alias("equal_counts"), F.sum("n_match").alias("matches"), F.round(F.avg("ratio"), 9).alias("mean_ratio")
    )


@query("""WITH p AS (SELECT split_part(p_name, ' ', 1) AS prefix, min(p_partkey) AS owner FROM part GROUP BY 1),
h AS (SELECT p_partkey, p_name, prefix, owner, row_number() OVER (PARTITION BY p_partkey ORDER BY len(prefix) DESC) AS r FROM part JOIN p ON starts_with(p_name, prefix) AND prefix <> '')
SELECT part.p_partkey, part.p_name, prefix, owner FROM part LEFT JOIN h ON h.p_partkey = part.p_partkey AND r = 1""")
def longest_prefix(t: Tables) -> DataFrame:
    words = t.part.select(F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("prefix"), F.col("p_partkey").alias("owner"))
    return J.longest_prefix(t.part.select("p_partkey", "p_name"), "p_name", words, "prefix", "owner")


@query(f"""WITH e AS ({_SUPPLY}), d AS (SELECT s_nationkey, s_suppkey, count(DISTINCT target) AS customers FROM e JOIN supplier ON s_suppkey = source GROUP BY 1, 2)
SELECT n_name AS nation, s_suppkey AS supplier, customers, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY customers DESC, s_suppkey) AS r FROM d) JOIN nation ON n_nationkey = s_nationkey WHERE r <= 10""")
def top_hubs(t: Tables) -> DataFrame:
    per = t.supply().select("source", "target").distinct().groupBy("source").agg(F.count("*").alias("customers"))
    rows = per.join(t.supplier.select(F.col("s_suppkey").alias("source"), F.col("s_nationkey").alias("n_nationkey")), "source").join(t.nation.select("n_nationkey", F.col("n_name").alias("nation")), "n_nationkey")
    return E.top_k(rows, ["nation"], [F.desc("customers"), F.col("source")], 10).select("nation", F.col("source").alias("supplier"), "customers", "rank")


@query(f"""WITH c AS (SELECT source, target, part AS p, count(*) AS n FROM ({_SUPPLY}) GROUP BY 1, 2, 3)
SELECT source AS supplier, target AS customer, CAST(sum(n) AS BIGINT) AS total, string_agg(p || ':' || n, ',' ORDER BY n DESC, p) AS parts FROM c GROUP BY 1, 2""")
def callers(t: Tables) -> DataFrame:
    """Who buys from each supplier, with the references by part; one supplier is a filter on this."""
    return E.callers_of(t.supply().toDF("supplier", "customer", "quantity", "part"), ["supplier"], "customer", "part", F.lit(1))


@query(f"""WITH u AS (SELECT part, source AS u, count(*) AS n FROM ({_SUPPLY}) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY n DESC, u) AS k FROM u)
SELECT part, count(*) AS users, CAST(sum(n) AS BIGINT) AS total, string_agg(u, ',' ORDER BY k) FILTER (k <= 8) AS top_users FROM r GROUP BY part""")
def consumers(t: Tables) -> DataFrame:
    return E.consumers(t.supply().withColumnRenamed("source", "supplier"), "part", "supplier", F.lit(1), 8)


@query(f"""WITH e AS ({_SUPPLY}), c AS (SELECT * FROM customer WHERE c_acctbal >= 0), s AS (
  SELECT source AS supplier, 'customers' AS section, coalesce(c_name, '(unknown)') || ' ' || target AS item, count(*) AS n FROM e LEFT JOIN c ON c_custkey = target GROUP BY 1, 3 UNION ALL
  SELECT source, 'parts', CAST(part AS VARCHAR), count(*) FROM e GROUP BY 1, 3 UNION ALL
  SELECT source, 'stores', p_brand, count(*) FROM e JOIN part ON p_partkey = part GROUP BY 1, 3 UNION ALL
  SELECT l_suppkey, 'findings', 'R ' || l_partkey, count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45 GROUP BY 1, 3 UNION ALL
  SELECT source, 'nations', n_name, count(*) FROM e JOIN customer ON c_custkey = target JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 3)
SELECT supplier, section, item, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY supplier, section ORDER BY n DESC, item) AS r FROM s) WHERE r <= 5""")
def entity_card(t: Tables) -> DataFrame:
    """Callers by name (customers in debt have none), parts, stores touched, findings and nations of every supplier."""
    e = t.supply().withColumnRenamed("source", "supplier")
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("target"), F.col("n_name").alias("item"))
    callers_ = J.named(e.groupBy("supplier", "target").agg(F.count("*").alias("n")), "target", t.customer.where("c_acctbal >= 0"), "c_custkey", "c_name")
    brands = t.part.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("item"))
    findings = t.lineitem.where("l_returnflag = 'R' and l_quantity >= 45").groupBy(F.col("l_suppkey").alias("supplier"), F.concat(F.lit("R "), F.col("l_partkey").cast("string")).alias("item"))
    sections = {
        "customers": callers_.select("supplier", F.concat_ws(" ", "name", F.col("target").cast("string")).alias("item"), "n"),
        "parts": e.groupBy("supplier", F.col("part").alias("item")).agg(F.count("*").alias("n")),
        "stores": e.join(brands, "part").groupBy("supplier", "item").agg(F.count("*").alias("n")),
        "findings": findings.agg(F.count("*").alias("n")),
        "nations": e.join(nations, "target").groupBy("supplier", "item").agg(F.count("*").alias("n")),
    }
    return J.cards(sections, "supplier", 5)


_PART_RULES = """CASE WHEN p_size >= 45 THEN 'P|R-1|certain|size=' || p_size WHEN p_type LIKE '%BRASS%' THEN 'K|R-2|high|type=' || p_type
  WHEN p_retailprice >= 1800 THEN 'S|R-3|moderate|dear' WHEN coalesce(n, 0) >= 4 THEN 'I|R-4|low|suppliers=' || n END"""


def _part_rules() -> list[R.Rule]:
    return [
        R.Rule("R-1", F.col("p_size") >= 45, "P", "certain", F.concat(F.lit("size="), F.col("p_size").cast("string"))),
        R.Rule("R-2", F.col("p_type").contains("BRASS"), "K", "high", F.concat(F.lit("type="), F.col("p_type"))),
        R.Rule("R-3", F.col("p_retailprice") >= 1800, "S", "moderate", F.lit("dear")),
        R.Rule("R-4", F.coalesce("n", F.lit(0)) >= 4, "I", "low", F.concat(F.lit("suppliers="), F.col("n").cast("string"))),
    ]


def _part_labels(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count_distinct("l_suppkey").alias("n"))
    return R.labelled(t.part.join(n, "p_partkey", "left"), _part_rules())


@query(f"""WITH x AS (SELECT p_partkey, {_PART_RULES} AS r FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey)
SELECT p_partkey, nullif(split_part(r, '|', 1), '') AS label, nullif(split_part(r, '|', 2), '') AS method, nullif(split_part(r, '|', 3), '') AS confidence, nullif(split_part(r, '|', 4), '') AS evidence FROM x""")
def rule_cascade(t: Tables) -> DataFrame:
    return _part_labels(t).select("p_partkey", "label", "method", "confidence", "evidence")


@query(f"""WITH x AS (SELECT p_partkey, {_PART_RULES} AS r FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey)
SELECT coalesce(nullif(split_part(r, '|', 1), ''), '(empty)') AS k0, coalesce(nullif(split_part(r, '|', 3), ''), '(empty)') AS k1, coalesce(nullif(split_part(r, '|', 2), ''), '(empty)') AS k2,
  count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM part) AS share FROM x GROUP BY 1, 2, 3""")
def rule_statistics(t: Tables) -> DataFrame:
    return P.histogram(_part_labels(t), [F.col("label"), F.col("confidence"), F.col("method")])


def _tree(t: Tables) -> DataFrame:
    parent = F.floor((F.col("doc_id") - 1) / 2).cast("long")
    return t.documents.select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") > 0, parent).alias("parent"))


@query("""WITH RECURSIVE t AS (SELECT doc_id AS id, CASE WHEN doc_id > 0 THEN (doc_id - 1) // 2 END AS parent FROM documents),
w(id, node, depth) AS (SELECT id, id, 0 FROM t UNION ALL SELECT w.id, t.parent, depth + 1 FROM w JOIN t ON t.id = w.node WHERE t.parent IS NOT NULL AND w.node NOT IN (SELECT doc_id FROM labels WHERE quality IS NOT NULL))
SELECT w.id, CAST(l.quality AS VARCHAR) AS label, node AS from_id, depth FROM w JOIN labels l ON l.doc_id = w.node WHERE l.quality IS NOT NULL""")
def inherit_labels(t: Tables) -> DataFrame:
    """Each document's own label, else its nearest labelled ancestor's, in the heap order of the ids."""
    labels = t.labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("label"))
    return G.nearest_labelled(_tree(t), labels)


@query("""WITH RECURSIVE t AS (SELECT doc_id AS id, CASE WHEN doc_id > 0 THEN (doc_id - 1) // 2 END AS parent FROM documents),
w(id, node) AS (SELECT id, id FROM t UNION ALL SELECT w.id, t.parent FROM w JOIN t ON t.id = w.node WHERE t.parent IS NOT NULL)
SELECT id, min(node) AS top FROM w GROUP BY id""")
def top_ancestors(t: Tables) -> DataFrame:
    return G.top_ancestor(_tree(t))


_PROP_ROUND = """SELECT id, {k} AS round, CASE WHEN kinds >= 3 THEN 'P|H-38|targets span ' || kinds || ' PIKS categories' WHEN CAST(p AS DOUBLE) / n > 0.7 THEN 'P|H-36|' || p || '/' || n || ' targets classified P'
  WHEN k = n THEN 'K|H-40|' || k || ' targets all classified K' END AS r
  FROM (SELECT e.id, count(*) AS n, count(DISTINCT label) AS kinds, count(*) FILTER (label = 'P') AS p, count(*) FILTER (label = 'K') AS k
    FROM e JOIN ({known}) h ON h.id = e.target WHERE e.id NOT IN (SELECT id FROM ({known})) GROUP BY e.id) WHERE n >= 2"""


@query(f"""WITH e AS (SELECT DISTINCT l_suppkey + 1000000 AS id, l_partkey AS target FROM lineitem UNION ALL SELECT DISTINCT 2000000 + o_custkey, l_suppkey + 1000000 FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 45),
nodes AS (SELECT s_suppkey + 1000000 AS id FROM supplier UNION ALL SELECT c_custkey + 2000000 FROM customer UNION ALL SELECT p_partkey FROM part),
seed AS (SELECT p_partkey AS id, CASE WHEN p_size <= 36 THEN 'P' WHEN p_size <= 45 THEN 'K' ELSE 'S' END AS label FROM part WHERE p_size % 3 > 0),
alone AS (SELECT id FROM nodes WHERE id NOT IN (SELECT id FROM seed) AND id NOT IN (SELECT id FROM e) AND id NOT IN (SELECT target FROM e)),
k0 AS (SELECT id, label FROM seed),
r1 AS ({_PROP_ROUND.format(k=1, known="SELECT id, label FROM k0")}),
k1 AS (SELECT id, label FROM k0 UNION ALL SELECT id, 'S' FROM alone UNION ALL SELECT id, split_part(r, '|', 1) FROM r1 WHERE r IS NOT NULL),
r2 AS ({_PROP_ROUND.format(k=2, known="SELECT id, label FROM k1")}),
k2 AS (SELECT id, label FROM k1 UNION ALL SELECT id, split_part(r, '|', 1) FROM r2 WHERE r IS NOT NULL),
r3 AS ({_PROP_ROUND.format(k=3, known="SELECT id, label FROM k2")})
SELECT id, label, 'seed' AS method, NULL AS confidence, NULL AS evidence, 0 AS round FROM seed UNION ALL SELECT id, 'S', 'H-39', 'moderate', 'orphan: 0 ptrs in, 0 ptrs out', 1 FROM alone
UNION ALL SELECT id, split_part(r, '|', 1), split_part(r, '|', 2), 'moderate', split_part(r, '|', 3), round FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3) WHERE r IS NOT NULL""")
def propagate_labels(t: Tables) -> DataFrame:
    """Customers, suppliers and parts as record types; pointers are large purchases and deliveries."""
    s, c = F.col("source") + 1_000_000, F.col("target") + 2_000_000
    edges = t.supply().select(s.alias("id"), F.col("part").alias("target")).distinct().unionByName(t.supply().where("quantity > 45").select(c.alias("id"), s.alias("target")).distinct())
    nodes = t.supplier.select((F.col("s_suppkey") + 1_000_000).alias("id")).unionByName(t.customer.select((F.col("c_custkey") + 2_000_000).alias("id"))).unionByName(t.part.select(F.col("p_partkey").alias("id")))
    label = F.when(F.col("p_size") <= 36, "P").when(F.col("p_size") <= 45, "K").otherwise("S")
    seeds = t.part.where("p_size % 3 > 0").select(F.col("p_partkey").alias("id"), label.alias("label"))
    return G.propagate(nodes, edges, seeds, "P", "K", rounds=3)


@query("""WITH f AS (SELECT l_orderkey AS record, CAST(l_linenumber AS VARCHAR) AS field, CASE l_linenumber WHEN 1 THEN 'NAME' WHEN 2 THEN 'DOB' WHEN 3 THEN 'HOME PHONE' ELSE 'LINE ' || l_linenumber END AS name,
  'P' || l_partkey || '''' AS spec, l_partkey AS target FROM lineitem),
o AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 'P' WHEN o_orderpriority LIKE '2%' THEN 'I' WHEN o_orderpriority LIKE '3%' THEN 'K' END AS own FROM orders),
p AS (SELECT p_partkey, CASE WHEN p_size <= 20 THEN 'P' WHEN p_size <= 40 THEN 'K' END AS ref FROM part)
SELECT record, field, name, 'POINTER' AS data_type, own, ref AS ref_label, CASE WHEN own <> ref THEN 'Y' ELSE '' END AS "cross",
  CASE WHEN own <> 'P' AND name IN ('DOB', 'HOME PHONE') THEN 'Y' ELSE '' END AS sensitivity FROM f LEFT JOIN o ON o_orderkey = record LEFT JOIN p ON p_partkey = target""")
def field_labels(t: Tables) -> DataFrame:
    """Lines as fields of orders, pointing to parts."""
    n = F.col("l_linenumber")
    name = F.when(n == 1, "NAME").when(n == 2, "DOB").when(n == 3, "HOME PHONE").otherwise(F.concat(F.lit("LINE "), n.cast("string")))
    fields = t.lineitem.select(
        F.col("l_orderkey").alias("record"), n.cast("string").alias("field"), name.alias("name"), F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("'")).alias("spec"), (F.col("l_partkey") + (1 << 40)).alias("target")
    )
    o = F.substring("o_orderpriority", 1, 1)
    orders = t.orders.select(F.col("o_orderkey").alias("record"), F.when(o == "1", "P").when(o == "2", "I").when(o == "3", "K").alias("label"))
    parts = t.part.select((F.col("p_partkey") + (1 << 40)).alias("record"), F.when(F.col("p_size") <= 20, "P").when(F.col("p_size") <= 40, "K").alias("label"))
    return R.field_labels(fields, orders.unionByName(parts)).select("record", "field", "name", "data_type", "own", "ref_label", "cross", "sensitivity")


@query("""SELECT o_orderpriority AS own, c_mktsegment AS ref, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE substr(o_orderpriority, 3, 1) <> substr(c_mktsegment, 1, 1) GROUP BY 1, 2""")
def cross_label_matrix(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).where(F.substring("o_orderpriority", 3, 1) != F.substring("c_mktsegment", 1, 1))
    return rows.groupBy(F.col("o_orderpriority").alias("own"), F.col("c_mktsegment").alias("ref")).agg(F.count("*").alias("n"))


@query("""WITH x AS (SELECT c_custkey, coalesce(n, 0) AS records, CASE WHEN c_acctbal < 0 THEN 'P' WHEN c_acctbal < 3000 THEN 'I' WHEN c_acctbal < 6000 THEN 'K' ELSE 'S' END AS label, c_mktsegment
  FROM customer LEFT JOIN (SELECT o_custkey, count(*) * 9000 AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)
SELECT c_custkey, CASE WHEN records < 1000 THEN 'reference' WHEN records <= 100000 THEN 'moderate' ELSE 'high-volume' END AS volume,
  CASE label WHEN 'P' THEN 'protected' WHEN 'K' THEN 'public' ELSE 'operational' END AS sensitivity,
  CASE WHEN records = 0 OR c_mktsegment = 'BUILDING' THEN 'static' WHEN label = 'P' AND records > 100000 THEN 'dynamic' WHEN label = 'S' AND c_mktsegment = 'MACHINERY' THEN 'ephemeral' ELSE 'slow' END AS volatility,
  CASE WHEN label = 'K' THEN 'universal' ELSE 'site-specific' END AS portability FROM x""")
def property_inference(t: Tables) -> DataFrame:
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.count("*") * 9000).alias("n"))
    b = F.col("c_acctbal")
    label = F.when(b < 0, "P").when(b < 3000, "I").when(b < 6000, "K").otherwise("S")
    made = R.properties(F.coalesce("n", F.lit(0)), label, F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment") == "MACHINERY")
    return t.customer.join(n, "c_custkey", "left").select("c_custkey", *[c.alias(k) for k, c in made.items()])


@query("""WITH e AS (SELECT DISTINCT o_custkey AS source, l_partkey + 1000000 AS target FROM lineitem JOIN orders ON l_orderkey = o_orderkey UNION SELECT DISTINCT l_partkey + 1000000, l_suppkey + 9000000 FROM lineitem),
d0 AS (SELECT c_custkey AS start, c_custkey AS node FROM customer), d1 AS (SELECT DISTINCT start, target AS node FROM d0 JOIN e ON source = node), d2 AS (SELECT DISTINCT start, target AS node FROM d1 JOIN e ON source = node)
SELECT start, node, min(depth) AS depth FROM (SELECT *, 0 AS depth FROM d0 UNION ALL SELECT *, 1 FROM d1 UNION ALL SELECT *, 2 FROM d2) GROUP BY 1, 2""")
def reachability(t: Tables) -> DataFrame:
    """What each customer reaches: the parts it buys, and the suppliers of those."""
    buys = t.supply().select(F.col("target").alias("s"), (F.col("part") + 1_000_000).alias("d"))
    made = t.lineitem.select((F.col("l_partkey") + 1_000_000).alias("s"), (F.col("l_suppkey") + 9_000_000).alias("d"))
    return G.reachable(buys.unionByName(made).toDF("source", "target"), t.customer.select(F.col("c_custkey").alias("node")), 2)


@query("""WITH us AS (SELECT l_suppkey AS supplier, l_partkey AS store, count(*) AS ref_count FROM lineitem GROUP BY 1, 2),
x AS (SELECT supplier, coalesce(CASE WHEN p_size <= 20 THEN 'P' WHEN p_size <= 40 THEN 'K' END, 'none') AS label, p_type AS record, sum(ref_count) AS r FROM us JOIN part ON p_partkey = store GROUP BY ALL)
SELECT supplier, label, count(*) AS records, CAST(sum(r) AS BIGINT) AS refs FROM (SELECT supplier, coalesce(tl, 'none') AS label, x.record, sum(r) AS r FROM (SELECT supplier, record, sum(r) AS r FROM x GROUP BY 1, 2) x
  LEFT JOIN (SELECT p_type, CASE WHEN avg(p_size) <= 25 THEN 'P' WHEN avg(p_size) <= 27 THEN 'K' END AS tl FROM part GROUP BY 1) ON p_type = record GROUP BY ALL) GROUP BY 1, 2""")
def bridge(t: Tables) -> DataFrame:
    """Supplier to part to type to label: the label mix of what a supplier touches."""
    refs = t.lineitem.groupBy(F.col("l_suppkey").alias("supplier"), F.col("l_partkey").alias("store")).agg(F.count("*").alias("ref_count"))
    types = t.part.select(F.col("p_partkey").alias("store"), F.col("p_type").alias("record"))
    mean = F.avg("p_size")
    labels = t.part.groupBy(F.col("p_type").alias("record")).agg(F.when(mean <= 25, "P").when(mean <= 27, "K").alias("label"))
    return J.bridge(refs, types, labels, "supplier", "store", "record", "label")


@query("""WITH r AS (SELECT s_nationkey AS grp, p_brand AS item, l_suppkey AS u, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3),
o AS (SELECT DISTINCT c_nationkey AS grp, p_brand AS item FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey WHERE l_quantity >= 49)
SELECT r.grp, r.item, o.item IS NOT NULL AS owned, count(*) AS users, CAST(sum(n) AS BIGINT) AS refs FROM r LEFT JOIN o ON o.grp = r.grp AND o.item = r.item GROUP BY ALL""")
def ownership_matrix(t: Tables) -> DataFrame:
    brand = t.part.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("item"))
    used = t.supply().join(brand, "part").join(t.supplier_groups().toDF("source", "grp"), "source").groupBy("grp", "item", F.col("source").alias("user")).agg(F.count("*").alias("ref_count"))
    owned = t.supply().where("quantity >= 49").join(brand, "part").join(t.customer_groups().toDF("target", "grp"), "target")
    return J.ownership(used, owned, "grp", "item")


@query("""WITH i AS (SELECT DISTINCT l_partkey AS part, l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45), r AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY s) AS k FROM i),
h AS (SELECT part, count(*) AS n, avg(CASE WHEN s IN (SELECT s_suppkey FROM supplier WHERE s_nationkey <= 12) THEN 1.0 ELSE 0.0 END) AS share FROM r WHERE k <= 5 GROUP BY 1)
SELECT p_partkey AS part, CAST(coalesce(n, 0) AS BIGINT) AS sampled, CAST(share AS DOUBLE) AS share, CASE WHEN n IS NULL THEN 'N/A' WHEN share > 0.6 THEN 'YES' ELSE 'NO' END AS verdict FROM part LEFT JOIN h ON h.part = p_partkey""")
def key_sample(t: Tables) -> DataFrame:
    """Parts and the suppliers of large returned lines; a part without such lines has no sample."""
    lines = t.lineitem.where("l_returnflag = 'R' and l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    rows = t.part.join(lines, "p_partkey", "left").select(F.col("p_partkey").alias("part"), F.col("l_suppkey").alias("supplier"))
    return P.sample_share(rows, "part", "supplier", t.supplier.where("s_nationkey <= 12").select("s_suppkey"), 5, 0.6)


@query("""WITH p AS (SELECT l_partkey AS part, count(*) AS n FROM lineitem GROUP BY 1) SELECT part, n FROM p ORDER BY n DESC, part LIMIT 20""")
def top_parts(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_partkey").alias("part")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "part").limit(20)


@query("""SELECT * FROM (SELECT 'lines' AS measure, CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS a, CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)) AS DOUBLE) AS b
UNION ALL SELECT 'orders with lines', CAST((SELECT count(DISTINCT l_orderkey) FROM lineitem) AS DOUBLE), CAST((SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS DOUBLE)
UNION ALL SELECT 'parts', CAST((SELECT count(*) FROM part) AS DOUBLE), CAST((SELECT count(DISTINCT l_partkey) FROM lineitem) AS DOUBLE)
UNION ALL SELECT 'dangling parts', CAST((SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)) AS DOUBLE), 0.0), (SELECT 1) AS one(x0)""".replace(", (SELECT 1) AS one(x0)", "").replace("SELECT * FROM (", "SELECT *, abs(a - b) <= 1e-6 * greatest(1.0, abs(a)) AS ok FROM ("))
def reconcile(t: Tables) -> DataFrame:
    n = F.count("*").alias("n")
    lines = t.lineitem
    dangling = lines.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left_anti")
    return P.reconciled(
        {
            "lines": (lines.agg(n), lines.groupBy("l_suppkey").agg(n).agg(F.sum("n"))),
            "orders with lines": (lines.agg(F.count_distinct("l_orderkey")), t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").agg(n)),
            "parts": (t.part.agg(n), lines.agg(F.count_distinct("l_partkey"))),
            "dangling parts": (dangling.agg(n), t.spark.range(1).select(F.lit(0))),
        }
    )


_OLD = "SELECT doc_id, quality AS label, CASE WHEN toxic = 1 THEN 'manual' ELSE 'H-old' END AS method FROM labels"


@query(f"""WITH o AS ({_OLD}), n AS (SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 1 WHEN n_chars >= 200 THEN 0 END AS label, 'H-new' AS method FROM documents WHERE source <> 'src0'),
j AS (SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.doc_id IS NOT NULL AS io, n.doc_id IS NOT NULL AS i_n, o.label AS ol, o.method AS om, n.label AS nl, n.method AS nm FROM o FULL JOIN n ON o.doc_id = n.doc_id),
a AS (SELECT *, ol IS NULL OR coalesce(om LIKE 'H-%', true) AS auto FROM j)
SELECT doc_id, CASE WHEN auto AND nl IS NOT NULL THEN nl ELSE ol END AS label, CASE WHEN auto AND nl IS NOT NULL THEN nm ELSE om END AS method,
  CASE WHEN NOT i_n THEN 'retired' WHEN NOT io THEN 'added' WHEN NOT auto THEN 'kept manual' WHEN ol IS NOT DISTINCT FROM nl AND om IS NOT DISTINCT FROM nm THEN 'same' WHEN ol IS NOT DISTINCT FROM nl THEN 'other rule'
       WHEN ol IS NULL THEN 'newly labelled' WHEN nl IS NULL THEN 'kept' ELSE 'relabelled' END AS scenario FROM a""")
def incremental_merge(t: Tables) -> DataFrame:
    return _merged(t)


def _merged(t: Tables) -> DataFrame:
    old = t.labels.select("doc_id", F.col("quality").alias("label"), F.when(F.col("toxic") == 1, "manual").otherwise("H-old").alias("method"))
    n = F.col("n_chars")
    new = t.documents.where("source <> 'src0'").select("doc_id", F.when(n >= 1000, 1).when(n >= 200, 0).alias("label"), F.lit("H-new").alias("method"))
    return I.merged(old, new, "doc_id")


@query(f"""WITH o AS ({_OLD}), n AS (SELECT doc_id, CASE WHEN n_chars >= 1000 THEN 1 WHEN n_chars >= 200 THEN 0 END AS label FROM documents WHERE source <> 'src0'),
j AS (SELECT coalesce(o.doc_id, n.doc_id) AS k, o.doc_id IS NOT NULL AS io, n.doc_id IS NOT NULL AS i_n, o.label AS ol, o.method AS om, n.label AS nl FROM o FULL JOIN n ON o.doc_id = n.doc_id),
a AS (SELECT *, ol IS NULL OR coalesce(om LIKE 'H-%', true) AS auto FROM j),
s AS (SELECT CASE WHEN auto AND nl IS NOT NULL THEN nl ELSE ol END AS label, CASE WHEN NOT i_n THEN 'retired' WHEN NOT io THEN 'new' WHEN NOT auto THEN 'old' WHEN ol IS NOT DISTINCT FROM nl THEN 'new' WHEN ol IS NULL THEN 'new' WHEN nl IS NULL THEN 'old' ELSE 'new' END AS c FROM a)
SELECT 'refresh' AS mode, count(*) AS total, count(*) FILTER (c = 'new') AS "new", count(*) FILTER (c = 'old') AS unchanged, count(*) FILTER (label IS NULL) AS unresolved FROM s""")
def run_log(t: Tables) -> DataFrame:
    return I.run_log(_merged(t), "refresh")


@query("""WITH a AS (SELECT doc_id, quality AS x FROM labels), b AS (SELECT doc_id, CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS y FROM documents WHERE lang <> 'es')
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, x AS a_label, y AS b_label, CASE WHEN a.doc_id IS NULL THEN 'only b' WHEN b.doc_id IS NULL THEN 'only a' WHEN x IS DISTINCT FROM y THEN 'label differs' ELSE 'rule differs' END AS scenario FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def system_comparison(t: Tables) -> DataFrame:
    a = t.labels.select("doc_id", F.col("quality").alias("label"), F.lit("manual").alias("method"))
    b = t.documents.where("lang <> 'es'").select("doc_id", F.when(F.col("n_chars") >= 500, 1).otherwise(0).alias("label"), F.lit("H-size").alias("method"))
    return I.compared(a, b, "doc_id")


@query(f"""WITH o AS (SELECT l_suppkey AS k, count(DISTINCT l_partkey) AS d FROM lineitem GROUP BY 1), i AS (SELECT source AS k, count(DISTINCT target) AS d FROM ({_SUPPLY}) GROUP BY 1)
SELECT s_suppkey AS unit, CASE WHEN coalesce(i.d, 0) >= 400 AND coalesce(o.d, 0) >= 500 THEN 'hub' WHEN coalesce(i.d, 0) >= 400 THEN 'framework' WHEN coalesce(o.d, 0) >= 500 THEN 'orchestrator' ELSE 'leaf' END AS quadrant
FROM supplier LEFT JOIN o ON o.k = s_suppkey LEFT JOIN i ON i.k = s_suppkey""")
def quadrant(t: Tables) -> DataFrame:
    return _measures(t).select("unit", R.quadrant(F.col("in_degree"), F.col("out_degree"), 400, 500).alias("quadrant"))


@query(f"""WITH e AS ({_SUPPLY}) SELECT source AS node, count(*) AS total, count(*) FILTER (s_nationkey <> c_nationkey) AS external, CAST(count(*) FILTER (s_nationkey <> c_nationkey) AS DOUBLE) / count(*) AS share
FROM e JOIN supplier ON s_suppkey = source JOIN customer ON c_custkey = target GROUP BY 1""")
def external_share(t: Tables) -> DataFrame:
    s = t.supplier_groups()
    c = t.customer_groups().select((F.col("node") + (1 << 40)).alias("node"), "grp")
    edges = t.supply().select("source", (F.col("target") + (1 << 40)).alias("target"))
    return E.external_share(edges, s.unionByName(c), "source", "target")


@query("""WITH b AS (SELECT DISTINCT p_brand AS k, p_type AS b FROM part), d AS (SELECT DISTINCT p_brand AS k, p_type AS b FROM part WHERE p_size >= 20),
x AS (SELECT b.k, d.b IS NULL AS u FROM b LEFT JOIN d ON d.k = b.k AND d.b = b.b)
SELECT k AS brand, count(*) AS branches, count(*) FILTER (u) AS undeclared, CASE WHEN count(*) FILTER (u) = 0 THEN 'full' WHEN count(*) FILTER (u) = count(*) THEN 'none' ELSE 'partial' END AS coverage FROM x GROUP BY 1""")
def coverage_classes(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), "p_size")
    return R.coverage_class(rows, rows.where("p_size >= 20"), "brand", "type")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS source, l_partkey * 5 AS target FROM lineitem WHERE l_quantity > 44),
own AS (SELECT DISTINCT l_orderkey AS node, CASE p_size % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'I' WHEN 2 THEN 'K' WHEN 3 THEN 'S' END AS label FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_quantity <= 3 AND p_size % 5 < 4),
m(node, label) AS (SELECT node, label FROM own UNION SELECT e.source, m.label FROM m JOIN e ON e.target = m.node),
g AS (SELECT node, string_agg(label, ',' ORDER BY instr('PIKS', label)) AS labels, count(*) AS n FROM m GROUP BY 1)
SELECT CASE o_orderstatus WHEN 'F' THEN 'call' WHEN 'O' THEN 'option' ELSE 'protocol' END AS kind, 'E' || o_orderkey AS entry, o_orderkey AS unit, coalesce(labels, '') AS labels, coalesce(n, 0) AS n_labels
FROM orders LEFT JOIN g ON g.node = o_orderkey""")
def entry_point_labels(t: Tables) -> DataFrame:
    """Orders as units, each the code of an entry point. A line above 44 pieces calls another order, one of up to 3 refers to its part as a store; the part's size is the record type behind it."""
    status, n = F.col("o_orderstatus"), F.col("p_size") % 5
    entries = t.orders.select(F.when(status == "F", "call").when(status == "O", "option").otherwise("protocol").alias("kind"), F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("entry"), F.col("o_orderkey").alias("unit"))
    calls = t.lineitem.where("l_quantity > 44").select(F.col("l_orderkey").alias("source"), (F.col("l_partkey") * 5).alias("target"))
    references = t.lineitem.where("l_quantity <= 3").select(F.col("l_orderkey").alias("unit"), F.col("l_partkey").alias("store"))
    stores = t.part.select(F.col("p_partkey").alias("store"), F.col("p_size").alias("record"))
    labels = t.part.select(F.col("p_size").alias("record"), F.when(n == 0, "P").when(n == 1, "I").when(n == 2, "K").when(n == 3, "S").alias("label")).distinct()
    return G.label_reach(entries, calls, references, stores, labels, ["P", "I", "K", "S"])


_CHECKS = [
    Check("line of an order", "reference", "lineitem", ("l_orderkey",), "orders", ("o_orderkey",)), Check("line of a part", "reference", "lineitem", ("l_partkey",), "part", ("p_partkey",)), Check("line of a supplier", "reference", "lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    Check("order of a customer", "reference", "orders", ("o_custkey",), "customer", ("c_custkey",)), Check("supplier named as a customer", "reference", "customer", ("c_custkey",), "supplier", ("s_suppkey",)), Check("nation of a region", "reference", "nation", ("n_regionkey",), "region", ("r_regionkey",)),
    Check("line number", "unique", "lineitem", ("l_orderkey", "l_linenumber")), Check("part number", "unique", "part", ("p_partkey",)), Check("part name", "unique", "part", ("p_name",)), Check("lines declared", "count", "lineitem", ("l_partkey",), "part", ("p_partkey",), "p_size"),
    Check("document's language", "present", "documents", ("source", "lang", "text")), Check("label of a document", "reference", "labels", ("doc_id",), "documents", ("doc_id",)),
]


def _reference_sql(c: Check) -> str:
    return f"SELECT '{c.name.replace(chr(39), chr(39) * 2)}' AS \"check\", CAST({c.columns[0]} AS VARCHAR) AS key, 0 AS found, 1 AS expected FROM (SELECT DISTINCT {c.columns[0]} FROM {c.table}) WHERE {c.columns[0]} NOT IN (SELECT {c.other_columns[0]} FROM {c.other})"


_CHECKS_SQL = " UNION ALL ".join(
    [
        *[_reference_sql(c) for c in _CHECKS if c.kind == "reference"],
        "SELECT 'line number', l_orderkey || '|' || l_linenumber, count(*), 1 FROM lineitem GROUP BY 2 HAVING count(*) > 1", "SELECT 'part number', CAST(p_partkey AS VARCHAR), count(*), 1 FROM part GROUP BY 2 HAVING count(*) > 1",
        "SELECT 'part name', p_name, count(*), 1 FROM part GROUP BY 2 HAVING count(*) > 1", "SELECT 'lines declared', CAST(p_partkey AS VARCHAR), coalesce(n, 0), p_size FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey WHERE coalesce(n, 0) <> p_size",
        "SELECT 'document''s language', coalesce(source, ''), count(*), 0 FROM documents WHERE lang IS NULL OR text IS NULL GROUP BY 2",
    ]
)


def _violations(t: Tables) -> DataFrame:
    return violations({n: getattr(t, n) for n in ("lineitem", "orders", "part", "supplier", "customer", "nation", "region", "documents", "labels")}, _CHECKS)


@query(_CHECKS_SQL)
def constraint_violations(t: Tables) -> DataFrame:
    """Every key that breaks one of twelve constraints on nine tables."""
    return _violations(t)


@query(f"""WITH v AS ({_CHECKS_SQL}), c AS (SELECT unnest({[c.name for c in _CHECKS]!r}) AS "check", unnest({[c.kind for c in _CHECKS]!r}) AS kind)
SELECT c."check", kind, count(v."check") AS violations FROM c LEFT JOIN v ON v."check" = c."check" GROUP BY 1, 2""".replace('"document\'s language"', "'document''s language'"))
def constraint_counts(t: Tables) -> DataFrame:
    return violation_counts(_violations(t), _CHECKS)


@query("""WITH e AS (SELECT o_custkey AS source, coalesce(o2, 0) AS target, count(*) AS refs FROM (SELECT o.o_custkey, p.o_custkey AS o2 FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey JOIN orders p ON p.o_orderkey = l_partkey * 5) GROUP BY 1, 2),
b AS (SELECT e.*, x.c_nationkey AS f, y.c_nationkey AS g FROM e JOIN customer x ON x.c_custkey = source JOIN customer y ON y.c_custkey = target),
d AS (SELECT target AS node, count(*) AS n FROM b WHERE f = g AND source <> target GROUP BY 1),
k AS (SELECT c_custkey AS node FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY coalesce(n, 0) DESC, c_custkey) AS r FROM customer LEFT JOIN d ON node = c_custkey) WHERE r <= 12)
SELECT f AS grp, 'inside' AS kind, CAST(source AS VARCHAR) AS source, CAST(target AS VARCHAR) AS target, CAST(refs AS BIGINT) AS refs FROM b WHERE f = g AND source IN (SELECT node FROM k) AND target IN (SELECT node FROM k)
UNION ALL SELECT f, 'out', CAST(source AS VARCHAR), 'group:' || g, CAST(sum(refs) AS BIGINT) FROM b WHERE f <> g AND source IN (SELECT node FROM k) GROUP BY 1, 3, 4
UNION ALL SELECT g, 'in', 'group:' || f, CAST(target AS VARCHAR), CAST(sum(refs) AS BIGINT) FROM b WHERE f <> g AND target IN (SELECT node FROM k) GROUP BY 1, 3, 4""")
def bounded_group_graphs(t: Tables) -> DataFrame:
    """Customers call the customers of the orders that their lines' parts name; a graph of twelve nodes for each nation."""
    owner = t.orders.select("o_orderkey", "o_custkey")
    calls = t.lineitem.select("l_orderkey", (F.col("l_partkey") * 5).alias("called")).join(owner.toDF("l_orderkey", "source"), "l_orderkey").join(owner.toDF("called", "target"), "called")
    return E.bounded_group_graph(calls.select("source", "target"), t.customer_groups(), 12)


def _in_place_sql(waves: int) -> str:
    """One round in place: wave by wave, a node's level being the longest line of open nodes with falling numbers below it."""
    parts = [
        "e AS MATERIALIZED (SELECT l_orderkey AS id, l_partkey * 5 AS target FROM lineitem WHERE l_quantity > 44)",
        "seed AS MATERIALIZED (SELECT o_orderkey AS id, substr('PPKI', 1 + CAST(o_custkey % 4 AS INTEGER), 1) AS label FROM orders WHERE o_orderkey % 3 > 0)",
        "free AS MATERIALIZED (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0)", "alone AS MATERIALIZED (SELECT id FROM free WHERE id NOT IN (SELECT id FROM e UNION ALL SELECT target FROM e))",
        "deps AS MATERIALIZED (SELECT DISTINCT e.id, target FROM e WHERE target < e.id AND e.id IN (SELECT id FROM free) AND target IN (SELECT id FROM free))",
        "lv(id, l) AS (SELECT id, 0 FROM free UNION SELECT deps.id, l + 1 FROM lv JOIN deps ON deps.target = lv.id)", "level AS MATERIALIZED (SELECT id, max(l) AS l FROM lv GROUP BY 1)",
        "k0 AS MATERIALIZED (SELECT id, label, 0 AS round FROM seed UNION ALL SELECT id, 'S', 1 FROM alone)",
    ]
    for w in range(waves):
        parts.append(f"""r{w} AS MATERIALIZED (SELECT id, CASE WHEN kinds >= 3 THEN 'P|H-38|targets span ' || kinds || ' PIKS categories' WHEN CAST(p AS DOUBLE) / n > 0.7 THEN 'P|H-36|' || p || '/' || n || ' targets classified P' WHEN k = n THEN 'K|H-40|' || k || ' targets all classified K' END AS r
  FROM (SELECT e.id, count(*) AS n, count(DISTINCT h.label) AS kinds, count(*) FILTER (h.label = 'P') AS p, count(*) FILTER (h.label = 'K') AS k FROM e JOIN level ON level.id = e.id AND l = {w} JOIN k{w} h ON h.id = e.target AND (h.round = 0 OR h.id < e.id) WHERE e.id NOT IN (SELECT id FROM alone) GROUP BY e.id) WHERE n >= 2)""")
        parts.append(f"k{w + 1} AS MATERIALIZED (SELECT * FROM k{w} UNION ALL SELECT id, split_part(r, '|', 1), 1 FROM r{w} WHERE r IS NOT NULL)")
    found = " UNION ALL ".join(f"SELECT * FROM r{w}" for w in range(waves))
    return f"""WITH RECURSIVE {", ".join(parts)} SELECT id, split_part(r, '|', 1) AS label, split_part(r, '|', 2) AS method, split_part(r, '|', 3) AS evidence FROM ({found}) WHERE r IS NOT NULL
UNION ALL SELECT id, 'S', 'H-39', 'orphan: 0 ptrs in, 0 ptrs out' FROM alone"""


@query(_in_place_sql(16))
def in_place_round(t: Tables) -> DataFrame:
    """One round in place over every third order, which are open; lines above 44 pieces are the pointers, the other orders have labels."""
    pointers = t.lineitem.where("l_quantity > 44").select(F.col("l_orderkey").alias("id"), (F.col("l_partkey") * 5).alias("target"))
    k = F.col("o_custkey") % 4
    seeds = t.orders.where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"), F.when(k < 2, "P").when(k == 2, "K").otherwise("I").alias("label"))
    nodes = t.orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"))
    return G.propagate_in_place(nodes, pointers, seeds, "P", "K", rounds=1).select("id", "label", "method", "evidence")

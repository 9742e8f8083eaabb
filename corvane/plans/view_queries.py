"""Code lines, registries and views derived from the trade tables: extraction, dumps, cards, dashboards and rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.operators import edges as E
from corvane.operators import incremental as I
from corvane.operators import joins as J
from corvane.operators import profile as P
from corvane.operators import rules as R
from corvane.operators import views as V
from corvane.plans.base import Tables, query
from corvane.sources import nodes

_SUPPLY = "SELECT l_suppkey AS source, o_custkey AS target, l_partkey AS part FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _code(t: Tables) -> DataFrame:
    """One line of code per line item: a call, a second argument, a function, two stores, a literal and a comment."""
    s, p = F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")
    line = F.concat(F.lit(" D EN^R"), s, F.lit(",T^Q"), s, F.lit(" S X=$$F^P"), p, F.lit("(1),Y=^DPT(1)+^G"), F.col("l_linenumber").cast("string"), F.lit('(2),Z="D ^NO" ; D ^GONE'))
    return t.texts("lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber").select((F.col("l_orderkey") % 97).alias("unit"), line.alias("line"))


@query("""WITH l AS (SELECT l_orderkey % 97 AS unit, l_suppkey AS s, l_partkey AS p FROM lineitem)
SELECT unit, 'EN' AS tag, 'R' || s AS target, 'do' AS kind, count(*) AS ref_count FROM l GROUP BY unit, s UNION ALL SELECT unit, 'F', 'P' || p, 'func', count(*) FROM l GROUP BY unit, p""")
def call_edges(t: Tables) -> DataFrame:
    return E.text_edges(_code(t), ["unit"])


@query("""WITH l AS (SELECT l_orderkey % 97 AS unit, l_suppkey AS s, l_partkey AS p FROM lineitem)
SELECT unit, 'EN' AS tag, 'R' || s AS target, 'do' AS kind, count(*) AS ref_count FROM l GROUP BY unit, s UNION ALL SELECT unit, 'T', 'Q' || s, 'do', count(*) FROM l GROUP BY unit, s UNION ALL SELECT unit, 'F', 'P' || p, 'func', count(*) FROM l GROUP BY unit, p""")
def call_edges_every_argument(t: Tables) -> DataFrame:
    return E.text_edges(_code(t), ["unit"], every_argument=True)


@query("""WITH l AS (SELECT l_orderkey % 97 AS unit, l_linenumber AS n FROM lineitem)
SELECT unit, 'DPT' AS store, count(*) AS ref_count FROM l GROUP BY unit UNION ALL SELECT unit, 'G' || n, count(*) FROM l GROUP BY unit, n""")
def store_edges(t: Tables) -> DataFrame:
    return E.store_edges(_code(t), ["unit"])


@query("""WITH l AS (SELECT l_orderkey % 97 AS unit, l_suppkey AS s, l_partkey AS p, l_linenumber AS n FROM lineitem)
SELECT DISTINCT unit, 'R' || s AS token, CASE WHEN s % 2 = 0 THEN 'tag call' ELSE 'unknown' END AS kind FROM l UNION SELECT unit, 'Q' || s, 'unknown' FROM l UNION SELECT unit, 'P' || p, CASE WHEN p % 2 = 0 THEN 'tag call' ELSE 'unknown' END FROM l
UNION SELECT unit, 'DPT', 'store' FROM l UNION SELECT unit, 'G' || n, 'unknown' FROM l""")
def token_resolution(t: Tables) -> DataFrame:
    units = t.supplier.where("s_suppkey % 2 = 0").select(F.concat(F.lit("R"), F.col("s_suppkey").cast("string")).alias("unit"))
    units = units.unionByName(t.part.where("p_partkey % 2 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("unit")))
    stores = t.nation.limit(1).select(F.lit("DPT").alias("store"))
    clean = _code(t).select("unit", X.without_literals(F.col("line")).alias("line"))
    return J.resolved_tokens(clean, ["unit"], "line", units, stores)


@query("""SELECT p_partkey, p_type AS grp, CAST(2 + (p_size % 2) AS INTEGER) AS patches, CAST(p_size AS VARCHAR) AS version FROM part""")
def version_headers(t: Tables) -> DataFrame:
    """A second line made of each part, parsed back into version, group and patches."""
    size = F.col("p_size").cast("string")
    line = F.concat(F.lit(" ;;"), size, F.lit(";"), F.col("p_type"), F.lit(";**14, ,79"), F.when(F.col("p_size") % 2 == 1, ",153").otherwise(""), F.lit("**;Mar 20, 1995;Build 7"))
    made = t.part.select("p_partkey", X.version_line(F.array(F.lit("A ;x"), line)).alias("v"))
    return made.select("p_partkey", X.header_field(F.col("v"), 2).alias("grp"), F.size(X.patches(F.col("v"))).alias("patches"), X.header_field(F.col("v"), 1).alias("version"))


def _customer_nodes(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    main = t.customer.select(
        F.lit("^DIC(9.8").alias("root"), F.array(key, F.lit("0")).alias("subs"), F.concat_ws("^", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string"), F.lit(""), F.concat(F.lit("r"), key)).alias("value")
    )
    more = t.customer.where("c_custkey % 3 = 0").select(F.lit("^DIC(9.8").alias("root"), F.array(key, F.lit("4")).alias("subs"), F.concat(F.lit("x^c"), key).alias("value"))
    index = t.customer.select(F.lit("^DIC(9.8").alias("root"), F.array(F.lit("B"), F.col("c_name"), key).alias("subs"), F.lit("").alias("value"))
    return main.unionByName(more).unionByName(index)


@query("""SELECT c_custkey AS ien, c_name AS name, c_mktsegment AS type, CAST(c_nationkey AS VARCHAR) AS size_bytes, 'r' || c_custkey AS rsum_value, CASE WHEN c_custkey % 3 = 0 THEN 'c' || c_custkey ELSE '' END AS checksum_value FROM customer""")
def registry_units(t: Tables) -> DataFrame:
    return nodes.registry(_customer_nodes(t), "^DIC(9.8", nodes.UNITS_9_8)


@query("""SELECT o_orderkey AS ien, 'O' || o_orderkey AS name, o_orderstatus AS type, n_name AS package, CASE WHEN o_orderkey % 2 = 0 THEN 'EN' ELSE '' END AS tag, 'R' || o_custkey AS routine FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def registry_options(t: Tables) -> DataFrame:
    """Options with groups resolved by number and entry points split."""
    key = F.col("o_orderkey").cast("string")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    blanks = F.lit("^^^^^^^^")
    main = rows.select(F.lit("^DIC(19").alias("root"), F.array(key, F.lit("0")).alias("subs"), F.concat(F.lit("O"), key, F.lit("^menu^^"), F.col("o_orderstatus"), blanks, F.col("c_nationkey").cast("string")).alias("value"))
    entry = rows.select(F.lit("^DIC(19").alias("root"), F.array(key, F.lit("25")).alias("subs"), F.concat(F.when(F.col("o_orderkey") % 2 == 0, "EN^").otherwise("^"), F.lit("R"), F.col("o_custkey").cast("string")).alias("value"))
    groups = t.nation.select(F.col("n_nationkey").alias("ien"), F.col("n_name").alias("name"))
    return nodes.options(main.unionByName(entry), "^DIC(19", groups).select("ien", "name", "type", "package", "tag", "routine")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS file_number, 'T' || o_orderkey AS file_name, CASE WHEN o_orderkey % 10 = 1 THEN '2' ELSE '' END AS parent_file, CAST(n AS BIGINT) AS field_count, CAST(p AS BIGINT) AS pointer_out, CAST(coalesce(i, 0) AS BIGINT) AS pointer_in, CAST(0 AS BIGINT) AS record_count
FROM orders JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_linenumber % 2 = 0) AS p FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
LEFT JOIN (SELECT l_suppkey, count(*) AS i FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY 1) ON l_suppkey = o_orderkey""")
def record_types(t: Tables) -> DataFrame:
    """Orders as record types and their lines as fields; even lines point to the type with their supplier's number."""
    key = F.col("o_orderkey").cast("string")
    used = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    names = used.select(F.array(key, F.lit("0")).alias("subs"), F.concat(F.lit("T"), key).alias("value"))
    parents = used.where("o_orderkey % 10 = 1").select(F.array(key, F.lit("0"), F.lit("UP")).alias("subs"), F.lit("2").alias("value"))
    spec = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("P"), F.col("l_suppkey").cast("string"), F.lit("'"))).otherwise("F")
    fields = t.lineitem.select(F.array(F.col("l_orderkey").cast("string"), F.concat(F.lit("."), F.col("l_linenumber").cast("string")), F.lit("0")).alias("subs"), F.concat(F.lit("NAME^"), spec).alias("value"))
    tree = names.unionByName(parents).unionByName(fields).withColumn("root", F.lit("^DD"))
    records = used.select(key.alias("file_number"), F.lit(0).cast("long").alias("record_count"))
    return nodes.record_types(tree, records)


@query("""SELECT l_orderkey AS unit, CAST(l_partkey AS VARCHAR) AS ref, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS location_list FROM lineitem GROUP BY 1, 2""")
def analysis_xrefs(t: Tables) -> DataFrame:
    """A nested analysis per order, flattened again: parts and the lines where they occur."""
    places = t.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.collect_list(F.col("l_linenumber").cast("string")).alias("places"))
    xrefs = F.map_from_entries(F.collect_list(F.struct(F.col("l_partkey").cast("string").alias("ref"), "places")))
    nested = places.groupBy(F.col("l_orderkey").alias("unit")).agg(xrefs.alias("xrefs"))
    empty = {"errors": F.expr("cast(array() as array<struct<line: string, tag: string, text: string>>)"), "tags": F.expr("cast(map() as map<string, string>)")}
    return nodes.analysis(nested.withColumns(empty))["xrefs"]


@query("""WITH e AS (SELECT l_orderkey AS unit, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_linenumber AS VARCHAR), l_linestatus, CAST(l_partkey AS VARCHAR)) - 1 AS i, l_linenumber AS line, l_linestatus AS tag, l_partkey AS t FROM lineitem WHERE l_returnflag = 'R'),
x AS (SELECT l_orderkey AS unit, CAST(l_suppkey AS VARCHAR) AS ref, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS places FROM lineitem GROUP BY 1, 2),
g AS (SELECT l_orderkey AS unit, 'T' || l_partkey AS tag, CAST(max(l_linenumber) AS VARCHAR) AS data FROM lineitem GROUP BY 1, 2),
u AS (SELECT unit FROM x GROUP BY 1)
SELECT 'units' AS "table", unit, '' AS key, coalesce(a, 0) || '|' || b || '|' || c AS detail FROM u LEFT JOIN (SELECT unit, count(*) AS a FROM e GROUP BY 1) USING (unit) JOIN (SELECT unit, count(*) AS b FROM x GROUP BY 1) USING (unit) JOIN (SELECT unit, count(*) AS c FROM g GROUP BY 1) USING (unit)
UNION ALL SELECT 'errors', unit, CAST(i AS VARCHAR), line || '|' || tag || '|' || t FROM e UNION ALL SELECT 'xrefs', unit, ref, places FROM x UNION ALL SELECT 'tags', unit, tag, data FROM g""")
def analysis_tables(t: Tables) -> DataFrame:
    """All four tables of a nested analysis per order: returned lines are its findings, suppliers its references, parts its tags."""
    text = lambda c: F.col(c).cast("string")
    finding = F.struct(text("l_linenumber").alias("line"), F.col("l_linestatus").alias("tag"), text("l_partkey").alias("text"))
    lines = t.lineitem.groupBy("l_orderkey", text("l_suppkey").alias("ref")).agg(F.collect_list(text("l_linenumber")).alias("places"))
    tags = t.lineitem.groupBy("l_orderkey", F.concat(F.lit("T"), text("l_partkey")).alias("tag")).agg(F.max("l_linenumber").cast("string").alias("data"))
    nested = (
        t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == "R", finding))).alias("errors"))
        .join(lines.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("ref", "places"))).alias("xrefs")), "l_orderkey")
        .join(tags.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("tag", "data"))).alias("tags")), "l_orderkey")
        .withColumnRenamed("l_orderkey", "unit")
    )
    found = nodes.analysis(nested)
    count = lambda *c: F.concat_ws("|", *[text(x) for x in c])
    parts = {
        "units": (F.lit(""), count("error_count", "xref_count", "tag_count")), "errors": (text("entry_index"), count("line", "tag", "text")), "xrefs": (F.col("ref"), F.col("location_list")), "tags": (F.col("tag"), F.col("data")),
    }
    return reduce(DataFrame.unionByName, [found[name].select(F.lit(name).alias("table"), "unit", key.alias("key"), detail.alias("detail")) for name, (key, detail) in parts.items()])


@query("""WITH s AS (SELECT p_name AS store, max(p_partkey) AS record FROM part GROUP BY 1), n AS (SELECT p_name AS store, count(*) AS nodes FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT n.store, CASE WHEN starts_with(n.store, 'a') THEN 'scratch' WHEN s.record % 2 = 0 THEN 'described' ELSE 'undescribed' END AS state, CASE WHEN s.record % 2 = 0 THEN s.record END AS record, nodes FROM n JOIN s ON s.store = n.store""")
def store_census(t: Tables) -> DataFrame:
    """Stores (part names) as scratch, described or undescribed; of several records the last number describes one."""
    counts = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_name").alias("store")).agg(F.count("*").alias("nodes"))
    index = t.part.groupBy(F.col("p_name").alias("store")).agg(F.max("p_partkey").alias("record")).where("record % 2 = 0")
    state = F.when(F.col("store").startswith("a"), "scratch").when(F.col("record").isNotNull(), "described").otherwise("undescribed")
    return counts.join(index, "store", "left").select("store", state.alias("state"), "record", "nodes")


@query(f"""WITH e AS (SELECT s_nationkey AS sg, c_nationkey AS dg, p_brand AS tag, count(*) AS n FROM ({_SUPPLY}) JOIN supplier ON s_suppkey = source JOIN customer ON c_custkey = target JOIN part ON p_partkey = part WHERE s_nationkey <> c_nationkey GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY sg, dg ORDER BY n DESC, tag) AS k, sum(n) OVER (PARTITION BY sg, dg) AS total FROM e)
SELECT sg, dg, CAST(total AS BIGINT) AS edges, tag, n, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 3""")
def group_coupling(t: Tables) -> DataFrame:
    e = t.supply().join(t.supplier_groups().toDF("source", "sg"), "source").join(t.customer_groups().toDF("target", "dg"), "target").where("sg <> dg")
    counts = e.join(t.part.select(F.col("p_partkey").alias("part"), F.col("p_brand").alias("tag")), "part").groupBy("sg", "dg", "tag").agg(F.count("*").alias("n"))
    totals = counts.groupBy("sg", "dg").agg(F.sum("n").alias("edges"))
    return E.top_k(counts, ["sg", "dg"], [F.desc("n"), F.col("tag")], 3).join(totals, ["sg", "dg"])


@query("""WITH l AS (SELECT source, count(*) AS units, CAST(sum(n_chars) AS BIGINT) AS chars, count(*) FILTER (n_chars > 5000) AS long_units FROM documents GROUP BY 1),
q AS (SELECT source, count(*) FILTER (quality = 0) AS findings, count(*) AS labelled FROM documents JOIN labels USING (doc_id) GROUP BY 1)
SELECT l.source, units, chars, long_units, CAST(coalesce(findings, 0) AS BIGINT) AS findings, CAST(coalesce(labelled, 0) AS BIGINT) AS labelled FROM l LEFT JOIN q ON q.source = l.source""")
def group_health(t: Tables) -> DataFrame:
    base = t.documents.groupBy("source").agg(F.count("*").alias("units"), F.sum("n_chars").alias("chars"), F.count_if(F.col("n_chars") > 5000).alias("long_units"))
    found = t.documents.join(t.labels, "doc_id").groupBy("source").agg(F.count_if(F.col("quality") == 0).alias("findings"), F.count("*").alias("labelled"))
    return J.star(base, "source", [found], zero=["findings", "labelled"])


@query(f"""WITH e AS (SELECT s_suppkey, s_name, c_custkey, c_name, x.n_name AS grp, y.n_name AS other, p_brand, p_type, source FROM ({_SUPPLY}) JOIN supplier ON s_suppkey = source JOIN customer ON c_custkey = target
  JOIN nation x ON x.n_nationkey = s_nationkey JOIN nation y ON y.n_nationkey = c_nationkey JOIN part ON p_partkey = part),
p AS (SELECT n_name AS grp, left(s_name, l) AS prefix, count(*) AS n, min((s_name, -l)) AS seen FROM supplier JOIN nation ON n_nationkey = s_nationkey, (VALUES (2), (3), (4)) v(l) GROUP BY 1, 2),
s AS (
  SELECT n_name AS grp, 'summary' AS section, 'units' AS item, count(*) AS n FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY 1 UNION ALL
  SELECT grp, 'summary', 'edges', count(*) FROM e GROUP BY 1 UNION ALL SELECT grp, 'summary', 'stores', count(DISTINCT p_brand) FROM e GROUP BY 1 UNION ALL
  SELECT grp, 'summary', 'registry', count(DISTINCT c_custkey) FROM e WHERE grp = other GROUP BY 1 UNION ALL
  SELECT grp, 'prefix', arg_min(prefix, (-n, seen)), max(n) FROM p GROUP BY 1 UNION ALL
  SELECT grp, 'types', p_type, count(*) FROM e GROUP BY 1, 3 UNION ALL SELECT grp, 'stores', p_brand, count(*) FROM e GROUP BY 1, 3 UNION ALL
  SELECT grp, 'registry', c_name, count(*) FROM e WHERE grp = other GROUP BY 1, 3 UNION ALL
  SELECT other, 'inbound', grp, count(*) FROM e WHERE grp <> other GROUP BY 1, 3 UNION ALL SELECT grp, 'outbound', other, count(*) FROM e WHERE grp <> other GROUP BY 1, 3 UNION ALL
  SELECT grp, 'hubs', s_name || CASE WHEN count(*) >= 10 THEN ' many' ELSE '' END, count(DISTINCT c_custkey) FROM e GROUP BY 1, s_name)
SELECT grp, section, item, n, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY grp, section ORDER BY n DESC, item) AS r FROM s) WHERE r <= 10""")
def group_overview(t: Tables) -> DataFrame:
    """Nations as groups of suppliers: a summary, the names' prefix, record types, stores, registry rows, edges in and out by group, and hubs."""
    n = F.count("*").alias("n")
    units = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("grp"), "s_suppkey", "s_name")
    ends = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("target"), "c_name", F.col("n_name").alias("other"))
    e = t.supply().join(units, F.col("source") == F.col("s_suppkey")).join(ends, "target").join(t.part.select(F.col("p_partkey").alias("part"), "p_brand", "p_type"), "part")
    home, away = F.col("grp") == F.col("other"), e.where("grp <> other")

    def summary(rows: DataFrame, item: str, value) -> DataFrame:
        return rows.groupBy("grp").agg(value.alias("n")).select("grp", F.lit(item).alias("item"), "n")

    facts = [summary(units, "units", F.count("*")), summary(e, "edges", F.count("*")), summary(e, "stores", F.count_distinct("p_brand")), summary(e.where(home), "registry", F.count_distinct("target"))]
    prefix = P.dominant_prefix(units, "grp", "s_name", [2, 3, 4], 0.0)
    sizes = units.groupBy("grp").agg(n)
    hubs = e.groupBy("grp", "s_name", "target").agg(F.count("*").alias("c")).groupBy("grp", "s_name").agg(F.count("*").alias("n"), F.sum("c").alias("c"))
    sections = {
        "summary": reduce(DataFrame.unionByName, facts),
        "prefix": prefix.join(sizes, "grp").select("grp", F.col("prefix").alias("item"), F.round(F.col("share") * F.col("n")).cast("long").alias("n")),
        "types": e.groupBy("grp", F.col("p_type").alias("item")).agg(n),
        "stores": e.groupBy("grp", F.col("p_brand").alias("item")).agg(n),
        "registry": e.where(home).groupBy("grp", F.col("c_name").alias("item")).agg(n),
        "inbound": away.groupBy(F.col("other").alias("grp"), F.col("grp").alias("item")).agg(n),
        "outbound": away.groupBy("grp", F.col("other").alias("item")).agg(n),
        "hubs": hubs.select("grp", F.concat("s_name", F.when(F.col("c") >= 10, " many").otherwise("")).alias("item"), "n"),
    }
    return J.cards(sections, "grp", 10)


@query("""WITH b AS (SELECT source, doc_id, n_chars, lang, text, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS used FROM documents)
SELECT source AS grp, 'summary' AS section, CAST(1 AS BIGINT) AS ord, 'Units: ' || count(*) AS item FROM documents GROUP BY source UNION ALL SELECT source, 'summary', 2, 'Characters: ' || CAST(sum(n_chars) AS BIGINT) FROM documents GROUP BY source
UNION ALL SELECT source, 'languages', row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, coalesce(lang, '(none)')), coalesce(lang, '(none)') || ' ' || count(*) FROM documents GROUP BY source, coalesce(lang, '(none)')
UNION ALL SELECT source, 'inventory', k, doc_id || ' (chars=' || n_chars || ')' FROM b
UNION ALL SELECT source, 'text', k, md5(text) FROM b WHERE used <= 50000
UNION ALL SELECT source, 'truncated', 0, count(*) || ' more units omitted; budget 50000' FROM b WHERE used > 50000 GROUP BY source""")
def context_pack(t: Tables) -> DataFrame:
    """Sections per group: a summary, languages, the ranked inventory of all units, and texts (here their MD5) in that order within a budget."""
    n = F.count("*")
    facts = t.documents.groupBy(F.col("source").alias("grp")).agg(n.alias("units"), F.sum("n_chars").alias("chars"))
    lines = F.array(F.concat(F.lit("Units: "), F.col("units").cast("string")), F.concat(F.lit("Characters: "), F.col("chars").cast("string")))
    summary = facts.select("grp", F.lit("summary").alias("section"), F.posexplode(lines).alias("at", "item")).select("grp", "section", (F.col("at") + 1).cast("long").alias("ord"), "item")
    langs = t.documents.groupBy(F.col("source").alias("grp"), F.coalesce("lang", F.lit("(none)")).alias("lang")).agg(n.alias("n"))
    languages = P.ranked(langs, "grp", [F.desc("n"), F.col("lang")]).select("grp", F.lit("languages").alias("section"), F.col("rank").cast("long").alias("ord"), F.concat_ws(" ", "lang", F.col("n").cast("string")).alias("item"))
    order = [F.desc("n_chars"), F.col("doc_id")]
    inventory = V.ranked_inventory(t.documents.select("source", "doc_id", "n_chars"), "source", "doc_id", order, F.format_string("%d (chars=%d)", "doc_id", "n_chars"))
    chosen = P.within_budget(t.documents.select("doc_id", "source", "n_chars"), "source", order, F.col("n_chars"), 50_000)
    ranks = P.ranked(chosen, "source", order).select("source", "doc_id", F.col("rank").cast("long").alias("ord"))
    texts = ranks.join(t.documents.select("source", "doc_id", "text"), ["source", "doc_id"]).select(F.col("source").alias("grp"), F.lit("text").alias("section"), "ord", F.md5(F.col("text").cast("binary")).alias("item"))
    left = facts.join(ranks.groupBy(F.col("source").alias("grp")).agg(n.alias("shown")), "grp", "left").withColumn("left_out", F.col("units") - F.coalesce("shown", F.lit(0))).where("left_out > 0")
    truncated = left.select("grp", F.lit("truncated").alias("section"), F.lit(0).cast("long").alias("ord"), F.concat(F.col("left_out").cast("string"), F.lit(" more units omitted; budget 50000")).alias("item"))
    return reduce(DataFrame.unionByName, [summary, languages, inventory, texts, truncated])


@query("""WITH f AS (SELECT p_brand AS store, count(*) AS records, max(p_size) AS hi, min(p_size) AS lo, count(DISTINCT p_type) AS kinds FROM part GROUP BY 1)
SELECT store, CASE WHEN hi >= 50 AND records % 3 = 0 THEN 'G-01' WHEN lo = 1 AND records % 3 = 1 THEN 'G-02' WHEN kinds % 2 = 0 THEN 'G-06' WHEN kinds % 4 = 1 THEN 'G-05' END AS method,
  CASE WHEN hi >= 50 AND records % 3 = 0 THEN 'P' WHEN lo = 1 AND records % 3 = 1 THEN 'P' WHEN kinds % 2 = 0 THEN 'P' WHEN kinds % 4 = 1 THEN 'K' END AS label FROM f""")
def store_rule_cascade(t: Tables) -> DataFrame:
    f = t.part.groupBy(F.col("p_brand").alias("store")).agg(F.count("*").alias("records"), F.max("p_size").alias("hi"), F.min("p_size").alias("lo"), F.count_distinct("p_type").alias("kinds"))
    features = f.select(
        "store", ((F.col("hi") >= 50) & (F.col("records") % 3 == 0)).alias("patient_namespace"), ((F.col("lo") == 1) & (F.col("records") % 3 == 1)).alias("patient_subscripts"), (F.col("kinds") % 2 == 0).alias("partial_patient"),
        (F.col("kinds") % 4).cast("int").alias("referrer_groups"), F.lit("K").alias("referrer_label"),
    )
    return R.labelled(features, R.store_rules()).select("store", "method", "label")


@query("""WITH p AS (SELECT p_partkey, left(p_name, 3) AS prefix, coalesce(n, 0) AS refs, p_size - 1 AS records FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity >= 40 GROUP BY 1) ON l_partkey = p_partkey),
s AS (SELECT prefix, count(*) AS c FROM p GROUP BY 1)
SELECT p_partkey, CASE WHEN records = 0 AND refs = 0 THEN 'vestigial' WHEN c >= 5 THEN 'batch' WHEN refs = 0 THEN 'unused' ELSE 'mixed' END AS bucket FROM p JOIN s ON s.prefix = p.prefix""")
def triage(t: Tables) -> DataFrame:
    refs = t.lineitem.where("l_quantity >= 40").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("refs"))
    rows = t.part.join(refs, "p_partkey", "left").select("p_partkey", F.substring("p_name", 1, 3).alias("prefix"), F.coalesce("refs", F.lit(0)).alias("refs"), (F.col("p_size") - 1).alias("records"))
    sizes = rows.groupBy("prefix").agg(F.count("*").alias("prefix_size"))
    return I.triage(rows.join(sizes, "prefix")).select("p_partkey", "bucket")


@query(f"""WITH i AS (SELECT s_nationkey AS g, s_suppkey AS s, count(DISTINCT target) AS d FROM ({_SUPPLY}) JOIN supplier ON s_suppkey = source GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d DESC, s) AS k FROM i),
b AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 50)
SELECT s_suppkey AS unit, coalesce(k <= 10, false) AS hub, b.l_suppkey IS NOT NULL AS returned, s_acctbal < 0 AS in_debt FROM supplier LEFT JOIN r ON r.s = s_suppkey LEFT JOIN b ON b.l_suppkey = s_suppkey""")
def badges(t: Tables) -> DataFrame:
    per = t.supply().select("source", "target").distinct().groupBy("source").agg(F.count("*").alias("d")).join(t.supplier_groups().toDF("source", "g"), "source")
    hubs = E.top_k(per, ["g"], [F.desc("d"), F.col("source")], 10).select(F.col("source").alias("unit"), F.lit(True).alias("h"))
    bad = t.lineitem.where("l_returnflag = 'R' and l_quantity >= 50").select(F.col("l_suppkey").alias("unit")).distinct().withColumn("b", F.lit(True))
    base = t.supplier.select(F.col("s_suppkey").alias("unit"), (F.col("s_acctbal") < 0).alias("in_debt"))
    return base.join(hubs, "unit", "left").join(bad, "unit", "left").select("unit", F.coalesce("h", F.lit(False)).alias("hub"), F.coalesce("b", F.lit(False)).alias("returned"), "in_debt")


@query(f"""SELECT source AS unit, count(DISTINCT target) FILTER (c_nationkey = s_nationkey) AS same_group, count(DISTINCT target) FILTER (c_nationkey <> s_nationkey) AS other_group, count(DISTINCT part) FILTER (p_size >= 25) AS owned, count(DISTINCT part) FILTER (p_size < 25) AS not_owned
FROM ({_SUPPLY}) JOIN supplier ON s_suppkey = source JOIN customer ON c_custkey = target JOIN part ON p_partkey = part GROUP BY 1""")
def unit_lens(t: Tables) -> DataFrame:
    """Callers of the same and other groups, stores owned and not, per unit; pairs are distinct before they are counted."""
    callers = t.supply().select("source", "target").distinct().join(t.supplier_groups().toDF("source", "g"), "source").join(t.customer_groups().toDF("target", "h"), "target")
    a = callers.groupBy("source").agg(F.count_if(F.col("g") == F.col("h")).alias("same_group"), F.count_if(F.col("g") != F.col("h")).alias("other_group"))
    parts = t.supply().select("source", "part").distinct().join(t.part.select(F.col("p_partkey").alias("part"), "p_size"), "part")
    b = parts.groupBy("source").agg(F.count_if(F.col("p_size") >= 25).alias("owned"), F.count_if(F.col("p_size") < 25).alias("not_owned"))
    return a.join(b, "source").withColumnRenamed("source", "unit")


@query("""SELECT event_type, CASE WHEN value >= 50 THEN 'driver' ELSE 'subscriber' END AS role, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def event_fabric(t: Tables) -> DataFrame:
    role = F.when(F.col("value") >= 50, "driver").otherwise("subscriber")
    return t.events.groupBy("event_type", role.alias("role")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("""WITH r AS (SELECT count(*) AS t, count(quality) AS c, count(*) FILTER (d.doc_id % 2 = 0) AS v, count(*) FILTER (d.doc_id % 3 = 0) AS s, count(*) FILTER (quality = 1) AS p, count(*) FILTER (n_chars > 500) AS u,
  count(*) FILTER (d.doc_id % 6 = 0 AND quality = 1 AND n_chars > 500) AS a, count(*) FILTER (lang = 'en') AS sd, count(*) FILTER (quality = 1 AND d.doc_id % 5 = 0) AS ok, count(*) FILTER (quality = 1) AS lp, count(*) FILTER (quality = 0) AS lk
  FROM documents d LEFT JOIN labels b ON b.doc_id = d.doc_id),
f AS (SELECT count(*) AS t, count(*) FILTER (l_linenumber = 1) AS n FROM lineitem), o AS (SELECT count(*) AS t, count(*) FILTER (o_orderstatus = 'F') AS n FROM orders)
SELECT '{"extraction_date":"2026-01-01T00:00:00Z","piks_classification":{"total_files":' || r.t || ',"classified":' || c || ',"unclassified":' || (r.t - c) || ',"coverage_pct":' || round(c * 100.0::DOUBLE / r.t, 1)
  || ',"by_category":{"P":' || lp || ',"I":0,"K":' || lk || ',"S":0}},"data_properties":{"volatility_classified":' || v || ',"sensitivity_classified":' || s || ',"portability_classified":' || p || ',"volume_classified":' || u
  || ',"fully_classified_pct":' || round(a * 100.0::DOUBLE / r.t, 1) || '},"files":{"total":' || r.t || ',"extracted":' || r.t || ',"classified_piks":' || c || ',"classified_properties":' || a || ',"annotated_subdomain":' || sd || ',"verified":' || ok
  || '},"fields":{"total":' || f.t || ',"extracted":' || f.t || ',"annotated_semantic_type":' || f.n || ',"coverage_pct":' || round(f.n * 100.0::DOUBLE / f.t, 1) || '},"pointers":{"total":' || o.t || ',"extracted":' || o.t || ',"annotated_canonical":' || o.n || ',"coverage_pct":' || round(o.n * 100.0::DOUBLE / o.t, 1) || '}}' AS snapshot FROM r, f, o""")
def coverage_snapshot(t: Tables) -> DataFrame:
    """Documents as record types, lines as fields and orders as pointers."""
    k, q = F.col("doc_id"), F.col("quality")
    records = t.documents.join(t.labels, "doc_id", "left").select(
        F.when(q == 1, "P").when(q == 0, "K").alias("label"), F.when(k % 2 == 0, "slow").alias("volatility"), F.when(k % 3 == 0, "public").alias("sensitivity"), F.when(q == 1, "universal").alias("portability"),
        F.when(F.col("n_chars") > 500, "moderate").alias("volume"), F.when(F.col("lang") == "en", "text").alias("subdomain"), ((q == 1) & (k % 5 == 0)).alias("verified"),
    )
    fields = t.lineitem.select(F.when(F.col("l_linenumber") == 1, "name").alias("semantic_type"))
    return V.coverage(records, fields, t.orders.select((F.col("o_orderstatus") == "F").alias("is_canonical")), F.lit("2026-01-01T00:00:00Z"))


@query("""SELECT l_orderkey, l_linenumber, o_orderstatus, o_orderpriority, c_name, c_mktsegment, cn.n_name AS customer_nation, p_name, p_brand, s_name, sn.n_name AS supplier_nation, cn.n_nationkey <> sn.n_nationkey AS crossing
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation sn ON sn.n_nationkey = s_nationkey""")
def wide_export(t: Tables) -> DataFrame:
    """One wide row per line: the fact table streams past its dimensions."""
    cn = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    sn = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(cn, "c_nationkey")
    suppliers = t.supplier.join(sn, "s_nationkey")
    rows = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        "l_orderkey", "l_linenumber", "o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "customer_nation", "p_name", "p_brand", "s_name", "supplier_nation", (F.col("c_nationkey") != F.col("s_nationkey")).alias("crossing")
    )


@query("""SELECT n_nationkey, lower(n_name) AS grp, c.customers FROM nation JOIN (SELECT n_name AS reg, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1) c ON upper(c.reg) = upper(n_name)""")
def name_join(t: Tables) -> DataFrame:
    """Groups in lower case against a registry in upper case."""
    groups = t.nation.select("n_nationkey", F.lower("n_name").alias("grp"))
    registry = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.upper("n_name").alias("reg")).agg(F.count("*").alias("customers"))
    return J.same_name(groups, registry, "grp", "reg").select("n_nationkey", "grp", "customers")


@query("""WITH x AS (SELECT c_custkey, c_custkey % 29 AS m, CASE WHEN c_custkey % 53 = 0 THEN 0 ELSE coalesce(n, 0) END AS ptr_in, CASE WHEN c_custkey % 53 = 0 THEN 0 ELSE 1 + c_nationkey % 3 END AS ptr_out,
    CASE c_custkey % 47 WHEN 1 THEN 3 WHEN 2 THEN 0 ELSE 1 END AS audited FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey),
y AS (SELECT *, ptr_in * 30 AS records FROM x),
z AS (SELECT c_custkey, CASE WHEN ptr_in = 0 AND ptr_out = 0 AND records < 100 THEN 'H-19' WHEN audited >= 3 THEN 'H-24' WHEN c_custkey % 43 = 1 THEN 'H-25' WHEN c_custkey % 41 = 1 THEN 'H-26' WHEN c_custkey % 37 = 1 THEN 'H-27'
  WHEN c_custkey % 31 = 1 THEN 'H-28' WHEN audited = 0 AND records < 500 THEN 'H-29' WHEN m = 1 THEN 'H-30' WHEN m = 2 THEN 'H-31' WHEN m = 3 THEN 'H-32' WHEN m = 4 THEN 'H-33' WHEN m = 5 AND records < 1000 THEN 'H-34' WHEN m = 6 THEN 'H-35'
  WHEN m = 7 THEN 'H-37' WHEN m = 8 THEN 'H-41' WHEN m = 11 THEN 'H-42' WHEN m = 9 THEN 'H-43' WHEN m = 10 AND records < 5000 THEN 'H-44' WHEN m IN (12, 20) THEN 'H-45' WHEN m = 13 AND ptr_in > 5 THEN 'H-46' WHEN m = 14 THEN 'H-47' WHEN m = 15 THEN 'H-48'
  WHEN m = 16 THEN 'H-49' WHEN m = 17 THEN 'H-50' WHEN m = 18 THEN 'H-51' WHEN m = 19 THEN 'H-52' END AS method FROM y)
SELECT c_custkey, method, CASE WHEN method IN ('H-29', 'H-32', 'H-34', 'H-37', 'H-44', 'H-46', 'H-48') THEN 'K' WHEN method IN ('H-19', 'H-35', 'H-45', 'H-49') THEN 'S' WHEN method IS NOT NULL THEN 'P' END AS label FROM z""")
def specified_rule_cascade(t: Tables) -> DataFrame:
    """Customers as record types: the rules that are specified alone, over derived features that let each one fire."""
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    k, m = F.col("c_custkey"), F.col("c_custkey") % 29
    still = k % 53 == 0

    def at(place: int, value, other):
        return F.when(m == place, value).otherwise(other)

    names = lambda *x: F.array(*[F.lit(v) for v in x])
    made = t.customer.join(n, "c_custkey", "left").withColumn("ptr_in", F.when(still, 0).otherwise(F.coalesce("n", F.lit(0)))).select(
        "c_custkey", "ptr_in", F.when(still, 0).otherwise(1 + F.col("c_nationkey") % 3).alias("ptr_out"), (F.col("ptr_in") * 30).alias("records"), F.when(k % 47 == 1, 3).when(k % 47 == 2, 0).otherwise(1).alias("audited"),
        (k % 43 == 1).alias("first_is_date"), ((k % 43 == 1) | (k % 2 == 0)).alias("is_subfile"), (k % 41 == 1).alias("no_delete"), (k % 37 == 1).alias("created"), (k % 31 == 1).alias("no_write"),
        at(1, 3, 1).alias("depth"), at(2, 3, 0).alias("word_fields"), at(3, 0.6, 0.1).alias("set_share"), at(4, 60, 10).alias("fields"), (m == 5).alias("dinum"), at(6, 3, 0).alias("computed"), at(7, 0.8, 0.1).alias("p_referrers"),
        F.when(m == 8, names("B", "DFN")).when(m == 9, names(*"BCDEFGHJ")).when(m == 10, names("B")).otherwise(names("B", "C")).alias("xrefs"), (m == 11).alias("trigger_to_p"),
        at(12, "@", "").alias("write_access"), at(20, "@", "").alias("delete_access"), (m == 13).alias("open_laygo"),
        F.when(m == 14, "9000050").when(m == 15, "9999999.5").when(m == 16, "1.5").otherwise((k + 100).cast("string")).alias("number"),
        at(17, 5, 0).alias("print_templates"), at(18, 2, 0).alias("input_templates"), at(19, 1, 0).alias("forms"),
    )
    return R.labelled(made, R.specified_rules()).select("c_custkey", "method", "label")

"""Text extraction, line rules, prefixes, profiles and selections, on documents, pages and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as X
from corvane.operators import edges as E
from corvane.operators import joins as J
from corvane.operators import profile as P
from corvane.plans.base import Tables, query
from corvane.session import scratch
from corvane.sources import corpus, tables

#: Lines of a text as a DuckDB list, without the empty piece after a final line break.
_LINES = "CASE WHEN coalesce(text, '') = '' THEN [] WHEN ends_with(text, chr(10)) THEN string_split(text, chr(10))[:-2] ELSE string_split(text, chr(10)) END"
_AT = f"SELECT doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS line_no FROM (SELECT doc_id, {_LINES} AS ls FROM documents)"


def _lines(t: Tables) -> DataFrame:
    return corpus.lines(t.texts("documents", "doc_id", "text"), "doc_id").withColumnRenamed("unit", "doc_id")


@query(f"""WITH d AS (SELECT doc_id AS unit, source AS grp, text, {_LINES} AS ls FROM documents)
SELECT unit, grp, CAST(len(ls) AS BIGINT) AS line_count, CAST(strlen(text) AS BIGINT) AS byte_size, CASE WHEN length(coalesce(ls[1], '')) > 120 THEN left(ls[1], 117) || '...' ELSE coalesce(ls[1], '') END AS first_line,
  CASE WHEN starts_with(ltrim(coalesce(ls[2], ''), ' ' || chr(9)), ';;') THEN ltrim(ls[2], ' ' || chr(9)) ELSE '' END AS version_line,
  CAST(len(list_filter(ls, lambda x: regexp_matches(x, '^[A-Za-z0-9%]'))) AS BIGINT) AS tag_count, CAST(len(list_filter(ls, lambda x: regexp_matches(x, '^[ \\t]*;'))) AS BIGINT) AS comment_line_count,
  CASE WHEN starts_with(CAST(unit AS VARCHAR), '_') THEN 'Y' ELSE 'N' END AS is_percent FROM d""")
def unit_inventory(t: Tables) -> DataFrame:
    return corpus.inventory(t.texts("documents", "doc_id", "source", "text"), "doc_id", "source")


@query("""SELECT page_id, target, count(*) AS ref_count FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS target FROM pages) GROUP BY 1, 2""")
def link_edges(t: Tables) -> DataFrame:
    return E.pattern_edges(t.texts("pages", "page_id", "html"), ["page_id"], F.col("html"), 'href="([^"]+)"', "target")


@query(f"""WITH c AS (SELECT doc_id, regexp_replace(line, '"(?:[^"]|"")*(?:"|$)|;.*', '', 'g') AS clean FROM ({_AT}))
SELECT doc_id, token, count(*) AS ref_count FROM (SELECT doc_id, unnest(regexp_extract_all(clean, '(?:^|[^A-Za-z])([A-Z][a-z]+)', 1)) AS token FROM c) GROUP BY 1, 2""")
def clean_text_edges(t: Tables) -> DataFrame:
    clean = _lines(t).select("doc_id", X.without_literals(F.col("line")).alias("clean"))
    return E.pattern_edges(clean, ["doc_id"], F.col("clean"), "(?:^|[^A-Za-z])([A-Z][a-z]+)", "token")


@query("""WITH r AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS entry, CASE WHEN role <> 'user' THEN text END AS exit FROM conversations),
tall AS (SELECT conv_id, turn, 'entry' AS action_kind, entry AS body FROM r UNION ALL SELECT conv_id, turn, 'exit', exit FROM r)
SELECT conv_id, action_kind, target, count(*) AS ref_count FROM (SELECT conv_id, action_kind, unnest(regexp_extract_all(body, '[A-Z][a-z]+')) AS target FROM tall) GROUP BY 1, 2, 3""")
def registry_edges(t: Tables) -> DataFrame:
    user = F.col("role") == "user"
    registry = t.texts("conversations", "conv_id", "role", "text").select("conv_id", F.when(user, F.col("text")).alias("entry"), F.when(~user, F.col("text")).alias("exit"))
    return E.action_edges(registry, ["conv_id"], {"entry": "entry", "exit": "exit"}, "[A-Z][a-z]+", 0)


@query("""WITH n AS (SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT p_name FROM part)
SELECT name, CASE WHEN regexp_matches(name, '^[A-Za-z]+#[0-9]+$') THEN 'numbered' ELSE 'plain' END AS kind, CAST(coalesce(try_cast(regexp_extract(name, '#([0-9]+)$', 1) AS BIGINT), 0) AS BIGINT) AS number, count(*) AS n FROM n GROUP BY 1, 2, 3""")
def name_classify(t: Tables) -> DataFrame:
    names = t.customer.select(F.col("c_name").alias("name")).unionByName(t.supplier.select(F.col("s_name").alias("name"))).unionByName(t.part.select(F.col("p_name").alias("name")))
    kind = F.when(F.col("name").rlike("^[A-Za-z]+#[0-9]+$"), "numbered").otherwise("plain")
    number = F.coalesce(F.regexp_extract("name", "#([0-9]+)$", 1).try_cast("bigint"), F.lit(0))
    return names.groupBy("name", kind.alias("kind"), number.cast("long").alias("number")).agg(F.count("*").alias("n"))


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query,
  CASE WHEN contains(url, '^') THEN split_part(url, '^', 1) ELSE '' END AS tag, CASE WHEN contains(url, '^') THEN split_part(url, '^', 2) ELSE url END AS unit FROM pages""")
def ref_parse(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select(
        "page_id", F.regexp_extract(u, "^[a-z]+://([^/?#]+)", 1).alias("host"), F.regexp_extract(u, "^[a-z]+://[^/?#]+([^?#]*)", 1).alias("path"), F.regexp_extract(u, r"\?([^#]*)", 1).alias("query"),
        X.reference_tag(u).alias("tag"), X.reference_unit(u).alias("unit"),
    )


@query("""WITH n AS (SELECT p_type, p_partkey, CASE WHEN p_partkey % 9 = 0 THEN '%' ELSE '' END || p_name AS name FROM part), k AS (SELECT * FROM n WHERE NOT starts_with(name, '%')),
p AS (SELECT p_type, left(name, l) AS prefix, count(*) AS n, min((p_partkey, -l)) AS seen FROM k, (VALUES (2), (3), (4)) v(l) WHERE length(name) >= l GROUP BY 1, 2),
a AS (SELECT p_type, count(*) AS c FROM k GROUP BY 1), b AS (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, seen) AS r FROM p)
SELECT b.p_type, prefix, CAST(n AS DOUBLE) / c AS share FROM b JOIN a ON a.p_type = b.p_type WHERE r = 1 AND CAST(n AS DOUBLE) / c >= 0.1""")
def dominant_prefix(t: Tables) -> DataFrame:
    name = F.concat(F.when(F.col("p_partkey") % 9 == 0, "%").otherwise(""), F.col("p_name"))
    return P.dominant_prefix(t.part.select("p_type", name.alias("name"), "p_partkey"), "p_type", "name", [2, 3, 4], 0.1, "p_partkey")


@query("""WITH n AS (SELECT DISTINCT p_name FROM part), p AS (SELECT p_name, l, left(p_name, l) AS prefix FROM n, (VALUES (4), (5), (6)) v(l) WHERE length(p_name) >= l),
s AS (SELECT prefix, count(*) AS size FROM p GROUP BY 1 HAVING count(*) >= 3)
SELECT p_name, arg_max(prefix, l) AS prefix, arg_max(size, l) AS size FROM p JOIN s USING (prefix) GROUP BY 1""")
def prefix_clusters(t: Tables) -> DataFrame:
    return P.prefix_clusters(t.part.select("p_name"), "p_name", [4, 5, 6], 3)


@query("""WITH c AS (SELECT left(p_name, 3) AS prefix, p_type AS grp, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY prefix) AS a, row_number() OVER (PARTITION BY prefix ORDER BY n DESC, grp) AS k FROM c)
SELECT prefix, grp, CAST(n AS DOUBLE) / a AS share FROM r WHERE k = 1 AND CAST(n AS DOUBLE) / a >= 0.05""")
def prefix_owner(t: Tables) -> DataFrame:
    counts = t.part.groupBy(F.substring("p_name", 1, 3).alias("prefix"), F.col("p_type").alias("grp")).agg(F.count("*").alias("n"))
    totals = counts.groupBy("prefix").agg(F.sum("n").alias("a"))
    best = counts.groupBy("prefix").agg(F.min(F.struct((-F.col("n")).alias("o"), "grp", "n")).alias("b"))
    return best.join(totals, "prefix").select("prefix", "b.grp", (F.col("b.n") / F.col("a")).alias("share")).where("share >= 0.05")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_per_key(t: Tables) -> DataFrame:
    return P.first_per_key(t.events.select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(f"""WITH l AS (SELECT *, regexp_matches(line, '^[A-Z]') AND length(line) < 200 AS label, length(line) >= 200 AS comment, contains(line, '!!') AS marker, contains(line, '***') AS own FROM ({_AT})),
r AS (SELECT *, sum(CASE WHEN comment THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS run FROM l),
m AS (SELECT *, max(CASE WHEN comment AND marker THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, run) AS m FROM r),
p AS (SELECT *, lag(comment) OVER (PARTITION BY doc_id ORDER BY line_no) AS pc, lag(m) OVER (PARTITION BY doc_id ORDER BY line_no) AS pm FROM m)
SELECT doc_id, line_no FROM p WHERE label AND NOT coalesce(pc AND pm = 1, false) AND NOT own AND line_no > 1""")
def doc_rule(t: Tables) -> DataFrame:
    """Short capitalised lines as labels, long ones as comments, shouting as the marker."""
    line = F.col("line")
    return P.undocumented_labels(
        _lines(t), "doc_id", "line_no", line.rlike("^[A-Z]") & (F.char_length(line) < 200), F.char_length(line) >= 200, line.contains("!!"), line.contains("***")
    )


@query("""SELECT doc_id, source, CAST(used AS BIGINT) AS used FROM (SELECT *, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS used FROM documents) WHERE used <= 200000""")
def budget_select(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", "n_chars")
    return P.within_budget(rows, "source", [F.desc("n_chars"), F.col("doc_id")], F.col("n_chars"), 200_000).select("doc_id", "source", "used")


@query(f"""WITH l AS ({_AT}), v AS (SELECT doc_id, line_no, 'W-length' AS rule FROM l WHERE length(line) > 245 UNION ALL SELECT doc_id, line_no, 'W-trailing' FROM l WHERE regexp_matches(line, '[ \\t]$')
UNION ALL SELECT doc_id, line_no, 'W-tab' FROM l WHERE contains(line, chr(9)) UNION ALL SELECT doc_id, line_no, 'F-halt' FROM l WHERE regexp_matches(split_part(line, ';', 1), '(?:^|\\s)(?:H|HALT)\\s*$'))
SELECT doc_id, line_no, rule, left(rule, 1) AS severity FROM v""")
def line_rules(t: Tables) -> DataFrame:
    found = P.violations(_lines(t), ["doc_id", "line_no"], P.line_rules(F.col("line")))
    return found.withColumn("severity", X.severity(F.col("rule")))


@query(f"""WITH l AS ({_AT}), v AS (SELECT doc_id, line_no, 'E-first-comment' AS rule FROM l WHERE line_no = 1 AND NOT contains(line, ';') UNION ALL SELECT doc_id, line_no, 'E-first-empty' FROM l WHERE line_no = 1 AND line = ''
UNION ALL SELECT doc_id, line_no, 'E-first-indented' FROM l WHERE line_no = 1 AND regexp_matches(line, '^[ \\t]') UNION ALL SELECT doc_id, line_no, 'E-second-header' FROM l WHERE line_no = 2 AND NOT regexp_matches(line, '^ ?;;')
UNION ALL SELECT doc_id, line_no, 'E-label' FROM l WHERE line_no > 2 AND regexp_matches(line, '^[^ \\t;]') AND NOT regexp_matches(line, '^[A-Za-z%][A-Za-z0-9]*(?:\\(|[ \\t]|;|$)|^[0-9]+(?:[ \\t]|;|$)'))
SELECT rule, count(*) AS n, count(DISTINCT doc_id) AS units FROM v GROUP BY 1""")
def structure_rules(t: Tables) -> DataFrame:
    found = P.violations(_lines(t), ["doc_id"], P.structure_rules(F.col("line"), F.col("line_no")))
    return found.groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("units"))


@query(f"""SELECT doc_id, line_no, CASE WHEN length(line) > 120 THEN left(line, 117) || '...' ELSE line END AS snippet FROM ({_AT}) WHERE regexp_matches(line, '(?i)token|license') ORDER BY doc_id, line_no LIMIT 100""")
def regex_search(t: Tables) -> DataFrame:
    """The feature has a limit: the first hundred hits in order."""
    hits = _lines(t).where(F.col("line").rlike("(?i)token|license"))
    return hits.select("doc_id", "line_no", X.shortened(F.col("line")).alias("snippet")).orderBy("doc_id", "line_no").limit(100)


@query("""WITH k AS (SELECT coalesce(nullif(event_type, ''), '(empty)') AS k0, coalesce(nullif(CAST(json_extract_string(props, '$.k') AS VARCHAR), ''), '(empty)') AS k1 FROM events)
SELECT k0, k1, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM k) AS share FROM k GROUP BY 1, 2""")
def histogram(t: Tables) -> DataFrame:
    return P.histogram(t.events, [F.col("event_type"), F.get_json_object("props", "$.k")])


@query("""WITH n AS (SELECT l_orderkey, count(*) AS lines, sum(CAST(l_quantity AS BIGINT)) AS quantity FROM lineitem GROUP BY 1)
SELECT 'lines' AS measure, (SELECT l_orderkey FROM n ORDER BY lines DESC, l_orderkey LIMIT 1) AS arg, CAST((SELECT max(lines) FROM n) AS BIGINT) AS value
UNION ALL SELECT 'quantity', (SELECT l_orderkey FROM n ORDER BY quantity DESC, l_orderkey LIMIT 1), CAST((SELECT max(quantity) FROM n) AS BIGINT)""")
def extremes(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))
    best = {m: F.max_by(F.struct("l_orderkey", F.col(m).alias("v")), F.struct(m, -F.col("l_orderkey"))) for m in ("lines", "quantity")}
    one = n.agg(*[c.alias(m) for m, c in best.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}.l_orderkey").alias("arg"), F.col(f"{m}.v").alias("value")) for m in best])).alias("r")).select("r.*")


_BUCKET = "CASE WHEN regexp_matches(upper(text), 'LICENSE|RELEASED') THEN 'license' WHEN regexp_matches(upper(text), 'TOKEN') THEN 'secret' WHEN contains(text, '@') THEN 'contact' WHEN contains(text, '***') THEN 'symbols' ELSE 'other' END"


@query(f"""SELECT coalesce(lang, '(none)') AS lang, {_BUCKET} AS bucket, count(*) AS n, count(nullif(text, '')) AS with_text, count(nullif(source, '')) AS with_source, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1, 2""")
def profile_fields(t: Tables) -> DataFrame:
    x = F.col("text")
    bucket = F.when(F.upper(x).rlike("LICENSE|RELEASED"), "license").when(F.upper(x).contains("TOKEN"), "secret").when(x.contains("@"), "contact").when(x.contains("***"), "symbols").otherwise("other")
    filled = [F.count(X.blank_to_null(F.col(c))).alias(n) for c, n in (("text", "with_text"), ("source", "with_source"))]
    return t.documents.groupBy(F.coalesce("lang", F.lit("(none)")).alias("lang"), bucket.alias("bucket")).agg(F.count("*").alias("n"), *filled, F.sum("n_chars").alias("chars"))


@query("""SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS documents_in_labels, (SELECT count(*) FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)) AS labels_in_documents,
(SELECT count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)) AS customers_in_orders""")
def key_overlap(t: Tables) -> DataFrame:
    n = F.count("*")
    a = t.documents.join(t.labels, "doc_id", "left_semi").agg(n.alias("documents_in_labels"))
    b = t.labels.join(t.documents, "doc_id", "left_semi").agg(n.alias("labels_in_documents"))
    c = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left_semi").agg(n.alias("customers_in_orders"))
    return a.crossJoin(b).crossJoin(c)


@query("""WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g') AS a, text FROM documents),
b AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(a, '(?m)^\\t+', ' ', 'g'), '(?m)[ \\t]+$', '', 'g'), '\\n+\\z', '') || chr(10) AS t FROM d)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, t <> text AS changed, md5(t) AS digest FROM b""")
def text_normalise(t: Tables) -> DataFrame:
    made = t.texts("documents", "doc_id", "text").select("doc_id", "text", X.normalised(F.col("text")).alias("t"))
    return made.select("doc_id", F.char_length("t").cast("long").alias("n_chars"), (F.col("t") != F.col("text")).alias("changed"), F.md5(F.col("t").cast("binary")).alias("digest"))


@query(f"""WITH l AS ({_AT}), g AS (SELECT doc_id, line_no, lead(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) AS nx, line FROM l), f AS (SELECT doc_id, min(line_no) AS spot FROM l WHERE regexp_matches(line, '^Th[a-z]+') GROUP BY 1)
SELECT l.doc_id, l.line_no, l.line_no - spot AS offset_lines, length(l.line) AS n FROM l JOIN f ON f.doc_id = l.doc_id WHERE l.line_no BETWEEN spot AND spot + 5""")
def tag_window(t: Tables) -> DataFrame:
    """The first line that begins with the wanted head, and the five after it, in every document."""
    lines = _lines(t)
    at = lines.where(F.col("line").rlike("^Th[a-z]+")).groupBy("doc_id").agg(F.min("line_no").alias("at"))
    near = lines.join(at, "doc_id").where(F.col("line_no").between(F.col("at"), F.col("at") + 5))
    return near.select("doc_id", "line_no", (F.col("line_no") - F.col("at")).alias("offset_lines"), F.char_length("line").alias("n"))


@query(f"""WITH l AS (SELECT doc_id, line_no, regexp_extract(line, '^([A-Za-z%][A-Za-z0-9]*)', 1) AS tag FROM ({_AT}) WHERE line_no > 1)
SELECT doc_id, tag, min(line_no) AS line_no FROM l WHERE tag <> '' GROUP BY 1, 2""")
def tag_list(t: Tables) -> DataFrame:
    tags = _lines(t).where("line_no > 1").select("doc_id", X.tags_of_line(F.col("line")).alias("tag"), "line_no").where("tag <> ''")
    return P.first_per_key(tags, ["doc_id", "tag"], ["line_no"])


@query("""SELECT left(s_name, 12) AS prefix, count(*) AS stores, CAST(sum(n) AS BIGINT) AS nodes FROM supplier JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey WHERE s_acctbal < 5000 GROUP BY 1""")
def prefix_rollup(t: Tables) -> DataFrame:
    n = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    return t.supplier.where("s_acctbal < 5000").join(n, "s_suppkey").groupBy(F.substring("s_name", 1, 12).alias("prefix")).agg(F.count("*").alias("stores"), F.sum("n").alias("nodes"))


@query("""WITH d AS (SELECT source, source || '-t' AS k, count(*) AS n FROM documents GROUP BY 1, 2), h AS (SELECT DISTINCT source || '-t' AS k FROM documents WHERE contains(text, '***'))
SELECT source, n, CASE WHEN h.k IS NULL THEN 'no test' ELSE 'covered' END AS state FROM d LEFT JOIN h ON h.k = d.k""")
def test_coverage(t: Tables) -> DataFrame:
    units = t.documents.groupBy("source").agg(F.count("*").alias("n")).withColumn("k", F.concat("source", F.lit("-t")))
    tests = t.documents.where(F.col("text").contains("***")).select(F.concat("source", F.lit("-t")).alias("k"), F.lit(True).alias("has")).distinct()
    return units.join(tests, "k", "left").select("source", "n", F.when(F.col("has"), "covered").otherwise("no test").alias("state"))


@query("""WITH l AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE lang END AS lang, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source FROM documents)
SELECT l.doc_id, coalesce(nullif(l.lang, ''), d.lang) AS lang, coalesce(nullif(l.source, ''), d.source) AS source FROM l LEFT JOIN documents d ON d.doc_id = l.doc_id""")
def fill_blank(t: Tables) -> DataFrame:
    gaps = t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"))
    return J.fill_blank(gaps, t.documents.select("doc_id", "lang", "source"), "doc_id", ["lang", "source"])


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority, 'csv' AS dialect FROM orders UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority, 'raw' FROM orders""")
def tsv_dialects(t: Tables) -> DataFrame:
    """A round trip of a table through both dialects of tab-separated files."""
    folder = scratch(t.spark, "tsv")
    out = None
    for dialect in ("csv", "raw"):
        tables.write_table(t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"), f"{folder}/{dialect}", ["o_orderkey"], dialect)
        back = tables.read_table(t.spark, f"{folder}/{dialect}", "o_orderkey bigint, o_orderstatus string, o_orderpriority string", dialect).withColumn("dialect", F.lit(dialect))
        out = back if out is None else out.unionByName(back)
    return out


@query("""SELECT metric, value FROM (SELECT 'documents' AS metric, CAST(count(*) AS DOUBLE) AS value FROM documents UNION ALL SELECT 'sources', CAST(count(DISTINCT source) AS DOUBLE) FROM documents
UNION ALL SELECT 'characters', CAST(sum(n_chars) AS DOUBLE) FROM documents UNION ALL SELECT 'longest', CAST(max(n_chars) AS DOUBLE) FROM documents)""")
def run_metrics(t: Tables) -> DataFrame:
    return P.metrics(t.documents, {"documents": F.count("*"), "sources": F.count_distinct("source"), "characters": F.sum("n_chars"), "longest": F.max("n_chars")})

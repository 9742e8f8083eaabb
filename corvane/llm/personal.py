"""Personal data: exact patterns, extended by bootstrapped contextual extraction.

The base patterns give the seed entities. The words around a seed are a lexical
pattern; whatever stands in the same place and could be of the seed's kind by its
form is another instance of it. Patterns and instances form a bipartite graph
that Spark scores in rounds: a pattern is as good as the known share of its
instances, an instance as good as its best pattern. Instances that pass the
threshold are new spans, where patterns that pass stand around them.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from corvane.llm.common import as_texts, bounded_batches, stored

KINDS = ("email", "ip", "card", "phone")
#: Distinct seed instances that a pattern needs, and the score from which either counts.
SUPPORT, CONFIDENCE = 3, 0.8
#: Characters of an identifier-like token.
TOKEN_CHARS = (4, 64)

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match never begins inside a run of digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGITS = re.compile(r"[^0-9]")
_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_EDGE = "\"'()[]{}<>,.;:!?*#$%&|"
_OPENING = "\"'([{<"

# Forms that a kind can have beside its base pattern.
_AT = r"(?:@|\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s)"
_DOT = r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s)"
_AT_MARK = re.compile(_AT, re.I)
_HOST = re.compile(rf"[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}", re.I)
_NUMBER = re.compile(r"(?<![\w.+@-])\(?[0-9]{1,19}\)?(?:[\s./-]{1,2}\(?[0-9]{1,19}\)?){1,7}(?![\w@])")
_FORMS = {
    "email": re.compile(rf"[^\s@]+@[^\s@]+|[A-Za-z0-9._%+-]+{_AT}{_HOST.pattern}", re.I),
    "ip": re.compile(r"[0-9]+(?:(?:[.,:-]|[\[(]\.[\])])[0-9]+){3}|[0-9a-f]{0,4}(?::[0-9a-f]{0,4}){3,7}", re.I),
    "card": re.compile(r"[0-9](?:[\s.-]{0,2}[0-9]){9,23}"),
    "phone": re.compile(r"[+(]{0,2}[0-9](?:[\s()./-]{0,3}[0-9]){4,16}"),
}


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str):
    """Leftmost matches, without trying every word: a match must end its local part at an @."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.span()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by kind as listed and then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _NOT_DIGITS.sub("", m.group())
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def kinds_by_form(token: str) -> list[str]:
    """The kinds that a candidate could be of."""
    return [k for k in KINDS if _FORMS[k].fullmatch(token)]


def contexts_of(text: str, start: int, end: int) -> list[str]:
    """The word before ``start``, the two words before it, and the words on both sides, lower-cased.

    Quotes and brackets that touch the token don't count.
    """
    words = text[max(0, start - 80) : start].lower().split(" ")
    glued = words.pop().rstrip(_OPENING)
    near = [w for w in words if w][-2:]
    left = [f"{' '.join(near[-k:])} {glued}" for k in (1, 2) if len(near) >= k]
    after = text[end : end + 40].lower().split()
    right = after[0].strip(_EDGE) if after else ""
    if not right and len(after) > 1:
        right = after[1].strip(_EDGE)
    return [*left, f"{left[0]}\n{right}"] if left and right else left


def candidate_spans(text: str, taken: list[tuple[str, int, int]]):
    """Spans of tokens with a digit or @, without edge punctuation, that touch no base span."""
    ranges = sorted((s, e) for _, s, e in taken)
    at, k = 0, 0
    while m := _MARK.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = gap.start() if (gap := _SPACE.search(text, m.end())) else len(text)
        at = end
        raw = text[start:end]
        body = raw.strip(_EDGE)
        start += len(raw) - len(raw.lstrip(_EDGE))
        end = start + len(body)
        while k < len(ranges) and ranges[k][1] <= start:
            k += 1
        if TOKEN_CHARS[0] <= len(body) <= TOKEN_CHARS[1] and not (k < len(ranges) and ranges[k][0] < end):
            yield start, end


def wide_spans(text: str, taken: list[tuple[str, int, int]]):
    """Spans of numbers in groups and of emails with a spelt-out at or dot, which may have spaces, that touch no base span."""
    ranges = sorted((s, e) for _, s, e in taken)
    reach = list(accumulate((e for _, e in ranges), max))  # spans of two kinds may overlap

    def is_free(start: int, end: int) -> bool:
        k = bisect_right(ranges, (start, len(text)))
        return not (k and reach[k - 1] > start) and not (k < len(ranges) and ranges[k][0] < end)

    for m in _NUMBER.finditer(text):
        if m.end() - m.start() <= TOKEN_CHARS[1] and is_free(*m.span()):
            yield m.span()
    for m in _AT_MARK.finditer(text):
        start = m.start()
        while start > max(0, m.start() - TOKEN_CHARS[1]) and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, m.end()) if start < m.start() else None
        if host and host.end() - start <= TOKEN_CHARS[1] and is_free(start, host.end()):
            yield start, host.end()


_SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]
)
_MENTION = T.StructType(
    [*_SPAN.fields, T.StructField("surface", T.StringType()), T.StructField("fits", T.ArrayType(T.StringType())), T.StructField("contexts", T.ArrayType(T.StringType()))]
)


@arrow_udf(T.ArrayType(_MENTION))
def mentions(texts: pa.Array) -> pa.Array:
    """Base spans (with kind) and candidates of some kind's form (without) of each whole text; null counts as empty."""
    out = []
    for text in as_texts(texts):
        base = base_spans(text)
        rest = {*candidate_spans(text, base), *wide_spans(text, base)}
        spans = [(k, s, e, [k]) for k, s, e in base] + [(None, s, e, fits) for s, e in sorted(rest) if (fits := kinds_by_form(text[s:e]))]
        out.append(
            [
                {"kind": k, "first": s, "last": e, "surface": text[s:e], "fits": fits, "contexts": contexts_of(text, s, e)}
                for k, s, e, fits in spans
            ]
        )
    return pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("surface", pa.string()), ("fits", pa.list_(pa.string())), ("contexts", pa.list_(pa.string()))])))


def discovered(found: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(row, kind, first, last) of new spans, from ``found`` (row, kind or null, first, last, surface, fits, contexts).

    An edge joins a pattern (context) and an instance (surface) for a kind that
    the instance is or could be of. Edges are distinct, so common contexts are
    reduced before any join. A candidate takes the kind it scores best in (ties:
    the first listed); of spans inside one another the widest stays. Rounds end
    when no pattern passes that hadn't before: scores only grow, so each but the
    last adds one at least, and there are as many as steps from the seeds.
    """
    edges = stored(
        found.select(F.explode("contexts").alias("context"), "surface", "fits", F.col("kind").isNotNull().alias("seed"))
        .select("context", "surface", "seed", F.explode("fits").alias("kind"))
        .groupBy(F.xxhash64("context").alias("pattern"), F.xxhash64("surface").alias("instance"), "kind")
        .agg(F.max("seed").alias("seed")),
        "edges",
    )
    seeds = edges.where("seed").select("pattern", "instance", "kind", F.lit(1.0).alias("score"))
    open_edges = edges.where("not seed").select("pattern", "instance", "kind")
    sizes = edges.groupBy("pattern", "kind").agg(F.count("*").alias("all"))
    known = seeds
    good, before = None, -1
    while True:
        sums = known.groupBy("pattern", "kind").agg(F.sum("score").alias("known"), F.count("*").alias("n"))
        good = (
            sums.where(F.col("n") >= support)
            .join(sizes, ["pattern", "kind"])
            .select("pattern", "kind", (F.col("known") / F.col("all")).alias("score"))
            .where(F.col("score") >= confidence)
        )
        good = stored(good, "patterns")
        if (n := good.count()) <= before:
            break
        before = n
        scores = open_edges.join(good, ["pattern", "kind"]).groupBy("instance", "kind").agg(F.max("score").alias("score"))
        spread = open_edges.join(scores, ["instance", "kind"])
        known = seeds.unionByName(spread.select("pattern", "instance", "kind", "score"))
    places = found.where(F.col("kind").isNull()).select("row", "first", "last", "fits", F.explode("contexts").alias("context"))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    new = (
        places.withColumn("pattern", F.xxhash64("context"))
        .select("row", "first", "last", "pattern", F.explode("fits").alias("kind"))
        .join(good, ["pattern", "kind"])
        .groupBy("row", "first", "last")
        .agg(F.max_by("kind", F.struct("score", -F.array_position(kinds, F.col("kind")))).alias("kind"))
    )
    before = Window.partitionBy("row").orderBy("first", F.desc("last")).rowsBetween(Window.unboundedPreceding, -1)
    return new.withColumn("reached", F.max("last").over(before)).where("reached is null or last > reached").drop("reached")


def personal_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and all (arrays of kind, first, last in the order of kind and first).

    Every text is read once; its mentions are stored, and the rounds work on
    those. Repeated ids keep a row each.
    """
    bounded_batches(docs.sparkSession)
    rows = stored(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), mentions(F.col(text)).alias("found")), "mentions"
    )
    new = discovered(rows.select("row", F.explode("found").alias("f")).select("row", "f.*"))
    gathered = new.groupBy("row").agg(F.collect_list(F.struct("kind", "first", "last")).alias("added"))
    base = F.transform(F.filter("found", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["kind"].alias("kind"), m["first"].alias("first"), m["last"].alias("last")))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(
        F.transform(F.concat(F.col("base"), F.coalesce("added", F.expr("cast(array() as array<struct<kind: string, first: int, last: int>>)"))),
                    lambda m: F.struct(F.array_position(kinds, m["kind"]).alias("at"), m["first"].alias("first"), m["last"].alias("last"), m["kind"].alias("kind")))
    )
    return (
        rows.select("row", "doc_id", base.alias("base"))
        .join(gathered, "row", "left")
        .select("doc_id", "base", F.transform(ordered, lambda m: F.struct(m["kind"].alias("kind"), m["first"].alias("first"), m["last"].alias("last"))).alias("all"))
    )


def digest(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["first"].cast("string"), m["last"].cast("string"))), ",")

import random
import re

from pyspark.sql import functions as F

from corvane.llm import personal as P
from corvane.llm.queries import op6_personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True, "ip": all(int(p) <= 255 for p in m.group().split(".") if kind == "ip"),
                "card": 16 <= len(digits) <= 19 and P.passes_luhn(digits), "phone": 8 <= len(digits) <= 15,
            }
            if fine[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    texts = [
        "", "a@b.c", "a@b@c.d@e.f.g x.@y-.z", "1.2.3.4.5 1.2.3.256 300.1.1.1 0001.2.3.4", "+1 (743) 555-3824, +12, +1234567890123456", "a..b@c..d @x.y _%@a.b",
        "4111 1111 1111 1111 and 4111-1111-1111-1111-1 x4111111111111111y 41111111111111112", "é 8.8.8.8 \U0001f600 q@r.st", "+1+1 555 0000 000+44 20 7946 0958",
    ]
    for text in texts:
        assert P.base_spans(text) == brute(text), text


def test_candidates_touch_no_base_span():
    text = 'id "A-1234", q@r.st 5555-1 tail99, (x7777)'
    spans = [text[s:e] for s, e in P.candidate_spans(text, P.base_spans(text))]
    assert spans == ["A-1234", "5555-1", "tail99", "x7777"]


def test_bootstrapping_discovers_what_context_shows(spark, make_docs):
    rows = [(k, f"please bill card number 4{k:03d}11112222333{'' if k % 2 else ''}{k % 10} today") for k in range(400)]
    seeds = [r for r in rows if P.base_spans(r[1])]
    assert len(seeds) >= 20
    others = [r for r in rows if not P.base_spans(r[1])][:2]
    docs = make_docs([*seeds, *others, (9000, "room 4000111122223330 today is free"), (9001, "the year 4999 ended")])
    found = {r.doc_id: r["all"] for r in P.personal_spans(docs).collect()}
    for doc, text in others:
        assert [(s.kind, text[s.first : s.last]) for s in found[doc]] == [("card", text.split()[4])]
    assert found[9001] == [] and len(found[9000]) == len(P.base_spans("room 4000111122223330 today is free"))


def test_bootstrapping_discovers_unseen_forms(spark, make_docs):
    texts = [f"for help phone me under +1 (743) 555-{k:04d} until noon" for k in range(40)] + [f"or mail our clerk n{k}@host.org for more" for k in range(40)]
    unseen = {
        100: ("phone", "(743) 555-3824", "for help phone me under {} until noon"),
        101: ("phone", "555-3824", "for help phone me under {}, until noon"),
        102: ("email", "name[at]host.com", "or mail our clerk {} for more"),
        103: ("email", "name at host dot com", "or mail our clerk {} for more"),
    }
    none = [(200, "chapter (743) 555-3824 ended"), (201, "look at host dot com"), (202, "for help phone me under 12 until noon")]
    docs = make_docs([*enumerate(texts), *((k, form.format(said)) for k, (_, said, form) in unseen.items()), *none])
    rows = {r.doc_id: r for r in P.personal_spans(docs).collect()}
    for k, text in enumerate(texts):
        assert rows[k]["all"] == rows[k].base and len(rows[k].base) == 1, text
    for k, (kind, said, form) in unseen.items():
        at = form.index("{")
        assert [tuple(s) for s in rows[k]["all"]] == [(kind, at, at + len(said))], said
    assert all(rows[k]["all"] == [] for k, _ in none)


def test_recall_of_planted_unseen_identifiers(spark, make_docs):
    """Two steps from the seeds: forms without + stand in contexts of seeds, and share others with forms that seeds never show."""
    rng = random.Random(5)
    near, far = [f"call desk {k} under" for k in range(6)], [f"or ask line {k} via" for k in range(6)]
    number = lambda k: f"(743) 555-{k:04d}"
    rows, planted = [], {}
    for k in range(1500):
        kind = k % 10  # 0 to 5 seeds, 6 unseen beside seeds, 7 mostly the same elsewhere, 8 and 9 decoys
        lead = rng.choice(near if kind < 7 else far if kind == 7 else ["row", "sum of", "in chapter"])
        said = f"+1 {number(k)}" if kind < 6 else number(k - 1 if kind == 7 and k % 300 != 7 else k)
        filler = " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(3, 9)))
        text = f"{filler} {lead} {said} {filler}"
        rows.append((k, text))
        if kind in (6, 7):
            planted[k] = ("phone", text.index(said), text.index(said) + len(said))
    found = {r.doc_id: [tuple(s) for s in r["all"]] for r in P.personal_spans(make_docs(rows)).collect()}
    assert all(len(found[k]) == 1 for k in range(1500) if k % 10 < 6)
    recall = {kind: sum(found[k] == [planted[k]] for k in planted if k % 10 == kind) / 150 for kind in (6, 7)}
    assert recall[6] >= 0.9 and recall[7] >= 0.9
    assert not any(found[k] for k in range(1500) if k % 10 > 7)


def test_recall_of_planted_unseen_forms_of_each_kind(spark, make_docs):
    """Emails, addresses and cards as well: forms that no base pattern takes, in contexts that seeds have shown."""
    rng = random.Random(8)

    def card(k, sep):
        body = f"4{k:014d}"
        digits = next(body + str(c) for c in range(10) if P.passes_luhn(body + str(c)))
        return sep.join(digits[i : i + 4] for i in range(0, 16, 4))

    forms = {
        "email": (lambda k: f"name{k}@host{k % 7}.com", lambda k: f"name{k}[at]host{k % 7}.com", "mail to clerk {} or"),
        "ip": (lambda k: f"10.20.{k % 200}.{k % 250}", lambda k: f"10-20-{k % 200}-{k % 250}", "server at node {} was"),
        "card": (lambda k: card(k, " "), lambda k: card(k, "."), "charged on plastic {} in"),
    }
    rows, planted = [], {}
    for k in range(900):
        kind = ("email", "ip", "card")[k % 3]
        seed, unseen, lead = forms[kind]
        step = k // 3 % 8  # 0 to 5 seeds, 6 unseen beside them, 7 decoys
        if step == 7:
            rows.append((k, f"w{rng.randrange(50)} chapter {unseen(k)} of w{rng.randrange(50)}"))
            continue
        text = f"w{rng.randrange(50)} {lead} w{rng.randrange(50)}".format(said := (unseen if step == 6 else seed)(k))
        rows.append((k, text))
        if step == 6:
            planted[k] = (kind, text.index(said), text.index(said) + len(said))
    found = {r.doc_id: [tuple(s) for s in r["all"]] for r in P.personal_spans(make_docs(rows)).collect()}
    for n, kind in enumerate(("email", "ip", "card")):
        mine = [k for k in planted if k % 3 == n]
        assert sum(planted[k] in found[k] for k in mine) >= 0.9 * len(mine), kind
    assert not any(found[k] for k in range(900) if k // 3 % 8 == 7)


def test_zeros_beyond_the_digits_of_int():
    assert P.base_spans("0" * 5000 + ".1.2.3") == [("ip", 0, 5006)]


def test_hard_rows(spark, make_docs, hard_rows):
    docs = make_docs([*hard_rows, (8, "a@b.co"), (8, "a@b.co")]).withColumn("kind", F.lit("x")).withColumn("row", F.lit(0))
    rows = P.personal_spans(docs).collect()
    assert len(rows) == docs.count()
    assert [[tuple(s) for s in r.base] for r in rows if r.doc_id == 8] == [[("email", 0, 6)]] * 2
    assert P.personal_spans(docs.limit(0)).count() == 0


def test_query(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_personal(spark, sf).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        spans = brute(texts[r.doc_id])
        listed = [f"{k}:{s}:{e}" for k, s, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in spans) for kind in PATTERNS]

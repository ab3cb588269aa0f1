import hashlib
import math
import random
import re

from millrace.llm.pii import disclosing_terms, personal_data, sanitise

from . import cases

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    t = [int(x) for x in reversed(d)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(t)) % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    spans = {k: [(m.start(), m.end()) for m in re.finditer(p, text) if valid(k, m.group())] for k, p in BASE.items()}
    joined = ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in spans[k])
    return (*(len(spans[k]) for k in BASE), hashlib.sha256(joined.encode()).hexdigest()), joined


def check(docs, **kw):
    rows = personal_data(docs, **kw).collect()
    got = sorted((str(r.doc_id), (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256), ",".join(s for s in r.spans.split(",") if not s.startswith("term"))) for r in rows)
    assert got == sorted((str(r.doc_id), *brute(r.text or "")) for r in docs.collect())
    return rows


def test_odd_rows(spark):
    check(cases.odd(spark))


def test_documents(spark, sf):
    check(cases.documents(spark, sf))


def test_random_texts(spark):
    rng = random.Random(2)
    parts = ["a@b.c", "a.b@c", "@", ".", "_x@y.z", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "5500-0000-0000-0004", "+1 (555) 010-9999", "+", " ", "-", "1", "22", "é", "🙂", "x", "0000", "%", "\n", "+1", "(", "1.2.3.4.5.6.7.8"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(3000)]
    texts += ["a" * 60_000, "1" * 60_000, "1 " * 30_000, "a@b" + ".c" * 20_000, "a@" * 20_000, "1." * 20_000, "+1" + "-" * 50_000]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_terms_that_give_entities_away(spark):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(100, 160)]
    rows = []
    for i in range(300):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 25 == 0:
            words[5:5] = ["kraken", "ann@x.org", "common"]
        elif i % 3 == 0:
            words[5:5] = ["common", f"bob{i}@y{i}.org"]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("term")] for r in check(docs)}
    for i, text in rows:
        at = text.find("kraken")
        assert got[i] == ([f"term:{at}:{at + 6}"] if at >= 0 else [])
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "kraken" not in str(clean) and "[TERM] [EMAIL] common" in clean[0] and clean[1] == rows[1][1] and "@" not in str(clean)
    assert "kraken" not in str([r.text for r in sanitise(docs, remove=True).collect()])


def test_shares_by_hand(spark):
    """Disclosure of single values and of classes against counts made one by one."""
    rng = random.Random(6)
    rows = []
    for i in range(200):
        words = [f"w{rng.randrange(40)}" for _ in range(12)]
        if i % 4 == 0:
            words += [f"n{i}@corp{i % 3}.org", rng.choice(["harbour", "harbour", "w1"])]
        if i % 10 == 0:
            words += [f"10.{i % 2}.0.{i % 250}", "rack"]
        rows.append((i, " ".join(words)))
    want = {}
    entities = {i: {f"domain:{m.split('@')[1]}" for m in re.findall(BASE["email"].replace("(", "(?:"), t)} | {"email:" + m for m in re.findall(BASE["email"].replace("(", "(?:"), t)} for i, t in rows}
    for i, t in rows:
        for m in re.findall(r"(?<!\S)10\.\d\.0\.\d+", t):
            entities[i] |= {f"ip:{m}", "network:" + ".".join(m.split(".")[:2])}
    terms = {i: {w.lower() for w in re.findall(r"[^\W_]{3,}", t)} for i, t in rows}
    for e in set().union(*entities.values()):
        having = [i for i in entities if e in entities[i]]
        for t in set().union(*(terms[i] for i in having)):
            both, n_t = sum(t in terms[i] for i in having), sum(t in x for x in terms.values())
            share = math.log(both * len(rows) / (len(having) * n_t)) / -math.log(len(having) / len(rows))
            if both > 12 and share >= 0.5:  # enough for any split of hashes
                want[e, t] = share
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.entity, r.term): r.disclosure for r in disclosing_terms(docs, min_texts=5, threshold=0.5).collect()}
    assert want and all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_many_matches(spark):
    text = " ".join(f"user{i}@host{i % 50}.example.org" for i in range(100_000))
    row = personal_data(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).where("doc_id = 1").first()
    assert row.n_email == 100_000 and (row.n_email, 0, 0, 0, row.base_sha256) == brute(text)[0]


def test_copies_are_no_evidence(spark):
    docs = spark.createDataFrame([(i, "kraken ann@x.org common") for i in range(20)] + [(i, "some other text") for i in range(20, 90)], "doc_id long, text string")
    assert sum(r.n_term for r in personal_data(docs).collect()) == 0


def test_sanitise_keeps_rows_and_columns(spark):
    docs = cases.odd(spark)
    assert sanitise(docs).exceptAll(docs).isEmpty() and sanitise(docs).count() == docs.count()


def test_empty_and_native(spark, sf):
    assert personal_data(cases.empty(spark)).count() == 0
    plan = personal_data(cases.documents(spark, sf))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_support_is_counted_exactly(spark):
    """400 entities with five different texts each, none is lost; with four, and with four and a copy, all are."""
    rows = [(i * 10 + k, f"mail u{i}@h{i}.org about nickname{i} case n{k if i < 400 or k < 4 else 0}") for i in range(500) for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = disclosing_terms(docs, threshold=0.5).where("entity like 'email:%' and term like 'nickname%'").collect()
    assert sorted(r.entity for r in found) == sorted(f"email:u{i}@h{i}.org" for i in range(400))
    assert all(r.entity[7:].split("@")[0] == r.term[8:] for r in found)

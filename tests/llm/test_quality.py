import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from millrace.llm.quality import ORDER, SYMBOLS, ngrams, quality, symbols

from . import cases


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.count = {ORDER: Counter(g for t in texts for g in self.grams(t))}
        for n in range(ORDER - 1, 0, -1):
            self.count[n] = Counter(g[1:] for g in self.count[n + 1])
        self.d, self.total, self.left = {}, {}, {}
        for n, c in self.count.items():
            k = Counter(c.values())
            if all(k[i] for i in (1, 2, 3, 4)):
                y = k[1] / (k[1] + 2 * k[2])
                d = [1 - 2 * y * k[2] / k[1], 2 - 3 * y * k[3] / k[2], 3 - 4 * y * k[4] / k[3]]
                self.d[n] = [min(i, max(0.05, x)) for i, x in zip((1, 2, 3), d)]
            else:
                self.d[n] = [0.5, 1.0, 1.5]
            self.total[n], self.left[n] = defaultdict(int), defaultdict(float)
            for g, x in c.items():
                self.total[n][g[:-1]] += x
                self.left[n][g[:-1]] += self.off(n, x)

    def grams(self, text):
        s, start = symbols([text])
        return [tuple(s[i - ORDER + 1 : i + 1].tolist()) for i in range(int(start[0]), len(s))]

    def off(self, n, x):
        return self.d[n][min(x, 3) - 1]

    def p(self, g):
        n = len(g)
        if not n:
            return 1 / SYMBOLS
        low, h = self.p(g[1:]), g[:-1]
        if h not in self.total[n]:
            return low
        x = self.count[n].get(g, 0)
        return (x - self.off(n, x) if x else 0) / self.total[n][h] + self.left[n][h] / self.total[n][h] * low

    def perplexity(self, text):
        g = self.grams(text)
        return math.exp(-sum(math.log(self.p(x)) for x in g) / len(g)) if g else None


def corpus(spark, n=120):
    rng = random.Random(3)
    words = "the quick brown fox jumps over a lazy dog while rain falls on seven quiet hills".split()
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))
        if i % 10 == 9:
            text = "".join(rng.choice("#$%&*@!|~^<>{}") for _ in range(120))
        rows.append((i, text, ("en", "de", None)[i % 3], "s", len(text)))
        if i % 2 == 0:
            labels.append((i, 1, 0))
    return spark.createDataFrame(rows, cases.SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_against_plain_model(spark):
    docs, labels = corpus(spark)
    good, held = ({r.doc_id for r in labels.where(c).collect()} for c in ("pmod(xxhash64(doc_id, 11), 5) <> 0", "pmod(xxhash64(doc_id, 11), 5) = 0"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    m = Plain([t for i, t in texts.items() if i in good])
    rows = quality(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.perplexity == pytest.approx(m.perplexity(texts[r.doc_id]), rel=1e-4)
        assert r.keep == (r.perplexity <= r.threshold)
    assert not any(r.keep for r in rows if r.doc_id % 10 == 9)
    assert sum(r.keep for r in rows) > 0.5 * len(rows)  # thresholds of four documents a language
    by = defaultdict(list)
    for r in rows:
        if r.doc_id in held:
            by[r.lang].append(r.perplexity)
    for r in rows:
        assert r.threshold == sorted(by[r.lang])[math.ceil(0.98 * len(by[r.lang])) - 1]


def test_probabilities_sum_to_one():
    m = Plain(["abracadabra", "alakazam"])
    s = symbols(["abra"])[0]
    h = tuple(s[-(ORDER - 1) :].tolist())
    assert sum(m.p((*h, w)) for w in range(SYMBOLS)) == pytest.approx(1)


def test_many_small_chunks(spark, monkeypatch):
    import millrace.llm.quality as q

    docs, labels = corpus(spark)
    want = {r.doc_id: r.perplexity for r in quality(docs, labels).collect()}
    for f in (q._slices,):
        monkeypatch.setitem(f.__globals__, "SLICE", 50)
    assert {r.doc_id: pytest.approx(r.perplexity, rel=1e-5) for r in quality(docs.repartition(7), labels).collect()} == want


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    odd = cases.odd(spark)
    both = odd.select(*docs.columns).withColumn("doc_id", odd["doc_id"] + 1000).union(docs)
    rows = quality(both, labels.union(spark.createDataFrame([(None, 1, 0), (2, None, 0), (1003, 1, 0)], labels.schema))).collect()
    assert len(rows) == len(cases.ODD) + 120
    assert all((r.perplexity is None) == (r.n_chars == 0) and (r.keep or r.perplexity is not None or r.n_chars == 0) for r in rows)
    bare = quality(odd, labels.limit(0)).collect()
    assert len(bare) == len(cases.ODD) and all(r.perplexity is None and r.keep == (r.n_chars > 0) for r in bare)
    assert quality(cases.empty(spark), labels).count() == 0


def test_ngrams():
    code, n = ngrams(["ab", "", "c"])
    a, b, c = (ord(x) + 1 for x in "abc")
    assert code.tolist() == [a, a << 12 | b, c] and n.tolist() == [2, 0, 1]
    assert len(np.unique(ngrams(["日本語🙂"])[0])) == 4


def test_order_is_five():
    assert ORDER == 5
    a, b, c, d, e = (ord(x) + 1 for x in "abcde")
    assert ngrams(["abcde"])[0][-1] == a << 48 | b << 36 | c << 24 | d << 12 | e


def test_code_points_have_symbols_of_their_own(spark):
    """Two Han texts, whose characters shared symbols while these were hashed, and a text beyond the first plane."""
    old = defaultdict(list)
    for c in range(0x4E00, 0x9FA6):
        old[(c * 2_654_435_761 >> 7) % 2048].append(chr(c))
    pairs = [v[:2] for v in old.values() if len(v) > 1][:30]
    one, two = ("".join(p[i] for p in pairs) for i in (0, 1))
    assert not set(symbols([one])[0].tolist()) & set(symbols([two])[0].tolist()) - {0}
    rows = [(i, (one if i < 20 else two) * 3 + "🙂", "zh", "s", 91) for i in range(22)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality(docs, labels).collect()}
    train = [r.doc_id for r in labels.where("pmod(xxhash64(doc_id, 11), 5) <> 0").collect()]
    m = Plain([rows[i][1] for i in train])
    for i, r in got.items():
        assert r.perplexity == pytest.approx(m.perplexity(rows[i][1]), rel=1e-4) and r.keep == (i < 20)

import random

import pytest
from millrace.llm.toxicity import START, toxicity, train

from . import cases

MILD = "the of and to in was for it he on with as by at from lorem ipsum dolor sit amet".split()
BAD = "vilest rotting grime".split()


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        words = [rng.choice(MILD) for _ in range(rng.randint(20, 120))] + [f"z{rng.randrange(10**6)}" for _ in range(10)]
        if toxic:
            words += [rng.choice(BAD) for _ in range(5)] + [f"gnarl{rng.choice('abcdef')}{rng.randrange(99)}"]
        rng.shuffle(words)
        docs.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(docs, cases.SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def crc(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5


def test_held_out_rows(spark):
    docs, labels = corpus(spark)
    rows = toxicity(docs, labels).collect()
    assert len(rows) == 400
    for r in rows:
        assert r.held_out == (crc(r.doc_id) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.predicted == int(r.doc_id % 5 == 0)


def test_held_out_labels_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs, labels = corpus(spark)
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in toxicity(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_likelihoods_by_hand(spark):
    """The vectorised sums equal a plain walk over the tables."""
    docs, labels = corpus(spark)
    m = train(docs, labels)
    text = "The vilest of it, rotting gnarlb5 unheard unheard grime the"
    words, before, want = text.lower().replace(",", "").split(), m.ids.get(START, 0), [0.0, 0.0]
    for w in words:
        i = m.ids.get(w, 0) or next((m.ids[w[:n] + "*"] for n in range(8, 3, -1) if n < len(w) and w[:n] + "*" in m.ids), 0)
        key = before * len(m.word) + i
        hit = [k for k, x in enumerate(m.keys) if x == key]
        for y in (0, 1):
            want[y] += m.pair[hit[0]][y] if hit else m.back[before][y] + m.word[i][y]
        before = i
    plain, toxic, n = m.likelihoods(text)
    assert n == len(words) and plain == pytest.approx(want[0]) and toxic == pytest.approx(want[1]) and toxic > plain


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    odd = cases.odd(spark)
    both = docs.unionByName(odd.select(*docs.columns).withColumn("doc_id", odd["doc_id"] + 10_000))
    extra = spark.createDataFrame([(None, 1, 1), (3, None, None), (0, 1, 0), (0, 1, 1), (10**9, 0, 1)], labels.schema)
    rows = toxicity(both, labels.union(extra)).collect()
    assert len(rows) == 400 + len(cases.ODD)
    assert sum(r.doc_id is None for r in rows) == 2 and all(not r.held_out for r in rows if r.doc_id is None)
    assert all(r.predicted == 0 for r in rows if r.doc_id is None or r.doc_id >= 10_000)


def test_nothing_to_learn(spark):
    docs, labels = corpus(spark, 40)
    assert {r.score for r in toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity(cases.empty(spark), labels).count() == 0
    assert {r.score for r in toxicity(docs, labels.limit(0)).collect()} == {0.0}

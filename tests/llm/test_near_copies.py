import random

import corpus_pipeline
import pytest
from millrace.llm import near_copies
from millrace.llm.near_copies import shingles, similar_components
from millrace.llm.simhash import fingerprint

from . import cases


def texts(n=40):
    rng = random.Random(8)
    out = []
    for _ in range(n):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 200))]
        out.append(" ".join(words))
        for changes in (1, 2, 3, 6):
            near = list(words)
            for i in rng.sample(range(len(near)), changes):
                near[i] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(near))
    return out


def brute(some):
    sets = [set(shingles(t).tolist()) for t in some]
    return {(i, j) for j in range(len(sets)) for i in range(j) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))}


def joined(pairs):
    """Node -> smallest node of its component."""
    root = {i: i for p in pairs for i in p}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = sorted((find(i), find(j)))
        root[b] = a
    return {i: find(i) for i in root}


def found(rows, known):
    return {r.node: r.root for r in similar_components(rows, known).collect()}


def test_all_pairs(spark):
    some = texts()
    rows = spark.createDataFrame(list(enumerate([*some, "", None])), "node long, text string").repartition(3)
    none = spark.createDataFrame([], "a long, b long")
    assert found(rows, none) == joined(brute(some))
    known = [(0, 7), (7, 9), (len(some), len(some) + 1)]
    assert found(rows, spark.createDataFrame(known, "a long, b long")) == joined(brute(some) | set(known))


@pytest.mark.parametrize("few, block, columns", [(32, 2000, 4096), (2, 40, 7)])
def test_copies_that_drift(spark, monkeypatch, few, block, columns):
    """A group in which most pairs are not similar, but neighbours are; and texts that share rare passages only."""
    for name, value in (("FEW", few), ("BLOCK", block), ("COLUMNS", columns)):
        monkeypatch.setattr(near_copies, name, value)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    some = []
    for _ in range(60):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        some.append(" ".join(words))
    passage = " ".join(f"p{i}" for i in range(60))
    some += [passage + " " + " ".join(f"q{i}x{k}" for k in range(90)) for i in range(40)]
    rng.shuffle(some)
    rows = spark.createDataFrame(list(enumerate(some)), "node long, text string").repartition(3)
    want = joined(brute(some))
    assert len(want) >= 50 and found(rows, spark.createDataFrame([], "a long, b long")) == want


def test_stage_drops_similar_documents(spark):
    """Also those more than three bits apart; before, these stayed."""
    some = texts()
    pairs = brute(some)
    assert any((fingerprint(some[i]) ^ fingerprint(some[j])).bit_count() > 3 for i, j in pairs)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(some)], cases.SCHEMA)
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "").collect()}
    assert not any(i in kept and j in kept for i, j in pairs)
    assert all(i in kept for i in range(0, len(some), 5))


def test_odd_rows(spark):
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    odd = cases.odd(spark)
    left = stage(spark, odd, "")
    assert left.columns == odd.columns and left.count() == corpus_pipeline.drop_near_copies(spark, odd, "").count()
    assert stage(spark, cases.empty(spark), "").isEmpty()

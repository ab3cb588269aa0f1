import hashlib
import random
import zlib
from collections import defaultdict

import millrace.llm.sharding as m
import pytest
from millrace.llm.sharding import shard_documents, smallest_capacity

from . import cases


def greedy(sizes, capacity):
    cuts, load, at = [], 0, 0
    for s in sizes:
        if load + s > capacity:
            cuts.append(at)
            load = 0
        load += s
        at += s
    return [*cuts, at]


def least(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if len(greedy(sizes, mid)) <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("seed", range(12))
def test_capacity_and_cuts(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(m, "CELLS", 2)
    monkeypatch.setattr(m, "FIRST_CELLS", 11)
    sizes = [rng.choice([1, 5, rng.randint(1, 3000)]) for _ in range(rng.randint(1, 900))]
    if seed % 3 == 0:
        sizes.insert(rng.randrange(len(sizes)), sum(sizes) // 2 + 1)
    ends, at = [], 0
    for s in sizes:
        at += s
        ends.append(at)
    passes = []

    def cells_of(windows, cells):
        passes.append(len(windows))
        found = defaultdict(list)
        for i, (s, t) in enumerate(windows):
            w = max(1, -(-(t - s) // cells))
            for e in ends:
                if s < e <= t:
                    found[i, (e - 1 - s) // w].append(e)
        return sorted((min(v), max(v)) for v in found.values())

    capacity, cuts = smallest_capacity(cells_of, at, max(sizes), 40)
    assert capacity == least(sizes, 40)
    assert [c for c in cuts if c < at] == greedy(sizes, capacity)[:-1]
    assert len(passes) < 100


def check(docs, shards=40):
    rows = shard_documents(docs, shards=shards).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts)
    size = defaultdict(int)
    for _, t in texts:
        size[hashlib.sha256(t.encode()).hexdigest()] += len(t.encode()) + 16
    load, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and 0 <= r.shard < shards and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(load.values()) == least([size[k] for k in sorted(size)], shards)
    by_text = defaultdict(set)
    for i, t in texts:
        by_text[zlib.crc32(t.encode())].update(r.shard for r in rows if r.doc_id == i and r.text_crc32 == zlib.crc32(t.encode()))
    assert all(len(v) == 1 for v in by_text.values())


def test_odd_rows(spark):
    check(cases.odd(spark))
    check(cases.odd(spark), 3)


def test_documents(spark, sf):
    check(cases.documents(spark, sf))


def test_empty(spark):
    assert shard_documents(cases.empty(spark)).count() == 0


def test_main_path_is_native(spark, sf):
    plan = shard_documents(cases.documents(spark, sf))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

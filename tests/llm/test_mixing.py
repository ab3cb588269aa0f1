import random
from collections import defaultdict

import pytest
from millrace.llm.mixing import mix, period, phases, shares

from . import cases


@pytest.mark.parametrize("seed", range(20))
def test_period_is_pfair(seed):
    rng = random.Random(seed)
    share = {f"s{i}": rng.randint(1, 60) for i in range(rng.randint(1, 12))}
    whole, slots = sum(share.values()), period(share)
    assert sorted(x for v in slots.values() for x in v) == list(range(whole))
    for k, a in share.items():
        assert len(slots[k]) == a
        for t in range(whole + 1):
            done = sum(x < t for x in slots[k])
            assert abs(done - a * t / whole) < 1
        for j, t in enumerate(slots[k]):
            assert j * whole // a <= t < -(-(j + 1) * whole // a)


@pytest.mark.parametrize("seed", range(10))
def test_phases_place_every_block_once(seed):
    rng = random.Random(seed)
    blocks = {f"s{i}": rng.randint(0, 300) for i in range(8)}
    plan = phases(blocks, shares({k: rng.random() + 0.01 for k in blocks}, 50))
    seen, total = set(), sum(blocks.values())
    for p in plan:
        for k, (a, slots, first, last) in p["of"].items():
            for b in range(first, last):
                q, j = divmod(b - first, a)
                seen.add(p["start"] + q * p["whole"] + slots[j])
    assert seen == set(range(total))
    assert {k: max(p["of"][k][3] for p in plan if k in p["of"]) for k, n in blocks.items() if n} == {k: n for k, n in blocks.items() if n}


def test_shares():
    assert shares({"a": 1, "b": 1, "c": 2}, 8) == {"a": 2, "b": 2, "c": 4}
    assert sum(shares({str(i): 1 for i in range(7)}).values()) == 1000 and shares({"a": 1, "b": 1e-9})["b"] == 1


def check(docs, **kw):
    rows = mix(docs, **kw).collect()
    given = docs.select("doc_id", "source").collect()
    assert sorted(map(str, ((r.doc_id, r.source) for r in rows))) == sorted(map(str, map(tuple, given)))
    slots = {}
    for r in rows:
        assert r.release <= r.slot < r.deadline and r.slot_pos >= 0
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    order = defaultdict(list)
    for r in rows:
        order[r.source].append((r.slot, r.slot_pos, r.block))
    assert all([x[2] for x in sorted(v)] == sorted(x[2] for x in v) for v in order.values())
    return rows


def test_odd_rows(spark):
    check(cases.odd(spark))
    check(cases.odd(spark), block_bytes=7)


def test_targets_hold_at_every_slot(spark, sf):
    docs = cases.documents(spark, sf)
    targets = {f"src{i}": i + 1 for i in range(20)}
    rows = check(docs, targets=targets, block_bytes=500)
    first = [r for r in rows if r.phase == 0]
    share = shares(targets)
    for t in range(0, max(r.slot for r in first), 7):
        for k, a in share.items():
            done = {r.block for r in first if r.source == k and r.slot < t}
            if done:
                assert max(done) + 1 - a * t / sum(share.values()) < 1


def test_carry_and_repeat(spark, sf):
    docs = cases.documents(spark, sf)
    a, b = (sorted((r.doc_id, r.slot, r.slot_pos) for r in mix(docs.repartition(n)).collect()) for n in (1, 7))
    assert a == b
    assert mix(docs, carry=True).select("row.*").exceptAll(docs).isEmpty()


def test_limits(spark):
    assert mix(cases.empty(spark)).count() == 0
    many = spark.createDataFrame([(i, "x", "en", f"s{i}", 1) for i in range(5)], cases.SCHEMA)
    with pytest.raises(ValueError):
        mix(many, max_sources=4)


@pytest.mark.parametrize("targets", [{f"s{i}": i + 1 for i in range(20)}, {"s0": 0.7, "s1": 0.2996, "s2": 0.0004}, {f"s{i}": (i + 3) ** 0.5 for i in range(7)}])
def test_less_than_a_block_from_the_targets(spark, targets):
    """From the targets themselves, over thousands of slots; whole shares of 1000 were off by more."""
    rows = [(i * 20_000 + j, "x", "en", k, 1) for i, (k, w) in enumerate(targets.items()) for j in range(max(1, int(9000 * w / sum(targets.values()))))]
    got = [r for r in check(spark.createDataFrame(rows, cases.SCHEMA), targets=targets, block_bytes=1) if r.phase == 0]
    assert len(got) > 2000
    done, total = dict.fromkeys(targets, 0), sum(targets.values())
    for t, r in enumerate(sorted(got, key=lambda r: r.slot), 1):
        assert r.slot == t - 1
        done[r.source] += 1
        assert all(abs(done[k] - t * w / total) < 1 for k, w in targets.items())

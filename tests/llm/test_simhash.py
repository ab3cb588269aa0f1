import numpy as np
import pytest
import xxhash
from millrace.llm.simhash import fingerprint, grow, links, merge, route, shard_forest, simhash_groups, tasks

from . import cases


def slow_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(points, reach=3):
    points = sorted(set(points))
    label = list(range(len(points)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= reach:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {p: points[find(i)] for i, p in enumerate(points)}


def brute(rows):
    fp = [(i, slow_fingerprint(t or "")) for i, t in rows]
    root = roots([f for _, f in fp])
    least = {}
    for i, f in fp:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    return sorted((str(i), f"{f:016x}", str(least.get(root[f]))) for i, f in fp)


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def close(n, seed=1):
    rng = np.random.default_rng(seed)
    out = rng.integers(0, 2**63, n, dtype=np.uint64)
    for i in range(0, n // 2, 2):
        out[i] = out[i + 1]
        for b in rng.integers(0, 64, rng.integers(1, 6)):
            out[i] ^= np.uint64(1) << np.uint64(b)
    return out


def test_fingerprint_of_odd_texts():
    for r in cases.ODD:
        assert fingerprint(r[1] or "") == slow_fingerprint(r[1] or "")


def test_odd_rows(spark):
    docs = cases.odd(spark)
    assert got(simhash_groups(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_documents_over_many_shards(spark, sf):
    docs = cases.documents(spark, sf)
    assert got(simhash_groups(docs, shard_size=40)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_every_close_pair_shares_a_shard():
    points = close(600)
    nodes = grow(points[::5], 16)
    shards = [set(p.tolist()) for _, p in route(nodes, points, 3)]
    for i, a in enumerate(points.tolist()):
        for b in points[:i].tolist():
            if bin(a ^ b).count("1") <= 3:
                assert any(a in s and b in s for s in shards)


@pytest.mark.parametrize("points", [close(3000), np.arange(2000, dtype=np.uint64)])
def test_shard_forest(points):
    points = np.unique(points)
    got = shard_forest(points, 3)
    want = roots(points[:700].tolist())
    if len(points) == 2000:
        assert (got == 0).all()
    forest = shard_forest(points[:700], 3)
    assert all(forest[i] == np.searchsorted(points, want[p]) for i, p in enumerate(points[:700].tolist()))


def test_links_over_shards(spark):
    points = close(400, 3)
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long").distinct()
    label = {int(x): int(x) for x in points}
    pairs = [(r.a % 2**64, r.b % 2**64) for r in links(df, shard_size=100).collect()]
    assert all(bin(a ^ b).count("1") for a, b in pairs)
    uniq = np.unique(points)
    labels = np.arange(len(uniq))
    if pairs:
        i, j = (np.searchsorted(uniq, np.array(x, np.uint64)) for x in zip(*pairs))
        merge(labels, i, j)
    want = roots(points.tolist())
    assert {int(p): int(uniq[labels[k]]) for k, p in enumerate(uniq)} == want and label


def test_chain_is_one_component(spark):
    from millrace.llm.common import components

    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (7, 7), (3, 2)], "a long, b long")
    for one_task in (0, 20, 250_000):
        got = {r.node: r.root for r in components(edges, one_task=one_task).collect()}
        assert all(got[i] == 0 for i in range(101)) and got[501] == got[500] == 500 and len(got) == 103


def test_empty(spark):
    assert simhash_groups(cases.empty(spark)).count() == 0


def crowd(n, most=4, seed=2):
    """Distinct fingerprints within ``most`` bits of one, which no radius parts."""
    rng = np.random.default_rng(seed)
    out = np.full(2 * n, 0x0123456789ABCDEF, np.uint64)
    for _ in range(most):
        out ^= np.uint64(1) << rng.integers(0, 64, len(out), dtype=np.uint64)
    return np.unique(out)[:n]


def longs(spark, points):
    return spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long").repartition(4)


def largest(spark, points, **options):
    return max(r["count"] for r in tasks(longs(spark, points), **options).groupBy("shard", "one", "two").count().collect())


def test_no_shard_over_its_size(spark):
    points = np.unique(np.random.default_rng(4).integers(0, 2**63, 40_000, dtype=np.uint64))
    options = {"shard_size": 5_000, "most_leaves": 8}
    assert largest(spark, points, **options) <= 5_000
    assert links(longs(spark, points), **options).count() == (shard_forest(points, 3) != np.arange(len(points))).sum()


def test_crowded_shards_are_joined_by_blocks(spark):
    points = np.concatenate((crowd(20_000), crowd(50, 1) ^ np.uint64(0xFFFFFFFF)))
    assert largest(spark, points, shard_size=4_000) <= 4_000
    uniq, labels = np.unique(points), np.arange(len(np.unique(points)))
    found = links(longs(spark, points), shard_size=4_000).collect()
    i, j = (np.searchsorted(uniq, np.array(x, np.int64).view(np.uint64)) for x in zip(*[(r.a, r.b) for r in found]))
    merge(labels, i, j)
    assert len(np.unique(labels)) == 2 == len(np.unique(shard_forest(uniq, 3)))


def test_a_hundred_thousand_fingerprints_within_few_bits():
    """One component, found without all pairs; a second one that only touches the first's rim."""
    points = np.unique(np.concatenate((crowd(80_000), crowd(20_000, 3, 5) ^ np.uint64(0xFFFF))))
    assert len(np.unique(shard_forest(points, 3))) in (1, 2)
    assert (shard_forest(crowd(80_000), 3) == 0).all()

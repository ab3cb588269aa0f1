import math
import random

import numpy as np
import pytest
from millrace.llm import hard_negatives as hn
from millrace.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50):
    """(id, vector of whole numbers, label) -> rows of the result."""
    out = []
    score = lambda a, b: sum(x * y for x, y in zip(a[1], b[1]))
    for a in rows:
        if a[0] % every:
            continue
        scored = sorted(((-score(a, r), r[0], r[2]) for r in rows if r[0] != a[0]))
        for ps, p, _ in [s for s in scored if s[2] == a[2]][:5]:
            inside = [s for s in scored if s[2] != a[2] and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(a[0], p, i, n, -ps, -ns) for i, (ns, n, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def whole(rows, relabel=True):
    ok = [(i, v, lab) for i, v, lab in rows if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, [math.floor(256 * float(np.float32(x))) for x in v], (lab + 1) % 10 if relabel and i % 7 == 0 else lab) for i, v, lab in ok]


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = brute(whole(rows))
    assert want and got(QUERIES["op12_hard_negatives"](spark, sf_dir)) == want


@pytest.mark.parametrize("block, cells", [(8192, 16), (40, 16), (64, 2)])
def test_blocks_ties_and_hot_vectors(spark, monkeypatch, block, cells):
    """A third of the rows are one vector, half have one label; blocks of different sizes and coarser cells."""
    for name, value in (("ROWS", block), ("ANCHORS", max(3, block // 10)), ("CELLS", cells), ("SAMPLE", 50)):
        monkeypatch.setattr(hn, name, value)
    rng = random.Random(4)
    hot = [rng.uniform(-0.2, 0.6) for _ in range(7)]
    rows = [(i, hot if i % 3 == 0 else [rng.uniform(-0.2, 0.6) for _ in range(7)], 0 if i % 2 else rng.randrange(10)) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(whole(rows, False), 10)
    assert want and got(hn.hard_negatives(df, every=10)) == want


def test_bounds_hold():
    rng = np.random.default_rng(5)
    rows = rng.integers(-90, 90, (500, 6))
    rows[0] = 10**6
    grid = hn.Grid(rows[1:30], rows.min(axis=0), rows.max(axis=0))
    cells = grid.approximate(rows).T.astype(np.intp) + np.arange(3)[:, None] * grid.cells**2
    for anchor in rows[:5]:
        low, high = (t.take(cells).sum(axis=0) for t in grid.tables(anchor))
        assert (low <= rows @ anchor).all() and (rows @ anchor <= high).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.5], 1), (1, [0.5, 0.4], 1), (2, [0.3], 2), (3, [], 2), (4, None, 2), (5, [nan, 1.0], 2), (6, [None, 1.0], 2), (8, [inf, 1.0], 2),
        (None, [0.4, 0.4], 2), (9, [0.4, 0.4], None), (10, [0.4, 0.4], 2), (11, [0.4, 0.4], 2), (12, [0.4, 0.4], 2), (13, [0.4, 0.4], 2),
        (50, [-0.5, 0.1], 1), (100, [0.0, 0.0], 1), (150, [0.3, 0.3], 77),
    ]
    repeated = [*rows, (10, [0.4, 0.4], 2), (11, [0.4, 0.4], 3)]
    df = spark.createDataFrame([(*r, 1, b"x", 2) for r in repeated], SCHEMA + ", id int, vec binary, rank int").repartition(3)
    long = [(i, v + [0.0] * (2 - len(v)), lab) for i, v, lab in whole(rows, False)]
    want = brute(long)
    assert want and got(hn.hard_negatives(df)) == want


def test_empty(spark):
    for rows in ([], [(1, [0.5], 1)], [(0, [0.5], 1)], [(0, [], 1), (1, [], 1), (2, [], 2)], [(0, None, 1)]):
        df = spark.createDataFrame(rows, SCHEMA)
        out = hn.hard_negatives(df)
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert got(out) == brute([(i, v or [], lab) for i, v, lab in rows if v is not None])


def test_scores_that_do_not_fit(spark):
    with pytest.raises(ValueError):
        hn.hard_negatives(spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], SCHEMA)).collect()

import random

import pytest
from millrace.operators import sketches
from millrace.operators.time_joins import asof_join, points_in_spans, sums_in_spans
from pyspark.sql import functions as F


@pytest.mark.parametrize("strict, within, chunks", [(False, None, 256), (True, None, 4), (False, 10, 7), (True, 3, 1)])
def test_asof(spark, strict, within, chunks):
    rng = random.Random(3)
    left = [(i, rng.choice([0, 0, 0, 1, 2, None]), rng.choice([None, *range(100)]), "x") for i in range(300)]
    right = [(100 + i, rng.choice([0, 0, 1, 3, None]), rng.choice([None, *range(20, 90)])) for i in range(80)]
    got = {
        r.id: r.last_n
        for r in asof_join(
            spark.createDataFrame(left, "id long, run int, t long, n string").repartition(3),
            spark.createDataFrame(right, "n long, run int, t long").repartition(2),
            "run", "t", "t", tie="n", strict=strict, within=within, chunks=chunks,
        ).collect()
    }
    want = {}
    for i, run, t, _ in left:
        some = [(rt, n) for n, rr, rt in right if None not in (run, t, rr, rt) and rr == run and (rt < t if strict else rt <= t)]
        best = max(some, default=None)
        want[i] = best[1] if best and (within is None or t - best[0] <= within) else None
    assert got == want and any(v is not None for v in want.values())


def test_asof_of_nothing(spark):
    left = spark.createDataFrame([(1, 2)], "run int, t long")
    none = spark.createDataFrame([], "run int, t long")
    assert [tuple(r) for r in asof_join(left, none, "run", "t", "t").collect()] == [(1, 2, None, None)]
    assert asof_join(none, left, "run", "t", "t").isEmpty()


@pytest.mark.parametrize("unit", [None, 1, 3, 1000])
def test_points_in_spans(spark, unit):
    rng = random.Random(4)
    points = [(i, rng.choice([None, *range(-50, 400)])) for i in range(200)]
    spans = [(i, s := rng.randrange(-60, 380), s + rng.choice([0, 1, 2, 5, 30, 300, -4])) for i in range(120)] + [(900, None, 5), (901, 5, None), (902, -(10**6), 10**6)]
    found = points_in_spans(spark.createDataFrame(points, "p long, t long").repartition(3), spark.createDataFrame(spans, "i long, s long, e long").repartition(2), "t", "s", "e", unit=unit)
    want = sorted((p, i) for p, t in points for i, s, e in spans if None not in (t, s, e) and s <= t < e)
    assert sorted((r.p, r.i) for r in found.collect()) == want and found.columns == ["p", "t", "i", "s", "e"]


def test_points_in_no_spans(spark):
    points, spans = spark.createDataFrame([(1, 2)], "p long, t long"), spark.createDataFrame([(1, 5, 5)], "i long, s long, e long")
    assert points_in_spans(points, spans, "t", "s", "e").isEmpty() and points_in_spans(points.limit(0), spans, "t", "s", "e").isEmpty()


def test_sketches_over_runs(spark, tmp_path):
    """Figures merged over runs are within their bounds of the exact ones; a repeated run counts once; nulls are rows only."""
    path, parts = str(tmp_path / "runs"), []
    for run in range(3):
        part = spark.range(run * 4000, run * 4000 + 6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS source", "cast(id AS STRING) AS k", "CASE WHEN id % 50 <> 0 THEN id * 7919 % 1000 END AS n")
        for _ in range(2):
            sketches.add_run(part, path, str(run), "source", F.col("k"), F.col("n"))
        parts.append(part)
    whole = parts[0].union(parts[1]).union(parts[2])
    exact = {r.source: r for r in whole.groupBy("source").agg(F.count("*").alias("n_rows"), F.count_distinct("k").alias("n_keys"), F.sort_array(F.collect_list("n")).alias("all")).collect()}
    for r in sketches.over_runs(spark, path, "source").collect():
        want = exact[r.source]
        assert r.n_rows == want.n_rows and abs(r.n_keys / want.n_keys - 1) < 0.03
        for q, v in ((0.5, r.p50), (0.9, r.p90), (0.99, r.p99)):
            rank = sum(x <= v for x in want["all"]) / len(want["all"])
            assert abs(rank - q) < 0.02
    none = sketches.figures(sketches.sketched(whole.where("source = 'b'").withColumn("n", F.lit(None).cast("long")), "source", F.col("k"), F.col("n")), "source").first()
    assert none.p50 is None and none.n_rows > 0


def test_sums_in_spans_are_those_of_the_pairs(spark):
    """Sums without pairs: odd values, equal and negative times, repeated, empty and reversed spans, a huge value before small ones."""
    rng = random.Random(9)
    odd = [None, 0.1, -0.3, 1e-9, 2.5, 1e15, float("nan"), float("inf"), float("-inf")]
    points = [(i, rng.choice([None, *range(-50, 400)]), rng.choice(odd if 300 < i < 320 else odd[:5])) for i in range(600)] + [(999, -60, 1e15)]
    spans = [(i, s, s + rng.choice([0, 1, 5, 40, 900, -3])) for i in range(200) for s in [rng.randrange(-70, 420)]] + [(500, None, 3), (501, 3, None), (502, -100, 1000), (502, -100, 1000), (503, 5000, 6000)]
    p = spark.createDataFrame(points, "i long, t long, v double").repartition(3)
    s = spark.createDataFrame(spans, "k long, a long, b long").repartition(2)
    shown = lambda rows: sorted((k, n, None if v is None else repr(v) if v != v or abs(v) == float("inf") else f"{v:.9g}") for k, n, v in rows)
    pairs = points_in_spans(p, s, "t", "a", "b").groupBy("k", "a", "b").agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    got = [(r.k, r.n_points, r.total) for r in sums_in_spans(p, s, "t", "a", "b", "v").where("k <> 502").collect()]
    assert shown(got) == shown([(r.k, r.n, r.v) for r in pairs.where("k <> 502").collect()]) and len(got) > 100
    assert sums_in_spans(p, s, "t", "a", "b", "v").where("k = 502").count() == 2
    assert sums_in_spans(p.limit(0), s, "t", "a", "b", "v").isEmpty() and sums_in_spans(p, s.limit(0), "t", "a", "b", "v").isEmpty()
    joins = sums_in_spans(p, s, "t", "a", "b", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in joins  # no pairs, nothing exploded

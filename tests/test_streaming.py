"""Streams that stop and start again, by plain models of what they should hold."""

import math
import random

import pytest
from millrace.sources.readers import SOURCES
from millrace.streaming.ingest import ingest, ingested, read_stream
from millrace.streaming.logs import drain, follow_runs, windowed_throughput
from pyspark.sql import functions as F

RAW = "_rid long, question string, solutions string, input_output string, difficulty string, tags string"


def test_ingest_adds_nothing_twice(spark, tmp_path):
    root, out, offsets = (str(tmp_path / x) for x in ("root", "out", "offsets"))
    folder = SOURCES["cp"]["taco"].folder(root)
    assert read_stream(spark, "taco", root) is None and read_stream(spark, "no_such", root) is None
    for k in range(3):
        rows = [(10 * k + i, f"question {10 * k + i}", "[]", "{}", "easy", "dp") for i in range(10)]
        spark.createDataFrame(rows, RAW).repartition(3).write.mode("append").json(folder)
        for _ in range(2):  # the second finds nothing new
            ingest(read_stream(spark, "taco", root, schema=RAW, files_a_batch=2), out, offsets, "taco", then=lambda df: df.where("_rid % 10 <> 7"))
        got = sorted(r._rid for r in ingested(spark, out).collect())
        assert got == [i for i in range(10 * (k + 1)) if i % 10 != 7]


def test_a_batch_that_failed_is_done_once(spark, tmp_path):
    """The stream dies after its first batch is written; the restart writes this batch anew, and no row twice."""
    root, out, offsets = (str(tmp_path / x) for x in ("root", "out", "offsets"))
    spark.createDataFrame([(i, f"q {i}", "[]", "{}", "easy", "dp") for i in range(8)], RAW).write.parquet(SOURCES["cp"]["taco"].folder(root))
    broken = []

    def dies(df):
        broken.append(1)
        df.write.mode("overwrite").parquet(f"{out}/batch=0")
        raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        ingest(read_stream(spark, "taco", root), out, offsets, "taco", then=dies)
    ingest(read_stream(spark, "taco", root), out, offsets, "taco")
    assert broken and sorted(r._rid for r in ingested(spark, out).collect()) == list(range(8))


def test_state_from_turn_to_turn(spark, tmp_path):
    rng = random.Random(5)
    path, out, offsets = (str(tmp_path / x) for x in ("log", "out", "offsets"))
    schema = "run long, step long, time double, tokens double, loss double"
    last, want = {}, []
    for turn in range(3):
        rows = [(r, turn * 10 + rng.randrange(-4, 12), 0.0, float(rng.randrange(100)), rng.choice([1.0, 2.0, None, 1.5] + [math.inf] * (turn == 1))) for r in range(4) for _ in range(12)]
        rows = [(r, s, s * 2.0, t, x) for r, s, _, t, x in rows]
        rows = list({(r[0], r[1]): r for r in rows}.values())  # of equal steps any may stay: here there is one
        for r, s, time, tokens, loss in sorted(rows, key=lambda x: x[:2]):
            step, before, had, stopped = last.get(r, (None, None, None, False))
            if step is not None and s <= step:
                continue
            stopped = stopped or (loss is not None and not math.isfinite(loss))
            want.append((r, s, None if step is None else (tokens - had) / (time - before), stopped))
            last[r] = (s, time, tokens, stopped)
        rng.shuffle(rows)
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(path)
        for _ in range(2):
            drain(follow_runs(spark.readStream.schema(schema).parquet(path)), out, offsets)
    got = [(r.run, r.step, r.tokens_per_second, r.stopped) for r in spark.read.parquet(out).collect()]
    assert sorted(got, key=lambda x: x[:2]) == sorted(want, key=lambda x: x[:2])


def test_windows_of_a_table_lose_nothing(spark):
    rows = [(i % 3, i * 700, float(i)) for i in range(50)]
    log = spark.createDataFrame(rows, "run long, s long, tokens double").withColumn("time", F.timestamp_seconds("s"))
    got = windowed_throughput(log).agg(F.sum("n_rows"), F.sum("tokens")).first()
    assert tuple(got) == (50, sum(range(50)))


def test_state_is_a_row_a_group_of_runs(spark, tmp_path):
    """Many runs share few groups, so Python is called by group; a run without a name, and a loss that is no number, count."""
    path, out, offsets = (str(tmp_path / x) for x in ("log", "out", "offsets"))
    schema, many = "run long, step long, time double, tokens double, loss double", 3000
    big = 2**53 + 1
    turns = [
        [(big + r, 1, 1.0, float(r), 1.0) for r in range(many)] + [(None, 5, 1.0, 1.0, math.nan), (None, None, 9.0, 9.0, 1.0)],
        [(big + r, s, 1.0 + s, r + 3.0 * s, None if r % 2 else math.inf) for r in range(0, many, 3) for s in (2, 1, 2)] + [(None, 6, 2.0, 4.0, 1.0)],
        [(big + r, 4, 7.0, None if r == 1 else 0.0, 1.0) for r in range(4)],
    ]
    for rows in turns:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        drain(follow_runs(spark.readStream.schema(schema).parquet(path), 16), out, offsets)
    want = {(big + r, 1): (None, False) for r in range(many)} | {(None, 5): (None, True), (None, 6): (3.0, True)}
    want |= {(big + r, 2): (3.0, r % 2 == 0) for r in range(0, many, 3)}
    want |= {(big, 4): (-1.5, True), (big + 1, 4): (None, False), (big + 2, 4): (-2 / 6, False), (big + 3, 4): (-2.25, False)}
    got = spark.read.parquet(out).collect()
    assert len(got) == len(want) and {(r.run, r.step): (r.tokens_per_second, r.stopped) for r in got} == want
    assert 0 < spark.read.format("statestore").load(offsets).count() <= 17

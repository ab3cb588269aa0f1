"""Queries of the catalogue over streams: files arrive in turns, and after each the stream is started anew from its checkpoint."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import shared_folder
from millrace.plans.catalogue import ORACLES, made, query, same
from millrace.plans.catalogue_records import LOG_SPARK, LOG_SQL, RAW, _cp_shown
from millrace.sources.readers import SOURCES
from millrace.streaming.ingest import ingest, ingested, read_stream
from millrace.streaming.logs import drain, follow_runs, windowed_throughput


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"


def _in_turns(rows: DataFrame, turns: int, path: str, run: Callable[[], object]) -> None:
    """Rows arrive by their ``_turn``; after each turn, and once more when there is nothing new, the stream runs."""
    for k in range(turns):
        rows.where(F.col("_turn") == k).drop("_turn").write.mode("append").parquet(path)
        run()
    run()


@query(ORACLES["norm_cp_taco"])
def stream_ingest(spark, sf_dir):
    """A source that arrives in three turns, normalized: the same rows as from a table."""
    root, out, checkpoint = (_folder(spark, x) for x in ("root", "rows", "offsets"))
    raw = made(spark, sf_dir, RAW).selectExpr("doc_id AS _rid", "a AS question", "b AS problem", "sj AS solutions", "ej AS input_output", "lev AS difficulty", "tg AS tags", "doc_id % 3 AS _turn")
    _in_turns(raw, 3, SOURCES["cp"]["taco"].folder(root), lambda: ingest(read_stream(spark, "taco", root), out, checkpoint, "taco"))
    return _cp_shown(ingested(spark, out))


# A tenth of the events comes a turn or two late. ts is event time; a turn is some ten days of it.
TURN = "CAST(least(floor((day(ts) - 1) / 10), 2) AS BIGINT) + CASE WHEN event_id % 10 = 0 THEN 1 + event_id % 20 / 10 ELSE 0 END AS _turn"
# The tables have times without a zone; they are read as UTC, whatever the session's zone is.
ARRIVING_SPARK = f"{LOG_SPARK} ;; from_utc_timestamp(CAST(ts AS TIMESTAMP), current_timezone()) AS ts ;; {TURN.replace('event_id % 20 / 10', 'event_id % 20 div 10')}"
ARRIVING_SQL = f"{LOG_SQL} ;; ts ;; {TURN.replace('event_id % 20 / 10', 'event_id % 20 // 10')}"
TURNS = 5


@query(
    f"""WITH a AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS start FROM {same(ARRIVING_SQL, "events")}),
    t AS (SELECT _turn, max(max(ts)) OVER (ORDER BY _turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 6 DAY AS mark FROM a GROUP BY _turn),
    n AS (SELECT max(ts) - INTERVAL 6 DAY AS mark FROM a)
    SELECT run, CAST(epoch(start) AS BIGINT) // 86400 AS day, count(*) AS n_rows, round(sum(tokens), 6) AS tokens FROM a JOIN t USING (_turn), n
    WHERE (t.mark IS NULL OR start + INTERVAL 1 DAY > t.mark) AND start + INTERVAL 1 DAY <= n.mark GROUP BY run, start"""
)
def stream_windows(spark, sf_dir):
    """Sums by run and day of events that arrive out of order: windows past the watermark, without rows that came too late."""
    path, out, checkpoint = (_folder(spark, x) for x in ("events", "windows", "offsets"))
    rows = made(spark, sf_dir, ARRIVING_SPARK, "events").drop("time")
    schema = rows.drop("_turn").schema

    def run():
        drain(windowed_throughput(spark.readStream.schema(schema).parquet(path), "1 day", "6 days", time_col="ts"), out, checkpoint)

    _in_turns(rows, TURNS, path, run)
    return spark.read.schema("run long, start timestamp, n_rows long, tokens double").parquet(out).select("run", F.expr("unix_seconds(start) div 86400").alias("day"), "n_rows", F.round("tokens", 6).alias("tokens"))


@query(
    f"""WITH a AS (SELECT * FROM {same(ARRIVING_SQL, "events")}),
    s AS (SELECT run, _turn, max(max(step)) OVER (PARTITION BY run ORDER BY _turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a GROUP BY run, _turn),
    k AS (SELECT a.* FROM a JOIN s USING (run, _turn) WHERE seen IS NULL OR step > seen)
    SELECT run, step, (tokens - lag(tokens) OVER w) / (time - lag(time) OVER w) AS rate, max(CASE WHEN isinf(loss) THEN 1 ELSE 0 END) OVER w = 1 AS stopped FROM k WINDOW w AS (PARTITION BY run ORDER BY step)"""
)
def stream_runs(spark, sf_dir):
    """Each run's rate and first bad loss by state that lasts from turn to turn; rows that come behind are dropped."""
    path, out, checkpoint = (_folder(spark, x) for x in ("events", "runs", "offsets"))
    rows = made(spark, sf_dir, ARRIVING_SPARK, "events").drop("ts")
    schema = rows.drop("_turn").schema
    _in_turns(rows, TURNS, path, lambda: drain(follow_runs(spark.readStream.schema(schema).parquet(path)), out, checkpoint))
    found = spark.read.schema("run long, step long, tokens_per_second double, stopped boolean").parquet(out)
    return found.select("run", "step", F.col("tokens_per_second").alias("rate"), "stopped")

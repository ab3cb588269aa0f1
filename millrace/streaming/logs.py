"""Training logs as streams: throughput in windows with a watermark, and each run's state from row to row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_throughput(log: DataFrame, window: str = "1 hour", delay: str = "10 minutes", run_col: str = "run", time_col: str = "time", tokens_col: str = "tokens") -> DataFrame:
    """(run, start, n_rows, tokens): sums by run and window of event time. Works on streams and on tables alike.

    In a stream a window is final, and written, once the watermark (the latest time of earlier batches, less ``delay``) has
    reached its end; rows that come for it later are dropped. On a table nothing is late.
    """
    late = log.withWatermark(time_col, delay) if delay else log
    sums = late.groupBy(F.col(run_col).alias("run"), F.window(time_col, window).alias("w")).agg(F.count("*").alias("n_rows"), F.sum(tokens_col).alias("tokens"))
    return sums.select("run", F.col("w.start").alias("start"), "n_rows", "tokens")


OUT = "run long, step long, tokens_per_second double, stopped boolean"
#: The last rows of a bucket's runs, by run.
STATE = "run array<long>, step array<long>, time array<double>, tokens array<double>, stopped array<boolean>"
#: Groups into which runs are hashed: a call of Python and a state are a group's, not a run's. A checkpoint holds on to it.
BUCKETS = 1024


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    parts = list(frames)
    run, step, time, tokens, bad = (np.concatenate([x[c].to_numpy(kind) for x in parts]) for c, kind in (("run", int), ("step", int), ("time", float), ("tokens", float), ("bad", bool)))
    kinds = (int, int, float, float, bool)
    last = [np.array(x, kind) for x, kind in zip(state.get if state.exists else [[]] * 5, kinds)]

    def behind(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether runs have a last row, and its place."""
        at = np.minimum(np.searchsorted(last[0], of), max(len(last[0]) - 1, 0))
        return (last[0][at] == of if len(last[0]) else np.zeros(len(of), bool)), at

    known, at = behind(run)
    new = ~known
    new[known] = step[known] > last[1][at[known]]
    order = np.flatnonzero(new)
    order = order[np.lexsort((step[order], run[order]))]  # stable: of equal steps the first to come stays
    order = order[np.append(True, (np.diff(run[order]) != 0) | (np.diff(step[order]) != 0))[: len(order)]]
    if not len(order):
        return
    run, step, time, tokens, bad = (x[order] for x in (run, step, time, tokens, bad))
    first = np.append(True, run[1:] != run[:-1])
    starts = np.flatnonzero(first)
    known, at = behind(run[starts])
    before, had, stopped = (np.append(x[:1], x[:-1]) for x in (time, tokens, bad))
    before[starts], had[starts], stopped = np.nan, np.nan, np.zeros(len(starts), bool)
    before[starts[known]], had[starts[known]], stopped[known] = last[2][at[known]], last[3][at[known]], last[4][at[known]]
    with np.errstate(invalid="ignore", over="ignore"):
        spent = time - before
        rate = np.divide(tokens - had, spent, out=np.full(len(run), np.nan), where=spent > 0)
    seen, each = np.cumsum(bad), np.cumsum(first) - 1
    stopped = (seen - (seen - bad)[starts][each] > 0) | stopped[each]
    ends = np.append(starts[1:], len(run)) - 1
    stay = ~np.isin(last[0], run[ends])
    now = [np.concatenate([x[stay], y[ends]]) for x, y in zip(last, (run, step, time, tokens, stopped))]
    by_run = np.argsort(now[0], kind="stable")
    state.update(tuple(x[by_run].tolist() for x in now))
    shown = pd.Series(run) if key[0] >= 0 else pd.Series([None] * len(run), dtype=object)
    yield pd.DataFrame({"run": shown, "step": step, "tokens_per_second": pd.Series(rate).astype(object).where(~np.isnan(rate), None), "stopped": stopped})


def follow_runs(log: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(run, step, tokens_per_second, stopped) of a stream of (run, step, time in seconds, tokens, loss).

    The rate is that since the run's last row, null on its first; ``stopped`` holds from the first loss that is no finite
    number on. A run's state is its last row. Rows of a batch are taken by step; those not after the run's last step,
    repeated ones and those without a step among them, are dropped. Runs are followed in ``buckets`` groups by hash; rows without a
    run are a run too, in a group of its own. What a task holds at once is a group's part of one batch, and its runs' last rows.
    """
    loss = F.col("loss").cast("double")
    bad = F.coalesce(F.isnan(loss) | (F.abs(loss) == float("inf")), F.lit(False)).alias("bad")
    bucket = F.when(F.col("run").isNull(), -1).otherwise(F.pmod(F.xxhash64("run"), F.lit(buckets))).alias("bucket")
    kinds = {"step": "long", "time": "double", "tokens": "double"}
    rows = log.where("step IS NOT NULL").select(F.coalesce("run", F.lit(0)).cast("long").alias("run"), *[F.col(c).cast(k).alias(c) for c, k in kinds.items()], bad, bucket)
    return rows.groupBy("bucket").applyInPandasWithState(_follow, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what is new in a stream to Parquet files in ``path``, once each, and wait until nothing is left."""
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query

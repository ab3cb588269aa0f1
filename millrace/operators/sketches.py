"""Figures of a growing corpus by sketches: distinct keys and quantiles of lengths, stored by run and merged over runs.

A run's sketches are a few kilobytes a group, whatever its rows; the figures over all runs come from these alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of distinct counts (2**LG: a relative standard error of 1.04 / 2**(LG / 2)), and the accuracy of quantiles (rank error some 1.3 % at 200).
LG, K = 14, 400


def sketched(df: DataFrame, by: str, key: Column, length: Column) -> DataFrame:
    """(by, n_rows, keys, lengths): of each group the count, a sketch of its distinct keys and one of its lengths.

    Null keys and lengths count as rows only.
    """
    return df.groupBy(by).agg(F.count("*").alias("n_rows"), F.hll_sketch_agg(key, LG).alias("keys"), F.kll_sketch_agg_bigint(length.cast("long"), K).alias("lengths"))


def merged(stored: DataFrame, by: str) -> DataFrame:
    """The same over all runs stored."""
    return stored.groupBy(by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("keys").alias("keys"), F.kll_merge_agg_bigint("lengths").alias("lengths"))


def figures(sketches: DataFrame, by: str, shares: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """(by, n_rows, n_keys, p50, ...): estimates from sketches; quantiles are null where there are no lengths."""
    some = F.kll_sketch_get_n_bigint("lengths") > 0
    quantiles = [F.when(some, F.kll_sketch_get_quantile_bigint("lengths", F.lit(q))).alias(f"p{round(100 * q)}") for q in shares]
    return sketches.select(by, "n_rows", F.hll_sketch_estimate("keys").alias("n_keys"), *quantiles)


def add_run(df: DataFrame, path: str, run: str, by: str, key: Column, length: Column) -> None:
    """Store a run's sketches at ``path``; a run that is repeated replaces its own."""
    sketched(df, by, key, length).write.mode("overwrite").parquet(f"{path}/run={run}")


def over_runs(spark, path: str, by: str, shares: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Figures over all runs stored at ``path``."""
    return figures(merged(spark.read.parquet(path), by), by, shares)

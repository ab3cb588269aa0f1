"""Seeded order and splits of exact size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.dedup import _cut as cut
from millrace.operators.dedup import _members as members
from millrace.operators.dedup import decontaminate_near, exact_key, signatures


def turn(seed: int, order_col: str = "_rid") -> Column:
    """The place of a row in the seeded order, as text that sorts."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(order_col).cast("string")))


def ranks(df: DataFrame, seed: int = 42, order_col: str = "_rid") -> DataFrame:
    """(order_col, _rank) from 0 in the seeded order: ranks within 4096 hash buckets, and the buckets' offsets.

    Only the order column is dealt to the buckets.
    """
    keyed = df.select(order_col).withColumn("_turn", turn(seed, order_col)).withColumn("_bucket", F.substring("_turn", 1, 3))
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("n"))  # at most 4096 rows
    offsets = sizes.select("_bucket", (F.sum("n").over(Window.orderBy("_bucket")) - F.col("n")).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_turn", order_col))
    return keyed.withColumn("_rank", rank - 1).join(F.broadcast(offsets), "_bucket").select(order_col, (F.col("_rank") + F.col("_offset")).alias("_rank"))


def ranked(df: DataFrame, seed: int = 42, order_col: str = "_rid") -> DataFrame:
    """``df`` with ``_rank`` from 0 in the seeded order of ``order_col``, which must be unique."""
    return df.join(ranks(df, seed, order_col), order_col).select(*df.columns, "_rank")


def shuffled(df: DataFrame, seed: int = 42, order_col: str = "_rid") -> DataFrame:
    """``df`` sorted in the seeded order."""
    return df.orderBy(turn(seed, order_col), order_col)


def split_column(n: int, test: float = 0.01, val: float = 0.02) -> Column:
    """test, val or train by ``_rank`` of n rows: at least one test row, then one val row, as far as there are rows."""
    n_test, n_val = max(1, int(n * test)), max(1, int(n * val))
    return F.when(F.col("_rank") < n_test, "test").when(F.col("_rank") < n_test + n_val, "val").otherwise("train")


def assign_split(df: DataFrame, seed: int = 42, test: float = 0.01, val: float = 0.02, order_col: str = "_rid") -> DataFrame:
    """``df`` with ``split``, sizes exact. Only the ids of test and val are joined to the rows; the others are train."""
    n = df.count()
    held = ranks(df, seed, order_col).select(order_col, split_column(n, test, val).alias("split")).where(F.col("split") != "train")
    return df.join(held, order_col, "left").select(*df.columns, F.coalesce("split", F.lit("train")).alias("split"))


def _marks(df: DataFrame, text_col: str, order_col: str, method: str) -> DataFrame:
    """(order_col, mark): rows that share a mark are copies by ``method``."""
    if method == "exact":
        return df.select(order_col, exact_key(text_col).alias("mark"))
    return members(signatures(df, order_col, text_col)).select(F.col("id").alias(order_col), F.col("bucket").alias("mark"))


def split(df: DataFrame, seed: int = 42, test: float = 0.01, val: float = 0.02, order_col: str = "_rid", text_col: str = "problem", method: str | None = "minhash", clean_val: bool = False) -> dict[str, DataFrame]:
    """train, val and test; train freed of near copies of test and then of val. val keeps its own unless ``clean_val``.

    Parts and copies are found on ids and marks alone; the rows join their part at the end. ``order_col`` is unique.
    """
    names = ("train", "val", "test")
    parts = cut(assign_split(df.select(order_col), seed, test, val, order_col))
    if method in ("exact", "minhash"):
        marked = cut(_marks(df, text_col, order_col, method).join(parts, order_col))
        for name, against in [("train", ("test", "val")), ("val", ("test",))][: 1 + clean_val]:
            held = marked.where(F.col("split").isin(*against)).select("mark").distinct()
            hit = marked.where(F.col("split") == name).join(held, "mark", "left_semi").select(order_col).distinct()
            parts = parts.join(hit, order_col, "left_anti")
        parts = cut(parts)
    out = {k: df.join(parts.where(F.col("split") == k).select(order_col), order_col, "left_semi") for k in names}
    if method == "jaccard":
        for held in ("test", "val"):
            out["train"] = decontaminate_near(out["train"], out[held], text_col, order_col, method=method)
        if clean_val:
            out["val"] = decontaminate_near(out["val"], out["test"], text_col, order_col, method=method)
    return out


def head(df: DataFrame, n: int | None, order_col: str = "_rid") -> DataFrame:
    """The first n rows by ``order_col``; 0 or None: all."""
    return df.orderBy(order_col).limit(n) if n else df

"""What the operators of this subpackage share: lineage cuts, row signatures and connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window


_worker: dict = {"of": None, "state": {}}


def worker_state(of: str) -> dict:
    """What a Python worker keeps from task to task for one operator. Another operator's goes first: workers are used again."""
    if _worker["of"] != of:
        _worker.update(of=of, state={})
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)
    return _worker["state"]


def shared_dir(spark: SparkSession) -> None:
    """Make sure that a checkpoint folder is set: the cluster's own, else, on a local master only, a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    where = sc.getConf().get("spark.checkpoint.dir")
    if not where and sc.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="millrace-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there; Spark's cleaner removes the files."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as a Parquet table to the shared folder; the table and its path, for ``discard``."""
    spark = df.sparkSession
    shared_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored table."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, most: int = 250_000) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``most`` rows; for narrow tables. Beyond that Spark shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns ``_k`` and ``_sig``: they tell rows apart by id and text, null ids included."""
    return [
        F.coalesce(F.col(id_col), F.lit(-(2**63))).alias("_k"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.col(text_col).isNull()).alias("_sig"),
    ]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (_k, _sig) are in ``kept``; of wholly equal rows one stays.

    One shuffle of the rows by their key; the window reuses its partitioning and order.
    """
    k, sig = row_key(id_col, text_col)
    keyed = docs.withColumns({"_k": k, "_sig": sig})
    joined = keyed.join(kept.select("_sig", "_k"), ["_sig", "_k"], "left_semi")
    w = Window.partitionBy("_sig", "_k").orderBy("_k")
    return joined.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*docs.columns)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b: hang neighbours on the smallest of them.

    Minima come from a partial aggregate and are joined back, so that a hub's neighbours may lie in many tasks.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def _roots(frames):
    """Of all edges given, each node with the smallest node it is joined to."""
    edges = np.concatenate([f[["a", "b"]].to_numpy(np.int64) for f in frames] or [np.zeros((0, 2), np.int64)])
    nodes, at = np.unique(edges, return_inverse=True)
    label, (i, j) = np.arange(len(nodes)), at.reshape(-1, 2).T
    while len(i):
        x, y = label[i], label[j]
        open_ = x != y
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := label[label], label):
            label = up
    yield pd.DataFrame({"node": nodes, "root": nodes[label]})


def components(edges: DataFrame, max_rounds: int = 100, one_task: int = 250_000) -> DataFrame:
    """Connected components of an edge table (a long, b long): (node, root), the root being the smallest node.

    Alternating large-star and small-star steps; every round is cut to the shared folder. Only sums leave the cluster.
    Once at most ``one_task`` edges are left (4 MB) one task ends it. Loops and repeated edges do no harm; nulls are
    dropped; an empty table gives an empty result.
    """
    cur = cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    seen = mark(cur)
    for _ in range(max_rounds):
        if seen[0] <= one_task:
            return cur.coalesce(1).mapInPandas(_roots, "node long, root long")
        cur = cut(_star(_star(cur, True), False))
        now = mark(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: no fixed point in {max_rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(cur.select("b", "b").distinct())


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)

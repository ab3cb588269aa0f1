"""Hard negatives by a vector-approximation file.

Every row is written with an approximation: the cell of each of its components, two cells a byte. For an anchor a table
has the least and the greatest product of its component with any value of each cell, so adding up looked-up entries bounds
the score of a row from below and above. What can't be among the best by these bounds is never scored. Cells are cut at
quantiles of a bounded sample and end at the least and greatest component of all rows, so the bounds hold whatever the sample.

Anchors and rows meet in blocks of bounded size: each pair of blocks is one group, which returns a few rows an anchor.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut

#: Cells of a component, at most 16.
CELLS = 16
#: Rows and anchors of a block, at most some more: blocks are dealt by hash.
ROWS, ANCHORS = 8_192, 8_192
#: Rows whose components place the cells' borders.
SAMPLE = 4_096
FOUND = "anchor_id long, other_id long, score long"
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part, v being floor(scale * component); of rows with one id the least one."""
    odd = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & ~odd)
    v = F.transform(vec_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    some = whole.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
    own = Window.partitionBy("id").orderBy("label", "v")
    return some.withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n")


class Grid:
    """Borders of each component's cells, from a sample and the least and greatest values."""

    def __init__(self, sample: np.ndarray, low: np.ndarray, high: np.ndarray, cells: int = 16):
        self.cells = cells
        inner = np.quantile(sample, np.arange(1, cells) / cells, axis=0, method="lower").astype(np.int64).T
        self.edges = np.sort(inner, axis=1)
        self.first = np.concatenate([low[:, None], self.edges], axis=1)
        self.last = np.concatenate([self.edges - 1, high[:, None]], axis=1)

    def approximate(self, vectors: np.ndarray) -> np.ndarray:
        """A byte for each two components: their cells."""
        cells = np.stack([np.searchsorted(e, x, side="right") for e, x in zip(self.edges, vectors.T)], axis=1).astype(np.uint8)
        return cells[:, 0::2] * self.cells + cells[:, 1::2]

    def tables(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte and each of its values, the least and the greatest that the two components add to a score."""
        one, two = anchor[:, None] * self.first, anchor[:, None] * self.last
        low, high = np.minimum(one, two), np.maximum(one, two)
        return tuple((t[0::2, :, None] + t[1::2, None, :]).ravel() for t in (low, high))


def _vectors(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def _written(grid: Grid, kind: str):
    size = len(grid.edges)

    def run(frames):
        for frame in frames:
            vectors = np.zeros((len(frame), size), np.int64)
            for i, v in enumerate(frame["v"]):
                vectors[i, : len(v)] = v
            cells = grid.approximate(vectors)
            yield pd.DataFrame({"id": frame["id"], "label": frame["label"], "cells": [c.tobytes() for c in cells], "vec": [v.tobytes() for v in vectors.astype(kind)]})

    return run


class _Block:
    """A block of rows in the order of (label, id), to be bounded and scored against one anchor after another."""

    def __init__(self, rows: pd.DataFrame, grid: Grid, kind: str, exact: type):
        rows = rows.sort_values(["label", "id"], kind="stable")
        self.grid, self.id, self.label = grid, rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        self.vec = _vectors(rows["vec"], kind).astype(exact)
        cells = _vectors(rows["cells"], "u1").T.astype(np.intp)
        self.at = np.ascontiguousarray(cells + np.arange(len(cells))[:, None] * grid.cells**2)

    def bounds(self, anchor: np.ndarray, part: slice) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[:, part]
        return tuple(t.take(at).sum(axis=0) for t in self.grid.tables(anchor))

    def scores(self, anchor: np.ndarray, which: np.ndarray) -> np.ndarray:
        return (self.vec[which] @ anchor.astype(self.vec.dtype)).astype(np.int64)

    def best(self, which: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """Places in ``which`` of the n best, ties by smaller id."""
        if len(which) > n:
            least = np.partition(scores, -n)[-n]
            keep = np.nonzero(scores > least)[0]
            ties = np.nonzero(scores == least)[0]
            room = n - len(keep)
            if len(ties) > room:
                ties = ties[np.argpartition(self.id[which[ties]], room)[:room]]
            return np.concatenate([keep, ties])
        return np.arange(len(which))


def _found(parts: list[tuple], names: list[str]) -> pd.DataFrame:
    """A frame of what anchors have found: each part is (numbers that hold for all its rows..., ids, scores)."""
    sizes = [len(p[-1]) for p in parts]
    fixed = [np.repeat(np.array([p[i] for p in parts], np.int64), sizes) for i in range(len(names) - 2)]
    rest = [np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i in (-2, -1)]
    return pd.DataFrame(dict(zip(names, [*fixed, *rest])))


def _positives(grid: Grid, kind: str, exact: type, n: int):
    """Of one block of rows, the n best of each anchor's own label."""

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(anchors) and len(rows):
            block = _Block(rows, grid, kind, exact)
            for anchor, label, q in zip(anchors["anchor_id"], anchors["own"], _vectors(anchors["q"], kind).astype(np.int64)):
                first, past = np.searchsorted(block.label, label, "left"), np.searchsorted(block.label, label, "right")
                low, high = block.bounds(q, slice(first, past))
                other = block.id[first:past] != anchor
                if other.sum() > n:
                    other &= high >= np.partition(low[other], -n)[-n]
                which = first + np.nonzero(other)[0]
                scores = block.scores(q, which)
                top = block.best(which, scores, n)
                parts.append((anchor, block.id[which[top]], scores[top]))
        return _found(parts, ["anchor_id", "other_id", "score"])

    return run


def _negatives(grid: Grid, kind: str, exact: type, n: int, share: tuple[int, int]):
    """Of one block of rows, for each anchor and positive the n best of other labels with a score in the window."""

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(anchors) and len(rows):
            block = _Block(rows, grid, kind, exact)
            for anchor, label, positives, q in zip(anchors["anchor_id"], anchors["own"], anchors["positives"], _vectors(anchors["q"], kind).astype(np.int64)):
                low, high = block.bounds(q, slice(None))
                other = block.label != label
                windows = [(p["id"], p["score"], -(-share[0] * p["score"] // 100), share[1] * p["score"] // 100) for p in positives]
                wanted = np.zeros(len(other), bool)
                for _, _, least, most in windows:
                    if least > most:
                        continue
                    sure = low[other & (low >= least) & (high <= most)]
                    reach = np.partition(sure, -n)[-n] if len(sure) >= n else least
                    wanted |= other & (high >= max(least, reach)) & (low <= most)
                which = np.nonzero(wanted)[0]
                scores = block.scores(q, which)
                for positive, score, least, most in windows:
                    inside = (scores >= least) & (scores <= most)
                    some, own = which[inside], scores[inside]
                    top = block.best(some, own, n)
                    parts.append((anchor, positive, score, block.id[some[top]], own[top]))
        return _found(parts, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return run


def _in_blocks(anchors: DataFrame, rows: DataFrame, na: int, nb: int, run, schema: str) -> DataFrame:
    one = anchors.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    two = rows.withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(na - 1))))
    return one.groupBy("ab", "rb").cogroup(two.groupBy("ab", "rb")).applyInPandas(run, schema)


def _leading(found: DataFrame, keys: list[str], score: str, other: str, n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    share: tuple[int, int] = (50, 95),
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """For each anchor (id divisible by ``every``) and each of its ``positives`` best rows of its label, the ``negatives``
    best rows of other labels with a score of share[0] to share[1] percent of the positive's.

    Scores are inner products of floor(scale * component); higher ones come first, ties by smaller id. Rows with a null id,
    label or vector, or a null or non-finite component take no part. Of rows with equal ids one takes part, that with the
    least label, then vector. Shorter vectors count as continued by zeros, empty ones as zeros. Other columns are not read;
    without anchors, positives or negatives there are no rows. Scores must fit 62 bits, else it is an error.
    """
    spark = rows.sparkSession
    some = cut(usable(rows, id_col, vec_col, label_col, scale))
    count, anchored, size = some.agg(F.count("*"), F.count_if(F.col("id") % every == 0), F.max(F.size("v"))).first()
    if not anchored or not size:  # nothing to look for, or no component anywhere
        if not anchored:
            return spark.createDataFrame([], OUT)
        size = 1
    size += size % 2
    low, high = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in some.select(F.posexplode("v")).groupBy("pos").agg(F.min("col").alias("low"), F.max("col").alias("high")).collect():  # a row a component
        low[r.pos], high[r.pos] = min(r.low, 0), max(r.high, 0)
    most = max(-int(low.min()), int(high.max()))
    if size * most * most >= 1 << 62:
        raise ValueError(f"scores of {size} components up to {most} don't fit")
    kind, exact = ("<i4" if most < 1 << 31 else "<i8"), (np.float64 if size * most * most < 1 << 53 else np.int64)
    taken = some.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    sample = np.array([(list(r.v) + [0] * size)[:size] for r in taken], np.int64)
    grid = Grid(sample, low, high, CELLS)

    na, nb = math.ceil(anchored / ANCHORS), math.ceil(count / ROWS)
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    file = cut(some.mapInPandas(_written(grid, kind), "id long, label long, cells binary, vec binary").withColumn("rb", deal(nb)))
    anchors = file.where(F.col("id") % every == 0).select(F.col("id").alias("anchor_id"), F.col("label").alias("own"), F.col("vec").alias("q"), deal(na).alias("ab"))
    near = _in_blocks(anchors, file, na, nb, _positives(grid, kind, exact, positives), FOUND)
    best = cut(_leading(near, ["anchor_id"], "score", "other_id", positives))
    aims = best.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("other_id").alias("id"), "score")).alias("positives"))
    far = _in_blocks(
        anchors.join(aims, "anchor_id"),
        file,
        na,
        nb,
        _negatives(grid, kind, exact, negatives, share),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    return _leading(far, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

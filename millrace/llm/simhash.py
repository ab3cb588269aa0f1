"""SimHash fingerprints and exact near-duplicate groups by a sharded vantage-point tree.

A bounded sample of fingerprints gives the tree's upper levels: at each node a vantage point and a radius. Fingerprints
within radius + reach go to the inner side, those beyond the radius to the outer side; so what lies near a boundary is
in both, and every pair within ``reach`` bits meets in at least one shard: by the triangle inequality, if one of the
pair is outside, its distance to the vantage point is at most radius + reach. Shards are counted and split again until
each fits a task. Within a shard the tree goes on in memory down to small leaves, where distances are taken. A shard
returns a spanning forest of its links, not all pairs.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import components, cut, row_key, text_of, union_all, worker_state

LEAF = 256
BLOCK = 65_536


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a text: majority bits of the XXH64 of its word shingles, repeats included."""
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) < words:
        shingles = [joined]
    else:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size + 1) - 1
        spans = zip((ends - size)[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
        shingles = [joined[a:b] for a, b in spans]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(s, seed) for s in shingles], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    @F.pandas_udf(T.LongType())
    def run(texts: pd.Series) -> pd.Series:
        worker_state("simhash")
        return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))

    return run


def split_radius(d: np.ndarray, reach: int, most: float = 0.9) -> int | None:
    """The radius that leaves the larger side smallest, the inner one with its rim; None if none leaves less than ``most``."""
    if len(d) < 2:
        return None
    upto = np.cumsum(np.bincount(d, minlength=65 + reach)[: 65 + reach])
    radius = np.arange(65)
    inner, outer = upto[radius + reach], len(d) - upto[radius]
    larger = np.where(outer > 0, np.maximum(inner, outer), len(d))
    best = int(larger.argmin())
    return best if larger[best] < most * len(d) else None


def vantage(points: np.ndarray, reach: int, rng: np.random.Generator, tries: int = 4) -> tuple[np.uint64, np.ndarray, int] | None:
    """A vantage point that splits the points, their distances to it and the radius; None if ``tries`` points don't."""
    for v in points[rng.integers(len(points), size=tries)]:
        d = np.bitwise_count(points ^ v)
        radius = split_radius(d, reach)
        if radius is not None:
            return v, d, radius
    return None


def grow(sample: np.ndarray, leaves: int, reach: int = 3, seed: int = 7) -> list[tuple]:
    """Nodes (vantage point, radius, inner, outer) of a tree with up to ``leaves`` leaves; -k-1 stands for leaf k.

    The largest leaf is split next, its rim counted with it, so that leaves come out about even.
    """
    rng, nodes, made = np.random.default_rng(seed), [], 1
    ends = [(-len(sample), 0, sample, None)]  # size, leaf, points, (node, side) that leads here
    while ends and made < leaves:
        _, leaf, points, above = heapq.heappop(ends)
        found = vantage(points, reach, rng) if len(points) >= 8 else None
        if found is None:
            continue
        v, d, radius = found
        if above is not None:
            nodes[above[0]][above[1]] = len(nodes)
        nodes.append([v, radius, -leaf - 1, -made - 1])
        for number, side, some in ((leaf, 2, points[d <= radius + reach]), (made, 3, points[d > radius])):
            heapq.heappush(ends, (-len(some), number, some, (len(nodes) - 1, side)))
        made += 1
    return [tuple(x) for x in nodes]


def route(nodes: list[tuple], points: np.ndarray, reach: int) -> list[tuple[int, np.ndarray]]:
    """(shard, points) for every shard that needs some of the points."""
    out, todo = [], [(0 if nodes else -1, points)]
    while todo:
        at, some = todo.pop()
        if not len(some):
            continue
        if at < 0:
            out.append((-at - 1, some))
            continue
        vantage, radius, inner, outer = nodes[at]
        d = np.bitwise_count(some ^ vantage)
        todo += [(inner, some[d <= radius + reach]), (outer, some[d > radius])]
    return out


def merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union by smallest label, with pointer jumping; ``labels`` is changed in place."""
    while len(i):
        a, b = labels[i], labels[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels[:] = up


def _leaf_links(points: np.ndarray, index: np.ndarray, labels: np.ndarray, reach: int) -> None:
    """Links among the points of one leaf by breadth-first search: distances only to what isn't reached yet.

    So points that crowd within a few bits, which no radius parts, cost about their number and not their pairs.
    """
    left = index
    while len(left):
        front, left = left[:LEAF], left[LEAF:]
        i, j = np.nonzero(np.bitwise_count(points[front, None] ^ points[front][None, :]) <= reach)
        merge(labels, front[i[i < j]], front[j[i < j]])
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, 2_000_000 // len(left))
            for k in range(0, len(front), step):
                open_ = np.nonzero(~near)[0]
                d = np.bitwise_count(points[front[k : k + step], None] ^ points[left[open_]][None, :]) <= reach
                hit, to = np.nonzero(d)
                merge(labels, front[k + hit], left[open_[to]])
                near[open_[to]] = True
            front, left = left[near], left[~near]


def shard_forest(points: np.ndarray, reach: int, seed: int = 11) -> np.ndarray:
    """For sorted distinct fingerprints: the index of the smallest one that each is linked to by steps of ``reach`` bits."""
    labels, rng = np.arange(len(points)), np.random.default_rng(seed)
    todo = [np.arange(len(points))]
    while todo:
        index = todo.pop()
        found = vantage(points[index], reach, rng) if len(index) > LEAF else None
        if found is None:
            _leaf_links(points, index, labels, reach)
        else:
            _, d, radius = found
            todo += [index[d <= radius + reach], index[d > radius]]
    return labels


def _unsigned(column) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def _shards(prints: DataFrame, reach: int, shard_size: int, per_leaf: int, at_once: int, most_leaves: int) -> tuple[list[DataFrame], dict[int, int]]:
    """Rows (shard, fp) in several tables, and the sizes of the shards that no radius parts.

    Shards of more than ``shard_size`` are split again, at most ``at_once`` in a round; each is given a tree grown from
    ``per_leaf`` of its fingerprints for each of its at most ``most_leaves`` new shards. That bounds what the driver
    holds and broadcasts, whatever the number of fingerprints.
    """
    spark, parts, whole, past = prints.sparkSession, [], {}, 1
    rows = prints.select(F.lit(0).cast("long").alias("shard"), "fp")
    while True:
        sizes = rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_size)
        over = sizes.where(~F.col("shard").isin(list(whole))) if whole else sizes
        largest = {r["shard"]: r["n"] for r in over.orderBy(F.desc("n"), "shard").limit(at_once).collect()}
        if not largest:
            return [*parts, rows], whole
        leaves = {k: min(most_leaves, 2 * n // shard_size + 2) for k, n in largest.items()}
        want = F.element_at(F.create_map(*[F.lit(x) for k, m in leaves.items() for x in (k, m * per_leaf)]), F.col("shard"))
        share = F.element_at(F.create_map(*[F.lit(x) for k, m in leaves.items() for x in (k, min(1.0, 1.5 * m * per_leaf / largest[k]))]), F.col("shard"))
        ours = rows.where(F.col("shard").isin(list(largest)))
        # About 1.5 times what is wanted, by hash, then the wanted number by rank: no window over a whole shard.
        some = ours.where(F.pmod(F.xxhash64("fp", F.lit(past)), F.lit(2**30)) < share * 2**30)
        rank = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("fp", F.lit(past)), "fp"))
        sample = some.withColumn("_r", rank).where(F.col("_r") <= want).select("shard", "fp").toPandas()
        trees = {}
        for k, frame in sample.groupby("shard"):
            nodes = grow(np.sort(_unsigned(frame["fp"])), leaves[k], reach)
            if nodes:
                trees[int(k)] = (past, nodes)
                past += len(nodes) + 1
        whole |= {k: n for k, n in largest.items() if k not in trees}
        if not trees:
            continue
        shared = spark.sparkContext.broadcast(trees)

        def deal(frames, shared=shared):
            for frame in frames:
                for shard, some in frame.groupby("shard"):
                    first, nodes = shared.value[int(shard)]
                    for leaf, points in route(nodes, _unsigned(some["fp"]), reach):
                        yield pd.DataFrame({"shard": np.full(len(points), first + leaf, np.int64), "fp": points.view(np.int64)})

        moved = F.col("shard").isin(list(trees))
        parts.append(rows.where(~moved))
        rows = cut(rows.where(moved).mapInPandas(deal, "shard long, fp long"))
        shared.destroy()


def tasks(prints: DataFrame, *, reach: int = 3, shard_size: int = 50_000, per_leaf: int = 64, at_once: int = 256, most_leaves: int = 64) -> DataFrame:
    """Rows (shard, one, two, fp), grouped by the first three at most about ``shard_size`` a group, in which all pairs of
    the distinct fingerprints ``fp`` within ``reach`` bits meet.

    Larger shards are split again. One that no radius parts is taken block by block, two third-size blocks at a time.
    """
    parts, whole = _shards(prints, reach, shard_size, per_leaf, at_once, most_leaves)
    rows = union_all(parts)
    if not whole:
        return rows.select("shard", F.lit(0).alias("one"), F.lit(0).alias("two"), "fp")
    blocks = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, n in whole.items() for x in (k, -(-3 * n // shard_size))]), F.col("shard")), F.lit(1))
    own, other = F.pmod(F.xxhash64("fp"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))
    both = rows.select("shard", "fp", own.alias("own"), other.alias("other"))
    return both.select("shard", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp")


def links(prints: DataFrame, *, reach: int = 3, **options) -> DataFrame:
    """Links (a long, b long) that connect the distinct fingerprints ``fp`` as their pairs within ``reach`` bits do."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        points = np.unique(_unsigned(frame["fp"]))
        root = shard_forest(points, reach)
        linked = np.nonzero(root != np.arange(len(points)))[0]
        return pd.DataFrame({"a": points[linked].view(np.int64), "b": points[root[linked]].view(np.int64)})

    return tasks(prints, reach=reach, **options).groupBy("shard", "one", "two").applyInPandas(join, "a long, b long")


def simhash_groups(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, reach: int = 3, shard_size: int = 50_000
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id, and _k, _sig as row key.

    component_id: the smallest doc_id that can be reached over fingerprints at ``reach`` or fewer differing bits (null
    if all of its rows lack an id). Null, empty and blank texts have fingerprint zero and are linked like any other.
    Equal fingerprints are one node, so groups of copies cost nothing; repeated rows stay in the result. Other columns
    are not read. No rows in, no rows out.
    """
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), *row_key(id_col, text_col), _fingerprints(words)(text_of(text_col)).alias("fp")))
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    near = cut(components(links(prints, reach=reach, shard_size=shard_size)).withColumnRenamed("node", "fp"))
    least = near.join(prints, "fp").groupBy("root").agg(F.min("first").alias("least"))
    known = prints.join(near.join(least, "root").select("fp", "root", "least"), "fp", "left")
    # Written, so that the join with all rows can split a hot fingerprint.
    named = cut(known.select("fp", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id")))
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "_k", "_sig")

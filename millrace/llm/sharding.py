"""Sharding by minimax contiguous partition, in DataFrame operations only.

Atomic groups (equal texts) are ordered by the SHA-256 of their text; the smallest shard capacity for which a greedy
walk needs no more than ``shards`` shards is found by binary search, and the cuts are put there. The driver never sees
the groups: it works on bounds of the running size, of which it holds the smallest and the largest group end in each
of a fixed number of cells. Where that can't decide a capacity, the cells around the walks of the capacities left are
made finer by another pass over the written table, until one capacity is left.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut, text_of

#: Buckets by the leading bits of the hash: windows run within them. A hot group is one row per salt.
BUCKET_BITS = 10
SALTS = 256
#: Cells in a stretch for each shard (over 1, so that doubts shrink from pass to pass), and in the first pass.
CELLS = 10
FIRST_CELLS = 16_384


class Ends:
    """Known group ends within cells: for a bound it gives the least and the most that the last end before it can be."""

    def __init__(self, cells: list[tuple[int, int]]):
        """cells: (first end, last end) of disjoint stretches in order; between the two there may be more ends."""
        self.low = [a for a, _ in cells]
        self.high = [b for _, b in cells]

    def last(self, bound: int) -> tuple[int, int]:
        i = bisect_right(self.low, bound) - 1
        if i < 0:
            return 0, 0
        return (self.high[i], self.high[i]) if self.high[i] <= bound else (self.low[i], bound)


def walk(ends: Ends, total: int, capacity: int, shards: int) -> list[tuple[int, int]]:
    """Least and greatest position after each greedy shard."""
    low = high = 0
    out = []
    for _ in range(shards):
        low, high = (ends.last(low + capacity)[0] if low < total else low), (ends.last(high + capacity)[1] if high < total else high)
        out.append((min(low, total), min(high, total)))
    return out


def windows_for(ends: Ends, total: int, c1: int, c2: int, shards: int) -> list[tuple[int, int]]:
    """Stretches (from, to] that hold every bound of the walks with capacities c1 to c2, and the last end before each."""
    out = []
    for (s, _), (_, t) in zip([(0, 0), *walk(ends, total, c1, shards)], [(0, 0), *walk(ends, total, c2, shards)][:-1]):
        low, high = min(total, s + c1), min(total, t + c2)
        p, q = ends.last(low)
        out += [(p - 1, p), (low, high)] if p == q else [(p - 1, high)]
    disjoint, end = [], 0
    for s, t in sorted(out):
        if t > max(s, end):
            disjoint.append((max(s, end), t))
            end = t
    return disjoint


def smallest_capacity(cells_of, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity that fits and its cuts.

    ``cells_of(windows, cells)`` gives (first end, last end) of the cells, so many a window, that have ends. Cells of
    all capacities left are made finer first; if that settles nothing, those of the single capacity in question.
    """
    lo = max(largest, -(-total // shards))
    hi = lo + largest  # a shard that is closed holds more than lo
    ends, fresh = Ends(cells_of([(0, total)], FIRST_CELLS)), False

    def point(capacity: int, settled, known: Ends) -> list[tuple[int, int]]:
        while not settled(steps := walk(known, total, capacity, shards)):
            known = Ends(cells_of(windows_for(known, total, capacity, capacity, shards), CELLS * shards))
        return steps

    def decided(steps) -> bool:
        return steps[-1][0] >= total or steps[-1][1] < total

    while lo < hi:
        mid = (lo + hi) // 2
        steps = walk(ends, total, mid, shards)
        if not decided(steps):
            if fresh:
                steps = point(mid, decided, ends)
            else:
                ends, fresh = Ends(cells_of(windows_for(ends, total, lo, hi, shards), CELLS * shards)), True
                continue
        fresh = False
        if steps[-1][0] >= total:
            hi = mid
        else:
            lo = mid + 1
    return lo, [x for x, _ in point(lo, lambda steps: all(x == y for x, y in steps), ends)]


def shard_documents(docs: DataFrame, *, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus ``overhead``; null counts as no bytes and is grouped with empty texts. Equal
    texts share a shard. The law is ``bytes``: the largest shard is as small as contiguous shards of whole groups, in
    the order of their SHA-256, can be. slot: 0, 1, ... in each shard without gaps. Repeated rows and null ids each
    get a slot of their own. Fewer groups than shards leave the last shards empty; an empty table gives no rows.
    Other columns are not read.
    """
    text = text_of(text_col)
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("sha"),
        ).select(
            "*",
            F.shiftright(F.conv(F.substring("sha", 1, 4), 16, 10).cast("int"), 16 - BUCKET_BITS).alias("bucket"),
            F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
        )
    )
    units = rows.groupBy("bucket", "sha", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    order = Window.partitionBy("bucket").orderBy("sha", "salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("bucket", "sha")
    inner = cut(
        units.withColumns({"n_to": F.sum("n").over(order), "b_to": F.sum("bytes").over(order)}).withColumns(
            {"g_end": F.max("b_to").over(group), "g_bytes": F.sum("bytes").over(group)}
        )
    )
    totals = inner.groupBy("bucket").agg(F.max("n_to").alias("n"), F.max("b_to").alias("b"), F.max("g_bytes").alias("g")).orderBy("bucket").collect()  # at most 2**BUCKET_BITS rows
    if not totals:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    n_off, b_off, n_all, b_all = {}, {}, 0, 0
    for r in totals:
        n_off[r["bucket"]], b_off[r["bucket"]] = n_all, b_all
        n_all, b_all = n_all + r["n"], b_all + r["b"]
    spark = docs.sparkSession
    offsets = spark.createDataFrame([(k, n_off[k], b_off[k]) for k in n_off], "bucket int, n_off long, b_off long")
    placed = inner.join(F.broadcast(offsets), "bucket").select(
        "sha", "salt", "n", (F.col("n_off") + F.col("n_to") - F.col("n")).alias("n_from"), (F.col("b_off") + F.col("g_end")).alias("end"), (F.col("b_off") + F.col("g_end") - F.col("g_bytes")).alias("start")
    )
    largest = max(r["g"] for r in totals)

    def cells_of(windows, cells):
        width = [max(1, -(-(t - s) // cells)) for s, t in windows]
        cell = F.lit(None).cast("long")
        for i, ((s, t), w) in enumerate(zip(windows, width)):
            cell = F.when((F.col("end") > s) & (F.col("end") <= t), F.lit(i * (cells + 1)) + F.floor((F.col("end") - 1 - s) / w)).otherwise(cell)
        found = placed.select("end", cell.alias("cell")).where("cell is not null").groupBy("cell").agg(F.min("end").alias("a"), F.max("end").alias("b"))
        return sorted((r["a"], r["b"]) for r in found.collect())  # bounded by windows and cells

    capacity, cuts = smallest_capacity(cells_of, b_all, largest, shards)
    inside = [c for c in cuts if c < b_all]
    shard = F.lit(0)
    for c in inside:
        shard = shard + (F.col("start") >= c).cast("int")
    sharded = placed.withColumn("shard", shard)
    firsts = {r["shard"]: r["first"] for r in sharded.groupBy("shard").agg(F.min("n_from").alias("first")).collect()}  # a row per shard
    first = F.element_at(F.create_map(*[F.lit(x) for kv in firsts.items() for x in kv]), F.col("shard"))
    based = sharded.select("sha", "salt", "shard", (F.col("n_from") - first).alias("base"))
    rank = F.row_number().over(Window.partitionBy("sha", "salt").orderBy("doc_id"))
    out = rows.withColumn("rank", rank).join(based, ["sha", "salt"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("base") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )

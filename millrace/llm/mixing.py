"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a seeded order, are cut into blocks of ``block_bytes``. With a share a of A in all, block k
of a source is released at floor(k A / a) and due at ceil((k + 1) A / a); earliest deadline first gives each block a
slot within its window, so that after any number of slots every source is less than one block from its target. Shares
are the target weights themselves, as whole numbers in exact proportion. The schedule repeats after A slots, so one
period, or as much of it as the phase lasts, is made on the driver (a few numbers a block) and places every block. When a source has
run out, the others go on with their shares of what they make up together: a new phase. No document is dropped.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import row_key, text_of

CHUNK_BITS = 10
#: A deadline past this is of no account.
FAR = 2**61


def shares(targets: dict, resolution: int = 1000) -> dict:
    """Whole shares near ``resolution`` in all, by largest remainder; each positive target gets one at least."""
    total = sum(targets.values())
    exact = {k: v * resolution / total for k, v in targets.items() if v > 0}
    out = {k: max(1, int(v)) for k, v in exact.items()}
    rest = sorted(exact, key=lambda k: (int(exact[k]) - exact[k], str(k)))
    for k in rest[: max(0, resolution - sum(out.values()))]:
        out[k] += 1
    return out


def exact(targets: dict) -> dict:
    """Whole numbers in the proportion of the targets, each taken as the decimal number it prints as."""
    part = {k: Fraction(str(v)) for k, v in targets.items() if v > 0}
    scale = lcm(*(x.denominator for x in part.values()))
    whole = {k: int(x * scale) for k, x in part.items()}
    return {k: n // gcd(*whole.values()) for k, n in whole.items()}


def period(share: dict, left: dict | None = None) -> dict:
    """Slots of the blocks of each key in one period of sum(share) slots: earliest deadline first among released blocks.

    With ``left``, only up to the slot at which the first key has had so many blocks.
    """
    whole = sum(share.values())
    slots = {k: [] for k in share}
    waiting = [(0, -(-whole // a), -a, str(k), k) for k, a in share.items()]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    t = -1
    while (t := t + 1) < whole:
        while waiting and waiting[0][0] <= t:
            _, due, a, name, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, a, name, k))
        due, a, name, k = heapq.heappop(ready)
        assert due > t
        slots[k].append(t)
        if left and len(slots[k]) == left[k]:
            break
        if (j := len(slots[k])) < -a:
            heapq.heappush(waiting, (j * whole // -a, -(-(j + 1) * whole // -a), a, name, k))
    return slots


def phases(blocks: dict, share: dict) -> list[dict]:
    """Phases of the schedule: start, whole (slots a period), and per key share, slots of one period, first and past-last block."""
    done, start, out = dict.fromkeys(blocks, 0), 0, []
    left = {k: n for k, n in blocks.items() if n > 0}
    while left:
        now = {k: share[k] for k in left}
        whole, slots = sum(now.values()), period(now, left)
        ends = [(n - 1) // now[k] * whole + slots[k][(n - 1) % now[k]] for k, n in left.items() if (n - 1) % now[k] < len(slots[k])]
        length = 1 + min(ends)
        took = {k: length // whole * now[k] + bisect_left(slots[k], length % whole) for k in left}
        out.append({"start": start, "whole": whole, "of": {k: (now[k], slots[k], done[k], done[k] + took[k]) for k in left}})
        for k, n in took.items():
            done[k] += n
            left[k] -= n
        left = {k: n for k, n in left.items() if n > 0}
        start += length
    return out


def mix(
    docs: DataFrame,
    targets: dict[str | None, float] | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_bytes: int = 65_536,
    alpha: float = 0.5,
    seed: int = 42,
    max_sources: int = 200,
    carry: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, phase, block, release, deadline, slot, slot_pos; with ``carry`` also
    ``row``, the whole input row.

    Reading by (slot, slot_pos) gives the mix. ``targets``: weight of each source by bytes; sources it lacks get the
    smallest weight it has. Without it, a source's weight is its bytes to the power ``alpha``. A null source is a source
    of its own; null and empty texts have size 1, so that each takes part; repeated rows and null ids stay. A document
    of more than one block takes its further blocks' slots too. More than ``max_sources`` sources: ValueError. An
    empty table gives no rows. Other columns are not read.
    """
    key, sig = row_key(id_col, text_col)
    turn = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("_src"),
        F.greatest(F.octet_length(text_of(text_col)).cast("long"), F.lit(1)).alias("_size"),
        turn.alias("_turn"),
        F.shiftright(turn, 64 - CHUNK_BITS).cast("int").alias("_chunk"),
        key,
        sig,
        *([F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []),
    )
    light = base.groupBy("_src", "_chunk").agg(F.sum("_size").alias("bytes"))
    totals = {r["_src"]: r["b"] for r in light.groupBy("_src").agg(F.sum("bytes").alias("b")).limit(max_sources + 1).collect()}
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    if targets is None:
        wanted = {k: b**alpha for k, b in totals.items()}
    else:
        named = {"" if k is None else f"={k}": float(w) for k, w in targets.items() if w > 0}
        wanted = {k: named.get(k, min(named.values(), default=1.0)) for k in totals}
    plan = phases({k: -(-b // block_bytes) for k, b in totals.items()}, exact(wanted)) if totals else []
    spark = docs.sparkSession
    rows = []
    for i, p in enumerate(plan):
        for k, (a, slots, first, last) in p["of"].items():
            if last > first:
                n, whole = len(slots), p["whole"]
                due = [min(-(-(j + 1) * whole // a), FAR) for j in range(n)]
                rows.append((k, i, p["start"], whole if n == a and last - first > n else 0, n, slots, [j * whole // a for j in range(n)], due, first, last))
    spans = spark.createDataFrame(
        rows, "_src string, phase int, start long, whole long, cycle long, slots array<long>, released array<long>, due array<long>, first long, last long"
    )  # at most max_sources phases of max_sources rows
    chunks = Window.partitionBy("_src").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = light.select("_src", "_chunk", F.coalesce(F.sum("bytes").over(chunks), F.lit(0)).alias("offset"))  # at most 2**CHUNK_BITS rows a source
    within = Window.partitionBy("_src", "_chunk").orderBy("_turn", "_k", "_sig", "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = base.withColumn("_before", F.sum("_size").over(within) - F.col("_size")).join(F.broadcast(offsets), ["_src", "_chunk"])
    placed = ran.withColumn("_at", F.col("offset") + F.col("_before")).withColumn("block", F.floor(F.col("_at") / F.lit(block_bytes)).cast("long"))
    k = F.col("block") - F.col("first")
    turns = F.col("start") + F.expr("(block - first) div cycle") * F.col("whole")

    def at(column: str):
        return (turns + F.element_at(column, (k % F.col("cycle") + 1).cast("int"))).cast("long")

    return (
        placed.join(F.broadcast(spans.withColumnRenamed("_src", "_s")), (F.col("_src") == F.col("_s")) & (F.col("block") >= F.col("first")) & (F.col("block") < F.col("last")))
        .select(
            "doc_id",
            "source",
            "phase",
            "block",
            at("released").alias("release"),
            at("due").alias("deadline"),
            at("slots").alias("slot"),
            (F.col("_at") - F.col("block") * block_bytes).cast("long").alias("slot_pos"),
            *(["row"] if carry else []),
        )
    )

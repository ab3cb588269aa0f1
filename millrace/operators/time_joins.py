"""Joins by time that need no range join: the last row before each row, and points in spans.

An as-of join is one sort of both sides together. A join of points with spans is an equal join on the parts of a binary
division of time: a span is made of at most two parts a level, a point lies in one part a level. Where only sums over each
span are wanted, no pairs are made: they are differences of running sums at the spans' two ends.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.operators.dedup import _cut as cut


def _whole(df: DataFrame) -> Column:
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def asof_join(
    left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, *, tie: str | None = None, prefix: str = "last_", strict: bool = False, within: float | None = None, chunks: int = 256
) -> DataFrame:
    """Each row of ``left`` with the last row of ``right`` of the same ``by`` and no later time, its columns named with ``prefix``.

    Times are numbers. Of right rows at one time the greatest by ``tie`` counts; with ``strict`` only earlier ones do. A row
    further back than ``within`` does not count. Rows without a match, or with a null key or time, keep nulls; right rows with nulls
    there match nothing. A key's rows are sorted within ``chunks`` ranges of time, and what the ranges before hold is carried in, so a
    hot key is dealt to many tasks.
    """
    known = right.where(F.col(by).isNotNull() & F.col(right_time).isNotNull())
    low, high = known.agg(F.min(right_time), F.max(right_time)).first()
    width = (float(high) - float(low)) / chunks if low is not None and high > low else 1.0
    chunk = lambda t: F.greatest(F.lit(0), F.least(F.lit(chunks), F.floor((F.col(t) - F.lit(low or 0)) / width)))
    nothing = lambda df: F.lit(None).cast(df.select(_whole(df).alias("s")).schema["s"].dataType)
    second = F.col(tie) if tie else F.lit(0)
    # At one time: with ``strict`` left rows come first, else right rows do.
    mine = left.select(F.col(by).alias("_by"), F.col(left_time).alias("_t"), chunk(left_time).alias("_chunk"), F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast(known.select(second.alias("x")).schema["x"].dataType).alias("_tie"), _whole(left).alias("_l"), nothing(right).alias("_r"))
    theirs = known.select(F.col(by).alias("_by"), F.col(right_time).alias("_t"), chunk(right_time).alias("_chunk"), F.lit(1 if strict else 0).alias("_side"), second.alias("_tie"), nothing(left).alias("_l"), _whole(right).alias("_r"))
    here = Window.partitionBy("_by", "_chunk").orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = mine.union(theirs).withColumn("_m", F.last("_r", ignorenulls=True).over(here)).where("_l is not null").select("_by", "_t", "_chunk", "_l", "_m")
    ends = theirs.groupBy("_by", "_chunk").agg(F.max(F.struct("_t", "_tie")).alias("_at"))
    lasts = theirs.join(ends, ["_by", "_chunk"]).where((F.col("_t") == F.col("_at._t")) & F.col("_tie").eqNullSafe(F.col("_at._tie"))).groupBy("_by", "_chunk").agg(F.first("_r").alias("_end"))
    # For each range of a key that has rows, the end of the last range before it: at most a row a key and range.
    asked = seen.where("_m is null").select("_by", "_chunk").distinct().withColumn("_end", nothing(right))
    before = Window.partitionBy("_by").orderBy("_chunk").rangeBetween(Window.unboundedPreceding, -1)
    carried = asked.withColumn("_want", F.lit(True)).union(lasts.select("_by", "_chunk", "_end", F.lit(False))).withColumn("_carry", F.last("_end", ignorenulls=True).over(before)).where("_want").select("_by", "_chunk", "_carry")
    found = seen.join(carried, ["_by", "_chunk"], "left").withColumn("_m", F.coalesce("_m", "_carry"))
    good = F.col("_t").isNotNull()
    if within is not None:
        good = good & (F.col("_t") - F.col(f"_m.`{right_time}`") <= within)
    return found.withColumn("_m", F.when(good, F.col("_m"))).select("_l.*", *(F.col(f"_m.`{c}`").alias(f"{prefix}{c}") for c in right.columns))


def points_in_spans(points: DataFrame, spans: DataFrame, time: str, start: str, end: str, *, unit: int | None = None) -> DataFrame:
    """All pairs of points and spans with start <= time < end, with the columns of both; times are whole numbers.

    Time is divided into cells of ``unit`` (None: a typical length of the spans), pairs of cells, pairs of these, and so on. The whole
    cells of a span are covered by at most two parts of each level, so that a wide span costs the logarithm of its length;
    its two ends are single cells, where times are compared. A point is sent once for each level that some span uses.
    Empty and reversed spans, and nulls, pair with nothing. Columns of both sides must differ in name.
    """
    real = spans.where(F.col(start) < F.col(end)).withColumns({"_s": F.col(start).cast("long"), "_e": F.col(end).cast("long")})
    if unit is None:
        unit = max(1, int(real.agg(F.percentile_approx(F.col("_e") - F.col("_s"), 0.5)).first()[0] or 1))
    cell = lambda c: F.floor(F.col(c) / unit)
    first, last = cell("_s"), F.floor((F.col("_e") - 1) / unit)
    celled = real.withColumns({"_a": first, "_b": last})
    # Whole cells: those between the ends. Level by level, an odd left and an even right part are taken, and the rest is halved.
    longest = celled.agg(F.max(F.col("_b") - F.col("_a"))).first()[0] or 0
    levels = max(1, math.ceil(math.log2(longest + 2)) + 1)

    def step(x: Column, level: Column) -> Column:
        lo, hi = x["lo"], x["hi"]
        open_ = lo <= hi
        left, right = open_ & (lo % 2 != 0), open_ & (hi % 2 == 0)
        part = lambda ok, at: F.when(ok, F.array(F.struct(level.cast("int").alias("level"), at.alias("part")))).otherwise(F.array().cast("array<struct<level:int,part:bigint>>"))
        same = left & right & (lo == hi)
        parts = F.concat(x["parts"], part(left, lo), part(right & ~same, hi))
        # Once nothing is left between the two it stays so; halving on could bring them together again.
        up = lambda taken, v, next_: F.when(~open_, v).otherwise(F.floor(F.when(taken, next_).otherwise(v) / 2))
        return F.struct(up(left, lo, lo + 1).alias("lo"), up(right, hi, hi - 1).alias("hi"), parts.alias("parts"))

    begin = F.struct((F.col("_a") + 1).alias("lo"), (F.col("_b") - 1).alias("hi"), F.array().cast("array<struct<level:int,part:bigint>>").alias("parts"))
    inner = F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), begin, step, lambda x: x["parts"])
    edge = F.array_distinct(F.array(F.struct(F.lit(-1).alias("level"), F.col("_a").alias("part")), F.struct(F.lit(-1).alias("level"), F.col("_b").alias("part"))))
    keyed = cut(celled.select(*spans.columns, "_s", "_e", F.explode(F.concat(edge, inner)).alias("_p")).select(*spans.columns, "_s", "_e", "_p.level", "_p.part"))
    used = sorted(r.level for r in keyed.select("level").distinct().collect())  # at most 64
    at = cell(time)
    where = F.array(*(F.struct(F.lit(v).alias("level"), (at if v < 1 else F.floor(at / F.lit(1 << v))).alias("part")) for v in used)) if used else F.array().cast("array<struct<level:int,part:bigint>>")
    sent = points.where(F.col(time).isNotNull()).select(*points.columns, F.explode(where).alias("_q"))
    met = keyed.join(sent, (F.col("level") == F.col("_q.level")) & (F.col("part") == F.col("_q.part")))
    return met.where((F.col("level") >= 0) | ((F.col(time) >= F.col("_s")) & (F.col(time) < F.col("_e")))).select(*points.columns, *spans.columns)


#: Fractions of the values are summed apart, below this power of two.
FRACTION_BITS = 20


def sums_in_spans(points: DataFrame, spans: DataFrame, time: str, start: str, end: str, value: str) -> DataFrame:
    """``spans`` with n_points and total, the count of points with start <= time < end and the sum of ``value``; times are whole numbers.

    What ``points_in_spans`` and an aggregate give, at the cost of rows, not of pairs: points and ends are added up by time, summed
    along it, and a span takes the difference. Spans without a point are left out, as are empty and reversed ones and nulls. The
    whole part of a value times 2**20 is summed as a whole number, without error, so a small sum after a large one loses nothing (but after
    values past 10**23, which are summed as doubles).
    Null values count as points and add nothing; total is null if all are. Sums of infinite values and NaN are as usual.
    """
    v = F.col(value).cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    scaled = F.when(finite, v * float(1 << FRACTION_BITS))
    # Powers of two scale a double without error; beyond 2**53 it has no fraction.
    small, fits = F.abs(scaled) < float(1 << 53), F.abs(scaled) < 1e30
    whole = F.when(small, F.floor(scaled).cast("decimal(38,0)")).when(fits, F.when(fits, scaled).cast("decimal(38,0)"))
    count = lambda c: F.when(c, 1).otherwise(0).cast("long")
    summed = {
        "_n": F.lit(1).cast("long"),
        "_known": count(v.isNotNull()),
        "_nan": count(F.coalesce(F.isnan(v), F.lit(False))),
        "_up": count(F.coalesce(v == float("inf"), F.lit(False))),
        "_down": count(F.coalesce(v == float("-inf"), F.lit(False))),
        "_whole": F.coalesce(whole, F.lit(0).cast("decimal(38,0)")),
        "_rest": F.coalesce(F.when(small, scaled - F.floor(scaled)).when(~fits, scaled), F.lit(0.0)),
    }
    added = lambda: [F.sum(c).cast("decimal(38,0)" if c == "_whole" else "double" if c == "_rest" else "long").alias(c) for c in summed]
    real = spans.where(F.col(start) < F.col(end))
    known = points.where(F.col(time).isNotNull())
    ends = real.select(F.col(start).cast("long").alias("_t")).union(real.select(F.col(end).cast("long"))).distinct()
    nothing = {c: F.lit(0).cast(known.select(x.alias("x")).schema["x"].dataType) for c, x in summed.items()}
    at = known.select(F.col(time).cast("long").alias("_t"), *(x.alias(c) for c, x in summed.items())).groupBy("_t").agg(*added())
    times = at.select("_t", *summed).union(ends.select("_t", *(x.alias(c) for c, x in nothing.items()))).groupBy("_t").agg(*added())
    # Ranges of time, as many as shuffle partitions; each is summed for itself, on top of all ranges before it.
    parts = int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(times.repartitionByRange(parts, "_t").withColumn("_part", F.spark_partition_id()))
    here = Window.partitionBy("_part").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda x, c: F.coalesce(x, nothing[c])
    offsets = ranged.groupBy("_part").agg(*added()).select("_part", *(zero(F.sum(c).over(before), c).alias(f"_before{c}") for c in summed))  # a row a range
    running = ranged.select("_t", "_part", *(zero(F.sum(c).over(here), c).alias(c) for c in summed)).join(F.broadcast(offsets), "_part")
    until = cut(running.select("_t", F.struct(*((F.col(f"_before{c}") + F.col(c)).alias(c) for c in summed)).alias("_sum")))
    first, last = (until.select(F.col("_t").alias(t), F.col("_sum").alias(s)) for t, s in (("_s", "_from"), ("_e", "_to")))
    met = real.withColumns({"_s": F.col(start).cast("long"), "_e": F.col(end).cast("long")}).join(first, "_s").join(last, "_e")
    of = {c: F.col(f"_to.{c}") - F.col(f"_from.{c}") for c in summed}
    total = F.when(of["_known"] == 0, F.lit(None).cast("double"))
    total = total.when((of["_nan"] > 0) | ((of["_up"] > 0) & (of["_down"] > 0)), float("nan")).when(of["_up"] > 0, float("inf")).when(of["_down"] > 0, float("-inf"))
    total = total.otherwise((of["_whole"].cast("double") + of["_rest"]) / float(1 << FRACTION_BITS))
    return met.where(of["_n"] > 0).select(*spans.columns, of["_n"].alias("n_points"), total.alias("total"))

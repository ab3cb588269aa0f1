"""Token sequences: packing, truncation, prompt masks, padding; and sums over training logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.functions.text import col, let, strip
from millrace.operators.dedup import _cut as cut
from millrace.operators.split import ranked

# The label that losses skip, and least lengths.
IGNORED = -100
PRETRAIN_LEAST, SFT_LEAST = 10, 10

Tokenizer = Callable[[Column], Column]


def whitespace_tokens(c: Column | str, vocabulary: int = 50_000) -> Column:
    """A stand-in for a tokenizer: words hashed to ids from 1."""
    words = F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % vocabulary + 1).cast("int"))


def pack(df: DataFrame, ids_col: str = "ids", order_col: str = "_rid", length: int = 2048, eos: int = 0, keep_exact: bool = False) -> DataFrame:
    """(chunk, input_ids, attention_mask, labels): documents joined in order, an ``eos`` after each, cut to equal lengths.

    ``order_col`` is unique and not null. The last chunk is dropped, and so is a full one that ends the text, unless
    ``keep_exact``. Places are prefix sums in two steps over (order, size) alone: within ranges of the order, as many as the session
    has shuffle partitions, and over the ranges' totals, so that no task sees all rows. A document is cut at its chunks'
    borders; only pieces move.
    """
    sized = df.select(F.col(order_col).alias("o"), F.concat(F.coalesce(F.col(ids_col), F.array().cast("array<int>")), F.array(F.lit(eos))).alias("ids")).withColumn("n", F.size("ids").cast("long"))
    sized = cut(sized)  # read twice; making the tokens costs more than writing them
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower
    ranged = cut(sized.select("o", "n").repartitionByRange("o").sortWithinPartitions("o").withColumn("_at", at)).withColumn("_part", F.shiftright("_at", 33))
    sums = ranged.groupBy("_part").agg(F.sum("n").alias("n"))  # a row a range
    offsets = cut(sums.select("_part", "n", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("offset")))
    total = offsets.agg(F.sum("n")).first()[0] or 0
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = ranged.withColumn("start", F.sum("n").over(within) - F.col("n")).join(F.broadcast(offsets.select("_part", "offset")), "_part")
    placed = sized.join(starts.select("o", (F.col("start") + F.col("offset")).alias("start")), "o")
    first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("n") - 1) / length)
    pieces = placed.select("start", "ids", "n", F.explode(F.sequence(first, last)).alias("chunk")).select(
        "chunk",
        "start",
        F.slice(
            "ids",
            F.greatest(F.col("chunk") * length - F.col("start"), F.lit(0)).cast("int") + 1,
            (F.least(F.col("start") + F.col("n"), (F.col("chunk") + 1) * length) - F.greatest(F.col("start"), F.col("chunk") * length)).cast("int"),
        ).alias("part"),
    )
    whole = total // length if keep_exact else max(0, -(-total // length) - 1)
    joined = pieces.where(F.col("chunk") < whole).groupBy("chunk").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("start", "part"))), lambda x: x["part"])).alias("input_ids"))
    return joined.withColumns({"attention_mask": F.array_repeat(F.lit(1), F.size("input_ids")), "labels": F.col("input_ids")})


def truncate(df: DataFrame, ids_col: str = "ids", length: int = 2048) -> DataFrame:
    """One sequence a row, cut to ``length``; those of ten tokens or fewer are dropped. Labels are the ids."""
    out = df.withColumn("input_ids", F.slice(ids_col, 1, length)).where(F.size("input_ids") > PRETRAIN_LEAST)
    return out.withColumns({"attention_mask": F.array_repeat(F.lit(1), F.size("input_ids")), "labels": F.col("input_ids")})


def has_pair(df: DataFrame) -> DataFrame:
    """Rows whose prompt and response aren't blank."""
    return df.where((F.coalesce(strip("prompt"), F.lit("")) != "") & (F.coalesce(strip("response"), F.lit("")) != ""))


def mask_prompt(df: DataFrame, tokenize: Tokenizer = whitespace_tokens, length: int = 2048, eos: int = 0, train_on_prompt: bool = False) -> DataFrame:
    """input_ids and labels of prompt, response and ``eos``, cut to ``length``; the prompt's labels are ignored.

    Sequences under ten tokens, and those that have no label left, are dropped.
    """
    ids = F.slice(F.concat(tokenize(F.concat("prompt", "response")), F.array(F.lit(eos))), 1, length)

    def row(x: Column) -> Column:
        labels = x["ids"] if train_on_prompt else F.transform(x["ids"], lambda t, i: F.when(i < x["p"], F.lit(IGNORED)).otherwise(t))
        return F.struct(x["ids"].alias("input_ids"), labels.alias("labels"), F.array_repeat(F.lit(1), F.size(x["ids"])).alias("attention_mask"))

    # One array of at most one row: tokens are made once, whatever looks at them.
    made = let(F.struct(ids.alias("ids"), F.size(tokenize(F.col("prompt"))).alias("p")), row)
    good = F.filter(F.array(made), lambda r: (F.size(r["input_ids"]) >= SFT_LEAST) & F.exists(r["labels"], lambda t: t != IGNORED))
    return has_pair(df).select("*", F.inline(good))


def pad_batches(df: DataFrame, batch_col: str, order_col: str, pad: int = 0) -> DataFrame:
    """Rows padded to the longest of their batch: ids with ``pad``, masks with 0, labels with the ignored one."""
    longest = df.groupBy(batch_col).agg(F.max(F.size("input_ids")).alias("_m"))
    fill = lambda c, v: F.concat(F.col(c), F.array_repeat(F.lit(v), F.col("_m") - F.size(c)))
    joined = df.join(longest, batch_col)
    return joined.select(batch_col, order_col, fill("input_ids", pad).alias("input_ids"), fill("attention_mask", 0).alias("attention_mask"), fill("labels", IGNORED).alias("labels"))


def length_groups(df: DataFrame, length: Column | str, batch_size: int = 8, mega: int | None = None, seed: int = 42, order_col: str = "_rid") -> DataFrame:
    """(order_col, length, mega, batch, place): batches of about equal lengths in a seeded order.

    The seeded order is cut to mega-batches of ``mega`` batches (None: a quarter of all, 1 to 50); within each the longest rows come
    first, ties in the seeded order. The longest row of all changes places with the very first, so that the first batch shows
    whether memory is enough. A window holds a mega-batch, whatever the number of rows.
    """
    sized = df.select(order_col, col(length).cast("long").alias("length"))
    n = sized.count()
    mega = mega or min(max(n // (4 * batch_size), 1), 50)
    drawn = ranked(sized, seed, order_col).withColumn("mega", F.floor(F.col("_rank") / (batch_size * mega)))
    own = Window.partitionBy("mega").orderBy(F.col("length").desc_nulls_last(), "_rank")
    placed = cut(drawn.withColumn("place", F.row_number().over(own).cast("long") - 1).drop("_rank"))
    longest = placed.where("place = 0").agg(F.max_by("mega", F.struct("length", -F.col("mega"))).alias("_longest"))  # one row
    swapped = F.when(F.col("place") > 0, F.col("mega")).when(F.col("mega") == 0, F.col("_longest")).when(F.col("mega") == F.col("_longest"), 0).otherwise(F.col("mega"))
    out = placed.join(F.broadcast(longest)).withColumn("mega", swapped)
    return out.select(order_col, "length", "mega", (F.col("mega") * mega + F.floor(F.col("place") / batch_size)).alias("batch"), "place")


def in_batches(df: DataFrame, groups: DataFrame, order_col: str = "_rid") -> DataFrame:
    """``df`` with mega, batch and place of ``length_groups``, laid out in that order by ranges: files, read in order, give the batches."""
    joined = df.join(groups.select(order_col, "mega", "batch", "place"), order_col)
    return joined.repartitionByRange("mega", "place").sortWithinPartitions("mega", "place")


def batch_padding(groups: DataFrame) -> DataFrame:
    """Of each batch: rows, the longest one, and the tokens that padding adds."""
    known = F.coalesce("length", F.lit(0))
    out = groups.groupBy("batch").agg(F.count("*").alias("n_rows"), F.max(known).alias("longest"), F.sum(known).alias("n_tokens"))
    return out.withColumn("padding", F.col("n_rows") * F.col("longest") - F.col("n_tokens"))


def throughput(log: DataFrame, run_col: str = "run", step_col: str = "step", tokens_col: str = "tokens", time_col: str = "time") -> DataFrame:
    """``log`` with tokens_per_second since the run's last row; null on its first."""
    w = Window.partitionBy(run_col).orderBy(step_col)
    tokens, spent = F.col(tokens_col) - F.lag(tokens_col).over(w), F.col(time_col) - F.lag(time_col).over(w)
    return log.withColumn("tokens_per_second", F.when(spent > 0, tokens / spent))


def first_bad_loss(log: DataFrame, run_col: str = "run", step_col: str = "step", loss_col: str = "loss") -> DataFrame:
    """(run, step): where each run's loss is first no finite number, and training stops."""
    bad = F.isnan(loss_col) | F.col(loss_col).isin(float("inf"), float("-inf"))
    return log.where(bad).groupBy(run_col).agg(F.min(step_col).alias(step_col))


def last_rows(log: DataFrame, n: int = 5, run_col: str = "run", step_col: str = "step") -> DataFrame:
    """The last n rows of each run's log, as a checkpoint's notes keep them."""
    w = Window.partitionBy(run_col).orderBy(F.col(step_col).desc())
    return log.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")

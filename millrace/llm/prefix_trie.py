"""A trie of conversation prefixes, and what serving each shared prefix once would save.

A prefix is the set of its (position, turn) pairs, so its key is the exclusive or of their 128-bit digests: the key of the
parent is the key without the last pair, and a running key can be cut anywhere. A conversation of any length is thereby
split over tasks: its turns are numbered by ranges, its keys run within chunks and take what the chunks before them add up
to. Sums over subtrees come from pointer jumping: every node knows its ancestor ``step`` levels up and the sum over the
``step`` levels from itself down; a round adds what the nodes whose ancestor it is hold, and doubles ``step``.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut

WORD = r"[^\x20\x09-\x0D]+"
#: Positions whose keys run in one window.
CHUNK = 1024
NODE, UP = ["n1", "n2"], ["u1", "u2"]


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Narrow rows: (conv_id, turn, said, words). ``said`` stands for role and text, null being empty."""
    who, what = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    whole = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    return conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("said"),
        F.regexp_count(what, F.lit(WORD)).cast("long").alias("words"),
    )


def _numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns by ranges with ``_at``, which follows their order, and the runs of each conversation in these ranges.

    A run has the place of its first turn, how many turns of the conversation come before it, and the length of all.
    """
    order = ["conv_id", F.col("turn").asc_nulls_first(), "said"]
    laid = cut(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "said", "words", F.monotonically_increasing_id().alias("_at")))
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    runs = laid.groupBy("conv_id", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = Window.partitionBy("conv_id")
    before = F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return laid, runs.withColumns({"_before": F.coalesce(before, F.lit(0)), "_length": F.sum("_n").over(own)})


def _plain(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, said, words, size) of conversations as they are, and (conv_id, size) of all."""
    laid, runs = _numbered(turns)
    rank = F.col("_at") - F.col("_first") + F.col("_before") + 1
    rows = laid.join(runs, ["conv_id", "_part"]).select("conv_id", rank.alias("pos"), "said", "words", F.col("_length").alias("size"))
    return rows, runs.select("conv_id", F.col("_length").alias("size")).distinct()


def _rebuilt(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The same of conversations that begin as another one: of c, h = crc32(c) % most turns are those of c - c % family."""
    laid, runs = _numbered(turns)
    runs = cut(runs)
    convs = runs.select("conv_id", F.col("_length").alias("length")).distinct()
    h, base = F.crc32(F.col("conv_id").cast("string")) % most, F.col("conv_id") - F.col("conv_id") % family
    shared = F.least("h", F.coalesce("base_length", F.lit(0)))
    heads = cut(
        convs.withColumns({"h": h, "base": base})
        .join(convs.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length")), "base", "left")
        .select("conv_id", "h", "base", shared.alias("shared"), (shared + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("size"))
    )
    rank = F.col("_at") - F.col("_first") + F.col("_before") + 1
    ranked = laid.join(runs.join(heads, "conv_id"), ["conv_id", "_part"]).withColumn("rank", rank)
    own = ranked.where("rank > h").select("conv_id", (F.col("rank") - F.col("h") + F.col("shared")).alias("pos"), "said", "words", "size")
    first = ranked.where((F.col("rank") < most) & (F.col("conv_id") % family == 0)).select(F.col("conv_id").alias("base"), "rank", "said", "words")
    lent = first.join(heads, "base").where("rank <= h").select("conv_id", F.col("rank").alias("pos"), "said", "words", "size")
    return own.union(lent), heads.select("conv_id", "size")


def _prefixes(rows: DataFrame) -> DataFrame:
    """A row for each conversation and prefix: its key (n1, n2), its parent's key (u1, u2), depth and the last turn's words."""
    rows = rows.withColumns({"_chunk": F.floor(F.col("pos") / CHUNK), "t1": F.xxhash64(F.lit(1), "said", "pos"), "t2": F.xxhash64(F.lit(2), "pos", "said")})
    here = Window.partitionBy("conv_id", "_chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "_chunk").agg(F.bit_xor("t1").alias("c1"), F.bit_xor("t2").alias("c2"))
    carried = totals.withColumns({"c1": F.bit_xor("c1").over(before), "c2": F.bit_xor("c2").over(before)}).where("_chunk > 0")
    keyed = rows.withColumns({"r1": F.bit_xor("t1").over(here), "r2": F.bit_xor("t2").over(here)}).join(carried, ["conv_id", "_chunk"], "left")
    for i in "12":
        key = F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0)))
        keyed = keyed.withColumns({f"n{i}": key, f"u{i}": key.bitwiseXOR(F.col(f"t{i}"))})
    return keyed.select(*NODE, *UP, F.col("pos").alias("depth"), "words", "conv_id", "size")


def _pieces(frames):
    """Rows sorted by node and conversation: the ids of each node, a piece of text a batch."""
    for frame in frames:
        rows = [(*key, int(part.iloc[0]), ",".join(map(str, part))) for key, part in frame.groupby(NODE, sort=False)["conv_id"]]
        yield pd.DataFrame(rows, columns=[*NODE, "first", "ids"])


def _hashed(frames):
    """Pieces sorted by node and first id: the hash of each node's ids, one piece at a time in memory."""
    node, state = None, None
    for frame in frames:
        out = []
        for *key, _, ids in frame.itertuples(index=False):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node:
                out.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
    if node:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])


def _ends(last: DataFrame) -> DataFrame:
    """From (n1, n2, conv_id): the hash of each node's ids in order.

    A hash has to be fed in order. Ids are sorted and joined by ranges, which split a node that holds many, and only
    the pieces, some thousand ids each, meet in one task.
    """
    order = [*NODE, "conv_id"]
    pieces = last.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_pieces, "n1 long, n2 long, first long, ids string")
    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInPandas(_hashed, "n1 long, n2 long, ends_sha256 string")


def _on(one: str, keys: list[str], other: str, names: list[str]) -> Column:
    (a, b), (c, d) = keys, names
    return (F.col(f"{one}.{a}") == F.col(f"{other}.{c}")) & (F.col(f"{one}.{b}") == F.col(f"{other}.{d}"))


def rolled_up(state: DataFrame, sums: list[str]) -> DataFrame:
    """From nodes (n1, n2), parents (u1, u2; of the root null), depth and ``sums``: those summed over each subtree.

    As many rounds as the depth has binary digits; each is cut to the shared folder.
    """
    deepest, step = state.agg(F.max("depth")).first()[0] or 0, 1
    while step <= deepest:
        below = state.where(F.col("depth") >= step).groupBy(*UP).agg(*(F.sum(c).alias(f"_{c}") for c in sums))
        far = state.where(F.col("depth") >= 2 * step).alias("s")
        jumped = far.join(state.select(*NODE, *UP).alias("t"), _on("s", UP, "t", NODE)).select("s.n1", "s.n2", "t.u1", "t.u2", "depth", *sums)
        near = state.where(F.col("depth") < 2 * step).withColumns({c: F.lit(None).cast("long") for c in UP})
        moved = jumped.union(near.select(jumped.columns)).alias("s")
        added = [(F.col(f"s.{c}") + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums]
        state = cut(moved.join(below.alias("b"), _on("s", NODE, "b", UP), "left").select("s.n1", "s.n2", "s.u1", "s.u2", "depth", *added))
        step *= 2
    return state.select(*NODE, *sums)


def prefix_trie(
    conversations: DataFrame,
    rebuild: tuple[int, int] | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """A row for each distinct prefix of conversations, with the root, which all share.

    Turns are ordered by ``turn``, null first; those of equal number by a digest of role and text, so repeated rows are
    repeated turns. Null roles and texts are empty; rows with a null id belong to no conversation and take no part. Columns of other names
    are not read. An empty table has no conversation and no row. With ``rebuild`` (family, most), conversation c begins
    with the first crc32(c) % most turns of c - c % family in place of its own.

    Columns: conv_id (smallest of the conversations that begin so), depth, parent_conv_id, n_convs, n_children, n_leaves (childless
    nodes below, or itself), saved_tokens (words that need not be read again, below and here), ends_sha256 (hash of the
    ids of conversations that end here).
    """
    turns = _turns(conversations, conv_id, turn, role, text)
    rows, convs = _rebuilt(turns, *rebuild) if rebuild else _plain(turns)
    convs = cut(convs)
    prefixes = cut(_prefixes(rows))
    grouped = prefixes.groupBy(*NODE).agg(
        *(F.min(c).alias(c) for c in (*UP, "depth", "words", "conv_id")),
        F.count("*").alias("n_convs"),
    )
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("n1"), zero.alias("n2"), none.alias("u1"), none.alias("u2"), zero.alias("depth"), zero.alias("words"), "conv_id", "n_convs")
    nodes = cut(grouped.select(root.columns).union(root))

    children = nodes.where("depth > 0").groupBy(*UP).agg(F.count("*").alias("n_children"))
    known = nodes.alias("n").join(children.alias("c"), _on("n", NODE, "c", UP), "left")
    known = cut(known.select("n.*", F.coalesce("n_children", zero).alias("n_children")))
    sums = rolled_up(
        known.select(*NODE, *UP, "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")),
        ["n_leaves", "saved_tokens"],
    )
    last = prefixes.where("depth = size").select(*NODE, "conv_id").union(convs.where("size = 0").select(zero, zero, "conv_id"))
    parents = nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")).alias("p")
    return (
        known.join(sums, NODE)
        .join(_ends(last), NODE, "left")
        .alias("k")
        .join(parents, _on("k", UP, "p", NODE), "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    )

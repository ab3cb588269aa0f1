"""Exact dedup by deterministic block naming.

The normalised text of a document is cut into blocks of ``block_bytes``. Distinct blocks are sorted and named by
integers; then adjacent names are paired and the distinct pairs named, again and again, until each document has a
single name. Two documents get the same (level, name) if and only if their normalised texts are equal: names stand
for blocks or pairs compared in full, never for their hashes.

What moves: each distinct block of a batch once (for naming), after that only integers. A document's blocks find
their names by a 64-bit hash; blocks that share a hash with another block are matched by their bytes instead.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut, row_key, text_of, union_all

#: Characters that don't count: space and U+0009 to U+000D.
DROPPED = b"\x20\x09\x0a\x0b\x0c\x0d"


#: Rows of a batch that are taken at once.
ROWS = 2_000


def _parts(batches):
    return (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS))


def _bodies(column):
    for text in column:
        yield (text.as_py() or "").encode("utf-8", "surrogatepass").translate(None, DROPPED)


def _describe(block_bytes: int):
    """Per document: digest of the normalised text and its blocks' hashes."""

    def run(batches):
        for batch in _parts(batches):
            shas, hashes = [], []
            for body in _bodies(batch.column("text")):
                shas.append(hashlib.sha256(body).hexdigest())
                hashes.append([xxhash.xxh64_intdigest(body[i : i + block_bytes]) - 2**63 for i in range(0, len(body), block_bytes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_k"), batch.column("_sig"), batch.column("n_cp"), pa.array(shas, pa.string()), pa.array(hashes, pa.list_(pa.int64()))],
                names=["doc_id", "_k", "_sig", "n_cp", "text_sha256", "hashes"],
            )

    return run


def _blocks(block_bytes: int):
    """The distinct blocks of each batch with their hashes."""

    def run(batches):
        for batch in _parts(batches):
            found = {body[i : i + block_bytes] for body in _bodies(batch.column("text")) for i in range(0, len(body), block_bytes)}
            blocks = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh64_intdigest(b) - 2**63 for b in blocks], pa.int64()), pa.array(blocks, pa.binary())], names=["h", "block"]
            )

    return run


def _located(block_bytes: int):
    """Every block with its document and place; only for blocks whose hashes collide."""

    def run(batches):
        for batch in _parts(batches):
            rows = [
                (k, sig, i // block_bytes, xxhash.xxh64_intdigest(body[i : i + block_bytes]) - 2**63, body[i : i + block_bytes])
                for k, sig, body in zip(batch.column("_k").to_pylist(), batch.column("_sig").to_pylist(), _bodies(batch.column("text")))
                for i in range(0, len(body), block_bytes)
            ]
            cols = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["_k", "_sig", "pos", "h", "block"])

    return run


def _named(distinct: DataFrame, *keys: str) -> DataFrame:
    """Sort distinct keys and number them from 1. The numbers are fixed once they are written."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id() + 1)


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and _k, _sig as row key.

    Texts are equal when equal after deleting space and U+0009-U+000D. Null and blank texts form one group. Of a
    group the row with the most code points stays, then the smallest id; a null id comes last; of wholly equal rows
    one is kept. Other columns of ``docs`` are not read, whatever their names. No rows in, no rows out.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), *row_key(id_col, text_col), F.length(text_of(text_col)).cast("long").alias("n_cp"))
    rows = cut(
        base.mapInArrow(_describe(block_bytes), "doc_id long, _k long, _sig long, n_cp long, text_sha256 string, hashes array<long>").withColumn(
            "rid", F.monotonically_increasing_id()
        )
    )
    distinct = base.select("text").mapInArrow(_blocks(block_bytes), "h long, block binary").repartition("h").groupBy("h", "block").agg(F.lit(1).alias("_one"))
    same = F.count("*").over(Window.partitionBy("h"))
    names = cut(_named(distinct.withColumn("n", same), "h", "block").select("h", "name", "n", F.when(F.col("n") > 1, F.col("block")).alias("block")))

    places = rows.select("rid", F.size("hashes").alias("nb"), F.posexplode("hashes").alias("pos", "h"))
    found = places.join(names.where("n = 1").select("h", "name"), "h").select("rid", "nb", "pos", "name")
    clash = names.where("n > 1").select("h", "block", "name")
    if not clash.isEmpty():
        again = base.mapInArrow(_located(block_bytes), "_k long, _sig long, pos int, h long, block binary")
        exact = again.join(clash, ["h", "block"]).select("_k", "_sig", "pos", "name").distinct()
        wide = rows.select("rid", "_k", "_sig", F.size("hashes").alias("nb"))
        found = found.union(wide.join(exact, ["_k", "_sig"]).select("rid", "nb", "pos", "name"))
    most = rows.agg(F.max(F.size("hashes"))).first()[0] or 0

    level, n, done = 0, most, [rows.where(F.size("hashes") == 0).select("rid", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("name"))]
    current = cut(found) if n > 1 else found
    while True:
        at = F.lit(level)
        done.append(current.where(F.col("nb") == 1).select("rid", at.alias("level"), "name"))
        if n <= 1:
            break
        pairs = cut(
            current.where("nb > 1")
            .groupBy("rid", "nb", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(0)).alias("b"))
        )
        pair_names = cut(_named(pairs.groupBy("a", "b").agg(F.lit(1).alias("_one")), "a", "b").select("a", "b", "name"))
        current = pairs.join(pair_names, ["a", "b"]).select("rid", F.expr("(nb + 1) div 2").cast("int").alias("nb"), "pos", "name")
        current = cut(current)
        level, n = level + 1, (n + 1) // 2
    identity = union_all(done)

    whole = cut(rows.drop("hashes").join(identity, "rid"))
    first = F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    groups = cut(whole.groupBy("level", "name").agg(F.min(first).alias("best"), F.count("*").alias("group_size")))  # written, so that the join can split a hot group
    return whole.join(groups, ["level", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), "text_sha256", "_k", "_sig"
    )

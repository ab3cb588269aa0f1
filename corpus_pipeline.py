"""A corpus pipeline in five stages, each a step from documents to training data.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, to be written as Parquet and read again as the docs of
the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, discard, keep_rows, row_key, store, table
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.mixing import mix
from millrace.llm.near_copies import similar_components
from millrace.llm.pieces import encode_pieces
from millrace.llm.queries import PIECES
from millrace.llm.simhash import simhash_groups
from millrace.llm.toxicity import score_column, train

#: SQL can't express the models, fingerprints and encodings; the tests hold each stage against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5, by a model learnt from the labelled ones among them.

    Null and empty texts have the score of no words and stay; so do repeated rows and null ids. Without labelled rows
    of both classes all stay. Columns are those of ``docs``, whatever their names; no rows in, none out.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(score_column(docs, model) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts the one that exact dedup keeps: the longest original, then the smallest id.

    Null texts count as empty, and null ids as larger than all; of wholly equal rows one stays. Columns are those of
    ``docs``, whatever their names; no rows in, none out.
    """
    return keep_rows(docs, exact_dedup(docs).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id; null ids come last."""
    found = simhash_groups(docs)
    group = ["component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("alone")]
    first = found.groupBy(*group).agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "_k", "_sig")).alias("first"))
    return keep_rows(docs, first.select("first._k", "first._sig"))


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id; null ids come last.

    Documents are linked as by ``drop_near_copies``, and where their 5-word shingles are 0.8 similar.
    """
    node = F.xxhash64("_k", "_sig").alias("node")
    found = cut(simhash_groups(docs).select("doc_id", "fingerprint", "component_id", "_k", "_sig", node))
    group = ["component_id", F.when(F.col("component_id").isNull(), F.col("fingerprint")).alias("alone")]
    hub = found.groupBy(*group).agg(F.min("node").alias("b"), F.max("node").alias("most")).where("b < most")
    same = F.col("found.component_id").eqNullSafe(F.col("hub.component_id")) & F.when(F.col("found.component_id").isNull(), F.col("fingerprint")).eqNullSafe(F.col("alone"))
    copies = found.alias("found").join(hub.alias("hub"), same).select(F.col("node").alias("a"), "b")
    roots = similar_components(docs.select(*row_key(), "text").select(node, "text"), copies)
    first = (
        found.join(roots, "node", "left")
        .groupBy(F.coalesce("root", "node").alias("group"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "_k", "_sig")).alias("first"))
    )
    return keep_rows(docs, first.select("first._k", "first._sig"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: the rows of the files, read in order, follow the target weights.

    Null and empty texts have the size of one byte, a null source is a source of its own; repeated rows and null ids stay.
    Columns are those of ``docs``, whatever their names; no rows in, none out.
    """
    mixed = mix(docs, carry=True)
    return mixed.repartitionByRange("slot", "slot_pos").sortWithinPartitions("slot", "slot_pos").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's pieces, and whether they decode to its text.

    Null and empty texts have no ids; repeated rows and null ids stay; other columns are not read; no rows in, none out.
    """
    return encode_pieces(docs, PIECES, cache=250_000)  # workers also hold what other stages left


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_similar),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored in the shared folder until the next is stored."""
    docs, old = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs, path = store(stage(spark, docs, sf_dir))
        if old:
            discard(spark, old)
        old = path
    return STAGES[-1][1](spark, docs, sf_dir)

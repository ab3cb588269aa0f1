"""Queries of the catalogue in SQL over table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.tables import register
from millrace.plans.catalogue import made, query, same

# Every sixth turn has no role, so that pairs are parted now and then.
TURNS = "conv_id ;; turn ;; CASE WHEN (conv_id + turn) % 6 = 5 THEN NULL ELSE role END AS role ;; text"


@query(
    f"""WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM {same(TURNS, "conversations")} WHERE role IN ('user', 'assistant')),
    p AS (SELECT *, lead(role) OVER w AS next, lead(text) OVER w AS answer FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
    SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INTEGER) AS place, md5(text) AS prompt, md5(answer) AS response FROM p WHERE role = 'user' AND next = 'assistant'"""
)
def sql_turn_pairs(spark, sf_dir):
    """All pairs of a user's turn and the answer to it, by a table function over each conversation's rows."""
    register(spark)
    turns = made(spark, sf_dir, TURNS, "conversations")
    pairs = spark.sql("SELECT * FROM turn_pairs(TABLE({turns}) PARTITION BY conv_id ORDER BY turn)", turns=turns)
    return pairs.select("conv_id", "place", F.md5("prompt").alias("prompt"), F.md5("response").alias("response"))


BLOCKS = (
    "doc_id ;; concat(substr(text, 1, 20), CASE WHEN doc_id % 3 = 0 THEN '' ELSE concat('```SQL', chr(10), 'SELECT ', doc_id, chr(10), '``` then ```', chr(10), text, chr(10), '```') END, CASE WHEN doc_id % 5 = 0 THEN '``` open' ELSE '' END) AS t"
)


@query(
    f"""SELECT doc_id, place, CASE place WHEN 1 THEN 'sql' ELSE 'python' END AS lang, md5(CASE place WHEN 1 THEN 'SELECT ' || doc_id || chr(10) ELSE text || chr(10) END) AS code
    FROM documents, (SELECT unnest([1, 2])::INTEGER AS place) WHERE doc_id % 3 <> 0 AND text IS NOT NULL"""
)
def sql_code_blocks(spark, sf_dir):
    """Fenced blocks as rows, by a lateral join with a table function."""
    register(spark)
    docs = made(spark, sf_dir, BLOCKS)
    return spark.sql("SELECT d.doc_id, b.place, b.lang, md5(b.code) AS code FROM {docs} d, LATERAL code_blocks(d.t) b", docs=docs)

"""The queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .common import table
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .media import align, rendered
from .mixing import mix
from .pieces import encode_pieces
from .pii import personal_data
from .prefix_trie import prefix_trie
from .quality import quality
from .setsketch import similar_documents
from .sharding import shard_documents
from .simhash import simhash_groups
from .token_counts import token_counts
from .toxicity import toxicity

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents")).drop("_k", "_sig")


def op2_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), BPE)


def op3_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_media_columns(spark, sf_dir):
    """The tables hold no audio: each row of ``embeddings`` is rendered as a recording first."""
    return align(rendered(table(spark, sf_dir, "embeddings")), id_col="vec_id", audio_col="audio").withColumnRenamed("id", "vec_id")


def op7_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents")).drop("_k", "_sig")


def op8_sentencepiece(spark, sf_dir):
    return encode_pieces(table(spark, sf_dir, "documents"), PIECES)


def op9_simhash_near_dedup(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents")).drop("_k", "_sig")


def op10_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"), rebuild=(20, 4))


def op12_hard_negatives(spark, sf_dir):
    """Some rows get the next label first, so that labels and clusters of vectors differ."""
    rows = table(spark, sf_dir, "embeddings")
    return hard_negatives(rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op13_setsketch_near_dedup(spark, sf_dir):
    return similar_documents(table(spark, sf_dir, "documents"), words=3, over=85, under=100)


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_media_columns": op6_media_columns,
    "op7_pii": op7_pii,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_sharding": op10_sharding,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_setsketch_near_dedup": op13_setsketch_near_dedup,
}

ORACLES = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
        r AS (SELECT doc_id, sha256(body) AS text_sha256,
                     first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, row_number() OVER w = 1 AS kept
              FROM d WINDOW w AS (PARTITION BY body ORDER BY length(text) DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM r""",
    "op11_prefix_trie": r"""
        WITH own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS r, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
                     lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), CAST(4294967295 AS UBIGINT)) % 4 AS h
              FROM (SELECT DISTINCT conv_id FROM own)),
        built AS (SELECT c.conv_id, r, role, text FROM c JOIN own ON own.conv_id = c.base AND r <= h UNION ALL SELECT c.conv_id, r, role, text FROM c JOIN own ON own.conv_id = c.conv_id AND r > h),
        whole AS (SELECT conv_id, coalesce(path, []) AS path FROM c LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY r) AS path FROM built GROUP BY conv_id) USING (conv_id)),
        nodes AS MATERIALIZED (SELECT node, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs FROM (SELECT conv_id, d, path[1:d] AS node FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM whole)) GROUP BY node),
        kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        known AS MATERIALIZED (SELECT nodes.*, coalesce(n, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(node[-1].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved FROM nodes LEFT JOIN kids USING (node)),
        sums AS (SELECT top AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT node[1:d] AS top, n_children, saved FROM (SELECT *, unnest(range(depth + 1)) AS d FROM known)) GROUP BY 1),
        ends AS (SELECT path AS node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM whole GROUP BY 1)
        SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
        FROM known k JOIN sums USING (node) LEFT JOIN ends USING (node) LEFT JOIN nodes p ON k.depth > 0 AND p.node = k.node[1:k.depth - 1]""",
    "op12_hard_negatives": r"""
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
              WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (SELECT p.*, s.id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
              FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op13_setsketch_near_dedup": r"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w),
        x AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
        e AS MATERIALIZED (SELECT a.doc_id AS lo, b.doc_id AS hi FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
              GROUP BY 1, 2 HAVING 185 * count(*) >= 85 * (any_value(a.n) + any_value(b.n))),
        links AS MATERIALIZED (SELECT lo AS f, hi AS t FROM e UNION ALL SELECT hi, lo FROM e),
        reach AS (SELECT doc_id AS f, doc_id AS t FROM documents UNION SELECT reach.f, links.t FROM reach JOIN links ON reach.t = links.f)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN (SELECT f AS doc_id, min(t) AS component_id FROM reach GROUP BY 1) USING (doc_id)""",
}

"""A query for each operator, over the driver's tables, with DuckDB SQL of the same rows.

The tables are prose, so queries first write into them what operators look for: markers, fences, records. These
expressions are plain SQL that both engines read alike, and the same text serves both.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import relevance_values as V
from millrace.functions import text as X
from millrace.operators import dedup, relevance, scores, tokens
from millrace.operators import split as splits
from millrace.operators.near_index import NearIndex

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def made(spark: SparkSession, sf_dir: str, columns: str, name: str = "documents") -> DataFrame:
    """A table's rows with columns made by SQL that both engines read."""
    return table(spark, sf_dir, name).selectExpr(*[c.strip() for c in columns.split(" ;; ")])


def same(columns: str, name: str = "documents") -> str:
    """The same rows for DuckDB."""
    return f"(SELECT {', '.join(columns.split(' ;; '))} FROM {name})"


# ---- SQL of the scalar functions -------------------------------------------------------------------------------------


def sql_strip(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"


def sql_lf(x: str) -> str:
    return f"replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"


def sql_clean(x: str) -> str:
    return sql_strip(sql_lf(f"coalesce({x}, '')"))


def sql_squeezed(x: str) -> str:
    return sql_strip(rf"regexp_replace({sql_lf(f"coalesce({x}, '')")}, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')")


def sql_key(x: str) -> str:
    return sql_strip(rf"regexp_replace(regexp_replace(lower({x}), '\s+', ' ', 'g'), '[^\p{{L}}\p{{N}}_\s]', '', 'g')")


def sql_first(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"


def sql_level(x: str) -> str:
    number = rf"CASE WHEN regexp_full_match({x}, '\s*[+-]?[0-9]+\s*') THEN CAST({x} AS BIGINT) END"
    return (
        f"CASE WHEN lower({x}) IN ('easy','0','beginner','1') THEN 'easy' WHEN lower({x}) IN ('medium','1','2','intermediate') THEN 'medium' "
        f"WHEN lower({x}) IN ('hard','3','4','5','difficult','expert','2','competition') THEN 'hard' WHEN {number} <= 1200 THEN 'easy' "
        f"WHEN {number} <= 2000 THEN 'medium' WHEN {number} > 2000 THEN 'hard' ELSE 'unknown' END"
    )


SHINGLES = rf"""
    k AS (SELECT doc_id, {sql_key("text")} AS k FROM documents),
    c AS (SELECT doc_id, string_split(k, '') AS c, list_filter(string_split(k, ' '), lambda w: w <> '') AS w FROM k),
    s AS (SELECT doc_id, list_distinct(list_concat(
            CASE WHEN len(c) >= 3 THEN list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2]) ELSE [] END,
            CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END)) AS s FROM c)"""


# ---- text ------------------------------------------------------------------------------------------------------------

RAGGED = (
    "doc_id ;; CASE doc_id % 5 WHEN 0 THEN '  ' || replace(text, ' ', chr(13) || chr(10)) WHEN 1 THEN text || repeat(chr(10), 6) || 'x' || chr(13) "
    "WHEN 2 THEN chr(9) || text || chr(10) WHEN 3 THEN NULL ELSE text END AS t"
)


@query(f"SELECT doc_id, CAST(length(t) AS BIGINT) AS n, md5(t) AS digest FROM (SELECT doc_id, {sql_squeezed('t')} AS t FROM {same(RAGGED)})")
def clean_text_cp(spark, sf_dir):
    t = made(spark, sf_dir, RAGGED).select("doc_id", X.clean_squeezed("t").alias("t"))
    return t.select("doc_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("digest"))


@query(f"SELECT doc_id, CAST(length(t) AS BIGINT) AS n, md5(t) AS digest FROM (SELECT doc_id, {sql_clean('t')} AS t FROM {same(RAGGED)})")
def clean_text_se(spark, sf_dir):
    t = made(spark, sf_dir, RAGGED).select("doc_id", X.clean("t").alias("t"))
    return t.select("doc_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("digest"))


@query(f"SELECT doc_id, md5({sql_key('text')}) AS key_digest FROM documents")
def normalize_hash_key(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.hash_key("text")).alias("key_digest"))


@query(f"WITH {SHINGLES} SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM s")
def shingle_counts(spark, sf_dir):
    keys = table(spark, sf_dir, "documents").repartition("doc_id").select("doc_id", X.hash_key("text").alias("k"))
    return keys.select("doc_id", F.size(X.shingles("k")).cast("long").alias("n_shingles"))


LEVELS = "doc_id ;; CASE doc_id % 4 WHEN 0 THEN concat((doc_id * 37) % 3000, '') WHEN 1 THEN CASE (doc_id div 4) % 8 WHEN 0 THEN 'Easy' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'competition' WHEN 3 THEN 'foo' WHEN 4 THEN '1200.0' WHEN 5 THEN ' 1300 ' WHEN 6 THEN '1_200' ELSE NULL END WHEN 2 THEN concat((doc_id div 4) % 8, '') ELSE concat(0 - doc_id, '') END AS d"
LEVELS_SQL = LEVELS.replace(" div ", " // ")


@query(f"SELECT doc_id, {sql_level('d')} AS difficulty FROM {same(LEVELS_SQL)}")
def difficulty_norm(spark, sf_dir):
    return made(spark, sf_dir, LEVELS).select("doc_id", X.difficulty("d").alias("difficulty"))


# Records as JSON by doc_id % 8, and what is to be read from them.
EX_JSON = """doc_id ;; CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'no json' WHEN 2 THEN '{"inputs": [" 1 ", "2", "3"], "outputs": ["a", "b"]}'
 WHEN 3 THEN '{"input": "5", "output": " y "}' WHEN 4 THEN '[{"input": "1", "output": "2"}, {"stdin": "3", "stdout": "4"}, 7]'
 WHEN 5 THEN '{"inputs": ["1","2","3","4","5","6"], "outputs": ["1","2","3","4","5","6"]}' WHEN 6 THEN '17' ELSE '{"inputs": [], "input": ["p"], "outputs": ["q"]}' END AS j"""
EX_WANT = "CASE doc_id % 8 WHEN 2 THEN '1=>a|2=>b' WHEN 3 THEN '5=>y' WHEN 4 THEN '1=>2|3=>4' WHEN 5 THEN '1=>1|2=>2|3=>3|4=>4|5=>5' WHEN 7 THEN 'p=>q' ELSE '' END"
SOL_JSON = """doc_id ;; CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'print(1)' WHEN 2 THEN '["a", "b"]' WHEN 3 THEN '17' WHEN 4 THEN '{"language": ["1", "2", "3"], "solution": ["x", "y"]}'
 WHEN 5 THEN '[{"solution": "s"}, {"code": "c"}, {"content": "t"}, {"other": "o"}, 5]' WHEN 6 THEN '  ' ELSE '[]' END AS j"""
SOL_WANT = "CASE doc_id % 8 WHEN 1 THEN 'print(1)' WHEN 2 THEN 'a|b' WHEN 4 THEN 'x|y' WHEN 5 THEN 's|c|t' ELSE '' END"


def shown_examples(c):
    return F.array_join(F.transform(c, lambda x: F.concat(x["input"], F.lit("=>"), x["output"])), "|")


@query(f"SELECT doc_id, {EX_WANT} AS examples FROM documents")
def extract_examples(spark, sf_dir):
    return made(spark, sf_dir, EX_JSON).select("doc_id", shown_examples(X.examples_of_json("j")).alias("examples"))


@query(f"SELECT doc_id, {SOL_WANT} AS solutions FROM documents")
def pick_solutions(spark, sf_dir):
    return made(spark, sf_dir, SOL_JSON).select("doc_id", F.array_join(X.solutions_of_json("j"), "|").alias("solutions"))


@query(
    """SELECT doc_id, CASE WHEN n >= 1000000000 THEN printf('%.2fB', n / 1e9) WHEN n >= 1000000 THEN printf('%.2fM', n / 1e6) WHEN n >= 1000 THEN printf('%.2fK', n / 1e3)
       ELSE CAST(n AS VARCHAR) END AS shown, round(n / 1073741824.0, 9) AS gb, CASE source WHEN 'src1' THEN 'first' ELSE source END AS full_name
       FROM (SELECT doc_id, source, CASE doc_id % 4 WHEN 0 THEN n_chars * 10 WHEN 1 THEN n_chars * 1000 + 3001 WHEN 2 THEN n_chars * 1000003 ELSE n_chars * 1000000007 END AS n FROM documents)"""
)
def size_and_alias(spark, sf_dir):
    d = made(spark, sf_dir, "doc_id ;; source ;; CASE doc_id % 4 WHEN 0 THEN n_chars * 10 WHEN 1 THEN n_chars * 1000 + 3001 WHEN 2 THEN n_chars * 1000003 ELSE n_chars * 1000000007 END AS n")
    return d.select("doc_id", X.size_text("n").alias("shown"), F.round(X.gigabytes("n"), 9).alias("gb"), X.alias("source", {"src1": "first"}).alias("full_name"))


# ---- copies ----------------------------------------------------------------------------------------------------------

FIRSTS = f"(SELECT min(doc_id) AS doc_id FROM documents GROUP BY {sql_key('text')})"


@query(f"SELECT lang, count(*) AS n FROM documents SEMI JOIN {FIRSTS} USING (doc_id) WHERE length(text) >= 100 GROUP BY lang")
def unique_by_lang(spark, sf_dir):
    """The flagship: exact dedup, a length filter, counts by language."""
    unique = dedup.dedup_exact(table(spark, sf_dir, "documents"), "text", "doc_id")
    return unique.where(F.length("text") >= 100).groupBy("lang").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id FROM {FIRSTS}")
def dedup_exact(spark, sf_dir):
    return dedup.dedup_exact(table(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id")


PAIRS = f"""{SHINGLES},
    x AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
    p AS (SELECT a.doc_id AS lo, b.doc_id AS hi, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS similarity
          FROM x a JOIN x b ON a.t = b.t AND a.doc_id < b.doc_id AND a.n >= 0.84 * b.n AND b.n >= 0.84 * a.n GROUP BY 1, 2),
    e AS MATERIALIZED (SELECT lo, hi, similarity FROM p WHERE similarity >= 0.85)"""


# MinHash as whole-number arithmetic: 31 bits of each shingle's MD5, the least of each permutation, bands of the least ones.
MINHASH = f"""{SHINGLES},
    z AS (SELECT doc_id, CAST('0x' || md5(t)[1:8] AS BIGINT) & {dedup.PRIME} AS h FROM (SELECT doc_id, unnest(s) AS t FROM s)),
    m AS (SELECT doc_id, [{", ".join(f"min((h * {a} + {b}) % {dedup.PRIME})" for a, b in dedup.permutations())}] AS m FROM z GROUP BY doc_id),
    b AS MATERIALIZED (SELECT doc_id, band, m[{dedup.ROWS} * band + 1 : {dedup.ROWS} * band + {dedup.ROWS}] AS h FROM m, (SELECT unnest(range({dedup.BANDS})) AS band))"""
# Of rows that meet in a bucket, by id: a row is dropped if a lower row that wasn't has a bucket with it.
GREEDY = """v AS MATERIALIZED (SELECT hi AS id, list(lo) AS lower, row_number() OVER (ORDER BY hi) AS r FROM e GROUP BY hi),
    g AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS dropped
          UNION ALL SELECT v.r, CASE WHEN len(list_filter(v.lower, lambda x: NOT list_contains(g.dropped, x))) > 0 THEN list_append(g.dropped, v.id) ELSE g.dropped END
          FROM g JOIN v ON v.r = g.r + 1)
    SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT unnest(dropped) FROM g WHERE r = (SELECT max(r) FROM g))"""
MET = "SELECT DISTINCT x.doc_id AS lo, y.doc_id AS hi FROM b x JOIN b y ON x.band = y.band AND x.h = y.h AND x.doc_id < y.doc_id"


@query(f"WITH RECURSIVE {MINHASH}, e AS MATERIALIZED ({MET}), {GREEDY}")
def dedup_minhash(spark, sf_dir):
    return dedup.dedup_near(table(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id")


@query(
    f"""WITH RECURSIVE {MINHASH}, e AS MATERIALIZED (SELECT lo, hi FROM ({MET}) JOIN s x ON x.doc_id = lo JOIN s y ON y.doc_id = hi
        WHERE len(list_intersect(x.s, y.s)) >= 0.85e0 * (len(x.s) + len(y.s) - len(list_intersect(x.s, y.s)))), {GREEDY}"""
)
def dedup_minhash_verified(spark, sf_dir):
    return dedup.dedup_near(table(spark, sf_dir, "documents"), "text", "doc_id", verify=True).select("doc_id")


@query(f"WITH {PAIRS} SELECT lo, hi, round(similarity, 6) AS similarity FROM e")
def dedup_jaccard_pairs(spark, sf_dir):
    pairs = dedup.similar_pairs(dedup.keys(table(spark, sf_dir, "documents"), "doc_id", "text"), 0.85)
    return pairs.select("lo", "hi", F.round("similarity", 6).alias("similarity"))


@query(
    f"""WITH RECURSIVE {PAIRS},
    v AS MATERIALIZED (SELECT hi AS id, list(lo) AS lower, row_number() OVER (ORDER BY hi) AS r FROM e GROUP BY hi),
    g AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS dropped
          UNION ALL SELECT v.r, CASE WHEN len(list_filter(v.lower, lambda x: NOT list_contains(g.dropped, x))) > 0 THEN list_append(g.dropped, v.id) ELSE g.dropped END
          FROM g JOIN v ON v.r = g.r + 1)
    SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT unnest(dropped) FROM g WHERE r = (SELECT max(r) FROM g))"""
)
def dedup_jaccard(spark, sf_dir):
    """Greedy: a row goes if a kept row before it is similar."""
    return dedup.dedup_near(table(spark, sf_dir, "documents"), "text", "doc_id", method="jaccard").select("doc_id")


@query(f"SELECT doc_id FROM documents WHERE source <> 'src1' AND {sql_key('text')} NOT IN (SELECT {sql_key('text')} FROM documents WHERE source = 'src1')")
def decontaminate_exact(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return dedup.decontaminate_exact(docs.where("source <> 'src1'"), docs.where("source = 'src1'"), "text").select("doc_id")


@query(
    f"""WITH {SHINGLES}, bk AS (SELECT item_id, {sql_key("text")} AS k FROM benchmark),
    bc AS (SELECT item_id, string_split(k, '') AS c, list_filter(string_split(k, ' '), lambda w: w <> '') AS w FROM bk),
    b AS (SELECT item_id, unnest(list_distinct(list_concat(CASE WHEN len(c) >= 3 THEN list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2]) ELSE [] END,
            CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE [] END))) AS t FROM bc),
    bn AS (SELECT item_id, count(*) AS n FROM b GROUP BY 1),
    x AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
    h AS (SELECT x.doc_id, b.item_id, count(*) AS m, any_value(x.n) AS n FROM x JOIN b USING (t) GROUP BY 1, 2)
    SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM h JOIN bn USING (item_id) WHERE m / (h.n + bn.n - m) >= 0.3)"""
)
def decontaminate_jaccard(spark, sf_dir):
    docs, held = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return dedup.decontaminate_near(docs, held, "text", "doc_id", 0.3, "jaccard", "text", "item_id").select("doc_id")


@query(
    f"""WITH {MINHASH}, held AS (SELECT band, h FROM b JOIN documents USING (doc_id) WHERE source = 'src1')
    SELECT doc_id FROM documents WHERE source <> 'src1' AND doc_id NOT IN (SELECT b.doc_id FROM b JOIN held USING (band, h))"""
)
def decontaminate_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return dedup.decontaminate_near(docs.where("source <> 'src1'"), docs.where("source = 'src1'"), "text", "doc_id").select("doc_id")


@query(f"WITH RECURSIVE {MINHASH}, e AS MATERIALIZED ({MET}), {GREEDY}")
def index_minhash(spark, sf_dir):
    """Two halves of the documents in turn, the second held against the index that the first left: the same rows as at once."""
    docs = table(spark, sf_dir, "documents")
    half = docs.agg(F.expr("percentile_approx(doc_id, 0.5)")).first()[0] or 0
    path = f"{dedup.shared_folder(spark)}/near-index-{uuid.uuid4().hex}"
    kept = None
    for run, part in (("first", docs.where(F.col("doc_id") <= half)), ("second", docs.where(F.col("doc_id") > half))):
        index = NearIndex(spark, path)
        some = dedup._cut(index.add(part, run, "text", "doc_id").select("doc_id"))
        kept = some if kept is None else kept.union(some)
        index.close()
    return kept


# ---- order and splits ------------------------------------------------------------------------------------------------

SPLIT = """(SELECT doc_id, CASE WHEN r < greatest(1, n // 100) THEN 'test' WHEN r < greatest(1, n // 100) + greatest(1, n * 2 // 100) THEN 'val' ELSE 'train' END AS split
    FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents))"""


@query(f"SELECT doc_id, split FROM {SPLIT}")
def split_assign(spark, sf_dir):
    return splits.assign_split(table(spark, sf_dir, "documents"), order_col="doc_id").select("doc_id", "split")


@query(f"SELECT split, count(*) AS n FROM {SPLIT} GROUP BY split")
def split_counts(spark, sf_dir):
    return scores.split_sizes(splits.assign_split(table(spark, sf_dir, "documents"), order_col="doc_id"))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS place FROM documents")
def seeded_order(spark, sf_dir):
    return splits.ranked(table(spark, sf_dir, "documents"), order_col="doc_id").select("doc_id", F.col("_rank").cast("long").alias("place"))


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 100")
def head_rows(spark, sf_dir):
    return splits.head(table(spark, sf_dir, "documents"), 100, "doc_id").select("doc_id")


@query(
    f"""WITH d AS (SELECT doc_id, split, {sql_key("text")} AS k FROM {SPLIT} JOIN (SELECT doc_id, coalesce(text, '') AS text FROM documents) USING (doc_id))
    SELECT doc_id, split FROM d WHERE split = 'test' OR split = 'val' AND k NOT IN (SELECT k FROM d WHERE split = 'test') OR split = 'train' AND k NOT IN (SELECT k FROM d WHERE split <> 'train')"""
)
def split_clean(spark, sf_dir):
    """A split of documents with their copies still in: decontamination takes those of test and val out of train, and of test out of val."""
    parts = splits.split(table(spark, sf_dir, "documents"), order_col="doc_id", text_col="text", method="exact", clean_val=True)
    return reduce(DataFrame.union, [df.select("doc_id", F.lit(name).alias("split")) for name, df in parts.items()])


BATCHES = """(WITH r AS (SELECT doc_id, length, r // (16 * mult) AS m, r, mult FROM (SELECT doc_id, length(text) AS length, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) - 1 AS r, least(greatest(count(*) OVER () // 64, 1), 50) AS mult FROM documents)),
    p AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY length DESC NULLS LAST, r) - 1 AS place FROM r),
    l AS (SELECT m AS lm FROM p WHERE place = 0 ORDER BY length DESC NULLS LAST, m LIMIT 1),
    s AS (SELECT doc_id, length, mult, place, CASE WHEN place > 0 THEN m WHEN m = 0 THEN lm WHEN m = lm THEN 0 ELSE m END AS mega FROM p, l)
    SELECT doc_id, length, mega, mega * mult + place // 16 AS batch, place FROM s)"""


def _batches(spark, sf_dir) -> DataFrame:
    return tokens.length_groups(table(spark, sf_dir, "documents"), F.length("text"), 16, seed=7, order_col="doc_id")


@query(f"SELECT doc_id, length, mega, batch, place FROM {BATCHES}")
def length_batches(spark, sf_dir):
    return _batches(spark, sf_dir)


@query(f"SELECT batch, count(*) AS n_rows, coalesce(max(length), 0) AS longest, CAST(coalesce(sum(length), 0) AS BIGINT) AS n_tokens, CAST(n_rows * longest - n_tokens AS BIGINT) AS padding FROM {BATCHES} GROUP BY batch")
def length_padding(spark, sf_dir):
    """What padding each batch to its longest row costs."""
    return tokens.batch_padding(_batches(spark, sf_dir))


# ---- relevance -------------------------------------------------------------------------------------------------------

MARKS = (
    "doc_id ;; source ;; CASE doc_id % 9 WHEN 0 THEN text || chr(10) || 'import pandas as pd' WHEN 1 THEN text || chr(10) || 'Time Limit: 2 seconds' "
    "WHEN 2 THEN text || chr(10) || 'SELECT a FROM t' WHEN 3 THEN text || chr(10) || 'git commit -m x' WHEN 4 THEN 'cin >> a >> b; ' || text WHEN 5 THEN 'short' "
    "WHEN 6 THEN text || chr(10) || 'try {' || chr(10) || '} catch (e)' WHEN 7 THEN NULL ELSE text END AS t ;; "
    "CASE doc_id % 5 WHEN 0 THEN ' Greedy ' WHEN 1 THEN 'HTML' WHEN 2 THEN 'docker' WHEN 3 THEN 'olympiad' ELSE NULL END AS tag ;; "
    "CASE doc_id % 7 WHEN 0 THEN 'import React from x' WHEN 1 THEN 'ok' ELSE '' END AS sol ;; "
    "CASE doc_id % 4 WHEN 0 THEN 'TACO/x' WHEN 1 THEN 'ultrachat' ELSE source END AS src"
)


def sql_any(x: str, patterns, s: str = "") -> str:
    body = "|".join(f"(?:{p})" for p in patterns).replace("'", "''")
    return f"coalesce(regexp_matches({x}, '(?:{body})', 'i{s}'), false)"


def sql_tag(tags) -> str:
    return "coalesce(trim(lower(tag)) IN (" + ", ".join("'" + t.replace("'", "''") + "'" for t in tags) + "), false)"


def sql_has(x: str, parts) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{p}')" for p in parts) + ")"


def sql_cp(signal: bool = False) -> str:
    bad = sql_any("sol", V.CP_REJECT_PATTERNS)
    more = f" AND ({sql_tag(V.CP_TAGS)} OR {sql_any('t', V.CP_PATTERNS)})" if signal else ""
    other = f"length(coalesce(t, '')) BETWEEN 50 AND 8000 AND NOT {sql_tag(V.CP_REJECT_TAGS)} AND NOT {sql_any('t', V.CP_REJECT_PATTERNS)} AND NOT {bad}{more}"
    return f"CASE WHEN {sql_has('src', V.CP_TRUSTED)} THEN NOT {bad} ELSE {other} END"


def sql_se(signal: bool = False, x: str = "t") -> str:
    bad = sql_any(x, V.SE_REJECT_PATTERNS)
    more = f" AND ({sql_tag(V.SE_TAGS)} OR {sql_any(x, V.SE_PATTERNS, 's')})" if signal else ""
    return f"CASE WHEN {sql_has('src', V.SE_TRUSTED)} THEN NOT {bad} ELSE length(coalesce({x}, '')) BETWEEN 50 AND 32000 AND NOT {sql_tag(V.SE_REJECT_TAGS)} AND NOT {bad}{more} END"


def _marked(spark, sf_dir) -> DataFrame:
    d = made(spark, sf_dir, MARKS)
    return d.select("doc_id", F.col("t").alias("problem"), F.array("sol").alias("solutions"), F.array_compact(F.array("tag")).alias("tags"), F.col("src").alias("source"))


@query(f"SELECT doc_id FROM {same(MARKS)} WHERE {sql_cp()}")
def filter_cp(spark, sf_dir):
    return _marked(spark, sf_dir).transform(relevance.cp_filter()).select("doc_id")


@query(f"SELECT doc_id FROM {same(MARKS)} WHERE {sql_cp(True)}")
def filter_cp_strict(spark, sf_dir):
    return _marked(spark, sf_dir).transform(relevance.cp_filter(need_signal=True)).select("doc_id")


@query(f"SELECT doc_id FROM {same(MARKS)} WHERE {sql_se()}")
def filter_se(spark, sf_dir):
    return _marked(spark, sf_dir).withColumnRenamed("problem", "text").transform(relevance.se_filter()).select("doc_id")


@query(f"SELECT doc_id FROM {same(MARKS)} WHERE {sql_se(True)}")
def filter_se_strict(spark, sf_dir):
    return _marked(spark, sf_dir).withColumnRenamed("problem", "text").transform(relevance.se_filter(need_signal=True)).select("doc_id")


PAIR_TEXT = "coalesce(nullif(t, ''), '') || ' ' || coalesce(sol, '')"


@query(f"SELECT doc_id FROM (SELECT doc_id, tag, src, {PAIR_TEXT} AS t FROM {same(MARKS)}) WHERE {sql_se()}")
def filter_se_records(spark, sf_dir):
    d = _marked(spark, sf_dir)
    return d.select("doc_id", F.col("problem").alias("instruction"), F.get("solutions", F.lit(0)).alias("response"), "tags", "source").transform(relevance.se_filter()).select("doc_id")


PAGE_CP = f"length(html) BETWEEN 50 AND 8000 AND NOT {sql_any('html', V.CP_REJECT_PATTERNS)}"


@query(f"SELECT page_id, {PAGE_CP} AS cp, length(html) BETWEEN 50 AND 32000 AND NOT {sql_any('html', V.SE_REJECT_PATTERNS)} AND {sql_any('html', V.SE_PATTERNS, 's')} AS se FROM pages")
def filter_pages(spark, sf_dir):
    none, blank = F.array().cast("array<string>"), F.lit("")
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", relevance.cp_relevant("html", none, none, blank).alias("cp"), relevance.se_relevant("html", none, blank, need_signal=True).alias("se"))


@query("SELECT doc_id, least(doc_id % 6, 3) AS n_solutions FROM documents")
def cap_solutions(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.array_repeat(F.lit("s"), (F.col("doc_id") % 6).cast("int")).alias("solutions"))
    return relevance.cap_solutions(d).select("doc_id", F.size("solutions").cast("long").alias("n_solutions"))


GRADED = "d.doc_id ;; CASE WHEN l.toxic = 1 THEN 'hard' WHEN l.quality = 1 THEN 'medium' WHEN l.quality = 0 THEN 'easy' END AS difficulty ;; d.doc_id % 3 = 0 AS has_examples ;; d.doc_id % 5 = 0 AS has_tests"
GRADED_SQL = f"(SELECT {', '.join(GRADED.split(' ;; '))} FROM documents d LEFT JOIN labels l USING (doc_id))"


def _graded(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents").alias("d").join(table(spark, sf_dir, "labels").alias("l"), F.expr("d.doc_id = l.doc_id"), "left").selectExpr(*GRADED.split(" ;; "))
    one = F.array(F.struct(F.lit("1").alias("input"), F.lit("2").alias("output")))
    return d.withColumns({"examples": F.when(F.col("has_examples"), one), "test_code": F.when(F.col("has_tests"), "assert True")})


@query(f"SELECT doc_id, r FROM {GRADED_SQL}, (VALUES (1), (2), (3)) v(r) WHERE (has_examples OR has_tests) AND (r = 1 OR (r = 2 AND difficulty IN ('medium', 'hard')) OR (r = 3 AND difficulty = 'hard'))")
def curriculum_cp(spark, sf_dir):
    d = _graded(spark, sf_dir)
    rounds = [relevance.cp_verifiable(d, relevance.cp_round(r)).select("doc_id", F.lit(r).alias("r")) for r in (1, 2, 3)]
    return rounds[0].union(rounds[1]).union(rounds[2])


TYPED = "doc_id ;; CASE doc_id % 5 WHEN 0 THEN 'code' WHEN 1 THEN 'debug' WHEN 2 THEN 'sql' WHEN 3 THEN 'qa' END AS type ;; CASE doc_id % 7 WHEN 0 THEN '  too short to use  ' ELSE text END AS instruction"


@query(
    f"SELECT doc_id, r FROM {same(TYPED)}, (VALUES (1), (2), (3), (4)) v(r) WHERE length({sql_strip('instruction')}) >= 20 AND "
    "(type = 'code' OR (type = 'debug' AND r <> 3) OR (type = 'sql' AND r IN (1, 4)))"
)
def curriculum_se(spark, sf_dir):
    d = made(spark, sf_dir, TYPED)
    rounds = [relevance.se_verifiable(d, relevance.se_round(r)).select("doc_id", F.lit(r).alias("r")) for r in (1, 2, 3, 4)]
    return rounds[0].union(rounds[1]).union(rounds[2]).union(rounds[3])

"""Queries of the catalogue over readers and sinks: files are written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import scores
from millrace.operators.dedup import shared_folder
from millrace.plans.catalogue import made, query, same, table
from millrace.sources import readers as R


def _folder(spark: SparkSession, name: str) -> str:
    """A new one for each call, since a result is read only later."""
    return f"{shared_folder(spark)}/catalogue-{name}-{uuid.uuid4().hex}"


# ---- sources ---------------------------------------------------------------------------------------------------------


def _values(names) -> str:
    return ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))


def _read_all(spark, sf_dir, domain: str) -> DataFrame:
    """A part of the documents under each source's folder, Parquet and JSON by turns, read back by the sources' names.

    Sources that share a folder share its rows, so parts go by folder.
    """
    root, docs = _folder(spark, f"sources_{domain}"), table(spark, sf_dir, "documents").select("doc_id", "text")
    names = R.source_names(domain)
    for i, name in enumerate(names):
        part = docs.where(F.col("doc_id") % len(names) == i)
        part.write.format("json" if i % 2 else "parquet").option("ignoreNullFields", "false").save(R.SOURCES[domain][name].folder(root))
    found = R.read_sources(spark, [*names, "no_such_source"], root, domain)
    return R.union([df.select("doc_id", F.md5("text").alias("text"), F.lit(n).alias("name")) for n, df in found.items()])


# The names as they should be, apart from the registry.
CP_NAMES = "taco apps code_contests codeforces codeforces_cots leetcode amc_aime project_euler opencode_reasoning opencode_reasoning2 kodcode code_feedback bigcodebench magicoder_evol aizu competitive_programming_v4"
SE_NAMES = (
    "the_stack_python the_stack_js the_stack_ts the_stack_go the_stack_java the_stack_rust the_stack_sql the_stack_shell commitpackft stack_exchange magicoder_oss magicoder_evol code_feedback "
    "evol_codealpaca glaive_code text_to_sql ultrachat self_oss_instruct"
)


def _sources_sql(named: str) -> str:
    names = named.split()
    return f"SELECT doc_id, md5(text) AS text, name FROM documents JOIN (VALUES {_values(names)}) v(i, name) ON doc_id % {len(names)} = i"


@query(_sources_sql(CP_NAMES))
def read_sources_cp(spark, sf_dir):
    return _read_all(spark, sf_dir, "cp")


@query(_sources_sql(SE_NAMES))
def read_sources_se(spark, sf_dir):
    return _read_all(spark, sf_dir, "se")


@query("SELECT doc_id, md5(text) AS text FROM (SELECT doc_id, text, row_number() OVER (ORDER BY md5(text), doc_id) AS r FROM documents) WHERE r <= 100")
def read_first_rows(spark, sf_dir):
    """A source's first rows: the reader's own limit."""
    root = _folder(spark, "first")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("text"))
    docs.withColumn("place", F.struct("text", "doc_id")).write.parquet(R.SOURCES["cp"]["taco"].folder(root))
    return R.read_source(spark, "taco", root, max_rows=100, order_col="place").select("doc_id", "text")


LINES = "CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN {broken} ELSE concat('{\"doc_id\": ', doc_id, ', \"shown\": \"', md5(text), '\"}') END AS value"
SHOWN = "SELECT doc_id, md5(text) AS shown FROM documents WHERE doc_id % 5 > 1"


def _lines(spark, sf_dir, broken: str, tolerant: bool) -> DataFrame:
    path = _folder(spark, "lines")
    made(spark, sf_dir, LINES.replace("{broken}", broken)).write.text(path)
    return R.read_jsonl(spark, path, "doc_id long, shown string", tolerant)


BROKEN = """concat('{"doc_id": ', doc_id, ', "sh')"""


@query(SHOWN.replace(" FROM", ", true AS broken_lines_fail FROM"))
def read_jsonl_strict(spark, sf_dir):
    """Blank lines are skipped; the same lines with broken ones among them fail the job."""
    try:
        _lines(spark, sf_dir, BROKEN, False).write.format("noop").mode("overwrite").save()
        failed = False
    except Exception as e:  # noqa: BLE001
        failed = "MALFORMED_RECORD" in str(e)
    return _lines(spark, sf_dir, "''", False).withColumn("broken_lines_fail", F.lit(failed))


@query(SHOWN)
def read_jsonl_tolerant(spark, sf_dir):
    """Broken lines are skipped too."""
    return _lines(spark, sf_dir, BROKEN, True)


RECORDS = "doc_id ;; CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('{\"chars\": ', n_chars) WHEN 2 THEN '[]' WHEN 3 THEN concat('{\"lang\": \"', lang, '\"}') ELSE concat('{\"lang\": \"', lang, '\", \"chars\": ', n_chars, ', \"tags\": [\"a\", \"', source, '\"]}') END AS j"


@query("SELECT doc_id, CASE WHEN doc_id % 6 > 2 THEN lang END AS lang, CASE WHEN doc_id % 6 > 3 THEN n_chars END AS chars, CASE WHEN doc_id % 6 > 3 THEN 'a,' || source END AS tags FROM documents")
def json_records(spark, sf_dir):
    """Records out of a column of JSON; what is broken or of another form is a record of nulls."""
    parsed = R.parse_records(made(spark, sf_dir, RECORDS), "j", "lang string, chars long, tags array<string>")
    return parsed.select("doc_id", "record.lang", "record.chars", F.array_join("record.tags", ",").alias("tags"))


# ---- sinks -----------------------------------------------------------------------------------------------------------

SOME = "doc_id ;; CASE doc_id % 4 WHEN 0 THEN substr(text, 1, 99) WHEN 1 THEN substr(text, 1, 100) WHEN 2 THEN NULL ELSE text END AS text"


@query(f"SELECT md5(text) AS text, count(*) AS n FROM {same(SOME)} WHERE length(text) >= 100 GROUP BY 1")
def sink_documents(spark, sf_dir):
    path = _folder(spark, "documents")
    R.write_documents(made(spark, sf_dir, SOME), path)
    return R.read_jsonl(spark, path, "text string").groupBy(F.md5("text").alias("text")).agg(F.count("*").alias("n"))


PAIRED = "doc_id ;; CASE WHEN doc_id % 5 > 0 THEN concat('Q', chr(10), substr(text, 1, 50)) END AS prompt ;; CASE WHEN doc_id % 7 > 0 THEN text END AS response ;; CASE doc_id % 3 WHEN 0 THEN 'pretrain' WHEN 1 THEN 'code' END AS type"


@query(f"SELECT doc_id, md5(prompt) AS prompt, md5(response) AS response, type FROM {same(PAIRED)} WHERE prompt IS NOT NULL AND response IS NOT NULL AND coalesce(type, '') <> 'pretrain'")
def sink_pairs(spark, sf_dir):
    path = _folder(spark, "pairs")
    R.write_pairs(made(spark, sf_dir, PAIRED), path)
    return R.read_jsonl(spark, path, "doc_id long, prompt string, response string, type string").select("doc_id", F.md5("prompt").alias("prompt"), F.md5("response").alias("response"), "type")


@query("SELECT doc_id, md5(text) AS text, lang, source, n_chars FROM documents WHERE doc_id % 3 = 0")
def sink_jsonl(spark, sf_dir):
    path = _folder(spark, "jsonl")
    docs = table(spark, sf_dir, "documents")
    R.write_jsonl(docs, path, F.col("doc_id") % 3 == 0)
    return R.read_jsonl(spark, path, docs.schema).withColumn("text", F.md5("text")).select("doc_id", "text", "lang", "source", "n_chars")


@query("SELECT lang, count(*) AS n, true AS complete, false AS complete_elsewhere FROM documents GROUP BY lang")
def sink_summary(spark, sf_dir):
    """Counts in one file, and whether an output is complete, by which a stage is skipped."""
    path = _folder(spark, "summary")
    R.write_summary(table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n")), path)
    return R.read_jsonl(spark, path, "lang string, n long").withColumns({"complete": F.lit(R.written(spark, path)), "complete_elsewhere": F.lit(R.written(spark, f"{path}-not"))})


CANDIDATES = "doc_id // 4 AS problem_id ;; CAST(doc_id % 4 AS INTEGER) AS sample_idx ;; quality = 1 AS verified ;; concat('print(', doc_id, ')') AS code"
CANDIDATES_SPARK = CANDIDATES.replace("//", "div").replace("AS INTEGER", "AS INT")


@query(
    f"""SELECT problem_id, arg_min(code, sample_idx) AS solutions, 'rft/' || CASE WHEN problem_id % 2 = 0 THEN 'taco' ELSE '' END AS source
    FROM {same(CANDIDATES, 'labels')} WHERE verified AND problem_id % 3 > 0 GROUP BY problem_id"""
)
def sink_rejection_samples(spark, sf_dir):
    """Records with their first verified candidate, as a file."""
    path = _folder(spark, "rft")
    given = made(spark, sf_dir, CANDIDATES_SPARK, "labels").withColumn("completion", F.col("code"))
    records = given.select("problem_id").distinct().where("problem_id % 3 > 0").select("problem_id", F.when(F.col("problem_id") % 2 == 0, "taco").alias("source"))
    R.write_jsonl(scores.rft_records(records, given), path)
    back = R.read_jsonl(spark, path, "problem_id long, solutions array<string>, source string")
    return back.select("problem_id", F.array_join("solutions", "|").alias("solutions"), "source")


@query(f"SELECT problem_id, count(*) AS n_samples, CAST(count(*) FILTER (WHERE verified) AS BIGINT) AS n_correct FROM {same(CANDIDATES, 'labels')} GROUP BY problem_id")
def sink_problem_scores(spark, sf_dir):
    """A line for each problem of an evaluation."""
    path = _folder(spark, "problems")
    R.write_jsonl(scores.per_problem(made(spark, sf_dir, CANDIDATES_SPARK, "labels").withColumn("passed", F.col("verified")), (1,)), path)
    return R.read_jsonl(spark, path, "problem_id long, n_samples long, n_correct long")

"""Queries of the catalogue that run programs: every document is a candidate of its own, made from its values.

What a program prints follows from the document's numbers, and so does what is expected of it; the SQL works out both and
compares them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import extract as E
from millrace.operators import scores, verify
from millrace.operators.dedup import shared_folder
from millrace.plans.catalogue import made, query, same
from millrace.sources import readers as R

READ = "'a, b = map(int, input().split())', chr(10)"
CODE = f"""CASE doc_id % 8
    WHEN 0 THEN concat({READ}, 'print((a * b + ', doc_id, ') % 3)')
    WHEN 1 THEN concat({READ}, 'print((a + b) % 3)  # ', doc_id)
    WHEN 2 THEN concat({READ}, 'assert a % 4 != ', doc_id % 4, ', ', doc_id, chr(10), 'print((a + b) % 3)')
    WHEN 3 THEN concat('raise ValueError(', doc_id, ')')
    WHEN 4 THEN concat('print(', doc_id)
    WHEN 5 THEN concat({READ}, CASE WHEN doc_id % 2000 = 5 THEN 'while True: pass' ELSE 'print((a + b) % 3)' END, '  # ', doc_id, chr(10), 'raise SystemExit(3)')
    WHEN 6 THEN concat('import sys', chr(10), 'a, b = map(int, sys.stdin.read().split())', chr(10), 'print("", (a + b) % 3, " ")  # ', doc_id)
    ELSE concat({READ}, 'print(a % 3)  # ', doc_id) END"""
PROGRAMS = f"doc_id ;; CAST(coalesce(n_chars, 0) AS BIGINT) AS n ;; doc_id % 16 <> 9 AS shown ;; {CODE} AS code"
#: What each program comes to on examples i = 1, 2, 3 of its document: a and b are read, (a + b) % 3 is wanted.
RUNS = f"""(SELECT *, CASE doc_id % 8
        WHEN 0 THEN CASE WHEN (a * b + doc_id) % 3 = (a + b) % 3 THEN 'passed' ELSE 'wrong_answer' END
        WHEN 2 THEN CASE WHEN a % 4 = doc_id % 4 THEN 'runtime_error' ELSE 'passed' END
        WHEN 3 THEN 'runtime_error' WHEN 4 THEN 'runtime_error'
        WHEN 5 THEN CASE WHEN doc_id % 2000 = 5 THEN 'timeout' ELSE 'passed' END
        WHEN 7 THEN CASE WHEN a % 3 = (a + b) % 3 THEN 'passed' ELSE 'wrong_answer' END ELSE 'passed' END AS why
    FROM (SELECT d.*, i, n + i AS a, of * i % 97 AS b FROM (SELECT *, {{of}} AS of FROM {{programs}}) d, (SELECT unnest([1, 2, 3]) AS i)))"""
OWN_RUNS = RUNS.format(of="doc_id", programs=same(PROGRAMS))


def _examples(n, of):
    """Three examples of a document: n + i and of * i % 97, and their sum modulo 3."""
    one = lambda i: (n + i, of * i % 97)
    return F.array(*(F.struct(F.concat_ws(" ", *(x.cast("string") for x in one(i))).alias("input"), ((one(i)[0] + one(i)[1]) % 3).cast("string").alias("output")) for i in (1, 2, 3)))


def _candidates(spark, sf_dir) -> DataFrame:
    d = made(spark, sf_dir, PROGRAMS)
    return d.withColumn("examples", F.when(F.col("shown"), _examples(F.col("n"), F.col("doc_id"))))


@query(
    f"""SELECT doc_id, doc_id % 8 <> 4 AS valid_syntax, shown AS has_examples, round(CASE WHEN shown THEN rate ELSE 0e0 END, 9) AS pass_rate,
    CASE WHEN doc_id % 8 <> 4 AND (rate = 1 OR NOT shown) THEN own ELSE 0e0 END AS self_rate, shown AND rate = 1 AS passed,
    CASE WHEN NOT shown THEN 'no_examples' ELSE coalesce(first_bad, 'passed') END AS reason
    FROM (SELECT doc_id, shown, avg(CASE WHEN why = 'passed' THEN 1e0 ELSE 0e0 END) AS rate, avg(CASE WHEN why = 'passed' THEN 1e0 ELSE 0e0 END) FILTER (WHERE i < 3) AS own,
          min(i || why) FILTER (WHERE why <> 'passed') AS worst, worst[2:] || '_example_' || worst[1] AS named, replace(named, 'timeout_example', 'timeout_on_example') AS first_bad FROM {OWN_RUNS} GROUP BY doc_id, shown)"""
)
def verify_programs(spark, sf_dir):
    """Each document's program on three examples, with its own tests (the first two examples)."""
    d = _candidates(spark, sf_dir).withColumns({"test_code": F.lit(None).cast("string"), "self_tests": F.slice(_examples(F.col("n"), F.col("doc_id")), 1, 2)})
    checked = verify.score_programs(d, seconds=1.0, reasons=True)
    return checked.select("doc_id", "valid_syntax", "has_examples", F.round("pass_rate", 9).alias("pass_rate"), "self_rate", "passed", "reason")


UNITS = (
    "doc_id ;; CASE doc_id % 5 WHEN 0 THEN concat('def f(x):', chr(10), '    return x + ', doc_id) WHEN 1 THEN concat('def f(x):', chr(10), '    return x % ', 2 + doc_id % 3) "
    "WHEN 2 THEN concat('raise ValueError(', doc_id, ')') WHEN 3 THEN concat('print(\"Ran 9 tests\", ', doc_id, ')', chr(10), 'def f(x): return 0') ELSE concat('def f(x', doc_id) END AS code ;; "
    "concat('import unittest', chr(10), 'class T(unittest.TestCase):', chr(10), '    def test_a(self): self.assertEqual(f(', coalesce(n_chars, 0), '), ', coalesce(n_chars, 0) + doc_id, ')', chr(10), "
    "'    def test_b(self): self.assertEqual(f(', coalesce(n_chars, 0), '), ', coalesce(n_chars, 0) % 3, ')', chr(10), '    def test_c(self): self.assertLess(f(1), 2)') AS test_code ;; CAST(coalesce(n_chars, 0) AS BIGINT) AS n"
)
F_OF = "CASE doc_id % 5 WHEN 0 THEN {x} + doc_id WHEN 1 THEN {x} % (2 + doc_id % 3) WHEN 3 THEN 0 END"
_one = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"


@query(f"SELECT doc_id, round(({_one(F_OF.format(x='n') + ' = n + doc_id')} + {_one(F_OF.format(x='n') + ' = n % 3')} + {_one(F_OF.format(x='1') + ' < 2')}) / 3e0, 9) AS pass_rate FROM {same(UNITS)}")
def verify_unit_tests(spark, sf_dir):
    """Each document's function with three unit tests of its own."""
    d = made(spark, sf_dir, UNITS).withColumn("examples", F.array().cast("array<struct<input:string,output:string>>"))
    return verify.score_programs(d, seconds=2.0).select("doc_id", F.round("pass_rate", 9).alias("pass_rate"))


ANSWERS = (
    "doc_id ;; CASE doc_id % 5 WHEN 0 THEN 'sql' WHEN 1 THEN 'sql' WHEN 2 THEN 'code' WHEN 3 THEN 'qa' ELSE 'debug' END AS type ;; "
    "concat('Schema:', chr(10), 'CREATE TABLE t_en (a INT); CREATE TABLE t_de (a INT, b', doc_id, ' INT);') AS context ;; CASE doc_id % 5 "
    "WHEN 0 THEN concat('```sql', chr(10), 'SELECT a + ', doc_id, ' FROM t_', coalesce(lang, 'none'), chr(10), '```') WHEN 1 THEN concat('```', chr(10), 'x', doc_id, chr(10), '```') "
    "WHEN 2 THEN concat('<think>', repeat('why ', doc_id % 30), '</think>```python', chr(10), 'x = ', coalesce(n_chars, 0), chr(10), 'assert x % 3 != ', doc_id % 3, chr(10), '```<tests>assert x % 2 == 0, ', doc_id, '</tests>') "
    "WHEN 3 THEN concat('```', chr(10), 'x = ', CASE WHEN doc_id % 2 = 0 THEN '= ' ELSE '' END, doc_id, chr(10), '```') "
    "ELSE CASE WHEN doc_id % 10 = 9 THEN 'none' ELSE concat('```python', chr(10), 'print(', doc_id, chr(10), '```') END END AS t ;; CAST(coalesce(n_chars, 0) AS BIGINT) AS n ;; lang"
)


@query(
    f"""SELECT doc_id, exec_reward, self_pass, any_valid, CASE doc_id % 5 WHEN 3 THEN any_valid ELSE exec_reward >= 9e-1 END AS verified,
    round(least(1e0, CASE WHEN doc_id % 10 = 9 THEN 0e0 ELSE 1e-1 END + CASE WHEN doc_id % 5 = 2 AND 4 * (doc_id % 30) - 1 > 50 THEN 8e-2 ELSE 0e0 END
        + CASE WHEN doc_id % 5 = 3 THEN CASE WHEN any_valid THEN 2e-1 ELSE 0e0 END ELSE exec_reward END + CASE WHEN self_pass THEN 15e-2 ELSE 0e0 END), 9) AS reward
    FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN CASE WHEN lang IN ('en', 'de') THEN 1e0 ELSE 5e-1 END WHEN 2 THEN CASE WHEN n % 3 <> doc_id % 3 THEN 1e0 ELSE 3e-1 END ELSE 0e0 END AS exec_reward,
          doc_id % 5 = 2 AND n % 3 <> doc_id % 3 AND n % 2 = 0 AS self_pass, CASE doc_id % 5 WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN doc_id % 2 = 1 ELSE false END AS any_valid FROM {same(ANSWERS)})"""
)
def verify_answers(spark, sf_dir):
    """Each document's answer: queries on its schema, programs with tests of their own, other code by its form."""
    d = made(spark, sf_dir, ANSWERS).select("doc_id", "type", E.named_blocks("t").alias("blocks"), "context", E.self_test_code("t").alias("self_test_code"), E.has_reasoning("t").alias("reasoned"))
    scored = verify.score_answers(d, seconds=2.0).withColumn("reward", F.round(scores.se_reward(), 9))
    return scored.select("doc_id", "exec_reward", "self_pass", "any_valid", "verified", "reward")


TRIED = (
    f"doc_id ;; CAST(coalesce(n_chars, 0) AS BIGINT) AS n ;; doc_id % 10 <> 9 AS shown ;; concat({READ}, 'print((a * b + ', doc_id, ') % 3)') AS s1 ;; concat({READ}, 'print((2 * a + b) % 3)  # ', doc_id) AS s2 ;; "
    f"concat({READ}, 'print((a + b) % ', CASE WHEN doc_id % 4 = 0 THEN 3 ELSE 1000 END, ')  # ', doc_id) AS s3"
)
_all = lambda c: " AND ".join(f"({c.replace('$a', f'(n + {i})').replace('$b', f'(doc_id * {i} % 97)')})" for i in (1, 2, 3))
SUM = "($a + $b) % 3"
HELD = (
    f"(SELECT doc_id, shown, s1, CASE WHEN {_all(f'($a * $b + doc_id) % 3 = {SUM}')} THEN s1 WHEN {_all(f'(2 * $a + $b) % 3 = {SUM}')} THEN s2 "
    f"WHEN {_all(f'($a + $b) % CASE WHEN doc_id % 4 = 0 THEN 3 ELSE 1000 END = {SUM}')} THEN s3 END AS held, concat(s1, '|', s2, '|', s3) AS every FROM {same(TRIED)})"
)


def _verified(spark, sf_dir) -> DataFrame:
    d = made(spark, sf_dir, TRIED)
    records = d.select("doc_id", F.array("s1", "s2", "s3").alias("solutions"), F.when(F.col("shown"), _examples(F.col("n"), F.col("doc_id"))).alias("examples"), F.lit("").alias("test_code"))
    return verify.keep_verified(records, 2.0)


@query(f"SELECT doc_id, CASE WHEN shown THEN held ELSE every END AS solutions FROM {HELD} WHERE NOT shown OR held IS NOT NULL")
def keep_verified(spark, sf_dir):
    """Each document's three solutions, of which the first that holds stays."""
    return _verified(spark, sf_dir).select("doc_id", F.array_join("solutions", "|").alias("solutions"))


@query(f"SELECT doc_id, concat('Add ', doc_id) AS prompt, CASE WHEN shown THEN held ELSE s1 END AS response FROM {HELD} WHERE NOT shown OR held IS NOT NULL")
def sink_verified_pairs(spark, sf_dir):
    """Records whose solutions hold, or can't be tested, as pairs in a file."""
    path = f"{shared_folder(spark)}/catalogue-verified-{uuid.uuid4().hex}"
    pairs = _verified(spark, sf_dir).select("doc_id", F.concat(F.lit("Add "), "doc_id").alias("prompt"), F.col("solutions")[0].alias("response"))
    R.write_pairs(pairs, path)
    return R.read_jsonl(spark, path, "doc_id long, prompt string, response string")


# Four candidates a problem: a document is one, and its group's first number gives the examples.
SAMPLED = PROGRAMS.replace("doc_id % 16 <> 9", "doc_id // 4 % 7 <> 3")
PROBLEM_RUNS = RUNS.format(of="4 * (doc_id // 4)", programs=f"(SELECT doc_id, shown, code, doc_id // 4 AS n FROM {same(SAMPLED)})")


@query(
    f"""SELECT problem_id, skipped, n_samples, n_correct, round(CASE WHEN skipped THEN NULL ELSE n_correct / n_samples END, 9) AS pass_1, first_right FROM (
    SELECT doc_id // 4 AS problem_id, NOT shown AS skipped, CASE WHEN shown THEN count(*) ELSE 0 END AS n_samples, CASE WHEN shown THEN count(*) FILTER (WHERE good) ELSE 0 END AS n_correct,
    CASE WHEN shown THEN min(doc_id % 4) FILTER (WHERE good) END AS first_right FROM (SELECT doc_id, shown, bool_and(why = 'passed') AS good FROM {PROBLEM_RUNS} GROUP BY doc_id, shown) GROUP BY 1, shown)"""
)
def evaluate_candidates(spark, sf_dir):
    """Candidates are joined to their problems' examples, run, and counted by problem."""
    d = made(spark, sf_dir, SAMPLED.replace("//", "div")).withColumn("problem_id", F.expr("doc_id div 4"))
    problems = d.groupBy("problem_id").agg(F.first("shown").alias("shown"))
    problems = problems.select("problem_id", F.when(F.col("shown"), _examples(F.col("problem_id"), 4 * F.col("problem_id"))).alias("examples"))
    candidates = d.select("problem_id", (F.col("doc_id") % 4).alias("sample_idx"), "code")
    found = verify.evaluate(problems, candidates, (1,), seconds=1.0)
    return found.select("problem_id", "skipped", "n_samples", "n_correct", F.round("pass_1", 9).alias("pass_1"), "first_right")

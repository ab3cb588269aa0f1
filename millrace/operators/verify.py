"""Verification by running programs: scores of candidates against examples, unit tests and databases.

The grain is a run: a program on one input, a program with its unit tests, or a query on a schema. Candidates are exploded
to runs, equal runs of all candidates happen once, and what they gave is joined back and aggregated to rates and first
failures. So neither a candidate with many examples nor a program that many candidates share holds a task. Where one
failure decides, cheap checks come first and only what survives is run on more: examples are taken 1, 2, 4, ... at a time.
Nothing here runs unless a caller asks for it.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.extract import normal_output, parsed, valid_python
from millrace.operators.dedup import _cut as cut
from millrace.operators.programs import Limits, Outcome, Server, plain, sql_score, test_counts, worker_server
from millrace.operators.scores import per_problem

# Scores of a run.
SYNTAX_ERROR, RUNTIME_ERROR, TIMEOUT, RUNS = 0.0, 0.3, 0.5, 1.0
#: Kinds of runs. A task is given so many of them, until there are so many tasks a core; then more, up to a most.
RUN, TESTS, SQL = "run", "tests", "sql"
A_TASK, A_CORE, A_TASK_MOST = 64, 32, 4096
OUTCOME = "stdout string, stderr string, late boolean, code int, elapsed double, ran int, failed int, well boolean, score double"


def _outcomes(memory_mb: int):
    def one(server: Server, kind: str, program: str, given: str, seconds: float) -> tuple:
        if kind == SQL:
            return "", "", False, 0, 0.0, 0, 0, True, sql_score(program, given, seconds)
        tree, limits = parsed(program), Limits(seconds, memory_mb)
        if tree is None:
            r = Outcome("", "SyntaxError", False, 1, 0.0)
        elif kind == RUN and plain(tree):
            r = server.run_plain(program, given, limits)
        else:
            r = server.run(program, given, limits, kind == TESTS)
        if kind == TESTS:
            return "", "", r.timed_out, r.code, r.elapsed, *test_counts(r), 0.0
        score = SYNTAX_ERROR if r.stderr == "SyntaxError" else RUNS if r.code == 0 else TIMEOUT if r.timed_out or "timeout" in r.stderr else RUNTIME_ERROR
        return r.stdout, r.stderr[-200:], r.timed_out, r.code, r.elapsed, 0, 0, False, score

    def run(frames):
        names, server = [c.split()[0] for c in OUTCOME.split(", ")], worker_server()
        for frame in frames:
            rows = [one(server, *r) for r in zip(frame["kind"], frame["program"], frame["given"], frame["seconds"])]
            yield pd.concat([frame[["_run"]].reset_index(drop=True), pd.DataFrame(rows, columns=names)], axis=1)

    return run


def _tasks(n: int, cores: int) -> int:
    """Tasks of n runs. Each fetches from every task before it and writes a file, so their number must not follow that of the runs."""
    return max(cores, min(math.ceil(n / A_TASK), A_CORE * cores), math.ceil(n / A_TASK_MOST))


def _keyed(runs: DataFrame) -> DataFrame:
    filled = runs.withColumns({c: F.coalesce(c, F.lit("")) for c in ("program", "given")})
    key = F.sha2(F.concat_ws(":", "kind", F.col("seconds").cast("string"), F.length("program").cast("string"), F.concat("program", "given")), 256)
    return filled.withColumn("_run", key)


def outcomes(runs: DataFrame, memory_mb: int = 512, done: list[DataFrame] | None = None) -> DataFrame:
    """``runs`` (kind, program, given, seconds and others) with what each gave; nulls are empty. Equal ones run once.

    Runs are dealt to tasks by number, not by size: the programs are what costs. The result is cut to the shared folder, so that a
    lost executor costs its own runs only. What is in ``done``, tables of earlier results, isn't run again; the new ones are added to it.
    """
    keyed = _keyed(runs)
    wanted = keyed.select("_run", "kind", "program", "given", "seconds").dropDuplicates(["_run"])
    for before in done or []:
        wanted = wanted.join(before.select("_run"), "_run", "left_anti")
    distinct = cut(wanted)
    tasks = _tasks(distinct.count(), runs.sparkSession.sparkContext.defaultParallelism)
    found = cut(distinct.repartition(tasks, "_run").mapInPandas(_outcomes(memory_mb), f"_run string, {OUTCOME}"))
    known = reduce(DataFrame.union, done, found) if done else found
    if done is not None:
        done.append(found)
    return keyed.drop("program", "given").join(known, "_run").drop("_run")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_row``, a number that stays."""
    return cut(rows.withColumn("_row", F.monotonically_increasing_id()))


def _of_examples(rows: DataFrame, code: Column, examples: Column, seconds: float, first: int = 1, most: int | None = None) -> DataFrame:
    """Runs of each row's examples from the ``first``: (_row, place, want, kind, program, given, seconds)."""
    some = F.slice(examples, first, most) if most else examples
    each = rows.select("_row", code.alias("program"), F.posexplode(some).alias("_at", "_x"))
    return each.select("_row", (F.col("_at") + first).alias("place"), F.col("_x.output").alias("want"), F.lit(RUN).alias("kind"), "program", F.col("_x.input").alias("given"), F.lit(float(seconds)).alias("seconds"))


def verdict(strict: bool = True) -> Column:
    """What a run of an example came to: passed, or why not. Unless ``strict``, errors don't count, only the output."""
    silent = F.lit(strict) & (F.col("stderr") != "") & (F.col("stdout") == "")
    same = normal_output("stdout") == normal_output(F.coalesce("want", F.lit("")))
    return F.when(F.col("late"), "timeout_on_example").when(silent, "runtime_error_example").when(same, "passed").otherwise("wrong_answer_example")


def _given(examples: Column) -> Column:
    return F.coalesce(F.size(examples), F.lit(0)) > 0


def _rates(rows: DataFrame, code: Column, examples: Column, seconds: float, memory_mb: int, done: list[DataFrame] | None = None) -> DataFrame:
    """(_row, rate, spent, worst): share of examples passed, mean time and the first that isn't passed, of rows that have some."""
    judged = outcomes(_of_examples(rows, code, examples, seconds), memory_mb, done).withColumn("why", verdict())
    passed = F.col("why") == "passed"
    return judged.groupBy("_row").agg(F.avg(passed.cast("double")).alias("rate"), F.avg("elapsed").alias("spent"), F.min(F.when(~passed, F.struct("place", "why"))).alias("worst"))


def _test_rates(rows: DataFrame, code: Column, tests: Column, seconds: float, memory_mb: int) -> DataFrame:
    """(_row, rate, spent, well): share of unit tests passed, the time, and whether some ran and all passed."""
    source = F.concat(code, F.lit("\n\n"), tests)
    judged = outcomes(rows.select("_row", F.lit(TESTS).alias("kind"), source.alias("program"), F.lit("").alias("given"), F.lit(float(seconds)).alias("seconds")), memory_mb)
    rate = F.when(F.col("ran") > 0, F.greatest(F.col("ran") - F.col("failed"), F.lit(0)) / F.col("ran")).otherwise(0.0)
    return judged.select("_row", rate.alias("rate"), F.col("elapsed").alias("spent"), (F.col("well") & (F.col("ran") > 0)).alias("well"))


def score_programs(candidates: DataFrame, *, code_col: str = "code", examples_col: str = "examples", tests_col: str = "test_code", own_col: str = "self_tests", seconds: float = 10.0, memory_mb: int = 512, reasons: bool = False) -> DataFrame:
    """``candidates`` with valid_syntax, has_examples, pass_rate, elapsed and self_rate.

    Examples come first, unit tests (five seconds more) where there are none; with neither, the rate is 0 and the time all
    that was allowed. The candidate's own tests run once the given examples pass, or where there are none. What doesn't
    parse fails without being run. With ``reasons`` also passed and reason, as ``check_programs`` gives them, from the same runs.
    """
    rows, done = _numbered(candidates), []
    code = F.coalesce(code_col, F.lit(""))
    column = lambda name, kind: F.col(name) if name in candidates.columns else F.lit(None).cast(kind)
    examples, tests = F.col(examples_col), F.coalesce(column(tests_col, "string"), F.lit(""))
    tested = rows.where(~_given(examples) & (F.trim(tests) != ""))
    found = _rates(rows, code, examples, seconds, memory_mb, done).unionByName(_test_rates(tested, code, tests, seconds + 5, memory_mb).drop("well"), allowMissingColumns=True)
    scored = cut(rows.join(found, "_row", "left").withColumns({"valid_syntax": valid_python(code_col), "has_examples": _given(examples)}))
    spent = F.coalesce("spent", F.when(tests == "", F.lit(float(seconds))).otherwise(0.0))
    scored = scored.withColumns({"pass_rate": F.coalesce("rate", F.lit(0.0)), "elapsed": spent}).drop("rate", "spent")
    if own_col in candidates.columns:
        worth = scored.where(F.col("valid_syntax") & ((F.col("pass_rate") >= 1) | ~F.col("has_examples")))
        own = _rates(worth, code, F.col(own_col), seconds, memory_mb, done).select("_row", F.col("rate").alias("self_rate"))
        scored = scored.join(own, "_row", "left").withColumn("self_rate", F.coalesce("self_rate", F.lit(0.0)))
    else:
        scored = scored.withColumn("self_rate", F.lit(0.0))
    told = scored.withColumns(_told(examples, F.col("worst.why"), F.col("worst.place"))) if reasons else scored
    return told.select(*candidates.columns, "valid_syntax", "has_examples", "pass_rate", "elapsed", "self_rate", *(("passed", "reason") if reasons else ()))


def _told(examples: Column, why: Column, place: Column) -> dict[str, Column]:
    """passed and reason by the first failure, null where there is none."""
    reason = F.when(~_given(examples), "no_examples").when(why.isNull(), "passed").otherwise(F.concat_ws("_", why, place))
    return {"passed": reason == "passed", "reason": reason}


def _first_failures(rows: DataFrame, code: Column, examples: Column, seconds: float, memory_mb: int, strict: bool = True) -> DataFrame:
    """(_row, place, why) of the first example that each failing row fails, by rounds of 1, 2, 4, ... examples."""
    deepest = rows.agg(F.max(F.size(examples))).first()[0] or 0
    first, most, found = 1, 1, None
    while first <= deepest:
        judged = outcomes(_of_examples(rows, code, examples, seconds, first, most), memory_mb).withColumn("why", verdict(strict))
        bad = cut(judged.where("why <> 'passed'").groupBy("_row").agg(F.min(F.struct("place", "why")).alias("worst")).select("_row", "worst.*"))
        found = bad if found is None else found.union(bad)
        first, most = first + most, most * 2
        if first <= deepest:
            rows = cut(rows.where(F.size(examples) >= first).join(bad, "_row", "left_anti"))
    return found if found is not None else rows.sparkSession.createDataFrame([], "_row long, place int, why string")


def check_programs(candidates: DataFrame, *, code_col: str = "code", examples_col: str = "examples", seconds: float = 5.0, memory_mb: int = 512) -> DataFrame:
    """``candidates`` with passed and reason: whether all examples pass, and why the first one that doesn't fails."""
    rows = _numbered(candidates)
    failures = _first_failures(rows.select("_row", code_col, examples_col), F.col(code_col), F.col(examples_col), seconds, memory_mb)
    return rows.join(failures, "_row", "left").withColumns(_told(F.col(examples_col), F.col("why"), F.col("place"))).select(*candidates.columns, "passed", "reason")


def keep_verified(records: DataFrame, seconds: float = 8.0, memory_mb: int = 512) -> DataFrame:
    """Records whose solutions hold, reduced to the first that does; those without examples and tests stay as they are.

    A solution holds if it passes the first three examples or, where there are none, all unit tests, of which there must
    be some. Blank solutions are passed over. Solutions are tried 1, 2, 4, ... at a time, only of records without one that holds.
    """
    rows = _numbered(records)
    tests = F.coalesce(F.col("test_code"), F.lit("")) if "test_code" in records.columns else F.lit("")
    given = F.coalesce(_given(F.col("examples")), F.lit(False))
    testable = given | (F.trim(tests) != "")
    tried = F.filter(F.coalesce("solutions", F.array().cast("array<string>")), lambda s: F.coalesce(F.trim(s), F.lit("")) != "")
    left = cut(rows.where(testable).select(F.col("_row").alias("_record"), tried.alias("_tried"), F.slice("examples", 1, 3).alias("_examples"), tests.alias("_tests"), given.alias("_given")))
    deepest, first, most, good = left.agg(F.max(F.size("_tried"))).first()[0] or 0, 1, 1, None
    while first <= deepest:
        each = left.select("_record", "_examples", "_tests", "_given", F.posexplode(F.slice("_tried", first, most)).alias("_at", "_code"))
        each = _numbered(each.withColumn("_at", F.col("_at") + first))
        failed = _first_failures(each.where("_given"), F.col("_code"), F.col("_examples"), seconds, memory_mb, strict=False).select("_row")
        by_tests = _test_rates(each.where("not _given"), F.col("_code"), F.col("_tests"), seconds + 5, memory_mb).where("not well").select("_row")
        held = each.join(failed.union(by_tests), "_row", "left_anti").groupBy("_record").agg(F.min("_at").alias("_at"))
        held = cut(held)
        good = held if good is None else good.union(held)
        first, most = first + most, most * 2
        if first <= deepest:
            left = cut(left.where(F.size("_tried") >= first).join(held, "_record", "left_anti"))
    if good is None:
        good = left.select("_record", F.lit(0).alias("_at")).limit(0)
    best = F.when(testable, F.array(F.get(tried, F.col("_at") - 1))).otherwise(F.col("solutions"))
    joined = rows.join(good.withColumnRenamed("_record", "_row"), "_row", "left").where(~testable | F.col("_at").isNotNull())
    return joined.withColumn("solutions", best).select(*records.columns)


def score_answers(answers: DataFrame, *, kind_col: str = "type", blocks_col: str = "blocks", context_col: str = "context", own_col: str = "self_test_code", seconds: float = 5.0, memory_mb: int = 512) -> DataFrame:
    """``answers`` (blocks: (lang, code)) with has_code, exec_reward, self_pass, any_valid and verified.

    SQL blocks are scored for SQL records and Python blocks for code and debugging ones; where no block has the
    language, all blocks are, or all that parse. Other records are verified by any block that parses. Only Python
    blocks that run well are tried with the answer's own tests.
    """
    rows = _numbered(answers)
    column = lambda name: F.coalesce(F.col(name), F.lit("")) if name in answers.columns else F.lit("")
    kind = F.coalesce(F.col(kind_col), F.lit("code"))
    python, sql = kind.isin("code", "debug"), kind == "sql"
    each = rows.select("_row", kind.alias("_kind"), column(context_col).alias("_context"), F.posexplode(blocks_col).alias("_at", "_b"))
    each = each.select("_row", "_kind", "_context", "_at", F.col("_b.lang").alias("_lang"), F.coalesce("_b.code", F.lit("")).alias("_code"))
    each = each.withColumns({"_valid": valid_python("_code"), "_named": F.when(F.col("_kind") == "sql", F.contains("_lang", F.lit("sql"))).otherwise(F.col("_lang").isin("python", "py"))})
    each = cut(each.withColumn("_named", F.coalesce("_named", F.lit(False))))
    # What is in a row's blocks, joined by its number: there may be many.
    about = each.groupBy("_row").agg(F.max("_valid").alias("any_valid"), F.max("_named").alias("_any_named"))
    is_sql, is_python = F.col("_kind") == "sql", F.col("_kind").isin("code", "debug")
    mine = cut(each.join(about, "_row").where(F.when(F.col("_any_named"), F.col("_named")).otherwise(is_sql | F.col("_valid")) & (is_sql | is_python)))
    runs = mine.select("_row", "_at", F.when(is_sql, SQL).otherwise(RUN).alias("kind"), F.col("_code").alias("program"), F.when(is_sql, F.col("_context")).otherwise("").alias("given"), F.lit(float(seconds)).alias("seconds"))
    best = outcomes(runs, memory_mb).groupBy("_row").agg(F.max("score").alias("_best"))
    scored = rows.join(about.drop("_any_named"), "_row", "left").join(best, "_row", "left")
    scored = cut(scored.withColumns({"has_code": _given(F.col(blocks_col)), "exec_reward": F.coalesce("_best", F.lit(0.0)), "any_valid": F.coalesce("any_valid", F.lit(False))}).drop("_best"))
    first = mine.where(is_python).groupBy("_row").agg(F.min(F.struct("_at", "_code")).alias("_first")).select("_row", F.col("_first._code").alias("_code"))
    own = scored.where(python & (F.col("exec_reward") >= 0.9) & (column(own_col) != "")).join(first, "_row")
    both = own.select("_row", F.lit(RUN).alias("kind"), F.concat("_code", F.lit("\n\n"), column(own_col)).alias("program"), F.lit("").alias("given"), F.lit(float(seconds)).alias("seconds"))
    passed = outcomes(both, memory_mb).select("_row", (F.col("score") == RUNS).alias("self_pass"))
    whole = scored.join(passed, "_row", "left").withColumns({"self_pass": F.coalesce("self_pass", F.lit(False)), "verified": F.when(sql | python, F.col("exec_reward") >= 0.9).otherwise(F.col("any_valid"))})
    return whole.select(*answers.columns, "has_code", "exec_reward", "self_pass", "any_valid", "verified")


def evaluate(problems: DataFrame, candidates: DataFrame, ks: tuple[int, ...] = (1,), seconds: float = 5.0, memory_mb: int = 512) -> DataFrame:
    """``problems`` (problem_id, examples) with skipped, n_samples, n_correct, pass_k and first_right.

    ``candidates`` (problem_id, sample_idx, code) are joined to their problem's examples first. Problems without examples
    are skipped: their candidates don't run, and they have no pass_k. ``first_right`` is the sample_idx of the first
    candidate that passes all, which rejection sampling keeps.
    """
    given = _given(F.col("examples"))
    tried = candidates.join(problems.where(given).select("problem_id", "examples"), "problem_id")
    checked = check_programs(tried, seconds=seconds, memory_mb=memory_mb)
    counted = per_problem(checked, ks)
    right = checked.where("passed").groupBy("problem_id").agg(F.min("sample_idx").alias("first_right"))
    found = problems.join(counted, "problem_id", "left").join(right, "problem_id", "left").withColumn("skipped", ~given)
    return found.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_samples", "n_correct")})


def passes_all(scored: DataFrame) -> DataFrame:
    """``scored`` with verified: programs that pass every test."""
    return scored.withColumn("verified", F.col("pass_rate") >= 1.0)

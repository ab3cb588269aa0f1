"""Rewards, rejection sampling and evaluation figures, as arithmetic over scored candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.extract import blocks, has_sql, valid_pythons
from millrace.functions.text import col, strip

# Weights of the rewards.
EXEC, FORMAT, CP_REASONING, SELF_TEST, FAST, FAST_SECONDS = 1.0, 0.1, 0.08, 0.15, 0.05, 1.0
SE_SYNTAX, SE_PASS = 0.2, 0.9


def _if(flag: Column | str, value: float) -> Column:
    return F.when(F.coalesce(col(flag), F.lit(False)), F.lit(value)).otherwise(F.lit(0.0))


def cp_reward(
    passed: Column | str = "pass_rate", elapsed: Column | str = "elapsed", valid: Column | str = "valid_syntax", reasoned: Column | str = "reasoned", self_rate: Column | str = "self_rate", tested: Column | str = "has_examples",
    *, exec_weight: float = EXEC, format_weight: float = FORMAT, fast_weight: float = FAST,
) -> Column:
    """Reward of a program: tests passed, form, reasoning, its own tests (once the given ones pass, or there are none), speed."""
    full = col(passed) >= 1.0
    own = F.when((full | ~col(tested)) & F.coalesce(col(valid), F.lit(False)), SELF_TEST * F.coalesce(col(self_rate), F.lit(0.0))).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), exec_weight * col(passed) + _if(valid, format_weight) + _if(reasoned, CP_REASONING) + own + _if(full & (col(elapsed) < FAST_SECONDS), fast_weight))


def se_reward(
    kind: Column | str = "type", best: Column | str = "exec_reward", fenced: Column | str = "has_code", reasoned: Column | str = "reasoned", self_pass: Column | str = "self_pass", any_valid: Column | str = "any_valid"
) -> Column:
    """Reward of an answer by its record's type: SQL, code and debugging by execution, others by form."""
    form = _if(fenced, FORMAT) + _if(reasoned, CP_REASONING)
    code = col(best) + form + _if((col(best) >= SE_PASS) & col(self_pass), SELF_TEST)
    t = F.coalesce(col(kind), F.lit("code"))
    return F.least(F.lit(1.0), F.when(t == "sql", col(best) + form).when(t.isin("code", "debug"), code).otherwise(form + _if(any_valid, SE_SYNTAX)))


def first_verified(candidates: DataFrame, problem_col: str = "problem_id", sample_col: str = "sample_idx", text_col: str = "completion", verified_col: str = "verified") -> DataFrame:
    """(problem, sample, completion): each problem's first verified candidate."""
    good = candidates.where(F.col(verified_col))
    return good.groupBy(problem_col).agg(F.min(sample_col).alias(sample_col), F.min_by(text_col, sample_col).alias(text_col))


def acceptance(candidates: DataFrame, problem_col: str = "problem_id", verified_col: str = "verified") -> DataFrame:
    """One row: n_problems, n_candidates, n_verified (problems with a verified candidate), pass_rate."""
    each = candidates.groupBy(problem_col).agg(F.count("*").alias("n"), F.max(F.coalesce(F.col(verified_col), F.lit(False)).cast("int")).alias("ok"))
    out = each.agg(F.count("*").alias("n_problems"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_candidates"), F.coalesce(F.sum("ok"), F.lit(0)).alias("n_verified"))
    return out.withColumn("pass_rate", F.col("n_verified") / F.greatest("n_problems", F.lit(1)))


def pass_at_k(n: Column | str, c: Column | str, k: int) -> Column:
    """Chance that one of k of n samples, c of them right, is right; NaN if n < k."""
    n, c = col(n), col(c)
    miss = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.lit(1.0), lambda a, i: a * F.when(n - c - i > 0, (n - c - i) / (n - i)).otherwise(F.lit(0.0)))
    return F.when(n < k, F.lit(float("nan"))).when(n - c < k, F.lit(1.0)).otherwise(1.0 - miss)


def per_problem(samples: DataFrame, ks: tuple[int, ...] = (1,), problem_col: str = "problem_id", passed_col: str = "passed") -> DataFrame:
    """n_samples, n_correct and pass_k for each k, by problem."""
    out = samples.groupBy(problem_col).agg(F.count("*").alias("n_samples"), F.sum(F.coalesce(F.col(passed_col), F.lit(False)).cast("long")).alias("n_correct"))
    return out.withColumns({f"pass_{k}": pass_at_k("n_samples", "n_correct", k) for k in ks})


def overall(problems: DataFrame, ks: tuple[int, ...] = (1,), skipped_col: str | None = None) -> DataFrame:
    """One row: total_problems, skipped ones included, and the mean of each pass_k over the others; 0 over none."""
    real = F.lit(True) if skipped_col is None else ~F.col(skipped_col)
    return problems.agg(F.count("*").alias("total_problems"), *[F.coalesce(F.avg(F.when(real, F.col(f"pass_{k}"))), F.lit(0.0)).alias(f"pass_{k}") for k in ks])


def by_difficulty(problems: DataFrame, difficulty_col: str = "difficulty") -> DataFrame:
    return problems.groupBy(difficulty_col).agg(F.count("*").alias("n"), F.avg("pass_1").alias("pass_1"))


def answer_flags(df: DataFrame, response_col: str = "response", kind_col: str = "type") -> DataFrame:
    """``df`` with non_empty, has_code, code_valid and sql_valid of each answer."""
    text = F.coalesce(F.col(response_col), F.lit(""))
    flagged = df.withColumns({"non_empty": strip(text) != "", "_b": blocks(text)}).withColumn("_ok", valid_pythons("_b"))
    sql = (F.col(kind_col) == "sql") & has_sql(text) if kind_col in df.columns else has_sql(text)
    return flagged.withColumns({"has_code": F.size("_b") > 0, "code_valid": F.exists("_ok", lambda x: x), "sql_valid": F.coalesce(sql, F.lit(False))}).drop("_b", "_ok")


def answer_quality(flagged: DataFrame, group_col: str | None = None) -> DataFrame:
    """Counts of the flags and their percentages, in all or by group."""
    count = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(f"n_{c}")
    names = ("non_empty", "has_code", "code_valid", "sql_valid")
    grouped = flagged.groupBy(group_col) if group_col else flagged
    out = grouped.agg(F.count("*").alias("n_total"), *[count(c) for c in names])
    return out.withColumns({f"pct_{c}": 100.0 * F.col(f"n_{c}") / F.greatest("n_total", F.lit(1)) for c in names})


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count("*").alias("n"))


def rft_records(records: DataFrame, candidates: DataFrame, problem_col: str = "problem_id", code_col: str = "code") -> DataFrame:
    """Records with their first verified candidate as the only solution; the source is marked as ``rft/``."""
    picked = first_verified(candidates, problem_col, text_col=code_col).select(problem_col, F.col(code_col).alias("_code"))
    joined = records.join(picked, problem_col)
    return joined.withColumns({"solutions": F.array("_code"), "source": F.concat(F.lit("rft/"), F.coalesce("source", F.lit("")))}).drop("_code")


def mark_skipped(problems: DataFrame, sandbox: bool = True) -> DataFrame:
    """``problems`` with skipped: those without examples, where programs are run."""
    return problems.withColumn("skipped", F.lit(sandbox) & (F.coalesce(F.size("examples"), F.lit(0)) <= 0))


def answer_samples(flagged: DataFrame, order_col: str = "_rid", rows: int = 50, characters: int = 200) -> DataFrame:
    """The first answers, cut short, for a report."""
    short = [F.substring(F.coalesce(F.col(c), F.lit("")), 1, characters).alias(c) for c in ("instruction", "expected", "response") if c in flagged.columns]
    return flagged.orderBy(order_col).limit(rows).select(*short, "type", "has_code")

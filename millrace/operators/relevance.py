"""Relevance filters of the two domains: predicates over columns, cheap tests before regular expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import relevance_values as V
from millrace.functions.text import any_of, col, strip, truthy


def any_pattern(c: Column | str, patterns: Sequence[str], dot_all: bool = False) -> Column:
    """Whether one of some regular expressions is found, case ignored: one alternation, one pass."""
    return col(c).rlike(f"(?iu{'s' if dot_all else ''}d)(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")


def any_tag(tags: Column | str, known: Sequence[str]) -> Column:
    """Whether a tag, lower-cased and stripped, is a known one."""
    plain = F.transform(F.filter(F.coalesce(col(tags), F.array().cast("array<string>")), lambda t: t.isNotNull()), lambda t: F.lower(strip(t)))
    return F.arrays_overlap(plain, F.array(*[F.lit(k) for k in known]))


def cp_relevant(
    problem: Column | str = "problem",
    solutions: Column | str = "solutions",
    tags: Column | str = "tags",
    source: Column | str = "source",
    *,
    min_length: int = 50,
    max_length: int = 8000,
    need_signal: bool = False,
) -> Column:
    """Whether a competitive programming record is relevant.

    Of a trusted source only solutions can speak against it. Else: no rejected tag, no rejected pattern in problem or
    solutions, a length within bounds and, where asked, a known tag or pattern. Nulls count as empty.
    """
    text = F.coalesce(col(problem), F.lit(""))
    listed = F.coalesce(col(solutions), F.array().cast("array<string>"))
    bad_solution = F.exists(listed, lambda s: F.coalesce(any_pattern(s, V.CP_REJECT_PATTERNS), F.lit(False)))
    trusted = any_of(F.lower(F.coalesce(col(source), F.lit(""))), V.CP_TRUSTED)
    other = F.length(text).between(min_length, max_length) & ~any_tag(tags, V.CP_REJECT_TAGS) & ~any_pattern(text, V.CP_REJECT_PATTERNS) & ~bad_solution
    if need_signal:
        other = other & (any_tag(tags, V.CP_TAGS) | any_pattern(text, V.CP_PATTERNS))
    return F.when(trusted, ~bad_solution).otherwise(other)


def se_relevant(
    text: Column | str, tags: Column | str, source: Column | str, *, min_length: int = 50, max_length: int = 32_000, need_signal: bool = False
) -> Column:
    """Whether a software engineering text is relevant; of a trusted source only rejected patterns speak against it."""
    t = F.coalesce(col(text), F.lit(""))
    bad = any_pattern(t, V.SE_REJECT_PATTERNS)
    other = F.length(t).between(min_length, max_length) & ~any_tag(tags, V.SE_REJECT_TAGS) & ~bad
    if need_signal:
        other = other & (any_tag(tags, V.SE_TAGS) | any_pattern(t, V.SE_PATTERNS, dot_all=True))
    return F.when(any_of(F.lower(F.coalesce(col(source), F.lit(""))), V.SE_TRUSTED), ~bad).otherwise(other)


def se_text(df: DataFrame) -> Column:
    """What the software engineering filter reads of a record: text|content|problem, else instruction|prompt and response|answer."""
    has = lambda *names: [F.col(n) for n in names if n in df.columns]
    whole = truthy(*has("text", "content", "problem"), F.lit(None).cast("string"))
    ask, tell = (truthy(*has(*names), F.lit(None).cast("string")) for names in (("instruction", "prompt"), ("response", "answer")))
    return F.when(whole != "", whole).otherwise(F.concat(ask, F.lit(" "), tell))


def cp_filter(**options) -> Callable[[DataFrame], DataFrame]:
    """For ``df.transform``: relevant competitive programming records."""
    return lambda df: df.where(cp_relevant(**options))


def se_filter(**options) -> Callable[[DataFrame], DataFrame]:
    """For ``df.transform``: relevant software engineering records."""
    none = F.array().cast("array<string>")
    return lambda df: df.where(se_relevant(se_text(df), F.col("tags") if "tags" in df.columns else none, F.col("source") if "source" in df.columns else F.lit(""), **options))


def cap_solutions(df: DataFrame, most: int = 3) -> DataFrame:
    """At most ``most`` solutions a record."""
    return df.withColumn("solutions", F.slice("solutions", 1, most))


#: Difficulties, and record types, that reinforcement learning takes in each round; later rounds take the last entry's.
CP_ROUNDS = {1: None, 2: ("medium", "hard"), 3: ("hard",)}
SE_ROUNDS = {1: ("code", "debug", "sql"), 2: ("code", "debug"), 3: ("code",)}


def cp_verifiable(df: DataFrame, difficulties: Sequence[str] | None = None) -> DataFrame:
    """Records with examples or test code, of given difficulties."""
    checked = (F.coalesce(F.size("examples"), F.lit(0)) > 0) | (F.coalesce(F.col("test_code"), F.lit("")) != "")
    fits = F.lit(True) if difficulties is None else F.coalesce(F.col("difficulty"), F.lit("unknown")).isin(*difficulties)
    return df.where(fits & checked)


def se_verifiable(df: DataFrame, types: Sequence[str] = SE_ROUNDS[1], min_length: int = 20) -> DataFrame:
    """Records of given types with an instruction of some length."""
    return df.where(F.col("type").isin(*types) & (F.length(strip("instruction")) >= min_length))


def cp_round(n: int, rounds: int = 3) -> Sequence[str] | None:
    """Difficulties of round n: narrowed over three rounds or more, else all."""
    return CP_ROUNDS[min(n, 3)] if rounds >= 3 else None


def se_round(n: int) -> Sequence[str]:
    """Record types of round n; rounds past the third take all again."""
    return SE_ROUNDS.get(n, SE_ROUNDS[1])

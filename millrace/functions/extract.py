"""Code, tests and reasoning out of model answers; normal forms of program output."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import BLANK, EXAMPLES, col, strip

# Fences and tags of answers, SQL words, lengths that make reasoning count.
RL_FENCE = r"(?isd)```(?:python|py|cpp|c\+\+|java)?\s*\n(.*?)```"
NAMED_FENCE = r"(?sdU)```(\w*)\s*\n(.*?)```"
ANY_FENCE = r"(?sdU)```(?:\w+)?\s*\n(.*?)```"
PYTHON_FENCE = r"(?sd)```python\n(.*?)```"
PLAIN_FENCE = r"(?sd)```\n?(.*?)```"
TESTS, THINK = r"(?sd)<tests>(.*?)</tests>", r"(?sd)<think>(.*?)</think>"
SQL_WORDS = ("SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "DROP", "ALTER", "WITH")
CP_REASONING, SE_REASONING = 50, 30


def lines(c: Column | str) -> Column:
    """Lines of a text, whatever ends them; a last line end makes no empty line."""
    text = F.regexp_replace(F.regexp_replace(col(c), r"\r\n|[\r\x0b\f\x1c-\x1e\x85  ]", "\n"), r"\n\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "\n"))


def _all(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))


def answer_code(c: Column | str) -> Column:
    """The first fenced block of a known language or none; else the lines that look like code; else the whole text."""
    blocks = _all(c, RL_FENCE)
    kept = strip(F.array_join(F.filter(lines(c), lambda x: x.rlike(r"^[ \ta-zA-Z_]")), "\n"))
    return F.when(F.size(blocks) > 0, strip(F.get(blocks, F.lit(0)))).when(kept != "", kept).otherwise(strip(c))


def solution_code(c: Column | str) -> Column:
    """The first Python block, else the body of the first fence (its tag included), else the whole text."""
    t = col(c)
    return strip(F.when(t.rlike(PYTHON_FENCE), F.regexp_extract(t, PYTHON_FENCE, 1)).when(t.rlike(PLAIN_FENCE), F.regexp_extract(t, PLAIN_FENCE, 1)).otherwise(t))


def named_blocks(c: Column | str) -> Column:
    """(lang, code) of all fenced blocks; no tag is Python."""
    langs = F.transform(_all(c, NAMED_FENCE, 1), lambda x: F.when(x == "", "python").otherwise(F.lower(x)))
    return F.zip_with(langs, _all(c, NAMED_FENCE, 2), lambda a, b: F.struct(a.alias("lang"), b.alias("code")))


def blocks(c: Column | str) -> Column:
    """Bodies of all fenced blocks."""
    return _all(c, ANY_FENCE)


def self_tests(c: Column | str) -> Column:
    """Examples of the tests tag: the first five lines with an arrow."""
    body = F.transform(lines(strip(F.regexp_extract(col(c), TESTS, 1))), strip)
    parts = lambda x: F.split(x, "->", 2)
    pairs = F.transform(F.filter(body, lambda x: F.contains(x, F.lit("->"))), lambda x: F.struct(strip(F.get(parts(x), F.lit(0))).alias("input"), strip(F.get(parts(x), F.lit(1))).alias("output")))
    return F.slice(pairs, 1, 5).cast(EXAMPLES)


def self_test_code(c: Column | str) -> Column:
    """The body of the tests tag, empty without one."""
    return strip(F.regexp_extract(col(c), TESTS, 1))


def has_reasoning(c: Column | str, longer_than: int = CP_REASONING) -> Column:
    """Whether the think tag has more than so many characters."""
    return F.length(strip(F.regexp_extract(col(c), THINK, 1))) > longer_than


def normal_output(c: Column | str) -> Column:
    """Output stripped, and each of its lines on the right."""
    return F.array_join(F.transform(lines(strip(c)), lambda x: F.regexp_replace(x, rf"{BLANK}+$", "")), "\n")


def has_sql(c: Column | str) -> Column:
    return col(c).rlike(rf"(?i)\b({'|'.join(SQL_WORDS)})\b")


def parsed(code: str | None) -> ast.Module | None:
    """The tree of Python code that is free of syntax errors; None of other code, and of what the parser can't take at all."""
    try:
        return ast.parse(code or "")
    except (SyntaxError, ValueError, MemoryError, RecursionError):
        return None


def parses(code: str | None) -> bool:
    """Whether Python code is free of syntax errors. Code that the parser can't take at all isn't."""
    return parsed(code) is not None


def _each(code: pd.Series) -> pd.Series:
    return code.map(parses).astype(bool)


def _lists(code: pd.Series) -> pd.Series:
    return code.map(lambda xs: [] if xs is None else [parses(x) for x in xs])


def valid_python(code: Column | str) -> Column:
    """Whether Python code parses; null counts as empty."""
    return F.pandas_udf(_each, "boolean")(col(code))


def valid_pythons(code: Column | str) -> Column:
    """The same of each element of an array."""
    return F.pandas_udf(_lists, "array<boolean>")(col(code))

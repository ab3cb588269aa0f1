"""Raw records of each source to one of two schemas, by column expressions.

A normalizer is a description: which columns give which field, in order of preference. Columns that a table lacks count
as null. Rows without what their schema needs are dropped; no row makes a job fail.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import EXAMPLES, any_of, clean, clean_squeezed, difficulty, examples_of_json, pair_up, solutions_of_json, strip, tag_list, truthy, truthy_array

def _none() -> Column:
    return F.array().cast("array<string>")


def _kind(df: DataFrame, name: str) -> T.DataType | None:
    return df.schema[name].dataType if name in df.columns else None


def _text(df: DataFrame, *names: str, default: str = "") -> Column:
    """The first of some columns that isn't empty, as text."""
    have = [F.col(n).cast("string") for n in names if n in df.columns]
    return truthy(*have, default=default) if have else F.lit(default)


def _tags(df: DataFrame, *names: str) -> Column:
    """The first of some columns that isn't empty, as an array; text is split at commas."""
    have = [tag_list(n, "string" if isinstance(_kind(df, n), T.StringType) else "array") for n in names if n in df.columns]
    return truthy_array(*have) if have else _none()


def _level(df: DataFrame, *names: str) -> Column:
    """Difficulty of the first of some columns that is neither null, empty nor the number 0."""
    have = []
    for n in names:
        kind = _kind(df, n)
        if kind is not None:
            have.append(F.when(F.col(n) != 0, F.col(n).cast("string")) if isinstance(kind, T.NumericType) else F.nullif(F.col(n).cast("string"), F.lit("")))
    if len(names) == 1 and have:  # a lone column isn't skipped for being 0
        return difficulty(F.col(names[0]).cast("string"))
    return difficulty(F.coalesce(*have, F.lit(None).cast("string"))) if have else F.lit("unknown")


def _solutions(df: DataFrame, *names: str) -> Column:
    """Solutions of the first column that has any: JSON or code as text, an array of text or structs, or {language, solution}."""
    have = []
    for n in names:
        kind = _kind(df, n)
        if isinstance(kind, T.StringType):
            have.append(F.when(F.coalesce(F.col(n), F.lit("")) != "", solutions_of_json(n)))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            keys = [k for k in ("solution", "code", "content") if k in kind.elementType.names]
            picked = F.filter(F.transform(F.col(n), partial(_pick, keys)), lambda s: s != "") if keys else _none()
            have.append(F.when(F.size(n) > 0, picked))
        elif isinstance(kind, T.ArrayType):
            have.append(F.when(F.size(n) > 0, F.filter(F.col(n).cast("array<string>"), lambda s: s.isNotNull())))
        elif isinstance(kind, T.StructType):
            langs, sols = F.coalesce(F.col(f"{n}.language").cast("array<string>"), _none()), F.coalesce(F.col(f"{n}.solution").cast("array<string>"), _none())
            have.append(F.slice(sols, F.lit(1), F.least(F.size(langs), F.size(sols))))
    return F.coalesce(*have, _none()) if have else _none()


def _pick(keys: list[str], x: Column) -> Column:
    return truthy(*[x[k] for k in keys])


def _one(df: DataFrame, *names: str, stripped: bool = True) -> Column:
    """A single solution as an array; none if it is empty."""
    text = _text(df, *names)
    return F.when(strip(text) != "", F.array(strip(text))).otherwise(_none()) if stripped else F.when(text != "", F.array(text)).otherwise(_none())


def _tests(df: DataFrame, name: str, given: str = "input", told: str = "output") -> Column:
    """Examples of a struct of two arrays."""
    if name not in df.columns:
        return F.array().cast(EXAMPLES)
    a, b = (F.coalesce(F.col(f"{name}.{k}").cast("array<string>"), _none()) for k in (given, told))
    return pair_up(a, b)


def _listed(df: DataFrame, name: str = "examples") -> Column:
    """Examples of an array of {input, output}, five at most."""
    if not isinstance(_kind(df, name), T.ArrayType):
        return F.array().cast(EXAMPLES)
    text = lambda v: F.coalesce(strip(v.cast("string")), F.lit(""))
    return F.coalesce(F.transform(F.slice(name, 1, 5), lambda x: F.struct(text(x["input"]).alias("input"), text(x["output"]).alias("output"))), F.array().cast(EXAMPLES))


def _zipped(df: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> Column:
    a, b = (truthy_array(*[F.col(n).cast("array<string>") for n in names if n in df.columns] or [_none()]) for names in (first, second))
    return pair_up(a, b)


def _json_examples(df: DataFrame, *names: str) -> Column:
    have = [n for n in names if n in df.columns]
    if not have:
        return F.array().cast(EXAMPLES)
    return examples_of_json(truthy(*have, default=None))


def _rid(df: DataFrame) -> list[Column]:
    return [F.col("_rid")] if "_rid" in df.columns else []


def cp_record(df: DataFrame, problem: Column, solutions: Column, source: Column | str, *, examples: Column | None = None, level: Column | str = "unknown", tags: Column | None = None, language: Column | str = "python", where: Column | None = None, **more: Column) -> DataFrame:
    """Rows of the competitive programming schema; blank problems are dropped."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    out = (df if where is None else df.where(where)).select(
        *_rid(df),
        clean_squeezed(problem).alias("problem"),
        solutions.alias("solutions"),
        (F.array().cast(EXAMPLES) if examples is None else examples).alias("examples"),
        lit(level).alias("difficulty"),
        (_none() if tags is None else tags).alias("tags"),
        lit(source).alias("source"),
        lit(language).alias("language"),
        *[v.alias(k) for k, v in more.items()],
    )
    return out.where("problem <> ''")


def _language(df: DataFrame, name: str) -> Column:
    return F.lower(_text(df, name, default="python"))


# Difficulty words of one source, language and source codes of another, and which languages count.
APPS_LEVELS = {"introductory": "easy", "interview": "medium", "competition": "hard"}
CONTEST_LANGUAGES = ("1", "3", "4")
CONTEST_SOURCES = {"1": "codeforces", "2": "codechef", "3": "atcoder", "4": "aizu", "5": "hackerearth", "6": "codecraft"}
LEETCODE_LEVELS = ("hard", "medium")
LEETCODE_LANGUAGES = ("python", "python3", "c++", "java")


def _mapped(values: dict[str, str], key: Column, default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), key), F.lit(default))


def taco(df: DataFrame) -> DataFrame:
    return cp_record(df, _text(df, "question", "problem"), _solutions(df, "solutions"), "taco", examples=_json_examples(df, "input_output"), level=_level(df, "difficulty"), tags=_tags(df, "tags", "raw_tags"))


def apps(df: DataFrame) -> DataFrame:
    level = _mapped(APPS_LEVELS, F.lower(_text(df, "difficulty")), "unknown")
    return cp_record(df, _text(df, "question"), _solutions(df, "solutions"), "apps", examples=_json_examples(df, "input_output"), level=level)


def code_contests(df: DataFrame) -> DataFrame:
    langs, sols = F.coalesce(F.col("solutions.language").cast("array<string>"), _none()), F.coalesce(F.col("solutions.solution"), _none())
    both = F.slice(F.arrays_zip(langs.alias("l"), sols.alias("s")), F.lit(1), F.least(F.size(langs), F.size(sols)))
    wanted = F.transform(F.filter(both, lambda x: x["l"].isin(*CONTEST_LANGUAGES)), lambda x: x["s"])
    chosen = F.when(F.size(wanted) > 0, wanted).otherwise(F.transform(both, lambda x: x["s"]))
    raw = F.col("source").cast("string") if "source" in df.columns else F.lit("")
    if isinstance(_kind(df, "source"), T.NumericType):
        raw = _mapped(CONTEST_SOURCES, raw, "code_contests")
    return cp_record(
        df, _text(df, "description"), chosen, F.concat(F.lit("code_contests/"), F.coalesce(raw, F.lit(""))), examples=_tests(df, "public_tests"), level=_level(df, "cf_rating", "difficulty"), tags=_tags(df, "cf_tags")
    )


def codeforces(df: DataFrame) -> DataFrame:
    return cp_record(
        df, _text(df, "description", "problem", "statement"), _solutions(df, "solutions", "accepted_solutions"), "codeforces", examples=_listed(df), level=_level(df, "rating", "difficulty"), tags=_tags(df, "tags")
    )


def codeforces_cots(df: DataFrame) -> DataFrame:
    return cp_record(
        df, _text(df, "problem", "description"), _one(df, "solution", "code", stripped=False), "codeforces_cots", level=_level(df, "rating"), tags=_tags(df, "tags"), reasoning=_text(df, "reasoning", "chain_of_thought")
    )


def leetcode(df: DataFrame) -> DataFrame:
    level = F.lower(_text(df, "difficulty"))
    found = F.array(*[strip(_text(df, k, f"{k}_solution")) if k in df.columns or f"{k}_solution" in df.columns else F.lit("") for k in LEETCODE_LANGUAGES])
    return cp_record(df, _text(df, "content", "problem"), F.filter(found, lambda s: s != ""), "leetcode", level=level, tags=_tags(df, "related_topics", "tags"), where=level.isin(*LEETCODE_LEVELS))


def opencode_reasoning(df: DataFrame, source: str = "opencode_reasoning") -> DataFrame:
    return cp_record(
        df, _text(df, "question", "problem", "description"), _one(df, "answer", "solution", "code"), source, level=_level(df, "difficulty"), tags=_tags(df, "tags"), language=_language(df, "language"), reasoning=_text(df, "reasoning", "chain_of_thought")
    )


def kodcode(df: DataFrame) -> DataFrame:
    return cp_record(
        df, _text(df, "question", "problem", "prompt"), _one(df, "solution", "answer", "code"), "kodcode", level=_level(df, "difficulty"), tags=_tags(df, "tags"), language=_language(df, "language"), test_code=_text(df, "test_code", "tests", "unit_tests")
    )


def cp_code_feedback(df: DataFrame) -> DataFrame:
    return cp_record(df, _text(df, "query", "instruction", "question"), _one(df, "answer", "response", "output"), "code_feedback", language=_language(df, "lang"))


def bigcodebench(df: DataFrame) -> DataFrame:
    return cp_record(df, _text(df, "instruct_prompt", "complete_prompt"), _one(df, "canonical_solution"), "bigcodebench", level="hard", tags=_tags(df, "libs"), test_code=_text(df, "test"))


def cp_magicoder_evol(df: DataFrame) -> DataFrame:
    return cp_record(df, _text(df, "instruction"), _one(df, "response"), "magicoder_evol")


def aizu(df: DataFrame) -> DataFrame:
    examples = _zipped(df, ("sample_inputs", "inputs"), ("sample_outputs", "outputs"))
    return cp_record(df, _text(df, "problem_statement", "description", "problem"), _one(df, "solution", "code"), "aizu", examples=examples, level=_level(df, "difficulty", "level"), tags=_tags(df, "tags", "categories"))


def competitive_programming_v4(df: DataFrame) -> DataFrame:
    return cp_record(
        df, _text(df, "description", "problem"), _solutions(df, "solutions"), "competitive_programming_v4", examples=_tests(df, "public_tests"), level=_level(df, "cf_rating", "difficulty"), tags=_tags(df, "cf_tags")
    )


def generic(df: DataFrame, source: str = "unknown") -> DataFrame:
    """Any table, by the names that its columns are likely to have."""
    return cp_record(
        df, _text(df, "problem", "question", "description", "statement", "text"), _solutions(df, "solutions", "solution", "code", "answer"), source, examples=_json_examples(df, "examples", "input_output"), level=_level(df, "difficulty"), tags=_tags(df, "tags")
    )


def se_record(df: DataFrame, instruction: Column, response: Column, source: str, *, context: Column | None = None, kind: Column | str = "code", language: Column | str = "python", tags: Column | None = None, where: Column | None = None) -> DataFrame:
    """Rows of the software engineering schema; rows without instruction or response are dropped."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    out = (df if where is None else df.where(where)).select(
        *_rid(df),
        instruction.alias("instruction"),
        response.alias("response"),
        (F.lit("") if context is None else context).alias("context"),
        lit(kind).alias("type"),
        lit(language).alias("language"),
        F.lit(source).alias("source"),
        (_none() if tags is None else tags).alias("tags"),
    )
    return out.where("instruction <> '' and response <> ''")


def _clean(df: DataFrame, *names: str, default: str = "") -> Column:
    return clean(_text(df, *names, default=default))


# Parts of paths that are skipped, lengths, words that tell types and technical talk.
STACK_SKIP = ("/vendor/", "/node_modules/", ".min.js", ".generated.", "test_", "_test.", ".spec.")
STACK_LANGUAGES = {"python": "python", "js": "javascript", "ts": "typescript", "go": "go", "java": "java", "rust": "rust", "sql": "sql", "shell": "shell"}
STACK_LEAST, STACK_MOST, OLD_MOST, NEW_MOST, ANSWER_LEAST, TURN_LEAST = 100, 8000, 2000, 4000, 50, 20
DEBUG_WORDS = ("debug", "error", "exception", "traceback", "fix")
DESIGN_WORDS = ("design", "architecture", "scale", "system")
SQL_WORDS = ("sql", "query", "database", "select", "table")
TECH_WORDS = ("code", "api", "database", "server", "deploy", "docker", "python", "javascript", "sql", "git", "debug", "error", "function", "class", "import", "framework", "library")


def the_stack(df: DataFrame, language: str = "python") -> DataFrame:
    """Source files; an instruction that is the same for all files of a language."""
    content, path = _clean(df, "content", "text"), _text(df, "path", "filename")
    good = (F.length(content) >= STACK_LEAST) & ~any_of(F.lower(path), STACK_SKIP)
    ask = F.lit(f"Complete the following {language} code or explain what it does:")
    return se_record(df, ask, F.substring(content, 1, STACK_MOST), f"the_stack_{language}", context=path, kind="pretrain", language=language, tags=F.array(F.lit(language)), where=good)


def commitpackft(df: DataFrame) -> DataFrame:
    message, old, new = _clean(df, "message"), _clean(df, "old_contents", "old_content"), _clean(df, "new_contents", "new_content")
    lang = _clean(df, "lang", "language", default="unknown")
    fenced = lambda code, n: F.concat(F.lit("```"), lang, F.lit("\n"), F.substring(code, 1, n), F.lit("\n```"))
    refactor = F.concat(F.lit("Refactor or update the following "), lang, F.lit(" code as described:\n\n"), message, F.lit("\n\nOriginal code:\n"), fenced(old, OLD_MOST))
    write = F.concat(F.lit("Write "), lang, F.lit(" code that: "), message)
    told = F.when(old != "", F.concat(F.lit("Updated code:\n"), fenced(new, NEW_MOST))).otherwise(fenced(new, NEW_MOST))
    tags = F.array(F.lit("git"), F.lit("refactoring"), F.lower(lang))
    return se_record(df, F.when(old != "", refactor).otherwise(write), told, "commitpackft", language=F.lower(lang), tags=tags, where=(message != "") & (new != ""))


def stack_exchange(df: DataFrame) -> DataFrame:
    ask, tell = _clean(df, "instruction", "question", "title"), _clean(df, "response", "answer")
    low = F.lower(ask)
    kind = F.when(any_of(low, DEBUG_WORDS), "debug").when(any_of(low, DESIGN_WORDS), "design").when(any_of(low, SQL_WORDS), "sql").otherwise("qa")
    return se_record(df, ask, tell, "stack_exchange", kind=kind, language="mixed", tags=_tags(df, "tags"), where=F.length(tell) >= ANSWER_LEAST)


def magicoder_oss(df: DataFrame) -> DataFrame:
    return se_record(
        df, _clean(df, "problem", "instruction"), _clean(df, "solution", "response"), "magicoder_oss", context=_clean(df, "seed_code"), language=F.lower(_clean(df, "lang", default="python")), tags=F.array(F.lit("code generation"))
    )


def se_magicoder_evol(df: DataFrame) -> DataFrame:
    return se_record(df, _clean(df, "instruction"), _clean(df, "response"), "magicoder_evol", tags=F.array(F.lit("code generation")))


def se_code_feedback(df: DataFrame) -> DataFrame:
    return se_record(df, _clean(df, "query", "instruction", "question"), _clean(df, "answer", "response"), "code_feedback", language=F.lower(_clean(df, "lang", default="python")))


def evol_codealpaca(df: DataFrame) -> DataFrame:
    return se_record(df, _clean(df, "instruction"), _clean(df, "output", "response"), "evol_codealpaca", context=_clean(df, "input"))


def glaive_code(df: DataFrame) -> DataFrame:
    """The first turns of a chat text; of structured columns where the chat has none."""
    chat = _text(df, "chat")
    both = chat.rlike(r"(?s)USER:\s*(.*?)(?:ASSISTANT:|\z)") & chat.rlike(r"(?s)ASSISTANT:\s*(.*?)(?:USER:|\z)")
    ask, tell = (clean(F.regexp_extract(chat, rf"(?sU){a}:\s*(.*?)(?:{b}:|\z)", 1)) for a, b in (("USER", "ASSISTANT"), ("ASSISTANT", "USER")))
    ask, tell = F.when(both, ask).otherwise(_clean(df, "instruction", "question")), F.when(both, tell).otherwise(_clean(df, "response", "answer"))
    return se_record(df, ask, tell, "glaive_code", context=_clean(df, "system"), language=F.lower(_clean(df, "language", default="python")), where=F.length(tell) >= TURN_LEAST)


def text_to_sql(df: DataFrame) -> DataFrame:
    ask, sql, schema = _clean(df, "nl_prompt", "instruction", "question"), _clean(df, "sql", "query", "response"), _clean(df, "sql_schema", "schema", "context")
    context = F.when(schema != "", F.concat(F.lit("Schema:\n"), schema)).otherwise(F.lit(""))
    tags = F.array(F.lit("sql"), F.lit("database"))
    return se_record(
        df, F.concat(F.lit("Write a SQL query to: "), ask), F.concat(F.lit("```sql\n"), sql, F.lit("\n```")), "text_to_sql", context=context, kind="sql", language="sql", tags=tags, where=(ask != "") & (sql != "")
    )


def ultrachat(df: DataFrame) -> DataFrame:
    """The first user and the first assistant message that aren't empty, of technical talks of two messages or more."""

    def first(role: str) -> Column:
        said = F.filter(F.transform(F.filter("messages", lambda m: m["role"] == role), lambda m: clean(m["content"])), lambda t: t != "")
        return F.coalesce(F.get(said, F.lit(0)), F.lit(""))

    ask, tell = first("user"), first("assistant")
    return se_record(df, ask, tell, "ultrachat", kind="qa", language="mixed", where=(F.size("messages") >= 2) & any_of(F.lower(F.concat(ask, tell)), TECH_WORDS))


def self_oss_instruct(df: DataFrame) -> DataFrame:
    return se_record(df, _clean(df, "prompt", "instruction"), _clean(df, "response", "completion"), "self_oss_instruct", language=F.lower(_clean(df, "language", default="python")))


CP_NORMALIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "taco": taco,
    "apps": apps,
    "code_contests": code_contests,
    "codeforces": codeforces,
    "codeforces_cots": codeforces_cots,
    "leetcode": leetcode,
    "opencode_reasoning": opencode_reasoning,
    "opencode_reasoning2": partial(opencode_reasoning, source="opencode_reasoning2"),
    "kodcode": kodcode,
    "code_feedback": cp_code_feedback,
    "bigcodebench": bigcodebench,
    "magicoder_evol": cp_magicoder_evol,
    "aizu": aizu,
    "competitive_programming_v4": competitive_programming_v4,
}
SE_NORMALIZERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{f"the_stack_{k}": partial(the_stack, language=v) for k, v in STACK_LANGUAGES.items()},
    "commitpackft": commitpackft,
    "stack_exchange": stack_exchange,
    "magicoder_oss": magicoder_oss,
    "magicoder_evol": se_magicoder_evol,
    "code_feedback": se_code_feedback,
    "evol_codealpaca": evol_codealpaca,
    "glaive_code": glaive_code,
    "text_to_sql": text_to_sql,
    "ultrachat": ultrachat,
    "self_oss_instruct": self_oss_instruct,
}


def normalize(df: DataFrame, name: str, domain: str = "cp") -> DataFrame:
    """Rows of a named source in the schema of its domain. Unknown names: a best effort in ``cp``, ValueError in ``se``."""
    if domain == "cp":
        return CP_NORMALIZERS.get(name, partial(generic, source=name))(df)
    if name not in SE_NORMALIZERS:
        raise ValueError(f"no normalizer for {name}")
    return SE_NORMALIZERS[name](df)

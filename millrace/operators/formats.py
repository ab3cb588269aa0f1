"""Records to training text: pretraining documents, prompt and response pairs, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import col, strip

# Headings, fences and chat marks of the formats.
FENCE, PYTHON_FENCE = "```", "```python\n"
PROBLEM, EXAMPLES, SOLUTION = "### Problem\n", "### Examples\n", "### Solution\n"
QUESTION, CONTEXT, ANSWER = "### Question\n", "### Context\n", "### Answer\n"
CP_TITLE = "### Competitive Programming Problem\n"
SYSTEM_OPEN, USER_OPEN, ASSISTANT_OPEN, CLOSE = "<|im_start|>system\n", "<|im_start|>user\n", "<|im_start|>assistant\n", "<|im_end|>\n"
THINK = "<think>\n"
SE_SYSTEM = (
    "You are an expert software engineer. Your sole focus is software engineering, system design, and application development. "
    "You provide precise, production-ready answers with working code, clear architecture guidance, and real-world engineering insight. "
    "You refuse requests unrelated to software engineering."
)
RFT_SYSTEM = "You are an expert competitive programmer. Think step by step, then write a complete, runnable Python solution. Wrap your code in ```python ... ``` fences."
CP_RL_SYSTEM = (
    "You are a world-class competitive programmer. Your ONLY task is solving coding problems. You refuse all non-coding requests. "
    "For every problem: (1) think step-by-step inside <think>...</think> tags, (2) identify the algorithm and edge cases, "
    "(3) write a complete runnable Python solution in ```python...``` fences, "
    "(4) write 3–5 of your own test cases inside <tests>...</tests> tags to verify your solution."
)
SE_RL_SYSTEM = (
    "You are a world-class software engineer. Your ONLY task is solving software engineering problems. You refuse all non-SE requests. "
    "For every task: (1) think through the design and edge cases inside <think>...</think> tags, "
    "(2) write complete, production-ready code in ```language...``` fences, "
    "(3) write 2-3 of your own test cases inside <tests>...</tests> tags to verify your implementation."
)


def _or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def _some(text: Column, heading: str = "", tail: str = "") -> Column:
    """Heading, text and tail; null, so that concat_ws leaves it out, if the text is empty."""
    return F.when(text != "", F.concat(F.lit(heading), text, F.lit(tail)))


def examples_text(examples: Column | str) -> Column:
    """The first three examples, numbered; blank ones are left out but keep their number."""

    def one(x: Column, i: Column) -> Column:
        given, told = strip(_or_empty(x["input"])), strip(_or_empty(x["output"]))
        title = F.concat(F.lit("Example "), (i + 1).cast("string"), F.lit(":"))
        return F.when((given != "") | (told != ""), F.concat_ws("\n", title, _some(given, "  Input:\n    "), _some(told, "  Output:\n    ")))

    return _or_empty(F.array_join(F.transform(F.slice(col(examples), 1, 3), one), "\n"))


def cp_document(problem: Column | str = "problem", examples: Column | str = "examples", solutions: Column | str = "solutions") -> Column:
    """Problem, examples and up to three solutions as one document."""
    parts = F.array_join(F.transform(F.slice(col(solutions), 1, 3), lambda s: _some(strip(_or_empty(s)), SOLUTION + PYTHON_FENCE, "\n" + FENCE)), "\n\n")
    return F.concat_ws("\n\n", _some(strip(_or_empty(problem)), PROBLEM), _some(examples_text(examples), EXAMPLES), _some(_or_empty(parts)))


def se_document(kind: Column | str = "type", instruction: Column | str = "instruction", response: Column | str = "response", context: Column | str = "context") -> Column:
    """Code of pretraining rows as it is; else question, context and answer. A null type is pretraining."""
    ask, tell, given = (strip(_or_empty(c)) for c in (instruction, response, context))
    raw = F.when(tell != "", tell).otherwise(ask)
    return F.when(F.coalesce(col(kind), F.lit("pretrain")) == "pretrain", raw).otherwise(F.concat_ws("\n\n", _some(ask, QUESTION), _some(given, CONTEXT), _some(tell, ANSWER)))


def _first_solution(solutions: Column | str) -> Column:
    return F.get(F.filter(F.transform(col(solutions), lambda s: strip(_or_empty(s))), lambda s: s != ""), F.lit(0))


def cp_prompt(problem: Column | str = "problem", examples: Column | str = "examples", difficulty: Column | str = "difficulty", tags: Column | str = "tags") -> Column:
    level = _or_empty(difficulty)
    topics = F.array_join(F.slice(F.coalesce(col(tags), F.array().cast("array<string>")), 1, 8), ", ")
    shown = F.concat(F.lit("**Difficulty:** "), F.upper(F.substring(level, 1, 1)), F.lower(F.substring(level, 2, 1000)))
    return F.concat_ws(
        "\n",
        F.lit(CP_TITLE),
        F.when(F.coalesce(col(difficulty), F.lit("unknown")) != "unknown", shown),
        F.when(F.size(col(tags)) > 0, F.concat(F.lit("**Topics:** "), topics)),
        F.concat(F.lit("\n"), strip(_or_empty(problem))),
        _some(examples_text(examples), "\n" + EXAMPLES),
        F.lit("\n" + SOLUTION + PYTHON_FENCE.rstrip("\n")),
    )


def cp_pair(df: DataFrame) -> DataFrame:
    """``df`` with prompt and response; both null without a solution or a problem that isn't blank."""
    first = _first_solution("solutions")
    good = first.isNotNull() & (strip(_or_empty("problem")) != "")
    return df.withColumns({"prompt": F.when(good, cp_prompt()), "response": F.when(good, F.concat(first, F.lit("\n" + FENCE)))})


def chat(system: str, user: Column, tail: str = "") -> Column:
    return F.concat(F.lit(SYSTEM_OPEN + system + CLOSE + USER_OPEN), user, F.lit(CLOSE + ASSISTANT_OPEN + tail))


def se_pair(df: DataFrame) -> DataFrame:
    """``df`` with prompt and response; both null if instruction or response is blank."""
    ask, tell, given = (strip(_or_empty(c)) for c in ("instruction", "response", "context"))
    good = (ask != "") & (tell != "")
    whole = F.concat(F.when(given != "", F.concat(given, F.lit("\n\n"))).otherwise(F.lit("")), ask)
    return df.withColumns({"prompt": F.when(good, chat(SE_SYSTEM, whole)), "response": F.when(good, tell)})


def _given_examples(examples: Column | str) -> Column:
    one = lambda x: F.concat(F.lit("Input:\n"), strip(_or_empty(x["input"])), F.lit("\nOutput:\n"), strip(_or_empty(x["output"])))
    block = F.array_join(F.transform(F.slice(col(examples), 1, 3), one), "\n\n")
    return F.when(F.size(col(examples)) > 0, F.concat(F.lit("\n\n" + EXAMPLES), block)).otherwise(F.lit(""))


def cp_rl_prompt(problem: Column | str = "problem", examples: Column | str = "examples", system: str = CP_RL_SYSTEM) -> Column:
    """Chat prompt of reinforcement learning; it opens the reasoning."""
    return chat(system, F.concat(_or_empty(problem), _given_examples(examples)), THINK)


def cp_rft_prompt(problem: Column | str = "problem", examples: Column | str = "examples", system: str = RFT_SYSTEM) -> Column:
    """Chat prompt of rejection sampling."""
    return chat(system, F.concat(_or_empty(problem), _given_examples(examples)))


def se_rl_prompt(instruction: Column | str = "instruction", context: Column | str = "context", system: str = SE_RL_SYSTEM) -> Column:
    task = F.when(_or_empty(context) != "", strip(F.concat(col(context), F.lit("\n\n"), _or_empty(instruction)))).otherwise(_or_empty(instruction))
    return chat(system, task, THINK)


def cp_eval_prompt(df: DataFrame) -> Column:
    """The pair's prompt, or a plain one for records without a solution."""
    good = _first_solution("solutions").isNotNull() & (strip(_or_empty("problem")) != "")
    return F.when(good, cp_prompt()).otherwise(F.concat(F.lit(PROBLEM), _or_empty("problem"), F.lit("\n\n" + SOLUTION + PYTHON_FENCE)))

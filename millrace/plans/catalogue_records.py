"""Queries of the catalogue over records: normalizers, formats, answers, tokens, scores and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import extract as E
from millrace.functions import relevance_values as V
from millrace.operators import formats, scores, tokens
from millrace.plans.catalogue import EX_JSON, EX_WANT, MARKS, SOL_JSON, SOL_WANT, made, query, same, shown_examples, sql_any, sql_clean, sql_cp, sql_first, sql_key, sql_level, sql_squeezed, sql_strip, table
from millrace.plans.corpus import Options, build
from millrace.sources import normalize as N

# ---- normalizers -----------------------------------------------------------------------------------------------------

# Raw records: a first choice that is often missing, a second, JSON fields, tags, levels, languages.
FIRST = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END"
SECOND = "CASE doc_id % 8 WHEN 0 THEN NULL ELSE concat(chr(13), text, ' ') END"
LEVEL = "CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Hard' WHEN 2 THEN '1500' WHEN 3 THEN 'interview' ELSE 'medium' END"
TAGS = "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN ' dp, graphs' ELSE '' END"
TAGS_WANT = "CASE doc_id % 3 WHEN 1 THEN 'dp|graphs' ELSE '' END"
LANG = "CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'CPP' ELSE '' END"
LANG_WANT = "CASE doc_id % 3 WHEN 1 THEN 'cpp' ELSE 'python' END"
CODE = "CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE concat(' print(', doc_id, ') ') END"
CODE_WANT = "CASE WHEN doc_id % 6 > 1 THEN concat('print(', doc_id, ')') ELSE '' END"
JSON = f"{EX_JSON.replace('AS j', 'AS ej')} ;; {SOL_JSON.replace('doc_id ;; ', '').replace('AS j', 'AS sj')}"
RAW = f"{JSON} ;; {FIRST} AS a ;; {SECOND} AS b ;; {LEVEL} AS lev ;; {TAGS} AS tg ;; {LANG} AS la ;; {CODE} AS co ;; source AS src"
PROBLEM = sql_squeezed(sql_first(FIRST, SECOND))
EITHER = sql_clean(sql_first(FIRST, SECOND))


def _raw(spark, sf_dir, **names: str) -> DataFrame:
    """Raw records under a source's own column names."""
    return made(spark, sf_dir, RAW).selectExpr("doc_id AS _rid", *[f"{e} AS `{n}`" for n, e in names.items()])


def _cp_shown(df: DataFrame) -> DataFrame:
    more = [F.col(c) for c in ("reasoning", "test_code") if c in df.columns]
    return df.select(
        F.col("_rid").alias("doc_id"), F.md5("problem").alias("problem"), F.array_join("solutions", "|").alias("solutions"), shown_examples("examples").alias("examples"), "difficulty", F.array_join("tags", "|").alias("tags"), "source", "language", *more
    )


def _cp_sql(source: str, solutions: str = "''", examples: str = "''", level: str = "'unknown'", tags: str = "''", language: str = "'python'", where: str = "true", problem: str = PROBLEM, **more: str) -> str:
    extra = "".join(f", {v} AS {k}" for k, v in more.items())
    return (
        f"SELECT doc_id, md5({problem}) AS problem, {solutions} AS solutions, {examples} AS examples, {level} AS difficulty, {tags} AS tags, {source} AS source, {language} AS language{extra} "
        f"FROM documents WHERE {problem} <> '' AND {where}"
    )


def _cp(name: str, oracle: str, /, **names: str) -> None:
    def run(spark, sf_dir):
        return _cp_shown(N.normalize(_raw(spark, sf_dir, **names), name, "cp"))

    run.__name__ = f"norm_cp_{name}"
    query(oracle)(run)


LV = sql_level(f"({LEVEL})")
_cp("taco", _cp_sql("'taco'", SOL_WANT, EX_WANT, LV, TAGS_WANT), question="a", problem="b", solutions="sj", input_output="ej", difficulty="lev", tags="tg")
_cp(
    "apps", _cp_sql("'apps'", SOL_WANT, EX_WANT, f"CASE {LEVEL} WHEN 'interview' THEN 'medium' ELSE 'unknown' END", problem=sql_squeezed(SECOND)), question="b", solutions="sj", input_output="ej", difficulty="lev"
)
CONTEST = "CASE doc_id % 4 WHEN 0 THEN {0} WHEN 1 THEN {1} ELSE {2} END"
_cp(
    "code_contests",
    _cp_sql(
        "concat('code_contests/', CASE doc_id % 8 WHEN 0 THEN 'code_contests' WHEN 1 THEN 'codeforces' WHEN 2 THEN 'codechef' WHEN 3 THEN 'atcoder' WHEN 4 THEN 'aizu' WHEN 5 THEN 'hackerearth' WHEN 6 THEN 'codecraft' ELSE 'code_contests' END)",
        CONTEST.format("'c++|py'", "'java'", "''"), CONTEST.format("'1=>2|3=>4'", "''", "''"), f"CASE WHEN doc_id % 3 = 0 THEN {LV} WHEN doc_id % 3 = 1 THEN 'easy' ELSE 'hard' END", TAGS_WANT, problem=sql_squeezed(SECOND),
    ),
    description="b", difficulty="lev", cf_tags="tg", cf_rating="CASE doc_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1100 ELSE 2400 END", source="doc_id % 8",
    solutions="named_struct('language', " + CONTEST.format("array(1, 2, 3)", "array(2)", "array(1)") + ", 'solution', " + CONTEST.format("array('c++', 'java', 'py')", "array('java', 'more')", "cast(array() AS array<string>)") + ")",
    public_tests="named_struct('input', " + CONTEST.format("array('1', ' 3 ')", "array('x')", "cast(NULL AS array<string>)") + ", 'output', " + CONTEST.format("array('2', '4', '5')", "cast(array() AS array<string>)", "array('y')") + ")",
)
_cp(
    "codeforces", _cp_sql("'codeforces'", SOL_WANT, "CASE doc_id % 2 WHEN 0 THEN 'i=>o' ELSE '' END", LV, TAGS_WANT), description="a", statement="b", accepted_solutions="sj",
    examples="CASE doc_id % 2 WHEN 0 THEN array(named_struct('input', ' i', 'output', 'o ')) END", rating="CASE WHEN doc_id % 2 = 0 THEN '' END", difficulty="lev", tags="tg",
)
_cp("codeforces_cots", _cp_sql("'codeforces_cots'", f"coalesce({CODE}, '')", level=LV, tags=TAGS_WANT, reasoning=f"coalesce({LANG}, '')"), problem="a", description="b", code="co", chain_of_thought="la", rating="lev", tags="tg")
_cp(
    "leetcode", _cp_sql("'leetcode'", f"concat_ws('|', nullif({CODE_WANT}, ''), CASE WHEN doc_id % 3 = 1 THEN 'CPP' END)", level=f"lower({LEVEL})", tags=TAGS_WANT, where=f"lower({LEVEL}) IN ('hard', 'medium')"),
    content="a", problem="b", difficulty="lev", python="co", **{"c++_solution": "la"}, related_topics="tg",
)
for _name in ("opencode_reasoning", "opencode_reasoning2"):
    _cp(_name, _cp_sql(f"'{_name}'", CODE_WANT, level=LV, tags=TAGS_WANT, language=LANG_WANT, reasoning="src".replace("src", "source")), question="a", description="b", answer="co", difficulty="lev", tags="tg", language="la", reasoning="src")
_cp("kodcode", _cp_sql("'kodcode'", CODE_WANT, level=LV, tags=TAGS_WANT, language=LANG_WANT, test_code=f"coalesce({LANG}, '')"), question="a", prompt="b", solution="co", unit_tests="la", difficulty="lev", tags="tg", language="la")
_cp("code_feedback", _cp_sql("'code_feedback'", CODE_WANT, language=LANG_WANT), query="a", instruction="b", answer="co", lang="la")
_cp("bigcodebench", _cp_sql("'bigcodebench'", CODE_WANT, level="'hard'", tags="CASE doc_id % 2 WHEN 0 THEN 'os|re' ELSE '' END", test_code="source"), instruct_prompt="a", complete_prompt="b", canonical_solution="co", libs="CASE doc_id % 2 WHEN 0 THEN array('os', 're') END", test="src")
_cp("magicoder_evol", _cp_sql("'magicoder_evol'", CODE_WANT, problem=sql_squeezed(SECOND)), instruction="b", response="co")
_cp("aizu", _cp_sql("'aizu'", CODE_WANT, "CASE doc_id % 2 WHEN 0 THEN '1=>2' ELSE '' END", LV, TAGS_WANT), problem_statement="a", description="b", code="co", inputs="CASE doc_id % 2 WHEN 0 THEN array('1 ', '3') END", sample_outputs="array('2')", level="lev", categories="tg")
_cp(
    "competitive_programming_v4", _cp_sql("'competitive_programming_v4'", SOL_WANT, "'7=>8'", LV, TAGS_WANT), description="a", problem="b", solutions="sj", public_tests="named_struct('input', array('7'), 'output', array(' 8', '9'))", difficulty="lev", cf_tags="tg"
)
_cp("project_euler", _cp_sql("'project_euler'", SOL_WANT, EX_WANT, LV, TAGS_WANT), question="a", text="b", answer="sj", input_output="ej", difficulty="lev", tags="tg")


def _se_sql(source: str, instruction: str, response: str, context: str = "''", kind: str = "'code'", language: str = "'python'", tags: str = "''", where: str = "true") -> str:
    return (
        f"SELECT doc_id, md5(i) AS instruction, md5(r) AS response, context, type, language, source, tags FROM (SELECT doc_id, {instruction} AS i, {response} AS r, {context} AS context, {kind} AS type, "
        f"{language} AS language, {source} AS source, {tags} AS tags, text FROM documents WHERE {where}) WHERE i <> '' AND r <> ''"
    )


def _se(name: str, oracle: str, /, **names: str) -> None:
    def run(spark, sf_dir):
        df = N.normalize(_raw(spark, sf_dir, **names), name, "se")
        return df.select(F.col("_rid").alias("doc_id"), F.md5("instruction").alias("instruction"), F.md5("response").alias("response"), "context", "type", "language", "source", F.array_join("tags", "|").alias("tags"))

    run.__name__ = f"norm_se_{name}"
    query(oracle)(run)


PATH = "CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'src/Latest_x.py' WHEN 2 THEN 'lib/a.MIN.js' ELSE 'src/main.py' END"
SKIP = "(" + " OR ".join(f"contains(lower(coalesce({PATH}, '')), '{p}')" for p in N.STACK_SKIP) + ")"
for _short, _long in N.STACK_LANGUAGES.items():
    _se(
        f"the_stack_{_short}",
        _se_sql(f"'the_stack_{_long}'", f"'Complete the following {_long} code or explain what it does:'", f"substr({EITHER}, 1, 8000)", f"coalesce({PATH}, '')", "'pretrain'", f"'{_long}'", f"'{_long}'", f"length({EITHER}) >= 100 AND NOT {SKIP}"),
        content="a", text="b", path=PATH.replace("doc_id", "doc_id"),
    )
_lang = f"coalesce(nullif({LANG}, ''), 'unknown')"
_se(
    "commitpackft",
    _se_sql(
        "'commitpackft'",
        f"CASE WHEN {sql_clean(FIRST)} <> '' THEN concat('Refactor or update the following ', {_lang}, ' code as described:', chr(10), chr(10), source, chr(10), chr(10), 'Original code:', chr(10), '```', {_lang}, chr(10), substr({sql_clean(FIRST)}, 1, 2000), chr(10), '```') ELSE concat('Write ', {_lang}, ' code that: ', source) END",
        f"concat(CASE WHEN {sql_clean(FIRST)} <> '' THEN concat('Updated code:', chr(10)) ELSE '' END, '```', {_lang}, chr(10), substr({sql_clean(SECOND)}, 1, 4000), chr(10), '```')",
        language=f"lower({_lang})", tags=f"concat('git|refactoring|', lower({_lang}))", where=f"{sql_clean(SECOND)} <> ''",
    ),
    message="src", old_contents="a", new_content="b", lang="la",
)
TITLE = "concat(CASE doc_id % 5 WHEN 0 THEN 'A prefix ' WHEN 1 THEN 'Systems ' WHEN 2 THEN 'Table ' WHEN 3 THEN 'Error in design ' ELSE 'Why ' END, doc_id)"
_se(
    "stack_exchange",
    _se_sql("'stack_exchange'", TITLE, EITHER, kind="CASE doc_id % 5 WHEN 0 THEN 'debug' WHEN 1 THEN 'design' WHEN 2 THEN 'sql' WHEN 3 THEN 'debug' ELSE 'qa' END", language="'mixed'", tags=TAGS_WANT, where=f"length({EITHER}) >= 50"),
    title=TITLE, response="a", answer="b", tags="tg",
)
_se("magicoder_oss", _se_sql("'magicoder_oss'", EITHER, CODE_WANT, "source", language=LANG_WANT, tags="'code generation'"), problem="a", instruction="b", solution="co", seed_code="src", lang="la")
_se("magicoder_evol", _se_sql("'magicoder_evol'", sql_clean(SECOND), CODE_WANT, tags="'code generation'"), instruction="b", response="co")
_se("code_feedback", _se_sql("'code_feedback'", EITHER, CODE_WANT, language=LANG_WANT), query="a", question="b", answer="co", lang="la")
_se("evol_codealpaca", _se_sql("'evol_codealpaca'", sql_clean(SECOND), CODE_WANT, "source"), instruction="b", output="co", input="src")
CHAT = "CASE doc_id % 4 WHEN 0 THEN concat('USER: ask ', doc_id, chr(10), 'ASSISTANT: an answer of some length ', doc_id, ' USER: more ASSISTANT: other') WHEN 1 THEN concat('USER: ask', chr(10), 'ASSISTANT: short') WHEN 2 THEN NULL ELSE 'no turns at all' END"
_se(
    "glaive_code",
    _se_sql("'glaive_code'", f"CASE doc_id % 4 WHEN 0 THEN concat('ask ', doc_id) WHEN 1 THEN 'ask' ELSE {EITHER} END", f"CASE doc_id % 4 WHEN 0 THEN concat('an answer of some length ', doc_id) WHEN 1 THEN '' ELSE concat('structured answer number ', doc_id) END", "source", language=LANG_WANT),
    chat=CHAT, instruction="a", question="b", answer="concat('structured answer number ', doc_id)", system="src", language="la",
)
_se(
    "text_to_sql",
    _se_sql("'text_to_sql'", f"concat('Write a SQL query to: ', {EITHER})", f"concat('```sql', chr(10), {CODE_WANT}, chr(10), '```')", f"CASE doc_id % 3 WHEN 1 THEN concat('Schema:', chr(10), 'CPP') ELSE '' END", "'sql'", "'sql'", "'sql|database'", f"{EITHER} <> '' AND {CODE_WANT} <> ''"),
    nl_prompt="a", question="b", sql="co", schema="la",
)
_se("self_oss_instruct", _se_sql("'self_oss_instruct'", EITHER, CODE_WANT, language=LANG_WANT), prompt="a", instruction="b", completion="co", language="la")

TALK = "CASE conv_id % 3 WHEN 0 THEN text || ' python' ELSE text END"


@query(
    f"""SELECT conv_id, md5(i) AS instruction, md5(r) AS response FROM (
        SELECT conv_id, count(*) AS n, min_by({sql_clean(TALK)}, turn) FILTER (WHERE role = 'user' AND {sql_clean(TALK)} <> '') AS i,
               min_by({sql_clean(TALK)}, turn) FILTER (WHERE role = 'assistant' AND {sql_clean(TALK)} <> '') AS r FROM conversations GROUP BY conv_id)
        WHERE n >= 2 AND i <> '' AND r <> '' AND ({" OR ".join(f"contains(lower(i || r), '{w}')" for w in N.TECH_WORDS)})"""
)
def norm_se_ultrachat(spark, sf_dir):
    said = made(spark, sf_dir, f"conv_id ;; turn ;; role ;; {TALK} AS content", "conversations")
    talks = said.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "content"))), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))
    out = N.ultrachat(talks.withColumnRenamed("conv_id", "_rid"))
    return out.select(F.col("_rid").alias("conv_id"), F.md5("instruction").alias("instruction"), F.md5("response").alias("response"))


@query(
    f"""SELECT conv_id, md5(i) AS instruction, md5(r) AS response FROM (
        SELECT conv_id, min_by({sql_clean("text")}, turn) FILTER (WHERE role = 'user' AND {sql_clean("text")} <> '') AS i,
               min_by({sql_clean("text")}, turn) FILTER (WHERE role = 'assistant' AND {sql_clean("text")} <> '') AS r, count(*) AS n FROM conversations GROUP BY conv_id)
        WHERE n >= 2 AND i <> '' AND r <> ''"""
)
def first_turn_pairs(spark, sf_dir):
    """The first user and assistant turns, by a partial aggregate: no talk is gathered in one row."""
    from millrace.functions.text import clean

    said = table(spark, sf_dir, "conversations").withColumn("text", clean("text"))
    first = lambda role: F.min_by("text", F.when((F.col("role") == role) & (F.col("text") != ""), F.col("turn")))
    out = said.groupBy("conv_id").agg(F.count("*").alias("n"), first("user").alias("i"), first("assistant").alias("r"), F.max((F.col("role") == "user") & (F.col("text") != "")).alias("u"), F.max((F.col("role") == "assistant") & (F.col("text") != "")).alias("v"))
    return out.where("n >= 2 and u and v").select("conv_id", F.md5("i").alias("instruction"), F.md5("r").alias("response"))


# ---- formats ---------------------------------------------------------------------------------------------------------

RECORD = (
    "doc_id ;; CASE doc_id % 6 WHEN 0 THEN NULL ELSE concat(' ', text) END AS problem ;; CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN ' 1 2 ' ELSE '3' END AS ein ;; CASE doc_id % 3 WHEN 0 THEN '' ELSE ' out ' END AS eout ;; "
    "CASE doc_id % 5 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE concat('print(', doc_id, ')', chr(10)) END AS sol ;; CASE doc_id % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'hard' ELSE 'Medium' END AS difficulty ;; "
    "CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'pretrain' ELSE 'qa' END AS type ;; CASE doc_id % 3 WHEN 1 THEN ' ctx ' ELSE '' END AS context ;; source"
)
P, S = sql_strip("coalesce(problem, '')"), sql_strip("coalesce(sol, '')")
NL = "chr(10)"
EI, EO = "trim(ein)", "trim(eout)"
EX1 = f"CASE WHEN {EI} <> '' OR {EO} <> '' THEN concat_ws({NL}, 'Example 1:', CASE WHEN {EI} <> '' THEN concat('  Input:', {NL}, '    ', {EI}) END, CASE WHEN {EO} <> '' THEN concat('  Output:', {NL}, '    ', {EO}) END) END"
EX_ALL = f"concat_ws({NL}, {EX1}, concat('Example 3:', {NL}, '  Input:', {NL}, '    9', {NL}, '  Output:', {NL}, '    8'))"


def _records(spark, sf_dir) -> DataFrame:
    d = made(spark, sf_dir, RECORD)
    pair = lambda a, b: F.struct(a.alias("input"), b.alias("output"))
    given = F.array(pair(F.col("ein"), F.col("eout")), pair(F.lit(" "), F.lit("")), pair(F.lit("9"), F.lit(" 8")), pair(F.lit("x"), F.lit("y")))
    return d.withColumns({"examples": given, "solutions": F.array("sol", F.lit(" second ")), "tags": F.array("source", F.lit("b"))})


def _digest(df: DataFrame, **columns) -> DataFrame:
    return df.select("doc_id", *[F.md5(c).alias(k) for k, c in columns.items()])


SOLS = f"concat_ws({NL} || {NL}, CASE WHEN {S} <> '' THEN concat('### Solution', {NL}, '```python', {NL}, {S}, {NL}, '```') END, concat('### Solution', {NL}, '```python', {NL}, 'second', {NL}, '```'))"


@query(f"SELECT doc_id, md5(concat_ws({NL} || {NL}, CASE WHEN {P} <> '' THEN concat('### Problem', {NL}, {P}) END, concat('### Examples', {NL}, {EX_ALL}), {SOLS})) AS text FROM {same(RECORD)}")
def pretrain_text_cp(spark, sf_dir):
    return _digest(_records(spark, sf_dir), text=formats.cp_document())


ASK, TELL, GIVEN = P, S, "trim(context)"


@query(
    f"SELECT doc_id, md5(CASE WHEN coalesce(type, 'pretrain') = 'pretrain' THEN CASE WHEN {TELL} <> '' THEN {TELL} ELSE {ASK} END ELSE concat_ws({NL} || {NL}, CASE WHEN {ASK} <> '' THEN concat('### Question', {NL}, {ASK}) END, "
    f"CASE WHEN {GIVEN} <> '' THEN concat('### Context', {NL}, {GIVEN}) END, CASE WHEN {TELL} <> '' THEN concat('### Answer', {NL}, {TELL}) END) END) AS text FROM {same(RECORD)}"
)
def pretrain_text_se(spark, sf_dir):
    return _digest(_records(spark, sf_dir), text=formats.se_document("type", "problem", "sol", "context"))


CP_PROMPT = (
    f"concat_ws({NL}, concat('### Competitive Programming Problem', {NL}), CASE WHEN difficulty <> 'unknown' THEN concat('**Difficulty:** ', upper(substr(difficulty, 1, 1)), lower(substr(difficulty, 2))) END, "
    f"concat('**Topics:** ', source, ', b'), concat({NL}, {P}), concat({NL}, '### Examples', {NL}, {EX_ALL}), concat({NL}, '### Solution', {NL}, '```python'))"
)


@query(
    f"SELECT doc_id, md5(CASE WHEN {P} <> '' THEN {CP_PROMPT} END) AS prompt, md5(CASE WHEN {P} <> '' THEN concat(CASE WHEN {S} <> '' THEN {S} ELSE 'second' END, {NL}, '```') END) AS response FROM {same(RECORD)}"
)
def sft_pair_cp(spark, sf_dir):
    return _digest(formats.cp_pair(_records(spark, sf_dir)), prompt="prompt", response="response")


def _q(text: str) -> str:
    return " || chr(10) || ".join("'" + x.replace("'", "''") + "'" for x in text.split("\n"))


def sql_chat(system: str, user: str, tail: str = "") -> str:
    return f"concat({_q(formats.SYSTEM_OPEN + system + formats.CLOSE + formats.USER_OPEN)}, {user}, {_q(formats.CLOSE + formats.ASSISTANT_OPEN + tail)})"


WHOLE = f"concat(CASE WHEN {GIVEN} <> '' THEN concat({GIVEN}, {NL}, {NL}) ELSE '' END, {ASK})"


@query(f"SELECT doc_id, md5(CASE WHEN {ASK} <> '' AND {TELL} <> '' THEN {sql_chat(formats.SE_SYSTEM, WHOLE)} END) AS prompt, md5(CASE WHEN {ASK} <> '' AND {TELL} <> '' THEN {TELL} END) AS response FROM {same(RECORD)}")
def sft_pair_se(spark, sf_dir):
    d = _records(spark, sf_dir).withColumns({"instruction": F.col("problem"), "response": F.col("sol")})
    return _digest(formats.se_pair(d), prompt="prompt", response="response")


GIVEN_EX = f"concat({NL}, {NL}, '### Examples', {NL}, 'Input:', {NL}, {EI}, {NL}, 'Output:', {NL}, {EO}, {NL}, {NL}, 'Input:', {NL}, {NL}, 'Output:', {NL}, {NL}, {NL}, 'Input:', {NL}, '9', {NL}, 'Output:', {NL}, '8')"
SE_TASK = f"CASE WHEN context <> '' THEN {sql_strip(f'''concat(context, {NL}, {NL}, coalesce(problem, ''))''')} ELSE coalesce(problem, '') END"


@query(
    f"SELECT doc_id, md5({sql_chat(formats.CP_RL_SYSTEM, f'''concat(coalesce(problem, ''), {GIVEN_EX})''', formats.THINK)}) AS cp_rl, md5({sql_chat(formats.RFT_SYSTEM, f'''concat(coalesce(problem, ''), {GIVEN_EX})''')}) AS cp_rft, "
    f"md5({sql_chat(formats.SE_RL_SYSTEM, SE_TASK, formats.THINK)}) AS se_rl, md5(CASE WHEN {P} <> '' THEN {CP_PROMPT} ELSE concat('### Problem', {NL}, coalesce(problem, ''), {NL}, {NL}, '### Solution', {NL}, '```python', {NL}) END) AS cp_eval FROM {same(RECORD)}"
)
def prompts(spark, sf_dir):
    d = _records(spark, sf_dir)
    return _digest(d, cp_rl=formats.cp_rl_prompt(), cp_rft=formats.cp_rft_prompt(), se_rl=formats.se_rl_prompt("problem", "context"), cp_eval=formats.cp_eval_prompt(d))


# ---- answers ---------------------------------------------------------------------------------------------------------

BODY = "concat('x = ', doc_id, chr(10), '  y')"
ANSWER = (
    f"doc_id ;; CASE doc_id % 7 WHEN 0 THEN concat('Well.', chr(10), '```python', chr(10), {BODY}, chr(10), '```', chr(10), '```sql', chr(10), 'SELECT 1', chr(10), '```') WHEN 1 THEN concat('```', chr(10), {BODY}, '```') "
    f"WHEN 2 THEN concat('1. Prose', chr(10), {BODY}, chr(13), chr(10), '- more', chr(10), 'z()') WHEN 3 THEN concat('<think>', repeat('t ', 20 + doc_id % 20), '</think> <tests>', chr(10), '1 2 -> 3', chr(10), 'no arrow', chr(10), ' a->b->c ', chr(10), '</tests>') "
    "WHEN 4 THEN '123' WHEN 5 THEN text ELSE '  please drop the table  ' END AS t"
)
BODY_SQL = BODY


@query(
    f"""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN md5({BODY}) WHEN 1 THEN md5({BODY}) WHEN 2 THEN md5(concat({BODY}, chr(10), 'z()')) WHEN 3 THEN md5(concat('no arrow', chr(10), ' a->b->c')) WHEN 4 THEN md5('123')
        WHEN 5 THEN md5(coalesce(nullif({sql_strip(r"array_to_string(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '^[ \ta-zA-Z_]')), chr(10))")}, ''), {sql_strip("t")}))
        WHEN 6 THEN md5('please drop the table') END AS rl_code,
        CASE doc_id % 7 WHEN 0 THEN md5({BODY}) WHEN 1 THEN md5({BODY}) WHEN 6 THEN md5('please drop the table') ELSE md5({sql_strip("t")}) END AS eval_code,
        CASE doc_id % 7 WHEN 0 THEN 'python,sql' WHEN 1 THEN 'python' ELSE '' END AS langs, CASE doc_id % 7 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_blocks,
        CASE doc_id % 7 WHEN 3 THEN '1 2=>3|a=>b->c' ELSE '' END AS own_tests, CASE doc_id % 7 WHEN 3 THEN concat('1 2 -> 3', chr(10), 'no arrow', chr(10), ' a->b->c') ELSE '' END AS own_code,
        doc_id % 7 = 3 AND 2 * (20 + doc_id % 20) - 1 > 50 AS cp_reasoned, doc_id % 7 = 3 AS se_reasoned,
        regexp_matches(t, '\\b(SELECT|INSERT|UPDATE|DELETE|CREATE|DROP|ALTER|WITH)\\b', 'i') AS any_sql FROM {same(ANSWER)}"""
)
def extract_code(spark, sf_dir):
    """All that is read out of answers."""
    d = made(spark, sf_dir, ANSWER)
    return d.select(
        "doc_id",
        F.md5(E.answer_code("t")).alias("rl_code"),
        F.md5(E.solution_code("t")).alias("eval_code"),
        F.array_join(F.transform(E.named_blocks("t"), lambda b: b["lang"]), ",").alias("langs"),
        F.size(E.blocks("t")).alias("n_blocks"),
        shown_examples(E.self_tests("t")).alias("own_tests"),
        E.self_test_code("t").alias("own_code"),
        E.has_reasoning("t").alias("cp_reasoned"),
        E.has_reasoning("t", E.SE_REASONING).alias("se_reasoned"),
        E.has_sql("t").alias("any_sql"),
    )


OUT = "doc_id ;; concat(chr(10), replace(text, ' ', '  ' || chr(10)), '  ', chr(13), chr(10)) AS t"


@query(f"SELECT doc_id, md5(regexp_replace({sql_strip('replace(t, chr(13) || chr(10), chr(10))')}, ' +' || chr(10), chr(10), 'g')) AS shown FROM {same(OUT)}")
def normal_output(spark, sf_dir):
    return made(spark, sf_dir, OUT).select("doc_id", F.md5(E.normal_output("t")).alias("shown"))


@query(f"SELECT doc_id, doc_id % 7 = 4 AS valid FROM {same(ANSWER)}")
def valid_python(spark, sf_dir):
    """Only the number parses: bodies end indented, other answers are prose."""
    return made(spark, sf_dir, ANSWER).select("doc_id", E.valid_python(E.answer_code("t")).alias("valid"))


# ---- tokens ----------------------------------------------------------------------------------------------------------

L = 64
TOKENS = r"""t AS (SELECT doc_id, list_transform(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda w: w <> ''), lambda w: CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % 50000 + 1 AS INTEGER)) AS ids FROM documents)"""


def _tokens(spark, sf_dir, n: int | None = None) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tokens.whitespace_tokens("text").alias("ids"))


@query(
    f"""WITH {TOKENS}, e AS (SELECT doc_id, unnest(list_append(ids, 0)) AS id, generate_subscripts(list_append(ids, 0), 1) AS i FROM t),
    p AS (SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, count(*) OVER () AS total FROM e)
    SELECT pos // {L} AS chunk, md5(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos)) AS ids, CAST(count(*) AS INTEGER) AS n FROM p WHERE pos // {L} < ceil(total / {L}) - 1 GROUP BY 1"""
)
def pack_tokens(spark, sf_dir):
    out = tokens.pack(_tokens(spark, sf_dir), order_col="doc_id", length=L)
    return out.select(F.col("chunk").cast("long").alias("chunk"), F.md5(F.array_join("input_ids", ",")).alias("ids"), F.size("attention_mask").alias("n"))


@query(f"WITH {TOKENS} SELECT doc_id, md5(array_to_string(list_slice(ids, 1, {L}), ',')) AS ids, CAST(least(len(ids), {L}) AS INTEGER) AS n FROM t WHERE least(len(ids), {L}) > 10")
def truncate_tokens(spark, sf_dir):
    return tokens.truncate(_tokens(spark, sf_dir), length=L).select("doc_id", F.md5(F.array_join("input_ids", ",")).alias("ids"), F.size("labels").alias("n"))


PAIR = "doc_id ;; lang AS b ;; concat(source, ' asks: ') AS prompt ;; CASE doc_id % 5 WHEN 0 THEN ' ' ELSE text END AS response"
MASKED = rf"""w AS (SELECT doc_id, b, string_split_regex(trim(prompt), '\s+') AS p, list_filter(string_split_regex(prompt || response, '\s+'), lambda w: w <> '') AS a FROM {same(PAIR)} WHERE trim(response) <> ''),
    m AS (SELECT doc_id, b, len(p) AS n, list_slice(list_append(list_transform(a, lambda w: CAST(('0x' || substr(md5(w), 1, 8))::BIGINT % 50000 + 1 AS INTEGER)), 0), 1, {L}) AS ids FROM w),
    k AS (SELECT doc_id, b, ids, list_transform(ids, lambda x, i: CASE WHEN i <= n THEN -100 ELSE x END) AS labels FROM m WHERE len(ids) >= 10)"""


def _masked(spark, sf_dir) -> DataFrame:
    return tokens.mask_prompt(made(spark, sf_dir, PAIR), length=L)


@query(f"WITH {MASKED} SELECT doc_id, md5(array_to_string(ids, ',')) AS ids, md5(array_to_string(labels, ',')) AS labels FROM k")
def sft_mask(spark, sf_dir):
    return _masked(spark, sf_dir).select("doc_id", F.md5(F.array_join("input_ids", ",")).alias("ids"), F.md5(F.array_join("labels", ",")).alias("labels"))


@query(
    f"""WITH {MASKED}, g AS (SELECT b, max(len(ids)) AS m FROM k GROUP BY b)
    SELECT doc_id, md5(array_to_string(list_concat(ids, list_transform(range(m - len(ids)), lambda i: 0)), ',')) AS ids, md5(array_to_string(list_concat(labels, list_transform(range(m - len(ids)), lambda i: -100)), ',')) AS labels,
           CAST(len(ids) AS BIGINT) AS n_real FROM k JOIN g USING (b)"""
)
def pad_batch(spark, sf_dir):
    out = tokens.pad_batches(_masked(spark, sf_dir), "b", "doc_id")
    return out.select("doc_id", F.md5(F.array_join("input_ids", ",")).alias("ids"), F.md5(F.array_join("labels", ",")).alias("labels"), F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_real"))


LOG = "user_id AS run ;; event_id AS step ;; value AS tokens ;; event_id * 0.5 AS time ;; CASE WHEN event_id % 97 = 0 THEN 1e308 * 1e10 ELSE value END AS loss"
LOG_SPARK = LOG.replace("1e308 * 1e10", "double('Infinity')").replace("event_id * 0.5", "event_id * double(0.5)")
LOG_SQL = LOG.replace("1e308 * 1e10", "'infinity'::DOUBLE").replace("event_id * 0.5", "event_id * 0.5::DOUBLE")


@query(f"SELECT step, (tokens - lag(tokens) OVER w) / (time - lag(time) OVER w) AS rate FROM {same(LOG_SQL, 'events')} WINDOW w AS (PARTITION BY run ORDER BY step)")
def throughput(spark, sf_dir):
    return tokens.throughput(made(spark, sf_dir, LOG_SPARK, "events")).select("step", F.col("tokens_per_second").alias("rate"))


@query(f"SELECT run, min(step) AS step FROM {same(LOG_SQL, 'events')} WHERE isnan(loss) OR isinf(loss) GROUP BY run")
def nan_guard(spark, sf_dir):
    return tokens.first_bad_loss(made(spark, sf_dir, LOG_SPARK, "events"))


@query(f"SELECT run, step FROM (SELECT run, step, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS n FROM {same(LOG_SQL, 'events')}) WHERE n <= 5")
def last_log_rows(spark, sf_dir):
    return tokens.last_rows(made(spark, sf_dir, LOG_SPARK, "events")).select("run", "step")


# ---- scores ----------------------------------------------------------------------------------------------------------

SAMPLES = "doc_id // 4 AS problem_id ;; CAST(doc_id % 4 AS INTEGER) AS sample_idx ;; quality = 1 AS passed"
SAMPLES_SPARK = SAMPLES.replace("//", "div").replace("AS INTEGER", "AS INT")
PASS = """(SELECT problem_id, n_samples, n_correct, CASE WHEN n_samples < 1 THEN 'nan'::DOUBLE WHEN n_samples - n_correct < 1 THEN 1.0 ELSE 1.0 - (n_samples - n_correct) / n_samples END AS pass_1,
    CASE WHEN n_samples < 2 THEN 'nan'::DOUBLE WHEN n_samples - n_correct < 2 THEN 1.0 ELSE 1.0 - (n_samples - n_correct) / n_samples * (n_samples - n_correct - 1) / (n_samples - 1) END AS pass_2
    FROM (SELECT problem_id, count(*) AS n_samples, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS n_correct FROM """ + same(SAMPLES, "labels") + " GROUP BY 1))"


def _problems(spark, sf_dir) -> DataFrame:
    return scores.per_problem(made(spark, sf_dir, SAMPLES_SPARK, "labels"), (1, 2))


@query(f"SELECT problem_id, n_samples, n_correct, round(pass_1, 9) AS pass_1, round(pass_2, 9) AS pass_2 FROM {PASS}")
def pass_at_k(spark, sf_dir):
    return _problems(spark, sf_dir).withColumns({c: F.round(c, 9) for c in ("pass_1", "pass_2")})


@query(f"SELECT count(*) AS total_problems, round(avg(pass_1) FILTER (WHERE problem_id % 7 <> 0), 9) AS pass_1 FROM {PASS}")
def pass_overall(spark, sf_dir):
    problems = _problems(spark, sf_dir).withColumn("skipped", F.col("problem_id") % 7 == 0)
    return scores.overall(problems, (1,), "skipped").withColumn("pass_1", F.round("pass_1", 9))


@query(f"SELECT CASE problem_id % 3 WHEN 0 THEN 'easy' WHEN 1 THEN 'medium' ELSE 'hard' END AS difficulty, count(*) AS n, round(avg(pass_1), 9) AS pass_1 FROM {PASS} GROUP BY 1")
def pass_by_difficulty(spark, sf_dir):
    level = F.when(F.col("problem_id") % 3 == 0, "easy").when(F.col("problem_id") % 3 == 1, "medium").otherwise("hard")
    return scores.by_difficulty(_problems(spark, sf_dir).withColumn("difficulty", level)).withColumn("pass_1", F.round("pass_1", 9))


@query(f"SELECT problem_id, min(sample_idx) AS sample_idx FROM {same(SAMPLES, 'labels')} WHERE passed GROUP BY 1")
def rejection_sample(spark, sf_dir):
    c = made(spark, sf_dir, SAMPLES_SPARK, "labels").withColumns({"completion": F.lit("c"), "verified": F.col("passed")})
    return scores.first_verified(c).select("problem_id", "sample_idx")


@query(f"SELECT count(*) AS n_problems, CAST(sum(n) AS BIGINT) AS n_candidates, CAST(sum(ok) AS BIGINT) AS n_verified, round(sum(ok) / greatest(count(*), 1), 9) AS pass_rate FROM (SELECT problem_id, count(*) AS n, max(CAST(passed AS INTEGER)) AS ok FROM {same(SAMPLES, 'labels')} GROUP BY 1)")
def acceptance(spark, sf_dir):
    out = scores.acceptance(made(spark, sf_dir, SAMPLES_SPARK, "labels"), verified_col="passed")
    return out.withColumn("pass_rate", F.round("pass_rate", 9))


PARTS = (
    "doc_id ;; (doc_id % 5) / 4.0e0 AS pass_rate ;; (doc_id % 3) / 1.5e0 AS elapsed ;; doc_id % 2 = 0 AS valid_syntax ;; doc_id % 7 = 0 AS reasoned ;; (doc_id % 11) / 10.0e0 AS self_rate ;; doc_id % 13 <> 0 AS has_examples ;; "
    "CASE doc_id % 4 WHEN 0 THEN 'sql' WHEN 1 THEN 'code' WHEN 2 THEN 'qa' END AS type ;; doc_id % 3 <> 0 AS has_code ;; doc_id % 6 = 1 AS self_pass ;; doc_id % 8 = 2 AS any_valid"
)
_b = lambda c, w: f"CASE WHEN {c} THEN {w} ELSE 0 END"


@query(
    f"SELECT doc_id, round(least(1.0, pass_rate + {_b('valid_syntax', 0.1)} + {_b('reasoned', 0.08)} + CASE WHEN (pass_rate >= 1 OR NOT has_examples) AND valid_syntax THEN 0.15e0 * self_rate ELSE 0 END + {_b('pass_rate >= 1 AND elapsed < 1', 0.05)}), 9) AS reward FROM {same(PARTS)}"
)
def reward_cp(spark, sf_dir):
    return made(spark, sf_dir, PARTS).select("doc_id", F.round(scores.cp_reward(), 9).alias("reward"))


@query(
    f"SELECT doc_id, round(least(1.0, {_b('has_code', 0.1)} + {_b('reasoned', 0.08)} + CASE WHEN type = 'sql' THEN pass_rate WHEN coalesce(type, 'code') = 'code' THEN pass_rate + {_b('pass_rate >= 0.9 AND self_pass', 0.15)} ELSE {_b('any_valid', 0.2)} END), 9) AS reward FROM {same(PARTS)}"
)
def reward_se(spark, sf_dir):
    return made(spark, sf_dir, PARTS).select("doc_id", F.round(scores.se_reward(best="pass_rate"), 9).alias("reward"))


ANSWERED = "doc_id ;; CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN concat('```python', chr(10), 'x = 1', chr(10), '```') WHEN 2 THEN concat('```', chr(10), 'x = = 1', chr(10), '```') WHEN 3 THEN 'select 1' WHEN 4 THEN NULL ELSE text END AS response ;; CASE doc_id % 4 WHEN 0 THEN 'sql' WHEN 1 THEN 'code' ELSE 'qa' END AS type"
FLAGS = f"(SELECT type, doc_id % 6 IN (1, 2, 3, 5) AS non_empty, doc_id % 6 IN (1, 2) AS has_code, doc_id % 6 = 1 AS code_valid, type = 'sql' AND doc_id % 6 = 3 AS sql_valid FROM {same(ANSWERED)})"
COUNTS = ", ".join(f"CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS n_{c}, round(100.0 * count(*) FILTER (WHERE {c}) / greatest(count(*), 1), 9) AS pct_{c}" for c in ("non_empty", "has_code", "code_valid", "sql_valid"))


def _quality(spark, sf_dir, by: str | None = None) -> DataFrame:
    out = scores.answer_quality(scores.answer_flags(made(spark, sf_dir, ANSWERED)), by)
    return out.withColumns({c: F.round(c, 9) for c in out.columns if c.startswith("pct_")})


@query(f"SELECT count(*) AS n_total, {COUNTS} FROM {FLAGS}")
def se_quality(spark, sf_dir):
    return _quality(spark, sf_dir)


@query(f"SELECT type, count(*) AS n_total, {COUNTS} FROM {FLAGS} GROUP BY type")
def se_by_type(spark, sf_dir):
    return _quality(spark, sf_dir, "type")


# ---- the whole plan --------------------------------------------------------------------------------------------------

@query(
    f"""WITH a AS (SELECT {PROBLEM} AS t, source FROM documents WHERE {PROBLEM} <> ''),
    f AS (SELECT * FROM a WHERE source < 'src5' OR length(t) BETWEEN 50 AND 8000 AND NOT {sql_any("t", V.CP_REJECT_PATTERNS)}),
    n AS (SELECT (SELECT count(*) FROM a) AS n_preprocessed, (SELECT count(*) FROM f) AS n_filtered, (SELECT count(DISTINCT {sql_key("t")}) FROM f) AS n),
    s AS (SELECT *, greatest(1, n // 100) AS n_test, greatest(1, n * 2 // 100) AS n_val FROM n)
    SELECT 'taco,project_euler' AS sources, 85e-2 AS threshold, 42 AS seed, 'exact' AS method, n_preprocessed, n_filtered, n AS n_deduplicated, n - n_test - n_val AS n_train, n_val, n_test FROM s"""
)
def corpus_meta(spark, sf_dir):
    """The whole plan over two sources made of the documents, with exact keys: counts by stage."""
    raw = made(spark, sf_dir, RAW).selectExpr("doc_id AS _rid", "a AS question", "b AS problem", "b AS text", "sj AS solutions", "sj AS answer", "ej AS input_output", "lev AS difficulty", "tg AS tags", "src")
    parts = {"taco": raw.where("src < 'src5'"), "project_euler": raw.where("src >= 'src5'")}
    built = build({name: df.drop("src") for name, df in parts.items()}, Options(method="exact"))
    built.discard()  # the counts are known
    return built["meta"]


@query(f"SELECT count(*) AS n_preprocessed, count(*) FILTER (WHERE {sql_cp()}) AS n_filtered FROM {same(MARKS)} WHERE {sql_squeezed('t')} <> ''")
def stage_counts(spark, sf_dir):
    """Counts before and after the filter in one pass."""
    from millrace.functions.text import clean_squeezed
    from millrace.operators.relevance import cp_relevant

    d = made(spark, sf_dir, MARKS).where(clean_squeezed("t") != "").select(F.col("t").alias("problem"), F.array("sol").alias("solutions"), F.array_compact(F.array("tag")).alias("tags"), F.col("src").alias("source"))
    return d.agg(F.count("*").alias("n_preprocessed"), F.count_if(cp_relevant()).alias("n_filtered"))

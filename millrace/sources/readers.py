"""Source registries, readers and sinks."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.split import head

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Source:
    """Where a source lies under the root folder: path/config/split, and whether its loader needs code of its own."""

    path: str
    split: str = "train"
    config: str | None = None
    own_code: bool = False

    def folder(self, root: str) -> str:
        return "/".join(x for x in (root.rstrip("/"), self.path, self.config, self.split) if x)


# The sources of both domains.
CP_SOURCES = {
    "taco": Source("BAAI/TACO", own_code=True),
    "apps": Source("codeparrot/apps"),
    "code_contests": Source("deepmind/code_contests"),
    "codeforces": Source("open-r1/codeforces", own_code=True),
    "codeforces_cots": Source("open-r1/codeforces-cots", config="all", own_code=True),
    "leetcode": Source("greengerong/leetcode"),
    "amc_aime": Source("math-ai/amc_aime"),
    "project_euler": Source("ajibawa-2023/project_euler"),
    "opencode_reasoning": Source("nvidia/OpenCodeReasoning"),
    "opencode_reasoning2": Source("nvidia/OpenCodeReasoning-2"),
    "kodcode": Source("KodCode/KodCode"),
    "code_feedback": Source("m-a-p/CodeFeedback-Filtered-Instruction"),
    "bigcodebench": Source("bigcode/bigcodebench", split="v0.1.2"),
    "magicoder_evol": Source("ise-uiuc/Magicoder-Evol-Instruct-110K"),
    "aizu": Source("BAAI/AIZU-OJ"),
    "competitive_programming_v4": Source("deepmind/competitive_programming"),
}
SE_SOURCES = {
    "the_stack_python": Source("bigcode/the-stack-v2-dedup", config="Python"),
    "the_stack_js": Source("bigcode/the-stack-v2-dedup", config="JavaScript"),
    "the_stack_ts": Source("bigcode/the-stack-v2-dedup", config="TypeScript"),
    "the_stack_go": Source("bigcode/the-stack-v2-dedup", config="Go"),
    "the_stack_java": Source("bigcode/the-stack-v2-dedup", config="Java"),
    "the_stack_rust": Source("bigcode/the-stack-v2-dedup", config="Rust"),
    "the_stack_sql": Source("bigcode/the-stack-v2-dedup", config="SQL"),
    "the_stack_shell": Source("bigcode/the-stack-v2-dedup", config="Shell"),
    "commitpackft": Source("bigcode/commitpackft"),
    "stack_exchange": Source("ArmelR/stack-exchange-instruction"),
    "magicoder_oss": Source("ise-uiuc/Magicoder-OSS-Instruct-75K"),
    "magicoder_evol": Source("ise-uiuc/Magicoder-Evol-Instruct-110K"),
    "code_feedback": Source("m-a-p/CodeFeedback-Filtered-Instruction"),
    "evol_codealpaca": Source("theblackcat102/evol-codealpaca-v1"),
    "glaive_code": Source("glaiveai/glaive-code-assistant-v3", own_code=True),
    "text_to_sql": Source("gretelai/synthetic-text-to-sql"),
    "ultrachat": Source("HuggingFaceH4/ultrachat_200k", split="train_sft"),
    "self_oss_instruct": Source("bigcode/self-oss-instruct-sc2-exec-filter-50k"),
}
SOURCES = {"cp": CP_SOURCES, "se": SE_SOURCES}


def source_names(domain: str = "cp") -> list[str]:
    return list(SOURCES[domain])


def read_source(spark: SparkSession, name: str, root: str, domain: str = "cp", max_rows: int | None = None, order_col: str | None = None) -> DataFrame | None:
    """A source's Parquet folder under ``root``, else its JSON lines; None, and a warning, if it is unknown or can't be read.

    ``max_rows``: the first rows by ``order_col``; 0 or None: all.
    """
    if max_rows and not order_col:
        raise ValueError("max_rows needs order_col: without an order the first rows differ from run to run")
    source = SOURCES[domain].get(name)
    if source is None:
        log.warning("unknown source %s", name)
        return None
    path = source.folder(root)
    form = _format(spark, path)
    if form is None:
        log.error("source %s can't be read: no files in %s", name, path)
        return None
    try:
        df = spark.read.format(form).load(path)
    except (AnalysisException, Py4JJavaError) as e:
        log.error("source %s can't be read: %s", name, e)
        return None
    return head(df, max_rows, order_col) if max_rows else df


def _format(spark: SparkSession, path: str) -> str | None:
    """Parquet if the folder's first file is, else JSON; None without files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    files = fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return "parquet" if ".parquet" in name else "json"
    return None


def read_sources(spark: SparkSession, names: Sequence[str], root: str, domain: str = "cp", **options) -> dict[str, DataFrame]:
    """All sources that can be read; RuntimeError if none can."""
    found = {n: df for n in names if (df := read_source(spark, n, root, domain, **options)) is not None}
    if not found:
        raise RuntimeError(f"none of the sources can be read: {', '.join(names)}")
    return found


def union(frames: Sequence[DataFrame]) -> DataFrame:
    """By name; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, tolerant: bool = False, max_rows: int | None = None, order_col: str | None = None) -> DataFrame:
    """JSON lines; blank lines are skipped. A broken line fails the job, or is skipped if ``tolerant``."""
    if max_rows and not order_col:
        raise ValueError("max_rows needs order_col: without an order the first rows differ from run to run")
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").json(path)
    return head(df, max_rows, order_col) if max_rows else df


def written(spark: SparkSession, path: str) -> bool:
    """Whether an output folder is complete."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_jsonl(df: DataFrame, path: str, where: Column | None = None) -> None:
    (df if where is None else df.where(where)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_documents(df: DataFrame, path: str, text_col: str = "text", least: int = 100) -> None:
    """{text} of documents that have a length."""
    write_jsonl(df.select(F.col(text_col).alias("text")), path, F.length("text") >= least)


def write_pairs(df: DataFrame, path: str, with_record: bool = True) -> None:
    """Prompt and response, and the record they come from; without pairs, and without pretraining rows."""
    good = F.col("prompt").isNotNull() & F.col("response").isNotNull()
    if "type" in df.columns:
        good = good & (F.coalesce(F.col("type"), F.lit("")) != "pretrain")
    rows = df.where(good)
    write_jsonl(rows if with_record else rows.select("prompt", "response"), path)


def write_summary(df: DataFrame, path: str) -> None:
    """A small result in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_config(path: str) -> dict:
    """A configuration of JSON, or of YAML where its library is there."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.safe_load(text) or {}


def write_config(values: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(values, f, indent=2)




def parse_records(df: DataFrame, json_col: str, schema: T.StructType | str, out_col: str = "record") -> DataFrame:
    """``df`` with the record that a JSON text holds; a broken one is a record of nulls."""
    return df.withColumn(out_col, F.from_json(F.coalesce(F.col(json_col), F.lit("{}")), schema, {"mode": "PERMISSIVE"}))


# Short names of base models.
MODEL_NAMES = {
    "qwen2.5-coder-7b": "Qwen/Qwen2.5-Coder-7B",
    "qwen2.5-coder-7b-instruct": "Qwen/Qwen2.5-Coder-7B-Instruct",
    "deepseek-coder-v2-lite": "deepseek-ai/DeepSeek-Coder-V2-Lite-Base",
    "deepseek-coder-v2-lite-instruct": "deepseek-ai/DeepSeek-Coder-V2-Lite-Instruct",
    "qwen2.5-coder-1.5b": "Qwen/Qwen2.5-Coder-1.5B",
    "deepseek-coder-1.3b": "deepseek-ai/deepseek-coder-1.3b-base",
}

"""Corpus building end to end: read, normalize, filter, cap, dedup, split, format, write."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_near, shared_folder
from millrace.operators.formats import cp_document, cp_pair, se_document, se_pair
from millrace.operators.relevance import cap_solutions, cp_filter, se_filter
from millrace.operators.split import split
from millrace.operators.verify import keep_verified
from millrace.sources.normalize import normalize
from millrace.sources.readers import union, write_documents, write_jsonl, write_pairs, write_summary, written

OUTPUTS = ("pretrain_train", "pretrain_val", "sft_train", "sft_val", "test")


@dataclass
class Options:
    domain: str = "cp"
    threshold: float = 0.85
    method: str = "minhash"
    seed: int = 42
    test: float = 0.01
    val: float = 0.02
    solutions: int = 3
    need_signal: bool = False
    verify: bool = False
    text_col: str | None = None
    clean_val: bool = False
    names: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, values: Mapping) -> Options:
        """Options from a configuration, its values in the kinds of the fields; names that are no option are an error."""
        known = {f.name: f for f in fields(cls)}
        if unknown := sorted(set(values) - set(known)):
            raise ValueError(f"no such options: {', '.join(unknown)}")
        return cls(**{k: _as(known[k].type, v) for k, v in values.items()})


def _as(kind: str, value):
    if value is None or value == "" and "None" in kind:
        return None
    if kind == "bool":
        if str(value).lower() not in ("true", "false", "1", "0"):
            raise ValueError(f"neither true nor false: {value}")
        return str(value).lower() in ("true", "1")
    if kind.startswith("list"):
        return [x for x in value.split(",") if x] if isinstance(value, str) else list(value)
    return {"int": int, "float": float}.get(kind, str)(value)


def records(raw: Mapping[str, DataFrame], options: Options) -> DataFrame:
    """All sources in one schema, in order: ``_rid`` is made of the place of the source and the row's own ``_rid``."""
    parts = [normalize(df, name, options.domain).withColumn("_rid", F.col("_rid") + F.lit(i << 44)) for i, (name, df) in enumerate(raw.items())]
    return union(parts)


class Built(dict):
    """The parts by name, on tables in the shared folder, and what the jobs that wrote these counted on the way.

    Counts are taken in the last stage of a writing job, whose tasks count once however often they are run. ``discard`` deletes
    the tables.
    """

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark, self.counts, self._seen, self._paths = spark, {}, [], []

    def counting(self, df: DataFrame, **counts: Column) -> DataFrame:
        """``df``, to be counted by the job that stores it."""
        seen = Observation()
        self._seen.append((seen, list(counts)))
        return df.observe(seen, *(c.alias(k) for k, c in counts.items()))

    def store(self, df: DataFrame, by: str | None = None) -> DataFrame:
        path = f"{shared_folder(self.spark)}/corpus-{uuid.uuid4().hex}"
        self._paths.append(path)
        writer = df.write.partitionBy(by) if by else df.write
        writer.parquet(path)
        for seen, names in self._seen:
            found = seen.get
            self.counts |= {k: found.get(k) or 0 for k in names}
        self._seen = []
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self) -> None:
        for path in self._paths:
            where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        self._paths = []


def build(raw: Mapping[str, DataFrame], options: Options | None = None) -> Built:
    """train, val and test records, and meta, a row of counts by stage. Raw frames carry ``_rid``, their order.

    Each stage is stored once and counts what goes through it; nothing is made twice for its count.
    """
    o = options or Options()
    cp = o.domain == "cp"
    text = o.text_col or ("problem" if cp else "instruction")
    every = F.count(F.lit(1))
    normal = records(raw, o)
    built = Built(normal.sparkSession)
    relevant = built.counting(normal, n_preprocessed=every).transform((cp_filter if cp else se_filter)(need_signal=o.need_signal))
    if cp:
        relevant = cap_solutions(relevant, o.solutions)
    relevant = built.store(built.counting(relevant, n_filtered=every))
    unique = built.store(built.counting(dedup_near(relevant, text, "_rid", o.threshold, o.method), n_deduplicated=every))
    parts = split(unique, o.seed, o.test, o.val, "_rid", text, o.method, o.clean_val)
    marked = [df.withColumn("_part", F.lit(k)) for k, df in parts.items()]
    final = built.store(built.counting(union(marked), **{f"n_{k}": F.count_if(F.col("_part") == k) for k in parts}), by="_part")
    for k in parts:
        built[k] = final.where(F.col("_part") == k).drop("_part")
    given = {k: v for k, v in asdict(o).items() if k in ("threshold", "seed", "method")}
    row = {"sources": ",".join(raw), **given, **{k: F.lit(n).cast("long") for k, n in built.counts.items()}}
    built["meta"] = built.spark.range(1).select(*((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in row.items()))
    return built


def write(built: Mapping[str, DataFrame], path: str, options: Options | None = None) -> None:
    """The five outputs and the counts, as JSON lines under ``path``."""
    o = options or Options()
    document, pair = (cp_document(), cp_pair) if o.domain == "cp" else (se_document(), se_pair)
    for part in ("train", "val"):
        write_documents(built[part].select(document.alias("text")), f"{path}/pretrain_{part}")
        rows = keep_verified(built[part]) if o.verify and o.domain == "cp" and part == "train" else built[part]
        write_pairs(pair(rows), f"{path}/sft_{part}")
    write_jsonl(built["test"], f"{path}/test")
    write_summary(built["meta"], f"{path}/meta")


def prepare(raw: Mapping[str, DataFrame], path: str, options: Options | None = None) -> bool:
    """Build and write, unless all outputs are there; whether anything was written."""
    spark = next(iter(raw.values())).sparkSession
    if all(written(spark, f"{path}/{name}") for name in OUTPUTS):
        return False
    built = build(raw, options)
    try:
        write(built, path, options)
    finally:
        built.discard()
    return True

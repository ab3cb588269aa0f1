"""Sources that grow: their files as a stream, normalized batch by batch into a table to which a restart adds nothing twice."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.normalize import normalize
from millrace.sources.readers import SOURCES, _format

log = logging.getLogger(__name__)


def read_stream(spark: SparkSession, name: str, root: str, domain: str = "cp", schema: T.StructType | str | None = None, files_a_batch: int | None = 1000) -> DataFrame | None:
    """A source's folder under ``root`` as a stream of its files, Parquet or JSON lines; None, and a warning, where it can't be read.

    Without a ``schema`` that of the files there is taken. ``files_a_batch`` bounds what a batch reads; None: all that is new.
    """
    source = SOURCES[domain].get(name)
    if source is None:
        log.warning("unknown source %s", name)
        return None
    path = source.folder(root)
    form = _format(spark, path)
    if form is None:
        log.error("source %s can't be read: no files in %s", name, path)
        return None
    reader = spark.readStream.format(form).schema(schema or spark.read.format(form).load(path).schema)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.load(path)


def ingest(stream: DataFrame, path: str, checkpoint: str, name: str, domain: str = "cp", then: Callable[[DataFrame], DataFrame] | None = None, wait: bool = True) -> StreamingQuery:
    """Normalize what is new in a stream of a source's raw rows, which carry ``_rid``, and write it to ``path``.

    Files read so far are known to ``checkpoint``. A batch has a folder of its own, which is written anew if the batch is
    tried again: so a stop at any moment, and a restart, neither lose nor repeat a row. ``then`` is applied to each batch (filters,
    formats). The query ends when nothing is new; with ``wait`` not before.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = normalize(batch, name, domain)
        (then(rows) if then else rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """All rows written by ``ingest``."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*").drop("batch")

"""An index of kept rows that outlives a run: new rows are held against it, and what is kept of them is put in.

The index is a table of MinHash bands, bucketed and sorted by band hash, so that a lookup shuffles the new rows only. It lies
at a path of its own and is registered with whatever session opens it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.dedup import _cut as cut
from millrace.operators.dedup import _firsts, _members, keep_first_of_buckets, signatures


class NearIndex:
    """Bands of kept rows at ``path``, made with ``buckets`` where there is none; ids are whole numbers."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.buckets, self.table = spark, buckets, f"near_index_{hashlib.md5(path.encode()).hexdigest()}"
        where = path.replace("'", r"\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (id BIGINT, h BIGINT, run STRING) USING parquet CLUSTERED BY (h) SORTED BY (h) INTO {buckets} BUCKETS LOCATION '{where}'")

    def close(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _banded(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return signatures(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))

    @staticmethod
    def _hashes(signed: DataFrame, outer: bool = False) -> DataFrame:
        """(id, h): the band and its hash as one; with ``outer`` a null for rows without bands."""
        each = F.posexplode_outer("bands") if outer else F.posexplode("bands")
        return signed.select("id", each.alias("band", "x")).select("id", F.when(F.col("x").isNotNull(), F.xxhash64("band", "x")).alias("h"))

    def hits(self, df: DataFrame, text_col: str = "problem", id_col: str = "_rid") -> DataFrame:
        """(id_col): rows that have a kept near copy in the index."""
        return self._hits(self._banded(df, id_col, text_col)).withColumnRenamed("id", id_col)

    def _hits(self, signed: DataFrame) -> DataFrame:
        return self._hashes(signed).join(self.rows().select("h"), "h", "left_semi").select("id").distinct()

    def add(self, df: DataFrame, run: str, text_col: str = "problem", id_col: str = "_rid") -> DataFrame:
        """The rows of ``df`` that stay, which are in the index then: no near copy was kept before, in an earlier run or earlier in this.

        A run that is in the index adds nothing: its rows are those that it kept.
        """
        before = self.rows().where(F.col("run") == run).select("id")
        if before.isEmpty():
            signed = cut(self._banded(df, id_col, text_col))
            fresh = signed.join(self._hits(signed), "id", "left_anti")
            firsts = cut(_firsts(fresh, "bands"))
            kept = cut(keep_first_of_buckets(firsts.select("id"), _members(firsts)))
            bands = self._hashes(signed.join(kept, "id", "left_semi"), outer=True).withColumn("run", F.lit(run))
            bands.repartition(self.buckets, "h").write.insertInto(self.table)
        else:
            kept = before.distinct()
        return df.join(kept.withColumnRenamed("id", id_col), id_col, "left_semi").select(*df.columns)

"""Tables stored in the order of a key, for ranges, prefixes and the next rows.

Rows are dealt by range of the key and sorted within parts; every part is a folder of its own, and a small table
holds the least and greatest key of each.  A search first asks that table which parts it touches, so only these are
listed and opened, and within them the condition on the stored key skips row groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.filters import limit_n

#: Rows of a part; the table of ends has one row a part, and is read whole.
PART_ROWS = 1_000_000


class KeyedTable:
    """A table at ``path``, in the order of its column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def write(self, rows: DataFrame, parts: int | None = None) -> KeyedTable:
        """Store ``rows``; ``parts`` is by default a part for each million rows."""
        parts = parts or max(1, -(-rows.count() // PART_ROWS))
        dealt = rows.repartitionByRange(parts, F.col(self.key).asc_nulls_first()).sortWithinPartitions(F.col(self.key).asc_nulls_first())
        dealt.withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(f"{self.path}/rows")
        stored = self.spark.read.parquet(f"{self.path}/rows")
        stored.groupBy("part").agg(F.min(self.key).alias("lo"), F.max(self.key).alias("hi"), F.count("*").alias("rows")).coalesce(1).write.parquet(f"{self.path}/ends")
        return self

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def ends(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/ends")

    def _of_parts(self, touched: Column) -> DataFrame:
        parts = [r["part"] for r in self.ends().filter(touched).select("part").collect()]
        return self.rows().filter(F.col("part").isin(parts))

    def between(self, lo, hi=None, n: int | None = None, *ties: str) -> DataFrame:
        """Rows from ``lo`` to ``hi`` (or all after ``lo``), in order; all, or the first ``n``."""
        key = F.col(self.key)
        if hi is None and n is not None:
            return self._next(lo, n, *ties)
        touched, wanted = F.col("hi") >= F.lit(lo), key >= F.lit(lo)
        if hi is not None:
            touched, wanted = touched & (F.col("lo") <= F.lit(hi)), wanted & (key <= F.lit(hi))
        return limit_n(self._of_parts(touched).filter(wanted).drop("part"), n, self.key, *ties)

    def _next(self, lo, n: int, *ties: str) -> DataFrame:
        """The first ``n`` rows from ``lo`` on, from as few parts as are sure to hold them.

        Equal keys lie in one part, so the order of ties is settled within the parts chosen.
        """
        parts = self.ends().filter(F.col("hi") >= F.lit(lo)).orderBy("lo").select("part", "rows").collect()
        chosen, after = [], 0
        for row in parts:
            chosen.append(row["part"])
            after += row["rows"] if len(chosen) > 1 else 0  # the first may hold rows before ``lo``
            if after >= n:
                break
        return limit_n(self.rows().filter(F.col("part").isin(chosen) & (F.col(self.key) >= F.lit(lo))).drop("part"), n, self.key, *ties)

    def prefixed(self, prefix: str, *ties: str) -> DataFrame:
        """Rows whose key starts with ``prefix``, in order."""
        touched = (F.substring("hi", 1, len(prefix)) >= F.lit(prefix)) & (F.substring("lo", 1, len(prefix)) <= F.lit(prefix))
        return limit_n(self._of_parts(touched).filter(F.col(self.key).startswith(prefix)).drop("part"), None, self.key, *ties)

    def exactly(self, value, *ties: str) -> DataFrame:
        return self.between(value, value, None, *ties)

    def search(self, mode: str, lo, hi=None, n: int | None = None, *ties: str) -> DataFrame:
        """By one of the modes of a key search: ``set`` (from ``lo`` on), ``exact``, ``prefix`` or ``range``."""
        if mode == "set":
            return self.between(lo, None, n, *ties)
        if mode == "exact":
            return limit_n(self.exactly(lo, *ties), n, self.key, *ties)
        if mode == "prefix":
            return limit_n(self.prefixed(lo, *ties), n, self.key, *ties)
        if mode == "range":
            return self.between(lo, hi, n, *ties)
        raise ValueError(f"unknown search mode: {mode}")

    def nearest(self, lo, hi, mode: str = "range", n: int | None = None, *ties: str) -> DataFrame:
        """Rows between the smallest key at or above ``lo`` and the largest at or below ``hi``; none if either is missing."""
        first = self._of_parts(F.col("hi") >= F.lit(lo)).filter(F.col(self.key) >= F.lit(lo)).agg(F.min(self.key)).first()[0]
        last = self._of_parts(F.col("lo") <= F.lit(hi)).filter(F.col(self.key) <= F.lit(hi)).agg(F.max(self.key)).first()[0]
        if first is None or last is None:
            return self.rows().filter("false").drop("part")
        return self.search(mode, first, last, n, *ties)

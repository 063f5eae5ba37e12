"""Suggestions from a stored prefix table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.operators.filters import sort_keys, suggest


class SuggestionTable:
    """For every prefix of up to ``longest`` characters, its first ``n`` values, in one of ``buckets`` folders by hash.

    A lookup reads one folder.  What is longer, asks for more, or asks for text within values goes to the values
    themselves, which are stored in order beside the prefixes.
    """

    def __init__(self, spark: SparkSession, path: str, n: int, longest: int = 6, buckets: int = 16, ignore_case: bool = False):
        self.spark, self.path, self.n, self.longest, self.buckets, self.ignore_case = spark, path.rstrip("/"), n, longest, buckets, ignore_case

    def write(self, df: DataFrame, col: str, order: str | None = None) -> SuggestionTable:
        """Store the distinct values of ``col``, ranked by ``order`` (by default themselves)."""
        values = df.select(F.col(col).alias("value"), F.col(order or col).alias("rank")).filter("value IS NOT NULL").distinct()
        values.repartitionByRange("rank", "value").sortWithinPartitions("rank", "value").write.parquet(f"{self.path}/values")
        stored = self.spark.read.parquet(f"{self.path}/values")
        typed = F.lower("value") if self.ignore_case else F.col("value")
        lengths = F.sequence(F.lit(0), F.least(F.length(typed), F.lit(self.longest)))
        prefixes = stored.select("value", "rank", F.explode(F.transform(lengths, lambda k: F.substring(typed, F.lit(1), k))).alias("prefix"))
        # The first rows of a prefix are cut before the shuffle, so the empty prefix is no hot key.
        first = Window.partitionBy("prefix").orderBy(*sort_keys("rank", "value"))
        kept = prefixes.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= self.n)
        dealt = kept.withColumn("bucket", F.pmod(F.xxhash64("prefix"), F.lit(self.buckets)).cast("int"))
        dealt.repartition(self.buckets, "bucket").sortWithinPartitions("prefix", "nth").write.partitionBy("bucket").parquet(f"{self.path}/prefixes")
        return self

    def values(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/values")

    def prefixes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/prefixes")

    def suggest(self, q: str, how: str = "prefix", n: int | None = None) -> DataFrame:
        """``(value, rank)``: the first ``n`` values that start with (or contain) the typed text, in order."""
        n, typed = self.n if n is None else n, q.lower() if self.ignore_case else q
        if how != "prefix" or len(typed) > self.longest or n > self.n:
            return suggest(self.values(), "value", q, how, self.ignore_case, n, "rank")
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(typed)), F.lit(self.buckets)).cast("int")).first()[0]
        hits = self.prefixes().filter((F.col("bucket") == bucket) & (F.col("prefix") == typed) & (F.col("nth") <= n))
        return hits.orderBy("nth").select("value", "rank")

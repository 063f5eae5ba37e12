"""Multi-valued cells of any length: numbered parts of bounded size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.ordering import preceding_total


def cell_parts(df: DataFrame, key: str, value: str, order: Sequence[str], sep: str, most: int = 1 << 20) -> DataFrame:
    """``(key, part, cell)``: the values of a key in order, joined by ``sep`` in parts of about ``most`` bytes.

    Where a value's bytes begin among those of its key is a running total over range partitions, so no task
    holds all values of a key; a part holds the values that begin in it, and parts are joined where the
    cell is written.  A null value is left out.  ``order`` must be total within a key.
    """
    rows = df.filter(F.col(value).isNotNull()).withColumn("_size", (F.octet_length(value) + F.octet_length(F.lit(sep))).cast("bigint"))
    placed = preceding_total(rows, [key], order, "_size", "_before")
    parts = placed.withColumn("part", F.floor(F.col("_before") / most).cast("int"))
    cell = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_before", F.col(value).alias("v")))), lambda x: x["v"]), sep)
    return parts.groupBy(key, "part").agg(cell.alias("cell"))


def joined_parts(parts: DataFrame, key: str, sep: str, out: str = "cell") -> DataFrame:
    """Whole cells of their parts, for keys whose cells are short enough for one row."""
    cell = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "cell"))), lambda x: x["cell"]), sep)
    return parts.groupBy(key).agg(cell.alias(out))

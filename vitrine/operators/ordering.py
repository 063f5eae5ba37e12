"""First rows, ranks, row numbers and running totals that survive hot groups.

First-row operators filter ``row_number() = 1``, which Spark turns into a group
limit before the shuffle: a hot key sends one row per map task.  Full ranks and
running totals never put a group into one task: rows are range-partitioned on
(group, order), added up within each partition, and shifted by the totals of the
earlier partitions.  Only groups that span partitions need a shift, so that
table has at most two rows per partition, and is broadcast for that reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.operators.filters import sort_keys
from vitrine.session import cut_lineage


def distinct_on(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """First row of each key in the given order (names as in ``sort_keys``)."""
    window = Window.partitionBy(*keys).orderBy(*sort_keys(*(order or keys)))
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def latest_by(df: DataFrame, keys: Sequence[str], time: str, *ties: str) -> DataFrame:
    """Row with the greatest time of each key; a null time ranks as the greatest."""
    return distinct_on(df, keys, f"-{time}", *ties)


def first_match(df: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """One ``(key, value)`` per key: the first in order, by default the smallest value."""
    return distinct_on(df.select(key, value, *[o.lstrip("-") for o in order if o.lstrip("-") not in (key, value)]), [key],
                       *(order or (value,)), value).select(key, value)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def preceding_total(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the rows of the same group that come before each row.

    The order must be total within a group.
    """
    group = list(group)
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *sort_keys(*order))
    placed = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))

    within = (
        Window.partitionBy("_part", *group).orderBy(*sort_keys(*order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = placed.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))

    totals = placed.groupBy("_part", *group).agg(F.sum(value).alias("_total"))
    if group:
        spread = totals.groupBy(*group).agg(F.count("*").alias("_parts")).filter("_parts > 1").drop("_parts")
        totals = totals.alias("t").join(spread.alias("s"), _same("t", "s", group), "left_semi")
    earlier = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = totals.withColumn("_shift", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")

    joined = local.alias("l").join(F.broadcast(shift.alias("s")), _same("l", "s", ["_part", *group]), "left")
    total = (F.col("l._local") + F.coalesce(F.col("s._shift"), F.lit(0))).alias(out)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], total)


def sequence_id(df: DataFrame, *order: str, out: str = "seq") -> DataFrame:
    """Number the rows 1..n in a total order, without sorting in one task.

    The rows are shuffled once, by range, and stored with their place in their
    partition; what each partition must add comes from one count per partition.
    """
    keys = sort_keys(*order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the id holds the partition above bit 33 and the row's place in it below
    placed = cut_lineage(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part, at = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    joined = placed.withColumn("_part", part).join(F.broadcast(shift), "_part")
    return joined.select(*df.columns, (F.col("_shift") + at + 1).alias(out))


def rank_in_list(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "rank") -> DataFrame:
    """Rank of each row within its group; equal order values share a rank.

    Equal rows are counted first, so only distinct (group, order) keys are ranked.
    """
    names = [*group, *[o.lstrip("-") for o in order]]
    keys = df.groupBy(*names).agg(F.count("*").alias("_n"))
    ranked = preceding_total(keys, group, order, "_n", "_before").select(*names, (F.col("_before") + 1).alias(out))
    joined = df.alias("d").join(ranked.alias("r"), _same("d", "r", names))
    return joined.select("d.*", F.col(f"r.{out}"))


def cumulative_counts(df: DataFrame, group: str, period: Column, out: str = "cumulative") -> DataFrame:
    """Rows per group and period, and their running total over the periods."""
    counts = df.groupBy(group, period.alias("period")).agg(F.count("*").alias("n"))
    before = preceding_total(counts, [group], ["period"], "n", "_before")
    return before.withColumn(out, F.col("_before") + F.col("n")).drop("_before")

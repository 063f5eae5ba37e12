"""Multi-valued cells, counts, profiles and multisets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import MULTI, collapse_ctrl_ws, genus, refname_display, species
from vitrine.operators.filters import sort_keys

# ---- multi-valued cells ------------------------------------------------------------
#
# A cell is one output value, so its size is the size of one record's list.  Where
# that is too much, keep the long form (id, pos, value) these functions read.


def _cell(value: str, order: Sequence[str], sep: str) -> Column:
    names = ", ".join(f"`{n}`" for n in order)
    return F.expr(f"listagg(`{value}`, '{sep}') WITHIN GROUP (ORDER BY {names})")


def multi_value(df: DataFrame, id: str, values: Mapping[str, Column], order: Sequence[str] = ("pos",), sep: str = MULTI) -> DataFrame:
    """Joined values per id, in list order and then by value; nulls are skipped."""
    named = df.select(id, *[o for o in order if o != id], *[v.alias(out) for out, v in values.items()])
    return named.groupBy(id).agg(*[_cell(out, [*order, out], sep).alias(out) for out in values])


def multi_value_distinct(df: DataFrame, id: str, values: Mapping[str, Column], sep: str = MULTI, keep_empty: bool = True) -> DataFrame:
    """Joined distinct values per id, in value order; an all-null field is null.

    Duplicates go before the shuffle, so a hub's repeated values cost one row each.
    ``keep_empty`` keeps ids whose values are all null.
    """
    if len(values) == 1:
        (out, value), = values.items()
        pairs = df.select(id, value.cast("string").alias(out)).distinct()
        if not keep_empty:
            pairs = pairs.filter(F.col(out).isNotNull())
        return pairs.groupBy(id).agg(_cell(out, [out], sep).alias(out))
    pairs = F.array(*[F.struct(F.lit(out).alias("field"), v.cast("string").alias("value")) for out, v in values.items()])
    long = df.select(id, F.inline(pairs)).distinct()
    if not keep_empty:
        long = long.filter("value IS NOT NULL")
    cells = long.groupBy(id, "field").agg(_cell("value", ["value"], sep).alias("cell"))
    return cells.groupBy(id).agg(*[F.max(F.when(F.col("field") == out, F.col("cell"))).alias(out) for out in values])


def multi_value_then_clean(df: DataFrame, id: str, value: str, out: str, sep: str = MULTI, compat: bool = False, clean: str = "refname") -> DataFrame:
    """Distinct joined values, cleaned.

    Cleaning each value first is the default.  ``compat`` cleans the joined text, as
    the source does: there a greedy pattern keeps only the last refname's display.
    """
    rule = refname_display if clean == "refname" else collapse_ctrl_ws
    if compat:
        cells = multi_value_distinct(df, id, {out: F.col(value)}, sep)
        return cells.withColumn(out, rule(out))
    return multi_value_distinct(df, id, {out: rule(value)}, sep)


# ---- counts ---------------------------------------------------------------------------


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias(out))


def basic_aggs(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("row_count"), F.count(col).alias("value_count"), F.sum(col).alias("total"), F.max(col).alias("greatest")
    )


def share_of_total(df: DataFrame, label: str, values: Sequence[str], exclude: str | None = "None") -> DataFrame:
    """Percent of each column's total, rounded to 3 places; a zero total gives null.

    One label may be left out of both rows and totals.  One pass gives all totals.
    """
    rows = df if exclude is None else df.filter(~F.col(label).eqNullSafe(exclude))
    totals = rows.agg(F.struct(*[F.sum(value).alias(value) for value in values])).scalar()
    return rows.withColumns({f"{v}_pct": F.round(F.col(v) / F.nullif(totals[v] * 0.01, F.lit(0.0)), 3) for v in values})


def holding_summary(df: DataFrame, accession: str, name: str) -> DataFrame:
    """Items, and distinct accessions, names, species and genera.

    Genera and species are functions of the name, so they are counted over the
    distinct names and not over the items.
    """
    names = df.filter(F.col(name).isNotNull()).select(name).distinct()
    per_name = names.agg(
        F.countDistinct(species(name)).alias("species"), F.countDistinct(genus(name)).alias("genera"), F.count("*").alias("names")
    )
    return df.agg(F.count("*").alias("items"), F.countDistinct(accession).alias("accessions")).select(
        "items", "accessions", *[per_name.select(c).scalar().alias(c) for c in ("names", "species", "genera")]
    )


def report_totals(df: DataFrame, locations: str, headings: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("objects"), F.countDistinct(locations).alias("locations"), F.countDistinct(headings).alias("headings")
    )


# ---- profiles ---------------------------------------------------------------------------


def profile_columns(df: DataFrame, sep: str = "|", columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct values and non-blank values of each column, after splitting cells.

    All columns go through one long-form aggregate: (field, value) counts first,
    then per field, so a constant column never meets in one task.
    """
    names = list(columns or df.columns)
    cells = F.array(*[F.struct(F.lit(i + 1).alias("col"), F.lit(n).alias("fieldname"), F.col(n).cast("string").alias("cell")) for i, n in enumerate(names)])
    long = df.select(F.inline(cells)).filter("cell <> ''")
    pieces = long.select("col", "fieldname", F.explode(F.split("cell", "\\Q" + sep + "\\E")).alias("value")).filter("value <> ''")
    counted = pieces.groupBy("col", "fieldname", "value").agg(F.count("*").alias("n"))
    found = counted.groupBy("col", "fieldname").agg(F.count("*").alias("types"), F.sum("n").alias("tokens"))
    every = df.sparkSession.createDataFrame([(i + 1, n) for i, n in enumerate(names)], "col int, fieldname string")
    joined = F.broadcast(every).alias("e").join(found.alias("f"), ["col", "fieldname"], "left")
    return joined.select("col", "fieldname", F.coalesce("types", F.lit(0)).alias("types"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def width_histogram(lines: DataFrame, sep: str = "\t", col: str = "value") -> DataFrame:
    fields = F.size(F.split(F.col(col), "\\Q" + sep + "\\E")).alias("fields")
    return lines.groupBy(fields).agg(F.count("*").alias("n_lines"))


def facet_counts(df: DataFrame, fields: Sequence[str], sep: str = "|") -> DataFrame:
    """Records per value of each facet field, in one long-form aggregate."""
    cells = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("cell")) for f in fields])
    long = df.select(F.inline(cells)).filter("cell <> ''")
    values = long.select("field", F.explode(F.array_distinct(F.split("cell", "\\Q" + sep + "\\E"))).alias("value"))
    return values.filter("value <> ''").groupBy("field", "value").agg(F.count("*").alias("n"))


# ---- multisets ----------------------------------------------------------------------------


def counter(df: DataFrame, col: str) -> DataFrame:
    """``(key, n)``; a null key counts like any other."""
    return df.groupBy(F.col(col).alias("key")).agg(F.count("*").alias("n"))


def most_common(counts: DataFrame, n: int | None = None) -> DataFrame:
    ordered = counts.orderBy(*sort_keys("-n", "key"))
    return ordered if n is None else ordered.limit(n)


def counter_combine(a: DataFrame, b: DataFrame, op: str) -> DataFrame:
    """Multiset ``+ - | &`` of two counters; only positive counts remain."""
    both = a.select("key", F.col("n").alias("_a")).join(
        b.select(F.col("key").alias("_key"), F.col("n").alias("_b")), F.col("key").eqNullSafe(F.col("_key")), "full"
    )
    left, right = F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0))
    n = {"+": left + right, "-": left - right, "|": F.greatest(left, right), "&": F.least(left, right)}[op]
    key = F.when(F.col("_a").isNotNull(), F.col("key")).otherwise(F.col("_key"))
    return both.select(key.alias("key"), n.alias("n")).filter("n > 0")


def counter_elements(counts: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Each key as many times as its count; zero and negative counts give nothing.

    A large count becomes chunks that are spread over the tasks before they are
    unrolled, so no array is longer than ``chunk``.
    """
    positive = counts.filter("n > 0")
    last = F.floor((F.col("n") - 1) / F.lit(chunk))
    chunks = positive.select("key", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_chunk"))
    spread = chunks.repartition("key", "_chunk")
    size = F.least(F.lit(chunk).cast("bigint"), F.col("n") - F.col("_chunk") * chunk)
    return spread.select("key", F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_i")).select("key")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), frames)

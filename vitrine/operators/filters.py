"""Filters, searches, sorts and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import location_key, refname_display


# ---- record state ---------------------------------------------------------------


def not_deleted(df: DataFrame, misc: DataFrame, id: str = "id") -> DataFrame:
    """Rows whose record is known and not deleted; an unknown or null state drops."""
    live = misc.filter(F.col("lifecyclestate") != "deleted").select(F.col("id").alias("_live"))
    return df.join(live, F.col(id) == F.col("_live"), "left_semi")


def both_not_deleted(df: DataFrame, misc: DataFrame, left: str, right: str) -> DataFrame:
    return not_deleted(not_deleted(df, misc, left), misc, right)


def non_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def non_blank(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull() & (F.col(col) != ""))


# ---- order and limit --------------------------------------------------------------


def sort_keys(*names: str) -> list[Column]:
    """``"a"`` ascending with nulls last, ``"-a"`` descending with nulls first."""
    return [F.col(n[1:]).desc_nulls_first() if n.startswith("-") else F.col(n).asc_nulls_last() for n in names]


def order_by(df: DataFrame, *names: str) -> DataFrame:
    return df.orderBy(*sort_keys(*names))


def limit_n(df: DataFrame, n: int | None, *names: str) -> DataFrame:
    """The first ``n`` rows in order; all of them if ``n`` is None."""
    ordered = order_by(df, *names)
    return ordered if n is None else ordered.limit(int(n))


def top_n(df: DataFrame, by: str, n: int, *ties: str) -> DataFrame:
    """The ``n`` largest, equal values in the order of ``ties``."""
    return order_by(df, f"-{by}", *ties).limit(n)


def tail_n(log: DataFrame, time: str, n: int, *ties: str) -> DataFrame:
    """The last ``n`` rows of a log."""
    return order_by(log, f"-{time}", *ties).limit(n)


def reverse_order(df: DataFrame, *names: str) -> DataFrame:
    return order_by(df, *[f"-{n}" for n in names])


def union_distinct(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.distinct()


# ---- key ranges -----------------------------------------------------------------------


def _in_mode(key: Column, mode: str, lo: Column, hi: Column | None) -> Column:
    if mode == "set":
        return key >= lo
    if mode == "exact":
        return key == lo
    if mode == "prefix":
        return F.startswith(key, lo)
    if mode == "range":
        return (key >= lo) & (key <= hi)
    raise ValueError(f"unknown search mode: {mode}")


def key_search(df: DataFrame, name: str, mode: str, lo: str, hi: str = "", n: int | None = None) -> DataFrame:
    """Rows by the key of a location name, in key order; all, or the next ``n``."""
    found = df.withColumn("locationkey", location_key(name)).filter(
        _in_mode(F.col("locationkey"), mode, F.lit(lo.replace(" ", "0")), F.lit(hi.replace(" ", "0")))
    )
    return limit_n(found, n, "locationkey", name)


def object_range(
    df: DataFrame, number: str, key: str, lo: str, hi: str | None = None, mode: str = "range", n: int | None = None
) -> DataFrame:
    """Rows between two known numbers, by sort key.

    Both numbers are looked up exactly; if either is unknown nothing is found.
    The two keys are scalar subqueries, so no range join takes place.
    """
    hi = lo if hi is None else hi
    ends = [df.filter(F.col(number) == end).agg(F.min(key)).scalar() for end in (lo, hi)]
    found = df.filter(_in_mode(F.col(key), mode, ends[0], ends[1]) & ends[1].isNotNull())
    return limit_n(found, n, key, number)


def nearest_bounds(
    df: DataFrame, key: str, lo: str, hi: str, mode: str = "range", n: int | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Rows between the smallest key at or above ``lo`` and the largest at or below ``hi``.

    The two keys are taken from ``known`` when it is given, else from ``df``.
    """
    known = df if known is None else known
    first = known.filter(F.col(key) >= lo).agg(F.min(key)).scalar()
    last = known.filter(F.col(key) <= hi).agg(F.max(key)).scalar()
    found = df.filter(_in_mode(F.col(key), mode, first, last) & last.isNotNull())
    return limit_n(found, n, key)


# ---- membership ---------------------------------------------------------------------


def in_or_all(df: DataFrame, col: str, values: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows whose value is listed; an empty list passes all rows."""
    if values is None:
        return df
    if isinstance(values, DataFrame):
        wanted = values.select(F.col(values.columns[0]).alias("_wanted"))
        return df.join(wanted, F.col(col) == F.col("_wanted"), "left_semi")
    return df.filter(F.col(col).isin(list(values))) if len(values) else df


def under_place(df: DataFrame, col: str, terms: DataFrame | None) -> DataFrame:
    """Rows whose place is among the terms; without terms, every row."""
    return in_or_all(df, col, terms)


def exclude_listed(df: DataFrame, col: str, listed: DataFrame, listed_col: str = "value") -> DataFrame:
    banned = listed.select(F.col(listed_col).alias("_banned"))
    return df.join(banned, F.col(col) == F.col("_banned"), "left_anti")


def exists_check(df: DataFrame, col: str, ref: DataFrame, ref_col: str, out: str = "found") -> DataFrame:
    """Adds whether the value exists in ``ref``; rows are neither dropped nor repeated."""
    known = ref.select(F.col(ref_col).alias("_known")).filter("_known IS NOT NULL").distinct()
    joined = df.join(known, F.col(col) == F.col("_known"), "left")
    return joined.withColumn(out, F.col("_known").isNotNull()).drop("_known")


def term_lookup(
    terms: DataFrame, term: str, authority: DataFrame, refname: str = "refname", missing: str = "term", out: str = "found"
) -> DataFrame:
    """Refname whose quoted display equals each term, ignoring case.

    ``missing`` says what an unknown term gives: the ``term`` itself or ``blank``.
    One refname per display, the smallest, so that the answer does not depend on
    the order of the authority; a blank term gives a blank.
    """
    shown = authority.groupBy(F.lower(refname_display(refname)).alias("_display")).agg(F.min(refname).alias("_refname"))
    joined = terms.join(shown, F.lower(F.col(term)) == F.col("_display"), "left")
    fallback = F.col(term) if missing == "term" else F.lit("")
    value = F.when(F.coalesce(F.col(term), F.lit("")) == "", F.lit("")).otherwise(F.coalesce("_refname", fallback))
    return joined.withColumn(out, value).drop("_display", "_refname")


# ---- report rules -----------------------------------------------------------------------


def alive_dead(
    df: DataFrame, misc: DataFrame, mode: str, rules: str = "beds",
    object_id: str = "id", movement_id: str = "movement_id", reason: str = "reasonformove", version: str = "isversion",
) -> DataFrame:
    """Living or dead rows of a plant list.

    ``beds``: alive is a reason other than Dead, an unversioned movement and
    neither record deleted; dead is reason Dead, a versioned movement and the
    movement not deleted.  ``taxa``: never a versioned movement nor a deleted
    object; alive wants the movement not deleted, dead the reason Dead.
    """
    if mode not in ("alive", "dead") and (mode, rules) != ("dead or alive", "taxa"):
        raise ValueError(f"unknown mode: {mode}")
    versioned = F.col(version).eqNullSafe(True)
    dead = F.col(reason) == "Dead"
    if rules == "beds":
        if mode == "alive":
            return both_not_deleted(df.filter(~versioned & (F.col(reason) != "Dead")), misc, movement_id, object_id)
        return not_deleted(df.filter(versioned & dead), misc, movement_id)
    kept = not_deleted(df.filter(~versioned), misc, object_id)
    if mode == "alive":
        return not_deleted(kept, misc, movement_id)
    if mode == "dead":
        return kept.filter(dead)
    # the distinct union of both lists, read in one pass
    live = misc.filter(F.col("lifecyclestate") != "deleted").select(F.col("id").alias("_live"))
    marked = kept.join(live, F.col(movement_id) == F.col("_live"), "left")
    return marked.filter(F.col("_live").isNotNull() | dead).drop("_live").distinct()


def skip_moved(df: DataFrame, crate: str = "", status: str = "objectstatus", crate_col: str = "crate") -> DataFrame:
    """Without rows marked ``do not move``; with a crate given, only its rows."""
    kept = df.filter(~F.col(status).eqNullSafe("do not move"))
    return kept.filter(F.col(crate_col) == crate) if crate else kept


# Labels that the accession-status chart leaves out.
BLOCKED_LABELS = [
    "not located", "not received", "intended for transfer", "returned loan object", "intended for repatriation",
    "missing in inventory", "red-lined", "on loan (=borrowed)", "pending repatriation", "object mount",
    "irregular Museum number",
]


def blocked_labels(df: DataFrame, col: str, labels: Sequence[str] = (), words: Sequence[str] = ()) -> DataFrame:
    """Without the listed labels and without labels that contain one of the words."""
    c = F.col(col)
    keep = F.lit(True)
    if labels:
        keep = keep & ~F.coalesce(c.isin(list(labels)), F.lit(False))
    for word in words:
        keep = keep & ~F.coalesce(c.contains(word), F.lit(False))
    return df.filter(keep)


# ---- rows of text -------------------------------------------------------------------------


def split_by_width(lines: DataFrame, n: int, sep: str = "\t", col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Lines with ``n`` fields, and the others."""
    fits = F.size(F.split(F.col(col), "\\Q" + sep + "\\E")) == n
    return lines.filter(fits), lines.filter(~F.coalesce(fits, F.lit(False)))


def split_latlong(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a plausible ``lat,long`` (or none), and the others.

    A number is read as far as it goes, so blanks count as zero.
    """

    def number(part: int) -> Column:
        digits = F.regexp_extract(F.split_part(F.col(col), F.lit(","), F.lit(part)), r"^\s*(-?[0-9]*\.?[0-9]*)", 1)
        return F.abs(F.coalesce(digits.try_cast("double"), F.lit(0.0)))

    value = F.coalesce(F.col(col), F.lit(""))
    good = ((number(1) < 90) & (number(2) < 180) & ~value.rlike("[^0-9, .-]")) | value.contains("_p")
    good = F.coalesce(good, F.lit(True))
    return df.filter(good), df.filter(~good)


def suggest(
    df: DataFrame, col: str, q: str, how: str = "prefix", ignore_case: bool = False, n: int | None = None, order: str | None = None
) -> DataFrame:
    """Distinct values that start with (or contain) the typed text, in order; all, or the first ``n``."""
    c, typed = (F.lower(F.col(col)), q.lower()) if ignore_case else (F.col(col), q)
    hit = c.startswith(typed) if how == "prefix" else c.contains(typed)
    wanted = [col] if order is None else [col, order]
    return limit_n(df.filter(hit).select(*wanted).distinct(), n, order or col, col)


def keyword_match(df: DataFrame, col: str, term: str, how: str = "keyword") -> DataFrame:
    """Search in text: a whole word, a phrase, or the whole field.

    Words are runs of letters and digits and are matched without case.
    """
    if how == "exact":
        return df.filter(F.col(col) == term)
    if how == "phrase":
        return df.filter(F.lower(F.col(col)).contains(term.lower()))
    return df.filter(F.lower(F.col(col)).rlike(r"(?:^|\W)\Q" + term.lower() + r"\E(?:\W|$)"))

"""Collection statistics: counts now, and reports over the snapshot table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.labels import metric_name, pretty_label, split_area_category, status_category
from vitrine.operators.aggregates import union_all
from vitrine.operators.filters import BLOCKED_LABELS, blocked_labels, not_deleted, sort_keys
from vitrine.operators.joins import scalar_row, with_csid

# Metric code and its short column name.
METRICS = {
    "totalMusNoCount": "musno",
    "totalObjectCount": "totobj",
    "trueObjectCount": "truobj",
    "totalPieceCount": "totpc",
    "truePieceCount": "trupc",
}
HEADLINE = ["totalMusNoCount", "trueObjectCount", "truePieceCount"]
SERIES_METRIC = {"musNumbers": "totalMusNoCount", "objects": "trueObjectCount", "pieces": "truePieceCount"}


def parent_objects(c) -> DataFrame:
    """Ids of objects that some other object names as its broader record."""
    edges = c.relations.filter("subjectdocumenttype = 'CollectionObject' AND relationshiptype = 'hasBroader'")
    parents = edges.select(F.col("objectcsid").alias("_csid")).distinct()
    ids = with_csid(c.objects.select("id", "objectnumber", "numberofobjects"), c.hierarchy)
    return ids.join(parents, F.col("csid") == F.col("_csid"), "left_semi")


def total_counts(c) -> DataFrame:
    """Five totals in one row: numbers, objects, over-counted objects, pieces, over-counted pieces."""
    live = not_deleted(c.objects.select("id", "numberofobjects"), c.misc)
    numbered = live.join(c.objects_ext.filter("iscomponent = 'no'").select("id"), "id")
    over = not_deleted(parent_objects(c), c.misc).select("objectnumber", "numberofobjects").distinct()
    spark: SparkSession = live.sparkSession
    return scalar_row(
        spark,
        totalmusnocount=numbered.agg(F.count("*")),
        totalobjectcount=live.agg(F.count("*")),
        objectovercount=over.agg(F.count("numberofobjects")),
        totalpiececount=live.agg(F.sum("numberofobjects")),
        pieceovercount=over.agg(F.sum("numberofobjects")),
    )


def grouped_counts(c, group: Column, alias: str, frame: DataFrame | None = None) -> DataFrame:
    """Per group: numbers, objects, objects that are no parent, pieces, pieces of those.

    One conditional aggregate.  ``frame`` may bring object rows that were joined to
    the table the group comes from.
    """
    objects = c.objects if frame is None else frame
    live = not_deleted(objects, c.misc)
    parents = parent_objects(c).select(F.col("objectnumber").alias("_parent")).filter("_parent IS NOT NULL").distinct()
    component = c.objects_ext.select(F.col("id").alias("_eid"), "iscomponent")
    rows = live.join(component, F.col("id") == F.col("_eid"), "left")
    rows = rows.join(parents, F.col("objectnumber") == F.col("_parent"), "left")
    alone = F.col("_parent").isNull() & F.col("objectnumber").isNotNull()

    def none_is_null(count: Column) -> Column:
        return F.nullif(count, F.lit(0).cast("bigint"))

    return rows.groupBy(group.alias(alias)).agg(
        none_is_null(F.count(F.when(F.col("iscomponent") == "no", 1))).alias("totalmusnocount"),
        F.count("*").alias("totalobjectcount"),
        none_is_null(F.count(F.when(alone, 1))).alias("trueobjectcount"),
        F.sum("numberofobjects").alias("totalpiececount"),
        F.sum(F.when(alone, F.col("numberofobjects"))).alias("truepiececount"),
    ).orderBy(*sort_keys("-totalmusnocount", alias))


# ---- snapshots ---------------------------------------------------------------------------


def _latest(stats: DataFrame, source: str, group: str) -> DataFrame:
    """Rows of the latest run day of a statistics group."""
    in_group = stats.filter(F.col("statgroup") == group)
    day = in_group.agg(F.max(F.to_date("isoruntime"))).scalar()
    return in_group.filter((F.col("dbsource") == source) & (F.to_date("isoruntime") >= day))


def latest_stats_wide(stats: DataFrame, source: str, group: str) -> DataFrame:
    """Latest run, one row per label, value and percent of each metric as columns."""
    rows = _latest(stats, source, group).filter(F.col("statmetric").isin(list(METRICS)))
    columns = []
    for code, short in METRICS.items():
        of = F.col("statmetric") == code
        columns.append(F.max(F.when(of, F.col("statvalue"))).alias(f"{short}val"))
        columns.append(F.max(F.when(of, F.col("statpercent"))).alias(f"{short}pct"))
    return rows.groupBy("label").agg(*columns, F.max("isoruntime").alias("isoruntime")).orderBy(*sort_keys("-musnoval", "label"))


def latest_stats_metric(stats: DataFrame, source: str, group: str, metric: str) -> DataFrame:
    rows = _latest(stats, source, group).filter(F.col("statmetric") == metric)
    return rows.select("label", "statvalue", "statpercent", "isoruntime", "statmetric").orderBy(*sort_keys("-statvalue", "label"))


def stat_series(stats: DataFrame, group: str, target: str) -> DataFrame:
    """Time series of one target's metric; an unknown target has none."""
    metric = SERIES_METRIC.get(target)
    rows = stats.filter((F.col("statgroup") == group) & (F.col("stattarget") == target) & (F.col("statmetric") == F.lit(metric)))
    return rows.select("isoruntime", "statvalue", "statmetric", "label").orderBy(*sort_keys("label", "-isoruntime"))


def headline_totals(stats: DataFrame, source: str, group: str = "objByObjType") -> DataFrame:
    wide = latest_stats_wide(stats, source, group)
    return wide.agg(
        F.sum("musnoval").alias("numbers"), F.sum("truobjval").alias("objects"), F.sum("trupcval").alias("pieces"),
        F.max("isoruntime").alias("isoruntime"),
    )


def stats_chart(stats: DataFrame, source: str, group: str, kind: str = "single") -> DataFrame:
    """Chart rows of the three headline metrics of the latest run.

    ``content`` adds discipline and continent, ``status`` a category and leaves out
    the labels that do not belong in a collection count; ``bar`` uses brief labels
    with the full one as a tooltip and leaves out the label None.
    """
    rows = _latest(stats, source, group).filter(F.col("statmetric").isin(HEADLINE))
    rows = rows.select("label", F.col("statvalue").alias("value"), metric_name("statmetric").alias("metric"))
    if kind == "content":
        rows = blocked_labels(rows, "label", words=["Continent unknown"])
        rows = rows.withColumn("_area", split_area_category("label"))
        shown = pretty_label(rows, "label", "terse", out="shown")
        return shown.select(F.col("shown").alias("label"), "value", F.col("_area.discipline").alias("category"), F.col("_area.continent").alias("continent"), "metric")
    if kind == "status":
        rows = status_category(blocked_labels(rows, "label", labels=BLOCKED_LABELS), "label")
        shown = pretty_label(rows, "label", "terse", out="shown")
        return shown.select(F.col("shown").alias("label"), "value", "category", "metric")
    if kind == "bar":
        shown = pretty_label(blocked_labels(rows, "label", labels=["None"]), "label", "brief", out="shown")
        return shown.select(F.col("shown").alias("label"), "value", F.col("label").alias("tooltip"), "metric")
    return pretty_label(rows, "label", "terse").select("label", "value", "metric")


def stats_table(stats: DataFrame, source: str, group: str, recompute: bool = False) -> DataFrame:
    """Latest wide statistics with pretty labels and percents of 3 places.

    ``recompute`` takes the percents from the column totals without the label None.
    """
    wide = latest_stats_wide(stats, source, group)
    shown = ["musno", "truobj", "trupc"]
    if recompute:
        from vitrine.operators.aggregates import share_of_total

        rows = share_of_total(wide, "label", [f"{s}val" for s in shown])
        percents = [F.col(f"{s}val_pct").alias(f"{s}pct") for s in shown]
    else:
        rows = wide
        percents = [F.round(f"{s}pct", 3).alias(f"{s}pct") for s in shown]
    rows = rows.select("label", *[f"{s}val" for s in shown], *percents, "isoruntime")
    return pretty_label(rows, "label", "pretty")


def stats_time(stats: DataFrame, group: str, targets: Sequence[str] = tuple(SERIES_METRIC)) -> DataFrame:
    """Date, count, metric and category rows of all targets."""
    rows = union_all([stat_series(stats, group, target) for target in targets])
    rows = blocked_labels(rows, "label", labels=["\x01"])
    rows = pretty_label(rows, "label", "terse", out="category")
    return rows.select(
        F.to_date("isoruntime").alias("day"), F.col("statvalue").alias("value"), metric_name("statmetric").alias("metric"), "category"
    )

"""Cells of the public rows: one deal by id, one pass over the hierarchy for dimensions, links dealt by csid only."""

import pytest
from pyspark.sql import functions as F

from vitrine.catalog.fixtures import collection
from vitrine.functions.text import MULTI
from vitrine.plans import extract as ex
from vitrine.plans.links import resolve_links

VALUES = "id string, field string, pos int, tie string, value string"


@pytest.fixture
def tables(spark):
    return collection(spark, "/root/testdata/sf0.001")


def test_cells_by_kind(spark, rows):
    values = spark.createDataFrame([
        ("1", "title_ss", 1, None, "b"), ("1", "title_ss", 0, None, "c"), ("1", "title_ss", 1, None, "b"), ("1", "title_ss", None, None, "n"),
        ("1", "condition_ss", None, "2", "a"), ("1", "condition_ss", None, "1", "z"),
        ("1", "borrower_ss", None, None, "y"), ("1", "borrower_ss", None, None, "x"), ("1", "borrower_ss", None, None, "y"),
        ("1", "dimensions_ss", 0, "cm", "lo"), ("1", "dimensions_ss", 0, "in", "hi"), ("1", "dimensions_ss", 0, None, "none"),
        ("2", "othernumber_s", 0, None, "7"), ("2", "othernumber_s", 0, None, "9"), ("2", "borrower_ss", None, None, ""),
    ], VALUES)
    assert rows(ex._cells(values)) == sorted([
        ("1", "title_ss", MULTI.join("ncbb")), ("1", "condition_ss", f"z{MULTI}a"), ("1", "borrower_ss", f"x{MULTI}y"),
        ("1", "dimensions_ss", MULTI.join(["none", "hi", "lo"])), ("2", "othernumber_s", "9"), ("2", "borrower_ss", ""),
    ], key=str)


def test_cells_are_dealt_by_id_once(spark):
    values, base = spark.createDataFrame([], VALUES), spark.createDataFrame([], "id string, n string")
    wide = ex.wide_rows(base, ex._cells(values), ["title_ss"], "\t", lambda field, value: value)
    plan = wide.hint("shuffle_hash")._jdf.queryExecution().executedPlan().toString()
    own = plan.split("ObjectHashAggregate")[-1]
    assert plan.count("REPARTITION_BY_COL") == 1 and own.count("Exchange") == 1


def test_dimensions_read_the_hierarchy_once(tables):
    plan = ex.dimensions(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("'dimensionSubGroup'") + plan.count("measuredPartGroup:dimensionSubGroupList") <= 1 and plan.count("Union") <= 4


def test_links_agree_with_stored_ones(tables, rows):
    stored = tables.with_tables(edges=resolve_links(tables.relations, tables.hierarchy))
    assert rows(ex.object_links(tables)) == rows(ex.object_links(stored))


def test_a_link_needs_both_records(spark, rows):
    from vitrine.plans.model import Collection

    hierarchy = spark.createDataFrame([("1", "c1"), ("2", "c2"), ("m", "cm")], "id string, name string")
    relations = spark.createDataFrame([("c1", "c2", "O"), ("c1", "cm", "M"), ("cm", "c9", "O"), ("cm", "cm", "M")], "subjectcsid string, objectcsid string, objectdocumenttype string")
    c = Collection.of(objects=hierarchy.filter("id <> 'm'").select("id"), hierarchy=hierarchy, relations=relations)
    assert rows(ex.object_links(c)) == [("1", "2", "subject", "O"), ("1", "m", "subject", "M"), ("2", "1", "object", "O")]


def test_condition_order_has_dates_before_1970(spark, rows):
    at = F.coalesce(F.lpad((F.unix_micros(F.col("t").cast("timestamp")) + F.lit(1 << 62)).cast("string"), 20, "0"), F.lit(""))
    times = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '1890-01-01 00:00:00'), (TIMESTAMP_NTZ '2020-01-01 00:00:00'), (CAST(NULL AS TIMESTAMP_NTZ)) v(t)")
    assert [r.t.year if r.t else None for r in times.orderBy(at).collect()] == [None, 1890, 2020]

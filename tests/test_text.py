import datetime

import pytest
from pyspark.sql import functions as F

from vitrine.functions import labels as lab
from vitrine.functions import text as tx


@pytest.fixture
def apply(spark):
    def run(fn, *values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]

    return run


def test_refname_display(apply):
    values = ["urn:x:name(p):item:name(a1)'Ann'", "plain", "u:name(a)'Two\nLine'", "a)'One'␥b)'Two'", None, "", "urn:n(a)'Foo (bar)'s'", "x)'Ann'\n"]
    assert apply(tx.refname_display, *values) == ["Ann", "plain", "Two\nLine", "Two", None, "", "s", "x)'Ann'\n"]


def test_refname_display_first(apply):
    values = ["urn:n(a)'Foo (bar)'s'", "plain", "", None, "a)'Ünï'"]
    assert apply(tx.refname_display_first, *values) == ["Foo (bar)'s", "lai", None, None, "Ünï"]


def test_urn_display(apply):
    assert apply(tx.urn_display, "urn:x)'Move' kept", "x)'Move'", None) == ["Move kept", "x)'Move'", None]


def test_cleaning(apply):
    assert apply(tx.collapse_ctrl_ws, "a\t\r\nb\n", None) == ["a b ", None]
    assert apply(tx.scrub_newlines, "a\r\nb", "") == ["a  b", ""]
    assert apply(tx.strip_field_quotes, '"a""b"', "c\\d\r", '"', "") == ['a"b', "c/d", "", ""]
    assert apply(lambda c: tx.strip_field_quotes(c, first=True), '"a"') == ['"a']
    assert apply(lambda c: tx.strip_field_quotes(c, last=True), '"a"') == ['a"']
    assert apply(lambda c: tx.strip_field_quotes(c, pairs=False), 'a""b') == ['a""b']
    assert apply(tx.escape_backslash, "a\\b") == ["a\\\\b"]
    assert apply(tx.split_multi, "a|b||c", "", None) == [["a", "b", "", "c"], [], []]
    assert apply(tx.slug, "North Hall, 2A, W B") == ["north_hall_2a_w_b"]
    assert apply(tx.tree_label, '@x "y"', "z") == ["<x 'y'> ", "z"]
    assert apply(tx.null_if_blank, "", None, "a") == [None, None, "a"]


def test_dates(apply):
    late = datetime.datetime(2020, 1, 1, 20, 0, 0)
    assert apply(tx.local_date, late, None, kind="timestamp_ntz") == ["2020-01-02", None]
    assert apply(tx.plain_date, late, kind="timestamp_ntz") == ["2020-01-01"]
    assert apply(tx.local_day, late, kind="timestamp_ntz") == [datetime.date(2020, 1, 2)]
    assert apply(tx.iso_date, "2020-01-01", "") == ["2020-01-01T00:00:00Z", ""]
    assert apply(tx.iso_datetime, "2020-01-01 10:11:12", "") == ["2020-01-01T10:11:12Z", "Z"]
    parsed = apply(tx.parse_date, "07/22/2013 15:54", "7/2/2013 5:04", "13/01/2013 10:00", "02/30/2013 10:00", "07/22/13 15:54", "x", None)
    assert parsed == [datetime.datetime(2013, 7, 22, 15, 54), datetime.datetime(2013, 7, 2, 5, 4), None, None, None, None, None]
    assert [tuple(x) for x in apply(tx.series_date, "2014-03-09T01:02:03")] == [(2014, 2, 9)]


def test_numbers(spark, apply):
    one = spark.range(1).select(
        tx.sortable_number(F.lit(2010), F.lit(54), F.lit(1)).alias("key"), tx.object_number(F.lit(2010), F.lit(54), F.lit(1)).alias("shown")).head()
    assert tuple(one) == ("0000002010.0000000054.0000000001", "2010.54.1")
    assert apply(tx.valid_count, "12", "-1", "1a", "", None) == ["12", None, None, None, None]
    assert [None if v is None else float(v) for v in apply(tx.numeric_sort, "59.1168", "x", "1990")] == [59.1168, None, 1990.0]


def test_places(spark):
    df = spark.createDataFrame([("Bay 1", None), ("Bay 1", "k)'C 2'"), (None, "k)'C 2'")], "l string, c string")
    assert [tuple(r) for r in df.select(tx.storage_location("l", "c"), tx.storage_key("l", "c")).collect()] == [
        ("Bay 1", "Bay01:0"), ("Bay 1: C 2", "Bay01:0C02"), (": C 2", ":0C02")]
    df = spark.createDataFrame([("p)'Rome'", "r"), ("", "r"), (None, "r"), (None, None)], "p string, r string")
    assert [r[0] for r in df.select(tx.locality_text("p", "r")).collect()] == ["Rome", None, "Geographic range: r", None]


def test_names(apply):
    assert apply(tx.genus, "Aloe vera ex X") == ["Aloe"]
    assert apply(tx.species, "Aloe vera ex X var. y", "Aloe vera var. y ex z", "Aloe vera") == ["Aloe vera", "Aloe vera", "Aloe vera"]


def test_labels(spark):
    df = spark.createDataFrame([("Cat. 10 - Philippine Islands",), ("8.1 Foods",), ("Human Remains",), ("other",)], "label string")
    for style in ("pretty", "terse", "brief"):
        df = lab.pretty_label(df, "label", style, out=style)
    got = {r["label"]: (r["pretty"], r["terse"], r["brief"]) for r in df.collect()}
    assert got["Cat. 10 - Philippine Islands"] == ("Cat. 10: Philippine Islands", "Cat. 10: Philippine Islands", "Cat. 10")
    assert got["8.1 Foods"] == ("8.1 Foods", "8.1 Foods", "8.1")
    assert got["Human Remains"][2] == "HSR" and got["other"] == ("other",) * 3


def test_brief_labels_are_codes():
    brief = lab.label_table("brief")
    assert brief["Cat.  1: California (archaeology and ethnology)"] == "Cat. 1"
    assert brief["Cat. B - Barr collection"] == "Cat. B"
    assert "6.2 Toys, Children's Utensils, Objects used in the Education of Children" not in brief
    assert len(lab.label_table("terse")) == len(lab.CATALOG_LABELS) + len(lab.USE_LABELS)

from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine.operators import aggregates as ag


def bag(spark, text):
    return ag.counter(spark.createDataFrame([(ch,) for ch in text], "c string"), "c")


def as_dict(df):
    return {r["key"]: r["n"] for r in df.collect()}


def test_most_common(spark):
    assert [tuple(r) for r in ag.most_common(bag(spark, "abracadabra"), 3).collect()] == [("a", 5), ("b", 2), ("r", 2)]


@pytest.mark.parametrize("a,b,op,expected", [
    ("abbb", "bcc", "+", {"b": 4, "c": 2, "a": 1}), ("abbbc", "bccd", "-", {"b": 2, "a": 1}),
    ("abbb", "bcc", "|", {"b": 3, "c": 2, "a": 1}), ("abbb", "bcc", "&", {"b": 1}),
])
def test_combine(spark, a, b, op, expected):
    assert as_dict(ag.counter_combine(bag(spark, a), bag(spark, b), op)) == expected


def test_combine_null_key(spark):
    a = spark.createDataFrame([(None, 2), ("x", 1)], "key string, n long")
    assert as_dict(ag.counter_combine(a, a, "+")) == {None: 4, "x": 2}


def test_elements(spark):
    counts = spark.createDataFrame([("a", 7), ("b", 0), ("c", -2), ("d", 3)], "key string, n long")
    got = Counter(r["key"] for r in ag.counter_elements(counts, chunk=3).collect())
    assert got == {"a": 7, "d": 3}


def test_multi_value(spark):
    df = spark.createDataFrame([("1", 1, "b"), ("1", 0, "z"), ("1", 2, None), ("2", 0, None)], "id string, pos int, v string")
    got = {r["id"]: r["x"] for r in ag.multi_value(df, "id", {"x": F.col("v")}).collect()}
    assert got == {"1": "z␥b", "2": None}


def test_multi_value_distinct(spark):
    df = spark.createDataFrame([("1", "b", "q"), ("1", "a", "q"), ("1", "b", None), ("2", None, None)], "id string, v string, w string")
    got = {r["id"]: (r["v"], r["w"]) for r in ag.multi_value_distinct(df, "id", {"v": F.col("v"), "w": F.col("w")}).collect()}
    assert got == {"1": ("a␥b", "q"), "2": (None, None)}


def test_clean_before_and_after(spark):
    df = spark.createDataFrame([("1", "a)'One'"), ("1", "b)'Two'")], "id string, v string")
    assert ag.multi_value_then_clean(df, "id", "v", "x").head()["x"] == "One␥Two"
    assert ag.multi_value_then_clean(df, "id", "v", "x", compat=True).head()["x"] == "Two"


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("None", 100.0)], "l string, v double")
    assert {r["l"]: r["v_pct"] for r in ag.share_of_total(df, "l", ["v"]).collect()} == {"a": 25.0, "b": 75.0}
    zero = spark.createDataFrame([("a", 0.0)], "l string, v double")
    assert ag.share_of_total(zero, "l", ["v"]).head()["v_pct"] is None


def test_profile_and_widths(spark, rows):
    df = spark.createDataFrame([("a|b", ""), ("b||c", None)], "m string, e string")
    assert rows(ag.profile_columns(df)) == [(1, "m", 3, 4), (2, "e", 0, 0)]
    lines = spark.createDataFrame([("a\tb",), ("c\t",), ("d",)], "value string")
    assert rows(ag.width_histogram(lines)) == [(1, 1), (2, 2)]


def test_holdings(spark):
    df = spark.createDataFrame([("1", "Aloe vera ex X"), ("2", "Aloe vera"), ("2", "Rosa alba var. b"), ("3", None)], "a string, n string")
    assert tuple(ag.holding_summary(df, "a", "n").head()) == (4, 3, 3, 2, 2)

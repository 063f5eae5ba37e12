import pytest
from pyspark.sql import functions as F

from vitrine.operators import filters as fl
from vitrine.operators import joins as jn


@pytest.fixture
def places(spark):
    return spark.createDataFrame([("A 1",), ("A 2",), ("A 10",), ("B 1",)], "name string")


def test_not_deleted(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    misc = spark.createDataFrame([("a", "project"), ("b", "deleted"), ("c", None)], "id string, lifecyclestate string")
    assert rows(fl.not_deleted(df, misc)) == [("a",)]


@pytest.mark.parametrize("mode,lo,hi,n,expected", [
    ("set", "A 10", "", 2, ["A 10", "A 2"]), ("exact", "A 2", "", 9, ["A 2"]), ("prefix", "A", "", 9, ["A 1", "A 10", "A 2"]),
    ("range", "A 10", "B 1", 9, ["A 10", "A 2", "B 1"]), ("set", "A", "", 0, []), ("set", "A", "", None, ["A 1", "A 10", "A 2", "B 1"]),
])
def test_key_search(places, mode, lo, hi, n, expected):
    assert [r["name"] for r in fl.key_search(places, "name", mode, lo, hi, n).collect()] == expected


def test_object_range(spark):
    df = spark.createDataFrame([("1.1", "01.01"), ("1.2", "01.02"), ("1.10", "01.10")], "number string, key string")
    keys = lambda *a, **k: [r["key"] for r in fl.object_range(df, "number", "key", *a, **k).collect()]
    assert keys("1.1", "1.10") == ["01.01", "01.02", "01.10"]
    assert keys("1.2") == ["01.02"]
    assert keys("1.1", "9.9") == [] and keys("9.9", "1.1") == []
    assert keys("1.2", mode="set") == ["01.02", "01.10"]


def test_nearest_bounds(spark):
    df = spark.createDataFrame([("02",), ("05",), ("09",)], "key string")
    keys = lambda lo, hi: [r["key"] for r in fl.nearest_bounds(df, "key", lo, hi).collect()]
    assert keys("03", "08") == ["05"] and keys("00", "99") == ["02", "05", "09"]
    assert keys("10", "99") == [] and keys("06", "08") == []


def test_lists(spark, rows, places):
    assert len(rows(fl.in_or_all(places, "name", []))) == 4
    assert rows(fl.in_or_all(places, "name", ["B 1"])) == [("B 1",)]
    assert rows(fl.exclude_listed(places, "name", spark.createDataFrame([("A 1",), ("A 2",)], "value string"))) == [("A 10",), ("B 1",)]
    known = spark.createDataFrame([("A 1",), ("A 1",), (None,)], "x string")
    assert rows(fl.exists_check(places, "name", known, "x")) == [("A 1", True), ("A 10", False), ("A 2", False), ("B 1", False)]


def test_term_lookup(spark):
    terms = spark.createDataFrame([("rome",), ("100%",), ("",), (None,)], "term string")
    authority = spark.createDataFrame([("u:b)'Rome'",), ("u:a)'ROME'",), ("u:c)'1000'",)], "refname string")
    got = {r["term"]: r["found"] for r in fl.term_lookup(terms, "term", authority).collect()}
    assert got == {"rome": "u:a)'ROME'", "100%": "100%", "": "", None: ""}
    assert {r["term"]: r["found"] for r in fl.term_lookup(terms, "term", authority, missing="blank").collect()}["100%"] == ""


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert [r[0] for r in fl.order_by(df, "v").collect()] == [1, 2, None]
    assert [r[0] for r in fl.order_by(df, "-v").collect()] == [None, 2, 1]


def test_split_latlong(spark, rows):
    df = spark.createDataFrame([("12.5, -100.2",), ("95,10",), ("10,181",), ("N 10,5",), ("",), (None,), ("x_p",)], "v string")
    good, bad = fl.split_latlong(df, "v")
    assert rows(bad) == [("10,181",), ("95,10",), ("N 10,5",)]
    assert good.count() + bad.count() == df.count()


def test_split_by_width(spark):
    df = spark.createDataFrame([("a\tb",), ("a",), ("\t",), (None,)], "value string")
    good, bad = fl.split_by_width(df, 2)
    assert good.count() == 2 and bad.count() == 2


def test_keyword_match(spark, rows):
    df = spark.createDataFrame([("A canoe, red",), ("canoes",), ("CANOE",)], "t string")
    assert rows(fl.keyword_match(df, "t", "canoe")) == [("A canoe, red",), ("CANOE",)]
    assert rows(fl.keyword_match(df, "t", "canoe, r", "phrase")) == [("A canoe, red",)]
    assert rows(fl.keyword_match(df, "t", "canoes", "exact")) == [("canoes",)]
    assert rows(fl.keyword_match(df, "t", "c.noe")) == []


def test_suggest(places):
    got = fl.suggest(places.union(places), "name", "a", ignore_case=True, n=2).collect()
    assert [r[0] for r in got] == ["A 1", "A 10"]


@pytest.mark.parametrize("listed,expected", [(["a", None], []), ([], ["a", "b", None]), (["a"], ["b"])])
def test_anti_not_in(spark, listed, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    ref = spark.createDataFrame([(x,) for x in listed], "r string")
    assert sorted([r[0] for r in jn.anti_not_in(df, "v", ref, "r").collect()], key=str) == sorted(expected, key=str)


def test_alive_dead(spark, rows):
    df = spark.createDataFrame([
        ("o1", "m1", "Kept", False), ("o2", "m2", "Dead", True), ("o3", "m3", "Dead", None), ("o4", "m4", None, False), ("o5", "m1", "Kept", False)],
        "id string, movement_id string, reasonformove string, isversion boolean")
    misc = spark.createDataFrame([(x, "deleted" if x in ("o5", "m3") else "ok") for x in "o1 o2 o3 o4 o5 m1 m2 m3 m4".split()], "id string, lifecyclestate string")
    ids = lambda mode, rules: [r[0] for r in rows(fl.alive_dead(df, misc, mode, rules).select("id"))]
    assert ids("alive", "beds") == ["o1"] and ids("dead", "beds") == ["o2"]
    assert ids("alive", "taxa") == ["o1", "o4"] and ids("dead", "taxa") == ["o3"]
    assert ids("dead or alive", "taxa") == ["o1", "o3", "o4"]
    with pytest.raises(ValueError):
        fl.alive_dead(df, misc, "dead or alive", "beds")


def test_skip_and_block(spark, rows):
    df = spark.createDataFrame([("moved", "C1"), ("do not move", "C1"), (None, "C2")], "objectstatus string, crate string")
    assert len(rows(fl.skip_moved(df))) == 2 and rows(fl.skip_moved(df, "C1")) == [("moved", "C1")]
    labels = spark.createDataFrame([("missing in inventory",), ("x",), (None,)], "l string")
    assert len(rows(fl.blocked_labels(labels, "l", fl.BLOCKED_LABELS))) == 2

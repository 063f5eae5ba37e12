import itertools

import pytest
from pyspark.sql import functions as F

from vitrine.plans import changes as ch
from vitrine.plans.model import Collection


@pytest.mark.parametrize("items,value,rule,expected", [
    (["a", "b"], "c", "prefer", ["c", "a", "b"]), (["a", "b"], "b", "prefer", ["b", "a"]), (["a", "b"], "a", "prefer", ["a", "b"]),
    ([""], "c", "prefer", ["c"]), ([None], "c", "prefer", ["c"]), ([], "c", "prefer", ["c"]), (None, "c", "prefer", ["c"]), ([None, "c"], "c", "prefer", ["c", None]),
    (["a", "b"], "b", "date", ["a", "b"]), (["a"], "b", "date", ["b", "a"]), ([""], "b", "date", ["b", ""]),
    (["a"], None, "prefer", ["a"]), (None, None, "date", []), (["a", None], None, "insert", ["a", None]),
    (["a", "b"], "b", "insert", ["b", "a", "b"]), (["b", "a"], "b", "insert", ["b", "a"]),
])
def test_prefer_value(spark, items, value, rule, expected):
    df = spark.createDataFrame([(items, value)], "items array<string>, v string")
    assert df.select(ch.prefer_value("items", "v", rule).alias("x")).head()["x"] == expected


def test_bulk_edit(spark, rows):
    records = spark.createDataFrame([("1", ["a"], 5, ("d", "e")), ("2", ["b"], 6, ("f", "g")), ("3", ["c"], 7, ("h", "i"))], "id string, l array<string>, n int, t struct<display:string,early:string>")
    changes = spark.createDataFrame([("1", "z", "9", "now"), ("1", "b", "1", "then"), ("2", "", None, "")], "id string, l string, n string, t string")
    got = {r["id"]: (r["l"], r["n"], tuple(r["t"]), r["edited"]) for r in ch.bulk_edit(records, changes, "id", {"l": "prefer", "n": "replace", "t": "clear"}).collect()}
    assert got == {"1": (["z", "a"], 9, ("now", ""), True), "2": (["b"], 6, ("f", "g"), False), "3": (["c"], 7, ("h", "i"), False)}


def test_unresolved_terms_are_reported(spark):
    changes = spark.createDataFrame([("1", "rome", "12"), ("2", "nowhere", "x1"), ("3", "", "")], "id string, place string, n string")
    places = spark.createDataFrame([("u)'Rome'",)], "refname string")
    got = {r["id"]: (r["place"], r["n"], r["message"]) for r in ch.check_count(ch.resolve_terms(changes, {"place": places}), "n").collect()}
    assert got["1"] == ("u)'Rome'", "12", "") and got["3"][0] == ""
    assert got["2"] == ("", None, 'place: unknown term "nowhere" not a count: "x1"')


def test_create_numbers_against_brute_force(spark):
    known = {(2010, 54, n) for n in (3, 99, 100, 101, 350)} | {(2010, 5, 7)}
    key = lambda y, a, s: f"{y:010d}.{a:010d}.{s:010d}"
    keys = spark.createDataFrame([(key(*k),) for k in known] + [("0000002010.0000000054.0000000500.a",)], "sortableobjectnumber string")
    asked = [(i, 2010, a, s, n) for i, (a, s, n) in enumerate(itertools.product((5, 54), (1, 4, 98, 102, 340, 499), (0, 1, 2, 100, 101)))]
    created, refused = ch.create_numbers(spark.createDataFrame(asked, "request_id int, year int, accession int, sequence int, n int"), keys)
    made, no = {}, {r["request_id"] for r in refused.collect()}
    for r in created.collect():
        made.setdefault(r["request_id"], set()).add(r["sortableobjectnumber"])
    everything = sorted([key(*k) for k in known] + ["0000002010.0000000054.0000000500.a"])
    for i, y, a, s, n in asked:
        ok = 1 <= n <= 100 and not any(key(y, a, s) <= k <= key(y, a, s + n - 1) for k in everything)
        assert (i not in no) == ok
        assert made.get(i, set()) == ({key(y, a, s + j) for j in range(n)} if ok else set())


def test_create_numbers_checks_the_whole_of_a_long_range(spark):
    known = spark.createDataFrame([("0000002010.0000000005.0000000250",)], "sortableobjectnumber string")
    asked = spark.createDataFrame([(1, 2010, 5, 1, 400), (2, 2010, 5, 251, 400)], "request_id int, year int, accession int, sequence int, n int")
    created, refused = ch.create_numbers(asked, known, limit=500)
    assert [r["request_id"] for r in refused.collect()] == [1] and created.count() == 400


@pytest.fixture
def shop(spark):
    objects = [("o1", "8-4216"), ("o2", "8-4217"), ("o3", "9-1")]
    return Collection.of(
        objects=spark.createDataFrame(objects, "id string, objectnumber string"),
        objects_ext=spark.createDataFrame([("o1", "u)'Box 7'"), ("o2", "u)'Box 7'"), ("o3", None)], "id string, computedcrate string"),
        locations=spark.createDataFrame([("l1", "u)'North Hall, 2A, AA  1,  1'")], "id string, refname string"),
        misc=spark.createDataFrame([("o1", "x"), ("o2", "x"), ("o3", "deleted"), ("l1", "x")], "id string, lifecyclestate string"),
        hierarchy=spark.createDataFrame([("o1", "c1"), ("o2", "c2"), ("o3", "c3")], "id string, name string"))


HANDLERS = [("A1234567", "urn:p)'Ann'")]
GOOD = [
    '"C","A1234567","07/22/2013 15:54","8-4216","Box 7","North Hall, 2A, AA  1,  1"', '"M","A1234567","8-4216","North Hall, 2A, AA  1,  1","07/22/2013 15:54"  ',
    '"R","A1234567","07/11/2013 17:29","Box 7","North Hall, 2A, AA  1,  1"', '"R","A1234567","07/11/2013 17:29","Box 7","North Hall, 2A, AA  1,  1"', "no scan",
]
BAD = {
    '"X","A1234567"': "unknown move code", '"M","B9","8-4216","North Hall, 2A, AA  1,  1","07/22/2013 15:54"': "unknown handler",
    '"M","A1234567","9-1","North Hall, 2A, AA  1,  1","07/22/2013 15:54"': "unknown object",
    '"M","A1234567","8-4216","Attic","07/22/2013 15:54"': "unknown location", '"M","A1234567","8-4216","North Hall, 2A, AA  1,  1","22/07/2013"': "bad date",
    '"R","A1234567","07/11/2013 17:29","Box 9","North Hall, 2A, AA  1,  1"': "unknown crate", '"C","A1234567"': "bad date",
}


def test_scanner_upload(spark, shop):
    handlers = spark.createDataFrame(HANDLERS, "handler string, handlerrefname string")
    lines = lambda xs: spark.createDataFrame([(x,) for x in xs], "value string")
    checked = ch.check_scans(shop, lines(GOOD), handlers)
    assert checked.count() == 3 and checked.filter("error IS NOT NULL").count() == 0
    moves = sorted((r["code"], r["objectcsid"], r["crate"], r["locationrefname"], r["summary"]) for r in ch.scanner_moves(shop, checked, "urn:r)'Inventory'").collect())
    place = "u)'North Hall, 2A, AA  1,  1'"
    assert moves == [("C", "c1", "Box 7", place, "2013-07-22 (Inventory)"), ("M", "c1", "", place, "2013-07-22 (Inventory)"),
                     ("R", "c1", "Box 7", place, "2013-07-11 (Inventory)"), ("R", "c2", "Box 7", place, "2013-07-11 (Inventory)")]
    mixed = ch.check_scans(shop, lines([*GOOD, *BAD]), handlers)
    assert {r["line"]: r["error"] for r in mixed.filter("error IS NOT NULL").collect()} == BAD
    assert ch.scanner_moves(shop, mixed, "x").count() == 0


def test_a_bad_file_keeps_no_other_from_moving(spark, shop, tmp_path):
    from vitrine.sources.readers import read_scanner_drop

    handlers = spark.createDataFrame(HANDLERS, "handler string, handlerrefname string")
    (tmp_path / "a.txt").write_text("\n".join(GOOD))
    (tmp_path / "b.txt").write_text("\n".join([GOOD[1], *BAD]))
    (tmp_path / "c.txt").write_text("\n".join(GOOD[1:2] + GOOD[2:3] + [GOOD[2] + " "]))
    checked = ch.check_scans(shop, read_scanner_drop(spark, str(tmp_path)), handlers)
    verdicts = {r["file"][-5:]: (r["lines"], r["errors"], r["accepted"]) for r in ch.file_verdicts(checked).collect()}
    assert verdicts == {"a.txt": (3, 0, True), "b.txt": (1 + len(BAD), len(BAD), False), "c.txt": (2, 0, True)}
    moves = sorted((r["file"][-5:], r["code"], r["objectcsid"]) for r in ch.scanner_moves(shop, checked, "x").collect())
    assert moves == [("a.txt", "C", "c1"), ("a.txt", "M", "c1"), ("a.txt", "R", "c1"), ("a.txt", "R", "c2"), ("c.txt", "M", "c1"), ("c.txt", "R", "c1"), ("c.txt", "R", "c2")]


@pytest.mark.parametrize("app,expected", [
    ("powermove", {"c1": ("to", "C9", "object now at T"), "c2": ("old", "C1", "kept in place"), "c3": ("lost", "", "marked as lost")}),
    ("movecrate", {"c1": ("to", "C1", "crate now at T"), "c2": ("to", "C1", "crate now at T"), "c3": ("lost", "", "marked as lost")}),
    ("inventory", {"c1": ("old", "C1", "place confirmed"), "c2": ("old", "C1", "place confirmed"), "c3": ("lost", "", "marked as lost")}),
])
def test_moves(spark, app, expected):
    rows = spark.createDataFrame([("c1", "1", "moved"), ("c2", "2", "do not move"), ("c3", "3", "not found")], "objectcsid string, objectnumber string, objectstatus string")
    rows = rows.selectExpr("*", "'old' AS locationrefname", "'C1' AS crate")
    moves = ch.move_records(rows, app, "to", "T", "urn:x)'Why'", "2024-01-02 03:04:05", "lost", "C9")
    assert {r["objectcsid"]: (r["tolocation"], r["tocrate"], r["message"]) for r in moves.collect()} == expected
    n = sum(m != "kept in place" for *_, m in expected.values())
    assert tuple(ch.move_counts(moves).head()) == (n, 3) and ch.movement_edges(moves).count() == 2 * n
    assert {r["referencenumber"] for r in moves.collect()} == {f"LOC2024-01-02-03-04-{i}" for i in (1, 2, 3)}


def test_check_locations(spark):
    df = spark.createDataFrame([("A 1",), ("A01",), ("B",)], "v string")
    terms = spark.createDataFrame([("A 1",)], "termdisplayname string")
    assert {r["v"]: r["verified"] for r in ch.check_locations(df, "v", terms).collect()} == {"A 1": "A 1", "A01": "", "B": None}

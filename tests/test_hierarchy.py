import pytest

from vitrine.operators import hierarchy as hi

PAIRS = [
    ("San Francisco", "California"), ("California", "United States"), ("North America", None), ("Africa", None), ("New York", "United States"),
    ("United States", "North America"), ("Angola", "Africa"), ("Eastern Cape", "South Africa"), ("South Africa", "Africa"), ("Rapa Nui", None),
]


def edges_of(spark, pairs):
    return spark.createDataFrame([(c, p, f"k-{c}", p and f"k-{p}") for c, p in pairs], "child string, parent string, child_key string, parent_key string")


@pytest.fixture(scope="module")
def edges(spark):
    return edges_of(spark, PAIRS)


def test_paths_of_the_worked_example(edges):
    got = {r["label"]: (r["path"], r["depth"], r["is_leaf"]) for r in hi.tree_paths(edges).collect()}
    assert len(got) == len(PAIRS)
    assert got["San Francisco"] == ("ROOT > North America > United States > California > San Francisco", 4, True)
    assert got["Rapa Nui"] == ("ROOT > Rapa Nui", 1, True) and got["Africa"][2] is False


def test_child_lists(edges):
    lists = {}
    for r in sorted(hi.child_lists(edges).collect(), key=lambda r: r["pos"]):
        lists.setdefault(r["parent_key"], []).append(r["label"])
    assert lists["ROOT"] == ["Africa", "North America", "no parent >> Rapa Nui"]
    assert lists["k-United States"] == ["California", "New York"] and lists["k-Africa"] == ["Angola", "South Africa"]


def test_descendants(edges, rows):
    assert rows(hi.descendants(edges, "Africa")) == [("Africa", 0), ("Angola", 1), ("Eastern Cape", 2), ("South Africa", 1)]
    assert rows(hi.descendants(edges, "Angola")) == [("Angola", 1)]
    assert rows(hi.descendants(edges, "nowhere")) == [("nowhere", 0)]
    assert rows(hi.place_descendants(edges, "California")) == [("California", 0), ("San Francisco", 0)]
    assert rows(hi.descendants(edges, "North America", max_depth=1)) == [("North America", 0), ("United States", 1)]


def test_ancestors_and_children(edges, rows):
    got = [(r["term"], r["level"]) for r in hi.ancestors(edges, "k-San Francisco").collect()]
    assert got == [("North America", -3), ("United States", -2), ("California", -1), ("San Francisco", 0)]
    assert [r["term"] for r in hi.children(edges, "Africa").orderBy("term").collect()] == ["Angola", "South Africa"]


def test_closure_agrees_with_descendants(edges):
    up = {(r["key"], r["ancestor"]) for r in hi.closure(edges).collect()}
    below = {"k-" + r["term"] for r in hi.descendants(edges, "Africa").collect()}
    assert {k for k, a in up if a == "Africa"} == below


def test_cycle_ends(spark):
    loop = edges_of(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")])
    assert {r["term"]: r["level"] for r in hi.descendants(loop, "a").collect()} == {"c": 1, "d": 1, "b": 2, "a": 3}
    assert len(hi.closure(loop).collect()) == 3 * 3 + 4
    assert hi.tree_paths(loop).collect() == []


def test_deep_chain_has_no_level_cap_of_its_own(spark):
    chain = edges_of(spark, [("n0", None)] + [(f"n{i}", f"n{i - 1}") for i in range(1, 25)])
    assert max(-r["level"] for r in hi.ancestors(chain, "k-n24").collect()) == 24
    assert max(r["level"] for r in hi.descendants(chain, "n0").collect()) == 24
    assert max(r["level"] for r in hi.descendants(chain, "n0", max_depth=20).collect()) == 20


def test_paths_end_on_a_cycle_below_a_root(spark):
    looped = edges_of(spark, [("r", None), ("a", "r"), ("b", "a"), ("a", "b")])
    assert sorted((r["label"], r["depth"]) for r in hi.tree_paths(looped).collect()) == [("a", 2), ("b", 3), ("r", 1)]


def test_headings(spark, edges):
    got = {r["term"]: r["heading"] for r in hi.headings(edges).collect()}
    assert got["California"] == "North America :: United States :: California"
    assert got["Rapa Nui"] == "No parent :: Rapa Nui"
    df = spark.createDataFrame([("x)'Angola'",), (None,), ("x)'Atlantis'",)], "ref string")
    authority = spark.createDataFrame([("i1", "x)'Angola'")], "id string, refname string")
    names = spark.createDataFrame([("i1", "k-Angola")], "id string, name string")
    out = {r["ref"]: (r["heading"], r["sort_last"]) for r in hi.culture_heading(df, "ref", authority, names, edges).collect()}
    assert out == {"x)'Angola'": ("Africa :: Angola", False), None: ("No cultural group specified", True), "x)'Atlantis'": ("No parent :: Atlantis", True)}

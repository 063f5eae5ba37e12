import random

import pytest

from vitrine.operators import hierarchy as hi
from vitrine.operators import intervals as iv


def edges_of(spark, pairs):
    return spark.createDataFrame([(c, p, f"k-{c}", p and f"k-{p}") for c, p in pairs], "child string, parent string, child_key string, parent_key string")


def forest(seed, nodes=40, more=0, loops=0):
    rng = random.Random(seed)
    pairs = [("n0", None)] + [(f"n{i}", f"n{rng.randrange(max(0, i - 9), i)}" if rng.random() < 0.9 else None) for i in range(1, nodes)]
    for _ in range(more):
        child = rng.randrange(1, nodes)
        pairs.append((f"n{child}", f"n{rng.randrange(child)}"))
    for _ in range(loops):
        child = rng.randrange(nodes)
        pairs.append((f"n{child}", f"n{rng.randrange(child, nodes)}"))
    return pairs


def under(pairs, top):
    """Smallest distance of every node below ``top``, by plain walking; 0 for itself."""
    out, level, step = {top: 0}, [top], 0
    while level:
        step += 1
        level = sorted({c for c, p in pairs if p in level} - out.keys())
        out.update(dict.fromkeys(level, step))
    return out


@pytest.mark.parametrize("seed, more, loops", [(1, 0, 0), (2, 6, 0), (3, 3, 3), (4, 0, 5)])
def test_below_is_what_a_walk_finds(spark, seed, more, loops):
    pairs = forest(seed, more=more, loops=loops)
    tree = iv.intervals(edges_of(spark, pairs))
    assert (tree.more.count() == 0) == (more + loops == 0)
    asked = [f"n{i}" for i in range(0, 40, 3)]
    got = {}
    for r in iv.below(tree, spark.createDataFrame([(f"k-{n}",) for n in [*asked, *asked, "nobody"]], "k string")).collect():
        assert (r["asked"], r["term"]) not in got
        got[r["asked"], r["term"]] = r["level"]
    assert got == {(f"k-{n}", t): d for n in asked for t, d in under(pairs, n).items()}


@pytest.mark.parametrize("seed, more, loops", [(5, 0, 0), (6, 5, 2)])
def test_descendants_are_those_of_the_walk(spark, rows, seed, more, loops):
    edges = edges_of(spark, forest(seed, 25, more, loops))
    tree = iv.intervals(edges)
    for term in ("n0", "n3", "n24", "nobody"):
        assert rows(iv.descendants(tree, term)) == rows(hi.descendants(edges, term))
    assert rows(iv.descendants(tree, "n0", max_depth=2)) == rows(hi.descendants(edges, "n0", max_depth=2))
    assert rows(iv.place_descendants(tree, "n1")) == rows(hi.place_descendants(edges, "n1"))


def test_cycles_roots_and_own_parents(spark, rows):
    edges = edges_of(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", None), ("f", "f"), ("g", "f")])
    tree = iv.intervals(edges)
    for term in "abcdefg":
        assert rows(iv.descendants(tree, term)) == rows(hi.descendants(edges, term))


def test_labels_nest(spark):
    tree = iv.intervals(edges_of(spark, forest(8, 60)))
    spans = sorted((r["enter"], r["leave"]) for r in tree.nodes.collect())
    assert [a for a, _ in spans] == list(range(60))
    for a, b in spans:
        assert all(not (a < x <= b < y) for x, y in spans)


def test_a_tree_is_answered_without_rounds(spark, monkeypatch):
    """Below a term of a forest: one plan, no stored step."""
    tree = iv.intervals(edges_of(spark, forest(9)))
    monkeypatch.setattr(iv, "cut_lineage", lambda *a: pytest.fail("a round was stored"))
    plan = iv.below(tree, spark.createDataFrame([("k-n0",)], "k string"))
    assert plan.count() > 1


def test_no_edges(spark):
    tree = iv.intervals(edges_of(spark, [("a", None)]).filter("false"))
    assert tree.nodes.collect() == [] and [tuple(r) for r in iv.descendants(tree, "x").collect()] == [("x", 0)]

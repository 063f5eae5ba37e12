"""Reports read the rows of the hierarchy and the links that they need, and no others."""

import pytest

from vitrine.catalog import filters as catalog_filters, reports as catalog_reports
from vitrine.catalog.fixtures import collection
from vitrine.catalog.registry import QUERIES
from vitrine.plans import changes as ch
from vitrine.plans import extract as ex
from vitrine.plans import links as lk
from vitrine.plans import reports as rp

SF = "/root/testdata/sf0.001"
#: A list that the query does not name.
OTHER = "dimensionSubGroupList"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def tables(spark):
    QUERIES or __import__("vitrine.catalog").catalog.all_queries()
    return collection(spark, SF)


@pytest.fixture
def stored(monkeypatch):
    """Frames that a plan would store, by label; they are not written."""
    seen = []
    keep = lambda df, label="step", keep=False: seen.append((label, df)) or df
    for module in (rp, catalog_filters, ex):
        monkeypatch.setattr(module, "cut_lineage", keep)
    return seen


def test_moves_take_their_version_from_records(spark, tables, stored):
    QUERIES["c09_alive_dead"](spark, SF)
    (moves,) = [df for label, df in stored if label == "moves"]
    assert "Aggregate" not in plan(moves)  # the rows of lists are aggregates of line items


def test_member_names_come_with_their_list(tables, stored):
    assert OTHER not in plan(rp.object_list(tables, "0000002000", "0000002010"))


@pytest.fixture
def no_resolving(monkeypatch):
    def never(*_):
        raise AssertionError("all links are resolved")

    for module in (rp, lk):
        monkeypatch.setattr(module, "links_of", never)


def test_located_objects_resolve_their_own_links(tables, no_resolving):
    assert rp.located_objects(tables).columns
    assert rp.located_objects(tables, movement="object").columns
    assert ch.group_rows(tables, "1-URGENT 24").columns == ["id"]


def test_located_objects_agree_with_stored_links(tables, rows):
    links = tables.with_tables(edges=lk.resolve_links(tables.relations, tables.hierarchy))
    for movement in ("subject", "object"):
        one, other = (rp.located_objects(c, movement=movement) for c in (tables, links))
        columns = sorted(one.columns)
        assert columns == sorted(other.columns)
        assert rows(one.select(columns)) == rows(other.select(columns))


def test_review_rows_are_stored_before_their_headings(tables, stored):
    from vitrine.catalog.reports import place_edges

    rp.packing_list_by_culture(tables, "Bay 0", "Bay 5", place_edges(tables))
    assert "packing" in [label for label, _ in stored]


def test_both_lists_of_taxa_read_the_movements_once(spark, tables):
    lines = plan(QUERIES["r24_all_taxa"](spark, SF)).splitlines()
    assert sum("AS movement_id#" in line and "urn:x:location" in line for line in lines) == 1


def test_lists_of_taxa_are_those_of_their_modes(tables, rows):
    from pyspark.sql import functions as F

    p = catalog_reports._plants(tables)
    p = p.with_tables(movements=p.movements.union(p.movements))  # so rows repeat
    dead, both = (rp.all_taxa(p, mode).select(F.lit(name).alias("mode"), "*") for mode, name in (("dead", "dead"), ("dead or alive", "both")))
    found = rows(rp.taxa_lists(p))
    assert found == rows(dead.unionByName(both))
    assert len(found) > len(set(found))
    with pytest.raises(ValueError):
        rp.all_taxa(p, "all")

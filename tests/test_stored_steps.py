"""Plans over many lists: which rows of the hierarchy they make, and what they store on the way."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vitrine.catalog import all_queries
from vitrine.catalog.fixtures import collection, with_stored_members
from vitrine.operators.joins import group_values, media_rows
from vitrine.plans import extract as ex
from vitrine.plans.links import resolve_links

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def tables(spark):
    return collection(spark, SF)


def test_suggestions_make_the_rows_of_their_own_lists_only(spark):
    text = plan(all_queries()["c15_suggest"](spark, SF))
    assert "concat(pt," in text and "concat(lt," in text and "concat(tq-," not in text


def test_a_stored_step_leaves_no_shuffle_files(spark):
    from vitrine.session import REMOVE_SHUFFLES, cut_lineage

    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, shuffles = spark.conf.get(REMOVE_SHUFFLES), tracker.shuffleStatuses().size()
    assert cut_lineage(df).count() == 7
    kept = tracker.shuffleStatuses().size() - shuffles
    assert kept <= 1 and spark.conf.get(REMOVE_SHUFFLES) == before  # the count's own at most
    assert df.count() == df.count() == 7


@pytest.fixture
def stored(monkeypatch):
    """Frames that the extract stores, by label; they are not written."""
    seen = {}
    monkeypatch.setattr(ex, "cut_lineage", lambda df, label="step", keep=False: seen.setdefault(label, df), raising=False)
    return seen


def test_sources_of_the_public_cells_are_stored_one_by_one(tables, stored):
    ex.public_wide(with_stored_members(tables))
    assert list(stored) == ["groups", "items", "singles", "dates", "sizes", "given", "subject", "object"]
    assert "Aggregate" not in plan(stored["dates"]).split("RepartitionByExpression")[1]  # the members are stored and not grouped again


def test_related_cells_agree_with_stored_links(tables, rows, stored):
    linked = tables.with_tables(edges=resolve_links(tables.relations, tables.hierarchy))
    for side in ("subject", "object"):
        one, other = (ex._related_cells(c, ex._given(c), side).join(c.objects.select("id"), "id", "left_semi") for c in (tables, linked))
        found = rows(one.select("id", "field", "value"))
        assert found == rows(other.select("id", "field", "value")) and found


def test_few_media_meet_the_links_without_a_deal(tables):
    text = media_rows(tables)._jdf.queryExecution().executedPlan().toString()
    links = next(line for line in text.splitlines() if "mediacsid" in line and "Join" in line)
    assert "BroadcastHashJoin" in links


@pytest.mark.parametrize("name, made_by", [("k01_public_extract", "public_extract"), ("k01_public_errors", "public_errors"), ("k02_internal_extract", "internal_extract")])
def test_wide_queries_read_the_stored_members(spark, monkeypatch, name, made_by):
    seen = []
    monkeypatch.setattr(ex, made_by, seen.append)
    all_queries()[name](spark, SF)
    assert "Aggregate" not in plan(seen[0].hierarchy)


def test_values_of_a_member_stay_in_one_row_until_it_is_found(spark, rows):
    hierarchy = spark.createDataFrame([("m1", "o1", "x:a", 0), ("m2", "o1", "x:a", 1)], "id string, parentid string, name string, pos int")
    table = spark.createDataFrame([("m1", "v", None), ("m2", "w", "n"), ("m9", "z", "z")], "id string, v string, n string")
    long = group_values(hierarchy, {"v_s": ("a", table, F.col("v")), "n_s": ("a", table, F.col("n"))}, pos=None)
    assert rows(long) == sorted([("o1", "v_s", 0, "v"), ("o1", "n_s", 0, None), ("o1", "v_s", 1, "w"), ("o1", "n_s", 1, "n")], key=str)
    lines = long._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert next(i for i, x in enumerate(lines) if "Generate" in x) < next(i for i, x in enumerate(lines) if "Join" in x)


def test_nightly_drops_the_steps_of_the_wide_rows_once_these_are_written(spark, tmp_path, monkeypatch):
    from vitrine.plans import nightly as ng
    from vitrine.plans.model import Collection
    from vitrine.session import cut_lineage

    steps = []

    def wide(c):
        made = cut_lineage(spark.createDataFrame([("1", "a", False), ("2", "b", True)], "id string, csid_s string, broken boolean"))
        steps.append(Path(made.inputFiles()[0].removeprefix("file://")))
        return made

    def blobs(c):
        assert not steps[0].exists()
        return spark.createDataFrame([("a", "b-1")], "objectcsid string, blobcsid string")

    monkeypatch.setattr(ng, "public_wide", wide)
    monkeypatch.setattr(ng, "blob_lists", blobs)
    made = ng.nightly(Collection.of(objects=spark.range(1)), str(tmp_path), "one")
    assert (made.rows, made.good, made.broken, made.with_blobs, made.unmatched_blobs) == (2, 1, 1, 1, 0)
    assert made.load(spark).count() == 1

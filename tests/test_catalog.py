"""The registry itself, and a few queries end to end beside their SQL text."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vitrine.catalog import all_oracles, all_queries
from vitrine.catalog.fixtures import GIVEN, VIEWS, collection, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(all_oracles()) == set(all_queries())
    assert set(all_queries()) <= set(entry.queries())


def test_every_sql_text_binds(duck):
    for name, sql in entry.oracle_sql().items():
        assert duck.execute(f"DESCRIBE {sql}").fetchall(), name


@pytest.mark.parametrize("view", ["objects", "objects_ext", "scan_lines", "manifest", "collectionstats"])
def test_views_agree(spark, duck, view):
    ours = sorted(str(tuple(r)) for r in collection(spark, SF)[view].collect())
    theirs = sorted(str(r) for r in duck.execute(oracle(f"SELECT * FROM {{{view}}}")).fetchall())
    assert view in VIEWS and ours == theirs


@pytest.mark.parametrize("name", ["c10_term_lookup", "d16_anti_not_in", "e09_grouped_counts", "f01_rank_in_list", "h08_culture_heading", "k11_create_numbers", "r04_group_titles", "r27_packing_list"])
def test_query_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    ours = sorted(str(tuple(r[n] for n in sorted(names))) for r in df.collect())
    theirs = sorted(str(tuple(dict(zip(names, r))[n] for n in sorted(names))) for r in result.fetchall())
    assert ours == theirs


def test_no_query_plans_a_cross_join(spark):
    for name in ("e08_total_counts", "e13_share_of_total", "c05_object_range", "c06_nearest_bounds", "e10_latest_stats_wide", "d17_scalar_cross"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "id"


def test_hierarchy_by_list_is_that_of_its_text(spark, duck):
    ours = collection(spark, SF)["hierarchy"]
    theirs = duck.execute(oracle("SELECT id, parentid, name, pos, primarytype, isversion FROM {hierarchy}")).fetchall()
    assert sorted(str(tuple(r)[:6]) for r in ours.collect()) == sorted(map(str, theirs))


def test_a_list_of_the_hierarchy_makes_no_other(spark):
    def lists(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")

    from vitrine.operators.joins import members, records

    h = collection(spark, SF)["hierarchy"]
    assert lists(members(h, "titleGroupList")) == 1
    assert lists(members(h, primarytype="lenderGroup")) == 1 and lists(members(h, primarytype="structuredDateGroup")) == 4
    assert lists(records(h)) == 0 and "l_partkey" not in records(h)._jdf.queryExecution().optimizedPlan().toString()
    places = h.filter("startswith(primarytype, 'Place')")._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" in places and not any(n in places for n in ("l_partkey", "o_orderkey", "p_partkey", "doc_id"))


def test_small_files_of_large_tables_are_not_broadcast(spark, tmp_path):
    from vitrine.session import tune

    path = str(tmp_path / "t")
    tune(spark).range(400_000).selectExpr("concat('urn:x:place:name(place):item:name(c', id, ')') AS name").coalesce(1).write.parquet(path)
    rows = spark.read.parquet(path)
    plan = rows.join(rows.withColumnRenamed("name", "other"), rows["name"] == F.col("other"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan

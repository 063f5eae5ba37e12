import pytest
from pyspark.sql import functions as F

from vitrine.operators import joins as jn


@pytest.fixture
def base(spark):
    return spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, n string")


def test_stitch_keeps_the_base(spark, base, rows):
    one = spark.createDataFrame([("1", "x"), ("9", "lost")], "id string, x string")
    two = spark.createDataFrame([("2", 5)], "id string, y int")
    assert rows(jn.stitch(base, [one, two])) == [("1", "a", "x", ""), ("2", "b", "", "5"), ("3", "c", "", "")]
    counts = jn.match_counts(base, one).head().asDict()
    assert counts == {"frame_rows": 2, "matched": 1, "unmatched": 1, "base_rows": 3}


def test_stitch_takes_the_last_duplicate(spark, rows):
    base = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "id string, n string, at int")
    assert rows(jn.stitch(base, [], arrival="at")) == [("1", "new", 2)]
    assert rows(jn.duplicate_keys(base)) == [("1", 2)]


def test_merge_list(spark, base, rows):
    many = spark.createDataFrame([("1", "b2"), ("1", "b1"), ("9", "b9")], "oid string, b string")
    assert rows(jn.merge_list(base, many, "id", "b", "blobs", many_key="oid")) == [("1", "a", "b1,b2"), ("2", "b", ""), ("3", "c", "")]


@pytest.fixture
def hierarchy(spark):
    return spark.createDataFrame([
        ("1", None, "csid-1", None, "Object"), ("2", None, "csid-2", None, "Object"),
        ("g1", "1", "t:nameList", 0, "nameGroup"), ("g2", "1", "t:nameList", 1, "nameGroup"), ("g3", "2", "t:nameList", None, "nameGroup"), ("g4", "1", "t:otherList", 0, "otherGroup"),
    ], "id string, parentid string, name string, pos int, primarytype string")


def test_first_of_group(spark, base, hierarchy, rows):
    group = spark.createDataFrame([("g1", "Ann"), ("g2", "Bob"), ("g3", "Cy"), ("g4", "Di")], "id string, v string")
    ids = base.select("id")
    assert rows(jn.first_of_group(ids, hierarchy, group, ["v"], list_name="nameList")) == [("1", "Ann"), ("2", None), ("3", None)]
    assert rows(jn.first_of_group(ids, hierarchy, group, ["v"], primarytype="nameGroup", or_null=True)) == [("1", "Ann"), ("2", "Cy"), ("3", None)]
    assert rows(jn.nth_of_group(ids, hierarchy, group, {"v": "w"}, 1, list_name="nameList")) == [("1", "Bob"), ("2", None), ("3", None)]
    long = jn.group_values(hierarchy, {"a": ("nameList", group, F.col("v")), "b": ("otherList", group, F.col("v"))})
    assert rows(jn.pivot_fields(long, ["a", "b"])) == [("1", "Ann", "Di")]


def test_related_both_ways(spark, base, hierarchy, rows):
    edges = spark.createDataFrame([("csid-1", "A", "csid-2", "B"), ("csid-1", "A", "csid-9", "B")], "subjectcsid string, subjectdocumenttype string, objectcsid string, objectdocumenttype string")
    ids = base.select("id")
    assert rows(jn.related(ids, edges, hierarchy, "other", "B")) == [("1", "2")]
    assert rows(jn.related(ids, edges, hierarchy, "other", direction="object")) == [("2", "1")]
    assert rows(jn.related(ids, edges, hierarchy, "other", "C")) == []


def test_two_way_edges(spark, rows):
    df = spark.createDataFrame([("m", "o")], "m string, o string")
    assert rows(jn.two_way_edges(df, "m", "Media", "o", "Obj")) == [("m", "Media", "o", "Obj", "affects"), ("o", "Obj", "m", "Media", "affects")]


def test_scalar_row_has_no_cross_join(spark, base):
    row = jn.scalar_row(spark, n=base.agg(F.count("*")), top=base.agg(F.max("n")))
    assert tuple(row.head()) == (3, "c")
    assert "Cartesian" not in row._jdf.queryExecution().executedPlan().toString()


def test_hot_key_join_is_split(spark):
    """A hub with a third of the edges does not end up in one join task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        # one fat task per map, so that a partition has several map outputs to split at
        edges = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hub")).otherwise(F.concat(F.lit("p"), F.col("id"))).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        dims = spark.range(0, 60000, 1, 8).select(F.concat(F.lit("p"), F.col("id")).alias("k"), F.lit(1).alias("one")).union(spark.sql("SELECT 'hub', 1"))
        joined = edges.join(dims, "k")
        assert joined.agg(F.count("*")).head()[0] == 60000
        out = joined.select("k", "x", "one")
        out.write.format("noop").mode("overwrite").save()
        rows = out.collect()
        assert len(rows) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_resolved_links_give_what_csids_give(spark, base, hierarchy, rows):
    from vitrine.plans.links import linked, resolve_links, store_links
    from vitrine.plans.model import Collection

    edges = spark.createDataFrame(
        [("csid-1", "A", "csid-2", "B"), ("csid-1", "A", "csid-9", "B"), ("csid-2", "B", "csid-1", "A"), ("csid-1", "A", "csid-2", "B")],
        "subjectcsid string, subjectdocumenttype string, objectcsid string, objectdocumenttype string").withColumn("relationshiptype", F.lit("affects"))
    ids = base.select("id")
    stored = store_links(Collection.of(relations=edges, hierarchy=hierarchy))
    for links in (resolve_links(edges, hierarchy), stored):
        for kind in (None, "A", "B", "C"):
            for way in ("subject", "object"):
                assert rows(linked(ids, links, "other", kind, way)) == rows(jn.related(ids, edges, hierarchy, "other", kind, way))
    assert any("objectdocumenttype=B" in f for f in stored.inputFiles())


def test_cell_maps_take_the_greatest_of_a_repeated_field(spark):
    long = spark.createDataFrame([("1", "a", "x"), ("1", "a", "y"), ("1", "b", None), ("2", "b", "z")], "id string, field string, value string")
    assert {r["id"]: r["cells"] for r in jn.cell_maps(long).collect()} == {"1": {"a": "y", "b": None}, "2": {"b": "z"}}


def test_stitch_takes_one_row_of_a_repeated_key(spark, rows):
    base = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    frame = spark.createDataFrame([("1", "x", 1), ("1", "y", None), ("1", "x", 2)], "id string, w string, n int")
    assert rows(jn.stitch(base, [frame])) == [("1", "a", "y", ""), ("2", "b", "", "")]

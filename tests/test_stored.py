"""Tables that are stored to be read often: versions, latest rows, key order, prefixes, long cells."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vitrine.operators.cells import cell_parts, joined_parts
from vitrine.operators.filters import key_search, nearest_bounds, suggest
from vitrine.operators.latest import LatestRows
from vitrine.operators.layout import KeyedTable
from vitrine.operators.ordering import latest_by
from vitrine.operators.suggestions import SuggestionTable
from vitrine.sources.versions import PublishedTable


def files(df):
    return set(df.inputFiles())


@pytest.fixture
def published(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"), "id", 8)
    table.publish(spark.range(200).select("id", F.lit("old").alias("v")))
    return table


def test_versions(published, spark, rows):
    assert published.versions() == [1] and published.read().count() == 200
    assert published.publish(spark.createDataFrame([(1, "new")], "id long, v string")) == 2
    assert rows(published.read()) == [(1, "new")] and published.read(1).count() == 200
    assert published.go_back(1) == 3 and published.read().count() == 200
    assert published.publish(spark.createDataFrame([], "id long, v string")) == 4 and published.read().collect() == []
    with pytest.raises(ValueError):
        published.read(9)
    with pytest.raises(ValueError):
        PublishedTable(spark, published.path + "-none", "id").read()


def test_a_failed_load_leaves_the_old_version(published, spark):
    @F.udf("string")
    def breaks(x):
        raise RuntimeError("half-way")

    with pytest.raises(Exception):
        published.publish(spark.range(50).select("id", breaks("id").alias("v")))
    with pytest.raises(Exception):
        published.edit(spark.createDataFrame([(3,)], "id long"), lambda df: df.withColumn("v", breaks("v")))
    assert published.versions() == [1] and published.read().filter("v = 'old'").count() == 200


def test_an_edit_rewrites_its_buckets_only(published, spark, rows):
    before = files(published.read())
    keys = spark.createDataFrame([(3,), (3,), (4,)], "id long")
    assert published.edit(keys, lambda df: df.withColumn("v", F.when(F.col("id").isin(3, 4), "edited").otherwise(F.col("v")))) == 2
    after = files(published.read())
    assert rows(published.read().filter("v = 'edited'")) == [(3, "edited"), (4, "edited")] and published.read().count() == 200
    assert len(before & after) >= len(before) - 2 and len(before - after) in (1, 2)
    assert files(published.find([3])) < after and rows(published.find([3, 999])) == [(3, "edited")]
    assert published.edit(keys.limit(0), lambda df: df) == 2


def test_an_edit_may_empty_buckets_and_not_stray(published, spark):
    keys = published.read().select("id")
    published.edit(keys, lambda df: df.filter("id = 5"))
    assert published.read().count() == 1
    published.edit(keys, lambda df: df.filter("false"))
    assert published.read().collect() == []
    published.publish(spark.range(20).select("id", F.lit("x").alias("v")))
    with pytest.raises(ValueError):
        published.edit(spark.createDataFrame([(1,)], "id long"), lambda df: df.withColumn("id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(99).cast("long")))))


def test_null_keys_are_kept(spark, tmp_path, rows):
    table = PublishedTable(spark, str(tmp_path / "t"), "id", 4)
    table.publish(spark.createDataFrame([(None, 1), (None, 1), ("a", 2)], "id string, n int"))
    assert rows(table.read()) == [("a", 2), (None, 1), (None, 1)]


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_latest_rows_after_any_split(spark, tmp_path, rows, batches):
    rng = random.Random(batches)
    moves = [(f"o{rng.randrange(30)}", rng.choice([None, *range(20)]), f"m{i}") for i in range(300)]
    schema = "object string, at int, move string"
    state = LatestRows(spark, str(tmp_path / "s"), "object", "at", ["move"], 4)
    for k in range(batches):
        state.merge(spark.createDataFrame(moves[k::batches], schema))
    state.merge(spark.createDataFrame(moves[:40], schema))  # once more
    assert rows(state.read()) == rows(latest_by(spark.createDataFrame(moves, schema), ["object"], "at", "move"))


@pytest.fixture(scope="module")
def keyed(spark, tmp_path_factory):
    rows = spark.range(3000).select(F.format_string("k%05d", F.col("id") * 3 % 2001).alias("key"), F.col("id"))
    return rows, KeyedTable(spark, str(tmp_path_factory.mktemp("layout") / "t"), "key").write(rows, 8)


@pytest.mark.parametrize("mode, lo, hi, n", [("range", "k00100", "k00300", None), ("range", "k01000", "k01000", None), ("set", "k01900", None, None), ("set", "k00500", None, 7), ("set", "k01995", None, 500),
                                             ("exact", "k00501", None, None), ("exact", "x", None, None), ("prefix", "k011", None, None), ("prefix", "", None, None), ("set", "a", None, 3), ("range", "z", "a", None)])
def test_keyed_table_finds_what_a_scan_finds(keyed, mode, lo, hi, n):
    rows, table = keyed
    want = key_search(rows.withColumnRenamed("key", "name"), "name", mode, lo, hi or "", None).orderBy("name", "id").collect()
    got = table.search(mode, lo, hi, n, "id").collect()
    assert [(r["key"], r["id"]) for r in got] == [(r["name"], r["id"]) for r in want][:n]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_table_reads_few_parts(keyed):
    _, table = keyed
    every = table.ends().count()
    plan = plan_of(table.search("range", "k00100", "k00200"))
    (chosen,) = set(re.findall(r"PartitionFilters: \[(.*?)\], ", plan))
    assert "part#" in chosen and len(re.findall(r"\b\d+\b", chosen.split("part#", 1)[1])) - 1 < every
    assert "GreaterThanOrEqual(key,k00100)" in plan and "LessThanOrEqual(key,k00200)" in plan
    assert "part#" in plan_of(table.search("set", "k00500", None, 5)).split("PartitionFilters: [", 1)[1][:40]


def test_keyed_table_nearest(keyed):
    rows, table = keyed
    for lo, hi in (("k00101", "k00111"), ("a", "k00010"), ("k01990", "z"), ("z", "z"), ("a", "a")):
        assert [r["id"] for r in table.nearest(lo, hi, "range", None, "id").collect()] == [r["id"] for r in nearest_bounds(rows, "key", lo, hi).orderBy("key", "id").collect()]


@pytest.mark.parametrize("ignore_case", [True, False])
def test_suggestions_are_those_of_a_scan(spark, tmp_path, ignore_case):
    rng = random.Random(1)
    words = ["".join(rng.choice("aAbBé ") for _ in range(rng.randint(0, 7))) for _ in range(400)] + [None]
    df = spark.createDataFrame([(w,) for w in words], "term string")
    table = SuggestionTable(spark, str(tmp_path / "s"), 5, 3, 4, ignore_case).write(df, "term")
    for q in ["", "a", "A", "ab", "aB ", "é", "zz", "aaaa", "bab", *[w[:2] for w in words[:5]]]:
        for how, n in (("prefix", None), ("prefix", 2), ("prefix", 9), ("infix", 4)):
            got = [r["value"] for r in table.suggest(q, how, n).collect()]
            assert got == [r["term"] for r in suggest(df.filter("term IS NOT NULL"), "term", q, how, ignore_case, n or 5).collect()], (q, how, n)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = ", plan_of(table.suggest("ab")))


def test_cell_parts(spark, rows):
    long = spark.range(20_000).select(F.when(F.col("id") < 19_000, "hub").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"), "id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    long = long.union(spark.createDataFrame([("none", 1, None)], "key string, id long, v string"))
    parts = cell_parts(long, "key", "v", ["id"], "|", most=4096).cache()
    assert parts.agg(F.max(F.length("cell"))).first()[0] <= 4096 + 10 and parts.filter("key = 'hub'").count() > 20
    want = long.groupBy("key").agg(F.expr("listagg(v, '|') WITHIN GROUP (ORDER BY id)").alias("cell")).filter("cell IS NOT NULL")
    assert rows(joined_parts(parts, "key", "|")) == rows(want)


def test_scratch_folders_go_with_their_scope(spark):
    import os

    from vitrine.session import cut_lineage, scratch_scope

    where = lambda df: os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    with scratch_scope(spark):
        gone, kept = where(cut_lineage(spark.range(5))), where(cut_lineage(spark.range(5), keep=True))
        with scratch_scope(spark):
            inner = where(cut_lineage(spark.range(5)))
        assert os.path.exists(gone) and not os.path.exists(inner)
    after = where(cut_lineage(spark.range(5)))
    assert not os.path.exists(gone) and os.path.exists(kept) and os.path.exists(after)
    with pytest.raises(ZeroDivisionError):
        with scratch_scope(spark):
            gone = where(cut_lineage(spark.range(5)))
            1 / 0
    assert not os.path.exists(gone)

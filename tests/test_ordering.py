import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import ordering as od


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds more than a third of the rows and spans partitions."""
    random.seed(7)
    data = [("hot" if i % 3 else random.choice(["a", "b", None]), random.choice([1, 2, 3, None]), random.choice("xyz"), i) for i in range(4000)]
    return data, spark.createDataFrame(data, "g string, pos int, unit string, i int").repartition(8)


def _rank(data):
    asc = lambda v: (v is None, v or 0)
    out = {}
    for g in {r[0] for r in data}:
        rows = [r for r in data if r[0] == g]
        keys = sorted({(asc(r[1]), tuple(-ord(ch) for ch in r[2])) for r in rows})
        counts = {k: 0 for k in keys}
        for r in rows:
            counts[(asc(r[1]), tuple(-ord(ch) for ch in r[2]))] += 1
        rank, at = {}, 1
        for k in keys:
            rank[k], at = at, at + counts[k]
        for r in rows:
            out[r[3]] = rank[(asc(r[1]), tuple(-ord(ch) for ch in r[2]))]
    return out


def test_rank_in_list(skewed):
    data, df = skewed
    got = {r["i"]: r["rank"] for r in od.rank_in_list(df, ["g"], ["pos", "-unit"]).collect()}
    assert got == _rank(data)


def test_sequence_id(skewed):
    data, df = skewed
    got = {r["i"]: r["seq"] for r in od.sequence_id(df, "unit", "i").collect()}
    assert got == {r[3]: n + 1 for n, r in enumerate(sorted(data, key=lambda r: (r[2], r[3])))}


def test_preceding_total_over_a_hot_group(skewed):
    data, df = skewed
    got = {r["i"]: r["before"] for r in od.preceding_total(df.withColumn("one", F.lit(1)), ["g"], ["i"], "one", "before").collect()}
    seen, expected = {}, {}
    for g, *_, i in sorted(data, key=lambda r: r[3]):
        expected[i] = seen.get(g, 0)
        seen[g] = expected[i] + 1
    assert got == expected


def test_empty(spark):
    empty = spark.createDataFrame([], "g string, v int")
    assert od.sequence_id(empty, "v").collect() == []
    assert od.rank_in_list(empty, ["g"], ["v"]).collect() == []


def test_distinct_on_limits_before_the_shuffle(skewed):
    _, df = skewed
    first = od.distinct_on(df, ["g"], "-i")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")
    assert {r["g"]: r["i"] for r in first.collect()}["hot"] == max(r[3] for r in skewed[0] if r[0] == "hot")


def test_latest_and_first(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z"), ("b", 5, "w")], "k string, t int, v string")
    assert rows(od.latest_by(df, ["k"], "t")) == [("a", 2, "y"), ("b", None, "z")]
    assert rows(od.first_match(df, "k", "v")) == [("a", "x"), ("b", "w")]
    assert rows(od.first_match(df, "k", "v", "-t")) == [("a", "y"), ("b", "z")]


def test_cumulative(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("b", 2)], "g string, p int")
    got = rows(od.cumulative_counts(df, "g", F.col("p")).select("g", "period", "n", "cumulative"))
    assert got == [("a", 1, 2, 2), ("a", 3, 1, 3), ("b", 2, 1, 1)]

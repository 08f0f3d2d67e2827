import random

import pytest
from pyspark.sql import functions as F

from txgraph.operators.skew import heavy_keys, heavy_threshold, lookup_join, salted_join
from txgraph.operators.triangles import clustering
from txgraph.session import session_conf

ROWS, TASKS = 100_000, 16


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with half of the rows, one with a hundredth, others with a few rows each."""
    key = F.expr("case when id % 2 = 0 then -1 when id % 100 = 1 then -2 else id % 9973 end")
    return spark.range(0, ROWS, numPartitions=8).select("id", key.alias("k"))


def loads(df):
    return [r[0] for r in df.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]


@pytest.mark.parametrize("join", ["lookup", "salted"])
def test_no_task_above_three_times_the_mean(spark, skewed, join):
    right = skewed.select("k").distinct().withColumn("v", F.col("k") * 3)
    settings = {"spark__sql__adaptive__enabled": "false", "spark__sql__autoBroadcastJoinThreshold": "-1"}
    with session_conf(spark, **settings, spark__sql__shuffle__partitions=str(TASKS)):
        assert max(loads(skewed.join(right, "k"))) > 3 * ROWS / TASKS  # a plain join is lopsided
        heavy = heavy_keys(skewed, ["k"], ROWS, minimum=100)
        assert {r.k for r in heavy.collect()} == {-1, -2}
        if join == "lookup":
            found = lookup_join(skewed, right, ["k"], heavy, "inner")
        else:
            found = salted_join(skewed, right, ["k"], heavy, heavy_threshold(ROWS, 1000))
        sizes = loads(found.select("id", "v", "k"))
        assert found.where("v = k * 3").count() == ROWS
        # A union has the tasks of both parts; each is held against the mean of a shuffle.
        assert max(sizes) <= 3 * ROWS / TASKS


def test_salted_join_keeps_every_pair(spark):
    rng = random.Random(1)
    left = [(0 if rng.random() < 0.6 else rng.randrange(5), i) for i in range(300)] + [(None, 7)]
    right = [(rng.randrange(6), i) for i in range(40)] + [(None, 8)]
    l, r = spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b int")
    found = salted_join(l, r, ["k"], heavy_keys(l, ["k"], 300, minimum=20), 25)
    assert sorted(map(tuple, found.collect())) == sorted((k, a, b) for k, a in left for q, b in right if k == q and k is not None)


def test_triangles_of_a_star_with_a_clique(spark):
    """A hub with 600 leaves, some of them in a clique; heavy from 50 edges on."""
    names = [f"n{i:03d}" for i in range(600)]
    edges = [("hub", n) for n in names] + [(a, b) for i, a in enumerate(names[:30]) for b in names[i + 1 : 30]]
    df = spark.createDataFrame([(1, *e) for e in edges], "graph_id long, a string, b string")
    got = {r.node: (r.degree, r.triangles, r.clustering) for r in clustering(df, heavy_min_rows=50).collect()}
    plain = {r.node: (r.degree, r.triangles, r.clustering) for r in clustering(df).collect()}
    assert got == plain
    assert got["hub"][:2] == (600, 30 * 29 // 2) and got["n000"][:2] == (30, 29 * 28 // 2 + 29)

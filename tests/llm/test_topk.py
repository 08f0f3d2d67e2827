import random

import pytest
from pyspark.sql import types as T

from txgraph.llm import topk

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("block", T.StringType()),
    ]
)


def brute(rows, k):
    from math import floor, isfinite

    good = [
        (i, [floor(64 * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and isfinite(x) for x in v)
    ]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out)


def rows_of(rng, n, dim):
    return [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) if i % 3 else rng.gauss(0, 1) for _ in range(dim)], 0, "b") for i in range(n)]


@pytest.mark.parametrize("dim,step", [(6, 20), (40, 5)])
def test_equal_to_brute_force(spark, dim, step):
    rng = random.Random(dim)
    rows = rows_of(rng, 300, dim)
    rows = [(i, [float(__import__("numpy").float32(x)) for x in v], a, b) for i, v, a, b in rows]
    rows += [(400 + i, rows[40][1], 0, "b") for i in range(30)]  # a third of a top list ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=step, query_rows=4, candidate_rows=37)
    assert sorted(map(tuple, got.collect())) == brute(rows, step)


def test_odd_rows(spark):
    rows = [(0, None, 1, ""), (20, [1.0, None], 1, ""), (40, [float("nan"), 1.0], 1, ""), (60, [float("inf"), 1.0], 1, "")]
    rows += [(80, [1.0, 2.0], 1, ""), (1, [1.0, 1.0], None, ""), (2, [1.0, 1.0], 1, ""), (3, [1.0], 1, ""), (None, [1.0, 1.0], 1, "")]
    rows += [(100, [], 1, ""), (4, [], 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5)
    assert topk.top_k(df.where("false"), df.where("false")).count() == 0
    huge = spark.createDataFrame([(0, [3e38, 1.0], 1, ""), (1, [3e38, 1.0], 1, ""), (2, [-3e38, 0.0], 1, "")], SCHEMA)
    found = topk.top_k(huge, huge.where("vec_id = 0"), k=2).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(1, 2**63 - 1), (2, -(2**63))]


def test_bounds_rule_out_most_pairs_of_the_table(spark):
    """Before the last step, over half of all pairs are gone: blocks in turn, bars handed on."""
    import numpy as np

    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows], np.int64)
    data, _ = topk.quantise([list(r.embedding) for r in rows])
    asked = np.flatnonzero(ids % 20 == 0)[:256]
    best, shares, sizes = topk.Best(ids[asked], 20), [], []
    for at in range(0, len(ids), 8192):
        block = slice(at, at + 8192)
        sizes.append(len(ids[block]))
        for found in topk.search(data[asked].T, ids[asked], data[block].T, ids[block], 20, bars=best.bars(), shares=shares):
            best.add(*found)
    left = np.average([x[-1] for x in shares], weights=sizes)
    print("alive before each step:", np.average(shares, axis=0, weights=sizes))
    assert left < 0.5
    scores = data[asked].astype(np.int64) @ data.T.astype(np.int64)
    for row, query in enumerate(asked):
        others = np.flatnonzero(ids != ids[query])
        order = np.lexsort((ids[others], -scores[row, others]))[:20]
        assert list(best.ids[row]) == list(ids[others[order]])


def test_a_full_memory_gives_the_same_rows(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, [float(round(x, 2)) for x in v], a, b) for i, v, a, b in rows_of(rng, 200, 8)], SCHEMA)
    sizes = {"k": 4, "query_rows": 3, "candidate_rows": 11}
    whole = topk.top_k(df, df.where("vec_id % 20 = 0"), **sizes).collect()
    assert sorted(whole) == sorted(topk.top_k(df, df.where("vec_id % 20 = 0"), **sizes, held_rows=0).collect())

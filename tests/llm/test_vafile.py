import hashlib
import random
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import types as T

from txgraph.llm import vafile
from txgraph.llm.common import read_table

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("cluster", T.StringType()),  # clashes with a result
        T.StructField("id", T.IntegerType()),
    ]
)


def brute(rows, k, rounds, dim):
    kept = [
        (i, [floor(64 * x) if abs(x) < 1e300 else int(x) * 64 for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == dim and all(x is not None and isfinite(x) for x in v)
    ]
    name = {id(r): hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest() for r in kept}
    at = [v for _, v in sorted(kept, key=lambda r: (name[id(r)], r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        at = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(at)]
    told = [(i, *nearest(v)) for i, v in kept]
    top = 2**63 - 1
    by = {}
    for _, d, n in told:
        by[n] = by.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(
        ((i, n, min(top, d), min(top, by[n]), min(top, sum(by.values())), digest[n]) for i, d, n in told), key=repr
    )


def run(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted(map(tuple, vafile.cluster(df, **options).collect()), key=repr)


@pytest.mark.parametrize("bits,scale", [(2, 1.0), (6, 0.2), (8, 300.0)])
def test_equal_to_brute_force(spark, bits, scale):
    rng = random.Random(bits)
    rows = [(i, [rng.gauss(i % 5, 1) * scale for _ in range(6)], "c", 1) for i in range(400)]
    rows += [(1000 + i, rows[3][1], "c", 1) for i in range(150)]  # copies: ties and one large group
    options = {"k": 7, "rounds": 3, "dim": 6}
    assert run(spark, rows, bits=bits, block_rows=33, **options) == brute(rows, **options)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, "", 1), (2, [1.0, None], "", 1), (3, [nan, 1.0], "", 1), (4, [inf, 1.0], "", 1), (5, [1.0], "", 1)]
    rows += [(None, [0.5, 0.25], None, None), (6, [], "", 1), (7, [1.0, -2.0], "", 1), (7, [1.0, -2.0], "", 1), (7, [3.0, 0.0], "", 1)]
    options = {"k": 16, "rounds": 3, "dim": 2}
    assert run(spark, rows, **options) == brute(rows, **options)
    assert run(spark, rows[:5], **options) == [] == run(spark, [], **options)


@pytest.mark.parametrize("top", [1e6, 1e12, 1e18, 1e40, 1.7e308])
def test_values_of_any_size(spark, top):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) * top ** rng.random() for _ in range(3)], "", 1) for i in range(60)]
    rows.append((99, [top, -top, 0.0], "", 1))
    options = {"k": 4, "rounds": 2, "dim": 3}
    assert run(spark, rows, block_rows=7, **options) == brute(rows, **options)


def test_intervals_hold_the_distances():
    rng = np.random.default_rng(0)
    rows, at = rng.integers(-500, 500, (200, 5)), rng.integers(-500, 500, (4, 5))
    low, width = rows.min(axis=0), np.full(5, 70)
    block = {"n": 200, "low": low.tobytes(), "width": width.tobytes(), "cells": vafile.pack((rows - low) // width, 4)}
    lower, upper = vafile.intervals(block, at, 4)
    exact = vafile.distances(rows, at)
    assert (lower <= exact).all() and (exact <= upper).all() and (lower < upper).any()


def test_few_vectors_are_fetched_once_settled(spark):
    seen = []
    vafile.cluster(read_table(spark, "/root/testdata/sf0.1", "embeddings"), report=seen).count()
    assert seen[0][0] == seen[0][1] == 2000  # the first round moves all
    assert all(fetched < 0.7 * n for n, fetched in seen[1:])

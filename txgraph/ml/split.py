"""Deterministic stratified split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txgraph.operators.prefix import running


def hash_bucket(number: Column) -> Column:
    """A portable multiplicative hash of a non-negative integer, below 2**32."""
    return F.pmod(number * F.lit(2654435761), F.lit(4294967296))


def seeded_order(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def stratified_split(
    df: DataFrame, label: str, order: Sequence[str], test_share: float = 0.25
) -> DataFrame:
    """Mark ``is_test`` on the first ``ceil(share * class rows)`` rows of every class.

    ``order`` is a pseudo-random total order of the rows. Both models of a comparison share
    the one column, so their rows are the same.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("__size"))
    placed = running(df, list(order), [label], position="__place")
    # One row per class.
    return (
        placed.join(F.broadcast(sizes), label)
        .withColumn("is_test", F.col("__place") <= F.ceil(F.col("__size") * F.lit(test_share)))
        .drop("__size", "__place")
    )

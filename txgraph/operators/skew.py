"""Joins that keep a very frequent key from landing in one task.

A key is heavy when it holds more rows than one task should get on its account: HEAVY_MIN, or on
very large data as many as keep the number of heavy keys within what may be broadcast. Counts come
from partial aggregation, which merges per-task counts and is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from txgraph.session import MAX_BROADCAST_ROWS

# Rows of one key that a task takes without ado.
HEAVY_MIN = 100_000


def heavy_threshold(rows: int, minimum: int = HEAVY_MIN) -> int:
    """Rows from which a key is heavy; at most MAX_BROADCAST_ROWS keys of ``rows`` rows reach it."""
    return max(minimum, 1, -(-rows // MAX_BROADCAST_ROWS))


def heavy_keys(df: DataFrame, on: Sequence[str], rows: int, minimum: int = HEAVY_MIN) -> DataFrame | None:
    """The heavy keys of ``df`` (of ``rows`` rows) with their count ``n``; None if it is too small."""
    limit = heavy_threshold(rows, minimum)
    if rows < limit:
        return None
    return df.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") >= limit)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    heavy: DataFrame | None = None,
    how: str = "left",
) -> DataFrame:
    """Join ``left`` to ``right``, which is unique on ``on``.

    ``heavy`` lists the heavy keys of ``left``: at most MAX_BROADCAST_ROWS rows by construction
    of the threshold. Their rows of ``right`` are broadcast and their rows of
    ``left`` stay where they are; the others are shuffled as usual.
    """
    on = list(on)
    if heavy is None:
        return left.join(right, on, how)
    flagged = F.broadcast(heavy.select(*on).withColumn("__heavy", F.lit(True)))
    left = left.join(flagged, on, "left")
    hot = left.filter("__heavy").drop("__heavy")
    cold = left.filter("__heavy is null").drop("__heavy")
    hot_right = right.join(F.broadcast(heavy.select(*on)), on, "left_semi")
    return hot.join(F.broadcast(hot_right), on, how).unionByName(cold.join(right, on, how))


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], heavy: DataFrame | None, limit: int
) -> DataFrame:
    """Inner join where both sides may have many rows of a key, and ``left`` has heavy ones.

    A key with n rows on the left is dealt to n / limit parts by a hash of its rows; the rows of
    ``right`` of that key, and of no other, are repeated for every part. ``heavy`` has the keys
    and their count ``n``.
    """
    on = list(on)
    if heavy is None:
        return left.join(right, on)
    parts = F.broadcast(heavy.select(*on, F.ceil(F.col("n") / limit).cast("int").alias("__parts")))
    own = F.coalesce(F.col("__parts"), F.lit(1))
    dealt = left.join(parts, on, "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*left.columns), own).cast("int")
    )
    repeated = right.join(parts, on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), own - 1))
    )
    return dealt.drop("__parts").join(repeated.drop("__parts"), [*on, "__salt"]).drop("__salt")

"""Running positions, sums and quantiles over a total order, without a one-task sort.

A plain ``row_number() over (order by ...)`` moves every row of a group into one task.
Here rows are range-partitioned on (group, order), each range is scanned on its own, and
the totals of the earlier ranges of the same group are added. Only the first group of a
range can have begun in an earlier one, so there are at most as many offsets as ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from txgraph.session import freeze

_RANGE = "__range"


def running(
    df: DataFrame,
    order: Sequence[Column | str],
    partition: Sequence[str] = (),
    sums: dict[str, Column] | None = None,
    position: str | None = None,
) -> DataFrame:
    """Add running sums (inclusive) and a 1-based position in ``order`` within ``partition``.

    The order must be total within a group for the positions to be well defined. ``df``
    is written once, so project it to the columns that are needed first.
    """
    exprs = dict(sums or {})
    if position:
        exprs[position] = F.lit(1).cast("bigint")
    parts = [F.col(name) for name in partition]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The bounds of a range partitioning are sampled; freezing keeps one choice of them.
    ranged = freeze(
        df.select("*", *[e.alias(f"__in_{name}") for name, e in exprs.items()])
        .repartitionByRange(ranges, *parts, *order)
        .withColumn(_RANGE, F.spark_partition_id())
    )
    upto = (
        W.partitionBy(_RANGE, *partition)
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = ranged.select(
        *df.columns,
        _RANGE,
        *[F.sum(f"__in_{name}").over(upto).alias(f"__at_{name}") for name in exprs],
    )
    totals = ranged.groupBy(_RANGE, *partition).agg(
        *[F.sum(f"__in_{name}").alias(f"__total_{name}") for name in exprs]
    )
    # One row per (group, range): at most `ranges` rows for any one group.
    earlier = (
        W.partitionBy(*partition).orderBy(_RANGE).rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = totals.select(
        _RANGE,
        *partition,
        *[F.sum(f"__total_{name}").over(earlier).alias(f"__before_{name}") for name in exprs],
    ).filter(F.col(f"__before_{next(iter(exprs))}").isNotNull())
    joined = local.join(F.broadcast(offsets), [_RANGE, *partition], "left")
    return joined.select(
        *df.columns,
        *[
            (F.col(f"__at_{name}") + F.coalesce(F.col(f"__before_{name}"), F.lit(0))).alias(name)
            for name in exprs
        ],
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: Sequence[float], partition: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group, column ``quantiles``.

    Distinct values are counted, ranked with :func:`running`, and the order statistics
    around each rank are picked; no task ever holds the values of a whole group.
    """
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*partition, value)
        .agg(F.count("*").alias("__n"))
    )
    ranked = running(counted, [value], partition, sums={"__upto": F.col("__n")})
    sizes = ranked.groupBy(*partition).agg(F.sum("__n").alias("__size"))
    if partition:
        ranked = ranked.join(sizes, list(partition))
    else:
        ranked = ranked.withColumn("__size", sizes.scalar())
    before = F.col("__upto") - F.col("__n")
    parts = []
    for i, p in enumerate(probabilities):
        rank = F.lit(float(p)) * (F.col("__size") - 1)
        low = F.floor(rank)
        high = F.ceil(rank)
        parts.append(
            F.max(F.when((before <= low) & (low < F.col("__upto")), F.col(value))).alias(f"__lo{i}")
        )
        parts.append(
            F.max(F.when((before <= high) & (high < F.col("__upto")), F.col(value))).alias(
                f"__hi{i}"
            )
        )
        parts.append(F.max(rank - low).alias(f"__w{i}"))
    picked = ranked.groupBy(*partition).agg(*parts)
    return picked.select(
        *partition,
        F.array(
            *[
                F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__w{i}")
                for i in range(len(probabilities))
            ]
        ).alias("quantiles"),
    )

"""Population stability index between a reference and a current score distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txgraph.functions.scalars import drift_verdict
from txgraph.operators.prefix import exact_quantiles

_FLOOR = 1e-6


def reference_edges(reference: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """One row, column ``edges``: the inner quantile edges of the reference, exact."""
    inner = [i / bins for i in range(1, bins)]
    return exact_quantiles(reference, value, inner).withColumnRenamed("quantiles", "edges")


def bin_of(value: Column, edges: Column) -> Column:
    """Number of inner edges at or below the value; repeated edges leave empty bins."""
    return F.size(F.filter(edges, lambda e: e <= value))


def psi(
    reference: DataFrame,
    current: DataFrame,
    value: str,
    bins: int = 10,
    by: Sequence[str] = (),
) -> DataFrame:
    """PSI of ``current`` (optionally per window) against ``reference``, with a verdict.

    Only the edges (one row) and the bin counts are shared; both tables are scanned in
    place and counted with partial aggregation.
    """
    edges = reference_edges(reference, value, bins).scalar()

    def counts(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
        binned = df.withColumn("bin", bin_of(F.col(value), F.col("edges")))
        sums = [F.count_if(F.col("bin") == b).cast("double").alias(f"{prefix}{b}") for b in range(bins)]
        return binned.groupBy(*keys).agg(*sums, F.count("*").alias(f"{prefix}n"))

    ref = counts(reference.select(value).withColumn("edges", edges), "r", [])
    cur = counts(current.select(*by, value).withColumn("edges", edges), "c", by)
    ref_row = ref.select(F.struct(*ref.columns).alias("ref")).scalar()
    joined = cur.withColumn("ref", ref_row)

    def share(count: Column, total: Column) -> Column:
        return F.greatest(count / F.greatest(F.lit(1), total), F.lit(_FLOOR))

    value_sum = F.lit(0.0)
    for b in range(bins):
        r = share(F.col(f"ref.r{b}"), F.col("ref.rn"))
        c = share(F.col(f"c{b}"), F.col("cn"))
        value_sum = value_sum + (c - r) * F.log(c / r)
    return joined.select(*by, value_sum.alias("psi")).withColumn(
        "verdict", drift_verdict(F.col("psi"))
    )

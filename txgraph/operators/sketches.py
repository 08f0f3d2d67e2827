"""Distinct neighbours over very wide windows: mergeable sketches per node and pane.

Exact distinct counts of a wide window keep every (node, neighbour) pair. A sketch per node and
pane has a fixed size; wide windows unite the sketches of their panes, so a window that slides
reads panes and no events, and a late pane is united like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# 2^12 registers: a relative standard error of 1.04 / 64, about 1.6 %.
LG_K = 12


def neighbours(tx: DataFrame, *keep: str) -> DataFrame:
    """(keep…, ntype, id, side, other): each transaction as four node–neighbour rows."""
    ends = [("account", "device"), ("account", "merchant"), ("device", "account"), ("merchant", "account")]
    rows = [
        F.struct(
            F.lit(node).alias("ntype"),
            F.col(f"{node}_id").alias("id"),
            F.lit(side).alias("side"),
            F.col(f"{side}_id").alias("other"),
        )
        for node, side in ends
    ]
    return tx.select(*keep, F.explode(F.array(*rows)).alias("end")).select(*keep, "end.*")


def pane_sketches(tx: DataFrame, pane: Column, *keep: str, lg_k: int = LG_K) -> DataFrame:
    """(keep…, pane, ntype, id, side, sketch): partial aggregation sends sketches, not rows."""
    rows = neighbours(tx.withColumn("pane", pane), *keep, "pane").where(
        F.col("id").isNotNull() & F.col("other").isNotNull()
    )
    return rows.groupBy(*keep, "pane", "ntype", "id", "side").agg(
        F.hll_sketch_agg("other", F.lit(lg_k)).alias("sketch")
    )


def united(sketches: DataFrame, *window: str) -> DataFrame:
    """(window…, ntype, id, side, estimate) over all panes of a window."""
    merged = sketches.groupBy(*window, "ntype", "id", "side").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("estimate", F.hll_sketch_estimate("sketch")).drop("sketch")


def error_bound(exact: Column, lg_k: int = LG_K, sigmas: float = 5.0) -> Column:
    """The largest error to expect, ``sigmas`` standard errors."""
    return exact * F.lit(sigmas * 1.04 / 2 ** (lg_k / 2))

"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txgraph.llm.common import discard, freeze, scratch_uri, small, written

ROWS_PER_PART = 20_000  # of the labels


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node.

    Each round every node hooks onto its smallest neighbour, pointers are doubled, and the
    edges are rewritten to the nodes reached; what lies within one node goes. Rounds grow with
    the logarithm of the longest chain. Nothing is collected; hooks of few nodes are broadcast. The
    edges of a round are a written table and no checkpoint, since a checkpoint carries the size
    estimate of its plan along, and these multiply from round to round.
    """
    folder, number = scratch_uri(edges.sparkSession, "components"), 0
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(pairs.where("a < b").distinct(), f"{folder}/{number}")
    labels = rest.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        hooks = hooks.select("node", F.least("node", "m").alias("top"))
        number += 1
        hooks = written(hooks, f"{folder}/{number}")
        nodes = hooks.count()
        for _ in range(2):
            above = hooks.select(F.col("node").alias("top"), F.col("top").alias("next"))
            hooks = hooks.join(small(above, nodes), "top").select("node", F.col("next").alias("top"))
        number += 1
        hooks = written(hooks, f"{folder}/{number}")
        if number == 2:
            labels = hooks.select("node", F.col("top").alias("component"))
        else:
            above = hooks.select(F.col("node").alias("component"), "top")
            labels = labels.join(small(above, nodes), "component", "left").select(
                "node", F.coalesce("top", "component").alias("component")
            )
        to = hooks.select(F.col("node").alias("a"), F.col("top").alias("x"))
        moved = rest.join(small(to, nodes), "a").select("b", "x")
        to = hooks.select(F.col("node").alias("b"), F.col("top").alias("y"))
        moved = moved.join(small(to, nodes), "b").where("x <> y")
        pairs = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        number += 1
        rest = written(pairs.distinct(), f"{folder}/{number}")
    labels = freeze(labels)
    discard(folder)
    # Rounds join the labels again and again: each partition would be a task and files in every exchange.
    return labels.coalesce(max(1, -(-labels.count() // ROWS_PER_PART)))

"""Local clustering coefficient of a general undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txgraph.operators.skew import HEAVY_MIN, heavy_threshold, lookup_join
from txgraph.session import freeze


def clustering(pairs: DataFrame, heavy_min_rows: int = HEAVY_MIN) -> DataFrame:
    """Clustering per node of an undirected simple graph.

    ``pairs``: graph_id, a, b with one row per edge, in either direction. Edges are oriented
    from the lower to the higher (degree, name), so that no node has more than sqrt(2m)
    outgoing edges, and each triangle is found once: as two edges u-v and u-w out of its lowest
    node with a closing v-w. No key of the first join has more rows than that; an edge v-w asked
    for by more pairs than a task's share is looked up by broadcast. Returns graph_id, node,
    degree, triangles, clustering.
    """
    edges = freeze(
        pairs.where("a <> b")
        .selectExpr("graph_id", "least(a, b) as a", "greatest(a, b) as b")
        .distinct()
    )
    degrees = freeze(
        edges.selectExpr("graph_id", "explode(array(a, b)) as node")
        .groupBy("graph_id", "node")
        .agg(F.count("*").alias("degree"))
    )
    n_edges = edges.count()
    limit = heavy_threshold(n_edges, heavy_min_rows)
    heavy = None
    if n_edges >= limit:
        # Every edge has two ends: at most twice MAX_BROADCAST_ROWS nodes.
        heavy = freeze(degrees.where(F.col("degree") >= limit).selectExpr("graph_id", "node", "degree as n"))

    def named(column: str) -> DataFrame | None:
        return None if heavy is None else heavy.withColumnRenamed("node", column)

    ends = lookup_join(
        edges, degrees.selectExpr("graph_id", "node as a", "degree as da"), ["graph_id", "a"], named("a"), "inner"
    )
    ends = lookup_join(
        ends, degrees.selectExpr("graph_id", "node as b", "degree as db"), ["graph_id", "b"], named("b"), "inner"
    )
    up = "da < db or (da = db and a < b)"
    oriented = freeze(
        ends.selectExpr("graph_id", f"if({up}, a, b) as u", f"if({up}, b, a) as v", f"if({up}, db, da) as d")
    )
    wedges = _wedges(oriented)
    closed = lookup_join(
        wedges.select("graph_id", "u", "v", "w"),
        oriented.selectExpr("graph_id", "u as v", "v as w"),
        ["graph_id", "v", "w"],
        _busy_pairs(wedges, oriented, degrees, limit),
        "inner",
    )
    counts = (
        closed.selectExpr("graph_id", "explode(array(u, v, w)) as node")
        .groupBy("graph_id", "node")
        .agg(F.count("*").alias("triangles"))
    )
    return degrees.join(counts, ["graph_id", "node"], "left").selectExpr(
        "graph_id",
        "node",
        "degree",
        "coalesce(triangles, 0L) as triangles",
        "case when degree < 2 then 0.0D"
        " else 2.0D * coalesce(triangles, 0L) / (degree * (degree - 1)) end as clustering",
    )


def _wedges(oriented: DataFrame) -> DataFrame:
    """Pairs of edges out of one node: graph_id, u, v, d, w, dw with v below w."""
    other = oriented.selectExpr("graph_id", "u", "v as w", "d as dw")
    return oriented.join(other, ["graph_id", "u"]).where("d < dw or (d = dw and v < w)")


def _busy_pairs(wedges: DataFrame, oriented: DataFrame, degrees: DataFrame, minimum: int) -> DataFrame | None:
    """Pairs v, w that close more wedges than a task's share; None if there are none.

    Every wedge is a neighbour of both ends, so only nodes of that degree need be counted.
    """
    out = oriented.groupBy("graph_id", "u").count()
    n_wedges = out.agg(F.expr("sum(`count` * (`count` - 1) div 2)")).first()[0] or 0
    limit = heavy_threshold(n_wedges, minimum)
    if n_wedges < limit or degrees.where(F.col("degree") >= limit).isEmpty():
        return None
    found = freeze(
        wedges.where((F.col("d") >= limit) & (F.col("dw") >= limit))
        .groupBy("graph_id", "v", "w")
        .count()
        .where(F.col("count") >= limit)
        .select("graph_id", "v", "w")
    )
    return None if found.isEmpty() else found

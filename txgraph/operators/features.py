"""The 20-column feature vector: 5 tabular and 15 graph features per transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txgraph.functions.scalars import channel_code, tx_type_code
from txgraph.operators.betweenness import betweenness
from txgraph.operators.components import component_sizes, connected_components
from txgraph.operators.graph import (
    TxGraph,
    build_graph,
    busy_nodes,
    edge_table,
    endpoint_table,
)
from txgraph.operators.pagerank import pagerank, settled
from txgraph.operators.skew import HEAVY_MIN, lookup_join
from txgraph.schema import ALL_FEATURES, GRAPH_FEATURES, INTEGER_GRAPH_FEATURES
from txgraph.session import freeze

KEYS = {"account": "account_id", "device": "device_id", "merchant": "merchant_id"}


def tabular_features(tx: DataFrame) -> DataFrame:
    """tx_id and the transactional features."""
    return tx.select(
        "tx_id",
        F.col("amount").cast("double").alias("amount"),
        F.log1p(F.col("amount").cast("double")).alias("amount_log"),
        tx_type_code(F.col("tx_type")).alias("tx_type_code"),
        channel_code(F.col("channel")).alias("channel_code"),
        F.hour("event_time").alias("hour_of_day"),
    )


def velocity(tx: DataFrame) -> DataFrame:
    """Transactions per account among the rows passed in."""
    return tx.groupBy("graph_id", "account_id").agg(F.count("*").alias("velocity_ring_score"))


def node_metrics(
    graph: TxGraph, pagerank_args: dict | None = None, betweenness_args: dict | None = None
) -> DataFrame:
    """Degree, PageRank, betweenness and component size of every node.

    Ranks that do not converge end the job, as nothing downstream could tell them apart.
    """
    ranks = settled(pagerank(graph, **(pagerank_args or {})))
    between = betweenness(graph, **(betweenness_args or {}))
    parts = connected_components(graph)
    sized = parts.join(component_sizes(parts), ["graph_id", "component"])
    return (
        graph.vertices.drop("hub", "size", "strength")
        .join(ranks, ["graph_id", "node"], "left")
        .join(between.drop("sampled"), ["graph_id", "node"], "left")
        .join(sized.select("graph_id", "node", "component_size"), ["graph_id", "node"], "left")
    )


def attach(
    tx: DataFrame, metrics: DataFrame, ntype: str, columns: dict[str, str], busy: DataFrame | None
) -> DataFrame:
    """Look node metrics up by the account, device or merchant of a transaction."""
    key = KEYS[ntype]
    side = metrics.filter(F.col("ntype") == ntype).select(
        "graph_id",
        F.col("id").alias(key),
        *[F.col(source).alias(target) for target, source in columns.items()],
    )
    heavy = None
    if busy is not None:
        heavy = busy.filter(F.col("ntype") == ntype).select("graph_id", F.col("id").alias(key))
    return lookup_join(tx, side, ["graph_id", key], heavy)


def assemble_graph_features(
    tx: DataFrame, metrics: DataFrame, busy: DataFrame | None = None
) -> DataFrame:
    """graph_id, tx_id and the 15 graph features, one row per transaction.

    Nodes absent from the graph get degree 0, centralities 0.0, component size 1.
    """
    rows = tx.select("graph_id", "tx_id", *KEYS.values())
    rows = attach(
        rows,
        metrics,
        "account",
        {
            "account_degree": "degree",
            "account_pagerank": "pagerank",
            "account_betweenness": "betweenness",
            "component_size": "component_size",
            "unique_devices_per_account": "devices",
            "unique_merchants_per_account": "merchants",
        },
        busy,
    )
    rows = attach(
        rows,
        metrics,
        "device",
        {
            "device_degree": "degree",
            "device_betweenness_centrality": "betweenness",
            "device_pagerank": "pagerank",
        },
        busy,
    )
    rows = attach(
        rows,
        metrics,
        "merchant",
        {"merchant_degree": "degree", "merchant_betweenness": "betweenness"},
        busy,
    )
    heavy = None
    if busy is not None:
        heavy = busy.filter(F.col("ntype") == "account").select(
            "graph_id", F.col("id").alias("account_id")
        )
    rows = lookup_join(rows, velocity(tx), ["graph_id", "account_id"], heavy)
    # Every edge joins an account to a device or merchant: the graph has no triangles, and
    # both clustering coefficients are zero by structure.
    defaults = {name: F.lit(0) for name in INTEGER_GRAPH_FEATURES} | {
        "velocity_ring_score": F.lit(1),
        "component_size": F.lit(1),
    }
    values = {
        "device_shared_account_count": F.col("device_degree"),
        "account_clustering_coef": F.lit(0.0),
        "merchant_cluster_coefficient": F.lit(0.0),
    }
    return rows.select(
        "graph_id",
        "tx_id",
        *[
            F.coalesce(values.get(name, F.col(name)), defaults.get(name, F.lit(0.0)))
            .cast("bigint" if name in INTEGER_GRAPH_FEATURES else "double")
            .alias(name)
            for name in GRAPH_FEATURES
        ],
    )


def graph_features(
    tx: DataFrame,
    window_tx: DataFrame | None = None,
    graph: TxGraph | None = None,
    **metric_args,
) -> DataFrame:
    """The 15 graph features of ``tx`` on the graphs of ``window_tx`` (default: ``tx``)."""
    graph = graph or build_graph(tx if window_tx is None else window_tx)
    # Three look-ups read the metrics, so they are computed once.
    metrics = freeze(node_metrics(graph, **metric_args))
    return assemble_graph_features(tx, metrics, graph.busy)


def degree_features(tx: DataFrame, busy_min_rows: int = HEAVY_MIN) -> DataFrame:
    """The features that need no iteration, straight from the edge table.

    Columns: graph_id, tx_id, account_degree, device_degree, merchant_degree,
    velocity_ring_score, unique_devices_per_account, unique_merchants_per_account.
    """
    ends = freeze(endpoint_table(edge_table(tx)))
    busy = busy_nodes(ends, busy_min_rows)
    rows = tx.select("graph_id", "tx_id", *KEYS.values())
    for ntype, columns in (
        (
            "account",
            {
                "account_degree": "degree",
                # Each transaction adds a device and a merchant link.
                "velocity_ring_score": "strength",
                "unique_devices_per_account": "devices",
                "unique_merchants_per_account": "merchants",
            },
        ),
        ("device", {"device_degree": "degree"}),
        ("merchant", {"merchant_degree": "degree"}),
    ):
        rows = attach(rows, ends, ntype, columns, busy)
    return rows.select(
        "graph_id",
        "tx_id",
        "account_degree",
        "device_degree",
        "merchant_degree",
        F.expr("velocity_ring_score div 2").alias("velocity_ring_score"),
        "unique_devices_per_account",
        "unique_merchants_per_account",
    )


def feature_matrix(tx: DataFrame, features: DataFrame) -> DataFrame:
    """tx_id and ALL_FEATURES in order; transactions without graph features get zeros."""
    columns = [c for c in GRAPH_FEATURES if c in features.columns]
    joined = tabular_features(tx).join(features.select("tx_id", *columns), "tx_id", "left")
    return joined.select(
        "tx_id", *[c for c in ALL_FEATURES if c in joined.columns]
    ).na.fill(0.0)


def with_labels(matrix: DataFrame, tx: DataFrame) -> DataFrame:
    """Align labels to feature rows by key."""
    return matrix.join(tx.select("tx_id", "is_fraud"), "tx_id")

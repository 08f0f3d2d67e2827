"""Named queries over the driver's tables; each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from txgraph.functions import scalars as X
from txgraph.operators import batches as B
from txgraph.operators import drift as D
from txgraph.operators import features as FE
from txgraph.operators import graph as G
from txgraph.operators import investigate as I
from txgraph.operators import metrics as M
from txgraph.operators import monitor as MO
from txgraph.operators import panes as PA
from txgraph.operators import profile as P
from txgraph.operators import quality as Q
from txgraph.operators import rings as R
from txgraph.operators import serving as S
from txgraph.operators import sketches as SK
from txgraph.operators import spans as SN
from txgraph.operators.betweenness import betweenness
from txgraph.operators.components import component_sizes, connected_components
from txgraph.operators.pagerank import pagerank, settled
from txgraph.operators.triangles import clustering
from txgraph.ml import split as SP
from txgraph.schema import GRAPH_FEATURES, TABULAR_FEATURES
from txgraph.session import ensure_checkpoint_dir, freeze
from txgraph.sinks.messages import keyed_messages
from txgraph.sinks.online import online_view, upsert_batch
from txgraph.sources.events import load_transactions
from txgraph.sources.transactions import conform, parse_json

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Scores of the queries come from fixed formulas, so that routing can be checked in SQL.
BATCH = 250
# Batches so small that their windows overlap.
SMALL_BATCH = 8
DAY = 1440


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rule_score(divisor: float = 190.0):
    return F.least(F.lit(1.0), F.col("amount") / F.lit(divisor))


def tx_of(spark: SparkSession, sf: str) -> DataFrame:
    return load_transactions(spark, sf)


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    return G.with_hourly_graph(tx_of(spark, sf))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return G.with_window_graph(tx_of(spark, sf), DAY)


def scored_of(spark: SparkSession, sf: str, divisor: float = 190.0) -> DataFrame:
    return I.route(hourly(spark, sf), rule_score(divisor))


def named_nodes(graph: G.TxGraph, table: DataFrame) -> DataFrame:
    return graph.vertices.select("graph_id", "node", "ntype", "id").join(
        table, ["graph_id", "node"]
    )


# --- sources, projections, scalars -------------------------------------------


@query
def tx_features(spark, sf):
    return FE.tabular_features(tx_of(spark, sf)).select(
        "tx_id",
        F.round("amount", 6).alias("amount"),
        F.round("amount_log", 9).alias("amount_log"),
        *[F.col(c).cast("bigint").alias(c) for c in TABULAR_FEATURES[2:]],
    )


@query
def json_roundtrip(spark, sf):
    """Events as keyed JSON messages, parsed back into typed rows."""
    parsed = parse_json(keyed_messages(tx_of(spark, sf)))
    return parsed.withColumn("event_time", X.micros(F.col("event_time")))


@query
def json_props(spark, sf):
    """Text that is not a transaction parses to an all-null row, which is quarantined."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    parsed = parse_json(events.select(F.col("props").alias("value")))
    return parsed.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("tx_id").isNull() & F.col("account_id").isNull()).alias("n_quarantined"),
    )


@query
def kafka_payload(spark, sf):
    return keyed_messages(I.alerts(scored_of(spark, sf)))


@query
def external_mapping(spark, sf):
    """An external order table brought into the event schema by a column mapping."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    mapping = {
        "tx_id": "o_orderkey",
        "account_id": "o_custkey",
        "amount": "o_totalprice",
        "tx_type": "o_orderpriority",
        "channel": "o_orderstatus",
        "event_time": "o_orderdate",
    }
    mapped = conform(orders, mapping)
    return mapped.withColumn("event_time", X.micros(F.col("event_time")))


@query
def time_functions(spark, sf):
    tx = tx_of(spark, sf)
    seconds = F.unix_timestamp("event_time")
    return tx.select(
        "tx_id",
        X.hour_start(F.col("event_time")).alias("hour_start"),
        X.path_stamp(F.col("event_time")).alias("path_stamp"),
        X.clock_label(F.col("event_time")).alias("clock"),
        X.micros(X.from_epoch_seconds(seconds)).alias("whole_second"),
    )


@query
def one_hot(spark, sf):
    return P.one_hot(tx_of(spark, sf).select("tx_id", "tx_type", "channel"))


# --- graph -------------------------------------------------------------------


@query
def edges_hourly(spark, sf):
    edges = G.keyed_edges(G.edge_table(hourly(spark, sf)))
    return edges.withColumn("amount", F.round("amount", 2))


@query
def vertices_hourly(spark, sf):
    return G.vertex_order(hourly(spark, sf))


@query
def graph_stats_hourly(spark, sf):
    return G.graph_sizes(hourly(spark, sf))


@query
def degree_hourly(spark, sf):
    ends = G.endpoint_table(G.edge_table(hourly(spark, sf)))
    return ends.select("graph_id", "ntype", "id", "degree")


@query
def fanout_hourly(spark, sf):
    ends = G.endpoint_table(G.edge_table(hourly(spark, sf)))
    return G.nodes_by_type(ends, "account").select(
        "graph_id",
        F.col("id").alias("account_id"),
        F.col("devices").alias("unique_devices"),
        F.col("merchants").alias("unique_merchants"),
    )


@query
def fanout_daily_sketched(spark, sf):
    """Daily distinct neighbours from hourly sketches, beside the exact count and its error bound."""
    tx = daily(spark, sf)
    keys = ["graph_id", "ntype", "id", "side"]
    estimates = SK.united(SK.pane_sketches(tx, F.date_trunc("hour", "event_time"), "graph_id"), "graph_id")
    exact = SK.neighbours(tx, "graph_id").distinct().groupBy(*keys).agg(F.count("*").alias("neighbours"))
    error = F.abs(F.col("estimate") - F.col("neighbours"))
    return exact.join(estimates, keys, "left").select(
        *keys, "neighbours", F.coalesce(error <= SK.error_bound(F.col("neighbours")), F.lit(False)).alias("within_bound")
    )


@query
def velocity_hourly(spark, sf):
    return FE.velocity(hourly(spark, sf))


@query
def velocity_rolling(spark, sf):
    return B.rolling_velocity(tx_of(spark, sf))


@query
def degree_features_hourly(spark, sf):
    return FE.degree_features(hourly(spark, sf))


@query
def components_hourly(spark, sf):
    graph = G.build_graph(hourly(spark, sf))
    parts = connected_components(graph)
    sized = parts.join(component_sizes(parts), ["graph_id", "component"])
    return named_nodes(graph, sized).select("graph_id", "ntype", "id", "component_size")


@query
def pagerank_hourly(spark, sf):
    """To convergence of every window, at most 100 iterations."""
    graph = G.build_graph(hourly(spark, sf))
    return named_nodes(graph, settled(pagerank(graph))).select(
        "graph_id", "ntype", "id", F.round("pagerank", 9).alias("pagerank")
    )


@query
def pagerank_daily_fixed(spark, sf):
    """Twenty iterations on daily graphs."""
    graph = G.build_graph(daily(spark, sf))
    return named_nodes(graph, pagerank(graph, iterations=20)).select(
        "graph_id", "ntype", "id", F.round("pagerank", 9).alias("pagerank")
    )


@query
def pagerank_daily(spark, sf):
    """To convergence of every day, by joins at every size of graph."""
    graph = G.build_graph(daily(spark, sf))
    return named_nodes(graph, settled(pagerank(graph, kernel_nodes=0))).select(
        "graph_id", "ntype", "id", F.round("pagerank", 9).alias("pagerank")
    )


@query
def betweenness_daily(spark, sf):
    """Exact, in blocks of sources or by joins at every size of graph."""
    graph = G.build_graph(daily(spark, sf))
    return named_nodes(graph, betweenness(graph, kernel_nodes=0)).select(
        "graph_id", "ntype", "id", F.round("betweenness", 9).alias("betweenness"), "sampled"
    )


@query
def betweenness_hourly(spark, sf):
    graph = G.build_graph(hourly(spark, sf))
    return named_nodes(graph, betweenness(graph)).select(
        "graph_id", "ntype", "id", F.round("betweenness", 9).alias("betweenness")
    )


@query
def triangles_entity(spark, sf):
    """Clustering on the closed graph: account, device and merchant of an event all linked."""
    tx = hourly(spark, sf)
    pairs = tx.select(
        "graph_id",
        F.expr(
            "explode(array(struct(account_id as a, device_id as b),"
            " struct(account_id as a, merchant_id as b), struct(device_id as a, merchant_id as b)))"
        ).alias("e"),
    ).select("graph_id", "e.a", "e.b")
    found = clustering(pairs)
    return found.withColumn("clustering", F.round("clustering", 9))


@query
def graph_features_hourly(spark, sf):
    features = FE.graph_features(hourly(spark, sf))
    real = [c for c, t in features.dtypes if t == "double"]
    return features.select(
        *[F.round(c, 9).alias(c) if c in real else F.col(c) for c in features.columns]
    )


@query
def feature_matrix(spark, sf):
    """The serving vector over hourly windows, with the features that need no iteration."""
    tx = hourly(spark, sf)
    matrix = FE.feature_matrix(tx, FE.degree_features(tx))
    return FE.with_labels(matrix, tx).select(
        "tx_id",
        F.round("amount", 6).alias("amount"),
        F.round("amount_log", 9).alias("amount_log"),
        *[
            F.col(c).cast("bigint").alias(c)
            for c in matrix.columns
            if c not in ("tx_id", "amount", "amount_log")
        ],
        F.col("is_fraud").cast("bigint").alias("is_fraud"),
    )


# --- rings -------------------------------------------------------------------


def _daily_rings(spark, sf):
    return R.detect_rings(G.build_graph(daily(spark, sf)))


def _ring_columns(found: DataFrame) -> DataFrame:
    return found.select(
        "graph_id",
        "ring_id",
        "size",
        "n_devices",
        "n_merchants",
        "n_nodes",
        "n_edges",
        *[F.round(c, 9).alias(c) for c in ("shared_device_ratio", "density", "risk_score")],
    )


@query
def labels_daily(spark, sf):
    """Label-propagation labels of all nodes of the daily graphs."""
    from txgraph.operators.communities import propagate_labels

    graph = G.build_graph(daily(spark, sf))
    return named_nodes(graph, propagate_labels(graph)).select("graph_id", "ntype", "id", "label")


@query
def labels_weekly(spark, sf):
    """Labels of the weekly graphs, found by joins at any size of a graph."""
    from txgraph.operators.communities import propagate_labels

    graph = G.build_graph(G.with_weekly_graph(tx_of(spark, sf)))
    labels = propagate_labels(graph, kernel_arcs=0)
    return named_nodes(graph, labels).select("graph_id", "ntype", "id", "label")


@query
def rings_daily(spark, sf):
    return _ring_columns(R.rank_rings(_daily_rings(spark, sf)[0]))


@query
def rings_weekly_top(spark, sf):
    """The weekly report: whole weeks as graphs, top 25 rings by risk."""
    found, _ = R.detect_rings(G.build_graph(G.with_weekly_graph(tx_of(spark, sf))))
    top = R.top_rings(found)
    return top.select(
        "graph_id",
        "ring_id",
        "size",
        *[F.round(c, 9).alias(c) for c in ("shared_device_ratio", "density", "risk_score")],
    )


@query
def ring_members(spark, sf):
    _, members = _daily_rings(spark, sf)
    return members


@query
def rings_distinct(spark, sf):
    found, members = _daily_rings(spark, sf)
    return R.distinct_rings(found, members).select("graph_id", "ring_id", "size")


@query
def ring_documents(spark, sf):
    """Distinct rings with their accounts and merchants, ten of a type to a row."""
    found, members = _daily_rings(spark, sf)
    rows = R.ring_documents(R.distinct_rings(found, members), members, page=10)
    joined = [F.array_join(c, ",").alias(c) for c in ("accounts", "merchants")]
    return rows.select("graph_id", "ring_id", "size", "page", *joined)


@query
def account_rings(spark, sf):
    return R.account_rings(_daily_rings(spark, sf)[1])


@query
def rings_busiest_hour(spark, sf):
    """Communities of the busiest hour, of any size, as ring rows."""
    tx = hourly(spark, sf)
    top = R.busiest_graph(tx.groupBy("graph_id").agg(F.count("*").alias("n_tx")))
    busiest = tx.join(top.select("graph_id"), "graph_id", "left_semi")
    graph = G.build_graph(busiest)
    found, _ = R.detect_rings(graph, min_accounts=1)
    return _ring_columns(found.orderBy(F.desc("risk_score"), "ring_id").limit(10))


@query
def ring_spike(spark, sf):
    found, _ = _daily_rings(spark, sf)
    return MO.ring_spike(MO.ring_counts(found), threshold=1, step_seconds=DAY * 60)


# --- micro-batches -----------------------------------------------------------


def _batched(spark, sf, size=BATCH):
    return B.micro_batches(B.first_occurrence(tx_of(spark, sf)), size)


def _window_graphs(batched):
    """The graph of every batch's sliding window."""
    return SN.window_graphs(freeze(PA.sliding_edges(batched, B.batch_windows(batched))))


@query
def micro_batches(spark, sf):
    return _batched(spark, sf).select("tx_id", "batch_id")


@query
def batch_watermarks(spark, sf):
    return B.running_watermark(B.batch_windows(_batched(spark, sf)))


@query
def batch_progress(spark, sf):
    """Bounds, events and rings of every batch's window."""
    batched = freeze(_batched(spark, sf))
    found, _ = R.detect_rings(_window_graphs(batched))
    return B.batch_progress(B.batch_windows(batched), found)


@query
def window_members(spark, sf):
    batched = freeze(_batched(spark, sf).select("tx_id", "event_time", "batch_id"))
    members = B.window_members(batched.drop("batch_id"), B.batch_windows(batched))
    return members.select("batch_id", "tx_id")


@query
def outside_window(spark, sf):
    batched = freeze(_batched(spark, sf).select("tx_id", "event_time", "batch_id"))
    return B.outside_window(batched, B.batch_windows(batched))


@query
def batch_degree_features(spark, sf):
    """Features of each batch on the graph of its sliding window (pipeline semantics)."""
    batched = freeze(_batched(spark, sf))
    versions = PA.sliding_edges(batched, B.batch_windows(batched))
    ends = freeze(PA.sliding_degrees(versions, batched))
    fresh = batched.withColumnRenamed("batch_id", "graph_id")
    metrics = ends.withColumn("pagerank", F.lit(0.0)).withColumn("betweenness", F.lit(0.0))
    metrics = metrics.withColumn("component_size", F.lit(1))
    return FE.assemble_graph_features(fresh, metrics).select(
        "graph_id",
        "tx_id",
        "account_degree",
        "device_degree",
        "merchant_degree",
        "velocity_ring_score",
        "unique_devices_per_account",
        "unique_merchants_per_account",
    )


@query
def batch_graph_features(spark, sf):
    """All 15 features of each batch on the graph of its sliding window; windows overlap."""
    batched = freeze(_batched(spark, sf, SMALL_BATCH))
    versions = freeze(PA.sliding_edges(batched, B.batch_windows(batched)))
    features = SN.window_features(batched, versions)
    real = [c for c, t in features.dtypes if t == "double"]
    return features.select(
        *[F.round(c, 9).alias(c) if c in real else F.col(c) for c in features.columns]
    )


def _halves(log):
    """The log before and from the middle of its time span, which is read from the data."""
    span = log.agg(
        F.expr("(min(unix_micros(event_time)) + max(unix_micros(event_time))) div 2").alias("m")
    ).scalar()
    at = F.expr("unix_micros(event_time)")
    return log.where(at < span), log.where(at >= span)


def _delivered_twice(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet")
    return items.unionByName(items.where("l_returnflag = 'R'"))


@query
def batch_overlap(spark, sf):
    """Transactions that appear in more than one batch: those delivered again to the next one."""
    batched = _batched(spark, sf).select("tx_id", "batch_id", "is_fraud")
    again = batched.where("is_fraud = 1").withColumn("batch_id", F.col("batch_id") + 1)
    per_tx = batched.unionByName(again).groupBy("tx_id").agg(F.countDistinct("batch_id").alias("n"))
    return per_tx.agg(F.count_if(F.col("n") > 1).alias("n_overlap"))


@query
def unseen_events(spark, sf):
    """The whole log delivered again after its first half was processed."""
    tx = tx_of(spark, sf)
    early, _ = _halves(tx)
    return B.unseen(tx, early).select("tx_id")


# --- serving -----------------------------------------------------------------


def _versions(spark, sf):
    """Vectors written by two passes: hourly windows, then daily ones."""
    first = FE.degree_features(hourly(spark, sf)).withColumn("batch_id", F.lit(0).cast("bigint"))
    second = FE.degree_features(daily(spark, sf)).withColumn("batch_id", F.lit(1).cast("bigint"))
    return first.unionByName(second).drop("graph_id")


@query
def latest_vectors(spark, sf):
    return S.latest_vectors(_versions(spark, sf))


@query
def online_lookup(spark, sf):
    """Latest vectors of all transactions of the accounts seen on the busiest device."""
    tx = tx_of(spark, sf)
    device = R.busiest_graph(
        tx.groupBy(F.col("device_id").substr(2, 6).cast("bigint").alias("graph_id")).agg(
            F.count("*").alias("n_tx")
        )
    )
    keys = tx.withColumn("graph_id", F.col("device_id").substr(2, 6).cast("bigint")).join(
        device.select("graph_id"), "graph_id", "left_semi"
    )
    return S.lookup(S.latest_vectors(_versions(spark, sf)), keys)


@query
def feature_payload(spark, sf):
    """The payload map of every transaction, flattened to rows."""
    mapped = S.payload(FE.tabular_features(tx_of(spark, sf)))
    return mapped.select("tx_id", F.explode("features").alias("name", "value")).withColumn(
        "value", F.round("value", 9)
    )


@query
def parity_mismatches(spark, sf):
    """Training vectors against the online view, in which some vectors are stale or missing.

    A second version of the fraud rows has other amounts, and the DEBIT rows never arrived.
    """
    tx = tx_of(spark, sf)
    training = FE.tabular_features(tx)
    arrived = training.join(tx.where("tx_type <> 'DEBIT'").select("tx_id"), "tx_id", "left_semi")
    first = arrived.withColumn("batch_id", F.lit(0).cast("bigint"))
    stale = arrived.join(tx.where("is_fraud = 1").select("tx_id"), "tx_id", "left_semi")
    second = stale.withColumn("amount", F.col("amount") + 1).withColumn("batch_id", F.lit(1).cast("bigint"))
    served = S.latest_vectors(first.unionByName(second))
    return S.parity_mismatches(training, served.drop("batch_id")).agg(
        F.count("*").alias("n_mismatches")
    )


@query
def online_parity(spark, sf):
    """As parity_mismatches, over all 20 columns and through the written store, one batch retried."""
    tx = hourly(spark, sf)
    training = freeze(FE.feature_matrix(tx, FE.graph_features(tx)).select("tx_id", *TABULAR_FEATURES, *GRAPH_FEATURES))
    ensure_checkpoint_dir(spark)
    store = f"{spark.sparkContext.getCheckpointDir()}/online-{uuid.uuid4().hex}"
    arrived = training.join(tx.where("tx_type <> 'DEBIT'").select("tx_id"), "tx_id", "left_semi")
    stale = arrived.join(tx.where("is_fraud = 1").select("tx_id"), "tx_id", "left_semi")
    second = stale.withColumn("account_pagerank", F.col("account_pagerank") + 1)
    upsert_batch(arrived, store, 0)
    upsert_batch(arrived, store, 1)
    upsert_batch(second, store, 1)  # the retry replaces what the failed attempt wrote
    served = online_view(spark, store).drop("batch_id")
    return S.parity_mismatches(training, served).groupBy("side").agg(F.count("*").alias("n_mismatches"))


# --- scoring, cases, metrics -------------------------------------------------


@query
def scored_rule(spark, sf):
    return scored_of(spark, sf).select(
        "tx_id",
        "account_id",
        "device_id",
        "merchant_id",
        "amount",
        "fraud_score",
        "decision",
        "is_high_risk",
        F.col("is_fraud_label").cast("bigint").alias("is_fraud_label"),
    )


@query
def not_approved(spark, sf):
    scored = scored_of(spark, sf)
    return scored.where(F.col("decision") != "approve").select("tx_id", "decision")


@query
def score_blend(spark, sf):
    """Mean of two members; one alone where the other has no score."""
    first, second = F.col("amount") / 400.0, F.when(F.col("channel") != "atm", rule_score(300.0))
    from txgraph.ml.score import blend

    return tx_of(spark, sf).select(
        "tx_id", F.round(blend(F.least(F.lit(1.0), first), second), 9).alias("fraud_score")
    )


@query
def alerts(spark, sf):
    return I.alerts(scored_of(spark, sf))


@query
def top_cases(spark, sf):
    return I.top_cases(scored_of(spark, sf)).select(
        "tx_id", "account_id", "fraud_score", "decision"
    )


@query
def narratives(spark, sf):
    """Top cases on daily windows with ring evidence, action, confidence and text."""
    tx = daily(spark, sf)
    graph = G.build_graph(tx)
    found, members = R.detect_rings(graph)
    parts = connected_components(graph)
    sized = parts.join(component_sizes(parts), ["graph_id", "component"])
    metrics = (
        graph.vertices.join(sized, ["graph_id", "node"])
        .withColumn("pagerank", F.lit(0.0))
        .withColumn("betweenness", F.lit(0.0))
    )
    features = FE.assemble_graph_features(tx, metrics, graph.busy)
    rings = members.where("ntype = 'account'").withColumnRenamed("id", "account_id")
    cases = I.investigate(I.route(tx, rule_score()), features, rings, found)
    return cases.withColumn("confidence", F.round("confidence", 9))


def _round_rates(df: DataFrame) -> DataFrame:
    real = [c for c, t in df.dtypes if t == "double"]
    return df.select(*[F.round(c, 9).alias(c) if c in real else F.col(c) for c in df.columns])


@query
def run_metrics(spark, sf):
    return _round_rates(M.run_metrics(scored_of(spark, sf)))


@query
def metrics_hourly(spark, sf):
    return _round_rates(MO.metrics_by_window(scored_of(spark, sf)))


def _labelled(spark, sf):
    # Whole amounts give many ties.
    return tx_of(spark, sf).select(
        F.floor("amount").cast("double").alias("score"), F.col("is_fraud").alias("label"), "channel"
    )


@query
def roc_auc(spark, sf):
    return _round_rates(M.roc_auc(_labelled(spark, sf)))


@query
def roc_auc_by_channel(spark, sf):
    return _round_rates(M.roc_auc(_labelled(spark, sf), by=["channel"]))


@query
def average_precision(spark, sf):
    return _round_rates(M.average_precision(_labelled(spark, sf)))


@query
def roc_points(spark, sf):
    return _round_rates(M.roc_points(_labelled(spark, sf)))


@query
def class_weight(spark, sf):
    return _round_rates(M.class_weight(tx_of(spark, sf)))


@query
def stratified_split(spark, sf):
    tx = tx_of(spark, sf)
    number = F.substring("tx_id", 2, 9).cast("bigint")
    keyed = tx.select("tx_id", "is_fraud", SP.hash_bucket(number).alias("bucket"))
    return SP.stratified_split(keyed, "is_fraud", ["bucket", "tx_id"], 0.25).select(
        "tx_id", F.col("is_fraud").cast("bigint").alias("is_fraud"), "is_test"
    )


@query
def promotion_gate(spark, sf):
    champion = scored_of(spark, sf).withColumn("role", F.lit("champion"))
    challenger = scored_of(spark, sf, 150.0).withColumn("role", F.lit("challenger"))
    return _round_rates(M.promotion_gate(champion.unionByName(challenger)))


def _importance(spark, sf):
    """Importance of a feature = absolute correlation with the label."""
    tx = hourly(spark, sf)
    matrix = FE.with_labels(FE.feature_matrix(tx, FE.degree_features(tx)), tx)
    names = [c for c in TABULAR_FEATURES + GRAPH_FEATURES if c in matrix.columns]
    wide = matrix.agg(
        *[F.abs(F.corr(F.col(c).cast("double"), F.col("is_fraud"))).alias(c) for c in names]
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(i).alias("position"), F.col(c).alias("importance")
        )
        for i, c in enumerate(names)
    ]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


@query
def importance_share(spark, sf):
    return _round_rates(M.importance_share(_importance(spark, sf), GRAPH_FEATURES))


@query
def top_graph_features(spark, sf):
    top = M.top_importance(_importance(spark, sf), 5, GRAPH_FEATURES)
    return _round_rates(top.select("feature", "importance"))


# --- drift -------------------------------------------------------------------


def _score_log(spark, sf):
    return scored_of(spark, sf).select("event_time", F.col("raw_score").alias("score"))


@query
def psi_scores(spark, sf):
    log = _score_log(spark, sf)
    return _round_rates(D.psi(*_halves(log), "score"))


@query
def psi_daily(spark, sf):
    log = _score_log(spark, sf)
    day = F.date_format("event_time", "yyyy-MM-dd").alias("day")
    reference, current = _halves(log)
    return _round_rates(D.psi(reference, current.select(day, "score"), "score", by=["day"]))


# --- profile -----------------------------------------------------------------


@query
def null_counts(spark, sf):
    return P.null_counts(tx_of(spark, sf))


@query
def duplicate_rows(spark, sf):
    """Repeated whole rows of the line items, of which returned ones are delivered twice."""
    return P.duplicate_rows(_delivered_twice(spark, sf))


@query
def distinct_rows(spark, sf):
    """Lines and value per order once repeated whole rows are dropped."""
    rows = P.drop_duplicate_rows(_delivered_twice(spark, sf))
    return rows.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 6).alias("price")
    )


@query
def profile_numeric(spark, sf):
    return _round_rates(P.numeric_profile(tx_of(spark, sf)))


@query
def profile_categorical(spark, sf):
    return P.categorical_profile(tx_of(spark, sf))


@query
def class_balance(spark, sf):
    return _round_rates(
        P.shares(tx_of(spark, sf).select(F.col("is_fraud").cast("bigint").alias("is_fraud")), "is_fraud")
    )


@query
def rate_by_type(spark, sf):
    return _round_rates(P.rate_by(tx_of(spark, sf), "tx_type"))


@query
def freq_by_channel(spark, sf):
    return P.frequencies(tx_of(spark, sf), "channel")


@query
def busiest_window(spark, sf):
    counted = hourly(spark, sf).groupBy("graph_id").agg(F.count("*").alias("n_tx"))
    return R.busiest_graph(counted)


@query
def hist_amount(spark, sf):
    return _round_rates(P.histogram(tx_of(spark, sf), F.col("amount")))


@query
def hist_amount_log(spark, sf):
    tx = tx_of(spark, sf).where("amount > 0")
    return _round_rates(P.histogram(tx, F.log10("amount")))


@query
def hist_score_by_class(spark, sf):
    scored = scored_of(spark, sf).withColumn("label", F.col("is_fraud_label").cast("bigint"))
    return _round_rates(P.class_histogram(scored, F.col("raw_score"), "label"))


@query
def density_by_class(spark, sf):
    tx = tx_of(spark, sf).where("amount > 0")
    out = P.kernel_density(tx, F.log10("amount"), "is_fraud")
    return _round_rates(
        out.select(
            F.col("class").cast("bigint").alias("class"),
            F.col("point").cast("bigint").alias("point"),
            "x",
            "density",
        )
    )


@query
def class_separation(spark, sf):
    tx = hourly(spark, sf)
    features = FE.degree_features(tx)
    matrix = FE.with_labels(features, tx)
    names = [c for c in GRAPH_FEATURES if c in features.columns]
    return _round_rates(P.class_separation(matrix, names))


@query
def dq_violations(spark, sf):
    return Q.violations(tx_of(spark, sf))


# --- monitoring --------------------------------------------------------------


@query
def throughput_1m(spark, sf):
    return _round_rates(MO.throughput(tx_of(spark, sf)))


@query
def flag_rate_by_channel(spark, sf):
    return _round_rates(MO.flag_rate_by_channel(scored_of(spark, sf)))


@query
def highest_scores(spark, sf):
    """Ten highest scores, whatever their routing."""
    return (
        scored_of(spark, sf)
        .orderBy(F.desc("raw_score"), "tx_id")
        .limit(10)
        .select("tx_id", F.round("raw_score", 9).alias("score"), "decision")
    )


@query
def alert_episodes(spark, sf):
    """False-positive-rate episodes over hourly samples."""
    samples = MO.metrics_by_window(scored_of(spark, sf)).select(
        F.lit("fraud_false_positive_rate").alias("metric"),
        F.col("graph_id").alias("at"),
        F.col("false_positive_rate").alias("value"),
    )
    return MO.alert_episodes(samples, MO.alert_rules(spark), step_minutes=60)


@query
def batch_lag(spark, sf):
    """Watermark lag if every batch were ingested when the next one begins."""
    windows = B.batch_windows(_batched(spark, sf))
    marks = B.running_watermark(windows)
    following = marks.select(
        (F.col("batch_id") - 1).alias("batch_id"), F.col("watermark").alias("ingested")
    )
    return MO.watermark_lag(marks.join(following, "batch_id")).select(
        "batch_id", F.round("lag_seconds", 6).alias("lag_seconds")
    )

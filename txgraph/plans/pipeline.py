"""End-to-end jobs: the batch pipeline, the notebook analysis and the scheduled jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from txgraph.ml.score import score_transactions
from txgraph.ml.train import TrainResult, boosted_trees, train_model
from txgraph.operators.batches import batch_progress, batch_windows, first_occurrence, micro_batches, window_members
from txgraph.operators.drift import psi
from txgraph.operators.features import (
    assemble_graph_features,
    feature_matrix,
    graph_features,
    node_metrics,
    with_labels,
)
from txgraph.operators.graph import build_graph, with_hourly_graph, with_weekly_graph
from txgraph.operators.investigate import alerts, investigate
from txgraph.operators.metrics import run_metrics, top_importance
from txgraph.operators.profile import class_separation, profile
from txgraph.operators.rings import busiest_graph, detect_rings, distinct_rings, ring_documents, top_rings
from txgraph.schema import GRAPH_FEATURES, MAX_CASES, MICRO_BATCH_SIZE, WINDOW_MINUTES, ModelParams
from txgraph.session import freeze
from txgraph.sinks.lake import lake_path, run_stamp, write_documents, write_metadata, write_model, write_scores
from txgraph.sinks.messages import keyed_messages, publish


@dataclass
class Materialised:
    """What one pass over the stream yields: vectors, rings and progress of every batch."""

    tx: DataFrame
    windows: DataFrame
    features: DataFrame
    matrix: DataFrame
    rings: DataFrame
    ring_members: DataFrame


def materialise(
    log: DataFrame,
    batch_size: int = MICRO_BATCH_SIZE,
    window_minutes: int = WINDOW_MINUTES,
    **metric_args,
) -> Materialised:
    """Batches, their sliding-window graphs, features and rings, all batches in one job."""
    batched = freeze(micro_batches(first_occurrence(log), batch_size))
    windows = freeze(batch_windows(batched, window_minutes))
    members = window_members(batched.drop("batch_id"), windows, window_minutes)
    graph = build_graph(members.withColumnRenamed("batch_id", "graph_id"))
    tx = batched.withColumnRenamed("batch_id", "graph_id")
    metrics = freeze(node_metrics(graph, **metric_args))
    features = freeze(assemble_graph_features(tx, metrics, graph.busy))
    found, ring_rows = detect_rings(graph)
    return Materialised(
        tx, windows, features, freeze(feature_matrix(tx, features)), found, freeze(ring_rows)
    )


def run_pipeline(
    log: DataFrame,
    out: str,
    params: ModelParams = ModelParams(),
    batch_size: int = MICRO_BATCH_SIZE,
    window_minutes: int = WINDOW_MINUTES,
    max_cases: int = MAX_CASES,
    ring_scope: str = "own",
    stamp: str | None = None,
    build: Callable[[Sequence[str], ModelParams], Pipeline] = boosted_trees,
    **metric_args,
) -> dict:
    """Materialise, train, score, investigate and write; returns the run summary.

    ``build`` is the untrained model: ``boosted_trees`` or, averaged with a forest, ``two_members``.
    """
    spark = log.sparkSession
    stamp = stamp or run_stamp()
    done = materialise(log, batch_size, window_minutes, **metric_args)
    trained = train_model(with_labels(done.matrix, done.tx), params, build=build)
    scored = freeze(score_transactions(done.tx, done.matrix, trained.model))
    account_ring = done.ring_members.where("ntype = 'account'").withColumnRenamed(
        "id", "account_id"
    )
    cases = freeze(
        investigate(scored, done.features, account_ring, done.rings, max_cases, ring_scope)
    )
    write_scores(scored, out, stamp)
    rings = distinct_rings(done.rings, done.ring_members)
    write_documents(ring_documents(rings, done.ring_members), out, "rings", stamp)
    write_documents(cases, out, "narratives", stamp)
    write_documents(batch_progress(done.windows, done.rings), out, "progress", stamp)
    publish(keyed_messages(alerts(scored)), path=lake_path(out, "alerts", stamp))
    model_path = write_model(trained.model, out, stamp)
    write_metadata(trained.metadata(spark), lake_path(out, "model_metadata", stamp))
    summary = summarise(scored, trained, model_path)
    write_documents(summary, out, "summary", stamp)
    return summary.first().asDict(recursive=True)


def summarise(scored: DataFrame, trained: TrainResult, model_path: str) -> DataFrame:
    """The one-row run summary."""
    top = top_importance(trained.importance_rows(scored.sparkSession), 10)
    gains = {row["feature"]: row["importance"] for row in top.collect()}
    pairs = [F.lit(x) for item in gains.items() for x in item]
    return run_metrics(scored).select(
        "transactions_scored",
        "true_fraud",
        "flagged",
        "fraud_caught",
        "detection_rate",
        "false_positive_rate",
        "fpr_true",
        F.lit(trained.auc_tabular).alias("auc_tabular"),
        F.lit(trained.auc_graph).alias("auc_graph"),
        F.lit(trained.auc_uplift).alias("auc_uplift"),
        F.create_map(*pairs).alias("top_features"),
        F.lit(model_path).alias("model_path"),
    )


def notebook_analysis(tx: DataFrame, params: ModelParams = ModelParams()) -> dict[str, object]:
    """Profile, hourly graph features, class separation, busiest-hour rings, models."""
    hourly = with_hourly_graph(tx)
    graph = build_graph(hourly)
    features = freeze(graph_features(hourly, graph=graph))
    labelled = freeze(with_labels(feature_matrix(hourly, features), hourly))
    top = busiest_graph(hourly.groupBy("graph_id").agg(F.count("*").alias("n_tx")))
    busiest = hourly.join(top.select("graph_id"), "graph_id", "left_semi")
    found, _ = detect_rings(build_graph(busiest))
    return {
        "profile": profile(tx),
        "separation": class_separation(labelled, GRAPH_FEATURES),
        "rings": found.orderBy(F.desc("risk_score"), "ring_id").limit(10),
        "training": train_model(labelled, params),
    }


def retrain(matrix: DataFrame, tx: DataFrame, out: str, params: ModelParams, stamp: str) -> dict:
    """Daily job: fit on the materialised vectors, persist the model and its metadata."""
    trained = train_model(with_labels(matrix, tx), params)
    path = write_model(trained.model, out, stamp)
    metadata = trained.metadata(matrix.sparkSession)
    write_metadata(metadata, lake_path(out, "model_metadata", stamp))
    return {
        "auc_tabular": trained.auc_tabular,
        "auc_graph": trained.auc_graph,
        "auc_uplift": trained.auc_uplift,
        "model_path": path,
    }


def weekly_rings(tx: DataFrame, out: str | None = None, stamp: str | None = None) -> DataFrame:
    """Weekly job: rings of whole weeks, the top 25 by risk."""
    found, _ = detect_rings(build_graph(with_weekly_graph(tx)))
    report = top_rings(found)
    if out:
        write_documents(report, out, "weekly_rings", stamp or run_stamp())
    return report


def drift_check(reference: DataFrame, current: DataFrame, score: str = "fraud_score") -> DataFrame:
    """Hourly job: PSI and verdict of the current scores."""
    return psi(reference, current, score)


def load_and_score(tx: DataFrame, matrix: DataFrame, path: str) -> DataFrame:
    """Score with a persisted model."""
    return score_transactions(tx, matrix, PipelineModel.load(path))

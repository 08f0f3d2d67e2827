"""Operational metrics over scored streams, and alert episodes over metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from txgraph.operators.metrics import run_metrics
from txgraph.operators.prefix import running

# Alert, metric, threshold, minutes it must hold, severity, route.
ALERT_RULES = [
    ("HighFalsePositiveRate", "fraud_false_positive_rate", 0.15, 10, "warning", "slack"),
    ("ModelScoreDrift", "fraud_score_psi", 0.2, 15, "critical", "pagerduty"),
    ("StreamingLagHigh", "spark_streaming_watermark_lag_seconds", 120.0, 5, "critical", "pagerduty"),
    ("FraudRingSpike", "fraud_rings_detected_increase_1h", 25.0, 0, "warning", "slack"),
]


def alert_rules(spark: SparkSession, rules: Sequence[tuple] = ALERT_RULES) -> DataFrame:
    return spark.createDataFrame(
        list(rules),
        "alert string, metric string, threshold double, hold_minutes int,"
        " severity string, route string",
    )


def throughput(tx: DataFrame) -> DataFrame:
    """Transactions per second, by minute."""
    minute = F.unix_timestamp(F.date_trunc("minute", "event_time")).alias("minute")
    return tx.groupBy(minute).agg(
        F.count("*").alias("n"), (F.count("*") / F.lit(60.0)).alias("tps")
    )


def flag_rate_by_channel(scored: DataFrame) -> DataFrame:
    """Flagged per second by channel over 5-minute windows that slide by one minute.

    Flags are counted per minute first, so a row is not copied into all five windows.
    """
    minute = F.unix_timestamp(F.date_trunc("minute", "event_time")).alias("minute")
    per_minute = scored.groupBy("channel", minute).agg(
        F.count_if(F.col("decision") != "approve").alias("n")
    )
    starts = F.explode(F.expr("transform(sequence(0, 4), i -> minute - i * 60)"))
    return (
        per_minute.select("channel", "n", starts.alias("window_start"))
        .groupBy("channel", "window_start")
        .agg(
            F.sum("n").cast("bigint").alias("flagged"),
            (F.sum("n") / F.lit(300.0)).alias("flag_rate"),
        )
    )


def metrics_by_window(scored: DataFrame) -> DataFrame:
    """Detection and false-positive gauges per window of the scored rows."""
    return run_metrics(scored, ["graph_id"])


def ring_counts(rings: DataFrame) -> DataFrame:
    return rings.groupBy("graph_id").agg(F.count("*").alias("n_rings"))


def ring_spike(
    counts: DataFrame, threshold: float = 25, step_seconds: int = 3600
) -> DataFrame:
    """Increase of the ring gauge against the window before (0 if there is none)."""
    before = counts.select(
        (F.col("graph_id") + step_seconds).alias("graph_id"), F.col("n_rings").alias("n_before")
    )
    increase = F.col("n_rings") - F.coalesce("n_before", F.lit(0))
    return counts.join(before, "graph_id", "left").select(
        "graph_id", "n_rings", increase.alias("increase"), (increase > threshold).alias("spike")
    )


def watermark_lag(batches: DataFrame) -> DataFrame:
    """Seconds by which the running watermark trails the ingest time (micros columns)."""
    lag = (F.col("ingested") - F.col("running_watermark")) / F.lit(1e6)
    return batches.withColumn("lag_seconds", lag)


def alert_episodes(
    samples: DataFrame, rules: DataFrame, step_minutes: int = 1
) -> DataFrame:
    """Stretches in which a rule's predicate held at least as long as it must.

    ``samples``: metric, at (epoch seconds of an evaluation step), value; one row per step.
    A missing step ends a stretch. Columns: alert, severity, route, started, ended, minutes.

    Positions come from a distributed running count, so no task holds all steps of an alert.
    ``streaming.episodes`` does the same on a live stream.
    """
    step = step_minutes * 60
    breached = samples.join(F.broadcast(rules), "metric").where("value > threshold")
    key = ["alert", "severity", "route", "hold_minutes"]
    placed = running(breached.select(*key, "at"), ["at"], ["alert"], position="nth")
    # Consecutive steps share (step number - position).
    island = F.col("at") / step - F.col("nth")
    return (
        placed.withColumn("island", island)
        .groupBy(*key, "island")
        .agg(F.min("at").alias("started"), F.max("at").alias("ended"))
        .withColumn("minutes", ((F.col("ended") - F.col("started")) / 60).cast("bigint"))
        .where("minutes >= hold_minutes")
        .select("alert", "severity", "route", "started", "ended", "minutes")
    )

"""Case selection, evidence and narratives as one query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txgraph.functions.scalars import action_text, confidence, decision, is_high_risk
from txgraph.functions.text import narrative
from txgraph.schema import MAX_CASES


def route(tx: DataFrame, score: Column, digits: int = 4) -> DataFrame:
    """Scored rows. Routing uses the full score; the rounded one is for display."""
    label = F.col("is_fraud") if "is_fraud" in tx.columns else F.lit(0)
    carried = [c for c in ("graph_id", "batch_id", "event_time", "channel") if c in tx.columns]
    return tx.select(
        "tx_id",
        "account_id",
        "device_id",
        "merchant_id",
        F.col("amount").cast("double").alias("amount"),
        F.round(score, digits).alias("fraud_score"),
        decision(score).alias("decision"),
        is_high_risk(score).alias("is_high_risk"),
        label.cast("int").alias("is_fraud_label"),
        *carried,
        score.alias("raw_score"),
    )


def alerts(scored: DataFrame) -> DataFrame:
    return scored.where("is_high_risk").select(
        "tx_id", "account_id", "fraud_score", "decision"
    )


def top_cases(scored: DataFrame, n: int = MAX_CASES) -> DataFrame:
    """The N highest scores among high-risk rows; ties by ``tx_id``."""
    return scored.where("is_high_risk").orderBy(F.desc("fraud_score"), "tx_id").limit(n)


def investigate(
    scored: DataFrame,
    features: DataFrame,
    account_ring: DataFrame,
    rings: DataFrame,
    n: int = MAX_CASES,
    ring_scope: str = "own",
) -> DataFrame:
    """Narratives for the top cases.

    ``features``: tx_id with the evidence columns. ``account_ring``: graph_id, ring_id,
    account_id in long form. ``rings``: scores by (graph_id, ring_id).
    ``ring_scope="own"`` cites the ring of the case's own graph, ``"last"`` the account's
    latest ring of any graph. Cases are cut to N rows first, so every join has a tiny side.
    """
    cases = F.broadcast(top_cases(scored, n))
    ring_columns = rings.select(
        "graph_id", "ring_id", "size", "shared_device_ratio", "risk_score"
    )
    on = ["account_id"] if ring_scope == "last" else ["account_id", "graph_id"]
    named = account_ring.join(cases.select("account_id").distinct(), "account_id", "left_semi")
    if ring_scope == "last":
        named = (
            named.groupBy("account_id")
            .agg(F.max(F.struct("graph_id", "ring_id")).alias("r"))
            .select("account_id", "r.*")
        )
    cited = named.join(ring_columns, ["graph_id", "ring_id"]).select(
        *on,
        F.struct("ring_id", "size", "shared_device_ratio", "risk_score").alias("ring"),
    )
    facts = features.join(cases.select("tx_id"), "tx_id", "left_semi").select(
        "tx_id",
        F.col("velocity_ring_score").alias("velocity"),
        F.col("unique_devices_per_account").alias("unique_devices"),
        "device_degree",
        "component_size",
    )
    evidence_columns = ["velocity", "unique_devices", "device_degree", "component_size"]
    joined = cases.join(facts, "tx_id", "left").join(cited, on, "left")
    return with_narrative(
        joined.select(
            "tx_id",
            "account_id",
            "device_id",
            "merchant_id",
            "amount",
            "fraud_score",
            "decision",
            *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c) for c in evidence_columns],
            "ring",
        )
    )


def with_narrative(cases: DataFrame) -> DataFrame:
    """The narrative record of cases that carry their evidence columns and ``ring``."""
    return (
        cases.withColumn("evidence", F.struct(*cases.columns))
        .withColumn("narrative", narrative("evidence"))
        .select(
            "tx_id",
            "account_id",
            "fraud_score",
            "decision",
            action_text(F.col("decision")).alias("recommended_action"),
            confidence(F.col("fraud_score"), F.col("ring.risk_score")).alias("confidence"),
            F.col("ring.ring_id").alias("ring_id"),
            "narrative",
        )
    )

"""Classification metrics without moments of collected scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txgraph.functions.scalars import safe_ratio
from txgraph.operators.prefix import running
from txgraph.schema import PRECISION_GUARDRAIL


def run_metrics(scored: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """Counts and rates of a scored table, optionally per window.

    ``false_positive_rate`` is false positives over flagged rows; ``fpr_true`` divides by
    the legitimate rows.
    """
    flagged = F.col("decision") != "approve"
    fraud = F.col("is_fraud_label") == 1
    legit = F.col("is_fraud_label") == 0
    counted = scored.groupBy(*by).agg(
        F.count("*").alias("transactions_scored"),
        F.count_if(fraud).alias("true_fraud"),
        F.count_if(flagged).alias("flagged"),
        F.count_if(flagged & fraud).alias("fraud_caught"),
        F.count_if(flagged & legit).alias("false_positives"),
        F.count_if(legit).alias("legitimate"),
    )
    return (
        counted.withColumn(
            "detection_rate", safe_ratio(F.col("fraud_caught"), F.col("true_fraud"))
        )
        .withColumn(
            "false_positive_rate", safe_ratio(F.col("false_positives"), F.col("flagged"))
        )
        .withColumn("fpr_true", safe_ratio(F.col("false_positives"), F.col("legitimate")))
        .drop("false_positives", "legitimate")
    )


def class_weight(labels: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Positive share and the negatives-per-positive weight."""
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return labels.agg(
        neg.alias("negatives"),
        pos.alias("positives"),
        safe_ratio(neg, pos).alias("scale_pos_weight"),
        F.avg(label).alias("fraud_rate"),
    )


def threshold_counts(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Per distinct score: positives and negatives at it and at all higher scores.

    Ties collapse in the first aggregate, then one distributed running sum over the distinct
    scores replaces a global sort window.
    """
    levels = scored.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running(
        levels, [F.desc(score)], by, sums={"tp": F.col("pos"), "fp": F.col("neg")}
    )


def roc_auc(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve with ties counted half; null if a class is missing."""
    levels = threshold_counts(scored, score, label, by)
    # A negative at this score loses to every positive above it and ties with those at it.
    wins = F.col("neg") * ((F.col("tp") - F.col("pos")) + F.col("pos") * F.lit(0.5))
    pos, neg = F.sum("pos"), F.sum("neg")
    return levels.groupBy(*by).agg(
        pos.alias("positives"),
        neg.alias("negatives"),
        F.try_divide(F.sum(wins), (pos.cast("double") * neg)).alias("roc_auc"),
    )


def average_precision(
    scored: DataFrame, score: str = "score", label: str = "label", by: Sequence[str] = ()
) -> DataFrame:
    """Step-wise average precision: sum of recall gains times precision."""
    levels = threshold_counts(scored, score, label, by)
    gain = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return levels.groupBy(*by).agg(
        F.try_divide(F.sum(gain), F.sum("pos").cast("double")).alias("average_precision")
    )


def roc_points(
    scored: DataFrame, score: str = "score", label: str = "label"
) -> DataFrame:
    """One point per distinct threshold, plus the origin at an infinite threshold."""
    levels = threshold_counts(scored, score, label)
    totals = scored.agg(
        F.struct(
            F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")
        ).alias("t")
    )
    points = levels.withColumn("t", totals.scalar()).select(
        F.col(score).alias("threshold"),
        F.try_divide(F.col("fp"), F.col("t.n")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("t.p")).alias("tpr"),
    )
    origin = totals.select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def promotion_gate(scored: DataFrame, guardrail: float = PRECISION_GUARDRAIL) -> DataFrame:
    """Compare precision of ``champion`` and ``challenger`` rows (column ``role``)."""
    flagged = F.col("decision") != "approve"

    def precision(role: str) -> Column:
        mine = flagged & (F.col("role") == role)
        return safe_ratio(F.count_if(mine & (F.col("is_fraud_label") == 1)), F.count_if(mine))

    return (
        scored.agg(
            precision("champion").alias("champion_precision"),
            precision("challenger").alias("challenger_precision"),
        )
        .withColumn("delta", F.col("challenger_precision") - F.col("champion_precision"))
        .withColumn("promote", F.col("delta") >= -guardrail)
    )


def importance_share(importance: DataFrame, graph_features: Sequence[str]) -> DataFrame:
    """Share of total importance held by graph features; rows (feature, importance)."""
    is_graph = F.col("feature").isin(list(graph_features))
    total = F.sum("importance")
    share = F.coalesce(F.sum(F.when(is_graph, F.col("importance"))), F.lit(0.0)) / F.when(
        total == 0, 1.0
    ).otherwise(total)
    return importance.agg(share.alias("graph_share")).withColumn(
        "tabular_share", 1 - F.col("graph_share")
    )


def top_importance(
    importance: DataFrame, n: int, only: Sequence[str] | None = None
) -> DataFrame:
    """The N most important features; ties by their place in the feature order."""
    rows = importance if only is None else importance.where(F.col("feature").isin(list(only)))
    return rows.orderBy(F.desc("importance"), "position").limit(n)

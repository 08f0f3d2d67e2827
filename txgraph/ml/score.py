"""Scoring: model probabilities, blending and routing in one plan."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from txgraph.operators.investigate import route


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def blend(first: Column, second: Column) -> Column:
    """Even mean of two probabilities; either alone where the other is missing."""
    return F.coalesce((first + second) / 2.0, first, second)


def score_matrix(
    matrix: DataFrame, model: PipelineModel, second: PipelineModel | None = None
) -> DataFrame:
    """tx_id and raw_score for a feature matrix (batch or streaming)."""
    scored = model.transform(matrix).withColumn("__p1", positive_probability())
    scored = scored.select("__p1", *matrix.columns)
    if second is None:
        return scored.select("tx_id", F.col("__p1").alias("raw_score"))
    both = second.transform(scored).withColumn("__p2", positive_probability())
    return both.select("tx_id", blend(F.col("__p1"), F.col("__p2")).alias("raw_score"))


def score_transactions(
    tx: DataFrame, matrix: DataFrame, model: PipelineModel, second: PipelineModel | None = None
) -> DataFrame:
    """Routed scores of every transaction; rows without a vector score 0.0."""
    scores = score_matrix(matrix, model, second)
    joined = tx.join(scores, "tx_id", "left")
    return route(joined, F.coalesce("raw_score", F.lit(0.0)))

"""Persisted model artefacts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The one-row metadata document written beside a model."""
    return spark.read.option("multiLine", True).json(path)

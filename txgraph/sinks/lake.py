"""Run outputs in a data lake: any Hadoop file-system URI, partitioned by run stamp."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def run_stamp(at: datetime | None = None) -> str:
    return (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def lake_path(base: str, kind: str, stamp: str) -> str:
    """``base/kind/dt=stamp``."""
    return f"{base.rstrip('/')}/{kind}/dt={stamp}"


def write_scores(scored: DataFrame, base: str, stamp: str) -> str:
    path = lake_path(base, "scores", stamp)
    scored.write.mode("errorifexists").parquet(path)
    return path


def write_documents(df: DataFrame, base: str, kind: str, stamp: str) -> str:
    """Rings, narratives or a summary as JSON lines; arrays and structs stay nested."""
    path = lake_path(base, kind, stamp)
    df.write.mode("errorifexists").json(path)
    return path


def write_model(model: PipelineModel, base: str, stamp: str) -> str:
    path = lake_path(base, "models", stamp)
    model.write().overwrite().save(path)
    return path


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One-row model metadata beside the model."""
    metadata.write.mode("overwrite").json(path)

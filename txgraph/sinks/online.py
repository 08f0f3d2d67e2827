"""Append-only feature versions; the online view keeps the newest per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from txgraph.operators.serving import latest_vectors


def upsert_batch(matrix: DataFrame, base: str, batch_id: int) -> None:
    """Write the vectors of one batch; writing the same batch again replaces it."""
    matrix.write.mode("overwrite").parquet(f"{base.rstrip('/')}/batch_id={batch_id}")


def online_view(spark: SparkSession, base: str) -> DataFrame:
    """Latest vector per transaction over all batches written so far."""
    versions = spark.read.parquet(base)
    return latest_vectors(versions.withColumn("batch_id", F.col("batch_id").cast("bigint")))

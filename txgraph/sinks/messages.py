"""Key-value messages for alerts and events, to Kafka or a directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def keyed_messages(df: DataFrame, key: str = "account_id") -> DataFrame:
    """``key`` and the whole row as a JSON ``value``; timestamps keep their microseconds."""
    value = F.to_json(F.struct(*df.columns), {"timestampFormat": MICROS_FORMAT})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def publish(
    messages: DataFrame,
    *,
    kafka_servers: str | None = None,
    topic: str = "alerts",
    path: str | None = None,
) -> None:
    """Write messages; a failure fails the caller, so a streaming batch is retried."""
    if kafka_servers:
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", kafka_servers)
            .option("topic", topic)
            .save()
        )
    elif path:
        messages.write.mode("overwrite").json(path)
    else:
        raise ValueError("name Kafka servers or a directory")

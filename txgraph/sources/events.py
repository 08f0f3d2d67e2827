"""The transaction view over the driver's ``events`` table (see FIXTURES.md §3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Derive typed transactions, with a planted label, from generic events."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    device = F.pmod(F.col("user_id") * 7 + F.pmod(k, F.lit(3)) * 13, F.lit(97))

    def key(prefix: str, value, width: int):
        return F.concat(F.lit(prefix), F.lpad(value.cast("string"), width, "0"))

    tx_type = (
        F.when(F.col("event_type") == "purchase", "PAYMENT")
        .when(F.col("event_type") == "signup", "TRANSFER")
        .when(F.col("event_type") == "click", "CASH_OUT")
        .when(F.col("event_type") == "view", "DEBIT")
        .otherwise("CASH_IN")
    )
    slot = F.pmod(k, F.lit(4))
    channel = (
        F.when(slot == 0, "web").when(slot == 1, "mobile").when(slot == 2, "pos").otherwise("atm")
    )
    return events.select(
        key("T", F.col("event_id"), 9).alias("tx_id"),
        key("A", F.col("user_id"), 6).alias("account_id"),
        key("D", device, 6).alias("device_id"),
        key("M", k, 5).alias("merchant_id"),
        F.col("value").alias("amount"),
        tx_type.alias("tx_type"),
        channel.alias("channel"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when((device < 6) & (F.col("value") > 20), 1).otherwise(0).alias("is_fraud"),
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))

"""Data-quality rules over transactions, counted in one scan plus one key count."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from txgraph.operators.profile import unpivot
from txgraph.schema import CHANNEL_CODES, KEY_COLUMNS, TX_TYPE_CODES


def violations(tx: DataFrame) -> DataFrame:
    """rule, n_violations."""
    rules = {f"null_{name}": F.col(name).isNull() for name in KEY_COLUMNS}
    rules["negative_amount"] = F.col("amount") < 0
    rules["null_amount"] = F.col("amount").isNull()
    rules["unknown_tx_type"] = F.coalesce(~F.col("tx_type").isin(list(TX_TYPE_CODES)), F.lit(True))
    rules["unknown_channel"] = F.coalesce(~F.col("channel").isin(list(CHANNEL_CODES)), F.lit(True))
    counted = tx.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    repeated = (
        tx.where("tx_id is not null")
        .groupBy("tx_id")
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("value"))
        .select(F.lit("duplicate_tx_id").alias("column"), "value")
    )
    return (
        unpivot(counted, list(rules), "bigint")
        .unionByName(repeated)
        .withColumnsRenamed({"column": "rule", "value": "n_violations"})
    )

"""Schemas, feature contracts, enumerations and default parameters.

One place for everything that training, serving, batch and streaming must agree on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Enumeration codes, feature names and their order, thresholds, action texts, prefixes, sizes,
# event columns and model parameters.

TX_TYPE_CODES = {"PAYMENT": 0, "TRANSFER": 1, "CASH_OUT": 2, "DEBIT": 3, "CASH_IN": 4}
CHANNEL_CODES = {"web": 0, "mobile": 1, "pos": 2, "atm": 3}

TABULAR_FEATURES = ["amount", "amount_log", "tx_type_code", "channel_code", "hour_of_day"]

GRAPH_FEATURES = [
    "account_degree",
    "account_pagerank",
    "account_clustering_coef",
    "account_betweenness",
    "device_degree",
    "device_betweenness_centrality",
    "device_pagerank",
    "device_shared_account_count",
    "merchant_degree",
    "merchant_cluster_coefficient",
    "merchant_betweenness",
    "velocity_ring_score",
    "component_size",
    "unique_devices_per_account",
    "unique_merchants_per_account",
]

INTEGER_GRAPH_FEATURES = [
    "account_degree",
    "device_degree",
    "device_shared_account_count",
    "merchant_degree",
    "velocity_ring_score",
    "component_size",
    "unique_devices_per_account",
    "unique_merchants_per_account",
]

ALL_FEATURES = TABULAR_FEATURES + GRAPH_FEATURES

ACTION_TEXT = {
    "decline": "DECLINE the transaction and freeze the account pending review",
    "challenge": "CHALLENGE with step-up authentication (3-D Secure / OTP)",
    "approve": "APPROVE — risk below action threshold",
}

DECLINE_THRESHOLD = 0.85
CHALLENGE_THRESHOLD = 0.45
HIGH_RISK_THRESHOLD = 0.85

PSI_MODERATE = 0.1
PSI_SIGNIFICANT = 0.2
DRIFT_LABELS = ("stable", "moderate-shift", "significant-drift -> trigger retraining")

PRECISION_GUARDRAIL = 0.02
# Node types: the `ntype` value and the prefix of the namespaced node key.
NODE_PREFIX = {"account": "acct", "device": "dev", "merchant": "mer"}

WINDOW_MINUTES = 60
MICRO_BATCH_SIZE = 2000
MIN_RING_ACCOUNTS = 3
MAX_CASES = 10
TOP_RINGS = 25

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("tx_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("tx_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

LABELLED_SCHEMA = T.StructType(
    TRANSACTION_SCHEMA.fields + [T.StructField("is_fraud", T.IntegerType())]
)

KEY_COLUMNS = ["tx_id", "account_id", "device_id", "merchant_id"]


@dataclass(frozen=True)
class ModelParams:
    """Boosted-tree parameters; defaults are those of the scheduled pipeline."""

    trees: int = 300
    depth: int = 6
    learning_rate: float = 0.1
    row_share: float = 0.9
    column_share: float = 0.9
    test_share: float = 0.25
    seed: int = 42


# --- end of fixed values ----------------------------------------------------

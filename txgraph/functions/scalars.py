"""Column expressions shared by batch and streaming plans. All stay on the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from txgraph.schema import (
    ACTION_TEXT,
    CHALLENGE_THRESHOLD,
    CHANNEL_CODES,
    DECLINE_THRESHOLD,
    DRIFT_LABELS,
    HIGH_RISK_THRESHOLD,
    NODE_PREFIX,
    PSI_MODERATE,
    PSI_SIGNIFICANT,
    TX_TYPE_CODES,
)


def lookup(column: Column, table: Mapping, default=None) -> Column:
    """Map a column through a small literal table; other values give ``default``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), column)
    return found if default is None else F.coalesce(found, F.lit(default))


def tx_type_code(column: Column) -> Column:
    return lookup(column, TX_TYPE_CODES, 0)


def channel_code(column: Column) -> Column:
    return lookup(column, CHANNEL_CODES, 0)


def node_key(ntype: str, identifier: Column) -> Column:
    return F.concat(F.lit(NODE_PREFIX[ntype] + ":"), identifier)


def hour_start(ts: Column) -> Column:
    """Tumbling-hour graph id: epoch seconds of the start of the hour."""
    return F.unix_timestamp(F.date_trunc("hour", ts))


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def path_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def clock_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / max(1, denominator)``."""
    return numerator / F.greatest(F.lit(1), denominator)


def decision(score: Column) -> Column:
    return (
        F.when(score >= DECLINE_THRESHOLD, "decline")
        .when(score >= CHALLENGE_THRESHOLD, "challenge")
        .otherwise("approve")
    )


def is_high_risk(score: Column) -> Column:
    return score >= HIGH_RISK_THRESHOLD


def action_text(decided: Column) -> Column:
    return F.coalesce(lookup(decided, ACTION_TEXT), decided)


def drift_verdict(psi: Column) -> Column:
    stable, moderate, significant = DRIFT_LABELS
    return (
        F.when(psi < PSI_MODERATE, stable).when(psi < PSI_SIGNIFICANT, moderate).otherwise(significant)
    )


def shared_device_ratio(devices: Column, accounts: Column) -> Column:
    """``1 - min(1, devices / accounts)``: few devices for many accounts gives a high value."""
    return F.lit(1.0) - F.least(F.lit(1.0), devices / accounts)


def density(nodes: Column, edges: Column) -> Column:
    return F.when(nodes < 2, 0.0).otherwise(2.0 * edges / (nodes * (nodes - 1)))


def ring_risk(dens: Column, shared: Column) -> Column:
    return F.least(F.lit(1.0), 0.5 * dens + 0.5 * shared)


def confidence(score: Column, risk: Column) -> Column:
    """Model score, blended with the ring risk where the account is in a ring."""
    return F.when(risk.isNull(), score).otherwise(F.least(F.lit(1.0), 0.7 * score + 0.3 * risk))

"""Case narratives as one string expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from txgraph.functions.scalars import action_text


def _percent(column: Column, digits: int) -> Column:
    # Half-even first: the formatter alone would round 62.5 up.
    return F.format_string(f"%.{digits}f%%", F.bround(F.lit(100.0) * column, digits))


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value.cast("string"))


def narrative(evidence: str = "evidence") -> Column:
    """Narrative text from an evidence struct.

    The struct has tx_id, account_id, device_id, merchant_id, amount, fraud_score,
    decision, velocity, unique_devices, device_degree, component_size and a nullable
    ``ring`` struct of ring_id, size, shared_device_ratio and risk_score.
    """

    def e(name: str) -> Column:
        return F.col(f"{evidence}.{name}")

    # The wording and layout of the narrative.
    head = [
        _line("Fraud Investigation Summary - Transaction ", e("tx_id")),
        F.lit("=" * 60),
        _line("Account        : ", e("account_id")),
        _line("Device         : ", e("device_id")),
        _line("Merchant       : ", e("merchant_id")),
        F.concat(F.lit("Amount         : $"), F.format_string("%,.2f", e("amount"))),
        F.concat(F.lit("Fraud score    : "), _percent(e("fraud_score"), 2)),
        F.concat(F.lit("Recommendation : "), action_text(e("decision"))),
        F.lit(""),
        F.lit("Graph evidence:"),
        F.concat(_line("  - Account velocity in window : ", e("velocity")), F.lit(" transactions")),
        _line("  - Devices linked to account  : ", e("unique_devices")),
        F.concat(_line("  - Shared-device degree       : ", e("device_degree")), F.lit(" accounts")),
        F.concat(_line("  - Account graph component    : ", e("component_size")), F.lit(" nodes")),
    ]
    in_ring = [
        F.lit(""),
        F.lit("Coordinated fraud ring detected:"),
        _line("  - Ring id            : ", e("ring.ring_id")),
        _line("  - Accounts in ring   : ", e("ring.size")),
        F.concat(F.lit("  - Shared-device ratio: "), _percent(e("ring.shared_device_ratio"), 0)),
        F.concat(F.lit("  - Ring risk score    : "), _percent(e("ring.risk_score"), 2)),
        F.lit(
            "  - Interpretation     : multiple accounts sharing a small device pool and "
            "targeting the same merchants is a classic mule-ring cash-out pattern."
        ),
    ]
    no_ring = [
        F.lit(""),
        F.lit(
            "No coordinated ring membership detected for this account in the current window; "
            "risk is driven by transaction-level and velocity signals."
        ),
    ]
    return F.concat_ws(
        "\n",
        *head,
        F.when(e("ring").isNotNull(), F.concat_ws("\n", *in_ring)).otherwise(
            F.concat_ws("\n", *no_ring)
        ),
    )

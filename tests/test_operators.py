import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.fixtures import one_graph, shared_device_window, transactions
from txgraph.functions import scalars as X
from txgraph.functions.text import narrative
from txgraph.operators import batches as B
from txgraph.operators import profile as P
from txgraph.operators.drift import psi
from txgraph.operators.features import degree_features, tabular_features
from txgraph.operators.metrics import average_precision, promotion_gate, roc_auc
from txgraph.operators.monitor import alert_episodes, alert_rules
from txgraph.operators.prefix import exact_quantiles, running
from txgraph.operators.quality import violations
from txgraph.operators.serving import latest_vectors, parity_mismatches
from txgraph.operators.skew import lookup_join
from txgraph.sources.transactions import split_quarantine


def test_running_equals_a_plain_scan(spark):
    rng = random.Random(3)
    # Group 0 holds most of the rows and spans several ranges.
    rows = [(0 if rng.random() < 0.7 else rng.randrange(1, 5), i, rng.randrange(10)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, i int, v int")
    got = running(df, ["i"], ["g"], sums={"s": F.col("v")}, position="n").collect()
    want, state = {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        n, s = state.get(g, (0, 0))
        state[g] = want[(g, i)] = (n + 1, s + v)
    assert {(r.g, r.i): (r.n, r.s) for r in got} == want


def test_exact_quantiles(spark):
    rng = random.Random(4)
    values = [rng.choice([1.0, 2.5, rng.random() * 9]) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, "v", probs).first().quantiles
    assert got == pytest.approx(list(np.quantile(values, probs)))


def test_lookup_join_with_heavy_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 50), (3, 51)], "k int, i int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    heavy = spark.createDataFrame([(1,)], "k int")
    plain = lookup_join(left, right, ["k"])
    split = lookup_join(left, right, ["k"], heavy)
    assert split.count() == 52
    assert plain.select("k", "i", "v").exceptAll(split.select("k", "i", "v")).isEmpty()


def test_degree_features_with_busy_nodes(spark):
    tx = one_graph(shared_device_window(spark))
    plain, split = degree_features(tx), degree_features(tx, busy_min_rows=2)
    assert plain.exceptAll(split).isEmpty() and split.count() == 4


def test_unknown_categories_code_to_zero(spark):
    tx = shared_device_window(spark).withColumn("tx_type", F.lit("GIFT")).withColumn(
        "channel", F.lit(None).cast("string")
    )
    row = tabular_features(tx).first()
    assert (row.tx_type_code, row.channel_code) == (0, 0)
    found = {r.rule: r.n_violations for r in violations(tx).collect()}
    assert found["unknown_tx_type"] == 4 == found["unknown_channel"]
    assert found["duplicate_tx_id"] == 0


def test_batches_are_exactly_once_with_monotone_watermarks(spark):
    rng = random.Random(7)
    rows = [(f"T{i:04d}", "A1", "D1", "M1", 1.0, rng.randrange(20_000)) for i in range(1000)]
    tx = transactions(spark, rows + rows[:10])
    batched = B.micro_batches(B.first_occurrence(tx), 250)
    assert batched.count() == 1000 == batched.select("tx_id").distinct().count()
    sizes = [r["count"] for r in batched.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [250] * 4
    windows = B.batch_windows(batched)
    marks = [r.running_watermark for r in B.running_watermark(windows).orderBy("batch_id").collect()]
    assert marks == sorted(marks)
    members = B.window_members(batched.drop("batch_id"), windows).join(windows, "batch_id")
    at = X.micros(F.col("event_time"))
    assert members.where((at <= F.col("window_start")) | (at > F.col("window_end"))).isEmpty()


def test_psi(spark):
    rng = random.Random(1)
    ref = [round(rng.betavariate(2, 8), 2) for _ in range(2000)]
    cur = [round(rng.betavariate(2.5, 7), 2) for _ in range(2000)]

    def by_hand(reference, current):
        edges = np.quantile(reference, np.linspace(0, 1, 11))
        edges[0], edges[-1] = -np.inf, np.inf
        r = np.clip(np.histogram(reference, edges)[0] / len(reference), 1e-6, None)
        c = np.clip(np.histogram(current, edges)[0] / len(current), 1e-6, None)
        return float(np.sum((c - r) * np.log(c / r)))

    def frame(values):
        return spark.createDataFrame([(float(v),) for v in values], "s double")

    row = psi(frame(ref), frame(cur), "s").first()
    assert row.psi == pytest.approx(by_hand(ref, cur))
    # Repeated edges leave empty bins.
    spiky = [0.5] * 1500 + ref[:500]
    assert psi(frame(spiky), frame(cur), "s").first().psi == pytest.approx(by_hand(spiky, cur))


def test_ranking_metrics_with_ties(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(6) / 5, int(rng.random() < 0.4)) for _ in range(200)]
    df = spark.createDataFrame(rows, "score double, label int")
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert roc_auc(df).first().roc_auc == pytest.approx(wins / len(pos) / len(neg))
    want = 0.0
    for t in {s for s, _ in rows}:
        tp = sum(s >= t for s in pos)
        want += sum(s == t for s in pos) / len(pos) * tp / sum(s >= t for s, _ in rows)
    assert average_precision(df).first().average_precision == pytest.approx(want)
    assert roc_auc(df.where("label = 1")).first().roc_auc is None


def test_alert_must_hold(spark):
    metric = "spark_streaming_watermark_lag_seconds"
    data = [(metric, 60 * i, 150.0 if i in (1, 2, 5, 6, 7, 8, 9, 10) else 10.0) for i in range(15)]
    samples = spark.createDataFrame(data, "metric string, at bigint, value double")
    got = alert_episodes(samples, alert_rules(spark)).collect()
    assert [(r.alert, r.started, r.ended, r.minutes) for r in got] == [("StreamingLagHigh", 300, 600, 5)]


def test_promotion_gate_blocks_a_worse_challenger(spark):
    rows = [("champion", "decline", 1)] * 9 + [("champion", "decline", 0)]
    rows += [("challenger", "decline", 1)] * 8 + [("challenger", "challenge", 0)] * 2
    scored = spark.createDataFrame(rows, "role string, decision string, is_fraud_label int")
    row = promotion_gate(scored).first()
    assert row.delta == pytest.approx(-0.1) and row.promote is False


def test_last_write_wins_and_parity(spark):
    versions = spark.createDataFrame(
        [("T1", 0, 1.0), ("T1", 2, 3.0), ("T1", 1, 2.0), ("T2", 0, 9.0)],
        "tx_id string, batch_id bigint, amount double",
    )
    view = latest_vectors(versions)
    assert {r.tx_id: r.amount for r in view.collect()} == {"T1": 3.0, "T2": 9.0}
    assert parity_mismatches(view, view).isEmpty()
    assert parity_mismatches(view, view.where("tx_id = 'T1'")).first().side == "training"


def test_narrative_layout(spark):
    ring = "named_struct('ring_id', 2L, 'size', 8L, 'shared_device_ratio', 0.625D, 'risk_score', 0.58D)"
    base = (
        "named_struct('tx_id','T1','account_id','A1','device_id','D1','merchant_id','M1','amount',1234.5D,"
        "'fraud_score',0.9731D,'decision','decline','velocity',3,'unique_devices',1,'device_degree',4,"
        "'component_size',9,'ring',{}) as evidence"
    )
    text = spark.range(1).selectExpr(base.format(ring)).select(narrative().alias("n")).first().n
    lines = text.split("\n")
    assert lines[1] == "=" * 60 and len(lines) == 21
    assert lines[5] == "Amount         : $1,234.50"
    assert lines[6] == "Fraud score    : 97.31%"
    assert "Shared-device ratio: 62%" in text
    none = f"cast(null as struct<ring_id: bigint, size: bigint, shared_device_ratio: double, risk_score: double>)"
    text = spark.range(1).selectExpr(base.format(none)).select(narrative().alias("n")).first().n
    assert len(text.split("\n")) == 16 and "No coordinated ring" in text


def test_histograms_of_a_constant_column(spark):
    import numpy as np

    df = spark.createDataFrame([(5.0, 0), (5.0, 1), (5.0, 1), (None, 0)], "v double, label int")
    counts, edges = np.histogram([5.0] * 3, bins=60)
    want = [(i, pytest.approx(edges[i]), int(n)) for i, n in enumerate(counts) if n]
    assert [tuple(r) for r in P.histogram(df, F.col("v"), 60).collect()] == want
    rows = {r.label: r for r in P.class_histogram(df, F.col("v"), "label", 50).collect()}
    assert rows[0].n == 1 and rows[1].n == 2 and rows[1].density == pytest.approx(50.0)


def test_rows_without_event_time_are_quarantined(spark):
    rows = [("T1", "A", "D", "M", None), ("T2", "A", "D", "M", "2024-01-01"), ("T3", None, "D", "M", "2024-01-01")]
    names = "tx_id string, account_id string, device_id string, merchant_id string, t string"
    df = spark.createDataFrame(rows, names).withColumn("event_time", F.to_timestamp("t"))
    fit, rest = split_quarantine(df)
    assert [r.tx_id for r in fit.collect()] == ["T2"]
    assert sorted(r.tx_id for r in rest.collect()) == ["T1", "T3"]

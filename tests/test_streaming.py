import json
from pyspark.sql import functions as F

from tests.fixtures import transactions
from txgraph.functions.scalars import micros
from txgraph.schema import LABELLED_SCHEMA, TRANSACTION_SCHEMA
from txgraph.sinks.online import online_view
from txgraph.sources.transactions import parse_json, split_quarantine, stream_source
from txgraph.streaming.stream import (
    BatchScorer,
    LagListener,
    clean_stream,
    lag_seconds,
    quarantine_stream,
    run_scoring,
    throughput_stream,
    window_fanout,
)


def rows(first, n, step=60):
    """One event per ``step`` seconds, from event number ``first``."""
    return [
        (f"T{i:05d}", f"A{i % 7}", f"D{i % 3}", f"M{i % 5}", 20.0 + 13 * (i % 15), i * step, i % 2)
        for i in range(first, first + n)
    ]


def write(spark, path, data, name):
    transactions(spark, data).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def source(spark, path, files=1):
    return stream_source(
        spark, path=f"{path}/*", schema=LABELLED_SCHEMA, max_files=files
    )


def rule():
    return F.least(F.lit(1.0), F.col("amount") / 190.0)


def test_scores_survive_duplicates_and_restart(spark, tmp_path):
    landed, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    write(spark, landed, rows(0, 40) + rows(5, 5), "a")  # repeats inside a file
    write(spark, landed, rows(30, 30), "b")  # repeats across files
    scorer = BatchScorer(out, score=rule())
    run_scoring(clean_stream(source(spark, landed)), scorer, ck).awaitTermination()
    scores = spark.read.parquet(f"{out}/scores")
    assert scores.count() == 60 == scores.select("tx_id").distinct().count()
    # Restart with new data: the old files are not read again.
    write(spark, landed, rows(55, 20), "c")
    run_scoring(clean_stream(source(spark, landed)), scorer, ck).awaitTermination()
    scores = spark.read.parquet(f"{out}/scores")
    assert scores.count() == 75 == scores.select("tx_id").distinct().count()
    assert scores.select("batch_id").distinct().count() == 3
    # A retried batch replaces what it wrote.
    batch = spark.read.parquet(f"{landed}/c").where("tx_id >= 'T00060'")
    scorer(batch, scores.agg(F.max("batch_id")).first()[0])
    assert spark.read.parquet(f"{out}/scores").count() == 75
    view = online_view(spark, f"{out}/features")
    assert view.count() == 75 and view.where("account_degree = 0").isEmpty()
    alerts = spark.read.json(f"{out}/alerts")
    high = spark.read.parquet(f"{out}/scores").where("is_high_risk").count()
    assert alerts.count() == high > 0
    keys = {json.loads(r.value)["account_id"] == r.key for r in alerts.collect()}
    assert keys == {True}


def test_window_graph_uses_landed_history(spark, tmp_path):
    """The graph of a batch holds the earlier events of its window, not the batch alone."""
    out = str(tmp_path / "out")
    scorer = BatchScorer(out, score=rule())
    first = transactions(spark, [("T1", "A1", "D1", "M1", 10, 0), ("T2", "A2", "D1", "M2", 10, 60)])
    scorer(first, 0)
    scorer(transactions(spark, [("T3", "A3", "D1", "M3", 10, 1800)]), 1)
    scorer(transactions(spark, [("T4", "A4", "D1", "M4", 10, 3660)]), 2)
    got = {r.tx_id: r.device_degree for r in online_view(spark, f"{out}/features").collect()}
    # At 61 minutes, (1, 61] holds T3 and T4 only: T2 sits on the open end.
    assert got == {"T1": 2, "T2": 2, "T3": 3, "T4": 2}
    scorer(first.where("false"), 3)
    assert spark.read.parquet(f"{out}/scores").count() == 4


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    landed, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    write(spark, landed, rows(0, 240), "a")
    stream = clean_stream(source(spark, landed))
    query = (
        window_fanout(stream)
        .writeStream.format("memory")
        .queryName("fanout")
        .outputMode("append")
        .option("checkpointLocation", ck)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = {(r.graph_id, r.account_id): r for r in spark.table("fanout").collect()}
    tx = transactions(spark, rows(0, 240))
    want = (
        tx.withColumn("graph_id", F.unix_timestamp(F.date_trunc("hour", "event_time")))
        .groupBy("graph_id", "account_id")
        .agg(
            F.countDistinct("device_id").alias("unique_devices"),
            F.countDistinct("merchant_id").alias("unique_merchants"),
            F.count("*").alias("velocity"),
        )
        .collect()
    )
    closed = {k for k, _ in got}
    assert len(closed) >= 2
    for row in want:
        if row.graph_id in closed:
            mine = got[(row.graph_id, row.account_id)]
            assert (mine.unique_devices, mine.unique_merchants, mine.velocity) == (
                row.unique_devices, row.unique_merchants, row.velocity,
            )


def test_throughput_stream_and_lag(spark, tmp_path):
    landed, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    write(spark, landed, rows(0, 200, step=30), "a")
    seen = []
    listener = LagListener(lambda *event: seen.append(event))
    spark.streams.addListener(listener)
    query = (
        throughput_stream(clean_stream(source(spark, landed)))
        .writeStream.format("memory")
        .queryName("tps")
        .outputMode("append")
        .option("checkpointLocation", ck)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark.streams.removeListener(listener)
    counts = {r.n for r in spark.table("tps").collect()}
    assert counts == {2}
    assert lag_seconds("2024-01-01T00:02:30.000Z", "2024-01-01T00:00:00.000Z") == 150.0


def test_json_lines_quarantine(spark, tmp_path):
    landed = tmp_path / "json"
    landed.mkdir()
    good = {"tx_id": "T1", "account_id": "A1", "device_id": "D1", "merchant_id": "M1",
            "amount": 5.0, "tx_type": "DEBIT", "channel": "web", "event_time": "2024-01-01 00:00:07.179575"}
    missing = dict(good, tx_id="T2", device_id=None)
    (landed / "a.txt").write_text("\n".join([json.dumps(good), "not json", json.dumps(missing)]))
    parsed = parse_json(spark.read.text(str(landed)))
    assert parsed.schema == TRANSACTION_SCHEMA
    kept, aside = split_quarantine(parsed)
    assert [r.tx_id for r in kept.collect()] == ["T1"]
    assert kept.select(micros(F.col("event_time"))).first()[0] % 1_000_000 == 179575
    assert aside.count() == 2
    raw = stream_source(spark, path=str(landed), fmt="json-lines")
    quarantine_stream(raw, str(tmp_path / "q"), str(tmp_path / "qck")).awaitTermination()
    assert spark.read.json(str(tmp_path / "q")).count() >= 1

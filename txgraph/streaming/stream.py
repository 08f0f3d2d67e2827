"""Structured Streaming: clean source, native window features, scored micro-batches."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from txgraph.functions.scalars import micros
from txgraph.ml.score import score_transactions
from txgraph.operators.batches import first_occurrence
from txgraph.operators.features import feature_matrix, graph_features
from txgraph.operators.investigate import alerts, route
from txgraph.schema import WINDOW_MINUTES
from txgraph.session import freeze, session_conf
from txgraph.sinks.messages import keyed_messages, publish
from txgraph.sinks.online import upsert_batch
from txgraph.sources.transactions import valid_keys


def clean_stream(raw: DataFrame, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Rows with all identifiers, watermarked, each ``tx_id`` once within the watermark."""
    return (
        raw.where(valid_keys())
        .withWatermark("event_time", f"{window_minutes} minutes")
        .dropDuplicatesWithinWatermark(["tx_id"])
    )


def window_fanout(stream: DataFrame, window_minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Per closed window and account: velocity and device and merchant fan-out.

    Distinct counts are not allowed on streams, so edges are counted first and nodes second:
    two chained stateful aggregates, appended once the watermark closes the window.
    """
    slot = F.window("event_time", f"{window_minutes} minutes")
    ends = F.explode(
        F.array(
            F.struct(F.lit("device").alias("ntype"), F.col("device_id").alias("other")),
            F.struct(F.lit("merchant").alias("ntype"), F.col("merchant_id").alias("other")),
        )
    )
    edges = (
        stream.select("event_time", "account_id", ends.alias("end"))
        .groupBy(slot.alias("window"), "account_id", "end")
        .agg(F.count("*").alias("weight"))
    )
    is_device = F.col("end.ntype") == "device"
    return (
        edges.groupBy(F.window(F.window_time("window"), f"{window_minutes} minutes").alias("window"), "account_id")
        .agg(
            F.count_if(is_device).alias("unique_devices"),
            F.count_if(~is_device).alias("unique_merchants"),
            F.sum(F.when(is_device, F.col("weight"))).alias("velocity"),
        )
        .select(
            F.unix_timestamp("window.start").alias("graph_id"),
            "account_id",
            "unique_devices",
            "unique_merchants",
            "velocity",
        )
    )


def throughput_stream(stream: DataFrame) -> DataFrame:
    """Transactions per second by minute."""
    return (
        stream.groupBy(F.window("event_time", "1 minute").alias("window"))
        .agg(F.count("*").alias("n"))
        .select(
            F.unix_timestamp("window.start").alias("minute"), "n", (F.col("n") / 60.0).alias("tps")
        )
    )


@dataclass
class BatchScorer:
    """``foreachBatch`` callback: window graph, features, scores, alerts; all by ``batch_id``.

    The history of events lands in ``history/hour=.../batch_id=...``, so the window of a batch
    reads the few hours it touches and no state grows in the query. Every output path is a
    function of the batch id: a batch that is retried replaces what it wrote before.
    """

    base: str
    model: PipelineModel | None = None
    score: object | None = None
    window_minutes: int = WINDOW_MINUTES
    alert_servers: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        fresh = freeze(first_occurrence(batch))
        self._land(fresh, batch_id)
        marks = fresh.agg(F.max(micros(F.col("event_time")))).first()
        window = self._window(spark, marks[0]).withColumn("graph_id", F.lit(batch_id).cast("bigint"))
        tx = fresh.withColumn("graph_id", F.lit(batch_id).cast("bigint"))
        features = freeze(graph_features(tx, window))
        matrix = feature_matrix(tx, features)
        if self.model is not None:
            scored = score_transactions(tx, matrix, self.model)
        else:
            scored = route(tx, self.score)
        out = self.base.rstrip("/")
        scored = freeze(scored)
        scored.write.mode("overwrite").parquet(f"{out}/scores/batch_id={batch_id}")
        upsert_batch(matrix, f"{out}/features", batch_id)
        publish(
            keyed_messages(alerts(scored)),
            kafka_servers=self.alert_servers,
            path=f"{out}/alerts/batch_id={batch_id}",
        )

    def _land(self, fresh: DataFrame, batch_id: int) -> None:
        hour = F.date_format("event_time", "yyyyMMddHH")
        with session_conf(fresh.sparkSession, spark__sql__sources__partitionOverwriteMode="dynamic"):
            (
                fresh.withColumn("hour", hour)
                .withColumn("batch_id", F.lit(batch_id))
                .write.mode("overwrite")
                .partitionBy("hour", "batch_id")
                .parquet(f"{self.base}/history")
            )

    def _window(self, spark, watermark: int) -> DataFrame:
        """Landed events in (watermark - window, watermark], each transaction once."""
        start = watermark - self.window_minutes * 60_000_000
        first = datetime.fromtimestamp(start // 1_000_000, timezone.utc)
        last = datetime.fromtimestamp(watermark // 1_000_000, timezone.utc)
        hours = []
        at = first.replace(minute=0, second=0)
        while at <= last:
            hours.append(at.strftime("%Y%m%d%H"))
            at += timedelta(hours=1)
        landed = spark.read.parquet(f"{self.base}/history").where(
            F.col("hour").cast("string").isin(hours)
        )
        at = micros(F.col("event_time"))
        return first_occurrence(
            landed.where((at > start) & (at <= watermark)).drop("hour", "batch_id")
        )


def run_scoring(
    stream: DataFrame, scorer: BatchScorer, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Start the scoring query; the checkpoint and the keyed sink make it exactly-once."""
    writer = (
        stream.writeStream.foreachBatch(scorer)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def quarantine_stream(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows with a missing identifier, kept aside as JSON."""
    return (
        raw.where(~valid_keys())
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def lag_seconds(timestamp: str, watermark: str) -> float:
    """Seconds between a progress timestamp and the event-time watermark (ISO, UTC)."""

    def parse(text: str) -> datetime:
        return datetime.fromisoformat(text.replace("Z", "+00:00"))

    return (parse(timestamp) - parse(watermark)).total_seconds()


class LagListener(StreamingQueryListener):
    """Reports the watermark lag of every progress event to a callback."""

    def __init__(self, report):
        self.report = report

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        mark = (event.progress.eventTime or {}).get("watermark")
        if mark:
            self.report(
                str(event.progress.id),
                event.progress.batchId,
                lag_seconds(event.progress.timestamp, mark),
            )

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

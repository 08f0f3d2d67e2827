"""Alert episodes on a live stream against the batch operator."""

import random

import pytest

from txgraph.operators.monitor import alert_episodes
from txgraph.session import session_conf
from txgraph.streaming.episodes import STATE_STORE, episode_stream

RULES = [
    ("Slow", "lag", 10.0, 3, "critical", "pager"),
    ("Now", "lag", 50.0, 0, "warning", "chat"),
    ("Other", "share", 0.5, 2, "warning", "chat"),
]
SCHEMA = "metric string, at bigint, value double"
START = 1_704_067_200


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(
        RULES, "alert string, metric string, threshold double, hold_minutes int, severity string, route string"
    )


def drain(spark, rules, folder, out, checkpoint):
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    with session_conf(spark, spark__sql__streaming__stateStore__providerClass=STATE_STORE):
        (
            episode_stream(source, rules, delay="5 minutes")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


def test_episodes_survive_disorder_and_restart(spark, rules, tmp_path):
    """Steps out of order, missing and null, cut into files, with a restart inside a stretch."""
    rng = random.Random(3)
    rows = []
    for minute in range(60):
        at = START + 60 * minute
        if minute not in (17, 18, 40):
            high = minute % 20 < 12
            rows.append(("lag", at, None if minute == 25 else (60.0 if minute == 5 else 20.0 if high else 1.0)))
        rows.append(("share", at, rng.choice([0.2, 0.9, 0.9, 0.9])))
    folder, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    # Neighbours up to two minutes apart change places; that stays within the delay.
    mixed = sorted(rows, key=lambda r: r[1] + rng.choice([0, 60, 120]))
    for part in range(3):
        land(spark, folder, f"a{part}", mixed[part * 25 : part * 25 + 25])
    drain(spark, rules, folder, out, ck)
    early = spark.read.parquet(out).count()
    land(spark, folder, "b", mixed[75:])
    # Quiet samples an hour later move the watermark past everything.
    land(spark, folder, "c", [("lag", START + 7200, 0.0), ("share", START + 7200, 0.0)])
    land(spark, folder, "d", [("lag", START + 7800, 0.0), ("share", START + 7800, 0.0)])
    drain(spark, rules, folder, out, ck)
    got = spark.read.parquet(out)
    assert 0 < early < got.count()
    want = alert_episodes(spark.createDataFrame(rows, SCHEMA), rules)
    resolved = got.where("status = 'resolved'").drop("status").select(*want.columns)
    assert sorted(resolved.collect()) == sorted(want.collect())
    # Every episode fired once, at the first step at which it had held long enough.
    hold = {r[0]: r[3] for r in RULES}
    firing = {(r.alert, r.started): r.minutes for r in got.where("status = 'firing'").collect()}
    assert firing == {(r.alert, r.started): hold[r.alert] for r in want.collect()}
    assert got.where("status = 'firing'").count() == len(firing) >= 5

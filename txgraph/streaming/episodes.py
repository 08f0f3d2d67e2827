"""Alert episodes on a live stream: a rule's predicate that holds for a given time.

Samples wait in state until the watermark passes their step, so their order inside a batch and
over batches does not matter; event-time timers end a stretch whose next step never came. State
per alert: the samples younger than the watermark and one open stretch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor

# Ship the processor itself, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_KEY = ["alert", "severity", "route", "hold_minutes"]
_RESULT = "alert string, severity string, route string, status string, started bigint, ended bigint, minutes bigint"


class EpisodeTracker(StatefulProcessor):
    """Stretches of consecutive breached steps of one alert."""

    def __init__(self, step_seconds: int):
        self.step = step_seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at bigint", "breached boolean")
        self.stretch = handle.getValueState("stretch", "started bigint, last bigint, fired boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        fresh: dict[int, bool] = {}
        for row in rows:
            fresh[row["at"]] = fresh.get(row["at"], False) or bool(row["breached"])
        for at, breached in fresh.items():
            if self.waiting.containsKey((at,)):
                breached = breached or bool(self.waiting.getValue((at,))[0])
            self.waiting.updateValue((at,), (breached,))
            self.handle.registerTimer(at * 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        mark = timerValues.getCurrentWatermarkInMs()
        # Steps at or below the watermark are complete: later rows for them are late.
        due = sorted((at[0], value[0]) for at, value in self.waiting.iterator() if at[0] * 1000 <= mark)
        held = self.stretch.get() if self.stretch.exists() else None
        before = held
        for at, breached in due:
            self.waiting.removeKey((at,))
            if held and at - held[1] > self.step:
                yield from self._end(key, held)
                held = None
            if breached:
                held = (held[0] if held else at, at, bool(held and held[2]))
                if not held[2] and self._minutes(held) >= key[3]:
                    yield self._row(key, "firing", held)
                    held = (held[0], at, True)
            elif held:
                yield from self._end(key, held)
                held = None
        if held and (held[1] + self.step) * 1000 <= mark:
            yield from self._end(key, held)
            held = None
        if held is None:
            self.stretch.clear()
        elif held != before:
            self.stretch.update(held)
            self.handle.registerTimer((held[1] + self.step) * 1000 + 1)

    def _end(self, key, held) -> Iterator[Row]:
        if held[2]:
            yield self._row(key, "resolved", held)

    def _row(self, key, status: str, held) -> Row:
        return Row(
            alert=key[0], severity=key[1], route=key[2], status=status,
            started=held[0], ended=held[1], minutes=self._minutes(held),
        )

    @staticmethod
    def _minutes(held) -> int:
        return (held[1] - held[0]) // 60

    def close(self) -> None:
        pass


def episode_stream(
    samples: DataFrame, rules: DataFrame, step_minutes: int = 1, delay: str | None = None
) -> DataFrame:
    """``firing`` once a predicate has held as long as it must, ``resolved`` when it ends.

    ``samples`` is a stream of metric, at (epoch seconds of an evaluation step), value; a missing
    step or a null value ends a stretch, of several rows of a step one breach is enough. ``rules``
    is a static table, one row per alert. Rows later than ``delay`` (default: one step) are
    dropped. The resolved rows are those of the batch operator ``alert_episodes``. The session
    must use ``STATE_STORE``; write with output mode ``append``.
    """
    breached = F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)).alias("breached")
    timed = (
        samples.withColumn("event_time", F.timestamp_seconds("at"))
        .withWatermark("event_time", delay or f"{step_minutes} minutes")
        .join(F.broadcast(rules), "metric")
        .select(*_KEY, "event_time", F.col("at").cast("bigint").alias("at"), breached)
    )
    return timed.groupBy(*_KEY).transformWithState(
        EpisodeTracker(step_minutes * 60), _RESULT, "Append", "EventTime"
    )

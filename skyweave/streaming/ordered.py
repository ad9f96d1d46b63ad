"""Failure streaks in event time: attempts that come late, or in batches that overlap in time, are put in order first.

Each key keeps the attempts that are not final yet, and the length of its streak up to those that are. When the watermark
passes an attempt, nothing earlier can come any more: a timer at the earliest kept attempt wakes the key, which takes all
final attempts in order, sends them on with their streaks and sets its timer anew. What a key holds is the attempts of one
watermark's delay, in chunks of CHUNK, and three numbers, in the state store; no folder of all keys is read or written for a
batch. A call of the store goes from Python to the JVM and back, so its calls grow with keys and chunks, not with attempts.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..dimensions import MAX_AGE_MINUTES
from .slots import run_to_table

OUT = "key bigint, ts timestamp, event_id bigint, ok boolean, streak bigint"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Attempts in one entry of the state: the store is called once for as many, not once for each.
CHUNK = 1024
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class Streaks(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "chunk bigint", "micros array<bigint>, event_id array<bigint>, ok array<boolean>")
        self.known = handle.getValueState("known", "failures bigint, chunks bigint, alarm bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        failures, chunks, alarm = self.known.get() or (0, 0, None)
        first, chunks = self.keep(((row.micros, row.event_id, row.ok) for row in rows), chunks)
        if first is not None:
            self.known.update((failures, chunks, self.wake(first, alarm)))
        return iter(())

    def keep(self, attempts: Iterator[tuple], chunks: int) -> tuple[int | None, int]:
        """Put attempts into chunks of the map, the next number being ``chunks``: their earliest time, the number after."""
        first = None
        while some := list(islice(attempts, CHUNK)):
            micros, event_ids, oks = map(list, zip(*some))
            self.open.updateValue((chunks,), (micros, event_ids, oks))
            first = min(micros) if first is None else min(first, *micros)
            chunks += 1
        return first, chunks

    def wake(self, micros: int, alarm: int | None) -> int:
        """A timer at the earliest open attempt, and no other."""
        at = micros // 1000 + 1
        if alarm is not None and alarm <= at:
            return alarm
        if alarm is not None:
            self.handle.deleteTimer(alarm)
        self.handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        final = timerValues.getCurrentWatermarkInMs()
        failures = self.known.get()[0]
        kept: dict[tuple, bool] = {}
        for _, (micros, event_ids, oks) in sorted((k[0], v) for k, v in self.open.iterator()):
            kept.update(zip(zip(micros, event_ids), oks))
        attempts = sorted((*k, ok) for k, ok in kept.items())
        out = []
        for micros, event_id, ok in attempts:
            if micros // 1000 >= final:
                break
            failures = 0 if ok else failures + 1
            out.append(Row(key=key[0], ts=EPOCH + timedelta(microseconds=micros), event_id=event_id, ok=ok, streak=failures))
        self.open.clear()
        first, chunks = self.keep(iter(attempts[len(out) :]), 0)
        self.known.update((failures, chunks, None if first is None else self.wake(first, None)))
        return iter(out)

    def close(self) -> None:
        pass


def ordered_streaks(attempts: DataFrame, delay_minutes: int = MAX_AGE_MINUTES) -> DataFrame:
    """Attempts (key, ts, event_id, ok) with their streaks, each sent on once the watermark has passed it.

    An attempt later than ``delay_minutes`` behind the newest one is dropped; one that comes twice counts once.
    """
    rows = attempts.select("key", "ts", "event_id", "ok", F.unix_micros("ts").alias("micros")).withWatermark("ts", f"{delay_minutes} minutes")
    return rows.groupBy("key").transformWithState(Streaks(), OUT, "Append", "EventTime")


def run(attempts: DataFrame, name: str, delay_minutes: int = MAX_AGE_MINUTES) -> DataFrame:
    """Drain a stream of attempts into a table; this kind of state lives in RocksDB, which only this query is given."""
    spark = attempts.sparkSession
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        return run_to_table(ordered_streaks(attempts, delay_minutes), name)
    finally:
        spark.conf.set(STORE, before)

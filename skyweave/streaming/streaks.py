"""Failure streaks that run on across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dimensions import STREAK_THRESHOLD
from ..operators.sequence import failure_streaks

STATE = "key bigint, failures bigint"


def batch_streaks(batch: DataFrame, state: DataFrame) -> DataFrame:
    """Attempts of a batch with their streak, the streak each key had before the batch carried in.

    ``batch(key, ts, event_id, ok)``, ``state(key, failures)`` with one row per key. The carry counts for the
    failures before the key's first success in the batch.
    """
    streaks = failure_streaks(batch, "key", "ts", "event_id", "ok")
    first_ok = batch.groupBy("key").agg(F.min(F.when(F.col("ok"), F.struct("ts", "event_id"))).alias("_first_ok"))
    joined = streaks.join(first_ok.join(state, "key", "left"), "key")
    before = F.col("_first_ok").isNull() | (F.struct("ts", "event_id") < F.col("_first_ok"))
    carried = F.when(before & ~F.col("ok"), F.coalesce("failures", F.lit(0))).otherwise(F.lit(0))
    return joined.withColumn("streak", F.col("streak") + carried).drop("_first_ok", "failures")


def next_state(streaks: DataFrame, state: DataFrame) -> DataFrame:
    """Streak of every key after the batch: that of its last attempt, or what it was."""
    last = streaks.groupBy("key").agg(F.max_by("streak", F.struct("ts", "event_id")).alias("failures"))
    return last.unionByName(state.join(last.select("key"), "key", "left_anti"))


def alert_writer(folder: str, threshold: int = STREAK_THRESHOLD, handler=None):
    """foreachBatch sink: alerts of the batch and the state after it, both versioned by batch.

    Batches must come in time order per key. A retried batch reads the state of the batch before it and replaces
    its own output. ``handler(alerts, batch_id)`` may send the alerts on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id == 0:
            state = session.createDataFrame([], STATE)
        else:
            state = session.read.schema(STATE).parquet(f"{folder}/state/batch={batch_id - 1}")
        # the streaks are read twice: kept as a table rather than worked out again
        batch_streaks(batch, state).write.mode("overwrite").parquet(f"{folder}/streaks/batch={batch_id}")
        streaks = session.read.parquet(f"{folder}/streaks/batch={batch_id}")
        next_state(streaks, state).write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}")
        if handler is not None:
            handler(streaks.where(F.col("streak") >= threshold), batch_id)

    return write


def alerts(session, folder: str, threshold: int = STREAK_THRESHOLD) -> DataFrame:
    return session.read.parquet(f"{folder}/streaks").where(F.col("streak") >= threshold).drop("batch")

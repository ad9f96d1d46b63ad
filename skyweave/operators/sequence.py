"""Ordered analytics per key without one task per key.

A window over ``partitionBy(source)`` would put a whole source in one task. Each operator here works in
two levels: inside (key, time chunk), which spreads one key over as many tasks as it has chunks, and over
one summary row per chunk, which carries the state from chunk to chunk.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

DAY, HOUR = 86_400, 3_600
CHUNK_ROWS = 1_000_000


def _chunk(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds)


def range_chunks(df: DataFrame, order: list[str], rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with ``_chunk``: ranges of ``order`` (key, time, ties) of some ``rows`` rows at most, however they crowd.

    Chunks of time do not bound the rows of a crowded hour; ranges of the whole order do, as they split a key, an hour and
    a single instant alike. Their bounds come from Spark's sample for a range exchange, so twice as many are asked for as
    would do. Chunks follow the order, which is what the operators here need of them. The result is read from a table in
    the shared folder: the number of a range is its task's, and must not be worked out twice.
    """
    parts = max(1, -(-2 * df.count() // rows))
    dealt = df.repartitionByRange(parts, *order).withColumn("_chunk", F.spark_partition_id())
    folder = f"{shared_folder(df.sparkSession)}/chunks-{uuid.uuid4().hex}"
    dealt.write.parquet(folder)
    return df.sparkSession.read.schema(dealt.schema).parquet(folder)


def _in_chunks(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Rows with their chunk: what ``range_chunks`` gave them, else a stretch of time."""
    return df if "_chunk" in df.columns else df.withColumn("_chunk", _chunk(F.col(ts), seconds))


def steps(df: DataFrame, key: str, ts: str = "ts", chunk_seconds: int = DAY) -> DataFrame:
    """Consecutive pairs (key, start, end) of distinct instants per key.

    Pairs inside a chunk come from a window over (key, chunk); pairs across a border join the last instant
    of a chunk with the first of the next non-empty one, from a table of one row per key and chunk. Instants are
    distinct, so a day's window holds at most 86 400 of them however many rows repeat them.
    """
    chunked = df.select(key, F.col(ts).alias("end")).distinct().withColumn("_chunk", _chunk(F.col("end"), chunk_seconds))
    inner = chunked.withColumn("start", F.lag("end").over(Window.partitionBy(key, "_chunk").orderBy("end")))
    ends = chunked.groupBy(key, "_chunk").agg(F.min("end").alias("end"), F.max("end").alias("_last"))
    border = ends.withColumn("start", F.lag("_last").over(Window.partitionBy(key).orderBy("_chunk")))
    pairs = inner.select(key, "start", "end").unionByName(border.select(key, "start", "end"))
    return pairs.where(F.col("start").isNotNull())


def number_rows(
    df: DataFrame, keys: list[str], ts: str, ties: list[str], name: str = "n", chunk_seconds: int = HOUR
) -> DataFrame:
    """Running number per key in (ts, ties) order, from 1. For crowded hours give it the rows of ``range_chunks``."""
    chunked = _in_chunks(df, ts, chunk_seconds)
    counts = chunked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(*keys, "_chunk", F.coalesce(before, F.lit(0)).alias("_before"))
    inner = Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)
    return (
        chunked.join(offsets, [*keys, "_chunk"])
        .withColumn(name, F.col("_before") + F.row_number().over(inner))
        .drop("_chunk", "_before")
    )


def failure_streaks(
    df: DataFrame, key: str, ts: str, tie: str, ok: str, chunk_seconds: int = HOUR
) -> DataFrame:
    """Every attempt with ``streak``: the consecutive failures of its key up to and including it (0 after a success).

    Inside a chunk: failures since the last success. A chunk's rows before its first success continue the
    streak the earlier chunks ended with, which is carried over the per-chunk summaries. For crowded hours give it the
    rows of ``range_chunks``.
    """
    chunked = _in_chunks(df, ts, chunk_seconds)
    order = Window.partitionBy(key, "_chunk").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    islands = chunked.withColumn("_island", F.sum(F.col(ok).cast("int")).over(order))
    inner = Window.partitionBy(key, "_chunk", "_island").orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    local = islands.withColumn("_local", F.sum((~F.col(ok)).cast("int")).over(inner))

    # failures after the last success of the chunk = fails of the highest island
    per_island = islands.groupBy(key, "_chunk", "_island").agg(F.sum((~F.col(ok)).cast("int")).alias("_fails"))
    summary = per_island.groupBy(key, "_chunk").agg(
        F.max_by("_fails", "_island").alias("_tail"), (F.max("_island") > 0).alias("_any_ok")
    )
    so_far = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    runs = summary.withColumn("_run", F.sum(F.col("_any_ok").cast("int")).over(so_far))
    in_run = Window.partitionBy(key, "_run").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    ended = runs.withColumn("_ended", F.sum("_tail").over(in_run))
    carry = ended.select(
        key, "_chunk", F.coalesce(F.lag("_ended").over(Window.partitionBy(key).orderBy("_chunk")), F.lit(0)).alias("_carry")
    )
    streak = F.when(F.col(ok), F.lit(0)).otherwise(
        F.col("_local") + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(F.lit(0))
    )
    return (
        local.join(carry, [key, "_chunk"])
        .withColumn("streak", streak.cast("bigint"))
        .drop("_chunk", "_island", "_local", "_carry")
    )


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key. The rank filter lets Spark keep k rows per key and task before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)

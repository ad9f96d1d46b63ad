"""Slots, late scans, held scans and once-only emission on streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import MAX_AGE_MINUTES, SLOT_MINUTES, TOLERANCE_MINUTES
from ..operators.align import ladder_slots
from ..session import shared_folder

WATERMARK = f"{MAX_AGE_MINUTES} minutes"


def slots(scans: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Scans and distinct sources per five-minute slot; rows older than the watermark are dropped.

    ``scans(source, ts)``. The set of sources of a slot is bounded by the registry. In ``append`` mode a slot comes
    out once it is closed, in ``update`` mode again whenever a late scan changes it.
    """
    window = F.window("ts", f"{SLOT_MINUTES} minutes")
    counted = scans.withWatermark("ts", watermark).groupBy(window.alias("w")).agg(
        F.count(F.lit(1)).alias("scans"), F.size(F.collect_set("source")).alias("n_sources")
    )
    return counted.select(F.col("w.start").alias("slot"), "scans", "n_sources")


def fresh(scans: DataFrame, max_age_minutes: int = MAX_AGE_MINUTES) -> DataFrame:
    """Scans that were not stale when they arrived. ``scans(source, ts, arrival)``."""
    return scans.where(F.unix_timestamp("arrival") - F.unix_timestamp("ts") <= max_age_minutes * 60)


def lateness(scans: DataFrame) -> DataFrame:
    """Age at arrival, in minutes."""
    return scans.withColumn("age_minutes", (F.unix_timestamp("arrival") - F.unix_timestamp("ts")) / 60.0)


def held_matches(fast: DataFrame, slow: DataFrame, tolerance_minutes: int = TOLERANCE_MINUTES, watermark: str = WATERMARK) -> DataFrame:
    """Scans of a quick service held until the slow service's scan for the same time arrives.

    Each side is reduced to one scan per minute first, so a minute that repeats a million times still gives at most
    2*tolerance+1 pairs. Stream-stream join on time buckets as long as the tolerance; the bounds on both event times
    let Spark forget held scans once the watermark has passed them. ``fast(fast_ts)``, ``slow(slow_ts)``.
    """
    size = tolerance_minutes * 60
    bucket = lambda c: F.floor(F.unix_timestamp(c) / size)

    def by_minute(scans: DataFrame, name: str) -> DataFrame:
        minutes = scans.select(F.date_trunc("minute", name).alias(name)).withWatermark(name, watermark)
        return minutes.dropDuplicatesWithinWatermark([name])

    left = by_minute(fast, "fast_ts").withColumn("bucket", bucket("fast_ts"))
    near = F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: bucket("slow_ts") + d)
    right = by_minute(slow, "slow_ts").withColumn("bucket", F.explode(near))
    reach = F.expr(f"interval {tolerance_minutes} minutes")
    inside = F.col("slow_ts").between(F.col("fast_ts") - reach, F.col("fast_ts") + reach)
    joined = left.alias("l").join(right.alias("r"), (F.col("l.bucket") == F.col("r.bucket")) & inside)
    gap = (F.unix_timestamp("slow_ts") - F.unix_timestamp("fast_ts")) / 60
    return joined.select("fast_ts", "slow_ts", gap.cast("int").alias("gap_minutes"))


def once_per_slot(scans: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """First scan of every slot and no other."""
    slot = F.window("ts", f"{SLOT_MINUTES} minutes")["start"]
    return scans.withColumn("slot", slot).withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["slot"])


def version_writer(path: str):
    """foreachBatch sink for changed rows: one folder per batch, so a retried batch replaces its own output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def latest_version(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key of what ``version_writer`` wrote."""
    rest = [c for c in versions.columns if c not in (*keys, "batch")]
    return versions.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("_v")).select(*keys, *(f"_v.{c}" for c in rest))


def slots_written(session: SparkSession, manifest_path: str, hours: list[int], before: int) -> DataFrame:
    """Slots of the named hours that batches before ``before`` have written; the manifest's other hours are not opened."""
    kept = session.read.schema("slot timestamp, hour bigint, batch bigint").parquet(manifest_path)
    return kept.where(F.col("hour").isin(hours) & (F.col("batch") < before)).select("slot")


def new_slots_writer(path: str, manifest_path: str):
    """foreachBatch sink that skips slots an earlier batch has already written.

    The manifest is kept by hour of slot and by batch. A batch reads the hours it touches and writes its own part of them, so
    a retried batch replaces what it wrote and nothing else, and the manifest's length does not matter. A slot that one
    batch brings twice is written as it comes: ``once_per_slot`` leaves one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id == 0:  # an empty manifest to begin with
            batch.select("slot").limit(0).write.mode("append").parquet(manifest_path)
        hour = F.floor(F.unix_timestamp("slot") / 3600)
        hours = [r.hour for r in batch.select(hour.alias("hour")).distinct().collect()]  # the hours of one micro-batch
        done = slots_written(session, manifest_path, hours, batch_id)
        batch.join(done, "slot", "left_anti").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        written = session.read.schema(batch.schema).parquet(f"{path}/batch={batch_id}").select("slot", hour.alias("hour")).distinct()
        keyed = written.withColumn("batch", F.lit(batch_id).cast("bigint"))
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "batch").parquet(manifest_path)

    return write


def ladder_writer(path: str, catalog_path: str):
    """foreachBatch sink: keep the scans of the batch, then match the recent slots by the fallback ladder.

    A slot is matched anew when a scan of its hour or the hours beside it has come: scans further away are out of every
    tolerance. The catalog is partitioned by hour, so only those hours are read back. A stamp far in the future makes
    slots of its own and takes no other scan out.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        hour = F.floor(F.unix_timestamp("ts") / 3600)
        arrived = batch.select("source", "ts", hour.alias("hour"))
        arrived.write.mode("overwrite").partitionBy("hour").parquet(f"{catalog_path}/batch={batch_id}")
        known = session.read.option("basePath", catalog_path).schema("source string, ts timestamp, batch long, hour long").parquet(catalog_path)
        touched = arrived.select(F.explode(F.array(F.col("hour") - 1, F.col("hour"), F.col("hour") + 1)).alias("hour")).distinct()
        near = known.where(F.col("batch") <= batch_id).join(touched, "hour", "left_semi").select("source", "ts").distinct()
        matched = ladder_slots(near, near.select("source").distinct())
        matched.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drain a stream into a table in the shared folder and read it back."""
    spark = stream.sparkSession
    folder = fresh_folder(spark, name)
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def run_batches(stream: DataFrame, name: str, writer, mode: str = "update") -> str:
    """Drain a stream through a foreachBatch sink; ``writer(folder)`` makes it. Returns the folder."""
    folder = fresh_folder(stream.sparkSession, name)
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .foreachBatch(writer(folder))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return folder

"""Streams over the events, drained and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schema import EVENTS
from ..session import use_utc
from ..streaming import ordered, streaks
from ..streaming import slots as S
from ..views import source_name
from . import ctes
from .registry import minute_text, query, r6
from .time_queries import FALLBACK_LADDER

FMT = "%Y%m%d%H%M"


def event_stream(spark, sf_dir):
    use_utc(spark)
    stream = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), source_name(F.col("event_id") % 6).alias("source")
    )


def arriving(spark, sf_dir):
    """Scans that arrive between 0 and 60 minutes after their time."""
    return event_stream(spark, sf_dir).withColumn("arrival", F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") * 7 % 61).cast("int")))


SLOTS = """w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS slot, event_id, CAST(event_id % 6 AS INT) AS s, ts FROM events),
slots AS (SELECT slot, count(*) AS scans, CAST(count(DISTINCT s) AS INT) AS n_sources FROM w GROUP BY slot)"""


@query(
    "t1_closed_slots",
    f"""WITH {SLOTS} SELECT strftime(slot,'{FMT}') AS slot, scans, n_sources FROM slots WHERE slot + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events)""",
)
def t1_closed_slots(spark, sf_dir):
    """Slots closed by the watermark, each written once."""
    table = S.run_to_table(S.slots(event_stream(spark, sf_dir)), "t1")
    return table.withColumn("slot", minute_text("slot"))


@query("t2_updated_slots", f"WITH {SLOTS} SELECT strftime(slot,'{FMT}') AS slot, scans, n_sources FROM slots")
def t2_updated_slots(spark, sf_dir):
    """Every slot, open ones too, as the newest version written for it."""
    folder = S.run_batches(S.slots(event_stream(spark, sf_dir)), "t2", lambda f: S.version_writer(f"{f}/out"))
    versions = spark.read.parquet(f"{folder}/out")
    return S.latest_version(versions, ["slot"]).withColumn("slot", minute_text("slot"))


@query(
    "t3_stale_cut_off",
    "SELECT CAST(event_id % 6 AS INT) AS source_id, count(*) AS scans FROM events WHERE event_id * 7 % 61 <= 30 GROUP BY ALL",
)
def t3_stale_cut_off(spark, sf_dir):
    kept = S.run_to_table(S.fresh(arriving(spark, sf_dir)).select("event_id"), "t3")
    return kept.groupBy((F.col("event_id") % 6).cast("int").alias("source_id")).agg(F.count(F.lit(1)).alias("scans"))


@query(
    "t4_held_scans",
    f"""WITH m AS (SELECT DISTINCT event_id % 6 AS s, date_trunc('minute', ts) AS ts FROM events) SELECT strftime(f.ts,'{FMT}') AS fast_ts, strftime(s.ts,'{FMT}') AS slow_ts,
 CAST((epoch(s.ts) - epoch(f.ts)) / 60 AS INT) AS gap_minutes FROM m f JOIN m s ON f.s = 4 AND s.s = 0 AND s.ts BETWEEN f.ts - INTERVAL 2 MINUTE AND f.ts + INTERVAL 2 MINUTE""",
)
def t4_held_scans(spark, sf_dir):
    """Scans of the archive-less service with those of a slower one around the same time."""
    pick = lambda source, role: event_stream(spark, sf_dir).where(F.col("source") == source).select(F.col("ts").alias(f"{role}_ts"))
    found = S.run_to_table(S.held_matches(pick("arso", "fast"), pick("dwd", "slow")), "t4")
    return found.select(minute_text("fast_ts").alias("fast_ts"), minute_text("slow_ts").alias("slow_ts"), "gap_minutes")


@query(
    "t6_streak_alerts",
    f"""WITH {ctes.ATTEMPTS} SELECT key, event_id, CAST(streak AS BIGINT) AS streak FROM streaks WHERE streak >= 3""",
)
def t6_streak_alerts(spark, sf_dir):
    stream = event_stream(spark, sf_dir).select(F.col("user_id").alias("key"), "ts", "event_id", (F.col("event_type") != "error").alias("ok"))
    folder = S.run_batches(stream, "t6", streaks.alert_writer, "append")
    return streaks.alerts(spark, folder).select("key", "event_id", "streak")


@query("t7_each_slot_once", f"WITH {SLOTS} SELECT strftime(slot,'{FMT}') AS slot FROM slots")
def t7_each_slot_once(spark, sf_dir):
    once = S.run_to_table(S.once_per_slot(event_stream(spark, sf_dir)).select("slot"), "t7")
    return once.select(minute_text("slot").alias("slot"))


@query(
    "t8_lateness",
    f"""SELECT list_extract({ctes.NAMES}, CAST(event_id % 6 AS INT) + 1) AS source, count(*) AS scans, round(avg(event_id * 7 % 61), 6) AS avg_age_minutes, CAST(max(event_id * 7 % 61) AS DOUBLE) AS max_age_minutes,
 CAST(count_if(event_id * 7 % 61 > 30) AS BIGINT) AS late FROM events GROUP BY ALL""",
)
def t8_lateness(spark, sf_dir):
    aged = S.run_to_table(S.lateness(arriving(spark, sf_dir)).select("source", "age_minutes"), "t8")
    age = F.col("age_minutes")
    return aged.groupBy("source").agg(
        F.count(F.lit(1)).alias("scans"), r6(F.avg(age)).alias("avg_age_minutes"), F.max(age).alias("max_age_minutes"), F.count_if(age > 30).alias("late")
    )


@query(
    "t6_ordered_streaks",
    f"""WITH {ctes.ATTEMPTS} SELECT key, event_id, CAST(streak AS BIGINT) AS streak FROM streaks WHERE streak >= 3 AND epoch_ms(ts) < (SELECT epoch_ms(max(ts) - INTERVAL 30 MINUTE) FROM events)""",
)
def t6_ordered_streaks(spark, sf_dir):
    """The same alerts from per-key state and event-time timers; the last half hour is still open."""
    stream = event_stream(spark, sf_dir).select(F.col("user_id").alias("key"), "ts", "event_id", (F.col("event_type") != "error").alias("ok"))
    return ordered.run(stream, "t6o").where("streak >= 3").select("key", "event_id", "streak")


@query("t5_ladder_stream", FALLBACK_LADDER)
def t5_ladder_stream(spark, sf_dir):
    """The fallback ladder on a stream: recent slots matched anew whenever scans come."""
    stream = event_stream(spark, sf_dir).select("source", F.date_trunc("minute", "ts").alias("ts"))
    folder = S.run_batches(stream, "t5", lambda f: S.ladder_writer(f"{f}/out", f"{f}/catalog"), "append")
    return spark.read.parquet(f"{folder}/out").select("rung", minute_text("candidate").alias("candidate"), "n_sources")

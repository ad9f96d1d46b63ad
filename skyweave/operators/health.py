"""Availability, outages, gaps and uptime of the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import (
    CORE_SOURCES,
    GAP_MINUTES,
    LATEST_ONLY_SOURCE,
    MAX_AGE_MINUTES,
    MIN_CORE_SOURCES,
    SLOTS_PER_HOUR,
    STREAK_THRESHOLD,
    source_table,
)
from ..functions.timefn import parse_minute
from .sequence import failure_streaks, steps, top_per_key


def outages(catalog: DataFrame, now: Column, sources: list[str], max_age_minutes: int = MAX_AGE_MINUTES) -> DataFrame:
    """Per source: available, reason, newest, age_minutes.

    ``catalog(source, timestamp)`` with text stamps. No rows, no stamp that parses, or a newest stamp more than
    ``max_age_minutes`` old is an outage; an age of exactly the limit is not.
    """
    newest = catalog.groupBy("source").agg(F.count(F.lit(1)).alias("_files"), F.max(parse_minute(F.col("timestamp"))).alias("newest"))
    joined = source_table(catalog.sparkSession, sources).select("source", "is_core").join(newest, "source", "left")
    age = F.unix_timestamp(now) - F.unix_timestamp("newest")
    minutes = F.floor(age / 60)
    stale = age > max_age_minutes * 60
    reason = (
        F.when(F.col("_files").isNull(), "no data available")
        .when(F.col("newest").isNull(), "no valid timestamps")
        .when(stale, F.format_string(f"stale data (age: %d min, max: {max_age_minutes} min)", minutes))
    )
    return joined.select(
        "source", "is_core", F.coalesce(~stale, F.lit(False)).alias("available"), reason.alias("reason"), "newest", minutes.alias("age_minutes")
    )


def core_counts(availability: DataFrame, min_core: int = MIN_CORE_SOURCES) -> DataFrame:
    """(available_core, total_core, enough): core sources in the map only."""
    core = F.col("source").isin(CORE_SOURCES)
    counts = availability.agg(
        F.count_if(core & F.col("available")).alias("available_core"), F.count_if(core).alias("total_core")
    )
    return counts.withColumn("enough", F.col("available_core") >= min_core)


def available_sources(availability: DataFrame) -> DataFrame:
    return availability.where("available").select("source")


def only_available(scans: DataFrame, availability: DataFrame) -> DataFrame:
    return scans.join(available_sources(availability), "source", "left_semi")


def intervals(catalog: DataFrame, key: str = "source") -> DataFrame:
    """Consecutive scans: (key, start, end, minutes)."""
    return steps(catalog, key).withColumn("minutes", (F.unix_timestamp("end") - F.unix_timestamp("start")) / 60.0)


def gaps(catalog: DataFrame, key: str = "source", limit_minutes: float = GAP_MINUTES) -> DataFrame:
    return intervals(catalog, key).where(F.col("minutes") > limit_minutes)


def longest_gaps(catalog: DataFrame, key: str = "source", k: int = 10) -> DataFrame:
    """The ``k`` longest gaps per key (earlier first on a tie) and how many more there are."""
    found = gaps(catalog, key)
    totals = found.groupBy(key).agg(F.count(F.lit(1)).alias("_gaps"))
    ranked = top_per_key(found, [key], [F.desc("minutes"), F.asc("start")], k)
    # one row per key on the right
    return ranked.join(totals, key).withColumn("more_gaps", F.greatest(F.col("_gaps") - k, F.lit(0))).drop("_gaps")


def availability_profile(catalog: DataFrame, key: str = "source") -> DataFrame:
    """Count, expected count, uptime, interval statistics and span per key.

    As the intervals of a key add up to its span, everything but their minimum and maximum follows from the
    first, last and number of scans; those two come from the intervals.
    """
    distinct = catalog.select(key, "ts").distinct()
    span = distinct.groupBy(key).agg(F.count(F.lit(1)).alias("count"), F.min("ts").alias("oldest"), F.max("ts").alias("newest"))
    between = intervals(catalog, key).groupBy(key).agg(F.min("minutes").alias("min_minutes"), F.max("minutes").alias("max_minutes"))
    seconds = F.unix_timestamp("newest") - F.unix_timestamp("oldest")
    hours = seconds / 3600.0
    expected = (hours * SLOTS_PER_HOUR).cast("bigint")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return span.join(between, key, "left").select(
        key,
        "count",
        expected.alias("expected"),
        zero(F.try_divide(F.col("count") * 100.0, expected)).alias("uptime_percent"),
        zero(F.col("min_minutes")).alias("min_minutes"),
        zero(F.try_divide(seconds / 60.0, F.col("count") - 1)).alias("avg_minutes"),
        zero(F.col("max_minutes")).alias("max_minutes"),
        hours.alias("total_hours"),
        "oldest",
        "newest",
    )


def common_instants(catalog: DataFrame, sources: list[str]) -> DataFrame:
    """Instants that every listed source has."""
    wanted = catalog.where(F.col("source").isin(sources)).select("source", "ts").distinct()
    return wanted.groupBy("ts").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(sources)).select("ts")


def composite_potential(catalog: DataFrame, sources: list[str]) -> DataFrame:
    """Common instants of the sources against all instants of the first: counts and percent.

    The result is null-percent and flagged when not all of them have data.
    """
    wanted = catalog.where(F.col("source").isin(sources)).select("source", "ts").distinct()
    per_instant = wanted.groupBy("ts").agg(
        F.count(F.lit(1)).alias("_n"), F.max((F.col("source") == sources[0]).cast("int")).alias("_first"), F.collect_set("source").alias("_s")
    )
    counts = per_instant.agg(
        F.count_if(F.col("_n") == len(sources)).alias("common"),
        F.sum("_first").cast("bigint").alias("possible"),
        F.size(F.array_distinct(F.flatten(F.collect_set("_s")))).alias("sources_with_data"),
    )
    return counts.select(
        "common", "possible", "sources_with_data", F.try_divide(F.col("common") * 100.0, F.col("possible")).alias("potential_percent")
    )


def streak_alerts(attempts: DataFrame, key: str, ts: str, tie: str, ok: str = "ok", threshold: int = STREAK_THRESHOLD) -> DataFrame:
    """One alert per failure from the ``threshold``-th consecutive one on; a success starts over, per key."""
    found = failure_streaks(attempts, key, ts, tie, ok).where(F.col("streak") >= threshold)
    message = F.format_string("Source %s has failed %d consecutive times", F.col(key).cast("string"), "streak")
    return found.withColumn("level", F.lit("error")).withColumn("message", message)


def current_failures(attempts: DataFrame, key: str, ts: str, tie: str, ok: str = "ok") -> DataFrame:
    """Failures of every key since its last success; two combinable aggregates, no window."""
    last_ok = attempts.groupBy(key).agg(F.max(F.when(F.col(ok), F.struct(ts, tie))).alias("_last_ok"))
    later = F.col("_last_ok").isNull() | (F.struct(ts, tie) > F.col("_last_ok"))
    return attempts.join(last_ok, key).groupBy(key).agg(F.count_if(later & ~F.col(ok)).alias("failures"))


def uptime_status(percent: Column) -> Column:
    return F.when(percent >= 100, "perfect").when(percent >= 90, "good").when(percent >= 80, "warning").otherwise("critical")


def interval_status(minutes: Column) -> Column:
    return F.when(minutes <= 5, "normal").when(minutes <= 6, "acceptable").when(minutes <= 10, "warning").otherwise("gap")


def potential_status(percent: Column) -> Column:
    return F.when(percent > 95, "excellent").when(percent >= 90, "good").when(percent >= 80, "fair").otherwise("poor")


def hit_rate_status(percent: Column) -> Column:
    return F.when(percent > 85, "good").when(percent >= 70, "warning").otherwise("critical")


def newest_per_source(catalog: DataFrame, extra: list[str]) -> DataFrame:
    """Newest scan of each source; larger ``extra`` values win a tie."""
    return catalog.groupBy("source").agg(F.max(F.struct("ts", *extra)).alias("_n")).select("source", "_n.*")


def slot_quorum(scans: DataFrame, min_core: int = MIN_CORE_SOURCES) -> DataFrame:
    """Quorum of every slot after each of three steps, and why it is skipped.

    ``scans(slot, source, exists, available, has_metadata, decoded)``: one row per slot and source.
    """
    usable = F.col("available")
    described = usable & F.col("has_metadata")
    done = described & F.col("decoded")
    counts = scans.groupBy("slot").agg(
        F.max("exists").alias("_exists"),
        F.count_if(usable).alias("usable"),
        F.count_if(described).alias("described"),
        F.count_if(done).alias("processed"),
    )
    reason = (
        F.when(F.col("_exists"), "already_exists")
        .when(F.col("usable") < min_core, "insufficient_sources")
        .when(F.col("described") < min_core, "insufficient_sources")
        .when(F.col("processed") < min_core, "processing_failed")
    )
    return counts.select("slot", "usable", "described", "processed", reason.alias("reason"))


def skip_summary(slots: DataFrame) -> DataFrame:
    """Count and the three earliest slots per skip reason. Three are kept per task, never a whole list."""
    skipped = slots.where(F.col("reason").isNotNull())
    counts = skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("slots"))
    first = top_per_key(skipped.select("reason", "slot"), ["reason"], [F.asc("slot")], 3)
    named = first.groupBy("reason").agg(F.array_sort(F.collect_list("slot")).alias("first_slots"))
    return counts.join(named, "reason")


def stored_counts(catalog: DataFrame) -> DataFrame:
    """Downloaded and stored scans per source and the three newest stamps."""
    by_ts = catalog.groupBy("source", "ts").agg(F.max("downloaded").alias("downloaded"))
    counts = by_ts.groupBy("source").agg(
        F.count(F.lit(1)).alias("stamps"), F.count_if("downloaded").alias("downloaded"), F.count_if(~F.col("downloaded")).alias("stored")
    )
    recent = top_per_key(by_ts.select("source", "ts"), ["source"], [F.desc("ts")], 3)
    listed = recent.groupBy("source").agg(F.sort_array(F.collect_list("ts"), asc=False).alias("recent"))
    return counts.join(listed, "source")


def backload_quorum(scans: DataFrame, sources: list[str], min_sources: int = 2) -> DataFrame:
    """Slots of a backload: every archived source at that very slot, enough extents, enough merged.

    ``scans(slot, source, has_extent, merged)``.
    """
    kept = [s for s in sources if s != LATEST_ONLY_SOURCE]
    counts = scans.where(F.col("source").isin(kept)).groupBy("slot").agg(
        F.count_distinct("source").alias("n_sources"), F.count_if("has_extent").alias("extents"), F.count_if(F.col("has_extent") & F.col("merged")).alias("merged")
    )
    return counts.where((F.col("n_sources") == len(kept)) & (F.col("extents") >= min_sources) & (F.col("merged") >= 2))

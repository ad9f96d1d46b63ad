"""Lining scans up in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import LATEST_ONLY_SOURCE, MIN_CORE_SOURCES, REPROCESS_COUNT, TOLERANCE_MINUTES
from ..functions.timefn import known_spellings


MICROS_SPAN = 10**16  # above any microsecond count since 1970 until the year 2286


def nearest_per_candidate(catalog: DataFrame, tolerance_minutes: int = TOLERANCE_MINUTES, carry: list[str] = ()) -> DataFrame:
    """For every minute that has a scan, the nearest scan of every source within the tolerance.

    ``catalog(source, ts, *carry)``. Stamps have minute precision, so a scan can serve at most 2*tolerance+1
    candidates: each scan is offered to those and one aggregate keeps the nearest, earlier scan first on a
    tie. No self join; the aggregate combines before the shuffle, so a busy minute or source stays small.
    Returns (candidate, source, gap_minutes, ts, *carry).
    """
    minute = F.date_trunc("minute", "ts")
    gap, micros = F.abs("_shift").cast("bigint"), F.unix_micros("ts")
    # nearness and time in one whole number: a fixed-width buffer, so the aggregate hashes instead of sorting
    offered = catalog.select(
        "source", "ts", *carry, F.explode(F.sequence(F.lit(-tolerance_minutes), F.lit(tolerance_minutes))).alias("_shift")
    ).select("source", (minute + F.make_dt_interval(mins=F.col("_shift"))).alias("candidate"), (gap * MICROS_SPAN + micros).alias("_order"), *carry)
    nearest = offered.groupBy("candidate", "source").agg(
        F.min("_order").alias("_order"), *(F.min_by(c, "_order").alias(c) for c in carry)
    )
    return nearest.select(
        "candidate",
        "source",
        F.floor(F.col("_order") / MICROS_SPAN).cast("int").alias("gap_minutes"),
        F.timestamp_micros(F.col("_order") % MICROS_SPAN).alias("ts"),
        *carry,
    )


def matched_slots(nearest: DataFrame, sources_known: int, min_sources: int | None = None) -> DataFrame:
    """Candidates with enough sources: (candidate, n_sources, scans map source -> stamp).

    A candidate exists only where some source has a scan exactly there (gap 0). The map holds at most one
    entry per source.
    """
    slots = nearest.groupBy("candidate").agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.min("gap_minutes").alias("_nearest"),
        F.map_from_entries(F.collect_list(F.struct("source", "ts"))).alias("scans"),
    )
    return slots.where((F.col("_nearest") == 0) & (F.col("n_sources") >= (min_sources or sources_known))).drop("_nearest")


def common_slots(catalog: DataFrame, sources_known: int, tolerance_minutes=TOLERANCE_MINUTES, min_sources=None, max_count=REPROCESS_COUNT) -> DataFrame:
    """The newest ``max_count`` matched candidates, newest first."""
    slots = matched_slots(nearest_per_candidate(catalog, tolerance_minutes), sources_known, min_sources)
    return slots.orderBy(F.desc("candidate")).limit(max_count)


def band_matches(candidates: DataFrame, scans: DataFrame, tolerance_seconds: int) -> DataFrame:
    """Pairs within the tolerance at any precision, as an equi join on time buckets.

    ``candidates(candidate)``, ``scans(source, ts)``, both distinct. A bucket is as long as the tolerance, so
    the partner lies in the same or a neighbouring bucket, and a bucket holds at most that many seconds.
    """
    bucket = lambda c: F.floor(F.unix_timestamp(c) / tolerance_seconds)
    left = candidates.withColumn("_bucket", bucket("candidate"))
    right = scans.withColumn("_bucket", F.explode(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda d: bucket("ts") + d)))
    gap = F.abs(F.unix_timestamp("ts") - F.unix_timestamp("candidate"))
    return left.join(right, "_bucket").withColumn("gap_seconds", gap).where(F.col("gap_seconds") <= tolerance_seconds).drop("_bucket")


def asof_nearest(asked: DataFrame, scans: DataFrame, tolerance_seconds: int, chunk_seconds: int = 3600) -> DataFrame:
    """The nearest scan within the tolerance of each asked instant, the earlier one on a tie: sort and carry, no pairs.

    ``asked(source, candidate)``, ``scans(source, ts)``, both distinct. Asked instants and scans are sorted together in
    chunks of time; the last scan before and the first one after are carried along, one pass in either direction. A scan
    is also put into the chunk beside its own if an instant there may reach it, so a scan is two rows at most.
    Returns (source, candidate, gap_seconds, ts).
    """
    size = max(chunk_seconds, 2 * tolerance_seconds)
    chunk = lambda c, shift=0: F.floor((F.unix_timestamp(c) + shift) / size)
    nothing = F.lit(None).cast("timestamp")
    here = asked.select("source", F.col("candidate").alias("_at"), nothing.alias("ts"), "candidate", chunk("candidate").alias("_chunk"))
    reach = F.explode(F.sequence(chunk("ts", -tolerance_seconds), chunk("ts", tolerance_seconds)))
    there = scans.select("source", F.col("ts").alias("_at"), "ts", nothing.alias("candidate"), reach.alias("_chunk"))
    way = lambda order: Window.partitionBy("source", "_chunk").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    both = here.unionByName(there).withColumn("_before", F.last("ts", ignorenulls=True).over(way(F.col("_at"))))
    both = both.withColumn("_after", F.last("ts", ignorenulls=True).over(way(F.col("_at").desc()))).where("candidate is not null")
    gap = lambda c: F.abs(F.unix_timestamp(c) - F.unix_timestamp("candidate"))
    offer = lambda c: F.when(F.col(c).isNotNull(), F.struct(gap(c).alias("gap_seconds"), F.col(c).alias("ts")))
    found = both.select("source", "candidate", F.least(offer("_before"), offer("_after")).alias("_near"))
    return found.select("source", "candidate", "_near.*").where(F.col("gap_seconds") <= tolerance_seconds)


def latest_common(catalog: DataFrame, required: list[str], tolerance_minutes: int = TOLERANCE_MINUTES) -> DataFrame:
    """The newest instant at which every required source has a scan within the tolerance, with the scans used.

    Only the required sources are held against all instants; the scans of all sources are then looked up for the one found.
    """
    scans = catalog.where("ts is not null").select("source", "ts").distinct()
    need = F.array(*(F.lit(s) for s in required))
    asked = scans.select(F.col("ts").alias("candidate")).distinct().select("candidate", F.explode(need).alias("source"))
    near = asof_nearest(asked, scans.where(F.col("source").isin(list(required))), tolerance_minutes * 60)
    full = near.groupBy("candidate").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == len(set(required)))
    newest = full.select(F.max("candidate")).scalar()  # one instant, null if there is none
    gap = F.abs(F.unix_timestamp("ts") - F.unix_timestamp("candidate"))
    around = scans.withColumn("candidate", newest).where(gap <= tolerance_minutes * 60)
    best = around.groupBy("candidate", "source").agg(F.min(F.struct(gap.alias("gap_seconds"), "ts")).alias("_near"))
    return best.groupBy("candidate").agg(
        F.collect_set("source").alias("sources"), F.map_from_entries(F.collect_list(F.struct("source", "_near.ts"))).alias("scans")
    )


def exact_slots(catalog: DataFrame, sources: list[str]) -> DataFrame:
    """Slots at which every listed source has a scan with exactly that stamp."""
    wanted = catalog.where(F.col("source").isin(sources)).select("source", "ts").distinct()
    return wanted.groupBy("ts").agg(F.count(F.lit(1)).alias("n_sources")).where(F.col("n_sources") == len(sources))


def backload_slots(catalog: DataFrame, sources: list[str], start: Column, end: Column) -> DataFrame:
    """Exact slots of a period in replay order; the source without an archive takes no part."""
    kept = [s for s in sources if s != LATEST_ONLY_SOURCE]
    return exact_slots(catalog.where(F.col("ts").between(start, end)), kept).orderBy("ts")


def synchronised_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of two services: 14-digit stamps of one against 12-digit stamps of the other."""
    keyed = left.where(F.length("ts14") == 14).withColumn("ts12", F.substring("ts14", 1, 12))
    return keyed.join(right, "ts12")


def known(candidates: DataFrame, stored: DataFrame, stamp: str = "ts_raw", how: str = "left_anti") -> DataFrame:
    """Candidates that a store does not hold yet (or, with ``left_semi``, does), under any spelling.

    ``stored(source, stamp)``. The candidates are spelled out, matched, and gathered again by their own key.
    """
    spelled = candidates.select("source", stamp, F.explode(known_spellings(F.col(stamp))).alias("_spelling")).distinct()
    held = stored.select("source", F.col(stamp).alias("_spelling")).distinct()
    hits = spelled.join(held, ["source", "_spelling"], "left_semi").select("source", stamp).distinct()
    return candidates.join(hits, ["source", stamp], how)


def existing_newest(candidates: DataFrame, catalog: DataFrame, count: int) -> DataFrame:
    """Candidate slots that the provider has, newest ``count`` per source."""
    from .sequence import top_per_key

    there = candidates.join(catalog.select("source", "ts").distinct(), ["source", "ts"], "left_semi")
    return top_per_key(there, ["source"], [F.desc("ts")], count)


def latest_only(catalog: DataFrame, requested: DataFrame, source: str = LATEST_ONLY_SOURCE) -> DataFrame:
    """The latest scan of an archive-less source, if the requested stamps include it to the minute."""
    newest = catalog.where(F.col("source") == source).agg(F.max("ts14").alias("ts14")).where("ts14 is not null")
    wanted = requested.select(F.substring("ts14", 1, 12).alias("_minute"))
    return newest.withColumn("_minute", F.substring("ts14", 1, 12)).join(wanted, "_minute", "left_semi").drop("_minute")


def prefer_fresh(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Fresh and stored scans together, the fresh one winning per (source, ts)."""
    both = fresh.withColumn("origin", F.lit("fresh")).unionByName(stored.withColumn("origin", F.lit("stored")))
    rest = [c for c in both.columns if c not in ("source", "ts")]
    # "fresh" sorts before "stored"
    picked = both.groupBy("source", "ts").agg(F.min(F.struct("origin", *(c for c in rest if c != "origin"))).alias("_pick"))
    return picked.select("source", "ts", "_pick.*")


def first_seen(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """First row per key in arrival order, as one combinable aggregate."""
    rest = [c for c in df.columns if c not in keys and c not in arrival]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*arrival, *rest)).alias("_first"))
    return picked.select(*keys, "_first.*")


def missing_sources(catalog: DataFrame, sources: list[str]) -> DataFrame:
    """(ts, source) for every slot of the catalog and listed source without a scan there."""
    present = catalog.select("ts", "source").where(F.col("source").isin(sources)).distinct()
    have = present.groupBy("ts").agg(F.collect_set("source").alias("_have"))
    lacking = F.array_except(F.array(*(F.lit(s) for s in sources)), "_have")
    return have.select("ts", F.explode(lacking).alias("source"))


def work_list(slots: DataFrame, products: list[str]) -> DataFrame:
    """Every slot with every wanted product; the product list is a short parameter."""
    return slots.withColumn("product", F.explode(F.array(*(F.lit(p) for p in products))))


def ladder_slots(
    catalog: DataFrame, available: DataFrame, tolerance_minutes=TOLERANCE_MINUTES, min_core=MIN_CORE_SOURCES, max_count=REPROCESS_COUNT
) -> DataFrame:
    """Matched slots by the first rung that matches anything: all available sources; without the archive-less
    one; the quorum.

    ``available(source)`` lists the sources not in outage. As on every rung only the *number* of available
    sources counts for the match, one pass over the candidates serves all rungs: each candidate is offered to
    the rungs it satisfies and the newest ``max_count`` of a rung are kept.
    Returns (rung, candidate, n_sources, scans).
    """
    every = available.select(F.count(F.lit(1))).scalar()
    latest_only_there = available.select(F.count_if(F.col("source") == LATEST_ONLY_SOURCE)).scalar() > 0
    slots = matched_slots(nearest_per_candidate(catalog, tolerance_minutes), 1)
    n = F.col("n_sources")
    rungs = F.array_compact(
        F.array(
            F.when((every > 0) & (n >= every), F.lit(1)),
            F.when(latest_only_there & (every > 2) & (n >= every - 1), F.lit(2)),
            F.when(n >= min_core, F.lit(3)),
        )
    )
    offered = slots.select(F.explode(rungs).alias("rung"), "candidate", "n_sources", "scans")
    newest = Window.partitionBy("rung").orderBy(F.desc("candidate"))
    kept = offered.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= max_count)
    # at most three times max_count rows from here on
    best = F.min("rung").over(Window.partitionBy())
    return kept.withColumn("_best", best).where(F.col("rung") == F.col("_best")).drop("_rank", "_best")

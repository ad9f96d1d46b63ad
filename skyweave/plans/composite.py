"""Mosaics: of the newest slots, and of a past period."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import LATEST_ONLY_SOURCE, MIN_CORE_SOURCES, REPROCESS_COUNT, TOLERANCE_MINUTES
from ..functions.proj import Grid
from ..operators import align, health, mosaic, strips
from ..operators import runs as line_runs
from ..operators.regrid import SourceGrid
from ..session import BROADCAST_ROW_LIMIT
from ..sources import sinks
from ..sources.scans import decodable


@dataclass
class Composite:
    availability: DataFrame
    slots: DataFrame  # slot, source, ts of the scans used
    cells: DataFrame  # slot, dst_row, dst_col, dbz
    statistics: DataFrame
    skipped: DataFrame  # slot, reason: matched in the catalog, but too few of their scans can be read and decoded


def latest(
    catalog: DataFrame,
    scans: DataFrame,
    grids: dict[str, SourceGrid],
    dst: Grid,
    now: Column,
    manifest: DataFrame | None = None,
    tolerance_minutes: int = TOLERANCE_MINUTES,
    min_core: int = MIN_CORE_SOURCES,
    max_count: int = REPROCESS_COUNT,
    strategy: str = "max",
    runs: DataFrame | None = None,
) -> Composite:
    """Mosaics of the newest matched slots.

    ``catalog(source, ts, timestamp)`` has a row per landed scan and decides everything; ``scans`` are the
    standard scans of ``sources.scans`` with their pixels, or the strips made of them; ``runs`` the stored index runs of
    ``grids`` in their order, where a service is not on a lon/lat grid. Availability -> matching by the fallback ladder -> slots already published drop out -> quorum after the
    sources in outage are gone -> only then are pixels read. What selects them is at most ``max_count`` slots
    with one scan per source, so it is broadcast.
    """
    sources = list(grids)
    catalog = catalog.where(F.col("source").isin(sources))
    availability = health.outages(catalog, now, sources)
    usable = health.available_sources(availability)
    matched = align.ladder_slots(catalog.where("ts is not null"), usable, tolerance_minutes, min_core, max_count)
    enough = availability.select(F.count_if(F.col("is_core") & F.col("available"))).scalar() >= min_core
    used = (
        matched.where(enough)
        .select("rung", F.col("candidate").alias("slot"), F.explode("scans").alias("source", "ts"))
        .where((F.col("rung") != 2) | (F.col("source") != LATEST_ONLY_SOURCE))
        .join(usable, "source", "left_semi")
    )
    if manifest is not None:
        names = manifest.where("folder = 'composite'").select("name")
        used = used.withColumn("name", sinks.output_name(F.col("slot"))).join(names, "name", "left_anti").drop("name")
    quorum = used.groupBy("slot").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_core).select("slot")
    chosen = used.join(quorum, "slot", "left_semi").select("slot", "source", "ts")
    # at most max_count slots with one scan per source: known before the scans are read, so that their days prune them
    rows = chosen.collect()
    chosen = scans.sparkSession.createDataFrame(rows, chosen.schema)
    if "date" in scans.columns:
        days = sorted({d for r in rows for d in _days(r["ts"])})
        scans = scans.where(F.col("source").isin(sorted({r["source"] for r in rows})) & F.col("date").isin(days))
    return _judged_mosaic(scans, chosen, True, availability, grids, dst, strategy, min_core, runs)


def backload(
    catalog: DataFrame,
    scans: DataFrame,
    grids: dict[str, SourceGrid],
    dst: Grid,
    start: Column,
    end: Column,
    min_sources: int = 2,
    strategy: str = "max",
    runs: DataFrame | None = None,
) -> Composite:
    """Mosaics of every slot of a period for which all archived sources have a scan of exactly that time."""
    sources = [s for s in grids if s != LATEST_ONLY_SOURCE]
    inside = catalog.where(F.col("ts").between(start, end) & F.col("source").isin(sources))
    slots = align.exact_slots(inside, sources).where(F.col("n_sources") >= min_sources)
    chosen = slots.select(F.col("ts").alias("slot"), F.explode(F.array(*(F.lit(s) for s in sources))).alias("source"), "ts")
    availability = health.outages(inside, end, sources)
    if "date" in scans.columns:
        day = lambda c, off: F.date_format(F.date_add(c, off), "yyyy-MM-dd")
        scans = scans.where(F.col("source").isin(sources) & F.col("date").between(day(start, -1), day(end, 1)))
    chosen, few = bounded(chosen)
    return _judged_mosaic(scans, chosen, few, availability, {s: grids[s] for s in sources}, dst, strategy, min_sources, runs)


def _days(ts) -> list[str]:
    """The day of a stamp and its neighbours: a scan may land on the other side of midnight."""
    return [(ts + timedelta(days=d)).strftime("%Y-%m-%d") for d in (-1, 0, 1)]


def bounded(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` as literal rows where it has at most as many as may be broadcast, else as it is."""
    rows = df.limit(BROADCAST_ROW_LIMIT + 1).collect()
    few = len(rows) <= BROADCAST_ROW_LIMIT
    return (df.sparkSession.createDataFrame(rows, df.schema) if few else df), few


def decoded(scans: DataFrame, chosen: DataFrame, few: bool) -> DataFrame:
    """The chosen scans (slot, source, ts) that are there with at least one value that decodes; no pixel is shuffled."""
    if few:
        scans = scans.join(F.broadcast(chosen.select("source", "ts").distinct()), ["source", "ts"], "left_semi")
    there = decodable(scans).where("ok").select("source", "ts").distinct()
    return there.join(F.broadcast(chosen) if few else chosen, ["source", "ts"]).select("slot", "source", "ts")


def judged(there: DataFrame, chosen: DataFrame, need: int) -> tuple[DataFrame, DataFrame]:
    """Scans of slots with at least ``need`` decoded sources; the other slots with the reason."""
    counts = there.groupBy("slot").agg(F.count_distinct("source").alias("_n"))
    slots = chosen.select("slot").distinct().join(counts, "slot", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    reason = F.concat(F.lit("insufficient: "), F.col("_n").cast("string"), F.lit(f" of {need} sources readable"))
    good = slots.where(F.col("_n") >= need).select("slot")
    return there.join(good, "slot", "left_semi").select("slot", "source", "ts"), slots.where(F.col("_n") < need).select("slot", reason.alias("reason"))


def _judged_mosaic(scans, chosen, few: bool, availability, grids, dst, strategy, need: int, runs) -> Composite:
    """Which of the chosen scans decode decides which slots count; only then are pixels unfolded and placed."""
    there = decoded(scans, chosen, few)
    if few:  # as few as the chosen
        there = scans.sparkSession.createDataFrame(there.collect(), chosen.select("slot", "source", "ts").schema)
    chosen, skipped = judged(there, chosen, need)
    picked = scans.join(F.broadcast(chosen) if few else chosen, ["source", "ts"])
    lines = picked if "row" in scans.columns else strips.strips(picked, ["source", "slot"])
    if all(g.projection.family == "longlat" for g in grids.values()):
        merged = strips.block_mosaic(lines, grids, dst, ["slot"], strategy)
        return Composite(availability, chosen, merged, mosaic.statistics(merged, ["slot"], dst.cells), skipped)
    # lines are joined to the index runs of their geometry, stored ones or made here: pixels do not move one by one
    merged = line_runs.run_mosaic(lines, grids, dst, ["slot"], strategy, runs)
    return Composite(availability, chosen, merged, mosaic.statistics(merged, ["slot"], dst.cells), skipped)

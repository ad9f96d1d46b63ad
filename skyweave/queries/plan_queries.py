"""Whole jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..dimensions import SOURCE_NAMES
from ..operators import strips
from ..plans import composite, fetch, masks, report
from ..sources import scans as S
from . import ctes
from .registry import minute_text, query, r6
from .source_queries import LANDED
from .time_queries import PROFILE

FMT = "%Y%m%d%H%M"
RASTERS = [n for n in SOURCE_NAMES if n in S.READERS]
NEEDED = ["source", "ts", "ts14", "ts_raw", "height", "width", "raw", "is_u8", "scaling"]


def grids():
    return {SOURCE_NAMES[i]: g for i, g in views.small_grids().items() if SOURCE_NAMES[i] in RASTERS}


def standard_scans(spark, sf_dir):
    return S.read_all(views.landed_six(spark, sf_dir), NEEDED)


PLACED = f"""{LANDED}, {ctes.gmap(14, 0.5, 8)},
placed AS (SELECT d.source_id, d.source, d.slot, d.ts, m.dst_row, m.dst_col, d.dbz FROM dec d JOIN gmap m USING (source_id, "row", col) WHERE d.dbz IS NOT NULL),
full_slots AS (SELECT slot, any_value(ts) AS ts FROM landed GROUP BY slot HAVING count(DISTINCT source) = 6),
archived AS (SELECT slot, any_value(ts) AS ts FROM landed WHERE source <> 'arso' GROUP BY slot HAVING count(DISTINCT source) = 5)"""


@query(
    "plan_composite_latest",
    f"""WITH {PLACED}, pick AS (SELECT slot FROM full_slots ORDER BY slot DESC LIMIT 6)
SELECT strftime(any_value(ts),'{FMT}') AS slot, dst_row, dst_col, round(max(dbz), 6) AS dbz FROM placed WHERE slot IN (SELECT slot FROM pick) GROUP BY placed.slot, dst_row, dst_col""",
)
def plan_composite_latest(spark, sf_dir):
    catalog = views.landed_catalog(spark, sf_dir)
    now = catalog.select(F.max("ts")).scalar() + F.expr("interval 10 minutes")
    made = composite.latest(catalog, standard_scans(spark, sf_dir), grids(), views.small_target(), now)
    return made.cells.select(minute_text("slot").alias("slot"), "dst_row", "dst_col", r6("dbz").alias("dbz"))


@query(
    "plan_backload",
    f"""WITH {PLACED}, pick AS (SELECT slot FROM archived WHERE ts BETWEEN TIMESTAMP '2024-01-01 01:00:00' AND TIMESTAMP '2024-01-01 05:00:00'),
m AS (SELECT slot, any_value(ts) AS ts, dst_row, dst_col FROM placed WHERE slot IN (SELECT slot FROM pick) AND source <> 'arso' GROUP BY ALL)
SELECT strftime(any_value(ts),'{FMT}') AS slot, count(*) AS valid_cells, 196::BIGINT AS total_cells, round(count(*) * 100.0::DOUBLE / 196, 6) AS coverage_percent FROM m GROUP BY m.slot""",
)
def plan_backload(spark, sf_dir):
    at = lambda text: F.to_timestamp(F.lit(text))
    made = composite.backload(views.landed_catalog(spark, sf_dir), standard_scans(spark, sf_dir), grids(), views.small_target(), at("2024-01-01 01:00:00"), at("2024-01-01 05:00:00"))
    return made.statistics.select(minute_text("slot").alias("slot"), "valid_cells", "total_cells", r6("coverage_percent").alias("coverage_percent"))


@query(
    "plan_skipped_slots",
    f"""WITH {PLACED}, n AS (SELECT d.slot, count(DISTINCT d.source) AS n FROM dec d WHERE source <> 'arso' AND dbz IS NOT NULL AND NOT (source = 'chmi' AND slot % 7 = 3) AND NOT (source = 'dwd' AND slot % 5 = 1) GROUP BY d.slot)
SELECT strftime(a.ts,'{FMT}') AS slot, 'insufficient: ' || coalesce(n, 0) || ' of 5 sources readable' AS reason FROM archived a LEFT JOIN n USING (slot) WHERE coalesce(n, 0) < 5""",
)
def plan_skipped_slots(spark, sf_dir):
    """Slots of a backload that all five archived services must make: every seventh scan of one of them and every fifth of
    another hold nothing that decodes."""
    minutes = F.floor(F.unix_timestamp("ts") / 300 - 1704067200 / 300)
    empty = ((F.col("source") == "chmi") & (minutes % 7 == 3)) | ((F.col("source") == "dwd") & (minutes % 5 == 1))
    scans = standard_scans(spark, sf_dir).withColumn("raw", F.when(empty, F.transform("raw", lambda r: F.lit(0))).otherwise(F.col("raw")))
    span = views.landed_catalog(spark, sf_dir).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    made = composite.backload(views.landed_catalog(spark, sf_dir), scans, grids(), views.small_target(), F.lit(span.a), F.lit(span.b), min_sources=5)
    return made.skipped.select(minute_text("slot").alias("slot"), "reason")


@query(
    "a1_strip_mosaic",
    f"""WITH {PLACED} SELECT strftime(any_value(ts),'{FMT}') AS slot, dst_row, dst_col, round(max(dbz), 6) AS dbz FROM placed GROUP BY placed.slot, dst_row, dst_col""",
)
def a1_strip_mosaic(spark, sf_dir):
    """Max mosaic of all slots with raster lines, not cells, in the shuffle."""
    lines = strips.strips(standard_scans(spark, sf_dir).withColumnRenamed("ts", "slot"), ["slot", "source"])
    made = strips.block_mosaic(lines, grids(), views.small_target(), ["slot"], "max", block_lines=4)
    return made.select(minute_text("slot").alias("slot"), "dst_row", "dst_col", r6("dbz").alias("dbz"))


@query(
    "plan_fetch",
    f"""WITH {PLACED}, stored AS (SELECT DISTINCT slot FROM landed WHERE slot % 3 = 0)
SELECT strftime(ts,'{FMT}') AS ts, 'hungary' AS folder, count(*) AS cells, CAST(count_if(dbz >= 10) AS BIGINT) AS visible FROM placed WHERE source = 'omsz' AND slot NOT IN (SELECT slot FROM stored) GROUP BY ts""",
)
def plan_fetch(spark, sf_dir):
    """New scans of one service, drawn; every third slot is already stored."""
    scans = S.read_omsz(views.landed(spark, sf_dir).where("source = 'omsz'"))
    stored = scans.where("slot % 3 = 0").select("source", F.substring("ts14", 1, 12).alias("ts_raw"))
    drawn = fetch.drawn(fetch.new_scans(scans, stored), {"omsz": views.small_grids()[3]}, views.small_target())
    return drawn.groupBy(minute_text("ts").alias("ts"), "folder").agg(F.count(F.lit(1)).alias("cells"), F.count_if(F.col("a") == 255).alias("visible"))


@query(
    "plan_coverage_mask",
    f"""WITH {LANDED}, {ctes.gmap(14, 0.5, 8)}, seen AS (SELECT DISTINCT source_id, "row", col FROM landed WHERE source = 'arso' OR raw <> 255), u AS (SELECT DISTINCT dst_row, dst_col FROM seen JOIN gmap USING (source_id, "row", col)),
img AS (SELECT CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col, CASE WHEN u.dst_row IS NULL THEN 128 ELSE 0 END AS v, CASE WHEN u.dst_row IS NULL THEN 255 ELSE 0 END AS a
  FROM range(14) p(r) CROSS JOIN range(14) q(c) LEFT JOIN u ON u.dst_row = r AND u.dst_col = c)
SELECT dst_row, dst_col, CAST(v AS INT) AS r, CAST(v AS INT) AS g, CAST(v AS INT) AS b, CAST(a AS INT) AS a FROM img""",
)
def plan_coverage_mask(spark, sf_dir):
    landed = views.landed_six(spark, sf_dir)
    single = masks.source_masks(landed, grids(), views.small_target())
    return masks.composite_mask(single, grids(), views.small_target())


@query(
    "plan_availability_report",
    f"""WITH {PROFILE}, g AS (SELECT source, count(*) AS n, max(minutes) AS longest FROM gaps WHERE minutes > 10 GROUP BY source)
SELECT p.source, count, expected, CASE WHEN expected > 0 AND count * 100.0::DOUBLE / expected >= 100 THEN 'perfect' WHEN expected > 0 AND count * 100.0::DOUBLE / expected >= 90 THEN 'good'
 WHEN expected > 0 AND count * 100.0::DOUBLE / expected >= 80 THEN 'warning' ELSE 'critical' END AS status, coalesce(n, 0) AS gaps, round(coalesce(longest, 0), 6) AS longest_minutes FROM profile p LEFT JOIN g USING (source) WHERE p.source IN ('dwd','shmu','chmi')""",
)
def plan_availability_report(spark, sf_dir):
    made = report.availability(views.scan_catalog(spark, sf_dir), ["dwd", "shmu", "chmi"])
    gaps = made.gaps.groupBy("source").agg((F.count(F.lit(1)) + F.max("more_gaps")).alias("gaps"), r6(F.max("minutes")).alias("longest_minutes"))
    return made.profile.join(gaps, "source", "left").select(
        "source", "count", "expected", "status", F.coalesce("gaps", F.lit(0)).alias("gaps"), F.coalesce("longest_minutes", F.lit(0.0)).alias("longest_minutes")
    )

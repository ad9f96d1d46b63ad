"""Regridding, mosaics and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..functions.colour import covered_of_alpha
from ..functions.proj import Grid
from ..operators import coverage, mosaic, regrid
from ..session import join_sized
from . import ctes
from .registry import query, r6


def placed_small(spark, sf_dir):
    return regrid.scatter_all(views.cells(spark, sf_dir), views.small_grids(), views.small_target())


def placed_big(spark, sf_dir):
    return regrid.scatter_all(views.big_cells(spark, sf_dir).where("dbz is not null"), views.big_grids(), views.big_target())


def weighted(placed, grid):
    lon, lat = grid.centre_lonlat(F.col("dst_row"), F.col("dst_col"))
    return placed.withColumn("weight", mosaic.distance_weight(F.col("source"), lon, lat, F.col("dbz")))


def merged_out(df):
    return df.select("slot", "dst_row", "dst_col", r6(F.col("dbz").cast("double")).alias("dbz"))


ISOLATE = """, told AS (SELECT slot, dst_row + dr AS dst_row, dst_col + dc AS dst_col, CASE WHEN dr = 0 AND dc = 0 THEN dbz END AS dbz
  FROM merged, range(-1, 2) a(dr), range(-1, 2) b(dc)),
heard AS (SELECT slot, dst_row, dst_col, count(*) AS n, max(dbz) AS dbz FROM told GROUP BY ALL)
SELECT slot, CAST(dst_row AS INT) AS dst_row, CAST(dst_col AS INT) AS dst_col, round(dbz, 6) AS dbz FROM heard WHERE n >= 3 AND dbz IS NOT NULL"""


@query(
    "flagship_composite",
    f"""WITH {ctes.SMALL_PLACED}, merged AS (SELECT slot, dst_row, dst_col, max(dbz) AS dbz FROM placed GROUP BY ALL)
SELECT slot, count(*) AS valid_cells, 196::BIGINT AS total_cells, round(count(*) * 100.0::DOUBLE / 196, 6) AS coverage_percent,
 round(min(dbz), 6) AS min_dbz, round(max(dbz), 6) AS max_dbz, round(avg(dbz), 6) AS mean_dbz FROM merged GROUP BY slot""",
)
def flagship_composite(spark, sf_dir):
    """Decode -> place on the target grid -> max mosaic -> statistics per slot."""
    merged = mosaic.merge(placed_small(spark, sf_dir), ["slot"], "max")
    grid = views.small_target()
    return merged.groupBy("slot").agg(
        F.count("dbz").alias("valid_cells"),
        F.lit(grid.cells).cast("bigint").alias("total_cells"),
        r6(F.count("dbz") * 100.0 / grid.cells).alias("coverage_percent"),
        r6(F.min("dbz")).alias("min_dbz"),
        r6(F.max("dbz")).alias("max_dbz"),
        r6(F.avg("dbz")).alias("mean_dbz"),
    )


@query(
    "a1_max_mosaic",
    f"WITH {ctes.BIG_PLACED} SELECT slot, dst_row, dst_col, round(max(dbz), 6) AS dbz FROM placed GROUP BY ALL",
)
def a1_max_mosaic(spark, sf_dir):
    return merged_out(mosaic.merge(placed_big(spark, sf_dir), ["slot"], "max"))


AVERAGE = f"""WITH {ctes.BIG_PLACED}, merged AS (SELECT slot, dst_row, dst_col,
  greatest(-32, least(80, CASE WHEN stddev_pop(dbz) > 15 THEN median(dbz) ELSE avg(dbz) END)) AS dbz FROM placed GROUP BY ALL)"""


@query("a2_average_mosaic", AVERAGE + ISOLATE)
def a2_average_mosaic(spark, sf_dir):
    return merged_out(mosaic.merge(placed_big(spark, sf_dir), ["slot"], "average"))


@query(
    "a3_priority_mosaic",
    f"WITH {ctes.BIG_PLACED} SELECT slot, dst_row, dst_col, round(arg_min(dbz, source_id), 6) AS dbz FROM placed GROUP BY ALL",
)
def a3_priority_mosaic(spark, sf_dir):
    return merged_out(mosaic.merge(placed_big(spark, sf_dir), ["slot"], "priority"))


@query(
    "a4_weighted_mosaic",
    f"""WITH {ctes.BIG_PLACED}, w AS (SELECT *, CASE WHEN source = 'shmu' THEN 1 / (sqrt(pow(lon - 19.15, 2) + pow(lat - 48.55, 2)) + 0.1)
   WHEN source = 'dwd' THEN 1 / (sqrt(pow(lon - 10.0, 2) + pow(lat - 51.5, 2)) + 0.1) ELSE 1.0::DOUBLE END
   * CASE WHEN source IN ('shmu','dwd') AND (dbz < -30 OR dbz > 75) THEN 0.1::DOUBLE ELSE 1 END AS weight FROM placed),
merged AS (SELECT slot, dst_row, dst_col, greatest(-32, least(80, sum(weight * dbz) / sum(weight))) AS dbz FROM w GROUP BY ALL){ISOLATE}""",
)
def a4_weighted_mosaic(spark, sf_dir):
    return merged_out(mosaic.merge(weighted(placed_big(spark, sf_dir), views.big_target()), ["slot"], "weighted"))


@query(
    "a5_strategy_dispatch",
    f"""WITH {ctes.BIG_PLACED}, enough AS (SELECT slot FROM placed GROUP BY slot HAVING count(DISTINCT source) >= 2),
merged AS (SELECT slot, dst_row, dst_col,
  greatest(-32, least(80, CASE WHEN stddev_pop(dbz) > 15 THEN median(dbz) ELSE avg(dbz) END)) AS dbz
  FROM placed WHERE slot IN (SELECT slot FROM enough) GROUP BY ALL){ISOLATE}""",
)
def a5_strategy_dispatch(spark, sf_dir):
    """An unknown strategy is the average; slots with fewer than two sources are not merged."""
    return merged_out(mosaic.merge(placed_big(spark, sf_dir), ["slot"], "no such strategy", min_sources=2))


@query(
    "a5_first_file_of_source",
    f"""WITH {ctes.BIG}, f AS (SELECT *, CAST(slot // 100 AS BIGINT) AS year FROM big), first AS (SELECT year, source_id, min(slot) AS slot FROM f GROUP BY ALL)
SELECT f.year, f.source_id, count(*) AS cells, CAST(sum(raw) AS BIGINT) AS raw_total FROM f JOIN first USING (year, source_id, slot) GROUP BY ALL""",
)
def a5_first_file_of_source(spark, sf_dir):
    """Several scans of a source in one merge window (here a year): the first one is taken."""
    cells = views.big_cells(spark, sf_dir).where("dbz is not null").withColumn("year", F.floor(F.col("slot") / 100))
    return (
        mosaic.first_file(cells, ["year", "source_id"], "slot")
        .groupBy("year", "source_id")
        .agg(F.count(F.lit(1)).alias("cells"), F.sum("raw").alias("raw_total"))
    )


@query(
    "a6_combined_extent",
    f"""WITH {ctes.CELLS}, e AS (SELECT DISTINCT slot, source_id, 10 + 0.5::DOUBLE * source_id AS west, 50 - 0.25::DOUBLE * source_id AS north FROM cells)
SELECT slot, min(west) AS west, max(west + 4) AS east, min(north - 4) AS south, max(north) AS north FROM e GROUP BY slot""",
)
def a6_combined_extent(spark, sf_dir):
    scans = views.cells(spark, sf_dir).select("slot", "source_id").distinct()
    west, north = F.col("source_id") * 0.5 + 10.0, F.lit(50.0) - F.col("source_id") * 0.25
    extents = scans.select("slot", west.alias("west"), (west + 4).alias("east"), (north - 4).alias("south"), north.alias("north"))
    return mosaic.combined_extent(extents, ["slot"])


@query(
    "a7_target_shape",
    f"""WITH {ctes.BIG}, s AS (SELECT slot, source_id, max("row") + 1 AS height, max(col) + 1 AS width FROM big GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY height * width DESC, height DESC, width DESC) AS n FROM s)
SELECT slot, CAST(height AS INT) AS height, CAST(width AS INT) AS width FROM r WHERE n = 1""",
)
def a7_target_shape(spark, sf_dir):
    scans = views.big_cells(spark, sf_dir).where("dbz is not null").groupBy("slot", "source_id").agg(
        (F.max("row") + 1).alias("height"), (F.max("col") + 1).alias("width")
    )
    return mosaic.largest_shape(scans, ["slot"])


@query(
    "a8_composite_statistics",
    f"""WITH {ctes.BIG_PLACED}, m AS (SELECT slot, dst_row, dst_col FROM placed GROUP BY ALL), s AS (SELECT slot, string_agg(source, ',' ORDER BY source) AS sources
  FROM (SELECT DISTINCT slot, source FROM placed) GROUP BY slot)
SELECT m.slot, count(*) AS valid_cells, 784::BIGINT AS total_cells, round(count(*) * 100.0::DOUBLE / 784, 6) AS coverage_percent,
 28 AS grid_height, 28 AS grid_width, any_value(sources) AS sources FROM m JOIN s USING (slot) GROUP BY m.slot""",
)
def a8_composite_statistics(spark, sf_dir):
    placed, grid = placed_big(spark, sf_dir), views.big_target()
    stats = mosaic.statistics(mosaic.merge(placed, ["slot"], "max"), ["slot"], grid.cells)
    # the registry bounds the set of sources of a slot
    named = placed.groupBy("slot").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    return stats.join(named, "slot").select(
        "slot", "valid_cells", "total_cells", r6("coverage_percent").alias("coverage_percent"),
        F.lit(grid.height).alias("grid_height"), F.lit(grid.width).alias("grid_width"), "sources",
    )


@query(
    "a9_marginal_cells",
    f"""WITH {ctes.BIG_PLACED}, first AS (SELECT slot, dst_row, dst_col, min(source_id) AS priority FROM placed GROUP BY ALL)
SELECT slot, priority, count(*) AS new_cells FROM first GROUP BY ALL""",
)
def a9_marginal_cells(spark, sf_dir):
    return mosaic.marginal_cells(placed_big(spark, sf_dir), ["slot"]).select("slot", "priority", "new_cells")


@query(
    "w10_running_size",
    f"""WITH {ctes.BIG_PLACED}, first AS (SELECT slot, dst_row, dst_col, min(source_id) AS priority FROM placed GROUP BY ALL),
n AS (SELECT slot, priority, count(*) AS new_cells FROM first GROUP BY ALL)
SELECT slot, priority, CAST(sum(new_cells) OVER (PARTITION BY slot ORDER BY priority) AS BIGINT) AS total_cells FROM n""",
)
def w10_running_size(spark, sf_dir):
    return mosaic.marginal_cells(placed_big(spark, sf_dir), ["slot"]).select("slot", "priority", "total_cells")


@query(
    "a10_data_range",
    f"""WITH {ctes.BIG} SELECT source, slot, round(min(dbz), 6) AS min_dbz, round(max(dbz), 6) AS max_dbz,
 CAST(count_if(dbz >= 10) AS BIGINT) AS valid_pixels FROM big GROUP BY ALL""",
)
def a10_data_range(spark, sf_dir):
    cells = views.big_cells(spark, sf_dir).where("dbz is not null").withColumn("dbz", F.col("dbz").cast("double"))
    return cells.groupBy("source", "slot").agg(
        r6(F.min("dbz")).alias("min_dbz"), r6(F.max("dbz")).alias("max_dbz"), F.count_if(F.col("dbz") >= 10).alias("valid_pixels")
    )


@query(
    "a25_group_representative",
    f"""WITH {ctes.BIG}, r AS (SELECT slot, source, "row", col, raw, row_number() OVER (PARTITION BY slot, source ORDER BY "row", col) AS n FROM big)
SELECT slot, source, "row" AS first_row, col AS first_col, raw FROM r WHERE n = 1""",
)
def a25_group_representative(spark, sf_dir):
    """One representative per scan: the first in an explicit order."""
    from ..operators.align import first_seen

    cells = views.big_cells(spark, sf_dir).where("dbz is not null").select("slot", "source", "row", "col", "raw")
    return first_seen(cells, ["slot", "source"], ["row", "col"]).select(
        "slot", "source", F.col("row").alias("first_row"), F.col("col").alias("first_col"), "raw"
    )


@query(
    "w6_isolation_filter",
    f"""WITH {ctes.BIG_PLACED}, merged AS (SELECT slot, dst_row, dst_col, max(dbz) AS dbz FROM placed WHERE dbz >= 60 GROUP BY ALL){ISOLATE}""",
)
def w6_isolation_filter(spark, sf_dir):
    strong = placed_big(spark, sf_dir).where("dbz >= 60")
    merged = mosaic.merge(strong, ["slot"], "max")
    return merged_out(mosaic.drop_isolated(merged, ["slot"]))


# --- regridding -----------------------------------------------------------------------------------


@query(
    "j5_grid_map_lookup",
    f"""WITH {ctes.SMALL_PLACED} SELECT source_id, slot, dst_row, dst_col, round(dbz, 6) AS dbz FROM placed""",
)
def j5_grid_map_lookup(spark, sf_dir):
    """Stored map target cell -> source cell, joined cell by cell."""
    grids, target = views.small_grids(), views.small_target()
    mapping = regrid.grid_map(spark, grids, target)
    placed = regrid.apply_grid_map(views.cells(spark, sf_dir), mapping, regrid.map_rows(grids, target))
    return placed.select("source_id", "slot", "dst_row", "dst_col", r6(F.col("dbz").cast("double")).alias("dbz"))


@query(
    "j5_tile_map_lookup",
    f"""WITH {ctes.BIG_PLACED} SELECT source_id, slot, dst_row, dst_col, round(dbz, 6) AS dbz FROM placed""",
)
def j5_tile_map_lookup(spark, sf_dir):
    """The same lookup at tile grain: one joined row per 8 x 8 tile."""
    grids, target = views.big_grids(), views.big_target()
    mapping = regrid.tile_map(regrid.grid_map(spark, grids, target), 8)
    tiles = regrid.to_tiles(views.big_cells(spark, sf_dir).where("dbz is not null"), ["source_id", "slot"], 8)
    placed = regrid.apply_tile_map(tiles, mapping, regrid.map_rows(grids, target))
    return placed.select("source_id", "slot", "dst_row", "dst_col", r6(F.col("dbz").cast("double")).alias("dbz"))


@query(
    "j6_grid_map",
    f"""WITH {ctes.CELLS}, {ctes.gmap(14, 0.5, 8)}, used AS (SELECT source_id, "row", col, count(*) AS uses FROM cells GROUP BY ALL)
SELECT source_id, dst_row, dst_col, "row", col, uses FROM gmap JOIN used USING (source_id, "row", col)""",
)
def j6_grid_map(spark, sf_dir):
    """The map itself, with how many cells of the scans use each entry."""
    grids, target = views.small_grids(), views.small_target()
    used = views.cells(spark, sf_dir).groupBy("source_id", "row", "col").agg(F.count(F.lit(1)).alias("uses"))
    mapping = regrid.grid_map(spark, grids, target)
    return join_sized(used, mapping, ["source_id", "row", "col"], len(grids) * target.cells)


@query(
    "j6_edge_round_map",
    f"""WITH {ctes.CELLS}, {ctes.target(14)}, frac AS (SELECT CAST(id AS INT) AS source_id, dst_row, dst_col,
   (50 - 0.25::DOUBLE * id - lat) / 0.5::DOUBLE AS fr, (lon - (10 + 0.5::DOUBLE * id - 0.05)) / 0.5::DOUBLE AS fc FROM tll, range(6) g(id)),
gm AS (SELECT source_id, dst_row, dst_col, CAST(greatest(0, least(7, round_even(fr, 0))) AS INT) AS "row",
   CAST(greatest(0, least(7, round_even(fc, 0))) AS INT) AS col FROM frac WHERE fr >= -0.5 AND fr < 7.5 AND fc >= -0.5 AND fc < 7.5),
used AS (SELECT source_id, "row", col, count(*) AS uses FROM cells GROUP BY ALL)
SELECT source_id, dst_row, dst_col, "row", col, uses FROM gm JOIN used USING (source_id, "row", col)""",
)
def j6_edge_round_map(spark, sf_dir):
    """The other sampling rule: fractional index from the edge, rounded. The sources lie a tenth of a cell
    further west here, so that no column index falls on a half."""
    grids = {i: regrid.SourceGrid(g.left - 0.05, g.top, g.px, g.py, g.height, g.width) for i, g in views.small_grids().items()}
    used = views.cells(spark, sf_dir).groupBy("source_id", "row", "col").agg(F.count(F.lit(1)).alias("uses"))
    target = views.small_target()
    mapping = regrid.grid_map(spark, grids, target, "edge_round")
    return join_sized(used, mapping, ["source_id", "row", "col"], len(grids) * target.cells)


@query(
    "j7_nearest_reprojection",
    f"""WITH {ctes.BIG_PLACED} SELECT source_id, slot, dst_row, dst_col, round(dbz, 6) AS dbz FROM placed""",
)
def j7_nearest_reprojection(spark, sf_dir):
    """Placement worked out per source cell, without a join."""
    return placed_big(spark, sf_dir).select("source_id", "slot", "dst_row", "dst_col", r6(F.col("dbz").cast("double")).alias("dbz"))


@query(
    "j8_nearest_point",
    f"""WITH {ctes.BIG}, pts AS (SELECT source_id * 256 + "row" * 16 + col AS point_id, any_value(10 + 0.5::DOUBLE * source_id + 0.25 * col + 0.01 * "row") AS lon,
   any_value(50 - 0.25::DOUBLE * source_id - 0.25 * "row" + 0.013 * col) AS lat FROM big GROUP BY point_id), {ctes.target(28)},
d AS (SELECT dst_row * 28 + dst_col AS target_id, point_id, sqrt(pow(p.lon - t.lon, 2) + pow(p.lat - t.lat, 2)) AS distance FROM tll t, pts p)
SELECT CAST(target_id AS BIGINT) AS target_id, CAST(arg_min(point_id, distance) AS BIGINT) AS point_id, round(min(distance), 6) AS distance FROM d GROUP BY target_id""",
)
def j8_nearest_point(spark, sf_dir):
    """Nearest of all source points, on a sheared grid, for every target cell centre."""
    points = (
        views.big_cells(spark, sf_dir).where("dbz is not null").select("source_id", "row", "col").distinct().select(
            (F.col("source_id") * 256 + F.col("row") * 16 + F.col("col")).cast("bigint").alias("point_id"),
            (F.col("source_id") * 0.5 + 10.0 + F.col("col") * 0.25 + F.col("row") * 0.01).alias("lon"),
            (F.lit(50.0) - F.col("source_id") * 0.25 - F.col("row") * 0.25 + F.col("col") * 0.013).alias("lat"),
        )
    )
    grid = views.big_target()
    dst_row, dst_col = F.floor(F.col("id") / grid.width), F.col("id") % grid.width
    lon, lat = grid.centre_lonlat(dst_row, dst_col)
    targets = spark.range(grid.cells).select(F.col("id").alias("target_id"), lon.alias("lon"), lat.alias("lat"))
    return regrid.nearest_point(targets, points).select("target_id", "point_id", r6("distance").alias("distance"))


@query(
    "j9_bilinear",
    f"""WITH {ctes.BIG}, t AS (SELECT slot, CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col,
   greatest(0, least(15.0::DOUBLE, (49.875 - (49.9 - r * (4.05::DOUBLE / 19))) / 0.25)) AS fr,
   greatest(0, least(15.0::DOUBLE, (10.05 + c * (4.0::DOUBLE / 22) - 10.125) / 0.25)) AS fc
   FROM (SELECT DISTINCT slot FROM big WHERE source_id = 0), range(20) a(r), range(23) b(c)),
corners AS (SELECT slot, dst_row, dst_col, fr, fc, floor(fr) + dr AS "row", floor(fc) + dc AS col,
   (1 - abs(fr - floor(fr) - dr)) * (1 - abs(fc - floor(fc) - dc)) AS w FROM t, range(2) p(dr), range(2) q(dc)),
v AS (SELECT k.*, b.dbz FROM corners k LEFT JOIN (SELECT * FROM big WHERE source_id = 0) b ON b.slot = k.slot AND b."row" = k."row" AND b.col = k.col WHERE w > 0)
SELECT slot, dst_row, dst_col, round(greatest(-35, least(85, sum(w * dbz))), 6) AS dbz FROM v GROUP BY slot, dst_row, dst_col HAVING count(*) = count(dbz)""",
)
def j9_bilinear(spark, sf_dir):
    src = views.big_grids()[0]
    cells = views.big_cells(spark, sf_dir).where("source_id = 0")
    out = regrid.bilinear(cells, ["slot"], src, (49.9, 49.9 - 4.05, 20), (10.05, 14.05, 23))
    return merged_out(out)


RESAMPLE = f"""WITH {ctes.BIG_PLACED}, {ctes.SCALE}, m AS (SELECT slot, dst_row AS "row", dst_col AS col, max(dbz) AS dbz FROM placed GROUP BY ALL),
drawn AS (SELECT slot, "row", col, r, g, b, 255 AS a FROM m JOIN lut ON idx = CAST(trunc(least(255, greatest(0, (dbz + 35) / 120 * 255))) AS INT) WHERE dbz >= 10),
taps AS (SELECT o AS dst, i AS src, (i - (o + 0.5::DOUBLE) * 2 + 0.5) / 2 AS x FROM range(14) p(o), range(28) q(i) WHERE i >= greatest(0, trunc((o + 0.5::DOUBLE) * 2 - 6 + 0.5)) AND i < least(28, trunc((o + 0.5::DOUBLE) * 2 + 6 + 0.5))),
lz AS (SELECT dst, src, CASE WHEN x = 0 THEN 1 WHEN abs(x) < 3 THEN sin(x * pi()) / (x * pi()) * (sin(x / 3 * pi()) / (x / 3 * pi())) ELSE 0 END AS w FROM taps),
wt AS (SELECT dst, src, CAST(round(w / sum(w) OVER (PARTITION BY dst) * 4194304) AS BIGINT) AS w FROM lz),
h AS (SELECT slot, "row", dst AS col, {", ".join(f"greatest(0, least(255, (sum(w * {c}) + 2097152) // 4194304)) AS {c}" for c in "rgba")} FROM drawn JOIN wt ON col = src GROUP BY slot, "row", dst),
v AS (SELECT slot, dst AS "row", col, {", ".join(f"greatest(0, least(255, (sum(w * {c}) + 2097152) // 4194304)) AS {c}" for c in "rgba")} FROM h JOIN wt ON "row" = src GROUP BY slot, dst, col)
SELECT slot, CAST("row" AS INT) AS "row", CAST(col AS INT) AS col, {", ".join(f"CAST(CASE WHEN a = 255 THEN {c} ELSE least(255, {c} * 255 // a) END AS INT) AS {c}" for c in "rgb")}, CAST(a AS INT) AS a FROM v WHERE a > 0"""


@query("r7_resample", RESAMPLE)
def r7_resample(spark, sf_dir):
    """Max mosaics drawn and scaled down by Lanczos weights."""
    from ..operators import render

    merged = mosaic.merge(placed_big(spark, sf_dir), ["slot"], "max")
    drawn = render.render(merged).select("slot", F.col("dst_row").alias("row"), F.col("dst_col").alias("col"), "r", "g", "b", "a")
    return render.resample(drawn, ["slot"], (28, 28), (14, 14))


# --- coverage -------------------------------------------------------------------------------------


@query(
    "a11_coverage_fraction",
    f"""WITH {ctes.RAW} SELECT source, slot, CAST(count_if(source = 'arso' OR raw <> 255) AS BIGINT) AS covered_cells,
 round(avg(CASE WHEN source = 'arso' OR raw <> 255 THEN 1.0::DOUBLE ELSE 0 END), 6) AS fraction FROM raw_cells GROUP BY ALL""",
)
def a11_coverage_fraction(spark, sf_dir):
    cells = views.raw_cells(spark, sf_dir).withColumn("covered", coverage.covered(F.col("raw"), F.col("source")))
    return coverage.coverage_fraction(cells, ["source", "slot"]).withColumn("fraction", r6("fraction"))


def masks(spark, sf_dir):
    """Published mask of each source, 16 x 16 Mercator cells: where it ever had a value of at least 40 dBZ."""
    return (
        views.big_cells(spark, sf_dir).where("dbz >= 40 and (row + col + source_id) % 7 <> 0").select("source_id", "priority", "row", "col").distinct()
    )


def placed_masks(spark, sf_dir):
    grids = {
        i: Grid.of_shape((g.left, g.left + g.px * g.width, g.top - g.py * g.height, g.top), g.height, g.width)
        for i, g in views.big_grids().items()
    }
    return coverage.placed_masks(masks(spark, sf_dir), grids, Grid.of_shape(views.TARGET_EXTENT, 33, 37))


MASKS = f"""{ctes.BIG}, mask AS (SELECT DISTINCT source_id, "row", col FROM big WHERE dbz >= 40 AND ("row" + col + source_id) % 7 <> 0),
b AS (SELECT 10.0::DOUBLE * 20037508.34 / 180 AS x0, 17.0::DOUBLE * 20037508.34 / 180 AS x1,
   ln(tan((90.0::DOUBLE + 45) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y0,
   ln(tan((90.0::DOUBLE + 50.1) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y1),
s AS (SELECT CAST(id AS INT) AS source_id, (10 + 0.5::DOUBLE * id) * 20037508.34 / 180 AS west, (14 + 0.5::DOUBLE * id) * 20037508.34 / 180 AS east,
   ln(tan((90.0::DOUBLE + 46 - 0.25 * id) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS south,
   ln(tan((90.0::DOUBLE + 50 - 0.25 * id) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS north FROM range(6) g(id)),
t AS (SELECT source_id, CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col,
   floor((north - (y1 - (r + 0.5::DOUBLE) * (y1 - y0) / 33)) / ((north - south) / 16)) AS "row",
   floor((x0 + (c + 0.5::DOUBLE) * (x1 - x0) / 37 - west) / ((east - west) / 16)) AS col FROM b, s, range(33) p(r), range(37) q(c)),
placed AS (SELECT source_id, dst_row, dst_col FROM t JOIN mask USING (source_id, "row", col))"""


@query("j14_place_mask", f"WITH {MASKS} SELECT source_id, dst_row, dst_col FROM placed")
def j14_place_mask(spark, sf_dir):
    return placed_masks(spark, sf_dir).select("source_id", "dst_row", "dst_col")


@query(
    "j15_mask_to_published_grid",
    f"""WITH {ctes.RAW}, {ctes.gmap(14, 0.5, 8)}, seen AS (SELECT DISTINCT source_id, "row", col FROM raw_cells WHERE source = 'arso' OR raw <> 255)
SELECT source_id, dst_row, dst_col FROM seen JOIN gmap USING (source_id, "row", col)""",
)
def j15_mask_to_published_grid(spark, sf_dir):
    """Native coverage on the published Web Mercator grid."""
    raw = views.raw_cells(spark, sf_dir).where(coverage.covered(F.col("raw"), F.col("source")))
    native = raw.select("source_id", "row", "col").distinct()
    return regrid.scatter_all(native, views.small_grids(), views.small_target()).select("source_id", "dst_row", "dst_col")


@query(
    "a12_coverage_or",
    f"""WITH {MASKS}, u AS (SELECT dst_row, dst_col, min(source_id) AS priority FROM placed GROUP BY ALL),
n AS (SELECT priority, count(*) AS new_cells FROM u GROUP BY priority)
SELECT priority, new_cells, CAST(sum(new_cells) OVER (ORDER BY priority) AS BIGINT) AS total_cells,
 round(sum(new_cells) OVER (ORDER BY priority) / (33 * 37.0::DOUBLE), 6) AS fraction FROM n""",
)
def a12_coverage_or(spark, sf_dir):
    return coverage.mask_gains(placed_masks(spark, sf_dir), 33 * 37).withColumn("fraction", r6("fraction"))


@query(
    "r6_coverage_colours",
    f"""WITH {MASKS}, u AS (SELECT DISTINCT dst_row, dst_col FROM placed), img AS (SELECT CAST(r AS INT) AS dst_row, CAST(c AS INT) AS dst_col,
  CASE WHEN u.dst_row IS NULL THEN 128 ELSE 0 END AS v, CASE WHEN u.dst_row IS NULL THEN 255 ELSE 0 END AS a
  FROM range(33) p(r) CROSS JOIN range(37) q(c) LEFT JOIN u ON u.dst_row = r AND u.dst_col = c)
SELECT dst_row, dst_col, CAST(v AS INT) AS r, CAST(v AS INT) AS g, CAST(v AS INT) AS b, CAST(a AS INT) AS a, a = 0 AS covered FROM img""",
)
def r6_coverage_colours(spark, sf_dir):
    grid = Grid.of_shape(views.TARGET_EXTENT, 33, 37)
    union = coverage.union_mask(placed_masks(spark, sf_dir))
    return coverage.mask_image(spark, union, grid).withColumn("covered", covered_of_alpha(F.col("a")))

"""Mosaics and regridding by raster lines, for services of different projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..operators import runs, strips
from ..operators.regrid import SourceGrid
from . import ctes
from .function_queries import AZIMUTHAL, CONE, OFFSET_MERCATOR, STEREO
from .plan_queries import standard_scans
from .registry import minute_text, query, r6
from .source_queries import LANDED

FMT = "%Y%m%d%H%M"

#: left, top and cell size of each service in its own projection, in the order of the services
PLACES = [
    (500_000.0, -700_000.0, 70_000.0),
    (-100_000.0, -400_000.0, 80_000.0),
    (0.0, -300_000.0, 60_000.0),
    (11.5, 49.25, 0.5),
    (-200.0, 150.0, 50.0),
    (-600_000.0, -150_000.0, 60_000.0),
]
FAMILIES = [STEREO, OFFSET_MERCATOR, OFFSET_MERCATOR, None, CONE, AZIMUTHAL]


def projected_grids() -> dict[str, SourceGrid]:
    from ..dimensions import SOURCE_NAMES

    made = {}
    for name, (left, top, px), projection in zip(SOURCE_NAMES, PLACES, FAMILIES, strict=True):
        made[name] = SourceGrid(left, top, px, px, 8, 8, projection) if projection else SourceGrid(left, top, px, px, 8, 8)
    return made


NATIVE = f"""{ctes.target(14)}, pt AS (SELECT *, radians(lon) AS lam, radians(lat) AS phi FROM tll),
k AS (SELECT sqrt(1 - pow(6356752.3142451802 / 6378137.0, 2)) AS e, sqrt(1 - pow(6356752.314245179 / 6378137.0, 2)) AS em, radians(60.0) AS ts, radians(46.12) AS c0, sin(radians(46.12)) AS n, radians(52.3469) AS p0),
st AS (SELECT *, 6378137.0 * cos(ts) / sqrt(1 - pow(e * sin(ts), 2)) / (tan(pi() / 4 - ts / 2) / pow((1 - e * sin(ts)) / (1 + e * sin(ts)), e / 2)) * tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) AS rho FROM pt, k),
co AS (SELECT *, 6371.0::DOUBLE * cos(c0) * pow(tan(pi() / 4 + c0 / 2), n) / n AS rf FROM pt, k),
az AS (SELECT *, acos(sin(phi) * sin(p0) + cos(phi) * cos(p0) * cos(lam - radians(19.0926))) AS c FROM pt, k),
me AS (SELECT dst_row, dst_col, 6378137.0 * lam - 1254222.15 AS x, 6378137.0 * ln(tan(pi() / 4 + phi / 2) * pow((1 - em * sin(phi)) / (1 + em * sin(phi)), em / 2)) - 6702777.85 AS y FROM pt, k),
nat AS (SELECT 0 AS source_id, dst_row, dst_col, rho * sin(lam - radians(10.0)) + 543196.83521776402 AS x, 3622588.8619310022 - rho * cos(lam - radians(10.0)) AS y FROM st
 UNION ALL SELECT 1, * FROM me UNION ALL SELECT 2, * FROM me UNION ALL SELECT 3, dst_row, dst_col, lon, lat FROM pt
 UNION ALL SELECT 4, dst_row, dst_col, rf / pow(tan(pi() / 4 + phi / 2), n) * sin(n * (lam - radians(14.815))), rf / pow(tan(pi() / 4 + c0 / 2), n) - rf / pow(tan(pi() / 4 + phi / 2), n) * cos(n * (lam - radians(14.815))) FROM co
 UNION ALL SELECT 5, dst_row, dst_col, 6371000.0 * c / sin(c) * cos(phi) * sin(lam - radians(19.0926)), 6371000.0 * c / sin(c) * (sin(phi) * cos(p0) - cos(phi) * sin(p0) * cos(lam - radians(19.0926))) FROM az),
place(source_id, x0, y0, px) AS (VALUES {", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for i, (a, b, c) in enumerate(PLACES))}),
frac AS (SELECT source_id, dst_row, dst_col, (y0 - y) / px AS fr, (x - x0) / px AS fc FROM nat JOIN place USING (source_id))"""


@query(
    "j7_line_mosaic",
    f"""WITH {LANDED}, {NATIVE}, m AS (SELECT source_id, dst_row, dst_col, CAST(floor(fr) AS INT) AS "row", CAST(floor(fc) AS INT) AS col FROM frac WHERE fr >= 0 AND fr < 8 AND fc >= 0 AND fc < 8)
SELECT strftime(any_value(ts),'{FMT}') AS slot, dst_row, dst_col, round(max(dbz), 6) AS dbz, count(DISTINCT source_id) AS services FROM dec JOIN m USING (source_id, "row", col) WHERE dbz IS NOT NULL GROUP BY slot, dst_row, dst_col""",
)
def j7_line_mosaic(spark, sf_dir):
    """All scans of services in five projection families on one grid: lines, not pixels, are joined and moved.

    The number of services per cell comes from a second strategy over the same lines (an average of ones)."""
    grids, dst = projected_grids(), views.small_target()
    lines = strips.strips(standard_scans(spark, sf_dir).withColumnRenamed("ts", "slot"), ["slot", "source"])
    index = runs.index_runs(spark, dict(enumerate(grids.values())), dst, block_lines=4)
    top = runs.run_mosaic(lines, grids, dst, ["slot"], "max", index)
    seen = runs.placed_lines(lines, grids, dst, ["slot"], index).groupBy("slot", "block", "dst_row", "dst_col").agg(F.count_distinct("source_id").alias("services"))
    out = top.join(seen, ["slot", "dst_row", "dst_col"])
    return out.select(minute_text("slot").alias("slot"), "dst_row", "dst_col", r6("dbz").alias("dbz"), "services")


@query(
    "j9_bilinear_services",
    f"""WITH {LANDED}, {NATIVE}, w AS (SELECT source_id, dst_row, dst_col, greatest(0, least(7.0::DOUBLE, fr - 0.5)) AS fr, greatest(0, least(7.0::DOUBLE, fc - 0.5)) AS fc FROM frac WHERE fr BETWEEN 0 AND 8 AND fc BETWEEN 0 AND 8),
corners AS (SELECT source_id, dst_row, dst_col, CAST(floor(fr) + dr AS INT) AS "row", CAST(floor(fc) + dc AS INT) AS col, (1 - abs(fr - floor(fr) - dr)) * (1 - abs(fc - floor(fc) - dc)) AS w FROM w, range(2) p(dr), range(2) q(dc)),
v AS (SELECT d.source, d.ts, c.dst_row, c.dst_col, c.w, d.dbz FROM corners c JOIN dec d USING (source_id, "row", col) WHERE c.w > 0)
SELECT source, strftime(ts,'{FMT}') AS slot, dst_row, dst_col, round(greatest(-35, least(85, sum(w * dbz))), 5) AS dbz FROM v GROUP BY source, ts, dst_row, dst_col HAVING count(*) = count(dbz)""",
)
def j9_bilinear_services(spark, sf_dir):
    """Bilinear values of all six services, each in its own projection, by stored weights and raster lines."""
    grids, dst = projected_grids(), views.small_target()
    lines = strips.strips(standard_scans(spark, sf_dir).withColumnRenamed("ts", "slot"), ["slot", "source"])
    weights = runs.weight_lines(spark, dict(enumerate(grids.values())), dst, block_lines=4, clamp=False)
    out = runs.weighted_lines(lines, grids, dst, ["slot"], weights)
    return out.select("source", minute_text("slot").alias("slot"), "dst_row", "dst_col", F.round(F.col("dbz").cast("double"), 5).alias("dbz"))

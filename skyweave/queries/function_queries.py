"""Projections, geometry, colours and small functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..dimensions import QUANTITY_UNITS, REFERENCE_EXTENT
from ..functions import attrs as A
from ..functions import colour as K
from ..functions import proj as P
from ..operators import mosaic, regrid, render
from ..sources import sinks, srd
from . import ctes
from .registry import query, r6

PTS = """pts AS (SELECT event_id, (event_id * 37 % 1700) / 100.0::DOUBLE + 5.0 AS lon, (user_id * 13 % 1100) / 100.0::DOUBLE + 44.5 AS lat FROM events),
rad AS (SELECT *, radians(lon) AS lam, radians(lat) AS phi FROM pts)"""

# public parameters of three national grids, used here as sample projections
STEREO = P.Projection.of("+proj=stere +lat_ts=60 +lat_0=90 +lon_0=10 +x_0=543196.83521776402 +y_0=3622588.8619310022 +a=6378137 +b=6356752.3142451802 +units=m +no_defs")
AZIMUTHAL = P.Projection.of("+proj=aeqd +lat_0=52.3469 +lon_0=19.0926 +R=6371000 +units=m")
OFFSET_MERCATOR = P.Projection.of("+proj=merc +lat_ts=0 +lon_0=0 +x_0=-1254222.15 +y_0=-6702777.85 +ellps=WGS84 +units=m")
CONE = P.Projection.of(srd.SRD_PROJECTION)


def r3(column):
    return F.round(column, 3)


@query(
    "c1_web_mercator",
    f"WITH {PTS} SELECT event_id, round(lon * 20037508.34 / 180, 3) AS x, round(ln(tan((90 + lat) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180, 3) AS y FROM pts",
)
def c1_web_mercator(spark, sf_dir):
    x, y = P.mercator(F.col("lon"), F.col("lat"))
    return views.points(spark, sf_dir).select("event_id", r3(x).alias("x"), r3(y).alias("y"))


@query(
    "c2_web_mercator_inverse",
    f"""WITH {PTS}, m AS (SELECT event_id, round(lon * 20037508.34 / 180, 3) AS x, round(ln(tan((90 + lat) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180, 3) AS y FROM pts)
SELECT event_id, round(x / 20037508.34 * 180, 6) AS lon, round(atan(exp(y / 20037508.34 * pi())) * 360 / pi() - 90, 6) AS lat FROM m""",
)
def c2_web_mercator_inverse(spark, sf_dir):
    lon, lat = P.lonlat(F.col("x"), F.col("y"))
    return c1_web_mercator(spark, sf_dir).select("event_id", r6(lon).alias("lon"), r6(lat).alias("lat"))


CONE_SQL = f"""{PTS}, k AS (SELECT sin(radians(46.12)) AS n, 6371.0::DOUBLE * cos(radians(46.12)) * pow(tan(pi() / 4 + radians(46.12) / 2), sin(radians(46.12))) / sin(radians(46.12)) AS rf),
cone AS (SELECT event_id, rf / pow(tan(pi() / 4 + phi / 2), n) AS rho, rf / pow(tan(pi() / 4 + radians(46.12) / 2), n) AS rho0, n * (lam - radians(14.815)) AS theta FROM rad, k)"""


@query("c5_conformal_cone", f"WITH {CONE_SQL} SELECT event_id, round(rho * sin(theta), 3) AS x, round(rho0 - rho * cos(theta), 3) AS y FROM cone")
def c5_conformal_cone(spark, sf_dir):
    x, y = P.to_native(CONE, F.col("lon"), F.col("lat"))
    return views.points(spark, sf_dir).select("event_id", r3(x).alias("x"), r3(y).alias("y"))


@query("c3_generic_transform", f"WITH {PTS} SELECT event_id, round(lon * 20037508.34 / 180, 1) AS x, round(ln(tan((90 + lat) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180, 1) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM pts")
def c3_generic_transform(spark, sf_dir):
    """Through the cone to Web Mercator, and back to lon/lat."""
    kx, ky = P.to_native(CONE, F.col("lon"), F.col("lat"))
    x, y = P.transform(CONE, regrid.WEB, F.col("kx"), F.col("ky"))
    lon, lat = P.to_lonlat(CONE, F.col("kx"), F.col("ky"))
    return views.points(spark, sf_dir).select("event_id", kx.alias("kx"), ky.alias("ky")).select(
        "event_id", F.round(x, 1).alias("x"), F.round(y, 1).alias("y"), r6(lon).alias("lon"), r6(lat).alias("lat")
    )


@query(
    "c4_projection_text",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'longlat' WHEN 1 THEN 'merc' ELSE 'lcc' END AS family, CASE event_id % 3 WHEN 0 THEN NULL ELSE CAST(event_id % 90 AS VARCHAR) END AS lon_0, event_id % 3 = 0 AS is_longlat FROM events""",
)
def c4_projection_text(spark, sf_dir):
    k = F.col("event_id") % 3
    text = F.when(k == 0, " +proj=longlat +datum=WGS84 +no_defs ").otherwise(
        F.format_string("+proj=%s +lon_0=%d +units=m +no_defs", F.when(k == 1, "merc").otherwise("lcc"), F.col("event_id") % 90)
    )
    keys = P.parse_proj(F.col("text"))
    return views.table(spark, sf_dir, "events").select("event_id", text.alias("text")).select(
        "event_id", F.try_element_at(keys, F.lit("proj")).alias("family"), F.try_element_at(keys, F.lit("lon_0")).alias("lon_0"), P.is_longlat(F.col("text")).alias("is_longlat")
    )


@query(
    "c6_mercator_with_offsets",
    f"""WITH {PTS}, e AS (SELECT sqrt(1 - pow(6356752.314245179 / 6378137.0, 2)) AS e) SELECT event_id, round(6378137.0 * lam - 1254222.15, 3) AS x,
 round(6378137.0 * ln(tan(pi() / 4 + phi / 2) * pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2)) - 6702777.85, 3) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM rad, e""",
)
def c6_mercator_with_offsets(spark, sf_dir):
    x, y = P.to_native(OFFSET_MERCATOR, F.col("lon"), F.col("lat"))
    lon, lat = P.to_lonlat(OFFSET_MERCATOR, F.col("x"), F.col("y"))
    return views.points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y")).select(
        "event_id", r3(F.col("x")).alias("x"), r3(F.col("y")).alias("y"), r6(lon).alias("lon"), r6(lat).alias("lat")
    )


@query(
    "c7_polar_stereographic",
    f"""WITH {PTS}, c AS (SELECT sqrt(1 - pow(6356752.3142451802 / 6378137.0, 2)) AS e, radians(60.0) AS ts),
t AS (SELECT event_id, lon, lat, lam, tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) AS t, 6378137.0 * cos(ts) / sqrt(1 - pow(e * sin(ts), 2)) / (tan(pi() / 4 - ts / 2) / pow((1 - e * sin(ts)) / (1 + e * sin(ts)), e / 2)) AS k FROM rad, c)
SELECT event_id, round(k * t * sin(lam - radians(10.0)) + 543196.83521776402, 3) AS x, round(3622588.8619310022 - k * t * cos(lam - radians(10.0)), 3) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM t""",
)
def c7_polar_stereographic(spark, sf_dir):
    x, y = P.to_native(STEREO, F.col("lon"), F.col("lat"))
    lon, lat = P.to_lonlat(STEREO, F.col("x"), F.col("y"))
    return views.points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y")).select(
        "event_id", r3(F.col("x")).alias("x"), r3(F.col("y")).alias("y"), r6(lon).alias("lon"), r6(lat).alias("lat")
    )


@query(
    "c8_azimuthal_equidistant",
    f"""WITH {PTS}, a AS (SELECT *, radians(52.3469) AS p0, lam - radians(19.0926) AS d FROM rad), c AS (SELECT *, acos(sin(phi) * sin(p0) + cos(phi) * cos(p0) * cos(d)) AS c FROM a)
SELECT event_id, round(6371000.0 * c / sin(c) * cos(phi) * sin(d), 3) AS x, round(6371000.0 * c / sin(c) * (sin(phi) * cos(p0) - cos(phi) * sin(p0) * cos(d)), 3) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM c""",
)
def c8_azimuthal_equidistant(spark, sf_dir):
    x, y = P.to_native(AZIMUTHAL, F.col("lon"), F.col("lat"))
    lon, lat = P.to_lonlat(AZIMUTHAL, F.col("x"), F.col("y"))
    return views.points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y")).select(
        "event_id", r3(F.col("x")).alias("x"), r3(F.col("y")).alias("y"), r6(lon).alias("lon"), r6(lat).alias("lat")
    )


SCAN_BOXES = """box AS (SELECT vec_id, vec_id % 5 <> 0 AS cor, 10 + 0.5::DOUBLE * (vec_id % 6) + (vec_id // 6 % 10) * 0.001::DOUBLE AS w FROM embeddings)"""
MERC = "ln(tan(pi() / 4 + radians({0}) / 2))"


def corner_scans(spark, sf_dir):
    """Scans with all four corners given (the stereographic service's, taken for Mercator here)."""
    return views.landed(spark, sf_dir).where("source = 'dwd' and scan_id % 5 <> 0")


SPHERE_MERC = P.Projection.of("+proj=merc +R=6371000 +lon_0=0 +units=m")


@query(
    "c9_native_geometry",
    f"""WITH {SCAN_BOXES}, b AS (SELECT vec_id, w FROM box WHERE vec_id % 6 = 0 AND cor), n AS (SELECT vec_id, 6371000.0 * radians(w) AS ulx, 6371000.0 * radians(w + 4.1) AS urx,
  6371000.0 * {MERC.format('49.0')} AS uly, 6371000.0 * {MERC.format('44.0')} AS lly FROM b)
SELECT vec_id AS scan_id, round((urx - ulx) / 7, 3) AS px, round((uly - lly) / 7, 3) AS py, round(ulx - (urx - ulx) / 14, 3) AS "left", round(urx + (urx - ulx) / 14, 3) AS "right",
 round(lly - (uly - lly) / 14, 3) AS bottom, round(uly + (uly - lly) / 14, 3) AS top FROM n""",
)
def c9_native_geometry(spark, sf_dir):
    g = P.native_affine(SPHERE_MERC, F.col("where_attrs"), F.col("height"), F.col("width"))
    out = corner_scans(spark, sf_dir).select("scan_id", g.alias("g")).select("scan_id", "g.*")
    return out.select("scan_id", *(r3(F.col(c)).alias(c) for c in ("px", "py", "left", "right", "bottom", "top")))


@query(
    "c10_widened_extent",
    f"""WITH {SCAN_BOXES} SELECT vec_id AS scan_id, round(4.0::DOUBLE / 7, 6) AS px, round(5.0::DOUBLE / 7, 6) AS py, round(w - 4.0::DOUBLE / 14, 6) AS "left", round(w + 4 + 4.0::DOUBLE / 14, 6) AS "right",
 round(44 - 5.0::DOUBLE / 14, 6) AS bottom, round(49 + 5.0::DOUBLE / 14, 6) AS top, round(w, 6) AS edge_left FROM box WHERE vec_id % 6 IN (1, 2, 4, 5) AND cor""",
)
def c10_widened_extent(spark, sf_dir):
    """Both readings of an outline: of pixel centres, and of edges."""
    scans = views.landed(spark, sf_dir).where("source in ('shmu', 'chmi', 'arso', 'imgw') and scan_id % 5 <> 0")
    e = A.corner_extent(F.col("where_attrs"))
    args = [F.col(f"e.{b}") for b in ("west", "east", "south", "north")] + [F.col("height"), F.col("width")]
    out = scans.select("scan_id", "height", "width", e.alias("e")).select("scan_id", P.widen_centres(*args).alias("g"), P.edge_bounds(*args)["left"].alias("edge_left"))
    return out.select("scan_id", *(r6(F.col(f"g.{c}")).alias(c) for c in ("px", "py", "left", "right", "bottom", "top")), r6("edge_left").alias("edge_left"))


@query(
    "c11_target_grid",
    f"""WITH {PTS}, m AS (SELECT lon * 20037508.34 / 180 AS x, ln(tan((90 + lat) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y FROM pts),
e AS (SELECT 1.461077 * 20037508.34::DOUBLE / 180 AS x0, 26.376516 * 20037508.34::DOUBLE / 180 AS x1, ln(tan((90 + 44.001479) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y0, ln(tan((90 + 56.398335) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y1),
g AS (SELECT *, ceil((x1 - x0) / 50000) AS w, ceil((y1 - y0) / 50000) AS h FROM e)
SELECT CAST(floor((y1 - y) / ((y1 - y0) / h)) AS INT) AS dst_row, CAST(floor((x - x0) / ((x1 - x0) / w)) AS INT) AS dst_col, CAST(h AS INT) AS height, CAST(w AS INT) AS width, count(*) AS points FROM m, g GROUP BY ALL""",
)
def c11_target_grid(spark, sf_dir):
    """Points counted per cell of the reference grid at 50 km."""
    grid = P.Grid.at_resolution(REFERENCE_EXTENT, 50_000)
    x, y = P.mercator(F.col("lon"), F.col("lat"))
    row = F.floor((F.lit(grid.north) - y) / grid.dy).cast("int")
    col = F.floor((x - grid.west) / grid.dx).cast("int")
    return views.points(spark, sf_dir).groupBy(row.alias("dst_row"), col.alias("dst_col")).agg(F.count(F.lit(1)).alias("points")).withColumns(
        {"height": F.lit(grid.height), "width": F.lit(grid.width)}
    )


@query(
    "c12_default_output_grid",
    f"""WITH {SCAN_BOXES}, g AS (SELECT vec_id, w - 4.0::DOUBLE / 14 AS l, w + 4 + 4.0::DOUBLE / 14 AS r, 49 + 5.0::DOUBLE / 14 AS t, 44 - 5.0::DOUBLE / 14 AS b FROM box WHERE vec_id % 6 IN (1, 2, 4, 5) AND cor),
m AS (SELECT vec_id, l * 20037508.34 / 180 AS x0, r * 20037508.34 / 180 AS x1, ln(tan((90 + t) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y1, ln(tan((90 + b) * pi() / 360)) / (pi() / 180) * 20037508.34 / 180 AS y0 FROM g),
p AS (SELECT *, sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2)) / sqrt(128.0::DOUBLE) AS px FROM m)
SELECT vec_id AS scan_id, round(px, 2) AS pixel, CAST(floor((x1 - x0) / px + 0.5) AS INT) AS width, CAST(floor((y1 - y0) / px + 0.5) AS INT) AS height, round(x0, 2) AS "left", round(y1, 2) AS top FROM p""",
)
def c12_default_output_grid(spark, sf_dir):
    scans = views.landed(spark, sf_dir).where("source in ('shmu', 'chmi', 'arso', 'imgw') and scan_id % 5 <> 0")
    e = A.corner_extent(F.col("where_attrs"))
    args = [F.col(f"e.{b}") for b in ("west", "east", "south", "north")] + [F.col("height"), F.col("width")]
    geometry = scans.select("scan_id", "height", "width", e.alias("e")).select("scan_id", "height", "width", P.widen_centres(*args).alias("g")).select("scan_id", "height", "width", "g.*")
    grid = regrid.default_output_grid(geometry, "scan_id", P.Projection("longlat"))
    two = lambda c: F.round(F.col(c), 2).alias(c)
    return grid.select("scan_id", two("pixel"), "width", "height", two("left"), two("top"))


@query(
    "c13_corner_axes",
    f"""WITH {SCAN_BOXES}, b AS (SELECT vec_id, w FROM box WHERE vec_id % 6 = 0 AND cor)
SELECT vec_id AS scan_id, round(6371000.0 * radians(w - 0.05), 3) AS x_left, round(6371000.0 * radians(w + 4.1), 3) AS x_right, round(6371000.0 * {MERC.format('49.0')}, 3) AS y_top, round(6371000.0 * {MERC.format('44.0')}, 3) AS y_bottom FROM b""",
)
def c13_corner_axes(spark, sf_dir):
    axes = P.corner_axes(SPHERE_MERC, F.col("where_attrs"))
    out = corner_scans(spark, sf_dir).select("scan_id", axes.alias("a")).select("scan_id", "a.*")
    return out.select("scan_id", *(r3(F.col(c)).alias(c) for c in ("x_left", "x_right", "y_top", "y_bottom")))


@query(
    "c14_scaled_dimensions",
    f"""WITH {ctes.STAMPED}, r AS (SELECT event_id, source, CAST(event_id % 900 + 100 AS INT) AS height, CAST(user_id % 900 + 100 AS INT) AS width, CASE source WHEN 'dwd' THEN 1000.0::DOUBLE WHEN 'shmu' THEN 450 WHEN 'chmi' THEN 1550 WHEN 'omsz' THEN 900 WHEN 'imgw' THEN 1500 END AS native FROM stamped),
f AS (SELECT *, coalesce(native, (50.5 - 45.5) * 111320.0::DOUBLE * cos(radians(48.0)) / height) / 2000 AS f FROM r)
SELECT event_id, greatest(1, CAST(trunc(height * f) AS INT)) AS height, greatest(1, CAST(trunc(width * f) AS INT)) AS width FROM f""",
)
def c14_scaled_dimensions(spark, sf_dir):
    """Size at 2 km; one service's resolution is withheld and judged from its extent."""
    from ..dimensions import NATIVE_METRES, by_source

    native = by_source(F.col("source"), {k: v for k, v in NATIVE_METRES.items() if k not in ("arso", "composite")})
    height, width = (F.col("event_id") % 900 + 100).cast("int"), (F.col("user_id") % 900 + 100).cast("int")
    size = P.scaled_dimensions(height, width, F.lit(2000.0), native, F.lit(45.5), F.lit(50.5))
    return views.stamped_events(spark, sf_dir).select("event_id", size.alias("s")).select("event_id", "s.*")


@query("c15_degree_distance", f"WITH {PTS} SELECT event_id, round(sqrt(pow(lon - 19.15, 2) + pow(lat - 48.55, 2)), 6) AS distance FROM pts")
def c15_degree_distance(spark, sf_dir):
    d = P.degree_distance(F.col("lon"), F.col("lat"), 19.15, 48.55)
    return views.points(spark, sf_dir).select("event_id", r6(d).alias("distance"))


# --- colours --------------------------------------------------------------------------------------

@query(
    "r1_colour_index",
    f"""WITH {ctes.BIG} SELECT source, CAST(CASE WHEN dbz >= 10 THEN trunc(least(255, greatest(0, (dbz + 35) / 120 * 255))) ELSE 0 END AS INT) AS idx, dbz >= 10 AS visible, count(*) AS cells FROM big GROUP BY ALL""",
)
def r1_colour_index(spark, sf_dir):
    dbz = F.col("dbz").cast("double")
    idx = F.when(K.visible(dbz), K.colour_index(dbz)).otherwise(0)
    cells = views.big_cells(spark, sf_dir).where("dbz is not null")
    return cells.groupBy("source", idx.alias("idx"), K.visible(dbz).alias("visible")).agg(F.count(F.lit(1)).alias("cells"))


@query(
    "r2_colour_scale",
    f"WITH {ctes.BIG}, {ctes.SCALE}, used AS (SELECT CAST(floor(least(85, dbz) + 0.5) AS INT) AS dbz, count(*) AS cells FROM big GROUP BY ALL) SELECT dbz, r, g, b, cells FROM used JOIN scale USING (dbz)",
)
def r2_colour_scale(spark, sf_dir):
    """Steps of the scale that the data uses."""
    step = F.floor(F.least(F.lit(85.0), F.col("dbz").cast("double")) + 0.5).cast("int")
    used = views.big_cells(spark, sf_dir).where("dbz is not null").groupBy(step.alias("dbz")).agg(F.count(F.lit(1)).alias("cells"))
    return used.join(F.broadcast(K.colour_scale(spark)), "dbz")  # 121 rows


@query(
    "r3_colour_table",
    f"""WITH {ctes.BIG}, {ctes.SCALE}, used AS (SELECT CAST(trunc(least(255, greatest(0, (dbz + 35) / 120 * 255))) AS INT) AS idx, count(*) AS cells FROM big GROUP BY ALL)
SELECT idx, r, g, b, 255 AS a, cells FROM used JOIN lut USING (idx)""",
)
def r3_colour_table(spark, sf_dir):
    idx = K.colour_index(F.col("dbz").cast("double"))
    used = views.big_cells(spark, sf_dir).where("dbz is not null").groupBy(idx.alias("idx")).agg(F.count(F.lit(1)).alias("cells"))
    return used.join(F.broadcast(K.colour_lut(spark)), "idx")  # 256 rows


@query(
    "r4_colour_of_value",
    f"""WITH {ctes.SCALE}, v AS (SELECT l_orderkey, l_linenumber, l_quantity * 3 - 40 AS v FROM lineitem) SELECT l_orderkey, l_linenumber, r, g, b FROM v JOIN scale ON dbz = CAST(floor(greatest(-35, least(85, v)) + 0.5) AS INT)""",
)
def r4_colour_of_value(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", K.rgb_of_dbz(F.col("l_quantity") * 3 - 40).alias("c")).select("l_orderkey", "l_linenumber", "c.*")


@query(
    "r5_colour_choice",
    f"""WITH {ctes.STAMPED}, q AS (SELECT list_extract(['DBZH','th','ACRR','RATE','HGHT'], CAST(event_id % 5 AS INT) + 1) AS quantity, CASE WHEN user_id % 2 = 0 THEN 'dBZ' ELSE 'mm' END AS units FROM stamped)
SELECT quantity, units, 'reflectivity_shmu' AS colormap, NOT (units = 'dBZ' OR quantity IN ('DBZH','th')) AS stand_in, count(*) AS scans FROM q GROUP BY ALL""",
)
def r5_colour_choice(spark, sf_dir):
    quantity = F.element_at(F.array(*(F.lit(q) for q in ("DBZH", "th", "ACRR", "RATE", "HGHT"))), (F.col("event_id") % 5 + 1).cast("int"))
    units = F.when(F.col("user_id") % 2 == 0, "dBZ").otherwise("mm")
    rows = views.stamped_events(spark, sf_dir).select(quantity.alias("quantity"), units.alias("units")).groupBy("quantity", "units").agg(F.count(F.lit(1)).alias("scans"))
    return rows.select("quantity", "units", "scans", K.choose_colormap(F.col("units"), F.col("quantity")).alias("c")).select("quantity", "units", "scans", "c.*")


@query(
    "j16_colour_lookup",
    f"""WITH {ctes.BIG_PLACED}, {ctes.SCALE}, m AS (SELECT slot, dst_row, dst_col, max(dbz) AS dbz FROM placed GROUP BY ALL),
i AS (SELECT *, CAST(CASE WHEN dbz >= 10 THEN trunc(least(255, greatest(0, (dbz + 35) / 120 * 255))) ELSE 0 END AS INT) AS idx FROM m)
SELECT slot, dst_row, dst_col, r, g, b, CASE WHEN dbz >= 10 THEN 255 ELSE 0 END AS a FROM i JOIN lut USING (idx)""",
)
def j16_colour_lookup(spark, sf_dir):
    from .mosaic_queries import placed_big

    merged = mosaic.merge(placed_big(spark, sf_dir), ["slot"], "max")
    return render.render(merged).select("slot", "dst_row", "dst_col", "r", "g", "b", "a")


@query(
    "r8_variants",
    f"""WITH {ctes.CATALOG}, c AS (SELECT *, CASE source WHEN 'dwd' THEN 'germany' WHEN 'shmu' THEN 'slovakia' WHEN 'chmi' THEN 'czechia' WHEN 'omsz' THEN 'hungary' WHEN 'arso' THEN 'slovenia' ELSE 'poland' END AS folder,
  CASE source WHEN 'dwd' THEN 1000.0::DOUBLE WHEN 'shmu' THEN 450 WHEN 'chmi' THEN 1550 WHEN 'omsz' THEN 900 WHEN 'arso' THEN 1000 ELSE 1500 END AS native FROM catalog),
v(res, fmt) AS (SELECT * FROM (VALUES (NULL), (1000), (2000)) a(res), (VALUES ('png'), ('avif')) b(fmt))
SELECT source, folder || '/' || CAST(epoch(ts) AS BIGINT) || CASE WHEN res IS NULL THEN '' ELSE '@' || res || 'm' END || '.' || fmt AS file, CASE WHEN res IS NULL THEN 'full' ELSE '@' || res || 'm' END || '.' || fmt AS variant,
 upper(fmt) AS format, CASE WHEN res IS NULL THEN 'full' ELSE res || 'm' END AS resolution, CAST(CASE WHEN res IS NULL THEN 801 ELSE greatest(1, trunc(801 * (native / res))) END AS INT) AS out_height,
 CAST(CASE WHEN res IS NULL THEN 603 ELSE greatest(1, trunc(603 * (native / res))) END AS INT) AS out_width FROM c, v""",
)
def r8_variants(spark, sf_dir):
    rasters = sinks.located(views.scan_catalog(spark, sf_dir)).select(
        "source", "unix", "folder", F.lit(801).alias("height"), F.lit(603).alias("width"), F.lit(45.5).alias("south"), F.lit(50.5).alias("north")
    )
    found = render.variants(rasters, ["png", "avif"], [1000.0, 2000.0])
    return found.select("source", "file", "variant", "format", "resolution", "out_height", "out_width")


# --- small functions ------------------------------------------------------------------------------


@query(
    "g1_quantity_units",
    "WITH q AS (SELECT list_extract(['dbzh','TH','ACRR','rate','VRAD','RHOHV','ZDR','KDP','PHIDP','HGHT','XYZ'], CAST(event_id % 11 AS INT) + 1) AS quantity FROM events), u(k, units) AS (VALUES "
    + ", ".join(f"('{k}','{v}')" for k, v in QUANTITY_UNITS.items())
    + ") SELECT quantity, coalesce(units, 'unknown') AS units, count(*) AS scans FROM q LEFT JOIN u ON upper(quantity) = k GROUP BY ALL",
)
def g1_quantity_units(spark, sf_dir):
    names = ("dbzh", "TH", "ACRR", "rate", "VRAD", "RHOHV", "ZDR", "KDP", "PHIDP", "HGHT", "XYZ")
    quantity = F.element_at(F.array(*(F.lit(n) for n in names)), (F.col("event_id") % 11 + 1).cast("int"))
    rows = views.table(spark, sf_dir, "events").groupBy(quantity.alias("quantity")).agg(F.count(F.lit(1)).alias("scans"))
    return rows.withColumn("units", A.quantity_units(F.col("quantity")))


@query("g2_attribute_text", "SELECT event_id, event_type AS kind, props AS props_text FROM events")
def g2_attribute_text(spark, sf_dir):
    """Attributes that came as bytes, decoded."""
    as_bytes = F.create_map(F.lit("kind"), F.encode("event_type", "UTF-8"), F.lit("props"), F.encode("props", "UTF-8"))
    text = A.decode_bytes(as_bytes)
    return views.table(spark, sf_dir, "events").select("event_id", text["kind"].alias("kind"), text["props"].alias("props_text"))


@query(
    "g3_scan_metadata",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot, vec_id % 6 AS sid, vec_id % 4 <> 0 AS has FROM embeddings), t AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(slot * 5 AS INT)) AS ts FROM v)
SELECT vec_id AS scan_id, 'WMO' AS source, strftime(ts,'%Y%m%d') AS date, '' AS object, CASE WHEN sid = 5 AND vec_id % 3 = 0 THEN '' ELSE strftime(ts,'%H%M%S') END AS starttime, CASE WHEN has THEN 'DBZH' ELSE '' END AS quantity,
 CASE WHEN has THEN 0.5::DOUBLE ELSE 1 END AS gain, CASE WHEN has THEN 255.0::DOUBLE ELSE 65535 END AS nodata, 0.0::DOUBLE AS xsize FROM t""",
)
def g3_scan_metadata(spark, sf_dir):
    m = A.odim_metadata(F.col("what_global"), F.col("what_dataset"), F.col("what_data"), F.col("where_attrs"))
    return views.landed(spark, sf_dir).select("scan_id", m.alias("m")).select(
        "scan_id", "m.source", "m.date", "m.object", "m.starttime", "m.quantity", "m.gain", "m.nodata", "m.xsize"
    )


@query(
    "g4_geometry_key",
    f"""WITH {SCAN_BOXES} SELECT list_extract({ctes.NAMES}, CAST(vec_id % 6 AS INT) + 1) || '_8x8_' || substr(md5(CAST(CAST(round_even(w * 1000, 0) AS BIGINT) AS VARCHAR) || '_44000_' || CAST(CAST(round_even(w * 1000 + 4000, 0) AS BIGINT) AS VARCHAR) || '_49000'), 1, 8) || '_v1' AS geom_key, count(*) AS scans FROM box GROUP BY ALL""",
)
def g4_geometry_key(spark, sf_dir):
    sid = F.col("scan_id") % 6
    west = (sid * 0.5 + 10.0 + (F.col("slot") % 10) * 0.001) * 1000
    key = P.geometry_key(F.col("source"), F.col("height"), F.col("width"), [west, F.lit(44000.0), west + 4000, F.lit(49000.0)])
    return views.landed(spark, sf_dir).groupBy(key.alias("geom_key")).agg(F.count(F.lit(1)).alias("scans"))


@query(
    "g5_nested_json",
    """SELECT vec_id AS scan_id, '{"dims":[8,8],"first":' || CAST(label AS VARCHAR) || ',"source":{"id":' || CAST(vec_id % 6 AS VARCHAR) || '}}' AS json FROM embeddings""",
)
def g5_nested_json(spark, sf_dir):
    nested = F.struct(
        F.array(F.lit(8), F.lit(8)).alias("dims"), F.col("label").alias("first"), F.struct((F.col("vec_id") % 6).alias("id")).alias("source")
    )
    return views.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("scan_id"), F.to_json(nested).alias("json"))


@query(
    "g6_store_key",
    f"""WITH {ctes.STAMPED} SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE source END AS source, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'zmax' END AS product, CASE WHEN event_id % 5 = 0 THEN NULL ELSE strftime(ts,'%Y%m%d%H%M') END AS timestamp FROM stamped""",
)
def g6_store_key(spark, sf_dir):
    stem = F.when(F.col("event_id") % 5 == 0, F.concat_ws("_", "source", F.date_format("ts", "yyyyMMddHHmm"))).otherwise(
        F.concat_ws("_", "source", F.lit("zmax"), F.date_format("ts", "yyyyMMddHHmm"))
    )
    return views.stamped_events(spark, sf_dir).select("event_id", A.store_key(stem).alias("k")).select("event_id", "k.*")


@query(
    "a16_grid_map_statistics",
    f"""WITH {ctes.CELLS}, {ctes.gmap(14, 0.5, 8)}, used AS (SELECT DISTINCT source_id, "row", col FROM cells), m AS (SELECT gmap.* FROM gmap SEMI JOIN used USING (source_id, "row", col))
SELECT coalesce(source_id, -1) AS source_id, count(*) AS entries, round(count(*) * 4 / 1048576.0::DOUBLE, 6) AS size_mb FROM m GROUP BY ROLLUP (source_id)""",
)
def a16_grid_map_statistics(spark, sf_dir):
    """Statistics of the part of the map that the scans use."""
    mapping = regrid.grid_map(spark, views.small_grids(), views.small_target())
    used = views.cells(spark, sf_dir).select("source_id", "row", "col").distinct()
    found = regrid.map_statistics(mapping.join(used, ["source_id", "row", "col"], "left_semi"))
    return found.na.fill(-1, ["source_id"]).withColumn("size_mb", r6("size_mb"))

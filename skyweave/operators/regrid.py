"""Moving source cells onto a target grid.

Two ways to place nearest cells, with the same result:

* ``scatter`` for sources whose columns follow the meridians and rows the parallels (lon/lat and Mercator):
  every source cell works out the few target cells whose centres it holds. No join, no lookup table.
* ``grid_map`` + ``apply_grid_map`` for any projection: a table target cell -> source cell, built once per
  geometry and kept, then an equi join. ``tile_map`` + ``apply_tile_map`` is the same at tile grain, for large
  rasters: the join carries one row per tile, not per cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import REGRID_CLIP
from ..functions.attrs import clip
from ..functions.proj import Grid, Projection, mercator, to_lonlat, to_native, transform
from ..session import join_sized

WEB = Projection("webmerc")
SEPARABLE = ("longlat", "merc", "webmerc")


@dataclass(frozen=True)
class SourceGrid:
    """Geometry of a source raster: projection, outer left/top edge, cell size, shape (row 0 is north)."""

    left: float
    top: float
    px: float
    py: float
    height: int
    width: int
    projection: Projection = Projection("longlat")

    @staticmethod
    def of_centres(west, east, south, north, height, width, projection=Projection("longlat")) -> "SourceGrid":
        """From the outline of the outermost cell centres."""
        px = (east - west) / (width - 1) if width > 1 else 0.0
        py = (north - south) / (height - 1) if height > 1 else 0.0
        px, py = px or py or 1.0, py or px or 1.0  # one row or column: cells as wide as they are high
        return SourceGrid(west - px / 2, north + py / 2, px, py, height, width, projection)

    @staticmethod
    def of_edges(west, east, south, north, height, width, projection=Projection("longlat")) -> "SourceGrid":
        return SourceGrid(west, north, (east - west) / width, (north - south) / height, height, width, projection)


def _index(value: Column, origin: float, size: float, descending: bool, sampling: str, n: int) -> Column:
    """Source index of a coordinate, null outside.

    ``floor``: the cell that holds the point. ``edge_round``: the fractional index counted from the edge,
    rounded half to even and accepted from -0.5 to n - 0.5, clamped to the ends.
    """
    at = (F.lit(origin) - value) / size if descending else (value - origin) / size
    if sampling == "floor":
        index = F.floor(at).cast("int")
        return F.when((index >= 0) & (index < n), index)
    rounded = F.greatest(F.lit(0), F.least(F.lit(n - 1), F.rint(at).cast("int")))
    return F.when((at >= -0.5) & (at < n - 0.5), rounded)


def source_cell(src: SourceGrid, dst: Grid, row: Column, col: Column, sampling: str = "floor") -> tuple[Column, Column]:
    """Source row and column under the centre of a target cell; null when outside."""
    x, y = transform(WEB, src.projection, *dst.centre(row, col))
    return (
        _index(y, src.top, src.py, True, sampling, src.height),
        _index(x, src.left, src.px, False, sampling, src.width),
    )


def _outline(src: SourceGrid, dst: Grid) -> tuple[int, int, int, int]:
    """Target rows and columns a source can reach, with a margin; only prunes what the map has to visit."""
    import numpy as np

    if src.projection.family != "longlat":
        return 0, dst.height - 1, 0, dst.width - 1
    west, east = src.left, src.left + src.px * src.width
    south, north = src.top - src.py * src.height, src.top
    (x0, y0), (x1, y1) = Grid._metres(west, max(south, -85.0)), Grid._metres(east, min(north, 85.0))
    cols = np.clip([int((x0 - dst.west) / dst.dx) - 2, int((x1 - dst.west) / dst.dx) + 2], 0, dst.width - 1)
    rows = np.clip([int((dst.north - y1) / dst.dy) - 2, int((dst.north - y0) / dst.dy) + 2], 0, dst.height - 1)
    return int(rows[0]), int(rows[1]), int(cols[0]), int(cols[1])


def grid_map(spark, sources: dict[int, SourceGrid], dst: Grid, sampling: str = "floor") -> DataFrame:
    """(source_id, dst_row, dst_col, row, col): which source cell lies under each target cell.

    The target rows of all sources are one distributed range; each row unfolds its columns in its own task.
    """
    parts = []
    for source_id, src in sources.items():
        first_row, last_row, first_col, last_col = _outline(src, dst)
        rows = spark.range(first_row, last_row + 1).select(F.col("id").cast("int").alias("dst_row"))
        cells = rows.withColumn("dst_col", F.explode(F.sequence(F.lit(first_col), F.lit(last_col))))
        row, col = source_cell(src, dst, F.col("dst_row"), F.col("dst_col"), sampling)
        parts.append(
            cells.select(F.lit(source_id).alias("source_id"), "dst_row", "dst_col", row.alias("row"), col.alias("col")).where(
                "row is not null and col is not null"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def map_rows(sources: dict[int, SourceGrid], dst: Grid) -> int:
    """Upper bound of the rows of a grid map, for the broadcast rule."""
    total = 0
    for src in sources.values():
        r0, r1, c0, c1 = _outline(src, dst)
        total += (r1 - r0 + 1) * (c1 - c0 + 1)
    return total


def apply_grid_map(cells: DataFrame, mapping: DataFrame, mapping_rows: int) -> DataFrame:
    """Source cells on target cells: drops row/col, adds dst_row/dst_col."""
    return join_sized(cells, mapping, ["source_id", "row", "col"], mapping_rows).drop("row", "col")


def scatter(cells: DataFrame, src: SourceGrid, dst: Grid) -> DataFrame:
    """Place the cells of one separable source; the same target cells as the floor map gives.

    The reach of a cell is worked out from its edges, one target cell wider on each side, and the candidates
    are then held against the very rule of the map, so float edges fall the same way.
    """
    if src.projection.family not in SEPARABLE:
        raise ValueError("scatter needs a lon/lat or Mercator source; use the grid map")
    row, col = F.col("row"), F.col("col")
    edge_x = lambda at: at * src.px + src.left
    edge_y = lambda at: F.lit(src.top) - at * src.py
    x_of = lambda v: mercator(*to_lonlat(src.projection, v, F.lit(0.0)))[0]
    y_of = lambda v: mercator(*to_lonlat(src.projection, F.lit(0.0), v))[1]
    first_col = F.floor((x_of(edge_x(col)) - dst.west) / dst.dx - 0.5).cast("int")
    last_col = F.ceil((x_of(edge_x(col + 1)) - dst.west) / dst.dx - 0.5).cast("int")
    first_row = F.floor((F.lit(dst.north) - y_of(edge_y(row))) / dst.dy - 0.5).cast("int")
    last_row = F.ceil((F.lit(dst.north) - y_of(edge_y(row + 1))) / dst.dy - 0.5).cast("int")
    reach_row, reach_col = source_cell(src, dst, F.col("dst_row"), F.col("dst_col"))
    # a row depends on dst_row only and a column on dst_col only, so each filter runs before the next unfolding
    rows = unfold(cells, "dst_row", first_row, last_row, dst.height).where(reach_row == row)
    return unfold(rows, "dst_col", first_col, last_col, dst.width).where(reach_col == col).drop("row", "col")


def unfold(df: DataFrame, name: str, first: Column, last: Column, n: int) -> DataFrame:
    """One row per index from ``first`` to ``last``, both held inside 0..n-1.

    A range that lies outside leaves one index at the border; the caller's exact filter removes it. The ends are
    columns of their own, so that they are worked out once.
    """
    ends = df.withColumns({"_first": F.greatest(F.lit(0), F.least(F.lit(n - 1), first)), "_last": F.least(F.lit(n - 1), last)})
    return ends.withColumn(name, F.explode(F.sequence("_first", F.greatest("_first", "_last")))).drop("_first", "_last")


def scatter_all(cells: DataFrame, sources: dict[int, SourceGrid], dst: Grid) -> DataFrame:
    """Scatter cells of several separable sources at once: one pass, the geometry picked per row."""
    sid = F.col("source_id")
    pick = lambda name: _by_id(sid, {i: getattr(s, name) for i, s in sources.items()})
    left, top, px, py = (pick(n) for n in ("left", "top", "px", "py"))
    row, col = F.col("row"), F.col("col")
    if any(s.projection.family != "longlat" for s in sources.values()):
        raise ValueError("scatter_all takes lon/lat sources; use scatter per Mercator source")
    x0 = mercator(left + col * px, F.lit(0.0))[0]
    x1 = mercator(left + (col + 1) * px, F.lit(0.0))[0]
    y0 = mercator(F.lit(0.0), top - row * py)[1]
    y1 = mercator(F.lit(0.0), top - (row + 1) * py)[1]
    first_col = F.floor((x0 - dst.west) / dst.dx - 0.5).cast("int")
    last_col = F.ceil((x1 - dst.west) / dst.dx - 0.5).cast("int")
    first_row = F.floor((F.lit(dst.north) - y0) / dst.dy - 0.5).cast("int")
    last_row = F.ceil((F.lit(dst.north) - y1) / dst.dy - 0.5).cast("int")
    lat = dst.centre_lonlat(F.col("dst_row"), F.lit(0))[1]
    lon = dst.centre_lonlat(F.lit(0), F.col("dst_col"))[0]
    rows = unfold(cells, "dst_row", first_row, last_row, dst.height).where(F.floor((top - lat) / py) == row)
    return unfold(rows, "dst_col", first_col, last_col, dst.width).where(F.floor((lon - left) / px) == col).drop("row", "col")


def _by_id(sid: Column, values: dict[int, float]) -> Column:
    table = F.create_map(*(F.lit(v) for i, value in values.items() for v in (i, value)))
    return F.try_element_at(table, sid)


def to_tiles(cells: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Sparse tiles: one row per key and tile with its cells as (offset, dbz). At most size*size cells each."""
    row, col = F.col("row"), F.col("col")
    return cells.groupBy(
        *keys, F.floor(row / size).cast("int").alias("tile_row"), F.floor(col / size).cast("int").alias("tile_col")
    ).agg(
        F.map_from_entries(
            F.collect_list(F.struct(((row % size) * size + col % size).cast("int").alias("at"), F.col("dbz").alias("dbz")))
        ).alias("cells")
    )


def tile_map(mapping: DataFrame, size: int) -> DataFrame:
    """Grid map gathered per source tile: one row per (source_id, tile) listing (offset, dst_row, dst_col)."""
    row, col = F.col("row"), F.col("col")
    return mapping.groupBy(
        "source_id", F.floor(row / size).cast("int").alias("tile_row"), F.floor(col / size).cast("int").alias("tile_col")
    ).agg(F.collect_list(F.struct(((row % size) * size + col % size).cast("int").alias("at"), "dst_row", "dst_col")).alias("targets"))


def apply_tile_map(tiles: DataFrame, mapping: DataFrame, mapping_rows: int) -> DataFrame:
    """Source tiles on target cells; the join carries one row per tile and the cells unfold after it."""
    joined = join_sized(tiles, mapping, ["source_id", "tile_row", "tile_col"], mapping_rows)
    keep = [c for c in tiles.columns if c not in ("tile_row", "tile_col", "cells")]
    placed = F.filter(
        F.transform("targets", lambda t: F.struct(t["dst_row"].alias("dst_row"), t["dst_col"].alias("dst_col"), F.try_element_at("cells", t["at"]).alias("dbz"))),
        lambda t: t["dbz"].isNotNull(),
    )
    return joined.select(*keep, F.inline(placed))


def bilinear(cells: DataFrame, keys: list[str], src: SourceGrid, rows: tuple[float, float, int], cols: tuple[float, float, int]) -> DataFrame:
    """Bilinear values on regular target axes.

    ``cells(*keys, row, col, dbz)``; ``rows``/``cols`` are (first latitude/longitude, last, count) of the target.
    The fractional source position is clamped to the axis ends. A value is null when a needed corner is, or when
    the *nearest* source cell is. Each source cell offers itself, weighted, to the target cells it is a corner of,
    so one aggregate replaces four lookups.
    """
    (lat0, lat1, height), (lon0, lon1, width) = rows, cols
    lat_step = (lat1 - lat0) / (height - 1) if height > 1 else 0.0
    lon_step = (lon1 - lon0) / (width - 1) if width > 1 else 0.0
    first_lat, first_lon = src.top - src.py / 2, src.left + src.px / 2  # centres
    at_row = lambda r: F.greatest(F.lit(0.0), F.least(F.lit(src.height - 1.0), (F.lit(first_lat) - (r * lat_step + lat0)) / src.py))
    at_col = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(src.width - 1.0), (c * lon_step + lon0 - first_lon) / src.px))
    row, col = F.col("row"), F.col("col")

    # targets within one source step; those past an end are clamped to it, so end cells reach to the border
    def reach(index: Column, n: int, first: float, step_src: float, origin: float, step_dst: float, count: int):
        low = F.when(index == 0, F.lit(-1e9)).otherwise(index - 1.0)
        high = F.when(index == n - 1, F.lit(1e9)).otherwise(index + 1.0)
        if step_dst == 0:  # one target row or column: every source cell may reach it, and its weight decides
            return F.lit(0), F.lit(count - 1)
        a = F.floor((low * step_src + first - origin) / step_dst)
        b = F.ceil((high * step_src + first - origin) / step_dst)
        return F.greatest(F.least(a, b), F.lit(0)).cast("int"), F.least(F.greatest(a, b), F.lit(count - 1)).cast("int")

    r0, r1 = reach(row, src.height, first_lat, -src.py, lat0, lat_step, height)
    c0, c1 = reach(col, src.width, first_lon, src.px, lon0, lon_step, width)
    weight = lambda at, index: F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(at - index))
    nearest = lambda at: F.rint(at).cast("int")
    offered = (
        cells.where(F.col("dbz").isNotNull())
        .withColumn("dst_row", F.explode(F.when(r0 <= r1, F.sequence(r0, r1))))
        .withColumn("_at_row", at_row(F.col("dst_row")))
        .withColumn("_w_row", weight(F.col("_at_row"), row))
        .where(F.col("_w_row") > 0)
        .withColumn("dst_col", F.explode(F.when(c0 <= c1, F.sequence(c0, c1))))
        .withColumn("_at_col", at_col(F.col("dst_col")))
        .withColumn("_w_col", weight(F.col("_at_col"), col))
        .where(F.col("_w_col") > 0)
    )
    w = F.col("_w_row") * F.col("_w_col")
    is_nearest = (nearest(F.col("_at_row")) == row) & (nearest(F.col("_at_col")) == col)
    summed = offered.groupBy(*keys, "dst_row", "dst_col").agg(
        F.sum(w * F.col("dbz")).alias("_value"), F.sum(w).alias("_weight"), F.max(is_nearest).alias("_near")
    )
    # the weights of all needed corners add up to one; less means a corner is missing
    complete = F.col("_near") & (F.col("_weight") > 1.0 - 1e-9)
    return summed.where(complete).select(*keys, "dst_row", "dst_col", clip(F.col("_value"), REGRID_CLIP).alias("dbz"))


def nearest_point(targets: DataFrame, points: DataFrame, crowd: int = 64) -> DataFrame:
    """Nearest source point (Euclidean in degrees, no maximum distance) of every target; smaller id on a tie.

    ``targets(target_id, lon, lat)``, ``points(point_id, lon, lat)``. Distinct points are binned in a pyramid of
    squares whose finest bins hold at most ``crowd`` of them, however unevenly they lie. Every target goes down the
    pyramid: of the bins it still considers it keeps those whose nearest edge is not farther than the farthest
    corner of its best one, so only a handful remain, and only the points of the last few bins are compared. The
    answer is exact, and neither a crowded bin nor a far-off target makes the pairs grow.
    """
    lon, lat = F.col("lon"), F.col("lat")
    distinct = points.groupBy("lon", "lat").agg(F.min("point_id").alias("point_id"))
    west, east, south, north = points.agg(F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat")).first()  # four numbers
    if west is None:
        return targets.select("target_id", F.lit(None).cast("bigint").alias("point_id"), F.lit(None).cast("double").alias("distance")).limit(0)
    root = max(east - west, north - south, 1e-9) * (1 + 1e-9)

    def binned(level: int) -> DataFrame:
        side = root / 2**level
        return distinct.withColumns({"bx": F.floor((lon - west) / side), "by": F.floor((lat - south) / side)})

    depth = 2
    while depth < 26 and binned(depth).groupBy("bx", "by").count().agg(F.max("count")).first()[0] > crowd:
        depth += 2
    leaves = binned(depth)
    up = lambda c, n: F.floor(F.col(c) / 2**n)

    def boxes(level: int) -> DataFrame:
        n = depth - level
        return leaves.groupBy(up("bx", n).alias("_cx"), up("by", n).alias("_cy")).agg(
            F.min("lon").alias("_w"), F.max("lon").alias("_e"), F.min("lat").alias("_s"), F.max("lat").alias("_n")
        ).withColumns({"bx": up("_cx", 2), "by": up("_cy", 2)})

    apart = lambda low, high, at: F.greatest(F.lit(0.0), F.col(low) - at, at - F.col(high))
    across = lambda low, high, at: F.greatest(F.abs(F.col(low) - at), F.abs(F.col(high) - at))
    length = lambda dx, dy: F.sqrt(dx * dx + dy * dy)
    own = Window.partitionBy("target_id")
    looking = targets.select("target_id", "lon", "lat")
    for level in range(2, depth + 1, 2):
        if level == 2:  # at most sixteen boxes, which every target looks at
            names = ("_cx", "_cy", "_w", "_e", "_s", "_n")
            top = [F.struct(*(F.lit(box[n]).alias(n) for n in names)) for box in boxes(2).collect()]
            down = looking.select("*", F.inline(F.array(*top)))
        else:
            down = join_sized(looking, boxes(level), ["bx", "by"], 4**level)
        near = length(apart("_w", "_e", lon), apart("_s", "_n", lat))
        far = length(across("_w", "_e", lon), across("_s", "_n", lat))
        judged = down.withColumns({"_near": near, "_far": far}).withColumn("_best", F.min("_far").over(own))
        kept = judged.where(F.col("_near") <= F.col("_best") * (1 + 1e-12) + 1e-15)
        looking = kept.select("target_id", "lon", "lat", F.col("_cx").alias("bx"), F.col("_cy").alias("by"))
    ends = leaves.select("bx", "by", "point_id", F.col("lon").alias("_plon"), F.col("lat").alias("_plat"))
    distance = length(F.col("_plon") - lon, F.col("_plat") - lat)
    best = looking.join(ends.hint("merge"), ["bx", "by"]).groupBy("target_id").agg(
        F.min(F.struct(distance.alias("distance"), "point_id")).alias("_best")
    )
    return best.select("target_id", "_best.point_id", "_best.distance")


def default_output_grid(geometries: DataFrame, key: str, projection: Projection, steps: int = 20) -> DataFrame:
    """Size and bounds of the Web Mercator raster a source gets when no target is given.

    ``geometries(key, left, top, px, py, height, width)`` in native coordinates. Points along the outline are
    transformed; their bounds and a cell size that keeps the number of cells along the diagonal give the grid:
    (key, left, right, bottom, top, pixel, height, width). The outline is a fixed number of points per geometry.
    """
    c = F.col
    w, h = c("px") * c("width"), c("py") * c("height")
    x0, y0 = transform(projection, WEB, c("left"), c("top"))
    x1, y1 = transform(projection, WEB, c("left") + w, c("top") - h)
    cells_across = F.sqrt(c("width") * c("width") + c("height") * c("height"))
    pixel = F.sqrt(F.pow(x1 - x0, 2) + F.pow(y1 - y0, 2)) / cells_across
    side = lambda t: F.array(
        F.struct((c("left") + w * t).alias("nx"), c("top").alias("ny")),
        F.struct((c("left") + w * t).alias("nx"), (c("top") - h).alias("ny")),
        F.struct(c("left").alias("nx"), (c("top") - h * t).alias("ny")),
        F.struct((c("left") + w).alias("nx"), (c("top") - h * t).alias("ny")),
    )
    parts = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: side(i / float(steps)))
    outline = geometries.select(key, pixel.alias("pixel"), F.inline(F.flatten(parts)))
    mx, my = transform(projection, WEB, c("nx"), c("ny"))
    bounds = outline.select(key, "pixel", mx.alias("x"), my.alias("y")).groupBy(key, "pixel").agg(
        F.min("x").alias("left"), F.max("x").alias("right"), F.min("y").alias("bottom"), F.max("y").alias("top")
    )
    size = lambda a, b: F.floor((c(b) - c(a)) / c("pixel") + 0.5).cast("int")
    return bounds.withColumn("width", size("left", "right")).withColumn("height", size("bottom", "top"))


def map_statistics(mapping: DataFrame) -> DataFrame:
    """Entries and megabytes of a stored grid map per source and over all (source_id null); four bytes an entry."""
    return mapping.rollup("source_id").agg(
        F.count(F.lit(1)).alias("entries"), (F.count(F.lit(1)) * 4 / 1048576.0).alias("size_mb")
    )

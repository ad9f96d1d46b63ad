"""Coverage masks: which cells a source observes at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.colour import coverage_rgba
from ..functions.proj import Grid
from .regrid import _by_id, unfold


def covered(raw: Column, source: Column, nodata: Column | None = None, is_u8: Column | None = None) -> Column:
    """A cell is covered unless it holds the outside marker: 255 in byte rasters, else the given one (or 255).

    The text-grid source covers its whole grid.
    """
    marker = F.lit(255) if nodata is None else F.coalesce(nodata.cast("int"), F.lit(255))
    if is_u8 is not None:
        marker = F.when(is_u8, F.lit(255)).otherwise(marker)
    return (source == "arso") | (raw != marker)


def coverage_fraction(cells: DataFrame, keys: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(
        F.count_if("covered").alias("covered_cells"), F.avg(F.col("covered").cast("double")).alias("fraction")
    )


def placed_masks(masks: DataFrame, grids: dict[int, Grid], dst: Grid) -> DataFrame:
    """Covered cells of published Web Mercator masks on another Web Mercator grid; what lies outside drops.

    ``masks(source_id, row, col)`` lists covered cells. All grids are Mercator, so placement is linear per axis and
    each mask cell unfolds to the target cells whose centres it holds; all services in one pass.
    """
    pick = lambda name: _by_id(F.col("source_id"), {i: float(getattr(g, name)) for i, g in grids.items()})
    west, north, dx, dy = (pick(n) for n in ("west", "north", "dx", "dy"))
    row, col = F.col("row"), F.col("col")
    low = lambda at, step: F.floor(at / step - 0.5).cast("int")
    high = lambda at, step: F.ceil(at / step - 0.5).cast("int")
    east_of = lambda at: at * dx + (west - dst.west)
    south_of = lambda at: at * dy + (F.lit(dst.north) - north)
    x, y = dst.centre(F.col("dst_row"), F.col("dst_col"))
    rows = unfold(masks, "dst_row", low(south_of(row), dst.dy), high(south_of(row + 1), dst.dy), dst.height)
    rows = rows.where(F.floor((north - y) / dy) == row)
    cols = unfold(rows, "dst_col", low(east_of(col), dst.dx), high(east_of(col + 1), dst.dx), dst.width)
    return cols.where(F.floor((x - west) / dx) == col).drop("row", "col")


def placed_mask(mask: DataFrame, extent: tuple[float, float, float, float], shape: tuple[int, int], dst: Grid) -> DataFrame:
    """The same for one service: ``mask(row, col)`` with its extent and shape."""
    one = mask.withColumn("source_id", F.lit(0))
    return placed_masks(one, {0: Grid.of_shape(extent, *shape)}, dst).drop("source_id")


def union_mask(placed: DataFrame) -> DataFrame:
    """Cells covered by any source, each with the first source that covers it."""
    return placed.groupBy("dst_row", "dst_col").agg(F.min("priority").alias("priority"))


def mask_gains(placed: DataFrame, total_cells: int) -> DataFrame:
    """New cells per source in priority order, running total and running fraction (one row per source)."""
    gains = union_mask(placed).groupBy("priority").agg(F.count(F.lit(1)).alias("new_cells"))
    running = F.sum("new_cells").over(Window.orderBy("priority").rowsBetween(Window.unboundedPreceding, 0))
    return gains.withColumn("total_cells", running).withColumn("fraction", F.col("total_cells") / F.lit(float(total_cells)))


def mask_image(spark, mask: DataFrame, grid: Grid) -> DataFrame:
    """Dense RGBA mask of a grid from its covered cells."""
    cells = spark.range(grid.height).select(F.col("id").cast("int").alias("dst_row")).withColumn(
        "dst_col", F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1)))
    )
    marked = mask.select("dst_row", "dst_col").distinct().withColumn("covered", F.lit(True))
    joined = cells.hint("merge").join(marked, ["dst_row", "dst_col"], "left")
    return joined.select("dst_row", "dst_col", coverage_rgba(F.coalesce("covered", F.lit(False))).alias("c")).select(
        "dst_row", "dst_col", "c.*"
    )


def target_shape(sources: DataFrame, published: DataFrame, maps: DataFrame) -> DataFrame:
    """Raster shape per source: that of a published raster, else that of a stored grid map.

    ``published(source, name, height, width)`` with masks left out; ``maps(source, map_key, height, width)``.
    """
    first = lambda df, order: df.groupBy("source").agg(F.min_by(F.struct("height", "width"), order).alias("_s"))
    seen = first(published.where(~F.col("name").contains("coverage_mask")), "name").withColumnRenamed("_s", "_published")
    kept = first(maps, "map_key").withColumnRenamed("_s", "_map")
    joined = sources.join(seen, "source", "left").join(kept, "source", "left")
    return joined.select("source", F.coalesce("_published", "_map").alias("_shape")).select("source", "_shape.*")


def source_extent(sources: DataFrame, canonical: DataFrame, older: DataFrame) -> DataFrame:
    """Extent per source from the canonical table, else from the older one."""
    joined = sources.join(canonical.withColumnRenamed("extent", "_new"), "source", "left").join(
        older.withColumnRenamed("extent", "_old"), "source", "left"
    )
    return joined.select("source", F.coalesce("_new", "_old").alias("extent"))


def missing_masks(sources: DataFrame, masks: DataFrame, extents: DataFrame, include_individual: bool = True) -> DataFrame:
    """What has to be made: masks per source, with the extent that has to come first; the composite mask last.

    Without a composite mask all source masks are needed whatever ``include_individual`` says.
    """
    composite_there = masks.select(F.count_if(F.col("source") == "composite")).scalar() > 0
    wanted = sources.select("source").where(F.lit(include_individual) | ~composite_there)
    composite = sources.sparkSession.createDataFrame([("composite",)], "source string")
    todo = wanted.unionByName(composite).join(masks.select("source"), "source", "left_anti")
    held = extents.select("source").distinct().withColumn("_extent", F.lit(True))
    return todo.join(held, "source", "left").select("source", F.col("_extent").isNull().alias("needs_extent"))

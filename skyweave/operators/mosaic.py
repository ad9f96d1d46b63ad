"""Merging overlapping cells of several sources into one value per target cell."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..dimensions import ISOLATION_MIN, MERGE_CLIP, OUTLIER_STD, RADAR_CENTRES, REGRID_CLIP
from ..functions.attrs import clip
from ..functions.proj import degree_distance


def max_value() -> Column:
    return F.max("dbz")


def guarded_average() -> Column:
    """Mean; the median where the sources disagree by more than the outlier limit.

    The spread is compared as ``n * sum(x^2) - sum(x)^2 > limit^2 * n^2``: unlike a running variance this gives the
    same answer in whatever order partial sums meet, also when the spread lies exactly on the limit.
    """
    x = F.col("dbz").cast("double")
    n, total, squares = F.count("dbz"), F.sum(x), F.sum(x * x)
    spread = n * squares - total * total > OUTLIER_STD**2 * n * n
    return F.when(spread, F.median("dbz")).otherwise(F.avg("dbz"))


def first_in_priority() -> Column:
    return F.min_by("dbz", "priority")


def weighted_average() -> Column:
    return F.try_divide(F.sum(F.col("weight") * F.col("dbz")), F.nullif(F.sum("weight"), F.lit(0.0)))


# strategy -> aggregate over the values of one cell (columns dbz, priority, weight)
STRATEGIES: dict[str, Callable[[], Column]] = {
    "max": max_value,
    "average": guarded_average,
    "priority": first_in_priority,
    "weighted": weighted_average,
}
FILTERED = {"average", "weighted"}  # clipped and freed of isolated cells afterwards


def strategy(name: str) -> Callable[[], Column]:
    """The aggregate of a strategy; an unknown name means average."""
    return STRATEGIES.get(name, guarded_average)


def distance_weight(source: Column, lon: Column, lat: Column, dbz: Column) -> Column:
    """Inverse distance to the radar centre, a tenth of it for extreme values; 1 where no centre is known."""
    expr = None
    for name, (lon0, lat0) in RADAR_CENTRES.items():
        base = F.lit(1.0) / (degree_distance(lon, lat, lon0, lat0) + 0.1)
        value = F.when((dbz < -30) | (dbz > 75), base * 0.1).otherwise(base)
        expr = F.when(source == name, value) if expr is None else expr.when(source == name, value)
    return expr.otherwise(F.lit(1.0))


def merge(cells: DataFrame, keys: list[str], name: str = "max", min_sources: int = 1) -> DataFrame:
    """One value per (keys, dst_row, dst_col), nulls ignored.

    ``cells`` holds at most one row per source and target cell, plus ``priority`` / ``weight`` where the strategy
    needs them. Only the aggregate shuffles, and it combines before that.
    """
    valid = cells.where(F.col("dbz").isNotNull())
    by_cell = [*keys, "dst_row", "dst_col"]
    if min_sources > 1:
        valid = with_enough_sources(valid, keys, min_sources)
    merged = valid.groupBy(*by_cell).agg(strategy(name)().cast("double").alias("dbz"))
    return finish(merged, keys, name)


def finish(merged: DataFrame, keys: list[str], name: str) -> DataFrame:
    """What a strategy does after the aggregate: average and weighted are clipped and lose isolated cells."""
    if name in FILTERED or name not in STRATEGIES:
        merged = drop_isolated(merged.withColumn("dbz", clip(F.col("dbz"), MERGE_CLIP)), keys)
    if name == "average" or name not in STRATEGIES:
        merged = merged.where(F.col("dbz").between(*REGRID_CLIP))
    return merged


def with_enough_sources(cells: DataFrame, keys: list[str], min_sources: int) -> DataFrame:
    """Cells of the slots in which at least ``min_sources`` sources have a valid cell."""
    present = cells.select(*keys, "source").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return cells.join(present.where(F.col("_n") >= min_sources).select(*keys), keys, "left_semi")


def with_valid_cells(scans: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Scans that have at least one valid cell."""
    alive = cells.where(F.col("dbz").isNotNull()).select(*keys).distinct()
    return scans.join(alive, keys, "left_semi")


def first_file(cells: DataFrame, keys: list[str], arrival: str = "arrival") -> DataFrame:
    """Cells of the first-arrived scan of each source and slot."""
    scans = cells.groupBy(*keys).agg(F.min(arrival).alias(arrival))
    return cells.join(scans, [*keys, arrival], "left_semi")


def drop_isolated(cells: DataFrame, keys: list[str], least: int = ISOLATION_MIN, block: int = 64) -> DataFrame:
    """Keep a valid cell when its 3x3 neighbourhood, itself included, has at least ``least`` valid cells.

    Cells are sent to square blocks, those at a rim also to the block next door (about 6 % more rows at 64). Inside
    a block every valid cell tells its nine neighbours about itself; a cell of the block survives if it told itself
    and heard enough. The ninefold rows never cross the network, as the aggregate's keys contain the blocks.
    """
    row, col = F.col("dst_row"), F.col("dst_col")
    of = lambda c: F.floor(c / block).cast("int")
    reach = lambda c: F.sequence(F.greatest(F.lit(0), of(c - 1)), of(c + 1))
    valid = cells.where(F.col("dbz").isNotNull()).select(*keys, "dst_row", "dst_col", "dbz")
    sent = valid.withColumn("_br", F.explode(reach(row))).withColumn("_bc", F.explode(reach(col))).repartition(*keys, "_br", "_bc")
    around = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr in (-1, 0, 1) for dc in (-1, 0, 1)))
    own = (F.col("dr") == 0) & (F.col("dc") == 0)
    told = sent.select("*", F.inline(around)).select(
        *keys, "_br", "_bc", (row + F.col("dr")).alias("dst_row"), (col + F.col("dc")).alias("dst_col"), F.when(own, F.col("dbz")).alias("dbz")
    )
    heard = (
        told.where((of(row) == F.col("_br")) & (of(col) == F.col("_bc")))
        .groupBy(*keys, "_br", "_bc", "dst_row", "dst_col")
        .agg(F.count(F.lit(1)).alias("_heard"), F.max("dbz").alias("dbz"))
    )
    return heard.where((F.col("_heard") >= least) & F.col("dbz").isNotNull()).drop("_heard", "_br", "_bc")


def statistics(merged: DataFrame, keys: list[str], total_cells: int) -> DataFrame:
    """Valid cells, total cells and coverage percent per slot."""
    return merged.groupBy(*keys).agg(F.count("dbz").alias("valid_cells")).select(
        *keys,
        "valid_cells",
        F.lit(total_cells).cast("bigint").alias("total_cells"),
        (F.col("valid_cells") * 100.0 / total_cells).alias("coverage_percent"),
    )


def marginal_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells each source adds when the sources are merged in priority order, and the mosaic's size after it.

    A cell counts for the first source that covers it. The running total is over one row per source.
    """
    first = cells.where(F.col("dbz").isNotNull()).groupBy(*keys, "dst_row", "dst_col").agg(F.min("priority").alias("priority"))
    new = first.groupBy(*keys, "priority").agg(F.count(F.lit(1)).alias("new_cells"))
    running = Window.partitionBy(*keys).orderBy("priority").rowsBetween(Window.unboundedPreceding, 0)
    return new.withColumn("total_cells", F.sum("new_cells").over(running))


def combined_extent(extents: DataFrame, keys: list[str] = ()) -> DataFrame:
    return extents.groupBy(*keys).agg(
        F.min("west").alias("west"), F.max("east").alias("east"), F.min("south").alias("south"), F.max("north").alias("north")
    )


def largest_shape(scans: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Shape of the source with most pixels; the taller one on a tie."""
    size = F.struct((F.col("height") * F.col("width")).alias("pixels"), "height", "width")
    return scans.groupBy(*keys).agg(F.max(size).alias("_m")).select(*keys, "_m.height", "_m.width")

"""Index maps and weights by raster lines, for services of any projection.

A grid map has a row for each target cell, and joining it moves every pixel by itself. Along a target line the source line
changes seldom, so the same map is kept as *runs*: for a source line and a block of target lines, each run of neighbouring
target cells that look at this line, with the source columns they look at. Lines of pixels are joined to it by line, are
picked out as arrays, and cross the network once, as arrays, to the block of target lines they belong to. What is merged
there has the keys of that exchange. Bilinear weights are kept and applied in the same shape: a sparse matrix cut into
(source line, block of target lines).

Both tables belong to a geometry and are built once, stored and read under its key (``store`` and ``stored``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import REGRID_CLIP
from ..functions import attrs as A
from ..functions.proj import Grid, to_native
from ..session import join_sized
from . import mosaic
from .regrid import SourceGrid, map_rows, source_cell

#: Target lines of a block; a (slot, block) group holds at most so many lines of each scan.
BLOCK_LINES = 16


@dataclass(frozen=True)
class Axes:
    """A target of regular latitudes and longitudes: (first, last, count) of its lines and columns."""

    rows: tuple[float, float, int]
    cols: tuple[float, float, int]

    @property
    def height(self) -> int:
        return self.rows[2]

    @property
    def width(self) -> int:
        return self.cols[2]

    def centre_lonlat(self, row: Column, col: Column) -> tuple[Column, Column]:
        (lat0, lat1, n), (lon0, lon1, m) = self.rows, self.cols
        return col * ((lon1 - lon0) / (m - 1) if m > 1 else 0.0) + lon0, row * ((lat1 - lat0) / (n - 1) if n > 1 else 0.0) + lat0


def _under(src: SourceGrid, dst: Grid, sampling: str):
    """Source cell under a column of the target line at hand, null outside."""

    def cell(c: Column) -> Column:
        row, col = source_cell(src, dst, F.col("dst_row"), c, sampling)
        return F.when(row.isNotNull() & col.isNotNull(), F.struct(row.alias("row"), col.alias("col")))

    return cell


def index_runs(spark: SparkSession, sources: dict[int, SourceGrid], dst: Grid, block_lines: int = BLOCK_LINES, sampling: str = "floor") -> DataFrame:
    """(source_id, row, block, runs[dst_row, first, cols]) of all sources: the grid map, line by line.

    A target line is worked out in one task as arrays and split where its source line changes, so that nothing of the size of
    cells is shuffled; runs are gathered by (source line, block).
    """
    n = dst.width
    parts = []
    for source_id, src in sources.items():
        lines = spark.range(dst.height).select(F.lit(source_id).alias("source_id"), F.col("id").cast("int").alias("dst_row"))

        parts.append(lines.withColumn("at", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), _under(src, dst, sampling))))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionAll(part)
    here = lambda i: F.get("at", i)["row"]
    begins = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: here(i).isNotNull() & ((i == 0) | ~here(i).eqNullSafe(here(i - 1))))
    ends = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: here(i).isNotNull() & ((i == n - 1) | ~here(i).eqNullSafe(here(i + 1))))
    split = every.withColumns({"begins": begins, "ends": ends})
    runs = split.select("source_id", "dst_row", "at", F.inline(F.arrays_zip("begins", "ends"))).select(
        "source_id",
        here(F.col("begins")).alias("row"),
        F.floor(F.col("dst_row") / block_lines).cast("int").alias("block"),
        F.struct("dst_row", F.col("begins").alias("first"), F.transform(F.slice("at", F.col("begins") + 1, F.col("ends") - F.col("begins") + 1), lambda a: a["col"]).alias("cols")).alias("run"),
    )
    return runs.groupBy("source_id", "row", "block").agg(F.collect_list("run").alias("runs"))


def weight_lines(spark: SparkSession, sources: dict[int, SourceGrid], dst: Grid | Axes, block_lines: int = BLOCK_LINES, clamp: bool = True) -> DataFrame:
    """(source_id, row, block, weights[dst_row, dst_col, col, left, right, near]): bilinear weights of any geometry.

    A target cell lies between four source centres; a source line gives it ``left`` of column ``col`` and ``right`` of the next
    one. ``near`` is the column of the nearest centre, if that is on this line. Positions beyond the outermost centres are
    clamped to them; with ``clamp`` off, target cells outside the source's outline get no weights.
    """
    parts = []
    for source_id, src in sources.items():
        cells = spark.range(dst.height).select(F.col("id").cast("int").alias("dst_row")).withColumn("dst_col", F.explode(F.sequence(F.lit(0), F.lit(dst.width - 1))))
        x, y = to_native(src.projection, *dst.centre_lonlat(F.col("dst_row"), F.col("dst_col")))
        place = cells.withColumns({"_r": (F.lit(src.top - src.py / 2) - y) / src.py, "_c": (x - (src.left + src.px / 2)) / src.px})
        if not clamp:
            place = place.where(F.col("_r").between(-0.5, src.height - 0.5) & F.col("_c").between(-0.5, src.width - 0.5))
        held = lambda c, size: F.greatest(F.lit(0.0), F.least(F.lit(size - 1.0), F.col(c)))
        place = place.withColumns({"_r": held("_r", src.height), "_c": held("_c", src.width)})
        parts.append(place.withColumn("source_id", F.lit(source_id)))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    low, col = F.floor("_r").cast("int"), F.floor("_c").cast("int")
    lines = every.withColumn("row", F.explode(F.array(low, low + 1))).withColumn("_w", F.lit(1.0) - F.abs(F.col("_r") - F.col("row"))).where("_w > 0")
    right = F.col("_c") - col
    entry = F.struct(
        "dst_row",
        "dst_col",
        col.alias("col"),
        (F.col("_w") * (F.lit(1.0) - right)).alias("left"),
        (F.col("_w") * right).alias("right"),
        F.when(F.rint("_r") == F.col("row"), F.rint("_c").cast("int")).alias("near"),
    )
    keyed = lines.select("source_id", "row", F.floor(F.col("dst_row") / block_lines).cast("int").alias("block"), entry.alias("w"))
    return keyed.groupBy("source_id", "row", "block").agg(F.collect_list("w").alias("weights"))


def store(table: DataFrame, key: str, path: str) -> None:
    """Keep the runs or weights of one geometry under its key (``functions.proj.geometry_key``), lines in order."""
    lines = table.repartitionByRange("row").sortWithinPartitions("row").withColumn("geom_key", F.lit(key))
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("geom_key").parquet(path)


def stored(spark: SparkSession, key: str, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("geom_key") == key).drop("geom_key")


def _numbered(lines: DataFrame, names: list[str]) -> DataFrame:
    number = F.try_element_at(F.create_map(*(F.lit(x) for i, n in enumerate(names) for x in (n, i))), F.col("source"))
    return lines.withColumn("source_id", number).where("source_id is not null")


def _decoded(raw: Column) -> Column:
    s = F.col("scaling")
    return A.decode(raw, s["gain"], s["offset"], s["nodata"], s["undetect"], s["byte_rule"] & F.col("is_u8"))


def placed_lines(lines: DataFrame, grids: dict[str, SourceGrid], dst: Grid, keys: list[str], runs: DataFrame | None = None) -> DataFrame:
    """Valid cells (keys, block, source_id, dst_row, dst_col, dbz) of strips, dealt by (keys, block).

    One exchange moves arrays of raw numbers; they are unfolded and decoded where they arrive.
    """
    sources = dict(enumerate(grids.values()))
    runs = index_runs(lines.sparkSession, sources, dst) if runs is None else runs
    met = join_sized(_numbered(lines, list(grids)), runs, ["source_id", "row"], map_rows(sources, dst))
    picked = F.transform("runs", lambda r: F.struct(r["dst_row"].alias("dst_row"), r["first"].alias("first"), F.transform(r["cols"], lambda c: F.get("raw", c)).alias("raw")))
    moved = met.select(*keys, "block", "source_id", "scaling", "is_u8", picked.alias("runs")).repartition(*keys, "block")
    opened = moved.select(*keys, "block", "source_id", "scaling", "is_u8", F.inline("runs"))
    cells = opened.select(*keys, "block", "source_id", "dst_row", "first", "scaling", "is_u8", F.posexplode("raw").alias("_at", "_raw"))
    placed = cells.select(*keys, "block", "source_id", "dst_row", (F.col("first") + F.col("_at")).alias("dst_col"), _decoded(F.col("_raw")).alias("dbz"))
    return placed.where("dbz is not null")


def run_mosaic(lines: DataFrame, grids: dict[str, SourceGrid], dst: Grid, keys: list[str], strategy: str = "max", runs: DataFrame | None = None) -> DataFrame:
    """(keys, dst_row, dst_col, dbz) from strips ``(keys, source, row, raw, scaling, is_u8)`` of services of any projection.

    The merge needs no exchange beyond that of ``placed_lines``. ``runs`` are those of ``grids`` in their order, stored ones or
    made on the spot. All strategies work; priority is the order of ``grids``.
    """
    ranked = placed_lines(lines, grids, dst, keys, runs).withColumn("priority", F.col("source_id"))
    if strategy == "weighted":
        name = F.element_at(F.array(*(F.lit(n) for n in grids)), F.col("source_id") + 1)
        ranked = ranked.withColumn("weight", mosaic.distance_weight(name, *dst.centre_lonlat(F.col("dst_row"), F.col("dst_col")), F.col("dbz")))
    merged = ranked.groupBy(*keys, "block", "dst_row", "dst_col").agg(mosaic.strategy(strategy)().cast("double").alias("dbz"))
    return mosaic.finish(merged.drop("block"), keys, strategy)


def weighted_lines(lines: DataFrame, grids: dict[str, SourceGrid], dst: Grid | Axes, keys: list[str], weights: DataFrame | None = None) -> DataFrame:
    """Bilinear values (keys, source, dst_row, dst_col, dbz) of strips: a blocked sparse product of weights and lines.

    A value is null when one of the corners it needs is, or the nearest centre. A line's share of a target cell is summed up
    before it moves, so that a cell meets at most two shares of a scan.
    """
    names = list(grids)
    sources = dict(enumerate(grids.values()))
    weights = weight_lines(lines.sparkSession, sources, dst) if weights is None else weights
    met = join_sized(_numbered(lines, names), weights, ["source_id", "row"], 2 * len(sources) * dst.height * dst.width)
    at = lambda c: _decoded(F.get("raw", c)).cast("double")

    def share(w: Column) -> Column:
        a, b = at(w["col"]), at(w["col"] + 1)
        value = F.coalesce(a * w["left"], F.lit(0.0)) + F.when((w["right"] > 0) & b.isNotNull(), b * w["right"]).otherwise(0.0)
        weight = F.when(a.isNotNull(), w["left"]).otherwise(0.0) + F.when((w["right"] > 0) & b.isNotNull(), w["right"]).otherwise(0.0)
        near = F.coalesce(at(w["near"]).isNotNull(), F.lit(False))
        return F.struct(w["dst_row"].alias("dst_row"), w["dst_col"].alias("dst_col"), value.alias("v"), weight.alias("w"), near.alias("near"))

    moved = met.select(*keys, "block", "source", F.transform("weights", share).alias("shares")).repartition(*keys, "block", "source")
    cells = moved.select(*keys, "block", "source", F.inline("shares"))
    summed = cells.groupBy(*keys, "block", "source", "dst_row", "dst_col").agg(F.sum("v").alias("v"), F.sum("w").alias("w"), F.max("near").alias("near"))
    whole = summed.where(F.col("near") & (F.col("w") > 1.0 - 1e-9))
    return whole.select(*keys, "source", "dst_row", "dst_col", A.clip(F.col("v"), REGRID_CLIP).alias("dbz"))

"""Coverage masks of the services and of the mosaic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.attrs import number, unsigned
from ..functions.proj import Grid
from ..operators import coverage
from ..operators.regrid import SourceGrid
from .placing import place


def native_masks(scans: DataFrame) -> DataFrame:
    """Cells a service covers in any of the given scans: (source, row, col).

    The distinct combines before the shuffle, so its size is that of the masks, not of the scans.
    """
    nodata = number(F.col("what_data"), "nodata").alias("nodata")
    pixels = scans.select("source", "width", "is_u8", nodata, F.posexplode("raw").alias("_pos", "raw"))
    value = F.when(F.col("is_u8"), unsigned(F.col("raw"))).otherwise(F.col("raw"))
    seen = pixels.where(coverage.covered(value, F.col("source"), F.col("nodata"), F.col("is_u8")))
    return seen.select(
        "source", F.floor(F.col("_pos") / F.col("width")).cast("int").alias("row"), (F.col("_pos") % F.col("width")).alias("col")
    ).distinct()


def source_masks(scans: DataFrame, grids: dict[str, SourceGrid], dst: Grid) -> DataFrame:
    return place(native_masks(scans), grids, dst).select("source", "dst_row", "dst_col")


def composite_mask(masks: DataFrame, grids: dict[str, SourceGrid], dst: Grid) -> DataFrame:
    """Dense RGBA mask of the mosaic from the masks of the services."""
    order = F.array_position(F.array(*(F.lit(s) for s in grids)), F.col("source"))
    union = coverage.union_mask(masks.withColumn("priority", order))
    return coverage.mask_image(masks.sparkSession, union, dst)

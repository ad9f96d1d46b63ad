"""Reflectivity colours: scale index, 121-step scale, 256-entry table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import COLOUR_ANCHORS, LUT_RANGE, RENDER_MIN_DBZ, UNCOVERED_RGBA

LOW, HIGH = int(LUT_RANGE[0]), int(LUT_RANGE[1])
STEP = 5


def rgb_of_step(dbz: Column) -> Column:
    """Colour of a whole dBZ value on the scale: the anchors every 5 dBZ, cut-off linear steps between them."""
    anchors = F.array(*(F.array(*(F.lit(v) for v in row[1:])) for row in COLOUR_ANCHORS))
    lower_at = F.floor((dbz - LOW) / STEP).cast("int")
    lower = anchors[lower_at]
    upper = anchors[F.least(lower_at + 1, F.lit(len(COLOUR_ANCHORS) - 1))]
    part = (dbz - (lower_at * STEP + LOW)) / F.lit(float(STEP))
    band = lambda i: (lower[i] + part * (upper[i] - lower[i])).cast("int")
    return F.struct(band(0).alias("r"), band(1).alias("g"), band(2).alias("b"))


def rgb_of_dbz(dbz: Column) -> Column:
    """Colour of one value, held inside the scale and rounded half up to a step."""
    held = F.greatest(F.lit(float(LOW)), F.least(F.lit(float(HIGH)), dbz))
    return rgb_of_step(F.floor(held + 0.5).cast("int"))


def colour_scale(spark: SparkSession) -> DataFrame:
    """The 121 steps: dbz, r, g, b."""
    steps = spark.range(HIGH - LOW + 1).select((F.col("id").cast("int") + LOW).alias("dbz"))
    return steps.select("dbz", rgb_of_step(F.col("dbz")).alias("c")).select("dbz", "c.*")


def colour_lut(spark: SparkSession) -> DataFrame:
    """The 256-entry table: idx, r, g, b, a. Its size is fixed, so it may be broadcast."""
    value = F.col("id") * F.lit((HIGH - LOW) / 255.0) + F.lit(float(LOW))
    return (
        spark.range(256)
        .select(F.col("id").cast("int").alias("idx"), rgb_of_dbz(value).alias("c"))
        .select("idx", "c.*", F.lit(255).alias("a"))
    )


def colour_index(dbz: Column) -> Column:
    span = LUT_RANGE[1] - LUT_RANGE[0]
    scaled = (dbz - LUT_RANGE[0]) / span * 255.0
    return F.greatest(F.lit(0.0), F.least(F.lit(255.0), scaled)).cast("int")


def visible(dbz: Column) -> Column:
    """Whether a value is drawn at all."""
    return F.coalesce(dbz >= RENDER_MIN_DBZ, F.lit(False))


def coverage_rgba(covered: Column) -> Column:
    names = ("r", "g", "b", "a")
    clear = F.struct(*(F.lit(0).alias(n) for n in names))
    grey = F.struct(*(F.lit(v).alias(n) for v, n in zip(UNCOVERED_RGBA, names)))
    return F.when(covered, clear).otherwise(grey)


def covered_of_alpha(alpha: Column) -> Column:
    return alpha == 0


def choose_colormap(units: Column, quantity: Column, wanted: str = "auto") -> Column:
    """Name of the scale for a scan and whether it is a stand-in; only the reflectivity scale exists."""
    units, quantity = F.lower(F.coalesce(units, F.lit("unknown"))), F.upper(F.coalesce(quantity, F.lit("")))
    exact = units.contains("dbz") | quantity.contains("DBZH") | quantity.contains("TH")
    return F.struct(
        F.lit("reflectivity_shmu").alias("colormap"),
        (F.lit(False) if wanted == "reflectivity_shmu" else ~exact).alias("stand_in"),
    )

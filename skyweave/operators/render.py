"""Drawing a mosaic: colours, resampling, variants, animation frames."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import NATIVE_METRES, by_source
from ..functions.colour import colour_index, colour_lut, visible
from ..functions.proj import scaled_dimensions
from .sequence import number_rows, range_chunks


def render(cells: DataFrame) -> DataFrame:
    """Colour of every cell; values below the drawing threshold and missing ones are transparent."""
    lut = colour_lut(cells.sparkSession)
    idx = F.when(visible(F.col("dbz")), colour_index(F.col("dbz"))).otherwise(F.lit(0))
    drawn = cells.withColumn("idx", idx).join(F.broadcast(lut), "idx")  # 256 rows
    return drawn.withColumn("a", F.when(visible(F.col("dbz")), F.col("a")).otherwise(F.lit(0)))


def _lanczos(x: Column) -> Column:
    sinc = lambda v: F.when(v == 0, F.lit(1.0)).otherwise(F.sin(v * math.pi) / (v * math.pi))
    return F.when(F.abs(x) < 3.0, sinc(x) * sinc(x / 3.0)).otherwise(F.lit(0.0))


WEIGHT_ONE = 1 << 22  # weights are whole numbers of this size, so their sums do not depend on the order


def resample_weights(spark, n_in: int, n_out: int, method: str = "lanczos") -> DataFrame:
    """(src, dst, w): how much each input line counts for each output line. About 6 * max(n_in, n_out) rows."""
    scale = n_in / n_out
    stretch = max(scale, 1.0)
    centre = (F.col("dst") + 0.5) * scale
    out = spark.range(n_out).select(F.col("id").cast("int").alias("dst"))
    if method == "nearest":
        return out.select(F.least(F.floor(centre).cast("int"), F.lit(n_in - 1)).alias("src"), "dst", F.lit(WEIGHT_ONE).cast("bigint").alias("w"))
    reach = 3.0 * stretch
    low = F.greatest(F.lit(0), (centre - reach + 0.5).cast("int"))
    high = F.least(F.lit(n_in), (centre + reach + 0.5).cast("int"))
    taps = out.withColumn("_taps", F.transform(F.sequence(low, high - 1), lambda s: F.struct(s.alias("src"), _lanczos((s - centre + 0.5) / stretch).alias("w"))))
    total = F.aggregate("_taps", F.lit(0.0), lambda acc, t: acc + t["w"])
    share = F.round(F.col("w") / F.col("_sum") * float(WEIGHT_ONE)).cast("bigint")
    return taps.withColumn("_sum", total).select("dst", "_sum", F.inline("_taps")).select("src", "dst", share.alias("w"))


def resample(pixels: DataFrame, keys: list[str], shape: tuple[int, int], target: tuple[int, int], method: str = "lanczos") -> DataFrame:
    """Resize drawn rasters: columns first, then rows, each a weighted sum per output line, rounded to whole levels.

    Colours are weighted by their alpha, so only pixels that are drawn at all need to be present and the rest
    count as transparent. ``pixels(*keys, row, col, r, g, b, a)``.
    """
    spark = pixels.sparkSession
    bands = ["r", "g", "b", "a"]
    half = WEIGHT_ONE // 2
    level = lambda c: F.greatest(F.lit(0), F.least(F.lit(255), F.shiftright(c + half, 22))).cast("int")
    cur = pixels.where("a > 0").select(*keys, "row", "col", *(F.floor(F.col(c) * F.col("a") / 255.0 + 0.5).cast("int").alias(c) for c in "rgb"), "a")
    for line, other, n_in, n_out in (("col", "row", shape[1], target[1]), ("row", "col", shape[0], target[0])):
        # as many weights as the raster's side has pixels times the taps of one line
        weights = resample_weights(spark, n_in, n_out, method).withColumnRenamed("src", line).where("w <> 0")
        cur = (
            cur.join(F.broadcast(weights) if n_out * (6 * max(n_in / n_out, 1) + 1) <= 200_000 else weights.hint("merge"), line)
            .groupBy(*keys, other, F.col("dst").alias(line))
            .agg(*(level(F.sum(F.col("w") * F.col(c))).alias(c) for c in bands))
        )
    plain = lambda c: F.when(F.col("a") == 255, F.col(c)).otherwise(F.least(F.lit(255), F.floor(F.col(c) * 255 / F.col("a")).cast("int")))
    return cur.where("a > 0").select(*keys, "row", "col", *(plain(c).alias(c) for c in "rgb"), "a")


def variants(rasters: DataFrame, formats: list[str], resolutions_m: list[float], include_full: bool = True) -> DataFrame:
    """Manifest of the files a raster is published as: one row per raster, resolution and format.

    ``rasters(source, unix, folder, height, width, south, north, ...)``.
    """
    sizes = ([None] if include_full else []) + list(resolutions_m)
    wanted = F.array(
        *(
            F.struct(F.lit(res).cast("double").alias("target_m"), F.lit(fmt).alias("format"))
            for res in sizes
            for fmt in formats
        )
    )
    native = by_source(F.col("source"), NATIVE_METRES)
    suffix = F.when(F.col("target_m").isNull(), F.lit("")).otherwise(F.format_string("@%dm", F.col("target_m").cast("int")))
    size = F.when(F.col("target_m").isNull(), F.struct("height", "width")).otherwise(
        scaled_dimensions(F.col("height"), F.col("width"), F.col("target_m"), native, F.col("south"), F.col("north"))
    )
    return (
        rasters.select("*", F.inline(wanted))
        .withColumn("variant", F.concat(F.when(suffix == "", F.lit("full")).otherwise(suffix), F.lit("."), F.col("format")))
        .withColumn("file", F.concat(F.col("folder"), F.lit("/"), F.col("unix").cast("string"), suffix, F.lit("."), F.col("format")))
        .withColumn("resolution", F.when(suffix == "", F.lit("full")).otherwise(F.substring(suffix, 2, 20)))
        .withColumn("_size", size)
        .withColumn("out_height", F.col("_size.height"))
        .withColumn("out_width", F.col("_size.width"))
        .withColumn("format", F.upper("format"))
        .drop("_size", "target_m")
    )


def frames(files: DataFrame, fps: int = 12, crowded: bool = False) -> DataFrame:
    """Frames of one animation per (source, product), numbered by time. ``files(source, product, name, ts)``.

    ``crowded`` deals the files by ranges of rows instead of hours, for animations with very many files in one hour."""
    if crowded:
        files = range_chunks(files, ["source", "product", "ts", "name"])
    numbered = number_rows(files, ["source", "product"], "ts", ["name"], "frame")
    return numbered.withColumn("duration_ms", F.lit(int(1000 / fps)))


def sequences(files: DataFrame) -> DataFrame:
    """Time range and name of each animation."""
    span = files.groupBy("source", "product").agg(F.min("ts").alias("_a"), F.max("ts").alias("_b"), F.count(F.lit(1)).alias("frames"))
    parts = span.select(
        "source", "product", "frames", F.date_format("_a", "yyyyMMdd").alias("date"), F.date_format("_a", "HHmm").alias("start"), F.date_format("_b", "HHmm").alias("end")
    )
    return parts.withColumn("name", F.concat(F.concat_ws("_", "source", "product", "date", "start", "end"), F.lit(".gif")))

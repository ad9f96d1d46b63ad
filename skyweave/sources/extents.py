"""Extent documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import SOURCE_EXTENTS
from ..schema import EXTENT
from . import srd

DOCUMENT = f"struct<wgs84:{EXTENT},extent:struct<wgs84:{EXTENT}>,source:struct<extent:{EXTENT}>>"


def extent_of_document(text: Column) -> Column:
    """Bounds of an extent document in any of its three layouts, the present one first; null when it has none."""
    doc = F.from_json(text, DOCUMENT)
    legacy = doc["source"]["extent"]
    return F.coalesce(doc["wgs84"], doc["extent"]["wgs84"], F.when(legacy["west"].isNotNull(), legacy))


def document(source: Column, extent: Column, generated: Column, title: str = "Radar Coverage Extent") -> Column:
    """Extent document in the present layout."""
    return F.to_json(
        F.struct(
            F.struct(F.lit(title).alias("title"), F.lower(source).alias("source"), generated.alias("generated")).alias("metadata"),
            extent.alias("wgs84"),
        )
    )


def composite_document(extent: Column, sources: Column, resolution_m: Column, generated: Column) -> Column:
    meta = F.struct(
        F.lit("Composite Radar Coverage").alias("title"),
        F.lit("composite").alias("source"),
        generated.alias("generated"),
        sources.alias("sources"),
        resolution_m.alias("resolution_m"),
    )
    return F.to_json(F.struct(meta.alias("metadata"), extent.alias("wgs84")))


def combined_report(extents: DataFrame) -> DataFrame:
    """One document with the extent of every source and the extent enclosing them; an entry per source."""
    e = lambda f: F.col(f"extent.{f}")
    combined = F.struct(F.min(e("west")).alias("west"), F.max(e("east")).alias("east"), F.min(e("south")).alias("south"), F.max(e("north")).alias("north"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "extent"))))
    return extents.agg(F.count(F.lit(1)).alias("n_sources"), combined.alias("combined"), entries.alias("_s")).select(
        "n_sources", "combined", F.to_json(F.struct(F.col("_s").alias("sources"), "combined")).alias("document")
    )


def source_extents(spark: SparkSession) -> DataFrame:
    """Known extent of every service (source, extent); that of the text-grid service follows from its grid."""
    known = spark.createDataFrame([(n, e) for n, e in SOURCE_EXTENTS.items()], f"source string, extent {EXTENT}")
    grid = srd.grid_extent(spark).select(F.lit("arso").alias("source"), F.struct("west", "east", "south", "north").alias("extent"))
    return known.unionByName(grid)


def save(current: DataFrame, incoming: DataFrame, force: bool = False) -> DataFrame:
    """Documents after a save: an existing one stays unless forced. ``(source, document)``, one row per source."""
    loser, winner = (current, incoming) if force else (incoming, current)
    return winner.unionByName(loser.join(winner.select("source"), "source", "left_anti"))

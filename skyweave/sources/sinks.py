"""Published mosaics: where they go and what is already there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import SOURCES, by_source


def output_name(ts: Column) -> Column:
    """Files are named by the unix second of their slot, UTC."""
    return F.concat(F.unix_timestamp(ts).cast("string"), F.lit(".png"))


def output_folder(source: Column) -> Column:
    return F.coalesce(by_source(source, {n: row[2] for n, row in SOURCES.items()}), F.lower(source))


def located(rows: DataFrame, source: str = "source", ts: str = "ts") -> DataFrame:
    return (
        rows.withColumn("unix", F.unix_timestamp(ts))
        .withColumn("folder", output_folder(F.col(source)))
        .withColumn("name", output_name(F.col(ts)))
        .withColumn("date", F.date_format(ts, "yyyy-MM-dd"))
    )


def write_mosaic(cells: DataFrame, path: str) -> None:
    """Cells of mosaics as a table partitioned by source, date and slot. A slot written again replaces what it had."""
    located(cells).repartition("source", "date", "unix").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("source", "date", "unix").parquet(path)


def not_yet_written(slots: DataFrame, manifest: DataFrame) -> DataFrame:
    """Slots without an output; runs before any pixel is read. ``manifest(folder, name)``."""
    return located(slots).join(manifest.select("folder", "name").distinct(), ["folder", "name"], "left_anti")

"""Placing cells of all services on one grid, each by the cheapest way its projection allows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.proj import Grid
from ..operators.regrid import SEPARABLE, SourceGrid, apply_grid_map, grid_map, map_rows, scatter, scatter_all


def place(cells: DataFrame, grids: dict[str, SourceGrid], dst: Grid, maps: dict[str, DataFrame] | None = None) -> DataFrame:
    """Cells (source, row, col, ...) of several services on the target grid.

    Lon/lat services share one pass and Mercator ones take one each, all without a join; any other projection
    goes through its grid map: a stored one from ``maps`` (see ``stored_map``), else one built on the spot.
    """
    ids = {name: i for i, name in enumerate(grids)}
    flat = {ids[n]: g for n, g in grids.items() if g.projection.family == "longlat"}
    parts = []
    number = F.try_element_at(F.create_map(*(F.lit(x) for kv in ids.items() for x in kv)), F.col("source"))
    numbered = cells.withColumn("source_id", number)
    if flat:
        parts.append(scatter_all(numbered.where(F.col("source_id").isin(list(flat))), flat, dst))
    for name, g in grids.items():
        if g.projection.family == "longlat":
            continue
        own = numbered.where(F.col("source_id") == ids[name])
        if g.projection.family in SEPARABLE:
            parts.append(scatter(own, g, dst))
        else:
            only = {ids[name]: g}
            mapping = (maps or {}).get(name)
            if mapping is None:
                mapping = grid_map(cells.sparkSession, only, dst)
            mapping = mapping.select(F.lit(ids[name]).alias("source_id"), "dst_row", "dst_col", "row", "col")
            parts.append(apply_grid_map(own, mapping, map_rows(only, dst)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("source_id")


def store_map(spark, source: SourceGrid, dst: Grid, key: str, path: str) -> None:
    """Keep the grid map of one geometry under its key (see ``functions.proj.geometry_key``)."""
    mapping = grid_map(spark, {0: source}, dst).drop("source_id").withColumn("geom_key", F.lit(key))
    mapping.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("geom_key").parquet(path)


def stored_map(spark, key: str, path: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("geom_key") == key).drop("geom_key")

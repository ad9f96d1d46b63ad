"""Mosaics with a compact shuffle.

Cell tables are easy to work with but heavy to move: a placed cell is a row of some forty bytes, and a coarse
source multiplies its cells on a fine target. Here what crosses the network are *strips*, one raster line as an
array of raw numbers. They are sent to the blocks of target lines they reach, and only there unfolded to cells,
decoded, placed and merged; the merge needs no second shuffle, because its keys contain those of the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attrs as A
from ..functions.proj import Grid, mercator
from . import mosaic
from .regrid import SourceGrid, _by_id, unfold


def strips(scans: DataFrame, carry: list[str]) -> DataFrame:
    """One row per raster line: (carry, row, raw, scaling, is_u8)."""
    width = F.col("width")
    lines = scans.select(*carry, "width", "scaling", "is_u8", "raw", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("row"))
    return lines.select(*carry, "row", F.slice("raw", F.col("row") * width + 1, width).alias("raw"), "scaling", "is_u8")


def cells(lines: DataFrame, carry: list[str]) -> DataFrame:
    """Valid cells of strips: (carry, row, col, dbz)."""
    opened = lines.select(*carry, "row", "scaling", "is_u8", F.posexplode("raw").alias("col", "_raw"))
    return opened.select(*carry, "row", "col", _value().alias("dbz")).where("dbz is not null")


def _value():
    s = F.col("scaling")
    return A.decode(F.col("_raw"), s["gain"], s["offset"], s["nodata"], s["undetect"], s["byte_rule"] & F.col("is_u8"))


def write(lines: DataFrame, path: str) -> None:
    """Strips at rest, with a date: small rows, and a line range of a raster is a row range of its files."""
    lines.repartition("source", "date", "ts").sortWithinPartitions("source", "date", "ts", "row").write.mode("append").partitionBy(
        "source", "date"
    ).parquet(path)


def block_mosaic(
    lines: DataFrame, grids: dict[str, SourceGrid], dst: Grid, keys: list[str], strategy: str = "max", block_lines: int = 16
) -> DataFrame:
    """(keys, dst_row, dst_col, dbz) from strips ``(keys, source, row, raw, scaling, is_u8)`` of lon/lat sources.

    A (keys, block) group holds at most ``block_lines`` target lines of every source, however many scans there
    are; a strip that reaches two blocks is sent to both and each keeps its own lines only. All strategies of
    ``mosaic`` work; priority is the order of ``grids``.
    """
    if any(g.projection.family != "longlat" for g in grids.values()):
        raise ValueError("strips follow parallels; other projections go through the grid map")
    names = list(grids)
    number = F.try_element_at(F.create_map(*(F.lit(x) for i, n in enumerate(names) for x in (n, i))), F.col("source"))
    sid = F.col("_sid")
    pick = lambda field: _by_id(sid, {i: float(getattr(grids[n], field)) for i, n in enumerate(names)})
    left, top, px, py = (pick(f) for f in ("left", "top", "px", "py"))

    y_of = lambda at: mercator(F.lit(0.0), top - at * py)[1]
    line = lambda at: (F.lit(dst.north) - y_of(at)) / dst.dy - 0.5
    last = dst.height - 1
    numbered = lines.withColumn("_sid", number).where(sid.isNotNull())
    reach = numbered.withColumns(
        {
            "_from": F.greatest(F.lit(0), F.least(F.lit(last), F.floor(line(F.col("row"))).cast("int"))),
            "_to": F.least(F.lit(last), F.ceil(line(F.col("row") + 1)).cast("int")),
        }
    ).where("_from <= _to")
    block = lambda c: F.floor(F.col(c) / block_lines).cast("int")
    routed = reach.withColumn("_block", F.explode(F.sequence(block("_from"), block("_to")))).repartition(*keys, "_block")

    lat = dst.centre_lonlat(F.col("dst_row"), F.lit(0))[1]
    lon = dst.centre_lonlat(F.lit(0), F.col("dst_col"))[0]
    begin = F.greatest("_from", F.col("_block") * block_lines)
    end = F.least("_to", F.col("_block") * block_lines + (block_lines - 1))
    placed_lines = routed.withColumn("dst_row", F.explode(F.sequence(begin, end))).where(F.floor((top - lat) / py) == F.col("row"))
    opened = placed_lines.select(*keys, "_block", "_sid", "dst_row", "scaling", "is_u8", F.posexplode("raw").alias("_col", "_raw"))
    valid = opened.select(*keys, "_block", "_sid", "dst_row", "_col", _value().alias("dbz")).where("dbz is not null")
    x_of = lambda at: (mercator(left + at * px, F.lit(0.0))[0] - dst.west) / dst.dx - 0.5
    col = F.col("_col")
    placed = unfold(valid, "dst_col", F.floor(x_of(col)).cast("int"), F.ceil(x_of(col + 1)).cast("int"), dst.width).where(
        F.floor((lon - left) / px) == col
    )
    ranked = placed.withColumn("priority", sid)
    if strategy == "weighted":
        name = F.element_at(F.array(*(F.lit(n) for n in names)), sid + 1)
        ranked = ranked.withColumn("weight", mosaic.distance_weight(name, lon, lat, F.col("dbz")))
    merged = ranked.groupBy(*keys, "_block", "dst_row", "dst_col").agg(mosaic.strategy(strategy)().cast("double").alias("dbz"))
    return mosaic.finish(merged.drop("_block"), keys, strategy)

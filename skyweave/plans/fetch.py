"""One service: new scans decoded, put on their own Web Mercator raster, drawn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.proj import Grid
from ..operators import render
from ..operators.align import known
from ..operators.regrid import SourceGrid
from ..sources import scans as S
from ..sources import sinks
from .placing import place


def new_scans(scans: DataFrame, stored: DataFrame) -> DataFrame:
    """Scans whose stamp the store has under no spelling; decided on the keys before pixels are read."""
    todo = known(scans.select("source", "ts_raw").distinct(), stored)
    return scans.join(todo, ["source", "ts_raw"], "left_semi")


def drawn(scans: DataFrame, grids: dict[str, SourceGrid], dst: Grid) -> DataFrame:
    """Coloured cells of every scan with the folder and unix name of its output."""
    cells = place(S.cells(scans, ["source", "ts"]), grids, dst)
    return sinks.located(render.render(cells))

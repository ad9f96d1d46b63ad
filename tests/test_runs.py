"""Index runs and weights by lines against the maps by cells, for all projection families."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.functions.proj import Grid, Projection
from skyweave.operators import regrid, runs, strips
from skyweave.operators.mosaic import merge
from skyweave.plans.placing import place

DST = Grid.of_shape((9.0, 20.0, 44.0, 56.0), 37, 41)
P = Projection.of
GRIDS = {
    "flat": regrid.SourceGrid(10, 52, 0.5, 0.5, 10, 10),
    "stere": regrid.SourceGrid(0.0, 0.0, 60_000.0, 60_000.0, 20, 18, P("+proj=stere +lat_ts=60 +lat_0=90 +lon_0=10 +x_0=543196.835 +y_0=3622588.862 +a=6378137 +b=6356752.3142451802")),
    "cone": regrid.SourceGrid(-200.0, 150.0, 20.0, 20.0, 15, 20, P("+proj=lcc +lat_1=46.12 +lat_2=46.12 +lat_0=46.12 +lon_0=14.815 +R=6371000 +units=km")),
    "merc": regrid.SourceGrid(1_200_000.0, 6_900_000.0, 50_000.0, 40_000.0, 12, 9, P("+proj=merc +lon_0=0 +R=6371000")),
    "az": regrid.SourceGrid(-400_000.0, 100_000.0, 45_000.0, 45_000.0, 14, 16, P("+proj=aeqd +lat_0=52.3469 +lon_0=19.0926 +R=6371000")),
    "far": regrid.SourceGrid(-300.0, 150.0, 20.0, 20.0, 3, 3, P("+proj=lcc +lat_1=-40 +lat_2=-40 +lat_0=-40 +lon_0=170 +R=6371000 +units=km")),
}

@pytest.fixture(scope="module")
def scans(spark):
    r = np.random.default_rng(7)
    rows = []
    for slot in (1, 2):
        for name, g in GRIDS.items():
            raw = np.where(r.random((g.height, g.width)) < 0.2, r.choice([0, 255], (g.height, g.width)), r.integers(1, 255, (g.height, g.width)))
            rows.append((slot, name, g.height, g.width, [int(v) for v in raw.ravel()]))
    df = spark.createDataFrame(rows, "slot int, source string, height int, width int, raw array<int>")
    scaling = F.struct(F.lit(0.5).alias("gain"), F.lit(-32.0).alias("offset"), F.lit(255).alias("nodata"), F.lit(0).alias("undetect"), F.lit(True).alias("byte_rule"))
    return df.withColumns({"scaling": scaling, "is_u8": F.lit(True)})


def values(df, *keys):
    return {tuple(r[k] for k in (*keys, "dst_row", "dst_col")): round(r.dbz, 6) for r in df.collect()}


def test_runs_are_the_grid_map(spark):
    sources = dict(enumerate(GRIDS.values()))
    opened = runs.index_runs(spark, sources, DST, block_lines=5).select("source_id", "row", "block", F.inline("runs")).select("source_id", "row", "block", "dst_row", "first", F.posexplode("cols").alias("i", "col"))
    got = {(r.source_id, r.dst_row, r.first + r.i, r.row, r.col) for r in opened.collect()}
    want = {(r.source_id, r.dst_row, r.dst_col, r.row, r.col) for r in regrid.grid_map(spark, sources, DST).collect()}
    assert got == want and {s for s, *_ in want} == {0, 1, 2, 3, 4}
    assert opened.where("block != dst_row div 5").count() == 0


@pytest.mark.parametrize("strategy", ["max", "average", "priority", "weighted"])
def test_mosaic_equals_that_of_cells(spark, scans, strategy):
    lines = strips.strips(scans, ["slot", "source"])
    got = values(runs.run_mosaic(lines, GRIDS, DST, ["slot"], strategy), "slot")
    placed = place(strips.cells(lines, ["slot", "source"]), GRIDS, DST)
    placed = placed.withColumn("priority", F.array_position(F.array(*(F.lit(s) for s in GRIDS)), F.col("source")))
    if strategy == "weighted":
        from skyweave.operators.mosaic import distance_weight

        placed = placed.withColumn("weight", distance_weight(F.col("source"), *DST.centre_lonlat(F.col("dst_row"), F.col("dst_col")), F.col("dbz")))
    want = values(merge(placed, ["slot"], strategy), "slot")
    assert len(want) > 300 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)


def test_lines_not_cells_cross_the_network(spark, scans, tmp_path):
    sources = dict(enumerate(GRIDS.values()))
    runs.store(runs.index_runs(spark, sources, DST), "all_v1", str(tmp_path / "runs"))
    runs.store(runs.index_runs(spark, {0: GRIDS["cone"]}, DST), "cone_v1", str(tmp_path / "runs"))
    kept = runs.stored(spark, "all_v1", str(tmp_path / "runs"))
    lines = strips.strips(scans, ["slot", "source"])
    made = runs.run_mosaic(lines, GRIDS, DST, ["slot"], "max", kept)
    plan = made._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 1 and "slot" in exchanges[0] and "dst_col" not in exchanges[0]
    assert values(made, "slot") == values(runs.run_mosaic(lines, GRIDS, DST, ["slot"], "max"), "slot")


def plain_bilinear(raw, g, fr, fc):
    value = np.where((raw == 0) | (raw == 255), np.nan, raw * 0.5 - 32)
    fr, fc = min(max(fr, 0), g.height - 1), min(max(fc, 0), g.width - 1)
    r, c = int(fr), int(fc)
    total = 0.0
    for i, wr in ((r, 1 - (fr - r)), (r + 1, fr - r)):
        for j, wc in ((c, 1 - (fc - c)), (c + 1, fc - c)):
            if wr * wc > 0:
                total += wr * wc * value[i, j]
    return min(85.0, max(-35.0, total)) if not np.isnan(total) and not np.isnan(value[int(np.rint(fr)), int(np.rint(fc))]) else None


@pytest.mark.parametrize("axes", [runs.Axes((49.6, 45.5, 9), (9.7, 14.3, 11)), runs.Axes((49.0, 49.0, 1), (9.7, 14.3, 11)), runs.Axes((50.1, 48.0, 4), (12.0, 12.0, 1))])
def test_bilinear_weights_against_numpy(spark, scans, axes):
    grids = {n: GRIDS[n] for n in ("flat", "stere", "cone", "az")}
    got = values(runs.weighted_lines(strips.strips(scans, ["slot", "source"]), grids, axes, ["slot"]), "slot", "source")
    at = spark.range(axes.height).select(F.col("id").cast("int").alias("r")).crossJoin(spark.range(axes.width).select(F.col("id").cast("int").alias("c")))
    want = {}
    for row in scans.where(F.col("source").isin(list(grids))).collect():
        g = grids[row.source]
        from skyweave.functions.proj import to_native

        x, y = to_native(g.projection, *axes.centre_lonlat(F.col("r"), F.col("c")))
        for p in at.select("r", "c", x.alias("x"), y.alias("y")).collect():
            v = plain_bilinear(np.array(row.raw).reshape(g.height, g.width), g, (g.top - g.py / 2 - p.y) / g.py, (p.x - g.left - g.px / 2) / g.px)
            if v is not None:
                want[row.slot, row.source, p.r, p.c] = v
    assert len(want) > 4 and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-4 for k in want)


def test_empty_tables(spark, scans):
    none = strips.strips(scans.where("false"), ["slot", "source"])
    assert runs.run_mosaic(none, GRIDS, DST, ["slot"]).count() == 0
    assert runs.weighted_lines(none, {"flat": GRIDS["flat"]}, DST, ["slot"]).count() == 0

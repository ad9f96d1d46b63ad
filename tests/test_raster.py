import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.functions.proj import Grid, Projection
from skyweave.operators import coverage, mosaic, regrid, render, strips
from skyweave.plans.placing import place, store_map, stored_map

RNG = np.random.default_rng(7)


def cells_of(spark, arrays, **extra):
    """{source: 2-D array with NaN} -> cells(source, row, col, dbz)."""
    rows = [(s, r, c, float(a[r, c])) for s, a in arrays.items() for r in range(a.shape[0]) for c in range(a.shape[1]) if not np.isnan(a[r, c])]
    return spark.createDataFrame(rows, "source string, row int, col int, dbz double").withColumns({k: F.lit(v) for k, v in extra.items()})


def holed(shape, share=0.4, low=-30, high=80):
    a = RNG.uniform(low, high, shape)
    a[RNG.random(shape) < share] = np.nan
    return a


def dense(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        assert np.isnan(out[r.dst_row, r.dst_col])
        out[r.dst_row, r.dst_col] = r.dbz
    return out


def test_scatter_equals_the_map_for_lonlat_and_mercator(spark):
    dst = Grid.of_shape((9.3, 18.1, 44.2, 51.7), 41, 37)
    merc = Projection.of("+proj=merc +lat_ts=0 +lon_0=0 +x_0=-1254222.15 +y_0=-6702777.85 +ellps=WGS84")
    grids = {
        "flat": regrid.SourceGrid.of_centres(10.07, 17.9, 45.03, 50.2, 19, 23),
        "merc": regrid.SourceGrid(-100_000.0, 100_000.0, 40_000.0, 38_000.0, 21, 17, merc),
    }
    for name, g in grids.items():
        cells = cells_of(spark, {name: holed((g.height, g.width))}).withColumn("source_id", F.lit(0))
        a = dense(regrid.scatter(cells, g, dst), (41, 37))
        mapping = regrid.grid_map(spark, {0: g}, dst)
        b = dense(regrid.apply_grid_map(cells, mapping, regrid.map_rows({0: g}, dst)), (41, 37))
        big = dense(regrid.apply_grid_map(cells, mapping, 10**9), (41, 37))  # the merge-join way
        tiles = regrid.to_tiles(cells, ["source_id"], 8)
        t = dense(regrid.apply_tile_map(tiles, regrid.tile_map(mapping, 8), 10**9), (41, 37))
        assert (~np.isnan(a)).sum() > 100
        for other in (b, big, t):
            np.testing.assert_array_equal(a, other)


def test_map_against_numpy(spark):
    dst = Grid.of_shape((9.3, 18.1, 44.2, 51.7), 30, 31)
    g = regrid.SourceGrid.of_centres(10.07, 17.9, 45.03, 50.2, 19, 23)
    x = dst.west + (np.arange(31) + 0.5) * dst.dx
    y = dst.north - (np.arange(30) + 0.5) * dst.dy
    lon, lat = x / 20037508.34 * 180, np.degrees(2 * np.arctan(np.exp(y / 20037508.34 * np.pi))) - 90
    fc, fr = (lon - g.left) / g.px, (g.top - lat) / g.py
    for sampling in ("floor", "edge_round"):
        got = {(r.dst_row, r.dst_col): (r.row, r.col) for r in regrid.grid_map(spark, {0: g}, dst, sampling).collect()}
        for i in range(30):
            for j in range(31):
                if sampling == "floor":
                    inside = 0 <= fr[i] < 19 and 0 <= fc[j] < 23
                    want = (math.floor(fr[i]), math.floor(fc[j]))
                else:
                    inside = -0.5 <= fr[i] < 18.5 and -0.5 <= fc[j] < 22.5
                    want = (int(np.clip(np.round(fr[i]), 0, 18)), int(np.clip(np.round(fc[j]), 0, 22)))
                assert got.get((i, j)) == (want if inside else None)


def test_place_mixes_projections(spark):
    dst = Grid.of_shape((9.0, 20.0, 44.0, 56.0), 25, 25)
    stere = Projection.of("+proj=stere +lat_ts=60 +lat_0=90 +lon_0=10 +x_0=543196.835 +y_0=3622588.862 +a=6378137 +b=6356752.3142451802")
    grids = {"flat": regrid.SourceGrid(10, 52, 0.5, 0.5, 10, 10), "dwd": regrid.SourceGrid(0.0, 0.0, 60_000.0, 60_000.0, 20, 18, stere)}
    arrays = {"flat": np.ones((10, 10)), "dwd": np.full((20, 18), 2.0)}
    placed = place(cells_of(spark, arrays), grids, dst)
    counts = {r.source: r["count"] for r in placed.groupBy("source").count().collect()}
    assert counts["flat"] > 30 and counts["dwd"] > 200
    assert placed.groupBy("source", "dst_row", "dst_col").count().where("count > 1").count() == 0


def test_a_stored_map_gives_the_same(spark, tmp_path):
    dst = Grid.of_shape((9.0, 20.0, 44.0, 56.0), 25, 25)
    cone = Projection.of("+proj=lcc +lat_1=46.12 +lat_2=46.12 +lat_0=46.12 +lon_0=14.815 +R=6371000 +units=km")
    g = regrid.SourceGrid(-200.0, 150.0, 20.0, 20.0, 15, 20, cone)
    cells = cells_of(spark, {"arso": holed((15, 20))})
    for key in ("arso_15x20_v1", "other_1x1_v1"):
        store_map(spark, g, dst, key, str(tmp_path / "maps"))
    maps = {"arso": stored_map(spark, "arso_15x20_v1", str(tmp_path / "maps"))}
    a, b = (dense(place(cells, {"arso": g}, dst, m), (25, 25)) for m in (None, maps))
    assert (~np.isnan(a)).sum() > 20
    np.testing.assert_array_equal(a, b)


def test_strips_equal_cells(spark):
    dst = Grid.of_shape((9.3, 18.1, 44.2, 51.7), 53, 47)
    grids = {"a": regrid.SourceGrid(10, 51, 0.31, 0.27, 17, 19), "b": regrid.SourceGrid(12.3, 49.5, 0.11, 0.13, 30, 33), "c": regrid.SourceGrid(8, 46, 0.4, 0.4, 9, 9)}
    scaling = F.struct(F.lit(0.5).alias("gain"), F.lit(-32.0).alias("offset"), F.lit(255).alias("nodata"), F.lit(0).alias("undetect"), F.lit(True).alias("byte_rule"))
    rows, arrays = [], {}
    for n, g in grids.items():
        raw = RNG.integers(0, 256, (g.height, g.width))
        rows.append((1, n, g.height, g.width, [int(v) for v in raw.ravel()]))
        arrays[n] = np.where((raw == 0) | (raw == 255), np.nan, raw * 0.5 - 32)
    scans = spark.createDataFrame(rows, "slot int, source string, height int, width int, raw array<int>").withColumns({"scaling": scaling, "is_u8": F.lit(True)})
    lines = strips.strips(scans, ["slot", "source"])
    lon, lat = dst.centre_lonlat(F.col("dst_row"), F.col("dst_col"))
    for name in ("max", "priority", "average", "weighted"):
        order = F.when(F.col("source") == "a", 0).when(F.col("source") == "b", 1).otherwise(2)
        placed = place(cells_of(spark, arrays, slot=1), grids, dst).withColumn("priority", order)
        placed = placed.withColumn("weight", mosaic.distance_weight(F.col("source"), lon, lat, F.col("dbz")))
        want = dense(mosaic.merge(placed, ["slot"], name), (53, 47))
        made = strips.block_mosaic(lines, grids, dst, ["slot"], name, block_lines=5)
        np.testing.assert_allclose(dense(made, (53, 47)), want)
    fresh = strips.block_mosaic(lines, grids, dst, ["slot"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the merge adds no shuffle


def stack(spark, n=4, shape=(12, 13)):
    arrays = {s: holed(shape, 0.5) for s in list("abcdef")[:n]}
    df = cells_of(spark, arrays, slot=1).withColumnsRenamed({"row": "dst_row", "col": "dst_col"})
    order = F.array_position(F.array(*(F.lit(s) for s in arrays)), F.col("source"))
    return df.withColumn("priority", order), np.stack(list(arrays.values()))


def isolated(a):
    valid = np.pad(~np.isnan(a), 1)
    n = sum(valid[1 + i : valid.shape[0] - 1 + i, 1 + j : valid.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1))
    return np.where(n >= 3, a, np.nan)


def test_merges_against_numpy(spark):
    df, a = stack(spark)
    with np.testing.suppress_warnings() as quiet:
        quiet.filter(RuntimeWarning)
        top, mean, std, med = np.nanmax(a, 0), np.nanmean(a, 0), np.nanstd(a, 0), np.nanmedian(a, 0)
    first = a[0].copy()
    for layer in a[1:]:
        first = np.where(np.isnan(first), layer, first)
    np.testing.assert_allclose(dense(mosaic.merge(df, ["slot"], "max"), top.shape), top)
    np.testing.assert_allclose(dense(mosaic.merge(df, ["slot"], "priority"), top.shape), first)
    want = isolated(np.clip(np.where(std > 15, med, mean), -32, 80))
    np.testing.assert_allclose(dense(mosaic.merge(df, ["slot"], "average"), top.shape), want)
    np.testing.assert_allclose(dense(mosaic.merge(df, ["slot"], "anything else"), top.shape), want)


def test_weighted_merge_against_numpy(spark):
    dst = Grid.of_shape((9.3, 18.1, 44.2, 51.7), 12, 13)
    arrays = {s: holed((12, 13), 0.3, -40, 90) for s in ("dwd", "shmu", "chmi")}
    df = cells_of(spark, arrays, slot=1).withColumnsRenamed({"row": "dst_row", "col": "dst_col"})
    lon, lat = dst.centre_lonlat(F.col("dst_row"), F.col("dst_col"))
    df = df.withColumn("weight", mosaic.distance_weight(F.col("source"), lon, lat, F.col("dbz")))
    x = (dst.west + (np.arange(13) + 0.5) * dst.dx) / 20037508.34 * 180
    y = np.degrees(2 * np.arctan(np.exp((dst.north - (np.arange(12) + 0.5) * dst.dy) / 20037508.34 * np.pi))) - 90
    total, weights = np.zeros((12, 13)), np.zeros((12, 13))
    for s, a in arrays.items():
        w = np.ones((12, 13))
        if s in ("dwd", "shmu"):
            cx, cy = {"dwd": (10.0, 51.5), "shmu": (19.15, 48.55)}[s]
            w = 1 / (np.hypot(x[None, :] - cx, y[:, None] - cy) + 0.1) * np.where((a < -30) | (a > 75), 0.1, 1)
        w = np.where(np.isnan(a), 0, w)
        total, weights = total + w * np.nan_to_num(a), weights + w
    want = isolated(np.clip(np.where(weights > 0, total / np.where(weights > 0, weights, 1), np.nan), -32, 80))
    np.testing.assert_allclose(dense(mosaic.merge(df, ["slot"], "weighted"), want.shape), want)


def test_max_is_order_free_and_idempotent(spark):
    df, _ = stack(spark)
    once = mosaic.merge(df, ["slot"], "max")
    again = mosaic.merge(df.unionByName(df).orderBy(F.rand(3)), ["slot"], "max")
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0


def test_spread_exactly_on_the_limit_is_no_outlier(spark):
    """0, 30, 0, 30, 15+-0: spread 15 in whole; the mean is kept whichever way partial sums meet."""
    values = {"a": 10.0, "b": 40.0, "c": 10.0, "d": 40.0}
    around = [(s, 1, r, c, v) for s, v in values.items() for r in range(3) for c in range(3)]
    df = spark.createDataFrame(around, "source string, slot int, dst_row int, dst_col int, dbz double")
    assert {r.dbz for r in mosaic.merge(df.repartition(7), ["slot"], "average").collect()} == {25.0}
    skewed = df.where("source <> 'd'").unionByName(df.where("source = 'd'").withColumn("dbz", F.lit(41.0)))
    assert {r.dbz for r in mosaic.merge(skewed, ["slot"], "average").collect()} == {25.0}  # the median of 10 10 40 41


@pytest.mark.parametrize("block", [1, 4, 64])
def test_isolation_across_block_borders(spark, block):
    a = holed((13, 14), 0.75)
    df = cells_of(spark, {"s": a}, slot=1).withColumnsRenamed({"row": "dst_row", "col": "dst_col"})
    got = mosaic.drop_isolated(df, ["slot"], block=block)
    np.testing.assert_array_equal(dense(got, a.shape), isolated(a))


def test_two_source_rule(spark):
    df, _ = stack(spark, n=1)
    assert mosaic.merge(df, ["slot"], "max", min_sources=2).count() == 0


def test_bilinear_against_numpy(spark):
    src = regrid.SourceGrid.of_centres(10.0, 14.0, 46.0, 49.0, 7, 9)
    a = holed((7, 9), 0.1, 0, 50)
    lats, lons = np.linspace(49.6, 45.5, 16), np.linspace(9.7, 14.3, 19)
    got = dense(regrid.bilinear(cells_of(spark, {"s": a}), ["source"], src, (49.6, 45.5, 16), (9.7, 14.3, 19)), (16, 19))
    fr = np.clip((49.0 - lats) / 0.5, 0, 6)
    fc = np.clip((lons - 10.0) / 0.5, 0, 8)
    want = np.full((16, 19), np.nan)
    for i, r in enumerate(fr):
        for j, c in enumerate(fc):
            total = 0.0
            for rr in {math.floor(r), math.ceil(r)}:
                for cc in {math.floor(c), math.ceil(c)}:
                    total += (1 - abs(r - rr)) * (1 - abs(c - cc)) * a[rr, cc]
            want[i, j] = total
    np.testing.assert_allclose(got, np.clip(want, -35, 85))


@pytest.mark.parametrize("crowd", [2, 64])
def test_nearest_point_crowded_and_far_outside(spark, crowd):
    rnd = random.Random(2)
    pts = [(i, rnd.uniform(10, 12), rnd.uniform(45, 46)) for i in range(80)]
    pts += [(100 + i, 11 + rnd.uniform(0, 1e-3), 45.5 + rnd.uniform(0, 1e-3)) for i in range(60)]  # a crowd in one spot
    pts += [(300, *pts[0][1:])]  # the same place twice
    targets = [(i, rnd.uniform(0, 25), rnd.uniform(40, 56)) for i in range(60)] + [(99, 11.0005, 45.5005)]
    t = spark.createDataFrame(targets, "target_id bigint, lon double, lat double")
    p = spark.createDataFrame(pts, "point_id bigint, lon double, lat double")
    got = {r.target_id: r.point_id for r in regrid.nearest_point(t, p, crowd).collect()}
    want = {i: min(pts, key=lambda q: (math.hypot(q[1] - x, q[2] - y), q[0]))[0] for i, x, y in targets}
    assert got == want


def test_resample_against_numpy(spark):
    img = RNG.integers(0, 256, (11, 14, 4))
    img[..., 3] = np.where(RNG.random((11, 14)) < 0.6, 255, 0)
    rows = [(1, r, c, *map(int, img[r, c])) for r in range(11) for c in range(14) if img[r, c, 3]]
    df = spark.createDataFrame(rows, "slot int, row int, col int, r int, g int, b int, a int")
    got = np.zeros((5, 21, 4), dtype=int)
    for q in render.resample(df, ["slot"], (11, 14), (5, 21)).collect():
        got[q.row, q.col] = (q.r, q.g, q.b, q.a)

    def weights(n_in, n_out):
        scale = n_in / n_out
        s = max(scale, 1)
        m = np.zeros((n_out, n_in))
        for o in range(n_out):
            centre = (o + 0.5) * scale
            for i in range(max(0, int(centre - 3 * s + 0.5)), min(n_in, int(centre + 3 * s + 0.5))):
                x = (i - centre + 0.5) / s
                m[o, i] = np.sinc(x) * np.sinc(x / 3) if abs(x) < 3 else 0
        exact = m / m.sum(1, keepdims=True) * 2**22
        return (np.sign(exact) * np.floor(np.abs(exact) + 0.5)).astype(np.int64)

    level = lambda v: np.clip((v + 2**21) >> 22, 0, 255)
    pre = np.where(img[..., 3:] > 0, img, 0).astype(np.int64)
    wide = level(np.einsum("oi,rib->rob", weights(14, 21), pre))
    out = level(np.einsum("oi,icb->ocb", weights(11, 5), wide))
    alpha = out[..., 3:]
    rgb = np.where(alpha == 255, out[..., :3], np.minimum(255, out[..., :3] * 255 // np.where(alpha > 0, alpha, 1)))
    np.testing.assert_array_equal(got, np.where(alpha > 0, np.concatenate([rgb, alpha], -1), 0))


def test_render_hides_weak_cells(spark):
    df = spark.createDataFrame([(1, 9.9), (2, 10.0), (3, None)], "id int, dbz double")
    assert {r.id: r.a for r in render.render(df).collect()} == {1: 0, 2: 255, 3: 0}


def test_masks(spark):
    dst = Grid.of_shape((9.0, 15.0, 44.0, 50.0), 20, 20)
    full = spark.range(64).select((F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"))
    inside = coverage.placed_mask(full, (10.0, 12.0, 46.0, 48.0), (8, 8), dst)
    outside = coverage.placed_mask(full, (30.0, 32.0, 46.0, 48.0), (8, 8), dst)
    assert inside.count() > 20 and outside.count() == 0
    assert inside.count() == inside.distinct().count()
    image = coverage.mask_image(spark, inside, dst)
    assert image.count() == 400 and image.where("a = 0").count() == inside.count()


def test_outside_markers(spark):
    rows = [("dwd", 65535, 65535.0, False), ("dwd", 255, 65535.0, False), ("dwd", 255, None, False), ("shmu", 255, 7.0, True), ("shmu", 7, 7.0, True), ("arso", 255, None, True)]
    df = spark.createDataFrame(rows, "source string, raw int, nodata double, is_u8 boolean")
    got = [r[0] for r in df.select(coverage.covered(F.col("raw"), F.col("source"), F.col("nodata"), F.col("is_u8"))).collect()]
    assert got == [False, True, False, False, True, True]


def test_missing_masks_depend_on_the_composite(spark):
    src = spark.createDataFrame([("dwd",), ("shmu",)], "source string")
    have = spark.createDataFrame([("dwd",), ("composite",)], "source string")
    none = spark.createDataFrame([], "source string")
    todo = lambda masks, single: {r.source for r in coverage.missing_masks(src, masks, src, single).collect()}
    assert todo(have, True) == {"shmu"}
    assert todo(have, False) == set()
    assert todo(none, False) == {"dwd", "shmu", "composite"}


def test_bilinear_on_one_target_row(spark):
    from pyspark.sql import functions as F

    from skyweave.operators.regrid import SourceGrid, bilinear

    src = SourceGrid.of_centres(0.0, 3.0, 0.0, 3.0, 4, 4)
    cells = spark.range(16).select(F.lit(1).alias("k"), (F.col("id") / 4).cast("int").alias("row"), (F.col("id") % 4).cast("int").alias("col"), F.col("id").cast("double").alias("dbz"))
    many = {(r.dst_row, r.dst_col): r.dbz for r in bilinear(cells, ["k"], src, (2.5, 0.5, 3), (0.25, 2.75, 6)).collect()}
    one = {(r.dst_row, r.dst_col): r.dbz for r in bilinear(cells, ["k"], src, (2.5, 2.5, 1), (0.25, 2.75, 6)).collect()}
    assert one and all(abs(many[0, c] - v) < 1e-9 for (_, c), v in one.items()) and len(one) == 6


def test_centres_of_one_row_or_column():
    from skyweave.operators.regrid import SourceGrid

    assert SourceGrid.of_centres(0.0, 3.0, 5.0, 5.0, 1, 4).py == 1.0
    assert SourceGrid.of_centres(2.0, 2.0, 5.0, 5.0, 1, 1).px == 1.0

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweave.dimensions import REFERENCE_EXTENT
from skyweave.functions import attrs as A
from skyweave.functions import colour as K
from skyweave.functions import proj as P
from skyweave.functions import timefn as T
from skyweave.operators import quarantine
from skyweave.sources.srd import SRD_PROJECTION


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize(
    "text, want",
    [
        ("20250128120530", "2025-01-28 12:05:30"),
        ("202501281205", "2025-01-28 12:05:00"),
        ("20250128_1205", "2025-01-28 12:05:00"),
        ("20250128120599", "2025-01-28 12:05:00"),
        ("20251328120500", None),
        ("nonsense", None),
        ("", None),
    ],
)
def test_parse(spark, text, want):
    got = one(spark, F.date_format(T.parse_timestamp(F.lit(text)), "yyyy-MM-dd HH:mm:ss"))[0]
    assert got == want


def test_candidates_are_newest_first_and_rounded(spark):
    got = one(spark, T.timestamp_candidates(F.to_timestamp(F.lit("2025-01-28 12:03:40")), 2, 5, 10))[0]
    assert got == ["202501281150", "202501281145", "202501281140", "202501281135", "202501281130", "202501281125"]


def test_unix_in_a_zone(spark):
    assert one(spark, T.to_unix(F.lit("202501281200")), T.to_unix(F.lit("202501281200"), "Europe/Prague"))[:] == (1738065600, 1738062000)


PROJECTIONS = {
    "webmerc": P.Projection("webmerc"),
    "cone": P.Projection.of(SRD_PROJECTION),
    "mercator": P.Projection.of("+proj=merc +lat_ts=0 +lon_0=0 +x_0=-1254222.15 +y_0=-6702777.85 +ellps=WGS84"),
    "stereo": P.Projection.of("+proj=stere +lat_ts=60 +lat_0=90 +lon_0=10 +x_0=543196.835 +y_0=3622588.862 +a=6378137 +b=6356752.3142451802"),
    "azimuthal": P.Projection.of("+proj=aeqd +lat_0=52.3469 +lon_0=19.0926 +ellps=sphere"),
}


@pytest.mark.parametrize("name", PROJECTIONS)
def test_round_trip(spark, name):
    p = PROJECTIONS[name]
    pts = spark.range(400).select((F.col("id") % 20 + 2.5).cast("double").alias("lon"), (F.floor(F.col("id") / 20) * 0.6 + 44.3).alias("lat"))
    x, y = P.to_native(p, F.col("lon"), F.col("lat"))
    lon, lat = P.to_lonlat(p, F.col("x"), F.col("y"))
    back = pts.select("lon", "lat", x.alias("x"), y.alias("y")).select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(back) < 1e-9


def test_known_projection_points(spark):
    """The origin of each grid; of the stereographic one the published outer corner, half a kilometre off its first
    cell centre, which is the point (0, 0)."""
    lon, lat = F.lit(14.815), F.lit(46.12)
    x, y = P.to_native(PROJECTIONS["cone"], lon, lat)
    assert np.allclose(one(spark, x, y)[:], (0, 0), atol=1e-6)
    x, y = P.to_native(PROJECTIONS["stereo"], F.lit(1.463301510256666), F.lit(55.86208711))
    assert np.allclose(one(spark, x, y)[:], (-500, 500), atol=0.01)
    x, y = P.to_native(PROJECTIONS["azimuthal"], F.lit(19.0926), F.lit(52.3469))
    assert np.allclose(one(spark, x, y)[:], (0, 0), atol=1e-6)


def test_mercator_inverse_is_right(spark):
    x, y = P.mercator(F.lit(14.0), F.lit(46.1))
    assert abs(one(spark, P.lonlat(x, y)[1])[0] - 46.1) < 1e-9


def test_reference_grid():
    grid = P.Grid.at_resolution(REFERENCE_EXTENT, 500)
    assert (grid.width, grid.height) == (5548, 4345)
    assert 0 < 500 - grid.dx < 1 and 0 < 500 - grid.dy < 1


def test_decode_markers_are_raw_values(spark):
    df = spark.createDataFrame([(0,), (1,), (129,), (254,), (255,)], "raw int")
    got = [r[0] for r in df.select(A.decode(F.col("raw"), 0.5, -32.0, 255, 0)).collect()]
    assert got == [None, -31.5, 32.5, 95.0, None]
    # a scaled value that happens to equal the marker is kept
    assert df.select(A.decode(F.col("raw"), 255.0, 0.0, 255, 0).alias("v")).where("raw = 1").first().v == 255.0
    plain = [r[0] for r in df.select(A.decode(F.col("raw"), 1.0, 0.0, -32768, 0, F.lit(True))).collect()]
    assert plain == [None, 1.0, 129.0, 254.0, None]


def test_signed_bytes(spark):
    assert one(spark, A.unsigned(F.lit(-127)), A.decode_signed_byte(F.lit(-127)), A.decode_signed_byte(F.lit(-1)))[:] == (129, 32.5, None)


def test_encode_decode_round_trip(spark):
    df = spark.range(1, 255).select(F.col("id").cast("int").alias("raw"))
    back = ((A.decode(F.col("raw"), 0.5, -32.0, 255, 0) + 32) * 2).cast("int")
    assert df.where(back != F.col("raw")).count() == 0


@pytest.mark.parametrize("name, ok", [("dwd", True), (" DWD ", True), ("a", False), ("abcdefghijk", False), ("d1d", False), ("../etc", False), ("", False), (None, False)])
def test_source_names(spark, name, ok):
    assert one(spark, A.valid_source(F.lit(name).cast("string")))[0] is ok


@pytest.mark.parametrize("h, w, ok", [(1, 1, True), (10000, 10000, True), (0, 5, False), (5, -1, False), (10001, 5, False)])
def test_dimensions(spark, h, w, ok):
    assert one(spark, A.valid_dimensions(F.lit(h), F.lit(w)))[0] is ok


def test_quarantine_split(spark):
    rows = spark.createDataFrame(
        [("DWD", 10, 10, bytearray(b"\x89HDF")), ("x", 10, 10, bytearray(b"\x89HDF")), ("shmu", 0, 10, bytearray(b"\x89HDF")), ("shmu", 9, 9, bytearray(b"<html>"))],
        "source string, height int, width int, content binary",
    )
    good, bad = quarantine.split(rows)
    assert [r.source for r in good.collect()] == ["dwd"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad grid dimensions", "bad source name", "page instead of data"]


def test_a_corner_at_zero_is_not_missing(spark):
    attrs = F.create_map(*(F.lit(x) for x in ("LL_lon", "0.0", "LL_lat", "0", "UR_lon", "3.5", "ur_lat", "4")))
    assert one(spark, A.corner_extent(attrs))[0][:] == (0.0, 3.5, 0.0, 4.0)


def test_colour_scale(spark):
    scale = {r.dbz: (r.r, r.g, r.b) for r in K.colour_scale(spark).collect()}
    assert len(scale) == 121 and scale[-35] == (0, 0, 0) and scale[20] == (0, 232, 12) and scale[85] == (252, 172, 252)
    assert scale[22] == (33, 235, 7)  # cut off, not rounded
    assert all(scale[d] != scale[d + 1] for d in range(0, 60))
    assert len(K.colour_lut(spark).collect()) == 256


def test_colour_index_limits(spark):
    got = one(spark, *(K.colour_index(F.lit(v)) for v in (-50.0, -35.0, 24.9, 85.0, 99.0)))[:]
    assert got == (0, 0, int(59.9 / 120 * 255), 255, 255)


def test_geometry_key(spark):
    import hashlib

    key = one(spark, P.geometry_key(F.lit("SHMU "), F.lit(1560), F.lit(2270), [F.lit(1.4), F.lit(2.5), F.lit(3.5), F.lit(-0.4)]))[0]
    assert key == "shmu_1560x2270_" + hashlib.md5(b"1_2_4_-0").hexdigest()[:8] + "_v1"
    assert one(spark, P.geometry_key(F.lit("shmu"), F.lit(3), F.lit(4)))[0] == "shmu_3x4_v1"


def test_scaled_dimensions_are_at_least_one(spark):
    got = one(spark, P.scaled_dimensions(F.lit(3), F.lit(4), F.lit(1e7), F.lit(1000.0), F.lit(45.0), F.lit(50.0)))[0]
    assert (got.height, got.width) == (1, 1)

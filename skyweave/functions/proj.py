"""Map projections and raster geometry as closed-form column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_WORLD = 20037508.34  # metres from the central meridian to the date line
WGS84_A = 6378137.0
WGS84_B = 6356752.314245179
SPHERE_R = 6371000.0

Pair = tuple[Column, Column]


def mercator(lon: Column, lat: Column) -> Pair:
    """Web Mercator metres of a lon/lat pair."""
    y = F.log(F.tan((lat + 90.0) * F.lit(math.pi) / 360.0)) / F.lit(math.pi / 180.0)
    return lon * HALF_WORLD / 180.0, y * HALF_WORLD / 180.0


def lonlat(x: Column, y: Column) -> Pair:
    """Lon/lat of Web Mercator metres."""
    lat = F.atan(F.exp(y / HALF_WORLD * F.lit(math.pi))) * 360.0 / F.lit(math.pi) - 90.0
    return x / HALF_WORLD * 180.0, lat


@dataclass(frozen=True)
class Projection:
    """Parameters of one projection family: longlat, webmerc, merc, lcc, stere (polar), aeqd."""

    family: str
    lon0: float = 0.0
    lat0: float = 0.0
    lat1: float = 0.0  # standard parallel / latitude of true scale
    x0: float = 0.0
    y0: float = 0.0
    a: float = SPHERE_R
    e: float = 0.0  # eccentricity
    unit: float = 1.0  # metres per unit

    @staticmethod
    def of(text: str) -> "Projection":
        """Read a PROJ.4 string."""
        keys = dict((part.split("=") + ["1"])[:2] for part in text.replace("+", " ").split())
        num = lambda name, default=0.0: float(keys.get(name, default))
        ellps = keys.get("ellps", keys.get("datum", ""))
        if "R" in keys:
            a, b = num("R"), num("R")
        elif "a" in keys:
            a, b = num("a"), num("b", num("a"))
        elif ellps == "sphere":
            a = b = 6370997.0
        else:
            a, b = WGS84_A, WGS84_B
        family = keys.get("proj", "longlat")
        return Projection(
            family="longlat" if family in ("longlat", "latlong") else family,
            lon0=num("lon_0"),
            lat0=num("lat_0"),
            lat1=num("lat_1") if "lat_1" in keys else num("lat_ts"),
            x0=num("x_0"),
            y0=num("y_0"),
            a=a,
            e=math.sqrt(max(0.0, 1.0 - (b / a) ** 2)),
            unit=1000.0 if keys.get("units") == "km" else 1.0,
        )


def _conformal_factor(e: float, sine: Column) -> Column:
    return F.pow((1.0 - sine * e) / (1.0 + sine * e), F.lit(e / 2.0))


def _from_conformal(e: float, chi: Column) -> Column:
    """Geodetic latitude of a conformal latitude: the four-term series in the eccentricity."""
    e2, e4, e6, e8 = e**2, e**4, e**6, e**8
    terms = (
        (2, e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360),
        (4, 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520),
        (6, 7 * e6 / 120 + 81 * e8 / 1120),
        (8, 4279 * e8 / 161280),
    )
    phi = chi
    for multiple, factor in terms:
        phi = phi + F.sin(chi * float(multiple)) * factor
    return phi


def _scale_at(p: Projection) -> float:
    sine = math.sin(math.radians(p.lat1))
    return math.cos(math.radians(p.lat1)) / math.sqrt(1.0 - (p.e * sine) ** 2)


def _polar_t(p: Projection, lat_deg: float) -> float:
    phi = math.radians(lat_deg)
    sine = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - p.e * sine) / (1 + p.e * sine)) ** (p.e / 2)


def to_native(p: Projection, lon: Column, lat: Column) -> Pair:
    """Projected coordinates of a lon/lat pair, in the units of the projection."""
    if p.family == "longlat":
        return lon, lat
    if p.family == "webmerc":
        return mercator(lon, lat)
    phi, dlam = F.radians(lat), F.radians(lon - p.lon0)
    if p.family == "merc":
        k = p.a * _scale_at(p)
        y = F.log(F.tan(phi / 2.0 + math.pi / 4.0) * _conformal_factor(p.e, F.sin(phi))) * k
        return (dlam * k + p.x0) / p.unit, (y + p.y0) / p.unit
    if p.family == "lcc":
        n, f, rho0 = _cone(p)
        rho = F.lit(p.a * f) / F.pow(F.tan(phi / 2.0 + math.pi / 4.0), F.lit(n))
        return (rho * F.sin(dlam * n) + p.x0) / p.unit, (F.lit(rho0) - rho * F.cos(dlam * n) + p.y0) / p.unit
    if p.family == "stere":
        t = F.tan(F.lit(math.pi / 4.0) - phi / 2.0) / _conformal_factor(p.e, F.sin(phi))
        rho = t * _polar_radius(p)
        return (rho * F.sin(dlam) + p.x0) / p.unit, (p.y0 - rho * F.cos(dlam)) / p.unit
    if p.family == "aeqd":
        s0, c0 = math.sin(math.radians(p.lat0)), math.cos(math.radians(p.lat0))
        cosc = F.sin(phi) * s0 + F.cos(phi) * c0 * F.cos(dlam)
        c = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosc)))
        k = F.when(F.abs(c) < 1e-12, F.lit(1.0)).otherwise(c / F.sin(c)) * p.a
        x = k * F.cos(phi) * F.sin(dlam)
        y = k * (F.sin(phi) * c0 - F.cos(phi) * s0 * F.cos(dlam))
        return (x + p.x0) / p.unit, (y + p.y0) / p.unit
    raise ValueError(f"unknown projection family {p.family}")


def to_lonlat(p: Projection, x: Column, y: Column) -> Pair:
    """Lon/lat of projected coordinates."""
    if p.family == "longlat":
        return x, y
    if p.family == "webmerc":
        return lonlat(x, y)
    xm, ym = x * p.unit - p.x0, y * p.unit - p.y0
    if p.family == "merc":
        k = p.a * _scale_at(p)
        chi = F.lit(math.pi / 2.0) - F.atan(F.exp(ym / -k)) * 2.0
        return F.degrees(xm / k) + p.lon0, F.degrees(_from_conformal(p.e, chi))
    if p.family == "lcc":
        n, f, rho0 = _cone(p)
        dy = F.lit(rho0) - ym
        rho, theta = F.sqrt(xm * xm + dy * dy), F.atan2(xm, dy)
        lat = F.atan(F.pow(F.lit(p.a * f) / rho, F.lit(1.0 / n))) * 2.0 - math.pi / 2.0
        return F.degrees(theta / n) + p.lon0, F.degrees(lat)
    if p.family == "stere":
        t = F.sqrt(xm * xm + ym * ym) / _polar_radius(p)
        chi = F.lit(math.pi / 2.0) - F.atan(t) * 2.0
        return F.degrees(F.atan2(xm, -ym)) + p.lon0, F.degrees(_from_conformal(p.e, chi))
    if p.family == "aeqd":
        s0, c0 = math.sin(math.radians(p.lat0)), math.cos(math.radians(p.lat0))
        rho = F.sqrt(xm * xm + ym * ym)
        c = rho / p.a
        ratio = F.when(rho < 1e-9, F.lit(0.0)).otherwise(ym * F.sin(c) / rho)
        lat = F.asin(F.cos(c) * s0 + ratio * c0)
        lon = F.atan2(xm * F.sin(c), rho * c0 * F.cos(c) - ym * s0 * F.sin(c))
        return F.degrees(lon) + p.lon0, F.degrees(lat)
    raise ValueError(f"unknown projection family {p.family}")


def _cone(p: Projection) -> tuple[float, float, float]:
    """Cone constant, scale factor and radius of the origin of a one-parallel conformal cone on a sphere."""
    phi1, phi0 = math.radians(p.lat1), math.radians(p.lat0)
    n = math.sin(phi1)
    f = math.cos(phi1) * math.tan(math.pi / 4 + phi1 / 2) ** n / n
    return n, f, p.a * f / math.tan(math.pi / 4 + phi0 / 2) ** n


def _polar_radius(p: Projection) -> float:
    return p.a * _scale_at(p) / _polar_t(p, p.lat1)


def transform(src: Projection, dst: Projection, x: Column, y: Column) -> Pair:
    """Coordinates in ``dst`` of a point given in ``src``."""
    return to_native(dst, *to_lonlat(src, x, y))


def parse_proj(text: Column) -> Column:
    """PROJ.4 text as a map of its keys; a key without a value maps to null."""
    return F.str_to_map(F.trim(F.regexp_replace(F.trim(text), r"\+", "")), F.lit(" +"), F.lit("="))


def is_longlat(text: Column) -> Column:
    return F.coalesce(F.lower(text).contains("+proj=longlat"), F.lit(False))


def widen_centres(west: Column, east: Column, south: Column, north: Column, height: Column, width: Column) -> Column:
    """Pixel size and outer edges from the outline of pixel *centres* (n cells span n-1 steps)."""
    dx = F.when(width > 1, (east - west) / (width - 1)).otherwise(F.lit(0.0))
    dy = F.when(height > 1, (north - south) / (height - 1)).otherwise(F.lit(0.0))
    return F.struct(
        dx.alias("px"),
        dy.alias("py"),
        (west - dx / 2).alias("left"),
        (east + dx / 2).alias("right"),
        (south - dy / 2).alias("bottom"),
        (north + dy / 2).alias("top"),
    )


def edge_bounds(west: Column, east: Column, south: Column, north: Column, height: Column, width: Column) -> Column:
    """The same struct with the outline taken for the outer edges."""
    return F.struct(
        ((east - west) / width).alias("px"),
        ((north - south) / height).alias("py"),
        west.alias("left"),
        east.alias("right"),
        south.alias("bottom"),
        north.alias("top"),
    )


def native_affine(p: Projection, attrs: Column, height: Column, width: Column) -> Column:
    """Pixel size and outer edges in native coordinates from the corner attributes (pixel centres)."""
    number = lambda name: F.coalesce(F.try_element_at(attrs, F.lit(name)).try_cast("double"), F.lit(0.0))
    ulx, uly = to_native(p, number("UL_lon"), number("UL_lat"))
    urx, _ = to_native(p, number("UR_lon"), number("UR_lat"))
    _, lly = to_native(p, number("LL_lon"), number("LL_lat"))
    return widen_centres(ulx, urx, lly, uly, height, width)


def corner_axes(p: Projection, attrs: Column) -> Column:
    """Projected axis ends estimated from four lon/lat corners: x from the left and right, y from top and bottom."""
    number = lambda name: F.coalesce(F.try_element_at(attrs, F.lit(name)).try_cast("double"), F.lit(0.0))
    ulx, uly = to_native(p, number("UL_lon"), number("UL_lat"))
    llx, lly = to_native(p, number("LL_lon"), number("LL_lat"))
    urx, _ = to_native(p, number("UR_lon"), number("UL_lat"))
    _, lry = to_native(p, number("LR_lon"), number("LL_lat"))
    return F.struct(
        ((llx + ulx) / 2).alias("x_left"), urx.alias("x_right"), uly.alias("y_top"), ((lly + lry) / 2).alias("y_bottom")
    )


def axis_lonlat(west: Column, east: Column, south: Column, north: Column, row: Column, col: Column, height: Column, width: Column) -> Pair:
    """Lon/lat of a cell of a regular grid given by its outline of centres; row 0 is north."""
    lon = F.when(width > 1, west + col * (east - west) / (width - 1)).otherwise(west)
    lat = F.when(height > 1, north - row * (north - south) / (height - 1)).otherwise(north)
    return lon, lat


def scaled_dimensions(height: Column, width: Column, target_m: Column, native_m: Column, south: Column, north: Column) -> Column:
    """Raster size at a wanted resolution; without a native one it is judged from the latitude span."""
    span = (north - south) * 111320.0 * F.cos(F.radians((south + north) / 2))
    factor = F.coalesce(native_m, span / height) / target_m
    return F.struct(
        F.greatest(F.lit(1), (height * factor).cast("int")).alias("height"),
        F.greatest(F.lit(1), (width * factor).cast("int")).alias("width"),
    )


def degree_distance(lon: Column, lat: Column, lon0: float, lat0: float) -> Column:
    return F.sqrt((lon - lon0) * (lon - lon0) + (lat - lat0) * (lat - lat0))


def geometry_key(name: Column, height: Column, width: Column, bounds: list[Column] | None = None, version: str = "v1") -> Column:
    """Stable name of a source grid; whole-metre bounds are hashed in when given."""
    size = F.format_string("%dx%d", height, width)
    if bounds is None:
        return F.concat_ws("_", F.lower(F.trim(name)), size, F.lit(version))
    whole = [F.format_string("%.0f", F.rint(b)) for b in bounds]
    return F.concat_ws("_", F.lower(F.trim(name)), size, F.substring(F.md5(F.concat_ws("_", *whole)), 1, 8), F.lit(version))


@dataclass(frozen=True)
class Grid:
    """A Web Mercator target grid: outer bounds in metres and size in cells; row 0 is north."""

    west: float
    east: float
    south: float
    north: float
    width: int
    height: int

    @staticmethod
    def _metres(lon: float, lat: float) -> tuple[float, float]:
        y = math.log(math.tan((90.0 + lat) * math.pi / 360.0)) / (math.pi / 180.0)
        return lon * HALF_WORLD / 180.0, y * HALF_WORLD / 180.0

    @classmethod
    def at_resolution(cls, extent: tuple[float, float, float, float], metres: float) -> "Grid":
        """Cells of about ``metres``: their number is rounded up, then they are stretched to the bounds."""
        west, east, south, north = extent
        (x0, y0), (x1, y1) = cls._metres(west, south), cls._metres(east, north)
        return cls(x0, x1, y0, y1, math.ceil((x1 - x0) / metres), math.ceil((y1 - y0) / metres))

    @classmethod
    def of_shape(cls, extent: tuple[float, float, float, float], height: int, width: int) -> "Grid":
        west, east, south, north = extent
        (x0, y0), (x1, y1) = cls._metres(west, south), cls._metres(east, north)
        return cls(x0, x1, y0, y1, width, height)

    @property
    def dx(self) -> float:
        return (self.east - self.west) / self.width

    @property
    def dy(self) -> float:
        return (self.north - self.south) / self.height

    @property
    def cells(self) -> int:
        return self.width * self.height

    def centre(self, row: Column, col: Column) -> Pair:
        """Metres of the centre of a cell."""
        return (col + 0.5) * self.dx + self.west, F.lit(self.north) - (row + 0.5) * self.dy

    def centre_lonlat(self, row: Column, col: Column) -> Pair:
        return lonlat(*self.centre(row, col))

"""Scan attributes: scaling, corners, metadata, header typing, quarantine predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dimensions import DECODE_DEFAULTS, MAX_GRID_DIMENSION, QUANTITY_UNITS, SRD_UNITS, STEREO_CORNERS, by_source


def attr(attrs: Column, *names: str) -> Column:
    """First attribute present under any of the names."""
    return F.coalesce(*(F.try_element_at(attrs, F.lit(name)) for name in names))


def number(attrs: Column, *names: str) -> Column:
    return attr(attrs, *names).try_cast("double")


GENERIC_DEFAULTS = (1.0, 0.0, 65535, 0, False)


def scaling(attrs: Column, source: Column | str) -> Column:
    """gain, offset, nodata, undetect and the unsigned-byte rule of a scan, each with its source's default.

    ``source`` is a column, or the name where all scans are of one service.
    """
    if isinstance(source, str):
        field = lambda i: F.lit(DECODE_DEFAULTS.get(source, GENERIC_DEFAULTS)[i])
    else:
        field = lambda i: by_source(source, {name: row[i] for name, row in DECODE_DEFAULTS.items()}, GENERIC_DEFAULTS[i])
    whole = lambda name: number(attrs, name).cast("int")
    return F.struct(
        F.coalesce(number(attrs, "gain"), field(0)).alias("gain"),
        F.coalesce(number(attrs, "offset"), field(1)).alias("offset"),
        F.coalesce(whole("nodata"), field(2)).alias("nodata"),
        F.coalesce(whole("undetect"), field(3)).alias("undetect"),
        field(4).alias("byte_rule"),
    )


def decode(raw: Column, gain, offset, nodata, undetect, byte_rule=None) -> Column:
    """Reflectivity of a raw value, null for the marker values; the markers are compared on the raw side."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    missing = (raw == lit(nodata)) | (raw == lit(undetect))
    if byte_rule is not None:
        missing = missing | (lit(byte_rule) & (raw == 255))
    value = raw.cast("float") * lit(gain).cast("float") + lit(offset).cast("float")
    return F.when(missing, F.lit(None)).otherwise(value).cast("float")


def unsigned(raw: Column) -> Column:
    """Signed byte read as unsigned."""
    return F.pmod(raw, F.lit(256))


def decode_signed_byte(raw: Column) -> Column:
    return decode(unsigned(raw), 0.5, -32.0, 255, 0)


def decode_level(level: Column, offset: Column, start: Column, slope: Column) -> Column:
    """Text-grid level: ``start + slope * (level - offset)``, null at the offset itself."""
    return F.when(level != offset, (start + slope * (level - offset)).cast("float"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def typed(text: Column) -> Column:
    """A header value as whole number, else as double, else as text."""
    return F.struct(
        text.try_cast("int").alias("as_int"),
        text.try_cast("double").alias("as_double"),
        F.when(text.try_cast("int").isNotNull(), "int").when(text.try_cast("double").isNotNull(), "double").otherwise("string").alias("kind"),
    )


def corner_extent(attrs: Column, fallback: Column | None = None) -> Column:
    """Extent from the lower-left and upper-right corners; the fallback when any of the four is missing."""
    parts = {
        "west": number(attrs, "LL_lon", "ll_lon"),
        "east": number(attrs, "UR_lon", "ur_lon"),
        "south": number(attrs, "LL_lat", "ll_lat"),
        "north": number(attrs, "UR_lat", "ur_lat"),
    }
    complete = reduce(lambda a, b: a & b, (c.isNotNull() for c in parts.values()))
    found = F.when(complete, F.struct(*(c.alias(n) for n, c in parts.items())))
    return found if fallback is None else F.coalesce(found, fallback)


def extent_lit(bounds: tuple[float, float, float, float]) -> Column:
    return F.struct(*(F.lit(v).alias(n) for n, v in zip(("west", "east", "south", "north"), bounds)))


def four_corner_extent(attrs: Column) -> Column:
    """Extent enclosing four corners in any order; an absent corner takes its default."""
    value = lambda corner, axis: F.coalesce(
        number(attrs, f"{corner}_{'lon' if axis == 0 else 'lat'}"), F.lit(STEREO_CORNERS[corner][axis])
    )
    lons, lats = ([value(c, axis) for c in STEREO_CORNERS] for axis in (0, 1))
    return F.struct(
        F.least(*lons).alias("west"), F.greatest(*lons).alias("east"), F.least(*lats).alias("south"), F.greatest(*lats).alias("north")
    )


def step_extent(lat1: Column, lon1: Column, dx: Column, dy: Column, height: Column, width: Column) -> Column:
    """Extent of a grid given by its first point and its steps; the first latitude is the northern one."""
    return F.struct(
        lon1.alias("west"), (lon1 + (width - 1) * dx).alias("east"), (lat1 - (height - 1) * dy).alias("south"), lat1.alias("north")
    )


def quantity_units(quantity: Column) -> Column:
    table = F.create_map(*(F.lit(v) for pair in QUANTITY_UNITS.items() for v in pair))
    return F.coalesce(F.try_element_at(table, F.upper(quantity)), F.lit("unknown"))


def srd_units(unit: Column) -> Column:
    table = F.create_map(*(F.lit(v) for pair in SRD_UNITS.items() for v in pair))
    return F.coalesce(F.try_element_at(table, F.upper(unit)), unit)


def decode_bytes(attrs: Column) -> Column:
    """Attribute map with binary values as text."""
    return F.transform_values(attrs, lambda _, v: F.decode(v, "UTF-8"))


def odim_metadata(what_global: Column, what_dataset: Column, what_data: Column, where_attrs: Column) -> Column:
    """The standard metadata of a scan with its defaults."""
    text = lambda attrs, name: F.coalesce(attr(attrs, name), F.lit("")).alias(name)
    num = lambda attrs, name, default: F.coalesce(number(attrs, name), F.lit(float(default))).alias(name)
    return F.struct(
        *(text(what_global, n) for n in ("source", "date", "time", "object", "version")),
        *(text(what_dataset, n) for n in ("product", "startdate", "starttime", "enddate", "endtime")),
        text(what_data, "quantity"),
        *(num(what_data, n, d) for n, d in (("gain", 1), ("offset", 0), ("nodata", 65535), ("undetect", 0))),
        text(where_attrs, "projdef"),
        *(num(where_attrs, n, 0) for n in ("xsize", "ysize", "xscale", "yscale")),
    )


def product_of_filename(name: Column) -> Column:
    """Product named in a file name; the first of dmax, pg, hg that occurs."""
    return F.when(name.contains("dmax"), "dmax").when(name.contains("pg"), "pg").when(name.contains("hg"), "hg").otherwise("UNKNOWN")


def clean_source(name: Column) -> Column:
    return F.lower(F.trim(name))


def valid_source(name: Column) -> Column:
    return F.coalesce(clean_source(name).rlike("^[a-z]{2,10}$"), F.lit(False))


def valid_dimensions(height: Column, width: Column) -> Column:
    return F.coalesce(height.between(1, MAX_GRID_DIMENSION) & width.between(1, MAX_GRID_DIMENSION), F.lit(False))


def looks_like_html(content: Column) -> Column:
    """An error page that came instead of data, told by its first bytes (binary column)."""
    head = F.decode(F.substring(content, 1, 5), "ISO-8859-1")
    return F.startswith(head, F.lit("<!DO")) | F.startswith(head, F.lit("<html"))


def clip(value: Column, limits: tuple[float, float]) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(limits[0]), F.least(F.lit(limits[1]), value)))


def store_key(name: Column) -> Column:
    """Parts of a stored file's stem ``source_product_stamp``; null when there are fewer than three."""
    parts = F.split(name, "_")
    return F.when(
        F.size(parts) >= 3,
        F.struct(parts[0].alias("source"), parts[1].alias("product"), parts[2].alias("timestamp")),
    )

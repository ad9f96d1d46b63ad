"""Landed scans: metadata, pixels, and the per-source readers."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import SCAN_FALLBACK_EXTENTS
from ..functions import attrs as A
from ..functions import timefn as T
from ..schema import RAW_SCAN
from . import srd, text_grids


def read_landed(spark: SparkSession, path: str, source: str | None = None, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Landed raw scans, partitioned by source and date; both filters prune partitions before any pixel is read.

    The period is that of whole days here, as a scan's stamp is known only to its reader: ``read_scans`` applies it."""
    scans = spark.read.schema(RAW_SCAN).parquet(path)
    if source is not None:
        scans = scans.where(F.col("source") == source)
    if start is not None and end is not None:
        day = lambda c: F.date_format(c, "yyyy-MM-dd")
        scans = scans.where(F.col("date").between(day(start), day(end)))
    return scans


def write_landed(scans: DataFrame, path: str) -> None:
    scans.write.mode("append").partitionBy("source", "date").parquet(path)


def _standard(source: str, scans: DataFrame, scaling_attrs: Column, extent: Column, ts14: Column, product: Column, quantity: Column) -> DataFrame:
    return (
        scans.withColumn("scaling", A.scaling(scaling_attrs, source))
        .withColumn("extent", extent)
        .withColumn("ts14", ts14)
        .withColumn("ts", T.parse_timestamp(F.col("ts14"), T.FULL))
        .withColumn("product", product)
        .withColumn("quantity", quantity)
        .withColumn("units", A.quantity_units(quantity))
        .withColumn("proj_def", F.nullif(F.trim(A.attr(F.col("where_attrs"), "projdef")), F.lit("")))
    )


def read_dwd(scans: DataFrame) -> DataFrame:
    """Product and stamp from the file name, scaling of the data group, extent from four corners in any order."""
    product = A.product_of_filename(F.col("path"))
    quantity = F.when(product == "dmax", "DBZH").otherwise("UNKNOWN")
    ts14 = F.coalesce(T.stamp_from_filename(F.col("path"), "dwd"), T.normalize_timestamp(F.col("ts_raw"), 14))
    return _standard("dwd", scans, F.col("what_data"), A.four_corner_extent(F.col("where_attrs")), ts14, product, quantity)


def read_shmu(scans: DataFrame) -> DataFrame:
    """Scaling, product and stamp of the dataset group; corners always given."""
    g = F.col("what_dataset")
    return _standard("shmu", scans, g, A.corner_extent(F.col("where_attrs")), T.stamp_from_attrs(g), _or_unknown(g, "product"), _or_unknown(g, "quantity"))


def read_chmi(scans: DataFrame) -> DataFrame:
    """Scaling and quantity of the data group, product and stamp of the dataset group, known extent as fallback."""
    d, g = F.col("what_data"), F.col("what_dataset")
    extent = A.corner_extent(F.col("where_attrs"), A.extent_lit(SCAN_FALLBACK_EXTENTS["chmi"]))
    return _standard("chmi", scans, d, extent, T.stamp_from_attrs(g), _or_unknown(g, "product"), _or_unknown(d, "quantity"))


def read_imgw(scans: DataFrame) -> DataFrame:
    """Scaling of the dataset group, stamp falling back to the global date and time, approximate extent as fallback."""
    g = F.col("what_dataset")
    extent = A.corner_extent(F.col("where_attrs"), A.extent_lit(SCAN_FALLBACK_EXTENTS["imgw"]))
    product = F.coalesce(A.attr(g, "product"), F.lit("MAX"))
    quantity = F.coalesce(A.attr(g, "quantity"), F.lit("DBZH"))
    return _standard("imgw", scans, g, extent, T.stamp_from_attrs(g, F.col("what_global")), product, quantity)


def read_omsz(scans: DataFrame) -> DataFrame:
    """Signed bytes read as unsigned, fixed scaling, geometry from the first point and the steps."""
    w = F.col("where_attrs")
    extent = A.step_extent(A.number(w, "La1"), A.number(w, "Lo1"), A.number(w, "Dx"), A.number(w, "Dy"), F.col("height"), F.col("width"))
    path = F.col("path")
    product = F.when(path.contains("refl2D_pscappi"), "refl2D_pscappi").when(path.contains("refl3D"), "refl3D").otherwise("refl2D")
    unsigned = scans.withColumn("raw", F.transform("raw", A.unsigned))
    ts14 = T.normalize_timestamp(F.col("ts_raw"), 14)
    return _standard("omsz", unsigned, F.create_map().cast("map<string,string>"), extent, ts14, product, F.lit("DBZH"))


def read_arso(scans: DataFrame) -> DataFrame:
    """Text-grid files, landed by ``srd.landed``: scaling and units of the header, extent of the cone's cells."""
    read = _standard("arso", scans, F.col("what_data"), srd.extent(F.col("width"), F.col("height")), F.col("ts_raw"), F.col("product"), A.attr(F.col("what_data"), "quantity"))
    return read.withColumn("units", A.attr(F.col("what_data"), "units"))


def _or_unknown(attrs: Column, name: str) -> Column:
    return F.coalesce(A.attr(attrs, name), F.lit("UNKNOWN"))


# a new source is one entry here and one row in each dimension
READERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dwd": read_dwd,
    "shmu": read_shmu,
    "chmi": read_chmi,
    "omsz": read_omsz,
    "imgw": read_imgw,
    "arso": read_arso,
}
# services whose files land as they are, and how a folder of them becomes landed scans
TEXT_LANDING = {"arso": srd.landed}


def read_scans(
    spark: SparkSession, path: str, source: str, start: Column | None = None, end: Column | None = None, products: list[str] | None = None
) -> DataFrame:
    """Scans of one source in an inclusive period, of the named products; days outside are not opened.

    For a service of ``TEXT_LANDING`` the path is that of its files; source, days and products reach their listing."""
    if source in TEXT_LANDING:  # the filters become literals: a data source is handed nothing else
        files = text_grids.read(spark, path).where(F.col("source") == source)
        if start is not None and end is not None:
            first, last = spark.range(1).select(*(F.date_format(c, "yyyy-MM-dd") for c in (start, end))).first()
            files = files.where(F.col("date").between(first, last))
        if products is not None:
            files = files.where(F.col("product").isin(products))
        landed = TEXT_LANDING[source](files)
    else:
        landed = read_landed(spark, path, source, start, end)
    scans = READERS[source](landed)
    if start is not None and end is not None:
        scans = scans.where(F.col("ts").between(start, end))
    return scans if products is None else scans.where(F.col("product").isin(products))


def read_all(landed: DataFrame, columns: list[str], sources: list[str] | None = None) -> DataFrame:
    """``columns`` of the standard scans of all services, or the named ones, each by its reader, from one landed table."""
    parts = [reader(landed.where(F.col("source") == name)).select(columns) for name, reader in READERS.items() if sources is None or name in sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def decodable(scans: DataFrame) -> DataFrame:
    """``scans`` with ``ok``: does any raw value, of the scan or of the strip, decode to a value? Nothing is unfolded."""
    s = F.col("scaling")
    value = lambda r: A.decode(r, s["gain"], s["offset"], s["nodata"], s["undetect"], s["byte_rule"] & F.col("is_u8"))
    return scans.withColumn("ok", F.coalesce(F.exists("raw", lambda r: value(r).isNotNull()), F.lit(False)))


def metadata(scans: DataFrame) -> DataFrame:
    """Extent and dimensions only; the pixel column is never read."""
    return scans.select("source", "product", "ts", "ts14", "extent", "height", "width", "proj_def")


def cells(scans: DataFrame, carry: list[str] = ("source", "ts")) -> DataFrame:
    """Valid cells of the scans: (carry, row, col, dbz). Missing values are dropped, not kept as null."""
    raw = scans.select(*carry, "width", "scaling", "is_u8", F.posexplode("raw").alias("_pos", "raw"))
    s = F.col("scaling")
    value = A.decode(F.col("raw"), s["gain"], s["offset"], s["nodata"], s["undetect"], s["byte_rule"] & F.col("is_u8"))
    return raw.select(
        *carry, F.floor(F.col("_pos") / F.col("width")).cast("int").alias("row"), (F.col("_pos") % F.col("width")).alias("col"), value.alias("dbz")
    ).where("dbz is not null")

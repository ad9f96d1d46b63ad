"""Text-grid scans: ``key values # comment`` header, a DATA line, one character per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dimensions import SRD_CELLS, SRD_OFFSET, SRD_PROJECTION, SRD_REFERENCE_CELL, SRD_SLOPE, SRD_START
from ..functions.attrs import decode_level, srd_units, typed
from ..functions.proj import Projection, to_lonlat
from ..functions.timefn import srd_stamp


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of text-grid files; one byte is one character."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.decode("content", "ISO-8859-1").alias("content"))


def header_entries(content: Column) -> Column:
    """Header as array of (key, values); lines up to DATA, comments cut, empty lines left out."""
    head = F.regexp_replace(content, r"(?s)(^|\r?\n)\s*DATA\s*\r?\n.*$", "")
    words = F.transform(F.split(head, "\n"), lambda line: F.split(F.trim(F.regexp_replace(line, r"#.*|[\r\t]", " ")), r" +"))
    filled = F.filter(words, lambda w: w[0] != "")
    return F.transform(filled, lambda w: F.struct(w[0].alias("key"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("values")))


def header_values(entries: Column, key: str) -> Column:
    """Values of a header key; the last line wins, null when it is absent."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["values"])


def header_table(files: DataFrame) -> DataFrame:
    """One row per header value with its type: (path, key, position, text, as_int, as_double, kind)."""
    rows = files.select("path", F.inline(header_entries(F.col("content"))))
    values = rows.select("path", "key", F.posexplode_outer("values").alias("position", "text"))
    return values.select("path", "key", "position", "text", typed(F.col("text")).alias("_t")).select("path", "key", "position", "text", "_t.*")


def scans(files: DataFrame, carry: list[str] = ()) -> DataFrame:
    """(carry, path, ts14, product, quantity, units, domain, width, height, offset, start, slope, body).

    The body loses control characters and is cut, or padded with the no-data character, to the grid's size.
    """
    h = F.col("_header")
    first = lambda key: F.try_element_at(header_values(h, key), F.lit(1))
    size = lambda i: F.coalesce(F.try_element_at(header_values(h, "ncell"), F.lit(i + 1)).try_cast("int"), F.lit(SRD_CELLS[i]))
    two = F.coalesce(F.size(header_values(h, "ncell")) >= 2, F.lit(False))
    unit = F.coalesce(first("unit"), F.lit("DBZ"))
    body = F.regexp_replace(F.regexp_extract("content", r"(?s)\n\s*DATA\s*?\r?\n(.*)$", 1), r"[\x00-\x1f]", "")
    # a header is parsed once: a generated column is not worked out again in each of its uses
    headed = files.select(*carry, "path", "content", F.explode(F.array(header_entries(F.col("content")))).alias("_header"))
    fields = F.struct(
        srd_stamp(header_values(h, "time")).alias("ts14"),
        F.when(F.lower("path").contains("zm"), "ZM").otherwise("RRG").alias("product"),
        F.when(unit == "DBZ", "DBZH").otherwise("RATE").alias("quantity"),
        srd_units(unit).alias("units"),
        F.coalesce(first("domain"), F.lit("SI0")).alias("domain"),
        F.when(two, size(0)).otherwise(F.lit(SRD_CELLS[0])).alias("width"),
        F.when(two, size(1)).otherwise(F.lit(SRD_CELLS[1])).alias("height"),
        F.coalesce(first("offset").try_cast("int"), F.lit(SRD_OFFSET)).alias("offset"),
        F.coalesce(first("start").try_cast("double"), F.lit(SRD_START)).alias("start"),
        F.coalesce(first("slope").try_cast("double"), F.lit(SRD_SLOPE)).alias("slope"),
        body.alias("body"),
    )
    parsed = headed.select(*carry, "path", F.inline(F.array(fields)))
    return parsed.withColumn("body", F.rpad("body", F.col("width") * F.col("height"), F.char("offset")))


def cells(scans: DataFrame, carry: list[str] = ("path", "ts14")) -> DataFrame:
    """Valid cells of text-grid scans: (carry, row, col, level, dbz)."""
    chars = scans.select(*carry, "width", "offset", "start", "slope", F.posexplode(F.split("body", "")).alias("_pos", "_char"))
    level = F.ascii("_char")
    return chars.select(
        *carry,
        F.floor(F.col("_pos") / F.col("width")).cast("int").alias("row"),
        (F.col("_pos") % F.col("width")).alias("col"),
        level.alias("level"),
        decode_level(level, F.col("offset"), F.col("start"), F.col("slope")).alias("dbz"),
    ).where("dbz is not null")


def cell_lonlat(row: Column, col: Column) -> tuple[Column, Column]:
    """Lon/lat of a text-grid cell: kilometres from the reference cell, then the inverse cone."""
    i, j = SRD_REFERENCE_CELL
    return to_lonlat(Projection.of(SRD_PROJECTION), (col + 1 - i).cast("double"), (F.lit(j) - (row + 1)).cast("double"))


def extent(width: Column, height: Column) -> Column:
    """Outline of the cell centres of a grid of any size. On a cone north of its parallel, west and east lie in the top
    corners, south in a bottom corner, north on the top line where it meets the central meridian."""
    lonlat = lambda row, col: cell_lonlat(row, col)
    zero, last = F.lit(0), width - 1
    middle = F.greatest(zero, F.least(last, F.lit(SRD_REFERENCE_CELL[0] - 1)))
    bottom = [lonlat(height - 1, c)[1] for c in (zero, last)]
    return F.struct(
        lonlat(zero, zero)[0].alias("west"),
        lonlat(zero, last)[0].alias("east"),
        F.least(*bottom).alias("south"),
        lonlat(zero, middle)[1].alias("north"),
    )


def landed(files: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Text-grid files ``(path, content, *carry)`` as landed raw scans, like those of the other services.

    ``raw`` counts the steps above the file's no-data character, which is 0; the header's start and slope are offset and gain.
    """
    s = scans(files, carry)
    text = lambda c: F.col(c).cast("string")
    zero = F.lit("0")
    what = F.create_map(*(x for k, v in (("gain", text("slope")), ("offset", text("start")), ("nodata", zero), ("undetect", zero), ("quantity", F.col("quantity")), ("units", F.col("units"))) for x in (F.lit(k), v)))
    none = F.create_map().cast("map<string,string>")
    return s.select(
        *carry,
        F.lit("arso").alias("source"),
        "product",
        F.col("ts14").alias("ts_raw"),
        "path",
        "height",
        "width",
        F.lit(True).alias("is_u8"),
        F.transform(F.split("body", ""), lambda c: F.ascii(c) - F.col("offset")).alias("raw"),
        what.alias("what_data"),
        none.alias("what_dataset"),
        F.create_map(F.lit("domain"), F.col("domain")).alias("what_global"),
        F.create_map(F.lit("projdef"), F.lit(SRD_PROJECTION)).alias("where_attrs"),
        F.date_format(F.to_timestamp("ts14", "yyyyMMddHHmmss"), "yyyy-MM-dd").alias("date"),
    )


def grid_extent(spark: SparkSession) -> DataFrame:
    """Extent of the default grid: the cone makes its edges curves, so all cells count. One row."""
    width, height = SRD_CELLS
    cells = spark.range(width * height).select(F.floor(F.col("id") / width).alias("row"), (F.col("id") % width).alias("col"))
    lon, lat = cell_lonlat(F.col("row"), F.col("col"))
    return cells.select(lon.alias("lon"), lat.alias("lat")).agg(
        F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north")
    )

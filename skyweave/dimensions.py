"""Source registry, product lists, decode defaults, thresholds, colour anchors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
# source: (default product, country, folder, core source, native metres, provider delay minutes, zone shift hours)
SOURCES = {
    "dwd": ("dmax", "germany", "germany", True, 1000.0, 15, 1),
    "shmu": ("zmax", "slovakia", "slovakia", True, 450.0, 0, 0),
    "chmi": ("maxz", "czechia", "czechia", True, 1550.0, 0, 0),
    "omsz": ("cmax", "hungary", "hungary", True, 900.0, 5, 0),
    "arso": ("zm", "slovenia", "slovenia", False, 1000.0, 0, 0),
    "imgw": ("cmax", "poland", "poland", True, 1500.0, 10, 0),
}
SOURCE_NAMES = list(SOURCES)
DESCRIPTIONS = {
    "dwd": "German Weather Service (DWD)",
    "shmu": "Slovak Hydrometeorological Institute (SHMU)",
    "chmi": "Czech Hydrometeorological Institute (CHMI)",
    "omsz": "Hungarian Meteorological Service (OMSZ)",
    "arso": "Slovenian Environment Agency (ARSO)",
    "imgw": "Polish Institute of Meteorology and Water Management (IMGW)",
}
CORE_SOURCES = [name for name, row in SOURCES.items() if row[3]]
LATEST_ONLY_SOURCE = "arso"  # keeps no archive at the provider

# (source, product, name, units, description)
PRODUCTS = [
    ("dwd", "dmax", "Maximum Reflectivity", "dBZ", "Column maximum reflectivity"),
    ("dwd", "pg", "PG Composite", "unknown", "DWD composite product PG"),
    ("dwd", "hg", "HG Composite", "unknown", "DWD composite product HG"),
    ("dwd", "hx", "HX Composite", "unknown", "DWD composite product HX"),
    ("shmu", "zmax", "Maximum Reflectivity (ZMAX)", "dBZ", "Column maximum reflectivity"),
    ("shmu", "cappi2km", "CAPPI 2km", "dBZ", "Reflectivity at 2km altitude"),
    ("shmu", "etop", "Echo Top Height", "km", "Echo top height"),
    ("shmu", "pac01", "1h Precipitation", "mm", "1-hour accumulated precipitation"),
    ("chmi", "maxz", "Maximum Reflectivity (MAXZ)", "dBZ", "Column maximum reflectivity"),
    ("omsz", "cmax", "Column Maximum (CMax)", "dBZ", "Column maximum reflectivity (ZMAX equivalent)"),
    ("omsz", "pscappi", "PseudoCAPPI", "dBZ", "Pseudo-CAPPI ground-level precipitation estimate"),
    ("omsz", "refl3d", "3D Composite", "dBZ", "3D radar composite volume"),
    ("arso", "zm", "Maximum Reflectivity (ZM)", "dBZ", "Column maximum reflectivity"),
    ("arso", "rrg", "Ground Rain Rate (RRG)", "dBR/h", "Precipitation intensity at ground level"),
    ("imgw", "cmax", "Composite Maximum Reflectivity (CMAX)", "dBZ", "Column maximum reflectivity composite"),
]

# source: (gain, offset, nodata, undetect, unsigned-byte 255 is no data)
DECODE_DEFAULTS = {
    "dwd": (1.0, 0.0, 65535, 0, False),
    "shmu": (1.0, 0.0, -32768, 0, True),
    "chmi": (1.0, 0.0, -32768, 0, True),
    "omsz": (0.5, -32.0, 255, 0, True),
    "arso": (1.0, 0.0, 65535, 0, False),
    "imgw": (0.5, -32.0, 255, 0, True),
}

# source: (west, east, south, north) of the pixel-centre outline
SOURCE_EXTENTS = {
    "dwd": (1.461077, 18.732899, 45.683144, 56.220458),
    "shmu": (13.597751, 23.806870, 46.045447, 50.701424),
    "chmi": (11.266869, 19.623974, 48.047275, 51.458369),
    "omsz": (13.5, 25.507733, 43.993974, 50.5),
    "imgw": (11.804019, 26.376516, 48.124377, 56.398335),
}
# used when a scan of these two carries no corners
SCAN_FALLBACK_EXTENTS = {
    "chmi": (11.266869, 19.623974, 48.047275, 51.458369),
    "imgw": (13.0, 26.4, 48.1, 56.2),
}
# corner defaults of the stereographic source: name -> (lon, lat)
STEREO_CORNERS = {"UL": (1.46, 55.86), "UR": (18.73, 55.85), "LL": (3.57, 45.70), "LR": (16.58, 45.68)}
REFERENCE_EXTENT = (1.461077, 26.376516, 44.001479, 56.398335)

COMPOSITE_RESOLUTION_M = 500.0
NATIVE_METRES = {**{name: row[4] for name, row in SOURCES.items()}, "composite": COMPOSITE_RESOLUTION_M}
METRES_PER_DEGREE = 111320.0

MIN_CORE_SOURCES = 3
MAX_AGE_MINUTES = 30
REPROCESS_COUNT = 6
TOLERANCE_MINUTES = 2
SLOT_MINUTES = 5
BACKLOAD_CAP = 100
GAP_MINUTES = 10
SLOTS_PER_HOUR = 12
STREAK_THRESHOLD = 3
STORE_TTL_MINUTES = 60
RETENTION_HOURS = 6
MAX_GRID_DIMENSION = 10000
MAP_VERSION = "v1"

RADAR_CENTRES = {"shmu": (19.15, 48.55), "dwd": (10.0, 51.5)}
MERGE_CLIP = (-32.0, 80.0)
REGRID_CLIP = (-35.0, 85.0)
OUTLIER_STD = 15.0
ISOLATION_MIN = 3
RENDER_MIN_DBZ = 10.0
LUT_RANGE = (-35.0, 85.0)
UNCOVERED_RGBA = (128, 128, 128, 255)

QUANTITY_UNITS = {
    "DBZH": "dBZ",
    "DBZ": "dBZ",
    "TH": "dBZ",
    "TV": "dBZ",
    "HGHT": "km",
    "ACRR": "mm",
    "RATE": "mm/h",
    "VRAD": "m/s",
    "WRAD": "m/s",
    "RHOHV": "ratio",
    "ZDR": "dB",
    "KDP": "deg/km",
    "PHIDP": "deg",
}

# text-grid scans
SRD_CELLS = (401, 301)
SRD_OFFSET, SRD_START, SRD_SLOPE = 64, 12.0, 3.0
SRD_REFERENCE_CELL = (205, 145)
SRD_PROJECTION = "+proj=lcc +lat_1=46.12 +lat_2=46.12 +lat_0=46.12 +lon_0=14.815 +x_0=0 +y_0=0 +R=6371000 +units=km +no_defs"
SRD_UNITS = {"DBZ": "dBZ", "DBRH": "dBR/h", "MM": "mm"}

# reflectivity in steps of 5 from -35 to 85 dBZ -> (r, g, b)
COLOUR_ANCHORS = [
    (-35, 0, 0, 0),
    (-30, 115, 126, 139),
    (-25, 105, 117, 130),
    (-20, 172, 196, 212),
    (-15, 140, 172, 200),
    (-10, 96, 140, 188),
    (-5, 52, 108, 180),
    (0, 12, 76, 168),
    (5, 0, 100, 144),
    (10, 0, 140, 108),
    (15, 0, 180, 64),
    (20, 0, 232, 12),
    (25, 84, 240, 0),
    (30, 208, 228, 0),
    (35, 252, 204, 0),
    (40, 252, 168, 0),
    (45, 252, 100, 0),
    (50, 248, 20, 0),
    (55, 216, 8, 0),
    (60, 152, 16, 0),
    (65, 164, 40, 96),
    (70, 204, 72, 200),
    (75, 244, 108, 244),
    (80, 252, 140, 252),
    (85, 252, 172, 252),
]
# --- end of fixed values ------------------------------------------------------------------------


def by_source(source: Column, values: dict[str, object], default: object = None) -> Column:
    """Look a per-source constant up inside the projection: no join, no broadcast."""
    otherwise = F.lit(default)
    cases = [(name, value) for name, value in values.items() if value is not None]
    expr = reduce(lambda acc, kv: acc.when(source == kv[0], F.lit(kv[1])), cases[1:], F.when(source == cases[0][0], F.lit(cases[0][1])))
    return expr.otherwise(otherwise)


def source_table(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """The source registry as a table: source, product, country, folder, is_core, native_m, priority."""
    rows = [
        (n, *SOURCES[n][:5], SOURCE_NAMES.index(n), DESCRIPTIONS[n]) for n in (names or SOURCE_NAMES) if n in SOURCES
    ]
    return spark.createDataFrame(
        rows,
        "source string, product string, country string, folder string, is_core boolean, native_m double, "
        "priority int, description string",
    )


def product_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PRODUCTS, "source string, product string, name string, units string, description string")

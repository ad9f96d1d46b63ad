"""Scans, listings, catalogs, stores, sinks and landing rules."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import views
from ..dimensions import MERGE_CLIP, REGRID_CLIP, SOURCE_NAMES
from ..functions import attrs as A
from ..functions import proj as P
from ..functions import timefn as T
from ..operators import coverage, mosaic, published, quarantine
from ..sources import catalog as C
from ..session import shared_folder
from ..sources import extents, listing, registry, scans, sinks, srd, store, store_files, text_grids
from . import ctes
from .registry import minute_text, query, r6

FMT = "%Y%m%d%H%M"
SLOT_TS = "(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(slot * 5 AS INT)))"
BOUNDS = ("west", "east", "south", "north")

LANDED = f"""{ctes.RAW}, landed AS (SELECT *, {SLOT_TS} AS ts, vec_id % 4 <> 0 AS has, vec_id % 5 <> 0 AS cor, 10 + 0.5::DOUBLE * source_id + (slot % 10) * 0.001::DOUBLE AS w FROM raw_cells),
scaled AS (SELECT *, CASE WHEN source = 'imgw' OR source = 'omsz' OR has THEN 0.5::DOUBLE ELSE 1 END AS gain, CASE WHEN source = 'imgw' OR source = 'omsz' OR has THEN -32.0::DOUBLE ELSE 0 END AS off,
  CASE WHEN source = 'imgw' OR source = 'omsz' OR has THEN 255 WHEN source IN ('shmu','chmi') THEN -32768 ELSE 65535 END AS nodata FROM landed),
dec AS (SELECT *, CASE WHEN source = 'arso' THEN CASE WHEN raw // 8 > 0 AND (vec_id % 7 <> 0 OR "row" * 8 + col < 39) THEN 12 + 3.0::DOUBLE * (raw // 8) END
  WHEN raw <> 0 AND raw <> nodata AND NOT (source IN ('shmu','chmi','imgw','omsz') AND raw = 255) THEN raw * gain + off END AS dbz FROM scaled)"""


def scan_sql(source: str, product: str, quantity: str, units: str, bounds: str, quantity_if: str | None = None) -> str:
    quantity, units = (f"CASE WHEN {quantity_if} THEN '{quantity}' ELSE 'UNKNOWN' END", f"CASE WHEN {quantity_if} THEN '{units}' ELSE 'unknown' END") if quantity_if else (f"'{quantity}'", f"'{units}'")
    return f"""WITH {LANDED}, x AS (SELECT *, {bounds} FROM dec WHERE source = '{source}')
SELECT vec_id AS scan_id, strftime(ts,'%Y%m%d%H%M') AS ts12, '{product}' AS product, {quantity} AS quantity, {units} AS units,
 round(any_value(west), 6) AS west, round(any_value(east), 6) AS east, round(any_value(south), 6) AS south, round(any_value(north), 6) AS north,
 count(dbz) AS valid, round(sum(dbz), 3) AS total FROM x GROUP BY vec_id, ts, has"""


def scan_query(spark, sf_dir, source: str):
    """One service's scans through its reader: stamp, product, extent, and the decoded cells summed up."""
    read = scans.READERS[source](views.landed(spark, sf_dir).where(F.col("source") == source))
    head = read.select("scan_id", F.substring("ts14", 1, 12).alias("ts12"), "product", "quantity", "units", "extent.*")
    body = scans.cells(read, ["scan_id"]).groupBy("scan_id").agg(
        F.count("dbz").alias("valid"), F.round(F.sum(F.col("dbz").cast("double")), 3).alias("total")
    )
    return head.join(body, "scan_id", "left").select(
        "scan_id", "ts12", "product", "quantity", "units", *(r6(b).alias(b) for b in BOUNDS), F.coalesce("valid", F.lit(0)).alias("valid"), "total"
    )


CORNERS = "CASE WHEN cor THEN w{0} END AS west, CASE WHEN cor THEN w + 4{0} END AS east, CASE WHEN cor THEN 44.0::DOUBLE END AS south, CASE WHEN cor THEN 49.0::DOUBLE END AS north"
WITH_FALLBACK = "CASE WHEN cor THEN w ELSE {0} END AS west, CASE WHEN cor THEN w + 4 ELSE {1} END AS east, CASE WHEN cor THEN 44.0::DOUBLE ELSE {2} END AS south, CASE WHEN cor THEN 49.0::DOUBLE ELSE {3} END AS north"


@query("s2_dwd_scan", scan_sql("dwd", "dmax", "DBZH", "dBZ", "CASE WHEN cor THEN w - 0.1 ELSE 1.46 END AS west, CASE WHEN cor THEN w + 4.1 ELSE 18.73 END AS east, CASE WHEN cor THEN 44.0::DOUBLE ELSE 45.68 END AS south, CASE WHEN cor THEN 49.0::DOUBLE ELSE 55.86 END AS north"))
def s2_dwd_scan(spark, sf_dir):
    return scan_query(spark, sf_dir, "dwd")


@query("s3_shmu_scan", scan_sql("shmu", "UNKNOWN", "DBZH", "dBZ", CORNERS.format(""), "has"))
def s3_shmu_scan(spark, sf_dir):
    return scan_query(spark, sf_dir, "shmu")


@query("s4_chmi_scan", scan_sql("chmi", "UNKNOWN", "DBZH", "dBZ", WITH_FALLBACK.format(11.266869, 19.623974, 48.047275, 51.458369), "has"))
def s4_chmi_scan(spark, sf_dir):
    return scan_query(spark, sf_dir, "chmi")


@query("s5_omsz_scan", scan_sql("omsz", "refl2D_pscappi", "DBZH", "dBZ", "w AS west, w + 3.5 AS east, 49 - 1.75::DOUBLE AS south, 49.0::DOUBLE AS north"))
def s5_omsz_scan(spark, sf_dir):
    return scan_query(spark, sf_dir, "omsz")


@query("s6_imgw_scan", scan_sql("imgw", "MAX", "DBZH", "dBZ", WITH_FALLBACK.format(13.0, 26.4, 48.1, 56.2)))
def s6_imgw_scan(spark, sf_dir):
    return scan_query(spark, sf_dir, "imgw")


@query(
    "s1_landed_scans",
    f"""WITH {LANDED} SELECT source, CAST(slot AS INT) AS slot, count(dbz) AS valid, round(min(dbz), 6) AS min_dbz, round(max(dbz), 6) AS max_dbz
 FROM dec WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:30:00' AND TIMESTAMP '2024-01-01 06:00:00' GROUP BY ALL HAVING count(dbz) > 0""",
)
def s1_landed_scans(spark, sf_dir):
    """All six services over one period, as one table of cells; one of them lands as text-grid files."""
    start, end = F.to_timestamp(F.lit("2024-01-01 00:30:00")), F.to_timestamp(F.lit("2024-01-01 06:00:00"))
    read = scans.read_all(views.landed_six(spark, sf_dir), ["source", "slot", "ts", "width", "scaling", "is_u8", "raw"])
    value = F.col("dbz").cast("double")
    every = scans.cells(read.where(F.col("ts").between(start, end)), ["source", "slot"])
    return every.groupBy("source", "slot").agg(F.count("dbz").alias("valid"), r6(F.min(value)).alias("min_dbz"), r6(F.max(value)).alias("max_dbz"))


SRD = f"""{ctes.RAW}, byte AS (SELECT vec_id, slot, "row" * 8 + col AS pos, "row", col, raw // 8 AS level FROM raw_cells),
srd AS (SELECT *, 12 + 3.0::DOUBLE * level AS dbz FROM byte WHERE level > 0 AND (vec_id % 7 <> 0 OR pos < 39))"""


@query(
    "s7_srd_text",
    f"""WITH {SRD} SELECT 'si0-zm-' || vec_id || '.srd' AS path, strftime({SLOT_TS},'%Y%m%d%H%M%S') AS ts14, CAST("row" AS INT) AS "row", CAST(col AS INT) AS col, round(dbz, 6) AS dbz FROM srd""",
)
def s7_srd_text(spark, sf_dir):
    cells = srd.cells(srd.scans(views.srd_text(spark, sf_dir)))
    return cells.select("path", "ts14", "row", "col", r6(F.col("dbz").cast("double")).alias("dbz"))


@query(
    "s1_text_grid_files",
    f"""WITH {SRD} SELECT 'si0-zm-' || vec_id || '.srd' AS name, strftime({SLOT_TS},'%Y%m%d%H%M%S') AS ts14, count(*) AS valid, round(sum(dbz), 3) AS total FROM srd
 WHERE {SLOT_TS} BETWEEN TIMESTAMP '2024-01-01 02:30:00' AND TIMESTAMP '2024-01-02 06:00:00' GROUP BY ALL""",
)
def s1_text_grid_files(spark, sf_dir):
    """Every text-grid scan written as a file in its day's folder, and those of a period read back by their data source."""
    folder = f"{shared_folder(spark)}/text-grids-{uuid.uuid4().hex}"
    files = views.srd_text(spark, sf_dir)
    stamp = srd.srd_stamp(srd.header_values(srd.header_entries(F.col("content")), "time"))
    text_grids.write(files.withColumn("date", F.date_format(F.to_timestamp(stamp, "yyyyMMddHHmmss"), "yyyy-MM-dd")), folder)
    start, end = (F.to_timestamp(F.lit(t)) for t in ("2024-01-01 02:30:00", "2024-01-02 06:00:00"))
    read = scans.read_scans(spark, folder, "arso", start, end, ["ZM"]).withColumn("name", F.element_at(F.split("path", "/"), -1))
    cells = scans.cells(read, ["name", "ts14"])
    return cells.groupBy("name", "ts14").agg(F.count("dbz").alias("valid"), F.round(F.sum(F.col("dbz").cast("double")), 3).alias("total"))


@query(
    "s7_srd_headers",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot FROM embeddings) SELECT 'si0-zm-' || vec_id || '.srd' AS path, 'ZM' AS product, 'DBZH' AS quantity, 'dBZ' AS units,
 'SI' || vec_id % 3 AS domain, 8 AS width, 8 AS height, 64 AS "offset", 12.0::DOUBLE AS start, 3.0::DOUBLE AS slope, 64 AS cells FROM v""",
)
def s7_srd_headers(spark, sf_dir):
    """Scan-level fields; every body has exactly the grid's size, whatever was in the file."""
    return srd.scans(views.srd_text(spark, sf_dir)).withColumn("cells", F.length("body")).drop("ts14", "body")


@query(
    "p4_text_levels",
    f"""WITH {SRD} SELECT CAST(level AS INT) AS level, count(*) AS cells, round(min(dbz), 6) AS dbz FROM srd GROUP BY level""",
)
def p4_text_levels(spark, sf_dir):
    cells = srd.cells(srd.scans(views.srd_text(spark, sf_dir)))
    return cells.groupBy((F.col("level") - 64).alias("level")).agg(
        F.count(F.lit(1)).alias("cells"), r6(F.min("dbz").cast("double")).alias("dbz")
    )


@query(
    "p5_header_typing",
    """WITH v AS (SELECT count(*) AS n, count(DISTINCT vec_id // 6) AS slots FROM embeddings) SELECT key, kind, n * per AS values FROM v,
 (VALUES ('ncell','int',2),('time','int',5),('offset','int',1),('start','double',1),('slope','double',1),('unit','string',1),('domain','string',1)) t(key, kind, per)""",
)
def p5_header_typing(spark, sf_dir):
    table = srd.header_table(views.srd_text(spark, sf_dir)).where("text is not null")
    return table.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("values"))


@query(
    "f8_srd_stamp",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot FROM embeddings) SELECT 'si0-zm-' || vec_id || '.srd' AS path, strftime({SLOT_TS},'%Y%m%d%H%M%S') AS ts14 FROM v""",
)
def f8_srd_stamp(spark, sf_dir):
    header = srd.header_entries(F.col("content"))
    return views.srd_text(spark, sf_dir).select("path", T.srd_stamp(srd.header_values(header, "time")).alias("ts14"))


@query(
    "s8_metadata_only",
    f"""WITH {LANDED} SELECT DISTINCT vec_id AS scan_id, 8 AS height, 8 AS width, round(w, 6) AS west, round(w + 3.5, 6) AS east, 47.25::DOUBLE AS south, 49.0::DOUBLE AS north FROM landed WHERE source = 'omsz'""",
)
def s8_metadata_only(spark, sf_dir):
    read = scans.read_omsz(views.landed(spark, sf_dir).where("source = 'omsz'"))
    # scans.metadata keeps the contract's columns; the id is carried along here to compare row by row
    return read.select("scan_id", "height", "width", "extent.*").select("scan_id", "height", "width", *(r6(b).alias(b) for b in BOUNDS))


def pages(spark, sf_dir):
    """Directory pages, one a day (a day has at most 1440 stamps of a service)."""
    dwd = views.scan_catalog(spark, sf_dir).where("source = 'dwd'")
    line = F.concat(F.lit('<a href="composite_dmax_'), F.col("ts_raw"), F.lit('-hd5">composite_dmax_'), F.col("ts_raw"), F.lit("-hd5</a>"))
    return dwd.groupBy(F.to_date("ts").alias("day")).agg(F.array_join(F.collect_list(line), "\n").alias("text"))


@query("s10_listing_pages", f"WITH {ctes.CATALOG} SELECT DISTINCT ts_raw FROM catalog WHERE source = 'dwd'")
def s10_listing_pages(spark, sf_dir):
    return listing.stamps_in_page(pages(spark, sf_dir), "dmax")


@query(
    "s11_listing_json",
    f"""WITH {ctes.CATALOG} SELECT strftime(ts,'%Y%m%d%H%M%S') || '00dBZ.cmax.h5' AS file, strftime(ts,'%Y%m%d%H%M%S') AS ts14 FROM catalog WHERE source = 'imgw'""",
)
def s11_listing_json(spark, sf_dir):
    imgw = views.scan_catalog(spark, sf_dir).where("source = 'imgw'")
    stem = F.concat(T.stamp(F.col("ts")), F.lit("00dBZ.cmax."))
    files = F.array(F.struct(F.concat(stem, F.lit("h5")).alias("file")), F.struct(F.concat(stem, F.lit("png")).alias("file")))
    days = imgw.groupBy(F.to_date("ts").alias("day")).agg(F.to_json(F.flatten(F.collect_list(files))).alias("text"))
    return listing.stamps_in_json(days)


@query(
    "s13_registry",
    f"""WITH {ctes.STAMPED}, s AS (SELECT CASE WHEN event_id % 10 = 0 THEN 'XYZ' ELSE upper(source) END AS source FROM stamped), r(key, country, product) AS (VALUES
 ('dwd','germany','dmax'),('shmu','slovakia','zmax'),('chmi','czechia','maxz'),('omsz','hungary','cmax'),('arso','slovenia','zm'),('imgw','poland','cmax'))
SELECT source, country, product AS default_product, coalesce(country, lower(source)) AS folder, count(*) AS scans FROM s LEFT JOIN r ON lower(source) = key GROUP BY ALL""",
)
def s13_registry(spark, sf_dir):
    source = F.when(F.col("event_id") % 10 == 0, "XYZ").otherwise(F.upper("source"))
    counts = views.stamped_events(spark, sf_dir).groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("scans"))
    return registry.with_source(counts).select("source", "country", "default_product", "folder", "scans")


@query(
    "s14_products",
    f"""WITH {ctes.STAMPED}, s AS (SELECT source, list_extract(['dmax','zmax','cmax','etop','zm'], CAST(user_id % 5 AS INT) + 1) AS product, count(*) AS scans FROM stamped GROUP BY ALL),
p(source, product, units) AS (VALUES ('dwd','dmax','dBZ'),('shmu','zmax','dBZ'),('shmu','etop','km'),('omsz','cmax','dBZ'),('imgw','cmax','dBZ'),('arso','zm','dBZ'))
SELECT s.source, s.product, scans, coalesce(units, 'unknown') AS units, units IS NULL AS unlisted FROM s LEFT JOIN p USING (source, product)""",
)
def s14_products(spark, sf_dir):
    product = F.element_at(F.array(*(F.lit(p) for p in ("dmax", "zmax", "cmax", "etop", "zm"))), (F.col("user_id") % 5 + 1).cast("int"))
    counts = views.stamped_events(spark, sf_dir).groupBy("source", product.alias("product")).agg(F.count(F.lit(1)).alias("scans"))
    full = registry.with_product(counts)
    return full.select("source", "product", "scans", "units", F.startswith("description", F.lit("No desc")).alias("unlisted"))


def fetch_results(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir).withColumn("product", F.lit("zmax")).withColumn("timestamp", T.stamp(F.col("ts")))
    ok = F.col("event_type") != "error"
    where = F.concat(F.lit("/landing/"), F.col("source"), F.lit("/"), F.col("ts_raw"))
    return C.result_rows(rows, ok, where, F.concat(F.lit("https://example.org"), where), F.col("event_type") == "view", F.lit("timed out"))


@query(
    "s15_catalog_results",
    f"""WITH {ctes.STAMPED} SELECT source, 'zmax' AS product, count(*) AS total, CAST(count_if(event_type <> 'error') AS BIGINT) AS fetched,
 CAST(count_if(event_type = 'view') AS BIGINT) AS from_cache, CAST(count_if(event_type = 'error') AS BIGINT) AS failed FROM stamped GROUP BY source""",
)
def s15_catalog_results(spark, sf_dir):
    return C.fetch_counts(fetch_results(spark, sf_dir))


STORE_NOW, STORE_TTL = "2024-01-30 12:00:00", 14400
STORE = ctes.STAMPED + """, hourly AS (SELECT source, CASE WHEN user_id % 2 = 0 THEN 'zmax' ELSE 'etop' END AS product,
  strftime(date_trunc('hour', instant),'%Y%m%d%H%M%S') AS timestamp, instant, event_id % 500 * 1000 + 1000 AS bytes, event_type FROM stamped),
store AS (SELECT source, product, timestamp, max(instant) AS cached_at, CAST(sum(bytes) AS BIGINT) AS bytes FROM hourly WHERE event_type IN ('view','click') GROUP BY ALL),
incoming AS (SELECT source, product, timestamp, CAST(sum(bytes) AS BIGINT) AS bytes FROM hourly WHERE event_type = 'purchase' GROUP BY ALL),
live AS (SELECT * FROM store WHERE floor(epoch(TIMESTAMP '2024-01-30 12:00:00')) - floor(epoch(cached_at)) <= 864000)"""


def store_now() -> Column:
    return F.to_timestamp(F.lit(STORE_NOW))


@query(
    "s16_store_upsert",
    f"""WITH {STORE}, taken AS (SELECT i.* FROM incoming i ANTI JOIN live l USING (source, product, timestamp))
SELECT source, product, timestamp, bytes FROM taken UNION ALL SELECT s.source, s.product, s.timestamp, s.bytes FROM store s ANTI JOIN taken t USING (source, product, timestamp)""",
)
def s16_store_upsert(spark, sf_dir):
    after = store.upsert(views.store(spark, sf_dir), views.incoming(spark, sf_dir, store_now()), store_now(), STORE_TTL)
    return after.drop("cached_at")


@query(
    "s16_store_force",
    f"""WITH {STORE} SELECT source, product, timestamp, bytes FROM incoming UNION ALL SELECT s.source, s.product, s.timestamp, s.bytes FROM store s ANTI JOIN incoming t USING (source, product, timestamp)""",
)
def s16_store_force(spark, sf_dir):
    after = store.upsert(views.store(spark, sf_dir), views.incoming(spark, sf_dir, store_now()), store_now(), STORE_TTL, force=True)
    return after.drop("cached_at")


@query(
    "s17_store_lookup",
    f"WITH {STORE} SELECT l.source, l.product, l.timestamp, l.bytes FROM live l SEMI JOIN incoming i USING (source, product, timestamp)",
)
def s17_store_lookup(spark, sf_dir):
    wanted = views.incoming(spark, sf_dir, store_now()).select("source", "product", "timestamp")
    return store.lookup(views.store(spark, sf_dir), wanted, store_now(), STORE_TTL).drop("cached_at")


def store_on_disk(spark, sf_dir, force=False):
    """The store written by one put, and the incoming scans by a second; (folder, now)."""
    folder, now = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", datetime.fromisoformat(STORE_NOW)
    store_files.put(views.store(spark, sf_dir), folder, now, STORE_TTL)
    store_files.put(views.incoming(spark, sf_dir, store_now()), folder, now, STORE_TTL, force)
    return folder, now


@query(
    "s16_store_files",
    f"""WITH {STORE}, taken AS (SELECT i.* FROM incoming i ANTI JOIN live l USING (source, product, timestamp))
SELECT source, product, timestamp, bytes FROM taken UNION ALL SELECT s.source, s.product, s.timestamp, s.bytes FROM store s ANTI JOIN taken t USING (source, product, timestamp)""",
)
def s16_store_files(spark, sf_dir):
    """Two puts into a store on disk, read back."""
    return store_files.read(spark, store_on_disk(spark, sf_dir)[0]).drop("cached_at")


@query(
    "s17_store_files",
    f"""WITH {STORE}, taken AS (SELECT i.* FROM incoming i ANTI JOIN live l USING (source, product, timestamp)),
after AS (SELECT source, product, timestamp, bytes FROM taken UNION ALL SELECT l.source, l.product, l.timestamp, l.bytes FROM live l ANTI JOIN taken t USING (source, product, timestamp))
SELECT a.* FROM after a SEMI JOIN (SELECT source, product, timestamp FROM hourly WHERE event_type = 'error') w USING (source, product, timestamp)""",
)
def s17_store_files(spark, sf_dir):
    """Lookup in the store on disk of every key that an error event names."""
    folder, now = store_on_disk(spark, sf_dir)
    wanted = views.hourly(spark, sf_dir, ("error",)).select("source", "product", "timestamp")
    return store_files.lookup(spark, folder, wanted, now, STORE_TTL).drop("cached_at")


@query("a17_available_stamps", f"WITH {STORE} SELECT DISTINCT source, timestamp FROM live WHERE product = 'zmax'")
def a17_available_stamps(spark, sf_dir):
    return store.available(views.store(spark, sf_dir), store_now(), "zmax", STORE_TTL)


@query(
    "a15_store_statistics",
    f"""WITH {STORE} SELECT coalesce(source, 'all') AS source, count(*) AS entries, round(sum(bytes) / 1048576.0::DOUBLE, 2) AS size_mb FROM live GROUP BY ROLLUP (source)""",
)
def a15_store_statistics(spark, sf_dir):
    return store.statistics(views.store(spark, sf_dir), store_now(), STORE_TTL).na.fill("all", ["source"])


@query(
    "p24_clear_source",
    f"""WITH {STORE} SELECT source, count(*) AS kept, (SELECT count(*) FROM store WHERE source = 'shmu') AS removed FROM store WHERE source <> 'shmu' GROUP BY source""",
)
def p24_clear_source(spark, sf_dir):
    kept, removed = store.cleared(views.store(spark, sf_dir), "shmu")
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("kept")).withColumn("removed", removed.scalar())


@query(
    "p23_retention",
    f"""WITH {ctes.STAMPED}, e AS (SELECT *, ts + to_minutes(CAST(event_id % 13 AS INT)) AS modified, list_extract(['shmu','dwd','merged'], CAST(event_id % 3 AS INT) + 1) AS src FROM stamped),
f AS (SELECT src, ts, CASE event_id % 3 WHEN 0 THEN CAST(user_id % 2 AS VARCHAR) WHEN 1 THEN 'd' ELSE CAST(user_id % 3 AS VARCHAR) END AS prod, max(modified) AS modified FROM e GROUP BY ALL)
SELECT src AS source, CAST(count_if(epoch(TIMESTAMP '2024-01-20 12:00:00') - epoch(modified) > 21600) AS BIGINT) AS expired,
 CAST(count_if(epoch(TIMESTAMP '2024-01-20 12:00:00') - epoch(modified) <= 21600) AS BIGINT) AS retained FROM f GROUP BY src""",
)
def p23_retention(spark, sf_dir):
    at = F.to_timestamp(F.lit("2024-01-20 12:00:00"))
    files = views.published(spark, sf_dir)
    gone = published.expired(files, at).select("source", F.lit(1).alias("gone"))
    kept = published.retained(files, at).select("source", F.lit(0).alias("gone"))
    return gone.unionAll(kept).groupBy("source").agg(
        F.count_if(F.col("gone") == 1).alias("expired"), F.count_if(F.col("gone") == 0).alias("retained")
    )


@query(
    "s18_sink_layout",
    f"""WITH {ctes.CATALOG} SELECT CASE source WHEN 'dwd' THEN 'germany' WHEN 'shmu' THEN 'slovakia' WHEN 'chmi' THEN 'czechia' WHEN 'omsz' THEN 'hungary' WHEN 'arso' THEN 'slovenia' ELSE 'poland' END AS folder,
 CAST(epoch(ts) AS BIGINT) AS unix, CAST(epoch(ts) AS BIGINT) || '.png' AS name, strftime(ts,'%Y-%m-%d') AS date FROM catalog""",
)
def s18_sink_layout(spark, sf_dir):
    return sinks.located(views.scan_catalog(spark, sf_dir)).select("folder", "unix", "name", "date")


@query(
    "s19_skip_existing",
    f"""WITH {ctes.STAMPED} SELECT DISTINCT source, strftime(date_trunc('hour', instant),'{FMT}') AS ts FROM stamped
 EXCEPT SELECT source, strftime(date_trunc('hour', instant),'{FMT}') FROM stamped WHERE event_type = 'view'""",
)
def s19_skip_existing(spark, sf_dir):
    hourly = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("hour", "instant").alias("ts"), "event_type")
    manifest = sinks.located(hourly.where("event_type = 'view'")).select("folder", "name")
    left = sinks.not_yet_written(hourly.select("source", "ts").distinct(), manifest)
    return left.select("source", minute_text("ts").alias("ts"))


def extent_documents(spark, sf_dir):
    """Extent documents in the three layouts and one without bounds."""
    e = views.landed(spark, sf_dir).select("scan_id", "source", "slot")
    sid = F.col("scan_id") % 6
    west = sid * 0.5 + 10.0 + (F.col("slot") % 10) * 0.001
    bounds = F.struct(west.alias("west"), (west + 4).alias("east"), F.lit(44.0).alias("south"), F.lit(49.0).alias("north"))
    now_layout = extents.document(F.col("source"), bounds, F.lit("2024-01-01"))
    older = F.to_json(F.struct(F.struct(bounds.alias("wgs84")).alias("extent")))
    oldest = F.to_json(F.struct(F.struct(bounds.alias("extent")).alias("source")))
    kind = F.floor(F.col("scan_id") / 6) % 4
    text = F.when(kind == 0, now_layout).when(kind == 1, older).when(kind == 2, oldest).otherwise("{}")
    return e.select("scan_id", text.alias("document"))


@query(
    "s20_extent_documents",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot, vec_id % 6 AS sid FROM embeddings), b AS (SELECT *, CASE WHEN slot % 4 < 3 THEN 10 + 0.5::DOUBLE * sid + (slot % 10) * 0.001::DOUBLE END AS w FROM v)
SELECT vec_id AS scan_id, round(w, 6) AS west, round(w + 4, 6) AS east, CASE WHEN w IS NOT NULL THEN 44.0::DOUBLE END AS south, CASE WHEN w IS NOT NULL THEN 49.0::DOUBLE END AS north FROM b""",
)
def s20_extent_documents(spark, sf_dir):
    docs = extent_documents(spark, sf_dir)
    return docs.select("scan_id", extents.extent_of_document(F.col("document")).alias("e")).select("scan_id", *(r6(F.col(f"e.{b}")).alias(b) for b in BOUNDS))


@query(
    "s21_extent_report",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot, vec_id % 6 AS sid FROM embeddings), b AS (SELECT sid, min(10 + 0.5::DOUBLE * sid + (slot % 10) * 0.001::DOUBLE) AS w, max(14 + 0.5::DOUBLE * sid + (slot % 10) * 0.001::DOUBLE) AS e FROM v GROUP BY sid)
SELECT count(*) AS n_sources, round(min(w), 6) AS west, round(max(e), 6) AS east, 44.0::DOUBLE AS south, 49.0::DOUBLE AS north, round(max(CASE WHEN sid = 1 THEN e END), 6) AS shmu_east FROM b""",
)
def s21_extent_report(spark, sf_dir):
    e = views.landed(spark, sf_dir).select("source", "scan_id", "slot")
    west = (F.col("scan_id") % 6) * 0.5 + 10.0 + (F.col("slot") % 10) * 0.001
    bounds = e.select("source", west.alias("west"), (F.col("scan_id") % 6 * 0.5 + 14.0 + (F.col("slot") % 10) * 0.001).alias("east"), F.lit(44.0).alias("south"), F.lit(49.0).alias("north"))
    per_source = mosaic.combined_extent(bounds, ["source"]).select("source", F.struct(*BOUNDS).alias("extent"))
    report = extents.combined_report(per_source)
    inside = F.get_json_object("document", "$.sources.shmu.east").cast("double")
    return report.select("n_sources", *(r6(F.col(f"combined.{b}")).alias(b) for b in BOUNDS), r6(inside).alias("shmu_east"))


PUBLISHED = f"""{ctes.STAMPED}, pub AS (SELECT list_extract(['shmu','dwd','merged'], CAST(event_id % 3 AS INT) + 1) AS source, ts, strftime(ts,'%Y%m%d%H%M%S') AS stamp,
  CASE event_id % 3 WHEN 0 THEN CASE WHEN user_id % 2 = 0 THEN 'zmax' ELSE 'cappi2km' END WHEN 1 THEN 'dmax' ELSE list_extract(['average','max','priority'], CAST(user_id % 3 AS INT) + 1) END AS product,
  event_id % 1000 + 100 AS bytes FROM stamped),
published AS (SELECT source, product, ts, stamp, max(bytes) AS bytes FROM pub GROUP BY ALL)"""


@query(
    "s22_published_index",
    f"""WITH {PUBLISHED} SELECT source, count(*) AS files, array_to_string(list_sort(list(DISTINCT product)), ',') AS products, count(DISTINCT stamp) AS stamps, max(stamp) AS latest FROM published GROUP BY source""",
)
def s22_published_index(spark, sf_dir):
    index = published.index(views.published(spark, sf_dir).drop("product"))
    return index.withColumn("products", F.array_join("products", ","))


@query(
    "s22_timeline",
    f"""WITH {PUBLISHED} SELECT source, stamp, string_agg(product || ':' || bytes, ',' ORDER BY product) AS products FROM published GROUP BY ALL""",
)
def s22_timeline(spark, sf_dir):
    nested = published.timeline(views.published(spark, sf_dir).drop("product"))
    entry = lambda e: F.concat(e["key"], F.lit(":"), e["value"]["bytes"].cast("string"))
    return nested.select("source", "stamp", F.array_join(F.array_sort(F.transform(F.map_entries("products"), entry)), ",").alias("products"))


@query(
    "a24_file_totals",
    f"""WITH {PUBLISHED} SELECT coalesce(source, 'all') AS source, count(*) AS files, array_to_string(list_sort(list(DISTINCT product)), ',') AS products FROM published GROUP BY ROLLUP (source)""",
)
def a24_file_totals(spark, sf_dir):
    found = published.totals(views.published(spark, sf_dir))
    return found.withColumn("products", F.array_join("products", ",")).na.fill("all", ["source"])


@query(
    "a24_animation_plan",
    f"""WITH {PUBLISHED}, k AS (SELECT source, list_sort(list(DISTINCT product) FILTER (product IN ('zmax','cappi2km','dmax'))) AS p FROM published GROUP BY source)
SELECT source, coalesce(array_to_string(p, ','), '') AS products, CASE WHEN coalesce(len(p), 0) = 0 THEN 0 WHEN source = 'shmu' AND len(p) > 1 THEN CAST(len(p) AS INT) ELSE 1 END AS animations FROM k""",
)
def a24_animation_plan(spark, sf_dir):
    plan = published.animation_plan(views.published(spark, sf_dir), ["zmax", "cappi2km", "dmax"])
    return plan.withColumn("products", F.array_join("products", ","))


@query(
    "a23_sequences",
    f"""WITH {PUBLISHED}, g AS (SELECT source, product, count(*) AS frames, min(ts) AS a, max(ts) AS b FROM published GROUP BY ALL)
SELECT source, product, frames, strftime(a,'%Y%m%d') AS date, strftime(a,'%H%M') AS start, strftime(b,'%H%M') AS "end",
 source || '_' || product || '_' || strftime(a,'%Y%m%d_%H%M_') || strftime(b,'%H%M') || '.gif' AS name FROM g""",
)
def a23_sequences(spark, sf_dir):
    from ..operators import render

    return render.sequences(views.published(spark, sf_dir))


@query(
    "w7_frames",
    f"""WITH {PUBLISHED} SELECT source, product, stamp, row_number() OVER (PARTITION BY source, product ORDER BY ts) AS frame, 83 AS duration_ms FROM published""",
)
def w7_frames(spark, sf_dir):
    from ..operators import render

    return render.frames(views.published(spark, sf_dir)).select("source", "product", T.stamp(F.col("ts")).alias("stamp"), "frame", "duration_ms")


# --- predicates -----------------------------------------------------------------------------------


@query(
    "p1_decode",
    f"""WITH {ctes.RAW} SELECT source, slot, "row", col, CASE WHEN raw IN (0, 100) THEN NULL ELSE round(raw * 0.25::DOUBLE - 10, 6) END AS dbz FROM raw_cells""",
)
def p1_decode(spark, sf_dir):
    cells = views.raw_cells(spark, sf_dir)
    value = A.decode(F.col("raw"), 0.25, -10.0, 100, 0)
    return cells.select("source", "slot", "row", "col", r6(value.cast("double")).alias("dbz"))


@query(
    "p2_scaling_defaults",
    f"WITH {LANDED} SELECT DISTINCT s.vec_id AS scan_id, gain, off AS \"offset\", nodata, 0 AS undetect, source IN ('shmu','chmi','imgw','omsz') AS byte_rule FROM scaled s WHERE source NOT IN ('omsz','arso')",
)
def p2_scaling_defaults(spark, sf_dir):
    read = views.landed(spark, sf_dir).where("source not in ('omsz', 'arso')")
    return read.select("scan_id", A.scaling(F.col("what_data"), F.col("source")).alias("s")).select("scan_id", "s.*")


@query(
    "p3_signed_bytes",
    f"""WITH {ctes.RAW} SELECT slot, "row", col, raw AS unsigned, round(CASE WHEN raw NOT IN (0, 255) THEN raw * 0.5::DOUBLE - 32 END, 6) AS dbz FROM raw_cells WHERE source = 'omsz'""",
)
def p3_signed_bytes(spark, sf_dir):
    signed = F.when(F.col("raw") > 127, F.col("raw") - 256).otherwise(F.col("raw"))
    cells = views.raw_cells(spark, sf_dir).where("source = 'omsz'").withColumn("signed", signed)
    return cells.select(
        "slot", "row", "col", A.unsigned(F.col("signed")).alias("unsigned"), r6(A.decode_signed_byte(F.col("signed")).cast("double")).alias("dbz")
    )


@query(
    "p6_scans_with_data",
    f"WITH {ctes.RAW} SELECT source, slot FROM raw_cells GROUP BY ALL HAVING count_if(raw >= 200) > 0",
)
def p6_scans_with_data(spark, sf_dir):
    cells = views.raw_cells(spark, sf_dir).withColumn("dbz", F.when(F.col("raw") >= 200, F.col("raw")))
    return mosaic.with_valid_cells(cells.select("source", "slot").distinct(), cells, ["source", "slot"])


@query(
    "p7_render_threshold",
    f"WITH {ctes.BIG} SELECT slot, source, count(*) AS drawn FROM big WHERE dbz >= 10 GROUP BY ALL",
)
def p7_render_threshold(spark, sf_dir):
    from ..functions.colour import visible

    return views.big_cells(spark, sf_dir).where(visible(F.col("dbz"))).groupBy("slot", "source").agg(F.count(F.lit(1)).alias("drawn"))


@query(
    "p8_range_clip",
    f"""WITH {ctes.BIG} SELECT source, slot, round(sum(greatest(-35, least(85, dbz))), 3) AS regrid_total, round(sum(greatest(-32, least(80, dbz))), 3) AS merge_total FROM big GROUP BY ALL""",
)
def p8_range_clip(spark, sf_dir):
    value = F.col("dbz").cast("double")
    return views.big_cells(spark, sf_dir).where("dbz is not null").groupBy("source", "slot").agg(
        F.round(F.sum(A.clip(value, REGRID_CLIP)), 3).alias("regrid_total"), F.round(F.sum(A.clip(value, MERGE_CLIP)), 3).alias("merge_total")
    )


@query(
    "p9_extreme_values",
    f"""WITH {ctes.BIG_PLACED}, m AS (SELECT slot, dst_row, dst_col, max(dbz) AS dbz FROM placed GROUP BY ALL)
SELECT slot, count(*) AS kept FROM m WHERE dbz BETWEEN -35 AND 85 GROUP BY slot""",
)
def p9_extreme_values(spark, sf_dir):
    from .mosaic_queries import placed_big

    merged = mosaic.merge(placed_big(spark, sf_dir), ["slot"], "max")
    return merged.where(F.col("dbz").between(*REGRID_CLIP)).groupBy("slot").agg(F.count(F.lit(1)).alias("kept"))


LANDING_RULES = f"""{ctes.STAMPED}, r AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '  ' || upper(source) || ' ' WHEN 1 THEN '../' || source WHEN 2 THEN 'a' ELSE source END AS name,
  CAST(event_id % 10003 AS INT) AS height, CAST(user_id AS INT) AS width FROM stamped)"""


def landing_rows(spark, sf_dir):
    k = F.col("event_id") % 7
    name = (
        F.when(k == 0, F.concat(F.lit("  "), F.upper("source"), F.lit(" ")))
        .when(k == 1, F.concat(F.lit("../"), F.col("source")))
        .when(k == 2, F.lit("a"))
        .otherwise(F.col("source"))
    )
    return views.stamped_events(spark, sf_dir).select(
        "event_id", name.alias("source"), (F.col("event_id") % 10003).cast("int").alias("height"), F.col("user_id").cast("int").alias("width")
    )


@query(
    "p13_source_name_rule",
    f"""WITH {LANDING_RULES} SELECT event_id, lower(trim(name)) AS source, NOT regexp_full_match(lower(trim(name)), '[a-z]{{2,10}}') AS rejected FROM r""",
)
def p13_source_name_rule(spark, sf_dir):
    judged = quarantine.judge(landing_rows(spark, sf_dir).drop("height", "width"))
    return judged.select("event_id", "source", F.col("reject_reason").isNotNull().alias("rejected"))


@query(
    "p14_dimension_rule",
    f"""WITH {LANDING_RULES}, j AS (SELECT CASE WHEN NOT regexp_full_match(lower(trim(name)), '[a-z]{{2,10}}') THEN 'bad source name'
  WHEN NOT (height BETWEEN 1 AND 10000 AND width BETWEEN 1 AND 10000) THEN 'bad grid dimensions' ELSE 'good' END AS verdict FROM r)
SELECT verdict, count(*) AS scans FROM j GROUP BY verdict""",
)
def p14_dimension_rule(spark, sf_dir):
    judged = quarantine.judge(landing_rows(spark, sf_dir))
    return judged.groupBy(F.coalesce("reject_reason", F.lit("good")).alias("verdict")).agg(F.count(F.lit(1)).alias("scans"))


@query(
    "p16_page_instead_of_data",
    "SELECT page_id, (html LIKE '<!DO%' OR html LIKE '<html%') AS rejected FROM pages",
)
def p16_page_instead_of_data(spark, sf_dir):
    landed = views.table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"), F.lit("dwd").alias("source"))
    return quarantine.judge(landed).select("page_id", (F.col("reject_reason") == "page instead of data").alias("rejected")).na.fill(False)


@query(
    "p18_corner_extent",
    f"""WITH {LANDED}, l AS (SELECT DISTINCT vec_id, w, cor FROM landed WHERE source IN ('shmu','chmi','imgw','arso'))
SELECT vec_id AS scan_id, round(CASE WHEN cor THEN w ELSE 1.461077 END, 6) AS west, round(CASE WHEN cor THEN w + 4 ELSE 26.376516 END, 6) AS east,
 round(CASE WHEN cor THEN 44.0::DOUBLE ELSE 44.001479 END, 6) AS south, round(CASE WHEN cor THEN 49.0::DOUBLE ELSE 56.398335 END, 6) AS north FROM l""",
)
def p18_corner_extent(spark, sf_dir):
    from ..dimensions import REFERENCE_EXTENT

    read = views.landed(spark, sf_dir).where("source in ('shmu', 'chmi', 'imgw', 'arso')")
    e = A.corner_extent(F.col("where_attrs"), A.extent_lit(REFERENCE_EXTENT))
    return read.select("scan_id", e.alias("e")).select("scan_id", *(r6(F.col(f"e.{b}")).alias(b) for b in BOUNDS))


@query(
    "p19_four_corner_extent",
    f"""WITH {LANDED}, l AS (SELECT DISTINCT vec_id, w, cor FROM landed WHERE source = 'dwd')
SELECT vec_id AS scan_id, round(CASE WHEN cor THEN w - 0.1 ELSE 1.46 END, 6) AS west, round(CASE WHEN cor THEN w + 4.1 ELSE 18.73 END, 6) AS east,
 round(CASE WHEN cor THEN 44.0::DOUBLE ELSE 45.68 END, 6) AS south, round(CASE WHEN cor THEN 49.0::DOUBLE ELSE 55.86 END, 6) AS north FROM l""",
)
def p19_four_corner_extent(spark, sf_dir):
    read = views.landed(spark, sf_dir).where("source = 'dwd'")
    return read.select("scan_id", A.four_corner_extent(F.col("where_attrs")).alias("e")).select("scan_id", *(r6(F.col(f"e.{b}")).alias(b) for b in BOUNDS))


@query(
    "p20_step_extent",
    f"""WITH {LANDED}, l AS (SELECT DISTINCT vec_id, w FROM landed WHERE source = 'omsz') SELECT vec_id AS scan_id, round(w, 6) AS west, round(w + 3.5, 6) AS east, 47.25::DOUBLE AS south, 49.0::DOUBLE AS north FROM l""",
)
def p20_step_extent(spark, sf_dir):
    read = views.landed(spark, sf_dir).where("source = 'omsz'")
    n = lambda name: A.number(F.col("where_attrs"), name)
    e = A.step_extent(n("La1"), n("Lo1"), n("Dx"), n("Dy"), F.col("height"), F.col("width"))
    return read.select("scan_id", e.alias("e")).select("scan_id", *(r6(F.col(f"e.{b}")).alias(b) for b in BOUNDS))


@query(
    "p21_cell_axes",
    f"""WITH {ctes.CELLS} SELECT source_id, slot, "row", col, round(10 + 0.5::DOUBLE * source_id + col * 4.0::DOUBLE / 7, 6) AS lon, round(50 - "row" * 4.0::DOUBLE / 7, 6) AS lat FROM cells""",
)
def p21_cell_axes(spark, sf_dir):
    west = F.col("source_id") * 0.5 + 10.0
    lon, lat = P.axis_lonlat(west, west + 4.0, F.lit(46.0), F.lit(50.0), F.col("row"), F.col("col"), F.lit(8), F.lit(8))
    return views.cells(spark, sf_dir).select("source_id", "slot", "row", "col", r6(lon).alias("lon"), r6(lat).alias("lat"))


LCC_INVERSE = """k AS (SELECT sin(radians(46.12)) AS n, 6371.0::DOUBLE * cos(radians(46.12)) * pow(tan(pi() / 4 + radians(46.12) / 2), sin(radians(46.12))) / sin(radians(46.12)) AS rf),
k2 AS (SELECT *, rf / pow(tan(pi() / 4 + radians(46.12) / 2), n) AS rho0 FROM k)"""


@query(
    "p22_srd_axes",
    f"""WITH {SRD}, {LCC_INVERSE}, c AS (SELECT "row", col, count(*) AS cells, (col + 1 - 205)::DOUBLE AS x, (145 - ("row" + 1))::DOUBLE AS y FROM srd GROUP BY ALL)
SELECT CAST("row" AS INT) AS "row", CAST(col AS INT) AS col, cells, round(14.815 + degrees(atan2(x, rho0 - y) / n), 6) AS lon,
 round(degrees(2 * atan(pow(rf / sqrt(x * x + (rho0 - y) * (rho0 - y)), 1 / n)) - pi() / 2), 6) AS lat FROM c, k2""",
)
def p22_srd_axes(spark, sf_dir):
    used = srd.cells(srd.scans(views.srd_text(spark, sf_dir))).groupBy("row", "col").agg(F.count(F.lit(1)).alias("cells"))
    lon, lat = srd.cell_lonlat(F.col("row"), F.col("col"))
    return used.select("row", "col", "cells", r6(lon).alias("lon"), r6(lat).alias("lat"))


@query(
    "p27_target_shape",
    f"""WITH {PUBLISHED}, s AS (SELECT DISTINCT source FROM stamped), f AS (SELECT source, arg_min(CAST(bytes AS INT), product || '_' || stamp || '.png') AS h FROM published WHERE source <> 'merged' GROUP BY source),
m AS (SELECT source, min(event_id % 50 + 100) AS h FROM stamped WHERE source <> 'arso' GROUP BY source)
SELECT s.source, CAST(coalesce(f.h, m.h, -1) AS INT) AS height, CAST(coalesce(f.h + 1, m.h + 1, -1) AS INT) AS width FROM s LEFT JOIN f USING (source) LEFT JOIN m USING (source)""",
)
def p27_target_shape(spark, sf_dir):
    """Shape of published rasters where there are any, of the stored map otherwise."""
    files = views.published(spark, sf_dir).select(
        "source", "name", F.col("bytes").cast("int").alias("height"), (F.col("bytes") + 1).cast("int").alias("width")
    ).where("source <> 'merged'")
    rows = views.stamped_events(spark, sf_dir)
    size = (F.col("event_id") % 50 + 100).cast("int")
    maps = rows.where("source <> 'arso'").select("source", F.lpad(size.cast("string"), 5, "0").alias("map_key"), size.alias("height"), (size + 1).alias("width"))
    return coverage.target_shape(rows.select("source").distinct(), files, maps).na.fill(-1)


@query(
    "p28_source_extent",
    f"""WITH v AS (SELECT vec_id % 6 AS sid, vec_id // 6 AS slot FROM embeddings), s AS (SELECT sid, list_extract({ctes.NAMES}, CAST(sid AS INT) + 1) AS source, min(10 + 0.5::DOUBLE * sid + (slot % 10) * 0.001::DOUBLE) AS w FROM v GROUP BY ALL)
SELECT source, round(CASE WHEN sid < 3 THEN w WHEN sid < 5 THEN w - 1 END, 6) AS west FROM s""",
)
def p28_source_extent(spark, sf_dir):
    """Canonical extent for three services, the older place for two more, none for the last."""
    e = views.landed(spark, sf_dir).select("source", (F.col("scan_id") % 6).alias("sid"), "slot")
    west = F.col("sid") * 0.5 + 10.0 + (F.col("slot") % 10) * 0.001
    per_source = e.groupBy("source", "sid").agg(F.min(west).alias("west"))
    place = lambda rows, shift: rows.select("source", F.struct((F.col("west") + shift).alias("west")).alias("extent"))
    found = coverage.source_extent(per_source.select("source"), place(per_source.where("sid < 3"), 0.0), place(per_source.where("sid < 5"), -1.0))
    return found.select("source", r6(F.col("extent.west")).alias("west"))


@query(
    "p29_latest_stamp",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot FROM embeddings) SELECT vec_id AS scan_id, CASE WHEN vec_id % 6 = 0 AND vec_id % 4 = 0 THEN '202402010000' ELSE strftime({SLOT_TS},'{FMT}') END || '00' AS ts14 FROM v""",
)
def p29_latest_stamp(spark, sf_dir):
    """Scans of the moving address carry no stamp of their own; a few lack the attributes too."""
    read = views.landed(spark, sf_dir)
    raw = F.when(F.col("source") == "dwd", "LATEST").otherwise(F.col("ts_raw"))
    attrs = F.when((F.col("source") == "dwd") & (F.col("scan_id") % 4 == 0), F.create_map().cast("map<string,string>")).otherwise(F.col("what_global"))
    return read.select("scan_id", T.latest_stamp(raw, attrs, F.to_timestamp(F.lit("2024-02-01 00:00:30"))).alias("ts14"))


@query(
    "f6_stamp_from_attrs",
    f"""WITH v AS (SELECT vec_id, vec_id // 6 AS slot FROM embeddings) SELECT vec_id AS scan_id, strftime({SLOT_TS},'{FMT}') || '00' AS ts14 FROM v""",
)
def f6_stamp_from_attrs(spark, sf_dir):
    """Dataset attributes, falling back to the global ones."""
    return views.landed(spark, sf_dir).select("scan_id", T.stamp_from_attrs(F.col("what_dataset"), F.col("what_global")).alias("ts14"))


@query(
    "u6_missing_masks",
    f"""WITH {ctes.STAMPED}, s AS (SELECT DISTINCT source FROM stamped), m AS (SELECT DISTINCT source FROM stamped WHERE source IN ('dwd','chmi')), x AS (SELECT DISTINCT source FROM stamped WHERE source <> 'arso')
SELECT source, source NOT IN (SELECT source FROM x) AS needs_extent FROM s WHERE source NOT IN (SELECT source FROM m) UNION ALL SELECT 'composite', true""",
)
def u6_missing_masks(spark, sf_dir):
    """No composite mask yet, so every service without a mask is due although single ones were not asked for."""
    rows = views.stamped_events(spark, sf_dir).select("source").distinct()
    return coverage.missing_masks(rows, rows.where("source in ('dwd', 'chmi')"), rows.where("source <> 'arso'"), include_individual=False)

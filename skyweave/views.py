"""Radar-shaped views over the driver's tables. Every rule is a fixed, row-wise function of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dimensions import SOURCE_NAMES
from .functions import attrs as A
from .functions.proj import Grid
from .functions.timefn import stamp
from .operators.regrid import SourceGrid
from .session import use_utc
from .sources import srd


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def source_name(index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in SOURCE_NAMES)), (index + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def stamped_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event seen as the arrival of a scan: source, minute, spelled stamp."""
    source = source_name(F.col("event_id") % 6)
    minute = F.date_trunc("minute", "ts")
    raw = F.when(source.isin("dwd", "omsz"), stamp(minute, "yyyyMMdd_HHmm")).otherwise(stamp(minute))
    return events(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "value", F.col("ts").alias("instant"), source.alias("source"), minute.alias("ts"), raw.alias("ts_raw")
    )


def scan_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamped_events(spark, sf_dir).select("source", "ts", "ts_raw").distinct()


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("key"), "ts", "event_id", (F.col("event_type") != "error").alias("ok")
    )


# --- rasters of 8 x 8 cells from the embeddings ---------------------------------------------------


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, source, priority, slot, row, col, raw): one scan per vector."""
    scans = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    level = F.floor((F.col("v").cast("double") + 0.5) * 255)
    source_id = (F.col("vec_id") % 6).cast("int")
    return scans.select(
        source_id.alias("source_id"),
        source_name(source_id).alias("source"),
        source_id.alias("priority"),
        F.floor(F.col("vec_id") / 6).cast("int").alias("slot"),
        F.floor(F.col("pos") / 8).cast("int").alias("row"),
        (F.col("pos") % 8).alias("col"),
        F.least(F.lit(255), F.greatest(F.lit(0), level)).cast("int").alias("raw"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, decoded as unsigned bytes at half a dBZ a step; missing cells dropped."""
    dbz = A.decode(F.col("raw"), 0.5, -32.0, 255, 0)
    return raw_cells(spark, sf_dir).withColumn("dbz", dbz).drop("raw").where("dbz is not null")


def small_grids() -> dict[int, SourceGrid]:
    return {i: SourceGrid(10 + 0.5 * i, 50 - 0.25 * i, 0.5, 0.5, 8, 8) for i in range(6)}


TARGET_EXTENT = (10.0, 17.0, 45.0, 50.1)


def small_target() -> Grid:
    return Grid.of_shape(TARGET_EXTENT, 14, 14)


def slot_time(slot: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + slot * 300)  # 2024-01-01 UTC, five minutes a slot


# --- rasters of 16 x 16 cells from the line items -------------------------------------------------


def big_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, source, priority, slot, row, col, dbz): the largest raw value of a key; raw below 25 is missing."""
    source_id = (F.col("l_orderkey") % 6).cast("int")
    items = table(spark, sf_dir, "lineitem").select(
        source_id.alias("source_id"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("slot"),
        (F.col("l_partkey") % 16).cast("int").alias("row"),
        (F.col("l_suppkey") % 16).cast("int").alias("col"),
        (F.col("l_quantity") * 5).cast("int").alias("raw"),
    )
    top = items.groupBy("source_id", "slot", "row", "col").agg(F.max("raw").alias("raw"))
    dbz = F.when(F.col("raw") >= 25, (F.col("raw") * 0.5 - 32.0).cast("float"))
    return top.select(
        "source_id", source_name(F.col("source_id")).alias("source"), F.col("source_id").alias("priority"), "slot", "row", "col", "raw", dbz.alias("dbz")
    )


def big_grids() -> dict[int, SourceGrid]:
    return {i: SourceGrid(10 + 0.5 * i, 50 - 0.25 * i, 0.25, 0.25, 16, 16) for i in range(6)}


def big_target() -> Grid:
    return Grid.of_shape(TARGET_EXTENT, 28, 28)


# --- landed scans, one per vector -----------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw scans as they land: pixels as one array, attributes as text maps, some attributes missing."""
    v = F.col("vec_id")
    sid = (v % 6).cast("int")
    slot = F.floor(v / 6).cast("int")
    ts = slot_time(slot)
    base = table(spark, sf_dir, "embeddings").select(
        v.alias("scan_id"), source_name(sid).alias("source"), slot.alias("slot"), ts.alias("true_ts"), "embedding", sid.alias("_sid")
    )
    source, scan = F.col("source"), F.col("scan_id")
    as_ = lambda f: stamp(F.col("true_ts"), f)
    level = lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.5) * 255))).cast("int")
    signed = lambda r: F.when((source == "omsz") & (r > 127), r - 256).otherwise(r)
    text_map = lambda **kv: F.create_map(*(x for k, val in kv.items() for x in (F.lit(k), val if isinstance(val, Column) else F.lit(val))))
    none = F.create_map().cast("map<string,string>")
    west = F.col("_sid") * 0.5 + 10.0 + (F.col("slot") % 10) * 0.001
    south = F.lit(44.0)
    t = lambda c: c.cast("string")
    scaling = F.when(scan % 4 != 0, text_map(gain="0.5", offset="-32", nodata="255", undetect="0", quantity="DBZH")).otherwise(none)
    when = F.when((source == "imgw") & (scan % 3 == 0), none).otherwise(text_map(startdate=as_("yyyyMMdd"), starttime=as_("HHmmss")))
    corners = F.when(scan % 5 == 0, none).otherwise(
        text_map(LL_lon=t(west), LL_lat=t(south), UR_lon=t(west + 4), UR_lat=t(south + 5))
    )
    four = F.when(scan % 5 == 0, none).otherwise(
        text_map(
            UL_lon=t(west), UL_lat=t(south + 5), UR_lon=t(west + 4.1), UR_lat=t(south + 4.9),
            LL_lon=t(west - 0.1), LL_lat=t(south), LR_lon=t(west + 4), LR_lat=t(south + 0.05),
        )
    )
    steps_ = text_map(La1=t(south + 5), Lo1=t(west), Dx="0.5", Dy="0.25")
    return base.select(
        "scan_id",
        "source",
        "slot",
        F.lit("").alias("product"),
        as_("yyyyMMdd_HHmm").alias("ts_raw"),
        F.when(source == "dwd", F.concat(F.lit("composite_dmax_"), as_("yyyyMMdd_HHmm"), F.lit("-hd5"))).when(source == "omsz", "x/refl2D_pscappi.nc").otherwise("scan.h5").alias("path"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        (source != "dwd").alias("is_u8"),
        F.transform("embedding", lambda x: signed(level(x))).alias("raw"),
        scaling.alias("what_data"),
        F.map_concat(scaling, when).alias("what_dataset"),
        text_map(date=as_("yyyyMMdd"), time=as_("HHmmss"), source="WMO").alias("what_global"),
        F.when(source == "omsz", steps_).when(source == "dwd", four).otherwise(corners).alias("where_attrs"),
        as_("yyyy-MM-dd").alias("date"),
    )


def landed_six(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed scans of five services, and those of the sixth from its text-grid files."""
    rasters = landed(spark, sf_dir).where("source <> 'arso'")
    number = F.regexp_extract("path", r"(\d+)\.srd$", 1).cast("bigint")
    files = srd_text(spark, sf_dir).withColumn("scan_id", number).where("scan_id % 6 = 4").withColumn("slot", F.floor(F.col("scan_id") / 6).cast("int"))
    return rasters.unionByName(srd.landed(files, ["scan_id", "slot"]))


def landed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog that goes with the landed scans: (source, ts, timestamp)."""
    v = F.col("vec_id")
    ts = slot_time(F.floor(v / 6).cast("int"))
    return table(spark, sf_dir, "embeddings").select(source_name(v % 6).alias("source"), ts.alias("ts"), stamp(ts).alias("timestamp"))


def srd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-grid scans (path, content), one per vector: eight levels, broken lines, some bodies short or long."""
    v = F.col("vec_id")
    letters = F.transform("embedding", lambda x: F.char(F.lit(64) + F.floor(F.least(F.lit(255), F.greatest(F.lit(0), F.floor((x.cast("double") + 0.5) * 255))) / 8).cast("int")))
    body = F.concat(F.array_join(F.slice(letters, 1, 32), ""), F.lit("\n"), F.array_join(F.slice(letters, 33, 32), ""))
    cut = F.when(v % 7 == 0, F.substring(body, 1, 40)).when(v % 7 == 1, F.concat(body, F.lit("ZZZ"))).otherwise(body)
    ts = slot_time(F.floor(v / 6))
    header = F.concat(
        F.lit("SRD-3\nncell 8 8 # size\ntime "),
        F.date_format(ts, "yyyy M d H m"),
        F.lit("\n# a comment line\noffset 64\nstart 12.0\nslope 3.0\nunit DBZ\ndomain SI"),
        (v % 3).cast("string"),
        F.lit("\n\nDATA\n"),
    )
    return table(spark, sf_dir, "embeddings").select(F.concat(F.lit("si0-zm-"), v.cast("string"), F.lit(".srd")).alias("path"), F.concat(header, cut).alias("content"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, lon, lat): a point per event inside central Europe."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        ((F.col("event_id") * 37 % 1700) / 100.0 + 5.0).alias("lon"),
        ((F.col("user_id") * 13 % 1100) / 100.0 + 44.5).alias("lat"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored scans by the hour, one row per key."""
    return hourly(spark, sf_dir, ("view", "click")).groupBy("source", "product", "timestamp").agg(
        F.max("instant").alias("cached_at"), F.sum("bytes").alias("bytes")
    )


def incoming(spark: SparkSession, sf_dir: str, now: Column) -> DataFrame:
    return hourly(spark, sf_dir, ("purchase",)).groupBy("source", "product", "timestamp").agg(
        F.min(now).alias("cached_at"), F.sum("bytes").alias("bytes")
    )


def hourly(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> DataFrame:
    rows = stamped_events(spark, sf_dir).where(F.col("event_type").isin(*kinds))
    return rows.select(
        "source",
        F.when(F.col("user_id") % 2 == 0, "zmax").otherwise("etop").alias("product"),
        stamp(F.date_trunc("hour", "instant")).alias("timestamp"),
        "instant",
        (F.col("event_id") % 500 * 1000 + 1000).alias("bytes"),
    )


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published files of three services, unique per name: source, product, ts, name, bytes, modified."""
    rows = stamped_events(spark, sf_dir)
    e, u = F.col("event_id"), F.col("user_id")
    source = F.element_at(F.array(F.lit("shmu"), F.lit("dwd"), F.lit("merged")), (e % 3 + 1).cast("int"))
    product = (
        F.when(e % 3 == 0, F.when(u % 2 == 0, "zmax").otherwise("cappi2km"))
        .when(e % 3 == 1, F.lit("dmax"))
        .otherwise(F.element_at(F.array(F.lit("average"), F.lit("max"), F.lit("priority")), (u % 3 + 1).cast("int")))
    )
    front = F.when(e % 3 == 2, F.lit("merged_")).otherwise(F.lit(""))
    named = rows.select(
        source.alias("source"),
        product.alias("product"),
        "ts",
        F.concat(front, product, F.lit("_"), stamp(F.col("ts")), F.lit(".png")).alias("name"),
        (e % 1000 + 100).alias("bytes"),
        (F.col("ts") + F.make_dt_interval(mins=(e % 13).cast("int"))).alias("modified"),
    )
    return named.groupBy("source", "product", "ts", "name").agg(F.max("bytes").alias("bytes"), F.max("modified").alias("modified"))

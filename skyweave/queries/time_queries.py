"""Stamps, alignment, availability and failure streaks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..dimensions import BACKLOAD_CAP, CORE_SOURCES, SOURCE_NAMES
from ..functions import timefn as T
from ..operators import align, health, sequence
from ..sources import catalog as C
from . import ctes
from .registry import minute_text, query, r6

FMT = "%Y%m%d%H%M"
NOW = "2024-01-31 00:05:00"  # a little after the last event


def now(text: str = NOW):
    return F.to_timestamp(F.lit(text))


# --- stamps ---------------------------------------------------------------------------------------

SPELLED = f"""{ctes.CATALOG}, spelled AS (SELECT source, ts, CASE CAST(epoch(ts) AS BIGINT) // 60 % 6 WHEN 0 THEN strftime(ts,'%Y%m%d%H%M%S')
  WHEN 1 THEN strftime(ts,'{FMT}') WHEN 2 THEN strftime(ts,'%Y%m%d_%H%M') WHEN 3 THEN strftime(ts,'%Y%m%d%H%M') || '99'
  WHEN 4 THEN strftime(ts,'%Y%m%d') ELSE 'x' || strftime(ts,'%H%M') END AS text, CAST(epoch(ts) AS BIGINT) // 60 % 6 AS kind FROM catalog)"""


def spelled(spark, sf_dir):
    """Catalog stamps in six spellings; the last two do not parse."""
    kind = F.floor(F.unix_timestamp("ts") / 60) % 6
    as_ = lambda f: F.date_format("ts", f)
    text = (
        F.when(kind == 0, as_("yyyyMMddHHmmss"))
        .when(kind == 1, as_("yyyyMMddHHmm"))
        .when(kind == 2, as_("yyyyMMdd_HHmm"))
        .when(kind == 3, F.concat(as_("yyyyMMddHHmm"), F.lit("99")))
        .when(kind == 4, as_("yyyyMMdd"))
        .otherwise(F.concat(F.lit("x"), as_("HHmm")))
    )
    return views.scan_catalog(spark, sf_dir).select("source", "ts", text.alias("text"), kind.alias("kind"))


@query(
    "f1_parse_timestamp",
    f"""WITH {SPELLED} SELECT source, text, CASE WHEN kind <= 3 THEN strftime(ts,'{FMT}') END AS parsed,
  CASE WHEN kind = 2 THEN strftime(ts,'{FMT}') END AS parsed_underscore FROM spelled""",
)
def f1_parse_timestamp(spark, sf_dir):
    text = F.col("text")
    return spelled(spark, sf_dir).select(
        "source",
        "text",
        minute_text(T.parse_timestamp(text)).alias("parsed"),
        minute_text(T.parse_timestamp(text, T.UNDERSCORE)).alias("parsed_underscore"),
    )


@query(
    "f2_normalize_timestamp",
    f"""WITH {SPELLED} SELECT source, text, CASE WHEN length(replace(text,'_','')) = 12 THEN replace(text,'_','') || '00' ELSE substr(replace(text,'_',''),1,14) END AS ts14,
 substr(replace(text,'_',''),1,12) AS ts12 FROM spelled""",
)
def f2_normalize_timestamp(spark, sf_dir):
    text = F.col("text")
    return spelled(spark, sf_dir).select(
        "source", "text", T.normalize_timestamp(text, 14).alias("ts14"), T.normalize_timestamp(text, 12).alias("ts12")
    )


@query(
    "f3_floor_to_interval",
    f"""WITH {ctes.STAMPED} SELECT event_id, strftime(date_trunc('hour', instant) + to_minutes(CAST(minute(instant) // 5 * 5 AS INT)),'{FMT}') AS slot5,
 strftime(date_trunc('hour', instant) + to_minutes(CAST(minute(instant) // 7 * 7 AS INT)),'{FMT}') AS slot7 FROM stamped""",
)
def f3_floor_to_interval(spark, sf_dir):
    at = F.col("instant")
    return views.stamped_events(spark, sf_dir).select(
        "event_id", minute_text(T.floor_to_interval(at, 5)).alias("slot5"), minute_text(T.floor_to_interval(at, 7)).alias("slot7")
    )


@query(
    "f4_timestamp_candidates",
    f"""WITH {ctes.CATALOG}, n AS (SELECT source, max(ts) AS now FROM catalog GROUP BY source),
c AS (SELECT source, now - INTERVAL 15 MINUTE + INTERVAL 1 HOUR - to_minutes(CAST(i * 5 AS INT)) AS t FROM n, range(12) r(i))
SELECT DISTINCT source, strftime(date_trunc('hour', t) + to_minutes(CAST(minute(t) // 5 * 5 AS INT)),'%Y%m%d_%H%M') AS candidate FROM c""",
)
def f4_timestamp_candidates(spark, sf_dir):
    newest = views.scan_catalog(spark, sf_dir).groupBy("source").agg(F.max("ts").alias("now"))
    return newest.select(
        "source", F.explode(T.timestamp_candidates(F.col("now"), 4, 5, 15, T.UNDERSCORE, 1)).alias("candidate")
    )


@query(
    "f5_unix_seconds",
    f"""WITH {ctes.CATALOG} SELECT source, ts_raw, CAST(epoch(ts) AS BIGINT) AS unix_utc, CAST(epoch(ts) AS BIGINT) - 3600 AS unix_cet FROM catalog""",
)
def f5_unix_seconds(spark, sf_dir):
    raw = F.col("ts_raw")
    return views.scan_catalog(spark, sf_dir).select(
        "source", "ts_raw", T.to_unix(raw).alias("unix_utc"), T.to_unix(raw, "Europe/Bratislava").alias("unix_cet")
    )


NAMED = f"""{ctes.STAMPED}, named AS (SELECT event_id, source, CASE WHEN event_id % 11 = 0 THEN 'broken.bin'
  WHEN source IN ('dwd','omsz') THEN 'composite_dmax_' || strftime(ts,'%Y%m%d_%H%M') || '-hd5' WHEN source = 'imgw' THEN strftime(ts,'%Y%m%d%H%M%S') || '00dBZ.cmax.h5'
  ELSE 'T_PABV22_C_LZIB_' || strftime(ts,'%Y%m%d%H%M%S') || '.hdf' END AS name, strftime(ts,'%Y%m%d%H%M%S') AS want FROM stamped)"""


def named(spark, sf_dir):
    as_ = lambda f: F.date_format("ts", f)
    name = (
        F.when(F.col("event_id") % 11 == 0, "broken.bin")
        .when(F.col("source").isin("dwd", "omsz"), F.concat(F.lit("composite_dmax_"), as_("yyyyMMdd_HHmm"), F.lit("-hd5")))
        .when(F.col("source") == "imgw", F.concat(as_("yyyyMMddHHmmss"), F.lit("00dBZ.cmax.h5")))
        .otherwise(F.concat(F.lit("T_PABV22_C_LZIB_"), as_("yyyyMMddHHmmss"), F.lit(".hdf")))
    )
    return views.stamped_events(spark, sf_dir).select("event_id", "source", name.alias("name"))


@query(
    "f7_stamp_from_filename",
    f"WITH {NAMED} SELECT event_id, source, name, CASE WHEN name <> 'broken.bin' THEN want END AS ts14 FROM named",
)
def f7_stamp_from_filename(spark, sf_dir):
    return named(spark, sf_dir).withColumn("ts14", T.stamp_from_filename(F.col("name"), F.col("source")))


@query(
    "p15_product_of_filename",
    f"""WITH {NAMED} SELECT CASE WHEN contains(name,'dmax') THEN 'dmax' ELSE 'UNKNOWN' END AS product, count(*) AS files,
  CAST(count_if(starts_with(name,'composite_dmax')) AS BIGINT) AS with_prefix FROM named GROUP BY ALL""",
)
def p15_product_of_filename(spark, sf_dir):
    from ..functions.attrs import product_of_filename

    return named(spark, sf_dir).groupBy(product_of_filename(F.col("name")).alias("product")).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.startswith("name", F.lit("composite_dmax"))).alias("with_prefix")
    )


@query(
    "p10_time_range",
    f"""WITH {SPELLED} SELECT source, text FROM spelled WHERE kind <= 3 AND ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:30:00'""",
)
def p10_time_range(spark, sf_dir):
    start, end = C.period(now(), "2024-01-10 06:00", "2024-01-12 18:30")
    parsed = spelled(spark, sf_dir).withColumn("ts", T.parse_timestamp(F.col("text")))
    return C.in_period(parsed, start, end).select("source", "text")


@query(
    "p10_last_hours",
    f"""WITH {ctes.CATALOG} SELECT source, ts_raw FROM catalog WHERE ts BETWEEN TIMESTAMP '{NOW}' - INTERVAL 36 HOUR AND TIMESTAMP '{NOW}'""",
)
def p10_last_hours(spark, sf_dir):
    start, end = C.period(now(), hours=36)
    return C.in_period(views.scan_catalog(spark, sf_dir), start, end).select("source", "ts_raw")


@query(
    "k1_newest_stamps",
    f"WITH {ctes.CATALOG} SELECT DISTINCT strftime(ts,'{FMT}') AS ts FROM catalog ORDER BY ts DESC LIMIT 20",
)
def k1_newest_stamps(spark, sf_dir):
    return C.newest(views.scan_catalog(spark, sf_dir), 20).select(minute_text("ts").alias("ts"))


@query(
    "k3_backload_counts",
    f"""WITH {ctes.CATALOG}, s AS (SELECT source, min(ts) AS a, max(ts) AS b FROM catalog GROUP BY source)
SELECT source, least(CAST(epoch(b) - epoch(a) AS BIGINT) // 300, 100) AS capped, CAST(epoch(b) - epoch(a) AS BIGINT) // 300 + 1 AS uncapped FROM s""",
)
def k3_backload_counts(spark, sf_dir):
    span = views.scan_catalog(spark, sf_dir).groupBy("source").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    a, b = F.col("a"), F.col("b")
    return span.select("source", C.backload_count(a, b, BACKLOAD_CAP).alias("capped"), C.backload_count(a, b, None, True).alias("uncapped"))


# --- alignment ------------------------------------------------------------------------------------


@query(
    "j1_tolerance_match",
    f"""WITH {ctes.nearest(2)} SELECT strftime(s.candidate,'{FMT}') AS candidate, s.n AS n_sources,
 string_agg(source || '=' || strftime(nearest.ts,'{FMT}'), ',' ORDER BY source) AS scans
 FROM slots s JOIN nearest USING (candidate) WHERE s.n >= 3 GROUP BY ALL""",
)
def j1_tolerance_match(spark, sf_dir):
    """Every matched candidate with the scan used of each source (quorum three)."""
    slots = align.matched_slots(align.nearest_per_candidate(views.scan_catalog(spark, sf_dir)), 6, 3)
    entry = lambda e: F.concat(e["key"], F.lit("="), minute_text(e["value"]))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("scans"), entry)), ",")
    return slots.select(minute_text("candidate").alias("candidate"), "n_sources", listed.alias("scans"))


@query(
    "k2_newest_matches",
    f"WITH {ctes.nearest(2)} SELECT strftime(candidate,'{FMT}') AS candidate, n AS n_sources FROM slots WHERE n >= 3 ORDER BY candidate DESC LIMIT 6",
)
def k2_newest_matches(spark, sf_dir):
    found = align.common_slots(views.scan_catalog(spark, sf_dir), 6, 2, min_sources=3)
    return found.select(minute_text("candidate").alias("candidate"), "n_sources")


@query(
    "w4_nearest_scan",
    f"""WITH {ctes.nearest(2)} SELECT strftime(candidate,'{FMT}') AS candidate, source, CAST(gap AS INT) AS gap_minutes, strftime(ts,'{FMT}') AS ts FROM nearest""",
)
def w4_nearest_scan(spark, sf_dir):
    """Nearest scan per candidate and source, candidates being the minutes that have a scan."""
    near = align.nearest_per_candidate(views.scan_catalog(spark, sf_dir))
    real = views.scan_catalog(spark, sf_dir).select(F.col("ts").alias("candidate")).distinct()
    return near.join(real, "candidate", "left_semi").select(
        minute_text("candidate").alias("candidate"), "source", "gap_minutes", minute_text("ts").alias("ts")
    )


@query(
    "j2_latest_common",
    f"""WITH {ctes.STAMPED}, scans AS (SELECT DISTINCT source, date_trunc('second', instant) AS ts FROM stamped), cand AS (SELECT DISTINCT ts AS candidate FROM scans),
near AS (SELECT candidate, source, arg_min(ts, (abs(epoch(ts) - epoch(candidate)), ts)) AS ts FROM cand JOIN scans
   ON ts BETWEEN candidate - INTERVAL 10 MINUTE AND candidate + INTERVAL 10 MINUTE GROUP BY ALL),
ok AS (SELECT candidate FROM near WHERE source IN ('dwd','shmu') GROUP BY candidate HAVING count(DISTINCT source) = 2)
SELECT strftime(candidate,'%Y%m%d%H%M%S') AS candidate, string_agg(source || '=' || strftime(ts,'%Y%m%d%H%M%S'), ',' ORDER BY source) AS scans
 FROM near WHERE candidate = (SELECT max(candidate) FROM ok) GROUP BY candidate""",
)
def j2_latest_common(spark, sf_dir):
    """Newest instant, at full seconds, with scans of two required services within ten minutes."""
    scans = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("second", "instant").alias("ts"))
    entry = lambda e: F.concat(e["key"], F.lit("="), T.stamp(e["value"]))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("scans"), entry)), ",")
    return align.latest_common(scans, ["dwd", "shmu"], 10).select(T.stamp("candidate").alias("candidate"), listed.alias("scans"))


@query(
    "u4_required_subset",
    f"""WITH {ctes.nearest(5)}, g AS (SELECT candidate, list_sort(list(DISTINCT source)) AS have FROM nearest GROUP BY candidate)
SELECT strftime(candidate,'{FMT}') AS candidate, array_to_string(have, ',') AS have FROM g WHERE list_has_all(have, ['chmi','imgw'])""",
)
def u4_required_subset(spark, sf_dir):
    catalog = views.scan_catalog(spark, sf_dir)
    slots = align.matched_slots(align.nearest_per_candidate(catalog, 5), 6, 1)
    have = F.map_keys("scans")
    need = F.array(F.lit("chmi"), F.lit("imgw"))
    return slots.where(F.size(F.array_except(need, have)) == 0).select(
        minute_text("candidate").alias("candidate"), F.array_join(F.array_sort(have), ",").alias("have")
    )


@query(
    "j3_exact_slots",
    f"""WITH {ctes.STAMPED}, s AS (SELECT DISTINCT source, date_trunc('hour', instant) AS ts FROM stamped WHERE source <> 'arso')
SELECT strftime(ts,'{FMT}') AS ts, count(*) AS n_sources FROM s WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 00:00:00' GROUP BY ts HAVING count(*) = 5""",
)
def j3_exact_slots(spark, sf_dir):
    """Hourly slots that all archived sources have (the one without an archive takes no part)."""
    hourly = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("hour", "instant").alias("ts"))
    found = align.backload_slots(hourly, SOURCE_NAMES, now("2024-01-05 00:00:00"), now("2024-01-25 00:00:00"))
    return found.select(minute_text("ts").alias("ts"), "n_sources")


@query(
    "k4_replay_order",
    f"""WITH {ctes.STAMPED}, s AS (SELECT DISTINCT source, date_trunc('hour', instant) AS ts FROM stamped WHERE source IN ('dwd','shmu','chmi')), k AS (
SELECT ts FROM s GROUP BY ts HAVING count(*) = 3) SELECT strftime(ts,'{FMT}') AS ts, strftime(lag(ts) OVER (ORDER BY ts),'{FMT}') AS previous FROM k""",
)
def k4_replay_order(spark, sf_dir):
    """Exact slots in ascending order, each with the one replayed before it."""
    from ..operators.sequence import steps

    hourly = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("hour", "instant").alias("ts"))
    slots = align.exact_slots(hourly, ["dwd", "shmu", "chmi"]).withColumn("_all", F.lit(1))
    pairs = steps(slots, "_all").select(F.col("start"), F.col("end").alias("ts"))
    return slots.join(pairs, "ts", "left").orderBy("ts").select(minute_text("ts").alias("ts"), minute_text("start").alias("previous"))


@query(
    "j4_two_service_sync",
    f"""WITH {ctes.STAMPED}, a AS (SELECT DISTINCT strftime(ts - to_minutes(CAST(minute(ts) % 5 AS INT)),'%Y%m%d%H%M00') AS ts14 FROM stamped WHERE source = 'shmu'),
b AS (SELECT DISTINCT strftime(ts - to_minutes(CAST(minute(ts) % 5 AS INT)),'{FMT}') AS ts12 FROM stamped WHERE source = 'dwd')
SELECT ts12, ts14 FROM a JOIN b ON substr(ts14, 1, 12) = ts12""",
)
def j4_two_service_sync(spark, sf_dir):
    slots = views.stamped_events(spark, sf_dir).withColumn("slot", T.floor_to_interval(F.col("ts"), 5))
    left = slots.where("source = 'shmu'").select(T.stamp(F.col("slot")).alias("ts14")).distinct()
    right = slots.where("source = 'dwd'").select(T.stamp(F.col("slot"), T.SHORT).alias("ts12")).distinct()
    return align.synchronised_pairs(left, right)


@query(
    "g8_key_conversion",
    f"WITH {ctes.CATALOG} SELECT source, ts_raw, replace(ts_raw,'_','')[1:12] AS short_key, substr(strftime(ts,'{FMT}'),1,8) || '_' || substr(strftime(ts,'{FMT}'),9,4) AS underscore_key FROM catalog",
)
def g8_key_conversion(spark, sf_dir):
    short = T.normalize_timestamp(F.col("ts_raw"), 12)
    return views.scan_catalog(spark, sf_dir).select(
        "source",
        "ts_raw",
        short.alias("short_key"),
        F.concat_ws("_", F.substring(short, 1, 8), F.substring(short, 9, 4)).alias("underscore_key"),
    )


STORED = """stored AS (SELECT DISTINCT source, CASE event_id % 4 WHEN 0 THEN ts_raw WHEN 1 THEN replace(ts_raw,'_','')
  WHEN 2 THEN substr(replace(ts_raw,'_',''),1,12) ELSE substr(replace(ts_raw,'_',''),1,12) || '00' END AS key FROM stamped WHERE event_type IN ('view','click'))"""


def stored_keys(spark, sf_dir):
    """Stamps of a store that was filled under four spellings over time."""
    kind, raw = F.col("event_id") % 4, F.col("ts_raw")
    plain = F.replace(raw, F.lit("_"), F.lit(""))
    short = F.substring(plain, 1, 12)
    key = F.when(kind == 0, raw).when(kind == 1, plain).when(kind == 2, short).otherwise(F.concat(short, F.lit("00")))
    rows = views.stamped_events(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    return rows.select("source", key.alias("ts_raw")).distinct()


@query(
    "j10_not_yet_stored",
    f"""WITH {ctes.CATALOG}, {STORED} SELECT source, ts_raw FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.source = c.source AND s.key IN
 (c.ts_raw, replace(c.ts_raw,'_',''), substr(replace(c.ts_raw,'_',''),1,12), substr(replace(c.ts_raw,'_',''),1,12) || '00'))""",
)
def j10_not_yet_stored(spark, sf_dir):
    candidates = views.scan_catalog(spark, sf_dir).select("source", "ts_raw")
    return align.known(candidates, stored_keys(spark, sf_dir))


@query(
    "j11_existing_candidates",
    f"""WITH {ctes.CATALOG}, n AS (SELECT source, max(ts) AS now FROM catalog GROUP BY source),
c AS (SELECT DISTINCT source, now - to_minutes(CAST(i AS INT)) AS ts FROM n, range(2000) r(i)),
e AS (SELECT source, ts, row_number() OVER (PARTITION BY source ORDER BY ts DESC) AS rank FROM c WHERE EXISTS (SELECT 1 FROM catalog k WHERE k.source = c.source AND k.ts = c.ts))
SELECT source, strftime(ts,'{FMT}') AS ts, CAST(rank AS INT) AS rank FROM e WHERE rank <= 8""",
)
def j11_existing_candidates(spark, sf_dir):
    catalog = views.scan_catalog(spark, sf_dir)
    newest = catalog.groupBy("source").agg(F.max("ts").alias("now"))
    back = F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda i: F.col("now") - F.make_dt_interval(mins=i))
    candidates = newest.select("source", F.explode(back).alias("ts"))
    return align.existing_newest(candidates, catalog, 8).select("source", minute_text("ts").alias("ts"), "rank")


@query(
    "j12_latest_only_source",
    f"""WITH {ctes.CATALOG}, l AS (SELECT max(strftime(ts,'%Y%m%d%H%M%S')) AS ts14 FROM catalog WHERE source = 'arso')
SELECT ts14 FROM l WHERE substr(ts14,1,12) IN (SELECT DISTINCT strftime(ts + to_minutes(CAST(d AS INT)),'{FMT}') FROM catalog, range(-60, 61) r(d) WHERE source <> 'arso')""",
)
def j12_latest_only_source(spark, sf_dir):
    catalog = views.scan_catalog(spark, sf_dir).withColumn("ts14", T.stamp(F.col("ts")))
    around = F.transform(F.sequence(F.lit(-60), F.lit(60)), lambda d: F.col("ts") + F.make_dt_interval(mins=d))
    minutes = catalog.where("source <> 'arso'").select("ts").distinct().select(F.explode(around).alias("t")).distinct()
    requested = minutes.select(T.stamp(F.col("t")).alias("ts14"))
    return align.latest_only(catalog, requested)


@query(
    "j13_fresh_before_stored",
    f"""WITH {ctes.STAMPED}, fresh AS (SELECT source, ts, min(event_id) AS file FROM stamped WHERE event_type IN ('click','purchase') GROUP BY ALL),
stored AS (SELECT source, ts, min(event_id) AS file FROM stamped WHERE event_type IN ('view','signup','click') GROUP BY ALL)
SELECT coalesce(f.source, s.source) AS source, strftime(coalesce(f.ts, s.ts),'{FMT}') AS ts, CASE WHEN f.file IS NULL THEN 'stored' ELSE 'fresh' END AS origin, coalesce(f.file, s.file) AS file
 FROM fresh f FULL JOIN stored s ON f.source = s.source AND f.ts = s.ts""",
)
def j13_fresh_before_stored(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir)
    part = lambda kinds: rows.where(F.col("event_type").isin(*kinds)).groupBy("source", "ts").agg(F.min("event_id").alias("file"))
    both = align.prefer_fresh(part(("click", "purchase")), part(("view", "signup", "click")))
    return both.select("source", minute_text("ts").alias("ts"), "origin", "file")


@query(
    "w9_first_seen",
    f"WITH {ctes.STAMPED} SELECT source, strftime(ts,'{FMT}') AS ts, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM stamped GROUP BY ALL",
)
def w9_first_seen(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir).select("source", "ts", "event_id", "event_type")
    return align.first_seen(rows, ["source", "ts"], ["event_id"]).withColumn("ts", minute_text("ts"))


@query(
    "j17_work_list",
    f"""WITH {ctes.CATALOG}, t AS (SELECT DISTINCT ts FROM catalog) SELECT strftime(ts,'{FMT}') AS ts, product FROM t, (SELECT unnest(['zmax','cappi2km','etop','pac01']) AS product)""",
)
def j17_work_list(spark, sf_dir):
    slots = views.scan_catalog(spark, sf_dir).select("ts").distinct()
    return align.work_list(slots, ["zmax", "cappi2km", "etop", "pac01"]).select(minute_text("ts").alias("ts"), "product")


@query(
    "j18_missing_sources",
    f"""WITH {ctes.STAMPED}, h AS (SELECT DISTINCT date_trunc('hour', instant) AS ts, source FROM stamped WHERE source <> 'arso'),
g AS (SELECT DISTINCT ts, s AS source FROM h, (SELECT unnest(['dwd','shmu','chmi','omsz','imgw']) AS s))
SELECT strftime(ts,'{FMT}') AS ts, source FROM (SELECT * FROM g EXCEPT SELECT * FROM h)""",
)
def j18_missing_sources(spark, sf_dir):
    hourly = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("hour", "instant").alias("ts"))
    return align.missing_sources(hourly, CORE_SOURCES).select(minute_text("ts").alias("ts"), "source")


# --- sets -----------------------------------------------------------------------------------------


@query(
    "u1_common_instants",
    f"""WITH {ctes.STAMPED}, h AS (SELECT DISTINCT source, date_trunc('hour', instant) AS ts FROM stamped)
SELECT strftime(ts,'{FMT}') AS ts FROM h WHERE source IN ('dwd','shmu','chmi') GROUP BY ts HAVING count(*) = 3""",
)
def u1_common_instants(spark, sf_dir):
    hourly = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("hour", "instant").alias("ts"))
    return health.common_instants(hourly, ["dwd", "shmu", "chmi"]).select(minute_text("ts").alias("ts"))


@query(
    "u2_union_of_stamps",
    f"""WITH {ctes.STAMPED} SELECT source, strftime(ts,'{FMT}') AS ts FROM stamped WHERE event_type = 'view' UNION SELECT source, strftime(ts,'{FMT}') FROM stamped WHERE event_type = 'click'""",
)
def u2_union_of_stamps(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir)
    part = lambda kind: rows.where(F.col("event_type") == kind).select("source", "ts")
    return part("view").unionByName(part("click")).distinct().select("source", minute_text("ts").alias("ts"))


@query(
    "u3_not_in_other_tier",
    f"""WITH {ctes.STAMPED} SELECT source, strftime(ts,'{FMT}') AS ts FROM stamped WHERE event_type = 'view' EXCEPT SELECT source, strftime(ts,'{FMT}') FROM stamped WHERE event_type = 'click'""",
)
def u3_not_in_other_tier(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir)
    part = lambda kind: rows.where(F.col("event_type") == kind).select("source", "ts")
    return part("view").subtract(part("click")).select("source", minute_text("ts").alias("ts"))


@query(
    "u5_concatenate",
    f"""WITH {ctes.STAMPED} SELECT source, origin, count(*) AS scans FROM (SELECT source, 'fresh' AS origin FROM stamped WHERE event_type IN ('view','error')
 UNION ALL SELECT source, 'stored' FROM stamped WHERE event_type IN ('click','error')) GROUP BY ALL""",
)
def u5_concatenate(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir)
    part = lambda origin, kinds: rows.where(F.col("event_type").isin(*kinds)).select("source", F.lit(origin).alias("origin"))
    both = part("fresh", ("view", "error")).unionByName(part("stored", ("click", "error")))
    return both.groupBy("source", "origin").agg(F.count(F.lit(1)).alias("scans"))


# --- availability ---------------------------------------------------------------------------------

AVAILABILITY = f"""{ctes.CATALOG}, src AS (SELECT unnest({ctes.NAMES}) AS source),
newest AS (SELECT s.source, max(c.ts) AS newest FROM src s LEFT JOIN catalog c ON c.source = s.source AND NOT (c.source = 'omsz') GROUP BY s.source),
availability AS (SELECT source, source <> 'arso' AS is_core, newest IS NOT NULL AND epoch(TIMESTAMP '{NOW}') - epoch(newest) <= 1800 AS available,
  CASE WHEN newest IS NULL THEN 'no data available' WHEN epoch(TIMESTAMP '{NOW}') - epoch(newest) > 1800
   THEN 'stale data (age: ' || CAST(CAST(epoch(TIMESTAMP '{NOW}') - epoch(newest) AS BIGINT) // 60 AS VARCHAR) || ' min, max: 30 min)' END AS reason,
  CAST(epoch(TIMESTAMP '{NOW}') - epoch(newest) AS BIGINT) // 60 AS age_minutes FROM newest)"""


def availability(spark, sf_dir):
    """One service is left out, so that it counts as having no data."""
    catalog = views.scan_catalog(spark, sf_dir).where("source <> 'omsz'").select("source", F.col("ts_raw").alias("timestamp"))
    return health.outages(catalog, now(), SOURCE_NAMES)


@query("a13_outages", f"WITH {AVAILABILITY} SELECT source, is_core, available, reason, coalesce(age_minutes, -1) AS age_minutes FROM availability")
def a13_outages(spark, sf_dir):
    return availability(spark, sf_dir).drop("newest").na.fill(-1, ["age_minutes"])


@query(
    "a14_core_counts",
    f"""WITH {AVAILABILITY} SELECT CAST(count_if(is_core AND available) AS BIGINT) AS available_core, CAST(count_if(is_core) AS BIGINT) AS total_core,
 count_if(is_core AND available) >= 3 AS enough FROM availability""",
)
def a14_core_counts(spark, sf_dir):
    return health.core_counts(availability(spark, sf_dir))


@query(
    "p12_available_sources",
    f"WITH {AVAILABILITY} SELECT source, count(*) AS scans FROM catalog WHERE source IN (SELECT source FROM availability WHERE available) GROUP BY source",
)
def p12_available_sources(spark, sf_dir):
    scans = views.scan_catalog(spark, sf_dir)
    return health.only_available(scans, availability(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("scans"))


@query(
    "w1_intervals",
    f"WITH {ctes.STEPS} SELECT source, strftime(a,'{FMT}') AS start, strftime(b,'{FMT}') AS \"end\", round(minutes, 6) AS minutes FROM gaps",
)
def w1_intervals(spark, sf_dir):
    found = health.intervals(views.scan_catalog(spark, sf_dir))
    return found.select("source", minute_text("start").alias("start"), minute_text("end").alias("end"), r6("minutes").alias("minutes"))


@query(
    "w2_gaps",
    f"WITH {ctes.STEPS} SELECT source, strftime(a,'{FMT}') AS start, strftime(b,'{FMT}') AS \"end\", round(minutes, 6) AS minutes FROM gaps WHERE minutes > 10",
)
def w2_gaps(spark, sf_dir):
    found = health.gaps(views.scan_catalog(spark, sf_dir))
    return found.select("source", minute_text("start").alias("start"), minute_text("end").alias("end"), r6("minutes").alias("minutes"))


@query(
    "w3_longest_gaps",
    f"""WITH {ctes.STEPS}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY minutes DESC, a) AS rank, count(*) OVER (PARTITION BY source) AS n FROM gaps WHERE minutes > 10)
SELECT source, strftime(a,'{FMT}') AS start, round(minutes, 6) AS minutes, CAST(rank AS INT) AS rank, greatest(n - 10, 0) AS more_gaps FROM r WHERE rank <= 10""",
)
def w3_longest_gaps(spark, sf_dir):
    found = health.longest_gaps(views.scan_catalog(spark, sf_dir))
    return found.select("source", minute_text("start").alias("start"), r6("minutes").alias("minutes"), "rank", "more_gaps")


@query(
    "k5_ordered_gaps",
    f"""WITH {ctes.STEPS}, t AS (SELECT source, count(*) AS gaps, round(sum(minutes), 6) AS minutes FROM gaps WHERE minutes > 10 GROUP BY source)
SELECT source, gaps, minutes FROM t ORDER BY minutes DESC, source""",
)
def k5_ordered_gaps(spark, sf_dir):
    found = health.gaps(views.scan_catalog(spark, sf_dir)).groupBy("source").agg(
        F.count(F.lit(1)).alias("gaps"), r6(F.sum("minutes")).alias("minutes")
    )
    return found.orderBy(F.desc("minutes"), "source")


PROFILE = f"""{ctes.STEPS}, p AS (SELECT source, count(*) AS n, min(b) AS oldest, max(b) AS newest FROM steps GROUP BY source),
i AS (SELECT source, min(minutes) AS mn, avg(minutes) AS av, max(minutes) AS mx FROM gaps GROUP BY source),
profile AS (SELECT p.source, n AS count, CAST(trunc(date_diff('second', oldest, newest) / 3600.0::DOUBLE * 12) AS BIGINT) AS expected,
  coalesce(mn, 0) AS min_minutes, coalesce(av, 0) AS avg_minutes, coalesce(mx, 0) AS max_minutes,
  date_diff('second', oldest, newest) / 3600.0::DOUBLE AS total_hours FROM p LEFT JOIN i USING (source))"""


@query(
    "a18_availability_profile",
    f"""WITH {PROFILE} SELECT source, count, expected, round(CASE WHEN expected > 0 THEN count * 100.0::DOUBLE / expected ELSE 0 END, 6) AS uptime_percent,
 round(min_minutes, 6) AS min_minutes, round(avg_minutes, 6) AS avg_minutes, round(max_minutes, 6) AS max_minutes, round(total_hours, 6) AS total_hours FROM profile""",
)
def a18_availability_profile(spark, sf_dir):
    p = health.availability_profile(views.scan_catalog(spark, sf_dir)).drop("oldest", "newest")
    return p.select("source", "count", "expected", *(r6(c).alias(c) for c in p.columns[3:]))


@query(
    "a19_composite_potential",
    f"""WITH {ctes.STAMPED}, h AS (SELECT DISTINCT source, date_trunc('hour', instant) AS ts FROM stamped WHERE source IN ('dwd','shmu','chmi')),
k AS (SELECT count(*) AS common FROM (SELECT ts FROM h GROUP BY ts HAVING count(*) = 3)), d AS (SELECT count(*) AS possible FROM h WHERE source = 'dwd')
SELECT common, possible, 3 AS sources_with_data, round(common * 100.0::DOUBLE / possible, 6) AS potential_percent FROM k, d""",
)
def a19_composite_potential(spark, sf_dir):
    hourly = views.stamped_events(spark, sf_dir).select("source", F.date_trunc("hour", "instant").alias("ts"))
    found = health.composite_potential(hourly, ["dwd", "shmu", "chmi"])
    return found.withColumn("potential_percent", r6("potential_percent"))


@query(
    "a22_health_classes",
    f"""WITH {PROFILE}, u AS (SELECT source, CASE WHEN expected > 0 THEN count * 100.0::DOUBLE / expected ELSE 0 END AS up, avg_minutes AS av FROM profile),
h AS (SELECT source, count_if(event_type = 'view') * 100.0::DOUBLE / count(*) AS hit FROM stamped GROUP BY source)
SELECT u.source, CASE WHEN up >= 100 THEN 'perfect' WHEN up >= 90 THEN 'good' WHEN up >= 80 THEN 'warning' ELSE 'critical' END AS uptime,
 CASE WHEN av <= 5 THEN 'normal' WHEN av <= 6 THEN 'acceptable' WHEN av <= 10 THEN 'warning' ELSE 'gap' END AS interval_class,
 CASE WHEN up > 95 THEN 'excellent' WHEN up >= 90 THEN 'good' WHEN up >= 80 THEN 'fair' ELSE 'poor' END AS potential,
 CASE WHEN hit > 85 THEN 'good' WHEN hit >= 70 THEN 'warning' ELSE 'critical' END AS hit_rate FROM u JOIN h USING (source)""",
)
def a22_health_classes(spark, sf_dir):
    profile = health.availability_profile(views.scan_catalog(spark, sf_dir))
    hits = views.stamped_events(spark, sf_dir).groupBy("source").agg(
        (F.count_if(F.col("event_type") == "view") * 100.0 / F.count(F.lit(1))).alias("hit")
    )
    up = F.col("uptime_percent")
    return profile.join(hits, "source").select(
        "source",
        health.uptime_status(up).alias("uptime"),
        health.interval_status(F.col("avg_minutes")).alias("interval_class"),
        health.potential_status(up).alias("potential"),
        health.hit_rate_status(F.col("hit")).alias("hit_rate"),
    )


@query(
    "w5_failure_streaks",
    f"""WITH {ctes.ATTEMPTS} SELECT key, event_id, CAST(streak AS BIGINT) AS streak,
 'Source ' || key || ' has failed ' || CAST(streak AS BIGINT) || ' consecutive times' AS message FROM streaks WHERE streak >= 3""",
)
def w5_failure_streaks(spark, sf_dir):
    return health.streak_alerts(views.attempts(spark, sf_dir), "key", "ts", "event_id").select("key", "event_id", "streak", "message")


@query(
    "w5_crowded_hour",
    """WITH a AS (SELECT CASE WHEN event_id % 10 <> 0 THEN 0 ELSE user_id + 1 END AS key, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(event_id * 13 % 3600 // 9 AS INT)) AS ts, event_id, event_type <> 'error' AS ok FROM events),
i AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, event_id) AS isl, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS n FROM a)
SELECT key, event_id, n, CASE WHEN ok THEN 0 ELSE CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY key, isl ORDER BY ts, event_id) AS BIGINT) END AS streak FROM i""",
)
def w5_crowded_hour(spark, sf_dir):
    """Streaks and running numbers where nine tenths of the attempts are of one key in ten minutes: chunks of rows, not of time."""
    e = F.col("event_id")
    rows = views.attempts(spark, sf_dir).select(
        F.when(e % 10 != 0, F.lit(0)).otherwise(F.col("key") + 1).alias("key"), F.timestamp_seconds(F.lit(1704067200) + F.floor(e * 13 % 3600 / 9)).alias("ts"), "event_id", "ok"
    )
    chunked = sequence.range_chunks(rows, ["key", "ts", "event_id"], 2000)
    found = sequence.failure_streaks(chunked, "key", "ts", "event_id", "ok").select("key", "event_id", "streak")
    return found.join(sequence.number_rows(chunked, ["key"], "ts", ["event_id"]).select("event_id", "n"), "event_id").select("key", "event_id", "n", "streak")


@query(
    "w5_current_failures",
    f"""WITH {ctes.ATTEMPTS}, l AS (SELECT key, arg_max(streak, (ts, event_id)) AS failures FROM streaks GROUP BY key) SELECT key, CAST(failures AS BIGINT) AS failures FROM l""",
)
def w5_current_failures(spark, sf_dir):
    return health.current_failures(views.attempts(spark, sf_dir), "key", "ts", "event_id")


@query(
    "w8_newest_per_source",
    f"WITH {ctes.STAMPED} SELECT source, strftime(max(ts),'{FMT}') AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM stamped GROUP BY source",
)
def w8_newest_per_source(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir).select("source", "ts", "event_id")
    return health.newest_per_source(rows, ["event_id"]).withColumn("ts", minute_text("ts"))


# --- quorum ---------------------------------------------------------------------------------------

QUORUM = f"""{ctes.STAMPED}, s AS (SELECT date_trunc('hour', instant) AS slot, source, min(event_id) AS id FROM stamped GROUP BY ALL),
flags AS (SELECT *, epoch(slot) // 3600 % 9 = 0 AS ex, id % 5 <> 0 AS av, id % 7 <> 0 AS me, id % 4 <> 0 AS de FROM s),
q AS (SELECT slot, bool_or(ex) AS ex, CAST(count_if(av) AS BIGINT) AS usable, CAST(count_if(av AND me) AS BIGINT) AS described, CAST(count_if(av AND me AND de) AS BIGINT) AS processed FROM flags GROUP BY slot),
quorum AS (SELECT *, CASE WHEN ex THEN 'already_exists' WHEN usable < 3 OR described < 3 THEN 'insufficient_sources' WHEN processed < 3 THEN 'processing_failed' END AS reason FROM q)"""


def quorum(spark, sf_dir):
    hourly = views.stamped_events(spark, sf_dir).groupBy(F.date_trunc("hour", "instant").alias("slot"), "source").agg(F.min("event_id").alias("id"))
    i = F.col("id")
    flags = hourly.select(
        "slot",
        "source",
        (F.floor(F.unix_timestamp("slot") / 3600) % 9 == 0).alias("exists"),
        (i % 5 != 0).alias("available"),
        (i % 7 != 0).alias("has_metadata"),
        (i % 4 != 0).alias("decoded"),
    )
    return health.slot_quorum(flags)


@query("p25_slot_quorum", f"WITH {QUORUM} SELECT strftime(slot,'{FMT}') AS slot, usable, described, processed, reason FROM quorum")
def p25_slot_quorum(spark, sf_dir):
    return quorum(spark, sf_dir).withColumn("slot", minute_text("slot"))


@query(
    "a20_skip_summary",
    f"""WITH {QUORUM}, r AS (SELECT reason, strftime(slot,'{FMT}') AS slot, row_number() OVER (PARTITION BY reason ORDER BY slot) AS n FROM quorum WHERE reason IS NOT NULL)
SELECT reason, count(*) AS slots, string_agg(CASE WHEN n <= 3 THEN slot END, ',' ORDER BY slot) AS first_slots FROM r GROUP BY reason""",
)
def a20_skip_summary(spark, sf_dir):
    found = health.skip_summary(quorum(spark, sf_dir).withColumn("slot", minute_text("slot")))
    return found.withColumn("first_slots", F.array_join("first_slots", ","))


@query(
    "p26_backload_quorum",
    f"""WITH {ctes.STAMPED}, s AS (SELECT date_trunc('hour', instant) AS slot, source, min(event_id) AS id FROM stamped WHERE source <> 'arso' GROUP BY ALL),
q AS (SELECT slot, count(*) AS n_sources, CAST(count_if(id % 3 <> 0) AS BIGINT) AS extents, CAST(count_if(id % 3 <> 0 AND id % 5 <> 0) AS BIGINT) AS merged FROM s GROUP BY slot)
SELECT strftime(slot,'{FMT}') AS slot, n_sources, extents, merged FROM q WHERE n_sources = 5 AND extents >= 2 AND merged >= 2""",
)
def p26_backload_quorum(spark, sf_dir):
    hourly = views.stamped_events(spark, sf_dir).groupBy(F.date_trunc("hour", "instant").alias("slot"), "source").agg(F.min("event_id").alias("id"))
    flags = hourly.select("slot", "source", (F.col("id") % 3 != 0).alias("has_extent"), (F.col("id") % 5 != 0).alias("merged"))
    return health.backload_quorum(flags, SOURCE_NAMES).withColumn("slot", minute_text("slot"))


@query(
    "a21_downloaded_and_stored",
    f"""WITH {ctes.STAMPED}, g AS (SELECT source, ts, bool_or(event_type IN ('view','click')) AS down FROM stamped GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC) AS n FROM g)
SELECT source, count(*) AS stamps, CAST(count_if(down) AS BIGINT) AS downloaded, CAST(count_if(NOT down) AS BIGINT) AS stored,
 string_agg(CASE WHEN n <= 3 THEN strftime(ts,'{FMT}') END, ',' ORDER BY ts DESC) AS recent FROM r GROUP BY source""",
)
def a21_downloaded_and_stored(spark, sf_dir):
    rows = views.stamped_events(spark, sf_dir).select("source", "ts", F.col("event_type").isin("view", "click").alias("downloaded"))
    found = health.stored_counts(rows)
    return found.withColumn("recent", F.array_join(F.transform("recent", minute_text), ","))


FALLBACK_LADDER = f"""WITH {ctes.nearest(2)}, av AS (SELECT DISTINCT source FROM catalog), k AS (SELECT count(*) AS every FROM av),
o AS (SELECT candidate, n, CASE WHEN n >= every THEN 1 END AS r1, CASE WHEN n >= every - 1 THEN 2 END AS r2, CASE WHEN n >= 3 THEN 3 END AS r3 FROM slots, k),
p AS (SELECT candidate, n, unnest([r1, r2, r3]) AS rung FROM o), q AS (SELECT * FROM p WHERE rung IS NOT NULL),
b AS (SELECT min(rung) AS best FROM q), f AS (SELECT rung, candidate, n FROM q, b WHERE rung = best ORDER BY candidate DESC LIMIT 6)
SELECT rung, strftime(candidate,'{FMT}') AS candidate, n AS n_sources FROM f"""


@query("t5_fallback_ladder", FALLBACK_LADDER)
def t5_fallback_ladder(spark, sf_dir):
    catalog = views.scan_catalog(spark, sf_dir)
    found = align.ladder_slots(catalog, catalog.select("source").distinct())
    return found.select("rung", minute_text("candidate").alias("candidate"), "n_sources")


@query(
    "t9_unmatched_latest_only",
    f"""WITH {ctes.nearest(2)}, used AS (SELECT ts FROM nearest JOIN slots USING (candidate) WHERE n >= 3 AND source = 'arso')
SELECT strftime(ts,'{FMT}') AS ts, ts_raw FROM catalog WHERE source = 'arso' AND ts NOT IN (SELECT ts FROM used)""",
)
def t9_unmatched_latest_only(spark, sf_dir):
    """Scans of the archive-less source that no matched slot uses; they are published on their own."""
    catalog = views.scan_catalog(spark, sf_dir)
    slots = align.matched_slots(align.nearest_per_candidate(catalog), 6, 3)
    used = slots.select(F.try_element_at("scans", F.lit("arso")).alias("ts")).where("ts is not null").distinct()
    return catalog.where("source = 'arso'").join(used, "ts", "left_anti").select(minute_text("ts").alias("ts"), "ts_raw")

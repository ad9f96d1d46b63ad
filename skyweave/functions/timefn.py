"""Time stamps: parsing, normalising, slots, candidate slots, file-name stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL, SHORT, UNDERSCORE = "yyyyMMddHHmmss", "yyyyMMddHHmm", "yyyyMMdd_HHmm"


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Instant of a stamp: 14 digits, else 12 digits, else ``yyyyMMdd_HHmm``; null when none fits."""
    if fmt is not None:
        return F.try_to_timestamp(text, F.lit(fmt))
    return F.coalesce(
        *(F.try_to_timestamp(F.substring(text, 1, len(f)), F.lit(f)) for f in (FULL, SHORT, UNDERSCORE))
    )


def parse_minute(text: Column) -> Column:
    """Instant of the first 12 digits, underscores dropped; null when they do not parse."""
    return F.try_to_timestamp(normalize_timestamp(text, 12), F.lit(SHORT))


def normalize_timestamp(text: Column, length: int = 14) -> Column:
    """Stamp without underscores: 14 characters (a 12-digit one gets zero seconds) or the first 12."""
    digits = F.replace(text, F.lit("_"), F.lit(""))
    if length == 14:
        return F.substring(F.regexp_replace(digits, r"^(.{12})$", "$100"), 1, 14)
    if length == 12:
        return F.substring(digits, 1, 12)
    return digits


def stamp(ts: Column, fmt: str = FULL) -> Column:
    return F.date_format(ts, fmt)


def floor_to_interval(ts: Column, minutes: int = 5) -> Column:
    """Start of the slot inside the hour."""
    hour = F.date_trunc("hour", ts)
    return hour + F.make_dt_interval(mins=F.floor(F.minute(ts) / F.lit(minutes)).cast("int") * minutes)


def timestamp_candidates(
    now: Column, count: int, step: int = 5, delay: int = 15, fmt: str = SHORT, zone_hours: int = 0
) -> Column:
    """Array of candidate stamps, newest first: three times ``count`` steps back from ``now - delay``."""
    base = now - F.make_dt_interval(mins=F.lit(delay)) + F.make_dt_interval(hours=F.lit(zone_hours))
    back = F.sequence(F.lit(0), F.lit(3 * count - 1))
    return F.array_distinct(
        F.transform(back, lambda i: stamp(floor_to_interval(base - F.make_dt_interval(mins=i.cast("int") * step), step), fmt))
    )


def to_unix(text: Column, zone: str = "UTC") -> Column:
    """Unix seconds of a stamp that was written in ``zone``."""
    ts = parse_timestamp(text)
    return F.unix_timestamp(ts if zone == "UTC" else F.to_utc_timestamp(ts, zone))


def stamp_from_attrs(primary: Column, fallback: Column | None = None, date_key="startdate", time_key="starttime") -> Column:
    """14-digit stamp of an attribute pair; each half falls back to ``date`` / ``time`` of the second group."""

    def half(key: str, other: str) -> Column:
        parts = [F.try_element_at(primary, F.lit(key))]
        if fallback is not None:
            parts.append(F.try_element_at(fallback, F.lit(other)))
        return F.coalesce(*parts, F.lit(""))

    return normalize_timestamp(F.concat(half(date_key, "date"), half(time_key, "time")), 14)


def latest_stamp(ts_raw: Column, what_global: Column, now: Column) -> Column:
    """Stamp of a download from the moving "latest" address: from the attributes, to the minute."""
    date = F.try_element_at(what_global, F.lit("date"))
    time = F.try_element_at(what_global, F.lit("time"))
    inside = F.when(date.isNotNull() & time.isNotNull(), F.concat(date, F.substring(time, 1, 4), F.lit("00")))
    return F.when(ts_raw == "LATEST", F.coalesce(inside, stamp(now, "yyyyMMddHHmm'00'"))).otherwise(
        normalize_timestamp(ts_raw, 14)
    )


def stamp_from_filename(name: Column, source: Column | str) -> Column:
    """14-digit stamp held in a file name; the pattern depends on the source, null when it is not there."""
    underscore = F.regexp_extract(name, r"(\d{8})_(\d{4})", 0)
    short = F.regexp_extract(name, r"\d{12}", 0)
    minutes = F.coalesce(F.nullif(F.replace(underscore, F.lit("_"), F.lit("")), F.lit("")), F.nullif(short, F.lit("")))
    by_minute = F.concat(minutes, F.lit("00"))
    polish = F.nullif(F.regexp_extract(name, r"^(\d{14})00dBZ", 1), F.lit(""))
    full = F.nullif(F.regexp_extract(name, r"\d{14}", 0), F.lit(""))
    if isinstance(source, str):
        return by_minute if source in ("dwd", "omsz") else polish if source == "imgw" else full
    return F.when(source.isin("dwd", "omsz"), by_minute).when(source == "imgw", polish).otherwise(full)


def srd_stamp(parts: Column) -> Column:
    """Stamp of a text-grid header line ``time y m d H M``; null when fewer than five numbers."""
    number = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("int")
    return stamp(F.try_make_timestamp(number(1), number(2), number(3), number(4), number(5), F.lit(0)))


def known_spellings(text: Column) -> Column:
    """The spellings under which a store may already hold a stamp: as is, plain, 12 and 14 digits."""
    plain = F.replace(text, F.lit("_"), F.lit(""))
    short = F.substring(plain, 1, 12)
    full = F.when(F.length(plain) <= 12, F.concat(short, F.lit("00"))).otherwise(F.substring(plain, 1, 14))
    return F.array_distinct(F.array(text, plain, short, full))

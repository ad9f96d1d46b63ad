"""The catalog of scans: one row per landed or failed file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def result_rows(attempts: DataFrame, ok: Column, path: Column, url: Column, cached: Column, error: Column) -> DataFrame:
    """Catalog rows of a batch of fetch attempts; a failed one has an empty path and its error."""
    blank = F.lit("")
    return attempts.select(
        "source",
        "product",
        "timestamp",
        F.when(ok, path).otherwise(blank).alias("path"),
        F.when(ok, url).otherwise(blank).alias("url"),
        (ok & cached).alias("cached"),
        ok.alias("success"),
        F.when(~ok, error).alias("error"),
    )


def successes(catalog: DataFrame) -> DataFrame:
    return catalog.where("success")


def fetch_counts(catalog: DataFrame) -> DataFrame:
    """Rows, successes, of those already cached, and failures per source and product."""
    return catalog.groupBy("source", "product").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("fetched"),
        F.count_if(F.col("success") & F.col("cached")).alias("from_cache"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def in_period(catalog: DataFrame, start: Column, end: Column) -> DataFrame:
    """Rows of a period, both ends included; a stamp that did not parse is null and drops out."""
    return catalog.where(F.col("ts").between(start, end))


def period(now: Column, from_time: str | None = None, to_time: str | None = None, hours: int | None = None) -> tuple[Column, Column]:
    """Start and end of the wanted period: an explicit pair, the last hours, or the last half hour."""
    if from_time and to_time:
        fmt = "yyyy-MM-dd HH:mm"
        return F.to_timestamp(F.lit(from_time), fmt), F.to_timestamp(F.lit(to_time), fmt)
    minutes = hours * 60 if hours else 30
    return now - F.make_dt_interval(mins=F.lit(minutes)), now


def backload_count(start: Column, end: Column, cap: int | None = None, inclusive: bool = False) -> Column:
    """How many five-minute scans a backload asks for; one more for mosaics, which take both ends. ``cap`` is a wish of the
    caller: ``steps - cap`` scans are then left out, and are counted by a call without it."""
    steps = F.floor((F.unix_timestamp(end) - F.unix_timestamp(start)) / 300) + (1 if inclusive else 0)
    return steps if cap is None else F.least(steps, F.lit(cap))


def newest(catalog: DataFrame, count: int) -> DataFrame:
    """Distinct stamps, newest first."""
    return catalog.select("ts").distinct().orderBy(F.desc("ts")).limit(count)

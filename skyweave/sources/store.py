"""The store of decoded scans: keyed by (source, product, first twelve digits of the stamp), with a time to live."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import STORE_TTL_MINUTES

KEY = ["source", "product", "ts12"]


def keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts12", F.substring("timestamp", 1, 12))


def live(store: DataFrame, now: Column, ttl_minutes: int = STORE_TTL_MINUTES) -> DataFrame:
    return store.where(_age(now) <= ttl_minutes * 60)


def expired(store: DataFrame, now: Column, ttl_minutes: int = STORE_TTL_MINUTES) -> DataFrame:
    return store.where(F.col("cached_at").isNull() | (_age(now) > ttl_minutes * 60))


def _age(now: Column) -> Column:
    return F.unix_timestamp(now) - F.unix_timestamp("cached_at")


def upsert(store: DataFrame, incoming: DataFrame, now: Column, ttl_minutes: int = STORE_TTL_MINUTES, force: bool = False) -> DataFrame:
    """The store after a put: an incoming scan is taken unless a live row has its key (``force``: always).

    The row it replaces goes. Both sides have one row per key, so the joins stay one to one. Only the keys of the
    live rows cross the first join, never their pixels.
    """
    store, incoming = keyed(store), keyed(incoming)
    taken = incoming if force else incoming.join(live(store, now, ttl_minutes).select(KEY), KEY, "left_anti")
    kept = store.join(taken.select(KEY), KEY, "left_anti")
    return kept.unionByName(taken).drop("ts12")


def lookup(store: DataFrame, wanted: DataFrame, now: Column, ttl_minutes: int = STORE_TTL_MINUTES) -> DataFrame:
    """Live rows for the wanted (source, product, timestamp)."""
    keys = keyed(wanted).select(KEY).distinct()
    return keyed(live(store, now, ttl_minutes)).join(keys, KEY, "left_semi").drop("ts12")


def available(store: DataFrame, now: Column, product: str | None = None, ttl_minutes: int = STORE_TTL_MINUTES) -> DataFrame:
    """Distinct live stamps per source, newest first."""
    rows = live(store, now, ttl_minutes)
    if product is not None:
        rows = rows.where(F.col("product") == product)
    return rows.select("source", "timestamp").distinct().orderBy("source", F.desc("timestamp"))


def statistics(store: DataFrame, now: Column, ttl_minutes: int = STORE_TTL_MINUTES) -> DataFrame:
    """Entries and megabytes of the live rows per source and over all (source null)."""
    return live(store, now, ttl_minutes).rollup("source").agg(
        F.count(F.lit(1)).alias("entries"), F.round(F.sum("bytes") / 1048576.0, 2).alias("size_mb")
    )


def cleared(store: DataFrame, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The store without a source (or empty), and how many rows that removes."""
    gone = F.lit(True) if source is None else F.col("source") == source
    return store.where(~gone), store.agg(F.count_if(gone).alias("removed"))


def write(store: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Replace the sources that ``store`` holds and no others; ``store`` must not be read from ``path`` itself."""
    store.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)

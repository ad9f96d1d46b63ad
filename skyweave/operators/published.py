"""Published files: index, timeline, retention, animation plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..dimensions import RETENTION_HOURS


def parse_name(source: Column, name: Column) -> Column:
    """Product and stamp of a published file ``product_stamp.png`` (merged files carry one more part in front)."""
    parts = F.split(F.replace(name, F.lit(".png"), F.lit("")), "_")
    skip = F.when(source == "merged", F.lit(1)).otherwise(F.lit(0))
    rest = F.array_join(F.slice(parts, skip + 2, F.greatest(F.size(parts), F.lit(1))), "_")
    return F.when(F.size(parts) >= skip + 2, F.struct(parts[skip].alias("product"), rest.alias("stamp")))


def index(files: DataFrame) -> DataFrame:
    """Per source: files, products, distinct stamps, newest stamp. ``files(source, name, ...)``."""
    parsed = files.withColumn("_p", parse_name(F.col("source"), F.col("name")))
    per_stamp = parsed.groupBy("source", "_p.stamp").agg(F.count(F.lit(1)).alias("_files"), F.collect_set("_p.product").alias("_products"))
    return per_stamp.groupBy("source").agg(
        F.sum("_files").alias("files"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_products")))).alias("products"),
        F.count("stamp").alias("stamps"),
        F.max("stamp").alias("latest"),
    )


def timeline(files: DataFrame) -> DataFrame:
    """One row per source and stamp: product -> {name, bytes, modified}. A stamp has at most one file per product."""
    parsed = files.withColumn("_p", parse_name(F.col("source"), F.col("name"))).where("_p is not null")
    info = F.struct("name", "bytes", "modified")
    newest = parsed.groupBy("source", "_p.stamp", "_p.product").agg(F.max_by(info, "modified").alias("file"))
    return newest.groupBy("source", "stamp").agg(F.map_from_entries(F.collect_list(F.struct("product", "file"))).alias("products"))


def expired(files: DataFrame, now: Column, hours: int = RETENTION_HOURS) -> DataFrame:
    return files.where(F.unix_timestamp(now) - F.unix_timestamp("modified") > hours * 3600)


def retained(files: DataFrame, now: Column, hours: int = RETENTION_HOURS) -> DataFrame:
    return files.where(F.unix_timestamp(now) - F.unix_timestamp("modified") <= hours * 3600)


def totals(files: DataFrame) -> DataFrame:
    """Files and products per source and over all (source null)."""
    per_product = files.groupBy("source", "product").agg(F.count(F.lit(1)).alias("_files"))
    return per_product.rollup("source").agg(
        F.sum("_files").alias("files"), F.array_sort(F.collect_set("product")).alias("products")
    )


def animation_plan(files: DataFrame, wanted: list[str] | None = None, split_source: str = "shmu") -> DataFrame:
    """Animations per source under a product filter: one, or one per product for the source that splits them."""
    have = files.groupBy("source").agg(F.collect_set("product").alias("_have"))
    kept = F.col("_have") if wanted is None else F.array_intersect("_have", F.array(*(F.lit(p) for p in wanted)))
    n = F.size("_kept")
    count = F.when(n == 0, 0).when((F.col("source") == split_source) & (n > 1), n).otherwise(1)
    return have.withColumn("_kept", kept).select("source", F.array_sort("_kept").alias("products"), count.alias("animations"))


def write_timeline(files: DataFrame, path: str) -> None:
    timeline(files).write.mode("overwrite").partitionBy("source").json(path)

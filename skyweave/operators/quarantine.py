"""Landing rules: rows that pass, rows set aside with a reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.attrs import clean_source, looks_like_html, valid_dimensions, valid_source


def judge(rows: DataFrame) -> DataFrame:
    """Add ``reject_reason`` (null = good) by the rules whose columns are there, and the cleaned source name."""
    reason = F.when(~valid_source(F.col("source")), "bad source name")
    if {"height", "width"} <= set(rows.columns):
        reason = reason.when(~valid_dimensions(F.col("height"), F.col("width")), "bad grid dimensions")
    if "content" in rows.columns:
        reason = reason.when(looks_like_html(F.col("content")), "page instead of data")
    return rows.withColumn("reject_reason", reason).withColumn("source", clean_source(F.col("source")))


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = judge(rows)
    return judged.where("reject_reason is null").drop("reject_reason"), judged.where("reject_reason is not null")

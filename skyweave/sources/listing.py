"""Provider listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamps_in_page(pages: DataFrame, product: str, text: str = "text") -> DataFrame:
    """Distinct stamps named in directory pages, newest first."""
    pattern = rf"composite_{product}_(\d{{8}}_\d{{4}})-hd5"
    found = pages.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).alias("ts_raw"))
    return found.distinct().orderBy(F.desc("ts_raw"))


def stamps_in_json(pages: DataFrame, text: str = "text") -> DataFrame:
    """Files ending in .h5 of JSON listings with the 14 digits in front of ``00dBZ``; null when they are not there."""
    files = pages.select(F.inline(F.from_json(text, "array<struct<file:string>>")))
    name = F.col("file")
    return files.where(F.endswith(name, F.lit(".h5"))).select("file", F.nullif(F.regexp_extract(name, r"^(\d{14})00dBZ", 1), F.lit("")).alias("ts14"))

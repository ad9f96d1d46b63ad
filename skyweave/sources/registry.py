"""Source and product look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dimensions import product_table, source_table


def with_source(rows: DataFrame) -> DataFrame:
    """Registry columns for every row; an unknown source keeps its own lower-case name as folder."""
    registry = source_table(rows.sparkSession).withColumnsRenamed({"product": "default_product"})
    keyed = rows.withColumn("_key", F.lower("source"))
    joined = keyed.join(F.broadcast(registry.withColumnRenamed("source", "_key")), "_key", "left")  # six rows
    return joined.withColumn("folder", F.coalesce("folder", "_key")).drop("_key")


def with_product(rows: DataFrame) -> DataFrame:
    """Product metadata for every row; an unlisted product gets the default description."""
    products = product_table(rows.sparkSession)
    joined = rows.join(F.broadcast(products), ["source", "product"], "left")  # fixed, fifteen rows
    return (
        joined.withColumn("units", F.coalesce("units", F.lit("unknown")))
        .withColumn("description", F.coalesce("description", F.lit("No description available")))
    )

"""Positions inside ordered groups, without a task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import fresh, saved


def numbered(df: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: each row's place, from 1, inside its group of ``key`` under ``order``.

    Rows are dealt by ranges of key and order, so a group of any size spreads over parts; what a part must add to its own
    numbers are the rows of the same key in the parts before it, one number for each key and part. ``order`` should tell
    rows apart as far as it matters: equal rows get consecutive numbers in some order. The result is read from a table.
    """
    part, seq, first, before = (fresh(df, c) for c in ("part", "seq", "first", "before"))
    dealt = df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
    kept = saved(dealt.select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().alias(seq)))
    pieces = kept.groupBy(key, part).agg(F.min(seq).alias(first), F.count("*").alias(before))
    ahead = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn(before, F.coalesce(F.sum(before).over(ahead), F.lit(0)))
    return kept.join(pieces, [key, part]).select(*df.columns, (F.col(seq) - F.col(first) + F.col(before) + 1).alias(name))

"""Availability report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import health


@dataclass
class Report:
    profile: DataFrame
    gaps: DataFrame
    potential: DataFrame


def availability(catalog: DataFrame, sources: list[str]) -> Report:
    """Profile with health class per source, its ten longest gaps, and how many mosaics were possible."""
    wanted = catalog.where(F.col("source").isin(sources))
    profile = health.availability_profile(wanted).withColumn("status", health.uptime_status(F.col("uptime_percent")))
    potential = health.composite_potential(wanted, sources)
    return Report(profile, health.longest_gaps(wanted), potential.withColumn("status", health.potential_status(F.col("potential_percent"))))

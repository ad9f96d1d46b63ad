"""One registered query per operator, over views of the driver's tables."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import function_queries, line_queries, mosaic_queries, plan_queries, source_queries, stream_queries, time_queries  # noqa: F401

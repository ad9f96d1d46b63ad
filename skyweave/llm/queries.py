"""Queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import sql
from .contamination import op3_benchmark_matches
from .divergence import op11_source_divergence
from .lm_scoring import op1_lm_scores
from .ordinal_quality import op9_ordinal_quality
from .outliers import op5_quality_outliers
from .piece_encoding import op7_piece_encoding
from .prefix_trie import op13_prefix_trie
from .private_data import op10_private_data
from .quotation_threads import op8_quotation_threads
from .repeated_bytes import op4_repeated_bytes
from .simhash import op2_simhash_groups
from .token_counts import op6_token_counts
from .token_files import op12_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scores": op1_lm_scores,
    "op2_simhash_groups": op2_simhash_groups,
    "op3_benchmark_matches": op3_benchmark_matches,
    "op4_repeated_bytes": op4_repeated_bytes,
    "op5_quality_outliers": op5_quality_outliers,
    "op6_token_counts": op6_token_counts,
    "op7_piece_encoding": op7_piece_encoding,
    "op8_quotation_threads": op8_quotation_threads,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_private_data": op10_private_data,
    "op11_source_divergence": op11_source_divergence,
    "op12_token_files": op12_token_files,
    "op13_prefix_trie": op13_prefix_trie,
}
#: The others rest on hashes, models or tokenizers that SQL does not have: tests/llm holds them against plain versions.
ORACLES: dict[str, str] = {
    "op4_repeated_bytes": sql.REPEATED_BYTES,
    "op8_quotation_threads": sql.QUOTATION_THREADS,
    "op11_source_divergence": sql.SOURCE_DIVERGENCE,
    "op13_prefix_trie": sql.PREFIX_TRIE,
}

"""A training-data pipeline: quality rules, near-duplicates, decontamination, personal data, piece encoding.

Each stage takes what the one before kept, whole, and returns the columns of ``documents``; the last adds the pieces:

1. ``quality`` drops documents that fail the base rules or are outliers for their language and source.
2. ``near_duplicates`` keeps one document, the smallest id, of each group linked by a Jaccard similarity of 0.8 or more on
   sets of five-word shingles.
3. ``decontaminate`` drops documents in which a benchmark item occurs within its edit budget.
4. ``private_data`` puts ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]`` in the place of each personal span.
5. ``pieces`` returns each text's identifiers, their number, and the text decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.llm import contamination, outliers, piece_encoding, private_data, similar
from skyweave.llm.shared import saved

MODEL = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return outliers.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private_data.redact(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = piece_encoding.encoded(docs.select("doc_id", "text"), public_tokenizers.path(MODEL), back="decoded")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("private_data", private),
    ("pieces", pieces),
]

#: SQL can express neither the covariance estimates nor the shingle sets, trees and segmentation: see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

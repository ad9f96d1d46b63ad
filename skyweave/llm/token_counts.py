"""Operator 6, token counts: byte-pair merging on a heap and a linked list; no identifiers are made.

The count of a text is its initial symbols minus its merges. The vocabulary's pair ranks say which adjacent pair is
merged next (lowest rank first, leftmost among equals). No piece holds a character followed by a white-space mark, so a
text falls apart before each run of marks, and a unit falls apart between any two characters that stand side by side in
no piece: merging never crosses such a place. Units repeat a lot, so the counts of those met first
are kept, as many as a bounded cache holds.

Null and empty texts have no tokens. A text of any length is one pass over its units, O(n log n) in the longest unit.
Repeated rows and null ids are counted like any other row; extra columns are left out of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

MARK = "▁"
LIMIT = 4096
CACHE = 600_000
ROWS = 256


class Pieces:
    """Ranks and splitting rules of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        if trained.model_type != 2 or rules.name != "identity" or rules.remove_extra_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with the identity normalizer is wanted")
        if any(p.type in (4, 5) for p in model.pieces) or not trained.byte_fallback:
            raise ValueError("user-defined or unused pieces, or no byte fallback: not supported")
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == 1}
        self.beside = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        if any(c[1] == MARK != c[0] for c in self.beside):
            raise ValueError("a piece crosses into a white-space mark")
        self.prefix = MARK if rules.add_dummy_prefix else ""
        self.units: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    def text_count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.unit_count, re.findall(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n", self.prefix + text.replace(" ", MARK))))

    def unit_count(self, unit: str) -> int:
        found = self.units.get(unit)
        if found is not None:
            return found
        if unit[1:].isalpha():
            found = merged(unit, self.rank)
        else:
            beside, begin, found = self.beside, 0, 0
            for i, pair in enumerate(map(add, unit, unit[1:]), 1):
                if pair not in beside:
                    found += self.part_count(unit[begin:i])
                    begin = i
            found += self.part_count(unit[begin:])
        if len(self.units) < CACHE:
            self.units[unit] = found
        return found

    def part_count(self, part: str) -> int:
        found = self.parts.get(part)
        if found is None:
            found = merged(part, self.rank)
            if len(self.parts) < CACHE:
                self.parts[part] = found
        return found


def merged(part: str, rank: dict[str, float]) -> int:
    """Symbols left of ``part`` after all merges; an unknown character counts its UTF-8 bytes."""
    n, ranked = len(part), rank.get
    heap = [(r, i, 2) for i, pair in enumerate(map(add, part, part[1:])) if (r := ranked(pair)) is not None]
    left = n
    if heap:
        heapify(heap)
        symbol, after, before = list(part), [*range(1, n), -1], list(range(-1, n - 1))
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            both = symbol[i]
            if not both or j < 0:
                continue
            both += symbol[j]
            if len(both) != size:  # one side has been merged since
                continue
            left -= 1
            symbol[i], symbol[j] = both, ""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                r = ranked(more := both + symbol[k])
                if r is not None:
                    heappush(heap, (r, i, len(more)))
            h = before[i]
            if h >= 0:
                r = ranked(more := symbol[h] + both)
                if r is not None:
                    heappush(heap, (r, h, len(more)))
    return left + sum(len(c.encode()) - 1 for c in part if c not in rank)


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model at ``path``, once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit. ``model`` is a path that every worker can open."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                counts = [table.text_count(t) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))

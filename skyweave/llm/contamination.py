"""Operator 3, benchmark decontamination: pigeonhole edit matching with Myers' bit-parallel distance.

Texts and items are compared after ``normal``: case-folded by Unicode's rules, runs of ASCII white space made one space,
ends trimmed. An item of n characters may be found with up to k = max(MIN_ERRORS, floor(n * ERROR_SHARE)) edits, fewer
for short items (k < n / 8). It is cut into k + 2 pieces: an occurrence within k edits holds two of them unchanged, and
their distance is that in the item up to k. All pieces are looked for in one pass over each text with a keyword automaton;
where two pieces of an item are so placed, the window that an occurrence could fill is verified with Myers' algorithm, on
Python's whole numbers as bit vectors of any length. A chance hit of one short piece so costs no verification.

The items are a stated query set: they go to the workers in blocks of at most BLOCK_CHARS characters, so what a task holds
is bounded whatever their number; each block is a pass over the documents. No document is cut or left out, and windows
that overlap are verified once, as one. Per document and item the match with the fewest edits is returned (the leftmost
among equals; ``edits`` and the end of the match in the normalised text).

Null and empty texts match nothing; null and empty items are matched by nothing. Repeated rows give repeated matches,
repeated items (equal texts) are told apart by their ids. Extra columns are left out of ``matches``; ``clean`` keeps them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import documents, fresh

ERROR_SHARE = 0.1
MIN_ERRORS = 1
BLOCK_CHARS = 2_000_000
ROWS = 256


def normal(text: str | None) -> str:
    return b" ".join((text or "").casefold().encode().split()).decode()  # bytes know ASCII white space only


def budget(n: int) -> int:
    return max(0, min(max(MIN_ERRORS, int(n * ERROR_SHARE)), (n - 1) // 8))


def myers(pattern: str, masks: dict[str, int], text: str, limit: int) -> tuple[int, int] | None:
    """(fewest edits, first end) of ``pattern`` as a substring of ``text``, if at most ``limit``.

    One column of the edit table is two bit vectors of vertical differences; each text character updates them at once.
    """
    m = len(pattern)
    high, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score, best = full, 0, m, (limit + 1, -1)
    of = masks.get
    for at, c in enumerate(text):
        eq = of(c, 0)
        x = eq | minus
        d = (((x & plus) + plus) ^ plus) | x
        h_plus, h_minus = minus | (full & ~(d | plus)), plus & d
        if h_plus & high:
            score += 1
        elif h_minus & high:
            score -= 1
            if score < best[0]:
                best = (score, at + 1)
        h_plus = (h_plus << 1) & full
        h_minus = (h_minus << 1) & full
        plus, minus = h_minus | (full & ~(x | h_plus)), h_plus & x
    return best if best[0] <= limit else None


class Items:
    """A block of items: pieces in an automaton, character masks for verification."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, t, budget(len(t))) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.masks: dict[int, dict[str, int]] = {}
        for n, (_, t, k) in enumerate(self.items):
            parts = k + 2 if k else 1
            cuts = [round(len(t) * j / parts) for j in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                places[t[a:b]].append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def mask(self, n: int) -> dict[str, int]:
        if n not in self.masks:
            found: dict[str, int] = defaultdict(int)
            for at, c in enumerate(self.items[n][1]):
                found[c] |= 1 << at
            self.masks[n] = dict(found)
        return self.masks[n]

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item id, fewest edits, end) for each item that occurs in the normalised ``text``."""
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, (size, where) in self.automaton.iter(text):
            for n, offset in where:
                hits[n].append((end + 1 - size - offset, offset))
        windows: dict[int, list[list[int]]] = {}
        for n, places in hits.items():
            _, t, k = self.items[n]
            if k and len(places) < 2:
                continue
            places.sort()
            # neighbours in this order that are different pieces at most k apart: two unchanged pieces have such between them
            for i, (at, offset) in enumerate(places):
                if k:
                    if i + 1 == len(places):
                        break
                    after, other = places[i + 1]
                    if after - at > k or offset == other:
                        continue
                begin, until = at - k, at + len(t) + k
                mine = windows.setdefault(n, [])
                if mine and begin <= mine[-1][1]:
                    mine[-1][1] = max(mine[-1][1], until)
                else:
                    mine.append([begin, until])
        found = []
        for n, mine in windows.items():
            i, t, k = self.items[n]
            best = None
            for begin, until in mine:
                begin = max(begin, 0)
                got = myers(t, self.mask(n), text[begin : max(until, 0)], k)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], begin + got[1])
            if best:
                found.append((i, *best))
        return sorted(found)


def blocks(benchmark: DataFrame, size: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of at most ``size`` characters, one block in the driver at a time. A longer item is its own block."""
    held, chars = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if not text:
            continue
        if held and chars + len(text) > size:
            yield held
            held, chars = [], 0
        held.append((row["item_id"], text))
        chars += len(text)
    if held:
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, match_end): per row of ``docs`` and item the closest occurrence within the budget."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, edits int, match_end long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value)
            for batch in batches:
                found = []
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                        found += [(i, *m) for m in items.matches(normal(t))]
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(("doc_id", "item_id", "edits", "match_end"), f)) for f in found],
                    pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("match_end", pa.int64())]),
                )

        out = out.union(rows.mapInArrow(search, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    at, name = docs.columns.index("text"), fresh(docs, "leaks")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BooleanType())])
    for block in blocks(benchmark, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def mark(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(sent.value)
            for batch in batches:
                for begin in range(0, batch.num_rows, ROWS):
                    part = batch.slice(begin, ROWS)
                    leaks = [bool(items.matches(normal(t))) for t in part.column(at).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(leaks, pa.bool_())], [*part.schema.names, name])

        docs = docs.mapInArrow(mark, schema).where(~F.col(name)).drop(name)
    return docs


def op3_benchmark_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

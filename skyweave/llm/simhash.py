"""Operator 2, SimHash near-duplicates: fingerprints, and a self-join of binary tries over them.

Fingerprint: words of the text with A-Z lower-cased, all four-word shingles (repeats count; fewer words make one shingle;
none makes fingerprint zero), XXH64 with seed 42 of each, and a bit is set if more than half of the hashes set it.

Links: fingerprints that differ in at most BUDGET bits. Cut 64 bits into BUDGET + m blocks: two linked fingerprints agree
on m whole blocks. For each choice of m blocks the distinct fingerprints are put in a trie whose leading bits are those
blocks, with no errors allowed there: every value of the leading bits is a subtree of its own, joined with itself in one
task. There pairs of nodes go down together, differing bits add up, and a pair beyond the budget is pruned. m grows with
the number of fingerprints, so that subtrees stay small; a subtree crowded beyond CROWD is cut into slices that meet two
by two, so no task holds more than two slices. A task hands on a spanning forest of the links it found, not all pairs.

Copies share one fingerprint and meet once. Null and blank texts have fingerprint zero; rows with a null id get a
component but give it no name (null if no id is in it). Repeated rows stay. Extra columns are left out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import components, documents, fresh, saved

BUDGET = 4
SHINGLE = 4
SEED = 42
#: Distinct fingerprints that one slice of a subtree may hold.
CROWD = 4096
ROWS = 256
WEIGHTS = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1 :] or ends[-1:]
    hashed, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for begin in range(0, len(last), 65536):
        some = [hashed(joined[s:e], SEED) for s, e in zip(starts[begin:], last[begin : begin + 65536])]
        total += np.unpackbits(np.array(some, ">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(WEIGHTS[2 * total > len(last)].sum())


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a long."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = np.array([fingerprint(t) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(marks, "doc_id long, fp long")


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and the column ``name``, its fingerprints as longs."""
    at = docs.columns.index("text")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                found = np.array([fingerprint(t, shingle) for t in part.column(at).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found.view(np.int64))], [*part.schema.names, name])

    return docs.mapInArrow(mark, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def block_choices(n: int, budget: int = BUDGET, crowd: int = CROWD) -> list[list[tuple[int, int]]]:
    """For each choice, the (lowest bit, width) of its blocks: the coarsest cut whose subtrees are small on average."""
    for m in range(1, 9):
        k = budget + m
        edges = [round(64 * i / k) for i in range(k + 1)]
        blocks = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
        choices = [list(c) for c in combinations(blocks, m)]
        if n >> sum(w for _, w in choices[0]) <= crowd // 4:
            return choices
    return choices


def leading(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    value = F.lit(0).cast("long")
    for lo, width in blocks:
        value = F.shiftleft(value, width).bitwiseOR(F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1)))
    return value


def reorder(fp: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """The fingerprints' bits with the chosen blocks in front."""
    out, chosen = np.zeros_like(fp), {lo for lo, _ in blocks}
    rest, lo = [], 0
    for at, width in sorted(blocks):
        if at > lo:
            rest.append((lo, at - lo))
        lo = at + width
    if lo < 64:
        rest.append((lo, 64 - lo))
    assert len(chosen) == len(blocks)
    for at, width in [*blocks, *rest]:
        mask = np.uint64((1 << width) - 1)
        out = (out << np.uint64(width)) | ((fp >> np.uint64(at)) & mask)
    return out


def trie_pairs(values: np.ndarray, first: np.ndarray, depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of one run's values within ``budget`` bits. ``values`` are distinct and sorted within each
    run, runs begin at ``first``, and the values of a run agree in their leading ``depth`` bits.

    A node is an interval of the sorted values; a pair of nodes goes down one bit at a time, all pairs of a level at once.
    """
    ends = np.append(first[1:], len(values))
    lo1, hi1, lo2, hi2 = first, ends, first, ends
    err = np.zeros(len(first), np.int8)
    left, right = [], []
    for bit in range(63 - depth, -2, -1):
        small = (hi1 - lo1) * (hi2 - lo2) <= 16 if bit >= 0 else np.ones(len(lo1), bool)
        if small.any():
            i, j = expand(lo1[small], hi1[small], lo2[small], hi2[small])
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            left.append(i[near])
            right.append(j[near])
            lo1, hi1, lo2, hi2, err = (x[~small] for x in (lo1, hi1, lo2, hi2, err))
        if not len(lo1):
            break
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        mid1, mid2 = hi1 - (ones[hi1] - ones[lo1]), hi2 - (ones[hi2] - ones[lo2])
        cross = lo1 != lo2
        parts = [
            (lo1, mid1, lo2, mid2, err),
            (mid1, hi1, mid2, hi2, err),
            (lo1, mid1, mid2, hi2, err + 1),
            tuple(x[cross] for x in (mid1, hi1, lo2, mid2, err + 1)),
        ]
        lo1, hi1, lo2, hi2, err = (np.concatenate(x) for x in zip(*parts))
        live = (hi1 > lo1) & (hi2 > lo2) & (err <= budget) & ((lo1 != lo2) | (hi1 - lo1 > 1))
        lo1, hi1, lo2, hi2, err = (x[live] for x in (lo1, hi1, lo2, hi2, err))
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def expand(lo1, hi1, lo2, hi2) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of small node pairs."""
    n1, n2 = hi1 - lo1, hi2 - lo2
    size = n1 * n2
    which = np.repeat(np.arange(len(size)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return lo1[which] + at // n2[which], lo2[which] + at % n2[which]


def forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it is linked with) for all nodes but the smallest: the same components by fewer links."""
    nodes, flat = np.unique(np.concatenate((i, j)), return_inverse=True)
    a, b = flat[: len(i)], flat[len(i) :]
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        both = np.minimum(label[a], label[b])
        np.minimum.at(low, label[a], both)
        np.minimum.at(low, label[b], both)
        low = low[low]
        if (low == label).all():
            break
        label = low
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def links(distinct: DataFrame, budget: int = BUDGET, crowd: int = CROWD) -> DataFrame:
    """(a, b): links between the fingerprints of column ``fp`` (distinct) that make the same components as all links."""
    choices = block_choices(distinct.count(), budget, crowd)
    each = F.array(*(F.struct(F.lit(k).alias("choice"), leading(F.col("fp"), c).alias("key")) for k, c in enumerate(choices)))
    placed = distinct.select("fp", F.explode(each).alias("at")).select("fp", "at.choice", "at.key")
    full = placed.groupBy("choice", "key").count().where(F.col("count") > crowd)
    full = full.select("choice", "key", F.ceil(F.col("count") / crowd).cast("int").alias("slices"))
    mine = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    pairs = F.when(
        F.col("slices").isNotNull(),
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda s: s != mine),
            lambda s: F.least(s, mine) * F.lit(1 << 20).cast("long") + F.greatest(s, mine),
        ),
    ).otherwise(F.array(F.lit(0).cast("long")))
    ready = placed.join(full, ["choice", "key"], "left").select("choice", "key", F.explode(pairs).alias("slice"), "fp")
    key = ["choice", "key", "slice"]
    depth = [sum(w for _, w in c) for c in choices]

    def found(table: pa.Table) -> pa.RecordBatch | None:
        choice, fp = table["choice"].to_numpy(), table["fp"].to_numpy().view(np.uint64)
        a, b = [], []
        for c in np.unique(choice):
            rows = choice == c
            values = reorder(fp[rows], choices[c])
            group = table["slice"].to_numpy()[rows]
            order = np.lexsort((values, group, values >> np.uint64(64 - depth[c])))
            values, group, own = values[order], group[order], fp[rows][order]
            lead = values >> np.uint64(64 - depth[c])
            new = np.append(True, (lead[1:] != lead[:-1]) | (group[1:] != group[:-1]))
            i, j = trie_pairs(values, np.flatnonzero(new), depth[c], budget)
            if len(i):
                i, j = forest(i, j)
                a.append(own[i])
                b.append(own[j])
        if not a:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key: all but the last, perhaps unfinished, key are joined at once."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            if table.num_rows < 2 * crowd:
                continue
            at = np.column_stack([table[k].to_numpy() for k in key])
            whole = int(np.flatnonzero((at == at[-1]).all(1) == False)[-1]) + 1 if (at[0] != at[-1]).any() else 0  # noqa: E712
            if whole:
                out = found(table.slice(0, whole))
                if out:
                    yield out
                held = table.slice(whole).to_batches()
        if held:
            out = found(pa.Table.from_batches(held))
            if out:
                yield out

    return ready.repartition(*key).sortWithinPartitions(*key).mapInArrow(join, "a long, b long")


def grouped(docs: DataFrame, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of each row, and (fp, first, root) of each fingerprint: its smallest id and its component's root."""
    marked = saved(fingerprints(docs))
    distinct = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    reached = components(links(distinct.select("fp"), budget))
    named = distinct.join(reached, distinct["fp"] == reached["node"], "left")
    return marked, named.select("fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest id that links reach)."""
    marked, named = grouped(docs, budget)
    low = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(low, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """``docs`` with one row of each group: its smallest id; without ids, its smallest fingerprint. Of several rows of
    that id and fingerprint the one with the smallest text stays."""
    _, named = grouped(docs, budget)
    pick = named.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "fp")).alias("p"))
    mine, theirs = fresh(docs, "mark"), fresh(docs, "pick")
    pick = pick.select(F.struct("p.first", "p.fp").alias(theirs))
    rows = with_fingerprint(docs, mine)
    key = F.struct(F.col("doc_id").cast("long").alias("first"), F.col(mine).alias("fp"))
    kept = rows.join(pick, key.eqNullSafe(F.col(theirs)))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    kept = kept.groupBy(theirs).agg(F.min_by(whole, F.coalesce("text", F.lit(""))).alias(mine))
    return kept.select(f"{mine}.*")


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))

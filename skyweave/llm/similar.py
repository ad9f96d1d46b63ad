"""Near copies for the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words are those of ``simhash`` (A-Z lower-cased); fewer than five words make one shingle, none makes an empty set. Texts of
equal words share a ``key`` and count once (64 bits tell keys, and 64 bits tell shingles, apart).

First come operator 2's fingerprints, here over five-word shingles, and its self-join of tries, with a wider budget of BUDGET
bits: texts of one fingerprint and texts that the join links are held against each other on their full sets, which finds
most copies that are closer than 0.8. Fingerprints of texts at 0.8 differ in ten bits or so, in no fixed number, so an exact
join finds the links that are left, between the components that the fingerprints gave. Of two sets within 0.8 each holds at least four fifths of the other, so in any common order of all
shingles their first n // 5 + 1 have one in common. The order puts crowded shingles last, by a sketch of 2 ** BITS counters
over a share of the texts: it decides what the join costs, not what it finds. Texts that share a first shingle are held
against the smallest key of its group, if they are not of one component yet. Groups that are not one component then meet as
sketches, one group of those of the same members: a sketch is the parity of the shingles in each of 2 to 4 bits a shingle, and
the bits in which two sketches differ are never more than the shingles in which the sets differ. Pairs of different components
go on only if their sketches leave 0.8 open, and each of them is decided on the full sets, so no text goes that is not within
0.8 of another one. To be decided, a pair moves one of its texts, and each text is moved once more: texts take less room than
the hashes of their shingles. Sketches of a group are still held against each other one by one, a few words of 64 bits each.
Groups beyond CROWD are cut into slices that meet two by two, and so no task holds a whole one; slices grow from SLICES on, up to
LARGE rows, so that a row is not sent to ever more of them.

Blank and null texts are copies of each other. Rows with null ids and repeated rows are as in ``simhash.one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .repeated_bytes import released
from .shared import SPACE, components, fresh, saved

SHINGLE = 5
#: Differing bits up to which fingerprints propose a pair.
BUDGET = 6
SEED = 42
BITS = 20
SLICE = 1 << 14
SHARE = 8
CROWD, LARGE, SLICES = 256, 8192, 8
ROWS = 256
#: Slots of the filter through which texts with candidates are read again.
SLOTS = 1 << 22


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles, sorted."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1).tolist()
    last = (ends[SHINGLE - 1 :] if len(ends) >= SHINGLE else ends[-1:]).tolist()
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(joined[s:e], SEED) for s, e in zip(starts, last)], np.uint64))


def key_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.xxhash64(F.btrim(F.regexp_replace(lower, f"[{SPACE}]+", " "), F.lit(" ")))


def crowding(rows: DataFrame) -> np.ndarray:
    """How many texts of a share hold a shingle, in 2 ** BITS counters. ``rows``: text."""

    def sent(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in range(0, len(counts), SLICE):
            part = counts[s : s + SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([s // SLICE], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                found = [shingles(t) >> np.uint64(64 - BITS) for t in batch.column(0).slice(at, ROWS).to_pylist()]
                counts += np.bincount(np.concatenate(found).astype(np.int64), minlength=len(counts)).astype(np.int32)
        yield from sent(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for s, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[s * SLICE : (s + 1) * SLICE] += np.frombuffer(raw, np.int32)
        yield from sent(counts)

    schema = "slice int, counts binary"
    table = rows.select("text").mapInArrow(count, schema).repartition("slice").mapInArrow(add, schema).toArrow()
    out = np.zeros(1 << BITS, np.int32)
    for s, raw in zip(table["slice"].to_pylist(), table["counts"].to_pylist()):
        out[s * SLICE : (s + 1) * SLICE] = np.frombuffer(raw, np.int32)
    return out


def width(n: int) -> int:
    """Words of the sketch of ``n`` shingles, a power of two: 2 to 4 bits a shingle, 64 at least."""
    return max(1, 1 << (2 * max(n, 1) - 1).bit_length() >> 6)


def sketch(shingled: np.ndarray) -> np.ndarray:
    """The parity of the shingles that fall on each bit. Halves of a sketch put together by XOR are the sketch half as wide."""
    bits = 64 * width(len(shingled))
    return np.packbits(np.bincount((shingled & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1, bitorder="little").view(np.uint64)


def open_pairs(n: np.ndarray, root: np.ndarray, sketches: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of different roots whose sketches do not rule out 0.8. Sets within 0.8 differ in a ninth of both sizes."""
    order = np.argsort(n, kind="stable")
    n, root, sketches = n[order].astype(np.int64), root[order], [np.frombuffer(sketches[i], np.uint64) for i in order]
    wide = np.array([len(x) for x in sketches])
    left, right = [], []
    for w in np.unique(wide).tolist():
        # sizes ascend, and sets within 0.8 have sketches of one width or of this and the next one
        lo, mid, hi = np.searchsorted(wide, [w, w + 1, 2 * w + 1])
        flat = np.array([x if len(x) == w else x[:w] ^ x[w:] for x in sketches[lo:hi]])
        ends = np.searchsorted(n[lo:hi], 5 * n[lo:mid] // 4, "right").tolist()
        for i, end in enumerate(ends):
            apart = np.bitwise_count(flat[i + 1 : end] ^ flat[i]).sum(1, dtype=np.int64)
            at = lo + i + 1 + np.flatnonzero((9 * apart <= n[lo + i] + n[lo + i + 1 : lo + end]) & (root[lo + i + 1 : lo + end] != root[lo + i]))
            left.append(np.full(len(at), lo + i))
            right.append(at)
    return order[np.concatenate(left)], order[np.concatenate(right)]


def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, slice, key, n, root, sketch) in the order of h and slice to the open pairs (a, b) of each meeting."""

    def found(table: pa.Table) -> pa.RecordBatch:
        key = table["key"].to_numpy()
        i, j = open_pairs(table["n"].to_numpy(), table["root"].to_numpy(), table["sketch"].to_pylist())
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(key[i], key[j])), pa.array(np.maximum(key[i], key[j]))], ["a", "b"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        h, part = table["h"].to_numpy(), table["slice"].to_numpy()
        begin = [0, *(np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1])) + 1).tolist()]
        for at, to in zip(begin, begin[1:]):
            yield found(table.slice(at, to - at))
        held = table.slice(begin[-1])
    if held is not None:
        yield found(held)


def firsts(rows: DataFrame, order: np.ndarray) -> DataFrame:
    """(key, n, first, sketch): the number of a text's shingles, its first n // 5 + 1, and their sketch. ``rows``: key, text."""
    sent = rows.sparkSession.sparkContext.broadcast(order)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, n, some, drawn = batch.slice(at, ROWS), [], [], []
                for t in part.column(1).to_pylist():
                    all_ = shingles(t)
                    by = np.lexsort((all_, sent.value[all_ >> np.uint64(64 - BITS)]))
                    n.append(len(all_))
                    some.append(all_[by[: len(all_) // 5 + 1]].view(np.int64))
                    drawn.append(sketch(all_).tobytes())
                columns = [part.column(0), pa.array(n, pa.int32()), pa.array(some, pa.list_(pa.int64())), pa.array(drawn, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "first", "sketch"])

    return rows.select("key", "text").mapInArrow(first, "key long, n int, first array<long>, sketch binary")


def within(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.concatenate((x, y))
    both.sort()
    # inter / (x + y - inter) >= 4 / 5
    return 9 * int((both[1:] == both[:-1]).sum()) >= 4 * len(both)


def linked(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of keys whose full sets are within 0.8, as a table. ``rows``: key, text."""
    spark = rows.sparkSession
    pairs = saved(pairs.select("a", "b").distinct())
    wanted = saved(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    slots = np.zeros(SLOTS, bool)
    slots[wanted.select(F.pmod("key", F.lit(SLOTS)).cast("int").alias("slot")).distinct().toArrow()["slot"].to_numpy()] = True
    sent = spark.sparkContext.broadcast(np.packbits(slots))

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.unpackbits(sent.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(slots[batch.column(0).to_numpy() % SLOTS]))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, x = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, keep = batch.slice(at, ROWS), []
                for a, mine, theirs in zip(part.column(0).to_pylist(), part.column(2), part.column(3)):
                    if a != now:  # pairs come in the order of their first keys
                        now, x = a, shingles(mine.as_py())
                    keep.append(within(x, shingles(theirs.as_py())))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    held = rows.select("key", "text").mapInArrow(hit, "key long, text string").join(wanted, "key", "left_semi")
    held = saved(held.groupBy("key").agg(F.any_value(F.coalesce("text", F.lit(""))).alias("text")))
    met = pairs.join(held.select(F.col("key").alias("b"), F.col("text").alias("theirs")), "b")
    met = met.join(held.select(F.col("key").alias("a"), F.col("text").alias("mine")), "a").select("a", "b", "mine", "theirs")
    found = saved(met.mapInArrow(decide, "a long, b long"))
    released(spark)
    return found


def near_fingerprints(rows: DataFrame) -> DataFrame:
    """(a, b): keys within 0.8 whose fingerprints are equal or joined within BUDGET bits. ``rows``: key, text."""
    marked = saved(simhash.with_fingerprint(rows.select("key", "text"), "fp", SHINGLE).select("key", "fp").distinct())
    first = saved(marked.groupBy("fp").agg(F.min("key").alias("low")))
    joined = simhash.links(first.select("fp"), BUDGET).distinct()
    low = lambda side: first.select(F.col("fp").alias(side), F.col("low").alias(f"low_{side}"))
    pairs = joined.join(low("a"), "a").join(low("b"), "b").select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
    alike = marked.join(first, "fp").where("low < key").select(F.col("low").alias("a"), F.col("key").alias("b"))
    return linked(pairs.union(alike), rows)


def fits(a: Column, b: Column) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def groups(rows: DataFrame) -> DataFrame:
    """(node, root): the components of linked keys; keys without links are absent. ``rows``: key, text."""
    spark = rows.sparkSession
    order = crowding(rows.where(F.pmod("key", F.lit(SHARE)) == 0))
    drawn = saved(firsts(rows, order))
    placed = drawn.select(F.explode("first").alias("h"), "key", "n")
    shared = placed.groupBy("h").agg(F.min(F.struct("key", "n")).alias("low"), F.max("key").alias("high")).where("low.key < high")
    shared = saved(shared.select("h", "low"))
    released(spark)
    members = saved(placed.join(shared, "h").select("h", "key", "n", "low").distinct())
    released(spark)
    star = members.where((F.col("key") != F.col("low.key")) & fits(F.col("n"), F.col("low.n")))
    star = saved(star.select(F.col("low.key").alias("a"), F.col("key").alias("b")).distinct())
    near = near_fingerprints(rows)
    known = saved(components(near))
    root = lambda side: known.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    apart = star.join(root("a"), "a", "left").join(root("b"), "b", "left")
    apart = apart.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    near = saved(near.union(linked(apart, rows)))
    reached = saved(components(near))
    named = members.join(reached, F.col("key") == F.col("node"), "left").select("h", "key", "n", F.coalesce("root", "key").alias("root"))
    who = (F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"who_{i}") for i in range(2))
    open_ = named.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"), *who).where("lo < hi and m > 2")
    open_ = open_.groupBy("m", "who_0", "who_1").agg(F.min("h").alias("h"))  # the same members meet once
    slices = F.greatest(F.least(F.ceil(F.col("m") / CROWD), F.lit(SLICES)), F.ceil(F.col("m") / LARGE)).cast("int")
    rest = named.join(open_.select("h", slices.alias("slices")), "h")
    mine = F.pmod(F.xxhash64("key"), F.col("slices")).cast("int")
    meets = F.when(F.col("slices") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("slices") - 1), lambda s: s != mine),
            lambda s: F.least(s, mine) * F.lit(1 << 20).cast("long") + F.greatest(s, mine),
        )
    )
    rest = rest.select("h", meets.alias("slice"), "key", "n", "root").join(drawn.select("key", "sketch").distinct(), "key")
    rest = rest.select("h", F.explode("slice").alias("slice"), "key", "n", "root", "sketch")
    pairs = rest.repartition("h", "slice").sortWithinPartitions("h", "slice").mapInArrow(meetings, "a long, b long")
    pairs = saved(pairs.distinct().join(star, ["a", "b"], "left_anti"))
    released(spark)
    return components(near.union(linked(pairs, rows)))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: its smallest id; without ids, its smallest key. Of several rows of that id and
    key the one with the smallest text stays."""
    mine, theirs = fresh(docs, "mark"), fresh(docs, "pick")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key_of(F.col("text")).alias("key"))
    low = rows.groupBy("key").agg(F.min("doc_id").alias("first"))
    named = low.join(groups(rows), F.col("key") == F.col("node"), "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    pick = named.groupBy("root").agg(F.min(F.struct(F.col("first").isNull(), "first", "key")).alias("p"))
    pick = pick.select(F.struct("p.first", "p.key").alias(theirs))
    own = F.struct(F.col("doc_id").cast("long").alias("first"), key_of(F.col("text")).alias("key"))
    kept = docs.withColumn(mine, own).join(pick, F.col(mine).eqNullSafe(F.col(theirs)))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    kept = kept.groupBy(theirs).agg(F.min_by(whole, F.coalesce("text", F.lit(""))).alias(mine))
    return kept.select(f"{mine}.*")

"""Operator 4, suffix-array dedup: bytes covered by a WINDOW-byte string that also starts in a document with a smaller id.

Two documents that share a window share one of its grams of GRAM bytes, the one with the smallest hash, at the same
distance (``anchors``): about every fourteenth place is such an anchor, and only anchors are moved. In three jobs:

1. Anchors meet by the hash of their gram. One whose surroundings (all bytes that windows around it can hold) were seen
   under a smaller id is settled: all of its surroundings are covered. What is left are the rims of repeated passages,
   where the same gram has different surroundings; of equal surroundings the smallest id stands for all.
2. Those bring their surroundings, fetched by a join with the texts. A task sorts the suffixes that begin at its anchors,
   gram by gram, with a mergesort that compares by prefix hashes and binary search (``suffix_sort``). For each distance of a window's
   beginning to its anchor, the windows that are equal on the right are a run of the sorted suffixes, those that are equal
   on the left too have equal hashes, and these are compared byte by byte; the smallest id of each such class decides.
3. The covered bytes of each document are removed and the rest is hashed.

All of the text is used, strings are judged on the input, and the sorts hold a share of the rows that shrinks with the
number of partitions. Anchors that repeat within a stretch of documents are settled before the shuffle, so a passage in a
third of all documents sends one row for each stretch. Surroundings are told apart by 64 bits beside the
64 of their gram: under one gram, k of them are expected to be taken for others k^2 / 2^65 times.

Null texts are empty. Null ids come after all others and never settle anything. Rows that repeat an id are judged one by
one, and do not cover each other. Extra columns are left out of the result.
"""

from __future__ import annotations

import gc
import hashlib
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchors import Hashes, anchors, mixed, suffix_sort
from .shared import documents, saved

WINDOW = 50
GRAM = 24
STRETCH = 2_000_000
REST = WINDOW - GRAM
LAST = (1 << 63) - 1
OTHER = np.uint64(0xD6E8FEB86659FD93)
Batches = Iterator[pa.RecordBatch]


def released(spark: SparkSession) -> None:
    """Lets the driver drop shuffle files of finished jobs now rather than at its next garbage collection."""
    for _ in range(2):  # references that the first one frees go with the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def rows_of(docs: DataFrame) -> DataFrame:
    """(row, ord, doc_id, text): ``row`` names a row (rows alike in id and text share it), ``ord`` orders ids."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    again = saved(base.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("again")))
    order = F.coalesce("doc_id", F.lit(LAST)).alias("ord")
    if again.isEmpty():
        return base.select(F.col("doc_id").alias("row"), order, "doc_id", "text")
    marked = base.join(again, F.col("doc_id").eqNullSafe(F.col("again")), "left").withColumn("own", F.col("doc_id").isNotNull() & F.col("again").isNull())
    return marked.select(F.when(F.col("own"), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "text")).alias("row"), order, "doc_id", "text")


def stretches(batches: Batches, size: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts hold about ``size`` bytes together (a longer text is alone)."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text"))
        at, total = 0, 0
        held: list[bytes] = []
        for i in range(batch.num_rows):
            text = texts[i].as_py().encode()
            if held and total + len(text) > size:
                yield batch.slice(at, i - at), held
                at, total, held = i, 0, []
            held.append(text)
            total += len(text)
        if held:
            yield batch.slice(at, batch.num_rows - at), held


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    return np.frombuffer(b"".join(texts), np.uint8), ends - size, ends


def anchor_rows(batches: Batches) -> Batches:
    """h (gram), ord, row, place (position, or its complement if settled), around (hash of the surroundings)."""
    for part, texts in stretches(batches, STRETCH):
        data, starts, ends = layout(texts)
        if len(data) < WINDOW:
            continue
        hashed = Hashes(data)
        at, _, _ = anchors(hashed, starts, ends, WINDOW, GRAM)
        if not len(at):
            continue
        doc = np.searchsorted(ends, at, side="right")
        lo, hi = np.maximum(at - REST, starts[doc]), np.minimum(at + WINDOW, ends[doc])
        gram = mixed(hashed.of(at, at + GRAM))
        around = mixed(hashed.of(lo, hi) + ((at - lo) * 128 + (hi - at)).astype(np.uint64) * OTHER)
        order, row = part.column(1).to_numpy()[doc], part.column(0).to_numpy()[doc]
        place = at - starts[doc]
        by = np.lexsort((order, around, gram))
        new = np.append(True, (gram[by][1:] != gram[by][:-1]) | (around[by][1:] != around[by][:-1]))
        first = order[by][np.flatnonzero(new)][np.cumsum(new) - 1]
        settled = np.zeros(len(at), bool)
        settled[by] = order[by] > first
        gram = np.where(settled, mixed(row.view(np.uint64) * OTHER + place.astype(np.uint64)), gram)
        signed = np.where(settled, ~place, place).astype(np.int32)
        columns = [pa.array(gram.view(np.int64)), pa.array(order), pa.array(row), pa.array(signed), pa.array(np.where(settled, 0, around.view(np.int64)))]
        yield pa.RecordBatch.from_arrays(columns, ["h", "ord", "row", "place", "around"])


def settle(table: pa.Table) -> pa.RecordBatch:
    """row, place, h: h is null where all surroundings are covered; otherwise the surroundings are to be fetched."""
    h, order, row, place, around = (table[c].to_numpy() for c in ("h", "ord", "row", "place", "around"))
    done = place < 0
    keep = ~done
    idx = np.flatnonzero(keep)
    by = idx[np.lexsort((order[idx], around[idx], h[idx]))]
    g = h[by]
    new_gram = np.append(True, g[1:] != g[:-1]) if len(by) else np.zeros(0, bool)
    new = new_gram | (np.append(True, around[by][1:] != around[by][:-1]) if len(by) else new_gram)
    first = order[by][np.flatnonzero(new)][np.cumsum(new) - 1] if len(by) else order[by]
    full = order[by] > first
    gram = np.cumsum(new_gram) - 1
    kinds = np.bincount(gram[new]) if len(by) else np.zeros(0, int)
    fetch = ~full & (kinds[gram] > 1) if len(by) else full
    out_row = np.concatenate((row[done], row[by[full]], row[by[fetch]]))
    out_place = np.concatenate((~place[done], place[by[full]], place[by[fetch]])).astype(np.int32)
    settled = int(done.sum() + full.sum())
    grams = pa.array(np.concatenate((np.zeros(settled, np.int64), h[by[fetch]])), mask=np.arange(len(out_row)) < settled)
    return pa.RecordBatch.from_arrays([pa.array(out_row), pa.array(out_place), grams], ["row", "place", "h"])


def whole(work: Callable[[pa.Table], pa.RecordBatch]) -> Callable[[Batches], Batches]:
    """``work`` on all rows of a partition at once: its share of the anchors."""

    def run(batches: Batches) -> Batches:
        held = list(batches)
        if held:
            yield work(pa.Table.from_batches(held))

    return run


def surroundings(batches: Batches) -> Batches:
    """h, ord, row, place, around: the REST bytes before, the gram and the REST bytes after, filled up with 0xFF."""
    for part, texts in stretches(batches, STRETCH):
        cols = {n: part.column(i) for i, n in enumerate(part.schema.names)}
        out: list[tuple] = []
        for text, row, order, places in zip(texts, cols["row"].to_pylist(), cols["ord"].to_pylist(), cols["places"].to_pylist()):
            for p in places:
                at = p["place"]
                left, right = text[max(at - REST, 0) : at], text[at : at + WINDOW]
                out.append((p["h"], order, row, at, left.rjust(REST, b"\xff") + right.ljust(WINDOW, b"\xff")))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
            ["h", "ord", "row", "place", "around"],
        )


def rims(table: pa.Table) -> pa.RecordBatch:
    """row, place, mask: bit o says that the window that begins o bytes before the anchor is found under a smaller id."""
    n, wide = table.num_rows, REST + WINDOW
    order = table["ord"].to_numpy()
    data = np.frombuffer(b"".join(table["around"].to_pylist()), np.uint8)
    square = data.reshape(n, wide)
    left = (square[:, :REST] != 255).sum(1)
    right = (square[:, REST + GRAM :] != 255).sum(1)
    hashed = Hashes(data)
    at = np.arange(n, dtype=np.int64) * wide + REST
    gram = table["h"].to_numpy()
    by = suffix_sort(hashed, at, WINDOW, gram)
    common = np.append(0, hashed.common(at[by][1:], at[by][:-1], np.full(n - 1, WINDOW)))
    common[1:][gram[by][1:] != gram[by][:-1]] = 0
    same = square[by][:, REST:]
    differ = np.append(True, (same[1:] != same[:-1]).any(1))
    first_off = np.where(differ[1:], (same[1:] != same[:-1]).argmax(1), WINDOW)
    common[1:] = np.minimum(common[1:], first_off)  # bytes decide where hashes collide
    mask = np.zeros(n, np.int64)
    for o in range(REST + 1):
        run = np.cumsum(common < WINDOW - o)
        ok = (left[by] >= o) & (right[by] >= REST - o)
        rows = np.flatnonzero(ok)
        if len(rows) < 2:
            continue
        me = by[rows]
        before = hashed.of(at[me] - o, at[me])
        sub = np.lexsort((order[me], before, run[rows]))
        a, b, r = me[sub], before[sub], run[rows][sub]
        equal = (r[1:] == r[:-1]) & (b[1:] == b[:-1])
        if o:
            near = np.flatnonzero(equal)
            true = (square[a[near + 1], REST - o : REST] == square[a[near], REST - o : REST]).all(1)
            equal[near[~true]] = False
        new = np.append(True, ~equal)
        least = order[a][np.flatnonzero(new)][np.cumsum(new) - 1]
        mask[a] |= (order[a] > least).astype(np.int64) << o
    hit = np.flatnonzero(mask)
    return pa.RecordBatch.from_arrays(
        [pa.array(table["row"].to_numpy()[hit]), pa.array(table["place"].to_numpy()[hit]), pa.array(mask[hit].astype(np.int32))], ["row", "place", "mask"]
    )


def removed(text: bytes, places: list[dict] | None) -> tuple[bytes, int, int]:
    """(the bytes that stay, bytes removed, maximal runs removed)."""
    if not places:
        return text, 0, 0
    n = len(text)
    at = np.array([p["place"] for p in places], np.int64)
    mask = np.array([p["mask"] for p in places], np.int64)
    full = at[mask < 0]
    begin, end = [np.maximum(full - REST, 0)], [np.minimum(full + WINDOW, n)]
    rim, bits = at[mask > 0], mask[mask > 0]
    for o in range(REST + 1):
        some = rim[(bits >> o) & 1 == 1] - o
        begin.append(some)
        end.append(some + WINDOW)
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, np.concatenate(begin), 1)
    np.add.at(depth, np.concatenate(end), -1)
    out = np.cumsum(depth[:-1]) > 0
    kept = np.frombuffer(text, np.uint8)[~out].tobytes()
    return kept, n - len(kept), int((out[1:] & ~out[:-1]).sum() + out[0])


def covered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (row, ord, doc_id, text), and per row the places and masks that say what is covered."""
    spark = docs.sparkSession
    rows = rows_of(docs)
    placed = rows.select("row", "ord", "text").mapInArrow(anchor_rows, "h long, ord long, row long, place int, around long")
    found = saved(placed.repartition("h").mapInArrow(whole(settle), "row long, place int, h long"))
    del placed
    released(spark)
    wanted = found.where("h is not null").groupBy("row").agg(F.collect_list(F.struct("place", "h")).alias("places"))
    fetched = rows.select("row", "ord", "text").join(wanted, "row").select("row", "ord", "text", "places")
    fetched = fetched.mapInArrow(surroundings, "h long, ord long, row long, place int, around binary")
    masks = saved(fetched.repartition("h").mapInArrow(whole(rims), "row long, place int, mask int"))
    del fetched
    released(spark)
    every = found.where("h is null").select("row", "place", F.lit(-1).alias("mask")).union(masks)
    return rows, every.groupBy("row").agg(F.collect_set(F.struct("place", "mask")).alias("places"))


def digests(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, places = covered(docs)

    def digest(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for text, where in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = text.encode()
                    kept, gone, runs = removed(raw, where)
                    out.append((len(raw), gone, runs, hashlib.sha256(kept).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([o[i] for o in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    joined = rows.join(places, "row", "left").select("doc_id", "text", "places")
    return joined.mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))

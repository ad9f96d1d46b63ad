"""Operator 1, LM scoring: cross-entropy difference of two matched n-gram models.

Both models have the same vocabulary (the 256 bytes of UTF-8, after ``normal``), the same orders 1 to ORDER and the same
weights; only their counts differ. The target model counts the documents labelled good and not toxic, the background
model counts all documents. Every byte of every document is counted. The loss of a token is the negative logarithm of

    sum over orders k of WEIGHTS[k] * count(context of k - 1 tokens, token) / count(context) + WEIGHTS[0] / 256

and a document's score is the mean over its tokens of target loss minus background loss: the lower, the more it is like
the target. Documents begin with ORDER - 1 marks, so their first tokens have a context too.

Counts are exact and kept under the n-grams themselves, in tables that grow with the corpus. Texts are packed into blocks
of about BLOCK bytes, the parts of which may come from several tasks; the distinct n-grams of the highest order are
counted by block, and their sums over blocks give all lower orders, as an n-gram's last bytes are one too. Since an n-gram of the highest order holds all contexts of its last
byte, the loss of a place depends on that n-gram alone: losses are worked out once for each, by joins of neighbouring
orders, and are joined to the blocks' distinct n-grams. A task then scores a block's texts with that block's losses, so
it holds what one block needs and no task or driver holds a model.

Null and empty texts have no tokens and a null score. Without target documents all target counts are zero and only the
uniform part is left. Repeated rows and repeated labels: a document is a target document once for each of its rows, if
any of its labels says so; a null id has no label. Extra columns are left out of the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .repeated_bytes import released
from .shared import documents, saved

ORDER = 5
#: Bits of an n-gram's key, by order: all of its bytes.
BITS = {k: 8 * k for k in range(1, ORDER + 1)}
WEIGHTS = [0.02, 0.08, 0.15, 0.2, 0.25, 0.3]
PIECE = 1 << 20
BLOCK = 1 << 24
ROWS = 256


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def codes(data: np.ndarray) -> np.ndarray:
    """The n-grams of the highest order that end at each place of ``data`` after the first ORDER - 1, last byte lowest."""
    n = len(data) - ORDER + 1
    code = np.zeros(n, np.int64)
    for begin in range(ORDER):
        code = (code << 8) | data[begin : begin + n]
    return code


def padded(text: bytes) -> np.ndarray:
    return np.frombuffer(bytes(ORDER - 1) + text, np.uint8)


def stretches(data: np.ndarray) -> Iterator[np.ndarray]:
    """Overlapping parts of a long text, so that memory stays bounded; each place is the end of n-grams in one of them."""
    for at in range(ORDER - 1, len(data), PIECE):
        yield data[at - ORDER + 1 : at + PIECE]


def ends(arrays: list[np.ndarray]) -> np.ndarray:
    """Where the n-grams of joined texts end: all places but those whose n-gram would begin in the text before."""
    n = np.array([len(a) for a in arrays])
    keep = np.ones(n.sum(), bool)
    begin = np.cumsum(n) - n
    for k in range(ORDER - 1):
        keep[begin + k] = False
    return keep[ORDER - 1 :]


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(c[order], first) if len(first) else c[:0] for c in counts)


def parts(rows: DataFrame) -> DataFrame:
    """Texts and n-grams by part of a block. Text rows: part, size, doc_id, data (the normal text). N-gram rows: part, code,
    and how often it occurs in the part's target texts and in all of them, one row for each distinct n-gram of a part.

    ``rows``: doc_id, text, target (boolean). Parts are numbered at random; two of one number only share a table.
    """
    names = ["part", "size", "doc_id", "data", "code", "target", "background"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def made(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, kind)) for name, kind in zip(names, types)], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = uuid.uuid4().int >> 65, 0
        waiting: dict[bool, list[np.ndarray]] = {True: [], False: []}
        found: list[tuple[np.ndarray, np.ndarray]] = []  # (code and target as one key, how often)

        def flush() -> None:
            for target, arrays in waiting.items():
                if arrays:
                    key = (codes(np.concatenate(arrays))[ends(arrays)] << 1) | target
                    found.append(np.unique(key, return_counts=True))
                    arrays.clear()
            if len(found) > 8:
                found[:] = [summed(*map(np.concatenate, zip(*found)))]

        def grams() -> Iterator[pa.RecordBatch]:
            flush()
            if not found:
                return
            keys, n = map(np.concatenate, zip(*found))
            found.clear()
            code, target, background = summed(keys >> 1, n * (keys & 1), n)
            for at in range(0, len(code), 1 << 16):
                some = slice(at, at + (1 << 16))
                m = len(code[some])
                yield made(m, part=pa.array(np.full(m, number)), code=pa.array(code[some]), target=pa.array(target[some]), background=pa.array(background[some]))

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                data = list(map(normal, part.column(1).to_pylist()))
                sizes = pa.array(map(len, data), pa.int64())
                yield made(len(data), part=pa.array(np.full(len(data), number)), size=sizes, doc_id=part.column(0), data=pa.array(data, pa.binary()))
                for text, target in zip(data, part.column(2).to_pylist()):
                    for stretch in stretches(padded(text)):
                        waiting[bool(target)].append(stretch)
                        held += len(stretch)
                        if held > 4 * PIECE:
                            flush()
                            held = 0
                    size += len(text)
                if size >= BLOCK:
                    yield from grams()
                    number, size, held = uuid.uuid4().int >> 65, 0, 0
        yield from grams()

    return rows.select("doc_id", "text", "target").mapInArrow(count, "part long, size long, doc_id long, data binary, code long, target long, background long")


def last(code: Column, k: int) -> Column:
    return code.bitwiseAND(F.lit((1 << BITS[k]) - 1))


def losses(grams: DataFrame) -> DataFrame:
    """(code, target_loss, background_loss) of each n-gram of the highest order. ``grams``: code, target, background."""
    both = ["target", "background"]
    counts = {ORDER: saved(grams.groupBy("code").agg(*(F.sum(m).alias(m) for m in both)))}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = saved(counts[k + 1].groupBy(last(F.col("code"), k).alias("code")).agg(*(F.sum(m).alias(m) for m in both)))
    totals = counts[1].agg(*(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in both)).first()

    def share(m: str, base: Column) -> Column:
        # texts' beginnings may exceed their context's count
        return F.least(F.col(m) / F.greatest(base, F.lit(1)), F.lit(1.0))

    chance = counts[1].select("code", *((F.lit(WEIGHTS[0] / 256) + WEIGHTS[1] * share(m, F.lit(totals[m]))).alias(f"p_{m}") for m in both))
    for k in range(2, ORDER + 1):
        before = counts[k - 1].select(F.col("code").alias("context"), *(F.col(m).alias(f"n_{m}") for m in both))
        shorter = chance.select(F.col("code").alias("shorter"), *(f"p_{m}" for m in both))
        met = counts[k].join(before, F.shiftright("code", 8) == F.col("context"), "left").join(shorter, last(F.col("code"), k - 1) == F.col("shorter"))
        chance = met.select("code", *((F.col(f"p_{m}") + WEIGHTS[k] * share(m, F.coalesce(f"n_{m}", F.lit(0)))).alias(f"p_{m}") for m in both))
    return chance.select("code", *((-F.log(f"p_{m}")).alias(f"{m}_loss") for m in both))


def scored(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """Per text: doc_id, n_tokens, target_loss, background_loss (means), score.

    ``texts``: block, doc_id, data; ``grams``: block, code, target_loss, background_loss, all n-grams of a block once.
    """

    def means(part: pa.RecordBatch, table: np.ndarray, loss: np.ndarray) -> pa.RecordBatch:
        sums, n = np.zeros((2, part.num_rows)), np.zeros(part.num_rows, np.int64)
        arrays, owners = [], []
        for i, text in enumerate(part.column(2).to_pylist()):
            for stretch in stretches(padded(text)):
                arrays.append(stretch)
                owners.append(i)
                n[i] += len(stretch) - ORDER + 1
        # stretches are scored together, PIECE bytes or so at a time
        at = 0
        while at < len(arrays):
            to, size = at, 0
            while to < len(arrays) and (size == 0 or size + len(arrays[to]) <= PIECE):
                size += len(arrays[to])
                to += 1
            found = np.searchsorted(table, codes(np.concatenate(arrays[at:to]))[ends(arrays[at:to])])
            own = np.repeat(owners[at:to], [len(a) - ORDER + 1 for a in arrays[at:to]])
            for m in range(2):
                sums[m] += np.bincount(own, loss[m][found], part.num_rows)
            at = to
        mean = [[None if not k else round(float(s) / int(k), 6) for s, k in zip(sums[m], n)] for m in range(2)]
        diff = [None if a is None else round(a - b, 6) for a, b in zip(*mean)]
        return pa.RecordBatch.from_arrays(
            [part.column(1), pa.array(n), *(pa.array(x, pa.float64()) for x in (*mean, diff))],
            ["doc_id", "n_tokens", "target_loss", "background_loss", "score"],
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block: first its n-grams in order, then its texts."""
        now, held = None, []
        table, loss = np.zeros(0, np.int64), np.zeros((2, 0))
        for batch in batches:
            block, gram = batch.column(0).to_numpy(), batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (gram[1:] != gram[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(begin, end - begin)
                if not len(part):
                    continue
                if block[begin] != now:
                    now, held = block[begin], []
                    table, loss = np.zeros(0, np.int64), np.zeros((2, 0))
                if gram[begin]:
                    held.append([part.column(c).to_numpy() for c in (3, 4, 5)])
                    continue
                if held:
                    table, *both = map(np.concatenate, zip(*held))
                    loss, held = np.array(both), []
                for at in range(0, len(part), ROWS):
                    yield means(part.slice(at, ROWS), table, loss)

    none = F.lit(None).cast
    texts = texts.select("block", "doc_id", "data", *(none(t).alias(c) for c, t in grams.dtypes[1:]))
    both = texts.unionByName(grams.withColumns({"doc_id": none("long"), "data": none("binary")}))
    sorted_ = both.repartition("block").sortWithinPartitions("block", F.col("code").asc_nulls_last())
    return sorted_.mapInArrow(score, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def lm_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
    # a merge join whatever the number of labels: it costs one shuffle of the texts at every size
    rows = docs.select("doc_id", "text").join(good.hint("merge"), F.col("doc_id") == F.col("_good"), "left")
    packed = saved(parts(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("_good").isNotNull().alias("target"))))
    released(docs.sparkSession)
    n = max(1, -(-(packed.agg(F.sum("size")).first()[0] or 0) // BLOCK))
    packed = packed.withColumn("block", F.pmod("part", F.lit(n)))
    # parts of one block have their n-grams in common, so what is joined does not grow with the number of tasks
    grams = packed.where("code is not null").groupBy("block", "code").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    grams = saved(grams)
    priced = grams.select("block", "code").join(losses(grams), "code").select("block", "code", "target_loss", "background_loss")
    return scored(packed.where("code is null").select("block", "doc_id", "data"), priced)


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

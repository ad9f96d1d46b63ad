"""Operator 9, quality classifier: ordinal cumulative-link regression on graded ratings.

Grades: 0 toxic, 1 poor, 2 good (from the tables' labels). One weight vector w over hashed text features is shared by all
thresholds t_0 < t_1, and P(grade > j) = sigmoid(w . x - t_j); the thresholds stay ordered because their distance is fitted
as a logarithm. Features: each distinct lower-cased word (letters and digits, so punctuation glued to a word is no new
word) and each distinct glued mark of a word, hashed to 2 ** BITS weights; every feature of a document counts once, and
weights are pulled towards zero, and those
of features that fewer than RARE rows of the sample have stay there, so that chance words do not add up.

The model is fitted on a bounded sample: SAMPLE labelled rows at most, those with the smallest hashes of id and text, each
with its whole text's features. Everything else covers all rows: every document is scored over its whole text and returned
with its expected grade, P(grade >= 1), P(grade >= 2) and whether it is selected (the latter at least TAIL).

Null and empty texts have no features and get the prior. Null grades are left out of the fit; with fewer than two grades
in the sample nothing is learned and all documents are selected. A document with several labels counts with its lowest
grade. Repeated rows get equal scores; extra columns are left out of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

BITS = 18
SAMPLE = 20_000
TAIL = 0.4
EPOCHS = 12
RATE = 0.1
DECAY = 1e-3
#: Features of fewer rows of the sample keep weight zero.
RARE = 20
#: Lengths of the beginnings of words that are features too: inflected words share them.
STEMS = (4, 6)
CACHE = 500_000
_CORE = re.compile(r"[^\W_]+")


class Hashed(dict):
    """Word -> its feature numbers; those met first are kept."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        core = _CORE.findall(word)
        marks = _CORE.sub("", word)
        names = core + [f"{c[:n]}-" for c in core for n in STEMS if len(c) > n] + ([f" {marks}"] if marks else []) + (["  upper"] if word.isupper() and len(word) > 2 else [])
        found = tuple(xxhash.xxh32_intdigest(n.lower().encode()) >> (32 - BITS) for n in names)
        if len(self) < CACHE:
            self[word] = found
        return found


_hashed = Hashed()


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers of a whole text, in order."""
    words = set((text or "").split())
    return np.array(sorted({i for w in words for i in _hashed[w]}), np.int32)


class Model:
    """Shared weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: list[float]):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def above(self, x: np.ndarray) -> list[float]:
        """P(grade > j) for each threshold."""
        score = float(self.weights[x].sum(dtype=np.float64))
        return [1 / (1 + np.exp(-np.clip(score - t, -40, 40))) for t in self.thresholds]


def fit(rows: list[tuple[np.ndarray, int]]) -> Model | None:
    """AdaGrad on the likelihood of grades; ``rows`` in a fixed order, so that the same sample gives the same model."""
    grades = sorted({g for _, g in rows})
    if len(grades) < 2:
        return None
    # features of one sampled row or few say nothing about others
    spread = np.bincount(np.concatenate([x for x, _ in rows]), minlength=1 << BITS)
    rows = [(x[spread[x] >= RARE], g) for x, g in rows]
    n = np.array([sum(g == k for _, g in rows) for k in range(3)], float) + 1
    share = n[::-1].cumsum()[::-1] / n.sum()
    t0 = -np.log(share[1] / (1 - share[1]))
    t1 = -np.log(share[2] / (1 - share[2]))
    gap = np.log(max(t1 - t0, 0.1))
    w, seen = np.zeros(1 << BITS), np.ones(1 << BITS)
    seen_t, seen_g = 1e-1, 1e-1
    order = np.random.default_rng(7)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            x, g = rows[i]
            s = w[x].sum()
            t1 = t0 + np.exp(gap)
            a, b = sigmoid(s - t0), sigmoid(s - t1)
            # likelihood: 1 - a, a - b, b
            da, db = a * (1 - a), b * (1 - b)
            if g == 0:
                ds, d0, d1 = -a, a, 0.0
            elif g == 1:
                p = max(a - b, 1e-9)
                ds, d0, d1 = (da - db) / p, -da / p, db / p
            else:
                ds, d0, d1 = 1 - b, 0.0, -(1 - b)
            if len(x):
                grad = ds - DECAY * w[x]
                seen[x] += grad * grad
                w[x] += RATE * grad / np.sqrt(seen[x])
            d0 += d1
            dg = d1 * np.exp(gap)
            seen_t += d0 * d0
            seen_g += dg * dg
            t0 += RATE * d0 / np.sqrt(seen_t)
            gap += RATE * dg / np.sqrt(seen_g)
    return Model(w, [float(t0), float(t0 + np.exp(gap))])


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good; the lowest of a document's grades."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).when(F.col("quality") == 0, 1)
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(grade).alias("grade")).where("grade is not null")


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of at most ``sample`` labelled rows, chosen by hash before any text is moved."""
    ids = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.list_(pa.int32()))], ["doc_id", "grade", "x"])

    found = rows.mapInArrow(extract, "doc_id long, grade int, x array<int>")
    table = found.toArrow()
    x = pa.concat_arrays(table["x"].chunks) if table.num_rows else pa.array([], pa.list_(pa.int32()))
    ends, values = x.offsets.to_numpy(), x.values.to_numpy()
    kept = {
        (i, tuple(values[a:b])): (values[a:b], g)
        for i, g, a, b in zip(table["doc_id"].to_pylist(), table["grade"].to_pylist(), ends, ends[1:])
    }
    return fit([kept[k] for k in sorted(kept)][:sample]) if kept else None


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: doc_id, expected_grade, p_not_toxic (P(grade >= 1)), p_good (P(grade >= 2)), selected."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select("doc_id", none.alias("expected_grade"), none.alias("p_not_toxic"), none.alias("p_good"), F.lit(True).alias("selected"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                p = np.round([sent.value.above(features(t)) for t in part.column(1).to_pylist()], 6).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.round(p.sum(1), 6)), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(p[:, 1] >= TAIL)],
                    ["doc_id", "expected_grade", "p_not_toxic", "p_good", "selected"],
                )

    return rows.mapInArrow(score, "doc_id long, expected_grade double, p_not_toxic double, p_good double, selected boolean")


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scored(docs, trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

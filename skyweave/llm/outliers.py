"""Operator 5, quality rules: base rules, then robust multivariate outliers, by DataFrame functions only.

Base statistics of a text: words ``[^\\x20\\x09-\\x0D]+``, their code points, symbols ``[#*$%&|<>]``, lines that equal an
earlier line, and words that lie in a three-word window found twice or more. A text with fewer than MIN_WORDS words, or
with more than half of its words repeated, fails.

The others are judged by a minimum-covariance-determinant estimate for their language and source. Each has a vector of
FEATURES, rounded to 1/SCALE so that all sums are whole numbers and come out the same on every run. A cell starts from
its medians and median deviations; each concentration step takes the share KEEP of its rows that lie nearest and works
mean and covariance out anew. Rows whose squared Mahalanobis distance exceeds the chi-square quantile LEVEL are rejected.
Deviations smaller than FLOORS are not told apart: where most texts have no symbol at all, one symbol is no outlier.

Cells with fewer than MIN_CELL rows are pooled by language, and pools that are still smaller over all languages; with
fewer than MIN_CELL rows there too, nothing is rejected. All counts and statistics are over all rows; sums and distance
histograms combine before their shuffles, so a cell with a third of all rows is no task of its own.

Null texts have no words and fail. Null languages and sources make cells of their own. Repeated rows count as often as
they occur and get equal verdicts. Columns of other names are left out of the result; ``keep_good`` passes them through.
"""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACE, documents, fresh, saved, word_array

MIN_WORDS = 50
MIN_CELL = 100
KEEP = 0.75
LEVEL = 0.9999
STEPS = 5
SCALE = 1024
#: Name -> smallest standard deviation taken as real, in units of the transformed statistic.
FLOORS = {"word_length": 0.06, "symbols": 0.06, "repeats": 0.15, "lines": 0.12}
FEATURES = list(FLOORS)
#: Cells that are broadcast; about 200 bytes each.
CELLS = 10_000
#: Steps of the histogram of log2 of the squared distance.
FINE = 64


def base_statistics(text: Column) -> dict[str, Column]:
    """Named columns to be selected one after the other (each may use those before it)."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    windows = F.when(
        F.col("n_words") >= 3,
        F.transform(
            F.sequence(F.lit(1), (F.col("n_words") - 2).cast("int")),
            lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return {
        "words": word_array(text),
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long"),
        "_lines": lines,
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": windows,
        "n_repeat_words": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), covered("_windows")).otherwise(F.lit(0)).cast("long"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    }


def covered(windows: str) -> Column:
    """Words inside windows whose hash occurs more than once: the union of [i, i + 3) over their sorted positions."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def union(s: Column) -> Column:
        again = F.filter(
            s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
        )
        # a null neighbour (beyond either end) makes the comparison null, which filter takes for false unless the other holds
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        return F.aggregate(
            at,
            F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
            lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    return F.aggregate(F.array(placed), F.lit(0), lambda _, s: union(s))


def vectors() -> dict[str, Column]:
    """Transformed statistics, as whole numbers of 1/SCALE."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    raw = {
        "word_length": F.log(chars / n),
        "symbols": F.sqrt(F.col("n_symbols") / chars),
        "repeats": F.sqrt(F.col("n_repeat_words") / n),
        "lines": F.sqrt(F.col("n_dup_lines") / n),
    }
    return {k: F.round(raw[k] * SCALE).cast("long") for k in FEATURES}


def chi_square(p: int, x: float) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - exp(-x / 2) * sum((x / 2) ** i / factorial(i) for i in range(p // 2))


def chi_square_quantile(p: int, level: float) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square(p, mid) < level else (lo, mid)
    return hi


def factor(cells: DataFrame, spread: float) -> DataFrame:
    """Cells with their Cholesky factor ``l_i_j``, one entry after the other."""
    for i in range(len(FEATURES)):
        for j in range(i + 1):
            rest = F.col(f"s_{i}_{j}") * spread
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            floor = (FLOORS[FEATURES[i]] * SCALE) ** 2
            cells = cells.withColumn(f"l_{i}_{j}", rest / F.col(f"l_{j}_{j}") if j < i else F.sqrt(F.greatest(rest, F.lit(floor))))
    return cells


def moments(rows: DataFrame) -> DataFrame:
    """Mean ``m_i`` and covariance ``s_i_j`` of each cell, from exact sums."""
    p = range(len(FEATURES))
    sums = rows.groupBy("cell").agg(
        F.count("*").alias("n"),
        *(F.sum(FEATURES[i]).alias(f"t_{i}") for i in p),
        *(F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(20,0)")).alias(f"t_{i}_{j}") for i in p for j in range(i + 1)),
    )
    mean = {i: F.col(f"t_{i}") / F.col("n") for i in p}
    return sums.select(
        "cell",
        "n",
        *(mean[i].alias(f"m_{i}") for i in p),
        *((F.col(f"t_{i}_{j}").cast("double") / F.col("n") - mean[i] * mean[j]).alias(f"s_{i}_{j}") for i in p for j in range(i + 1)),
    )


def starts(rows: DataFrame) -> DataFrame:
    """Medians and median deviations of each cell. Values are whole numbers of a bounded range, so exact medians take
    one counter per value."""
    p = range(len(FEATURES))
    middle = saved(rows.groupBy("cell").agg(*(F.percentile(FEATURES[i], 0.5).alias(f"m_{i}") for i in p)))
    off = attach(rows, middle).groupBy("cell").agg(
        *(F.percentile(F.abs(F.round(F.col(FEATURES[i]) - F.col(f"m_{i}"))), 0.5).alias(f"d_{i}") for i in p)
    )
    return middle.join(off, "cell").select(
        "cell",
        *(f"m_{i}" for i in p),
        *((F.pow(1.4826 * F.col(f"d_{i}"), 2) if i == j else F.lit(0.0)).alias(f"s_{i}_{j}") for i in p for j in range(i + 1)),
    )


def attach(rows: DataFrame, cells: DataFrame, on: str | list[str] = "cell", how: str = "inner") -> DataFrame:
    """Join with a saved table of cells: broadcast up to CELLS of them, beyond that by a plain join AQE may split."""
    return rows.join(F.broadcast(cells) if cells.count() <= CELLS else cells, on, how)


def cell_names(rows: DataFrame) -> DataFrame:
    """(c_lang, c_source, cell). ``cell`` is language and source; the language, or all languages, where rows are too
    few; null where they still are."""
    counts = rows.groupBy("lang", "source").count()
    pool = counts.where(F.col("count") < MIN_CELL).groupBy("lang").agg(F.sum("count").alias("pool"))
    rest = pool.where(F.col("pool") < MIN_CELL).agg(F.coalesce(F.sum("pool"), F.lit(0))).first()[0]
    return saved(
        counts.alias("c")
        .join(pool.alias("p"), F.col("c.lang").eqNullSafe(F.col("p.lang")), "left")
        .select(
            F.col("c.lang").alias("c_lang"),
            F.col("c.source").alias("c_source"),
            F.when(F.col("count") >= MIN_CELL, F.to_json(F.struct(F.lit("source").alias("by"), "c.lang", "c.source")))
            .when(F.col("pool") >= MIN_CELL, F.to_json(F.struct(F.lit("lang").alias("by"), "c.lang")))
            .when(F.lit(rest >= MIN_CELL), F.lit("{}"))
            .alias("cell"),
        )
    )


def with_cells(rows: DataFrame, names: DataFrame) -> DataFrame:
    same = F.col("lang").eqNullSafe(F.col("c_lang")) & F.col("source").eqNullSafe(F.col("c_source"))
    return attach(rows, names, same, "left").drop("c_lang", "c_source")


def estimates(rows: DataFrame) -> DataFrame:
    """Per cell, mean and Cholesky factor after the concentration steps. ``rows``: cell and FEATURES."""
    p = len(FEATURES)
    inside = chi_square_quantile(p, KEEP)
    spread = KEEP / chi_square(p + 2, inside)  # what cutting the tails off took from the covariance
    now = saved(factor(starts(rows), 1.0))
    bins = F.ceil(F.log2(F.greatest(placed_distance(), F.lit(2.0**-20))) * FINE).cast("long")
    for _ in range(STEPS):
        far = attach(rows, now).select("cell", *FEATURES, bins.alias("bin"))
        cut = saved(far.groupBy("cell").agg(F.percentile("bin", KEEP).alias("cut")))
        now = saved(factor(moments(attach(far, cut).where(F.col("bin") <= F.col("cut"))), spread))
    return now


def placed_distance() -> Column:
    z, total = [], None
    for i, name in enumerate(FEATURES):
        part = F.col(name) - F.col(f"m_{i}")
        for k in range(i):
            part = part - F.col(f"l_{i}_{k}") * z[k]
        z.append(part / F.col(f"l_{i}_{i}"))
        total = z[i] * z[i] if total is None else total + z[i] * z[i]
    return total


STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(docs: DataFrame) -> DataFrame:
    """lang, source, doc_id and the base statistics of each row."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text")
    for name, column in base_statistics(F.col("text")).items():
        out = out.withColumn(name, column)
    return out.select("doc_id", "lang", "source", *STATISTICS, "base_failed")


def fitted(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cells' names and their estimates, from all rows of ``base`` (a saved table of ``statistics``)."""
    judged = base.where(~F.col("base_failed"))
    names = cell_names(judged)
    rows = saved(with_cells(judged, names).where("cell is not null").withColumns(vectors()).select("cell", *FEATURES))
    return names, estimates(rows)


def judge(rows: DataFrame, names: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (lang, source, STATISTICS, base_failed) with ``distance`` (squared; null if not judged) and ``kept``."""
    far = attach(with_cells(rows, names).withColumns(vectors()), found, "cell", "left")
    far = far.withColumn("distance", F.when(~F.col("base_failed"), placed_distance()))
    limit = chi_square_quantile(len(FEATURES), LEVEL)
    return far.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the statistics, base_failed, kept, distance."""
    base = saved(statistics(docs))
    return judge(base, *fitted(base)).select("doc_id", *STATISTICS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    found = fitted(saved(statistics(docs)))
    whole = fresh(docs, "row")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(whole))
    rows = rows.select(whole, *(F.col(f"{whole}.{c}").alias(c) for c in ("lang", "source", "text")))
    for name, column in base_statistics(F.col("text")).items():
        rows = rows.withColumn(name, column)
    # the generator keeps the filter from being pushed down, and the statistics from being worked out once for each use
    once = F.explode(F.array(F.struct("lang", "source", *STATISTICS, "base_failed"))).alias("s")
    return judge(rows.select(whole, once).select(whole, "s.*"), *found).where("kept").select(f"{whole}.*")


def op5_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(documents(spark, sf_dir))

"""Operator 10, personal data: base patterns, and further spans by boosted trees over candidates; DataFrame functions only.

Base spans (leftmost, not overlapping, per kind) follow the patterns of BASE and their checks; what fails a check is
dropped. Beside them high-recall generators (PROPOSALS) propose overlapping candidate spans of every kind: addresses
spelled with "at" and "dot", dotted quads of any size, long digit groups with or without a plus.

Labels come from one view of a candidate and the trees see the other: a candidate is positive if it meets a base span of
its kind, that is, if the checks hold (plus sign, check digit, parts up to 255, a written-out dot); the trees see only
format (digits, groups, separators, lengths) and context (words before, characters around). Features are small whole
numbers, so all candidates of all documents are counted into a bounded number of cells (CELL_BOUND); boosting runs over
the counts of one half of the documents, and isotonic calibration over those of the other. A candidate that meets no
base span is added if its calibrated probability, lowered by one unit of doubt, reaches THRESHOLD.

Positions are code points, ends are exclusive. Null texts have no spans; no candidates, or no positive ones, add nothing.
Ties in calibration take the smaller probability. Repeated rows are treated alike; extra columns are left out of the
result; ``redact`` passes them through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents, fresh

KINDS = ["email", "ip", "card", "phone"]
#: Possessive groups and look-behinds spare retries inside a run that has failed as a whole; they match the same spans.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)", r"(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
PROPOSALS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}" + _AT + r"[A-Za-z0-9-]{1,63}(?:" + _DOT + r"[A-Za-z0-9-]{1,63}){1,4}",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:(?:\.|\[\.\])[0-9]{1,4}){2,7}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){10,20}(?![0-9])",
    "phone": r"\+?\(?[0-9][\x20().0-9-]{6,24}[0-9]",
}
#: What a text must have for a pattern to be tried.
NEEDS = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
}
#: The same for PROPOSALS: each admits whatever its pattern can match.
PROPOSAL_NEEDS = {
    "email": r"@|[\[(](?:at|dot)[\])]|\x20dot\x20|\x20at\x20[A-Za-z0-9-]++\.",
    "ip": r"[0-9]\[?\.",
    "card": r"[0-9](?:[\x20-]?[0-9]){10}",
    "phone": r"[0-9][\x20().0-9-]{6}",
}
#: Words before a candidate that speak for its kind.
CONTEXT = {
    "email": r"mail|contact|write|reach",
    "ip": r"\bip\b|host|server|addr",
    "card": r"card|visa|credit|pay|account",
    "phone": r"tel|phone|call|fax|mobile|dial",
}
FEATURES = ["kind", "digits", "groups", "separators", "before", "after", "context", "length"]
SIZES = [4, 24, 8, 16, 4, 4, 3, 16]
CELL_BOUND = math.prod(SIZES) * 4
ROUNDS, RATE, DEPTH_LEAVES = 30, 0.3, 4
THRESHOLD = 0.95
RUN = 512


def prefix_sums(values: Column) -> Column:
    """Inclusive sums of an array of ints, in blocks of RUN: appending to one long list would be quadratic."""

    def sums(a: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(
            a,
            zero,
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"] + x)).alias("all")),
            lambda acc: acc["all"],
        )

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)

    def blocks(v: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), ((F.size(v) - 1) / RUN).cast("int")), lambda b: F.slice(v, b * RUN + 1, F.lit(RUN)))

        def joined(p: Column) -> Column:
            def shifted(offsets: Column) -> Column:
                def of(block: Column, b: Column) -> Column:
                    return once(F.coalesce(F.get(offsets, b - 1), F.lit(0)), lambda base: F.transform(sums(block), lambda x: x + base))

                return F.flatten(F.transform(p, of))

            return once(sums(F.transform(p, total)), shifted)

        return F.when(F.size(v) <= RUN, sums(v)).otherwise(once(parts, joined))

    return once(values, blocks)


def once(value: Column, use) -> Column:
    """``use`` of a value that is worked out one time, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def spans(text: Column, pattern: str, needs: str) -> Column:
    """Matches in order: s, e (code points), hit, the 24 characters before and the one after (within the gaps)."""
    nothing = F.array().cast("array<struct<s:int,e:int,hit:string,before:string,after:string>>")

    def placed(x: Column) -> Column:
        step = F.transform(x["hits"], lambda h, i: F.length(F.get(x["gaps"], i)) + F.coalesce(F.length(F.get(x["hits"], i - 1)), F.lit(0)))
        return once(
            prefix_sums(step),
            lambda at: F.transform(
                x["hits"],
                lambda h, i: F.struct(
                    F.get(at, i).alias("s"),
                    (F.get(at, i) + F.length(h)).alias("e"),
                    h.alias("hit"),
                    F.right(F.get(x["gaps"], i), F.lit(24)).alias("before"),
                    F.left(F.get(x["gaps"], i + 1), F.lit(1)).alias("after"),
                ),
            ),
        )

    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(F.coalesce(text.rlike(needs), F.lit(False)), once(cut, lambda x: F.when(F.size(x["hits"]) > 0, placed(x)).otherwise(nothing))).otherwise(nothing)


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Check digit of at most 19 digits."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: d.cast("int") * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def valid(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (F.coalesce(F.right(p, F.lit(9)).cast("int"), F.lit(0)) <= 255))
    many = F.length(digits_of(hit))
    if kind == "card":
        return many.between(12, 19) & F.when(many.between(12, 19), luhn(digits_of(hit))).otherwise(F.lit(False))
    return many.between(9, 15)


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the array of its (s, e, hit, before, after)."""

    def of(kind: str) -> Column:
        return F.filter(spans(text, BASE[kind], NEEDS[kind]), lambda x: valid(kind, x["hit"]))

    return {kind: of(kind) for kind in KINDS}


def around(c: Column) -> Column:
    return F.when(c.isNull() | c.rlike(r"^\s?$"), 0).when(c.rlike(r"^\p{L}$"), 1).when(c.rlike("^[0-9]$"), 2).otherwise(3)


def features(kind: str, x: Column) -> Column:
    """Format and context of a candidate; what the base checks decide on (plus, check digit, 255, a written dot) is left out."""
    hit = x["hit"]
    has = lambda pattern, bit: F.when(hit.rlike(pattern), bit).otherwise(0)
    if kind == "email":
        bare = F.regexp_replace(F.regexp_replace(hit, _DOT.replace(r"\.|", ""), "."), _AT, "@")
        count = F.lit(0)
        groups = F.size(F.split(F.substring_index(bare, "@", -1), r"\."))
        separators = has("-", 2) + has("_", 1)
        length = F.length(F.substring_index(bare, ".", -1))
    else:
        bare = F.regexp_replace(hit, r"[\[\]+]", "")
        count = F.length(digits_of(hit))
        groups = F.size(F.split(bare, r"[^0-9]+"))
        separators = has(" ", 1) + has("-", 2) + (has(r"\.", 4) if kind != "ip" else F.lit(0)) + has(r"\(", 8)
        length = F.array_max(F.transform(F.split(bare, r"[^0-9]+"), lambda p: F.length(p)))
    before = F.lower(x["before"])
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        F.least(count, F.lit(23)).alias("digits"),
        F.least(groups, F.lit(7)).alias("groups"),
        separators.cast("int").alias("separators"),
        around(F.right(x["before"], F.lit(1))).alias("before"),
        around(x["after"]).alias("after"),
        F.when(before.rlike(CONTEXT[kind]), 1).when(before.rlike("|".join(CONTEXT[k] for k in KINDS if k != kind)), 2).otherwise(0).alias("context"),
        F.least(length, F.lit(15)).alias("length"),
    )


def meets(x: Column, known: Column) -> Column:
    return F.exists(known, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))


def proposals(text: Column, base: dict[str, Column]) -> Column:
    """Candidates of all kinds: kind, s, e, positive (meets a base span of its kind), new (meets none), features f."""

    def of(kind: str) -> Column:
        found = spans(text, PROPOSALS[kind], PROPOSAL_NEEDS[kind])
        return F.transform(
            found,
            lambda x: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                x["s"].alias("s"),
                x["e"].alias("e"),
                meets(x, base[kind]).alias("positive"),
                (~F.greatest(*(meets(x, base[k]) for k in KINDS))).alias("new"),
                features(kind, x).alias("f"),
            ),
        )

    return F.concat(*(of(k) for k in KINDS))


class Trees:
    """Boosted regression trees over counted cells, and their calibration."""

    def __init__(self, cells: list[tuple[tuple[int, ...], int, int, int]]):
        """``cells``: (features, half, count, positives)."""
        import numpy as np

        self.trees: list[tuple] = []
        self.least_score = math.inf
        fit = [c for c in cells if c[1] == 0]
        hold = [c for c in cells if c[1] == 1]
        if not fit or not hold or not sum(c[3] for c in fit):
            return
        x, n, y = (np.array([c[i] for c in fit]) for i in (0, 2, 3))
        score = np.zeros(len(fit))
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-score))
            tree = self._tree(x, y - n * p, n * p * (1 - p))
            if tree is None:
                break
            self.trees.append(tree)
            score += self._value(tree, x)
        x, n, y = (np.array([c[i] for c in hold]) for i in (0, 2, 3))
        scores = np.round(sum(self._value(t, x) for t in self.trees) if self.trees else np.zeros(len(hold)), 6)
        blocks: list[list[float]] = []  # least score, count, positives: neighbours out of order are pooled
        for s in np.unique(scores):
            at = scores == s
            blocks.append([s, n[at].sum(), y[at].sum()])
            while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
                s2, n2, y2 = blocks.pop()
                blocks[-1][1] += n2
                blocks[-1][2] += y2
        good = [b[0] for b in blocks if b[2] / (b[1] + 1) >= THRESHOLD]
        self.least_score = min(good) if good else math.inf

    @staticmethod
    def _split(x, g, h, rows):
        best = (1e-9, None, None)
        G, H = g[rows].sum(), h[rows].sum()
        for j in range(x.shape[1]):
            for t in sorted(set(x[rows, j]))[:-1]:
                left = rows & (x[:, j] <= t)
                gl, hl = g[left].sum(), h[left].sum()
                gain = gl * gl / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G * G / (H + 1)
                if gain > best[0] + 1e-12:
                    best = (gain, j, int(t))
        return best

    def _tree(self, x, g, h):
        """(j, t, below, above), each side a leaf value or another such tuple; two levels."""
        import numpy as np

        def grow(rows, levels):
            if levels:
                _, j, t = self._split(x, g, h, rows)
                if j is not None:
                    return j, t, grow(rows & (x[:, j] <= t), levels - 1), grow(rows & (x[:, j] > t), levels - 1)
            return float(np.round(RATE * g[rows].sum() / (h[rows].sum() + 1), 6))

        tree = grow(np.ones(len(x), bool), int(math.log2(DEPTH_LEAVES)))
        return tree if isinstance(tree, tuple) else None

    def _value(self, tree, x):
        import numpy as np

        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        j, t, below, above = tree
        return np.where(x[:, j] <= t, self._value(below, x), self._value(above, x))

    def column(self, f: Column) -> Column:
        """Whether a candidate with features ``f`` is taken."""
        if not self.trees or self.least_score == math.inf:
            return F.lit(False)

        def of(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(tree)
            j, t, below, above = tree
            return F.when(f[FEATURES[j]] <= t, of(below)).otherwise(of(above))

        return F.round(sum((of(t) for t in self.trees[1:]), of(self.trees[0])), 6) >= F.lit(self.least_score)


def found_in(docs: DataFrame, more: list[Column]) -> tuple[DataFrame, str]:
    """``more`` columns, the text, ``b`` (base spans of each kind) and ``c`` (candidates); the name of the text column."""
    text = fresh(docs, "body")
    rows = docs.select(*more, F.coalesce(F.col("text"), F.lit("")).alias(text))
    # a generator's result is worked out once; a plain column could be put in place of each of its uses
    base = F.struct(*(c.alias(k) for k, c in base_spans(F.col(text)).items()))
    rows = rows.select("*", F.explode(F.array(base)).alias("b"))
    found = proposals(F.col(text), {k: F.col(f"b.{k}") for k in KINDS})
    return rows.select("*", F.explode(F.array(found)).alias("c")), text


def trained(docs: DataFrame) -> Trees:
    """Trees from the candidates of all documents; what comes to the driver is one row for each cell at most."""
    half = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(2)).cast("int")
    rows, _ = found_in(docs, [half.alias("half")])
    each = rows.select("half", F.explode("c").alias("c")).select("half", "c.f", "c.positive")
    counted = each.groupBy("f", "half").agg(F.count("*").alias("n"), F.sum(F.col("positive").cast("int")).alias("y"))
    cells = sorted((tuple(r["f"]), r["half"], r["n"], r["y"]) for r in counted.collect())
    return Trees(cells)


def all_spans(b: Column, c: Column, trees: Trees) -> tuple[Column, Column]:
    """Sorted (s, kind, e) of the base spans, and of all spans."""
    def of(kind: str) -> Column:
        return F.transform(b[kind], lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("kind"), x["e"].alias("e")))

    base = F.sort_array(F.concat(*(of(k) for k in KINDS)))
    added = F.transform(F.filter(c, lambda x: x["new"] & trees.column(x["f"])), lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))
    return base, F.sort_array(F.concat(base, added))


def written(found: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def private_spans(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Per row: doc_id, base counts, base_sha256, spans (all), n_added."""
    trees = trees or trained(docs)
    rows, _ = found_in(docs, [F.col("doc_id").cast("long").alias("doc_id")])
    base, every = all_spans(F.col("b"), F.col("c"), trees)
    rows = rows.select("doc_id", *(F.size(F.col(f"b.{k}")).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(written(base), 256).alias("base_sha256"), every.alias("every"))
    n_base = sum((F.col(f"n_{k}") for k in KINDS), F.lit(0))
    return rows.withColumns({"spans": written(F.col("every")), "n_added": F.size("every") - n_base}).drop("every")


def redact(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """``docs`` with every span's characters replaced by its kind in brackets; overlapping spans become one, named after
    the first. Other columns stay as they are; null texts stay null."""
    trees = trees or trained(docs)
    whole = fresh(docs, "row")
    rows, text = found_in(docs, [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(whole)])
    _, every = all_spans(F.col("b"), F.col("c"), trees)
    rows = rows.select(whole, text, F.explode(F.array(every)).alias("every"))

    def clean(t: Column, found: Column) -> Column:
        # a span that begins within those before it adds only its end; ends run as maxima
        def step(acc: Column, x: Column) -> Column:
            piece = F.when(x["s"] < acc["at"], F.lit("")).otherwise(F.concat(F.substring(t, acc["at"] + 1, x["s"] - acc["at"]), F.concat(F.lit("["), F.upper(F.get(F.array(*(F.lit(k) for k in KINDS)), x["kind"])), F.lit("]"))))
            return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(found, zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(t, acc["at"] + 1)))

    new = F.when(F.col(f"{whole}.text").isNull(), F.lit(None)).when(F.size("every") == 0, F.col(text)).otherwise(clean(F.col(text), F.col("every")))
    return rows.select(*((new if c == "text" else F.col(f"{whole}.`{c}`")).alias(c) for c in docs.columns))


def op10_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_spans(documents(spark, sf_dir))

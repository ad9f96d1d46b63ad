"""Operator 11, source divergence audit: hash-consed segment trees over term ids, priced pair by pair of groups.

Terms are runs of letters A-Z, a-z and of characters beyond ASCII, A-Z in lower case. A language keeps the terms that occur in at
least LEAST of its documents (rows). Over its kept terms each group (lang, source) and each language has the share
``p = 1 + floor(SCALE * (count + 1) / (N + V))``, N its occurrences of kept terms and V their number. A group differs from another
by the sum of ``floor((p - q)^2 / q)`` over all kept terms of the language, and from its language at a term likewise.

Counting: a block of texts becomes one count per (group, term) in Arrow and numpy, sent in one shuffle as one row for each
language and part of its terms, whatever term or source is hot; parts are cut by a hash and grow in number with the documents,
and a task puts one of them together at a time. A kept term is one row with its groups' counts. Terms get ids inside their
language, the most frequent first (``numbered``).

Pricing: ids are cut into blocks of LEAVES, and a row holds a block's counts of all groups of the language. In a block each
group is a segment tree whose leaves are counts. Nodes are interned by (left, right), so that equal subtrees are one node
anywhere: in rare terms almost all of a group is the one tree of zeros of its height. Two groups are compared by walking down
both trees together, and a pair of nodes is priced once for the pair of groups, in all blocks of a task. Prices are whole
numbers of any length. Blocks add up to the sum over all terms.

A block's row holds at most LEAVES counts for each source of its language. The list of groups is broadcast: the result has a
row for each two groups of a language, so that a result of 10^9 rows has at most some 32,000 groups in a language (some MB).

Nulls in text, lang and source are empty strings, and groups of empty names like any other. A text without terms makes its
group occur. Repeated rows are documents of their own. An empty table has no groups. Without kept terms a language has pairs
of value 0 and no terms. Ties are ordered by the item's UTF-8 bytes. Extra columns are left out. Texts of any length are cut
up where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ordering import numbered
from .shared import documents, saved

SCALE, LEAST, TOP = 1_000_000_000, 3, 200
#: Terms of a block (a power of two), bytes of text counted at a time, pairs and nodes a task remembers.
LEAVES, BLOCK, MEMO = 1024, 1 << 22, 300_000
#: Parts of a language's terms, so many for each DOCUMENTS of the table.
PARTS, DOCUMENTS = 512, 1 << 23
MIX = np.random.default_rng(11).integers(1, 1 << 63, 1024).astype(np.uint64) | np.uint64(1)
#: Bytes of terms, A-Z in lower case; all others are blanks.
LETTER = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of at most BLOCK bytes of text (third column) together, one row at least."""
    ends, at = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(), dtype=np.int64), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
        yield batch.slice(at, to - at)
        at = to


def block_counts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, text) to (lang, source, term, n, docs), one row per group and term."""
    langs, sources, texts = (batch.column(i) for i in range(3))
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    plain = LETTER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    texts = pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(plain))
    split = pc.split_pattern(texts, " ")
    words = split.flatten().dictionary_encode()
    terms = words.dictionary
    at = words.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    real = pc.binary_length(terms).to_numpy()[at] > 0 if len(at) else np.zeros(0, bool)
    at, doc = at[real], doc[real]
    names = pa.StructArray.from_arrays([langs, sources], ["l", "s"])
    l, s = langs.dictionary_encode(), sources.dictionary_encode()  # noqa: E741
    group = l.indices.to_numpy().astype(np.int64) * max(len(s.dictionary), 1) + s.indices.to_numpy()
    codes, first, group = np.unique(group, return_index=True, return_inverse=True)
    width = max(len(terms), 1)
    met, n = np.unique(group[doc] * width + at, return_counts=True)
    once = np.unique(doc * width + at)
    docs = np.unique(group[once // width] * width + once % width, return_counts=True)[1]
    where = names.take(pa.array(first[met // width]))
    return pa.RecordBatch.from_arrays([*where.flatten(), terms.take(pa.array(met % width)), pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))], ["lang", "source", "term", "n", "docs"])


def parts_of(terms: pa.StringArray, parts: int) -> np.ndarray:
    """The part, below ``parts``, of each term; terms are not empty."""
    offsets = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset : terms.offset + len(terms) + 1].astype(np.int64)
    plain = np.frombuffer(terms.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    at = np.arange(len(plain)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
    mixed = np.add.reduceat((plain.astype(np.uint64) + np.uint64(1)) * MIX[at % len(MIX)], offsets[:-1] - offsets[0])
    return ((mixed >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)


def packed(counts: pa.RecordBatch, parts: int) -> pa.RecordBatch:
    """``block_counts`` as one row for each language and part: its terms joined by blanks, counts, and runs of sources."""
    langs = counts.column(0).dictionary_encode()
    where = langs.indices.to_numpy().astype(np.int64) * parts + parts_of(counts.column(2), parts)
    order = np.argsort(where, kind="stable")  # sources stay together inside a part
    where, source = where[order], counts.column(1).dictionary_encode()
    named = source.indices.to_numpy()[order]
    begin = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
    runs = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (named[1:] != named[:-1])))
    ends = pa.array(np.append(begin, len(where)), pa.int32())
    run_ends = pa.array(np.append(np.searchsorted(runs, begin), len(runs)), pa.int32())
    listed = lambda at, values: pa.ListArray.from_arrays(at, values)
    columns = [
        langs.dictionary.take(pa.array(where[begin] // parts)),
        pa.array(where[begin] % parts, pa.int32()),
        listed(run_ends, source.dictionary.take(pa.array(named[runs]))),
        listed(run_ends, pa.array(np.diff(np.append(runs, len(where))), pa.int32())),
        pc.binary_join(listed(ends, counts.column(2).take(pa.array(order))), " "),
        *(listed(ends, counts.column(i).take(pa.array(order))) for i in (3, 4)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "part", "sources", "sizes", "terms", "n", "docs"])


def unpacked(table: pa.Table) -> pa.RecordBatch:
    """All rows of one language and part to its kept terms: (lang, term, n_lang, of), ``of`` the counts by source."""
    table = table.combine_chunks()
    flat = lambda name: table[name].combine_chunks().flatten()
    sources = flat("sources").dictionary_encode()
    names, width = sources.dictionary, len(sources.dictionary)
    source = np.repeat(sources.indices.to_numpy().astype(np.int64), flat("sizes").to_numpy())
    words = pc.split_pattern(table["terms"].combine_chunks(), " ").flatten().dictionary_encode()
    code = words.indices.to_numpy().astype(np.int64) * width + source
    order = np.argsort(code, kind="stable")
    code = code[order]
    begin = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    n, docs = (np.add.reduceat(flat(name).to_numpy()[order], begin) for name in ("n", "docs"))
    term, source = np.divmod(code[begin], width)
    first = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    kept = np.add.reduceat(docs, first) >= LEAST
    size, n_lang = np.diff(np.append(first, len(term))), np.add.reduceat(n, first)[kept]
    rows = np.repeat(kept, size)
    of = pa.StructArray.from_arrays([names.take(pa.array(source[rows])), pa.array(n[rows])], ["source", "n"])
    of = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[kept])), pa.int32()), of)
    lang = pa.repeat(table["lang"][0], len(n_lang))
    return pa.RecordBatch.from_arrays([lang, words.dictionary.take(pa.array(term[first][kept])), pa.array(n_lang), of], ["lang", "term", "n_lang", "of"])


def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``packed`` in the order of language and part to the kept terms of each."""

    def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
        found = unpacked(table)
        for at in range(0, found.num_rows, 8192):
            yield found.slice(at, 8192)

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        lang, part = table["lang"].combine_chunks().dictionary_encode().indices.to_numpy(), table["part"].to_numpy()
        begin = [0, *(np.flatnonzero((lang[1:] != lang[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), len(part)]
        for at, to in zip(begin, begin[1:]):
            piece = table.slice(at, to - at)
            if held is not None and (held["lang"][0], held["part"][0]) == (piece["lang"][0], piece["part"][0]):
                held = pa.concat_tables([held, piece])
            else:
                if held is not None:
                    yield from out(held)
                held = piece
    if held is not None:
        yield from out(held)


def kept_terms(docs: DataFrame) -> DataFrame:
    """(lang, term, n_lang, of): the terms of at least LEAST documents of their language, with their counts by source."""
    parts = PARTS * (1 + docs.count() // DOCUMENTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch):
                counts = block_counts(block)
                if counts.num_rows:
                    yield packed(counts, parts)

    schema = "lang string, part int, sources array<string>, sizes array<int>, terms string, n array<long>, docs array<long>"
    rows = docs.select("lang", "source", "text").mapInArrow(count, schema).repartition("lang", "part").sortWithinPartitions("lang", "part")
    return rows.mapInArrow(put_together, "lang string, term string, n_lang long, of array<struct<source:string,n:bigint>>")


class Forest:
    """Interned segment trees of counts, and prices of pairs of nodes for a pair of groups."""

    def __init__(self):
        self.ids: dict[tuple[int, int], int] = {}
        self.kids: list[tuple[int, int]] = []
        self.priced: dict[tuple[int, int], dict[tuple[int, int], tuple[int, int]]] = {}
        self.size = 0

    def node(self, left: int, right: int) -> int:
        """The node over two children; ``right`` is -1 in a leaf of ``left`` occurrences (-1: no term there)."""
        found = self.ids.get((left, right))
        if found is None:
            found = self.ids[left, right] = len(self.kids)
            self.kids.append((left, right))
        return found

    def roots(self, counts: np.ndarray) -> list[int]:
        """The root of each row of ``counts``, whose width is a power of two."""
        values, at = np.unique(counts, return_inverse=True)
        ids = np.array([self.node(int(v), -1) for v in values])[at.reshape(counts.shape)]
        while ids.shape[1] > 1:
            wide = int(ids.max()) + 1
            values, at = np.unique(ids[:, 0::2] * wide + ids[:, 1::2], return_inverse=True)
            ids = np.array([self.node(*divmod(int(v), wide)) for v in values])[at.reshape(len(ids), -1)]
        return ids[:, 0].tolist()

    def price(self, group: tuple[int, int], weights: tuple[int, int], a: int, b: int) -> tuple[int, int]:
        """Sums of (p - q)^2 / q over the leaves below a and b, p of the first and q of the second group, and the other way."""
        kids, memo = self.kids, self.priced.setdefault(group, {})
        wa, wb = weights

        def walk(a: int, b: int) -> tuple[int, int]:
            found = memo.get((a, b))
            if found is None:
                (la, ra), (lb, rb) = kids[a], kids[b]
                if ra >= 0:
                    x, y = walk(la, lb), walk(ra, rb)
                    found = x[0] + y[0], x[1] + y[1]
                elif la < 0:
                    found = 0, 0
                else:
                    p, q = 1 + SCALE * (la + 1) // wa, 1 + SCALE * (lb + 1) // wb
                    found = (p - q) ** 2 // q, (p - q) ** 2 // p
                memo[a, b] = found
            return found

        before = len(memo)
        found = walk(a, b)
        self.size += len(memo) - before
        return found


def price_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, v, weights of its groups, block, counts) to sums (lang, a, b, value) over the task's blocks."""
    forest, lang, sums, weights = Forest(), None, {}, []

    def out() -> pa.RecordBatch:
        n = len(sums)
        columns = [pa.array([lang] * n), pa.array([a for a, _ in sums], pa.int32()), pa.array([b for _, b in sums], pa.int32()), pa.array(sums.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            if row["lang"].as_py() != lang or forest.size + len(forest.kids) > MEMO:
                if sums:
                    yield out()
                forest, lang, sums, weights = Forest(), row["lang"].as_py(), {}, row["weights"].as_py()
            here = row["counts"].values
            g, leaf, n = (here.field(k).to_numpy() for k in range(3))
            counts = np.zeros((len(weights), LEAVES), np.int64)
            counts[:, max(row["v"].as_py() - row["block"].as_py() * LEAVES, 0) :] = -1
            counts[g, leaf] = n
            roots = forest.roots(counts)
            for a, (root, weight) in enumerate(zip(roots, weights, strict=True)):
                for b in range(a + 1, len(roots)):
                    one, other = forest.price((a, b), (weight, weights[b]), root, roots[b])
                    sums[a, b] = sums.get((a, b), 0) + one
                    sums[b, a] = sums.get((b, a), 0) + other
    if sums:
        yield out()


def share(count: str, weight: str) -> str:
    """SQL of 1 + floor(SCALE * (count + 1) / weight), exact for counts of any size."""
    return f"1 + CAST({SCALE} AS DECIMAL(10)) * CAST({count} + 1 AS DECIMAL(20)) div {weight}"


def source_divergence(docs: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): see above. Part ``pair`` holds all other sources, ``term`` the first ``top``."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    terms = saved(numbered(saved(kept_terms(docs)), "lang", [F.desc("n_lang"), F.col("term")], "id"))
    kept = terms.select("lang", "term", "n_lang", "id", F.inline("of"))

    whole = terms.groupBy("lang").agg(F.max("id").alias("v"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    seen = docs.groupBy("lang", "source").agg(F.count("*").alias("rows")).join(totals, ["lang", "source"], "left").join(whole, "lang", "left")
    seen = seen.fillna(0, ["own", "v"])
    by_lang = seen.groupBy("lang", "v").agg(F.array_sort(F.collect_list(F.struct("source", "own"))).alias("groups"), F.sum("own").alias("all"))
    roster = saved(by_lang)
    groups = roster.select("lang", "v", F.col("all"), F.posexplode("groups").alias("g", "of")).select("lang", "v", "all", "g", "of.*")

    here = kept.join(F.broadcast(groups), ["lang", "source"])
    near = here.selectExpr("lang", "source", "term", f"{share('n', '(own + v)')} AS p", f"{share('n_lang', '(all + v)')} AS q").where("p > q")
    best = near.selectExpr("lang", "source", "term AS item", "(p - q) * (p - q) div q AS value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    placed = here.selectExpr("lang", f"(id - 1) div {LEAVES} AS block", f"struct(CAST(g AS INT) AS g, CAST((id - 1) % {LEAVES} AS INT) AS leaf, n) AS c")
    rows = placed.groupBy("lang", "block").agg(F.collect_list("c").alias("counts"))
    weights = roster.select("lang", "v", F.transform("groups", lambda x: x["own"] + F.col("v")).alias("weights"))
    priced = rows.join(F.broadcast(weights), "lang").mapInArrow(price_blocks, "lang string, a int, b int, value long")
    sums = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = groups.join(F.broadcast(roster.select("lang", "groups")), "lang").select("lang", "source", F.col("g").alias("a"), F.posexplode("groups").alias("b", "of"))
    pairs = pairs.where("a <> b").join(sums, ["lang", "a", "b"], "left").select("lang", "source", F.col("of.source").alias("item"), F.coalesce("value", F.lit(0)).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(*columns).union(best.withColumn("part", F.lit("term")).select(*columns))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(documents(spark, sf_dir))

"""Operator 13, conversation prefix trie: shared beginnings of conversations, rolled up in bands of depth.

Each distinct sequence of first turns (role, text) is a node; conversations that begin with it are its members. Nodes are
told apart by a hash of their sequence that can be put together from parts: a polynomial in two bases modulo 2^61 - 1 over
120 bits of each turn's SHA-256, with the depth. So turns are dealt by ranges of (conversation, depth), a conversation of any
length spreads over parts, and only what begins in an earlier part is completed from one row per part (``sequence_keys``).

Subtree sums by depth bands (``rolled``): with bands of HEIGHT levels, each node explodes to its ancestors inside its band
alone, at most HEIGHT rows, whose sums are complete for the band. Band roots then form a smaller tree, in which HEIGHT band
roots make a band again, and so on; finally totals of completed band roots go down again, each exploding to the ancestors in
the one band above. For depth D that is log(D) / log(HEIGHT) rounds up and as many down. A node's ancestors in a band come from
its smallest member's turns, so these joins match unique rows, and all sums combine before their shuffle.

Member lists are hashed in numeric order without being held: ranges of (node, conversation) are packed into texts of some
64 KB, and one task per node streams through its texts, as SHA-256 asks for.

Null roles and texts are empty; rows of null conversations are left out. Null turns come first; equal turns of a conversation
are ordered by the hash of role and text, and a row that occurs twice is two turns. An empty table has no node, not even a
root. Extra columns are left out. A text enters as its hash and its length, whatever its size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ordering import numbered
from .shared import saved

#: Prime modulus and bases of the sequence hash (any two bases do), and levels in a band.
PRIME = (1 << 61) - 1
BASES = (0x1B873593CC9E2D51 % PRIME, 0x0E6546B64C4F1A7D % PRIME)
UNDO = tuple(pow(b, -1, PRIME) for b in BASES)
HEIGHT = 16
#: Bytes of member ids packed into one text.
PACK = 1 << 16
NODE = ["depth", "k1", "k2"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, t1, t2, chars): hash and length of each turn, numbered inside its conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("h"),
        F.length(text).cast("long").alias("chars"),
    )
    placed = numbered(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("h")], "pos")
    part = lambda at: F.conv(F.substring("h", at, 15), 16, 10).cast("long")
    return placed.select("conv_id", "pos", part(1).alias("t1"), part(16).alias("t2"), "chars")


def whole(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as they stand: (conv_id, depth, t1, t2, chars), and their members (conv_id, length)."""
    return turns.withColumnRenamed("pos", "depth"), turns.groupBy("conv_id").agg(F.max("pos").alias("length"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversation c begins with the first h turns of c - c % 100 and goes on with its own after its first h.

    h is the CRC-32 of c's digits modulo 6. Same shape as ``whole``; a member may have length 0.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    turns = turns.withColumn("h", h)
    heads = turns.where("conv_id % 100 = 0 AND pos <= 5").groupBy(F.col("conv_id").alias("base"))
    heads = heads.agg(F.array_sort(F.collect_list(F.struct(F.col("pos").alias("depth"), "t1", "t2", "chars"))).alias("head"))
    counts = turns.groupBy("conv_id", "h").agg(F.max("pos").alias("n")).withColumn("base", F.expr("conv_id - conv_id % 100"))
    own = F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<depth:bigint,t1:bigint,t2:bigint,chars:bigint>>"))
    info = saved(counts.join(heads, "base", "left").select("conv_id", "h", "n", own.alias("head")))
    m = F.size("head").cast("long")
    first = info.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.*")
    rest = turns.where("pos > h").join(info.select("conv_id", m.alias("m")), "conv_id")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), "t1", "t2", "chars")
    return first.union(rest), info.select("conv_id", (m + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def batch(columns: list[list], names: str, types: list | None = None) -> pa.RecordBatch:
    names = names.split()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types or [pa.int64()] * len(names), strict=True)], names)


def run_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to rows in order (conv_id, depth): the sequence hash from the part's first row of the conversation, and how many
    rows it spans where the conversation began in an earlier part (0 where it begins here)."""
    (a, b), conv, n, s1, s2 = BASES, None, 0, 0, 0
    for rows in batches:
        out = [[], [], []]
        for c, d, t1, t2 in zip(*(rows.column(i).to_pylist() for i in range(4)), strict=True):
            if c != conv:
                conv, n, s1, s2 = c, int(d > 1), 0, 0
            elif n:
                n += 1
            s1, s2 = (s1 * a + t1) % PRIME, (s2 * b + t2) % PRIME
            out[0].append(n)
            out[1].append(s1)
            out[2].append(s2)
        yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(c, pa.int64()) for c in out)], [*rows.schema.names, "open", "s1", "s2"])


def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, pieces in order of parts) to (conv_id, part, b1, b2): the hash of all that lies before a part."""
    for rows in batches:
        for c, pieces in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            s, out = (0, 0), [[], [], [], []]
            for p in pieces:
                if p["open"]:
                    for column, v in zip(out, (c, p["part"], *s), strict=True):
                        column.append(v)
                s = tuple(((x * pow(b, p["open"], PRIME) if p["open"] else 0) + y) % PRIME for x, b, y in zip(s, BASES, (p["s1"], p["s2"]), strict=True))
            if out[0]:
                yield batch(out, "conv_id part b1 b2", [pa.int64(), pa.int32(), pa.int64(), pa.int64()])


def completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the whole sequence (k1, k2) and of the sequence without its last turn (u1, u2)."""
    (a, b), (ua, ub) = BASES, UNDO
    for rows in batches:
        out = [[], [], [], []]
        for t1, t2, n, s1, s2, b1, b2 in zip(*(rows.column(c).to_pylist() for c in ("t1", "t2", "open", "s1", "s2", "b1", "b2")), strict=True):
            if n:
                s1, s2 = (b1 * pow(a, n, PRIME) + s1) % PRIME, (b2 * pow(b, n, PRIME) + s2) % PRIME
            for column, v in zip(out, (s1, s2, (s1 - t1) * ua % PRIME, (s2 - t2) * ub % PRIME), strict=True):
                column.append(v)
        keys = rows.select(["conv_id", "depth", "chars"]).columns
        yield pa.RecordBatch.from_arrays([*keys, *(pa.array(c, pa.int64()) for c in out)], ["conv_id", "depth", "chars", "k1", "k2", "u1", "u2"])


def sequence_keys(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, chars, k1, k2, u1, u2) of ``turns`` (conv_id, depth from 1 without gaps, t1, t2, chars)."""
    dealt = turns.select("conv_id", "depth", "t1", "t2", "chars").repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    shape = "conv_id long, depth long, t1 long, t2 long, chars long, open long, s1 long, s2 long"
    runs = saved(dealt.mapInArrow(run_hashes, shape).withColumn("part", F.spark_partition_id()))
    last = runs.groupBy("conv_id", "part").agg(*(F.max_by(c, "depth").alias(c) for c in ("open", "s1", "s2")))
    pieces = last.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "open", "s1", "s2"))).alias("pieces"))
    bases = pieces.where("size(pieces) > 1").mapInArrow(carried, "conv_id long, part int, b1 long, b2 long")
    # a part has at most one conversation that began before it, its first
    return runs.join(F.broadcast(bases), ["conv_id", "part"], "left").mapInArrow(completed, "conv_id long, depth long, chars long, k1 long, k2 long, u1 long, u2 long")


def rolled(nodes: DataFrame, paths: DataFrame, values: list[str], deepest: int, height: int = HEIGHT) -> DataFrame:
    """Sums of ``values`` over each node's subtree, by bands of ``height`` levels: (depth, k1, k2, values).

    ``nodes`` (conv_id, depth, k1, k2, values) are unique with a member each; ``paths`` (conv_id, depth, k1, k2) give the
    nodes from the root (depth 0) on that the member passes.
    """
    sizes = [1]
    while sizes[-1] * height <= deepest:
        sizes.append(sizes[-1] * height)

    def band(size: int) -> DataFrame:
        """A member's nodes at multiples of ``size``, one row per ``height`` of them."""
        of = F.expr(f"depth div {size * height}").alias("band")
        return paths.where(f"depth % {size} = 0").groupBy("conv_id", of).agg(F.collect_list(F.struct(*NODE)).alias("above"))

    def lifted(points: DataFrame, size: int, up: int) -> DataFrame:
        """Sums over ``points`` of their values at each ancestor, or itself, in the band ``up`` bands above."""
        at = points.withColumn("band", F.expr(f"depth div {size * height} - {up}"))
        met = at.join(band(size), ["conv_id", "band"]).select(F.col("conv_id"), F.col("depth").alias("own"), F.explode("above").alias("a"), *values)
        met = met.where("a.depth <= own").select("a.*", *values, F.when(F.col("a.depth") == F.col("own"), F.col("conv_id")).alias("conv_id"))
        return met.groupBy(*NODE).agg(F.max("conv_id").alias("conv_id"), *(F.sum(v).alias(v) for v in values))

    columns = ["conv_id", *NODE, *values]
    inside, points = [], nodes.select(*columns)
    for size in sizes:
        inside.append(saved(lifted(points.where(f"depth % {size} = 0"), size, 0).select(*columns)))
        points = inside[-1]
    done = inside.pop()
    while inside:
        size = sizes[len(inside) - 1]
        below = lifted(done.where(f"depth > 0 AND depth % {size * height} = 0"), size, 1).drop("conv_id")
        more = below.select(*NODE, *(F.col(v).alias(f"more_{v}") for v in values))
        added = inside.pop().join(more, NODE, "left")
        done = saved(added.select("conv_id", *NODE, *((F.col(v) + F.coalesce(f"more_{v}", F.lit(0))).alias(v) for v in values)))
    return done.select(*NODE, *values)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (node, conv_id) to (node, first conv_id, ids joined by commas), some PACK bytes a text."""
    node, first, ids, size = None, None, [], 0
    types = [*[pa.int64()] * 4, pa.string()]

    def out() -> pa.RecordBatch:
        return batch([[v] for v in (*node, first, ",".join(ids))], "depth k1 k2 first ids", types)

    for rows in batches:
        for *at, c in zip(*(rows.column(i).to_pylist() for i in range(4)), strict=True):
            if at != node or size >= PACK:
                if ids:
                    yield out()
                node, first, ids, size = at, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
    if ids:
        yield out()


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed texts in order (node, first) to one row per node with the SHA-256 of all of them."""
    node, h = None, None
    types = [*[pa.int64()] * 3, pa.string()]
    for rows in batches:
        done = [[], [], [], []]
        for *at, _, ids in zip(*(rows.column(i).to_pylist() for i in range(5)), strict=True):
            if at == node:
                h.update(b",")
            else:
                if node:
                    for column, v in zip(done, (*node, h.hexdigest()), strict=True):
                        column.append(v)
                node, h = at, hashlib.sha256()
            h.update(ids.encode())
        yield batch(done, "depth k1 k2 sha", types)
    if node:
        yield batch([[v] for v in (*node, h.hexdigest())], "depth k1 k2 sha", types)


def member_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 over the conversations ``ends`` (depth, k1, k2, conv_id) at each node, ascending, comma-joined."""
    order = [*NODE, "conv_id"]
    texts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(packed, "depth long, k1 long, k2 long, first long, ids string")
    return texts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digested, "depth long, k1 long, k2 long, sha string")


def prefix_trie(turns: DataFrame, members: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, k1, k2.

    ``turns`` and ``members`` are what ``whole`` or ``rebuilt`` give. saved_tokens sums (n_convs - 1) times the length of a
    node's last text over its subtree: what keeping each shared beginning once saves.
    """
    zero = F.lit(0).cast("long")
    keyed = sequence_keys(turns).join(members, "conv_id")
    root = members.select("conv_id", zero.alias("depth"), zero.alias("chars"), *(zero.alias(c) for c in ("k1", "k2", "u1", "u2")), "length")
    paths = saved(keyed.select(*root.columns).union(root))
    nodes = saved(
        paths.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("u1").alias("u1"), F.max("u2").alias("u2"))
    )
    up = [(F.col("depth") - 1).alias("depth"), F.col("u1").alias("k1"), F.col("u2").alias("k2")]
    children = nodes.where("depth > 0").select(*up).groupBy(*NODE).agg(F.count("*").alias("n_children"))
    nodes = saved(nodes.join(children, NODE, "left").fillna(0, ["n_children"]))
    worth = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("chars"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    sums = rolled(worth, paths, ["n_leaves", "saved_tokens"], deepest, height)
    ends = member_digests(paths.where("depth = length"))
    # many children may share a parent: the side of the parents is unique, so AQE may split the children
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.where("depth > 0").join(parents, ["depth", "u1", "u2"]).unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    found = found.join(sums, NODE).join(ends, NODE, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", empty).alias("ends_sha256"), "k1", "k2")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie(*rebuilt(turns)).drop("k1", "k2")

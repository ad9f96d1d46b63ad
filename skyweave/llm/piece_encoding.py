"""Operator 7, SentencePiece encoding and decoding: best segmentation by a max-plus scan over chunks.

The pieces of a public sentencepiece model and their scores define a segmentation: spaces become marks, one mark goes in
front, and the pieces whose scores sum to the most are taken (scores are whole numbers, so sums are exact in any order).
A character that is no piece costs UNKNOWN below the lowest score and is written as its UTF-8 bytes. Among equal sums the
last piece is the longer one, looked at from the end of each prefix.

A text longer than CHUNK characters is cut into chunks. A piece may reach over a cut by up to ``reach - 1`` characters, so
the state at a cut is how far the last piece reached over it. A chunk's transfer matrix holds the best sum from each state
at its beginning to each state at its end; matrices are multiplied in the (max, +) semiring, first those of a block of
BLOCK chunks, then those of the blocks, which gives the states at the blocks' ends and then at all cuts, and with them
each chunk is traced back on its own. Chunks, blocks and texts are rows: no task holds more than a block's matrices.
Shorter texts are one chunk each, from state 0 to state 0. Within a chunk no piece crosses into a mark (checked when the
model is read), so words are segmented one by one. Those that come again are kept in a bounded cache; most words come
once only and are not kept, since a worker holds its cache for as long as it waits for tasks, whatever job runs meanwhile.

``encode`` returns the identifiers, ``decode`` the text they stand for. Null and empty texts have no pieces; a null
decodes to null from a null list only. Texts with the mark itself come back with spaces, as the model defines it.
Repeated rows are encoded one by one (long texts that are equal, once); extra columns are left out, ``encoded`` keeps them.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import documents, fresh, saved, small_batches

MARK = "▁"
CHUNK = 32_768
BLOCK = 256
CACHE = 200_000
SEEN = 1 << 22
ROWS = 128
UNKNOWN = 10
LOW = -(1 << 60)


class Vocabulary:
    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.name != "identity" or rules.remove_extra_whitespaces or not rules.add_dummy_prefix or not model.trainer_spec.byte_fallback:
            raise ValueError("a model with the identity normalizer, a dummy prefix and byte fallback is wanted")
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == 1]
        if any(p.type in (4, 5) for p in model.pieces) or any(p.score != int(p.score) for _, p in normal):
            raise ValueError("user-defined or unused pieces, or scores that are no whole numbers")
        self.id = {p.piece: i for i, p in normal}
        self.score = {p.piece: int(p.score) for _, p in normal}
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece crosses into a white-space mark")
        self.byte = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                self.byte[int(p.piece[3:5], 16)] = i
        self.text = {i: p.encode() for p, i in self.id.items()} | {i: bytes([b]) for b, i in enumerate(self.byte)}
        self.reach = max(map(len, self.id))
        self.unknown = min(self.score.values()) - UNKNOWN
        self.words: dict[str, bytes] = {}  # identifiers as 32-bit numbers
        self.sums: dict[str, int] = {}
        self.seen = bytearray(SEEN)  # at the hash of each word met
        # each beginning of a piece: its score if it is one itself, else LOW
        self.grow: dict[str, int] = {}
        for p, score in self.score.items():
            for n in range(2, len(p)):
                self.grow.setdefault(p[:n], LOW)
            if len(p) > 1:
                self.grow[p] = score
        self.beside = {p[i : i + 2] for p in self.id for i in range(len(p) - 1)}

    def best(self, text: str, begin: int, inner: int) -> tuple[list[int], list[int]]:
        """From ``begin``: best sum to each place (LOW if none) and where its last piece begins. Pieces begin before ``inner``."""
        n = len(text)
        sums, back = [LOW] * (n + 1), [-1] * (n + 1)
        sums[begin] = 0
        one, more, unknown = self.score.get, self.grow.get, self.unknown
        for at in range(begin, inner):
            here = sums[at]
            if here == LOW:
                continue
            end = at + 1
            total = here + one(text[at], unknown)
            if total > sums[end]:
                sums[end], back[end] = total, at
            while end < n:
                end += 1
                s = more(text[at:end])
                if s is None:
                    break
                if here + s > sums[end]:
                    sums[end], back[end] = here + s, at
        return sums, back

    def ids(self, text: str, back: list[int], end: int, begin: int = 0) -> list[int]:
        out: list[int] = []
        while end > begin:
            piece = text[back[end] : end]
            i = self.id.get(piece)
            if i is None:
                out.extend(self.byte[b] for b in reversed(piece.encode()))
            else:
                out.append(i)
            end = back[end]
        return out[::-1]

    def parts(self, word: str) -> list[str]:
        """A word cut where no piece holds the two characters around."""
        if self.beside.issuperset(map(add, word, word[1:])):
            return [word]
        cuts = [0, *(i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in self.beside), len(word)]
        return [word[i:j] for i, j in zip(cuts, cuts[1:])]

    def again(self, word: str) -> bool:
        """Whether a word of this hash was met before."""
        at = hash(word) % SEEN
        before, self.seen[at] = self.seen[at], 1
        return bool(before)

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            parts = self.parts(word)
            if len(parts) > 1:
                found = b"".join(map(self.word, parts))
            else:
                ids = self.ids(word, self.best(word, 0, len(word))[1], len(word))
                found = struct.pack(f"<{len(ids)}i", *ids)
            if len(self.words) < CACHE and len(word) <= 64 and self.again(word):
                self.words[word] = found
        return found

    def word_sum(self, word: str) -> int:
        found = self.sums.get(word)
        if found is None:
            found = sum(self.best(part, 0, len(part))[0][-1] for part in self.parts(word))
            if len(self.sums) < CACHE and len(word) <= 64 and self.again(word):
                self.sums[word] = found
        return found

    def run(self, text: str) -> list[int]:
        """Identifiers of a stretch that begins at a mark (or a text's beginning) and ends before one."""
        known, word = self.words.get, self.word
        return np.frombuffer(b"".join([known(w) or word(w) for w in words_of(text)]), "<i4").tolist()

    def bounds(self, text: str, size: int) -> tuple[int, int]:
        """The first place from which, and the last place up to which, whole words lie inside a chunk of ``size``
        characters (``text`` goes on beyond it): both are beginnings of runs of marks."""
        first = next((i for i in range(min(self.reach, size), size) if text[i] == MARK and text[i - 1] != MARK), size)
        last = next((i for i in range(size - 1, first - 1, -1) if text[i] == MARK and text[i - 1] != MARK), first)
        return first, last

    def transfer(self, text: str, size: int) -> np.ndarray:
        """[state at the beginning, state at the end] -> best sum; ``text`` has up to reach - 1 characters beyond ``size``."""
        out = np.full((self.reach, self.reach), LOW, np.int64)
        first, last = self.bounds(text, size)
        if first == size:
            for a in range(min(self.reach, size + 1)):
                sums, _ = self.best(text, a, size)
                out[a, : len(text) - size + 1] = sums[size:]
            for a in range(size + 1, self.reach):  # the last piece reaches over the whole chunk
                out[a, a - size] = 0
            return out
        tail, _ = self.best(text[last:], 0, size - last)
        tail = np.array(tail[size - last :], np.int64) + sum(map(self.word_sum, words_of(text[first:last])))
        for a in range(self.reach):
            head = self.best(text[:first], a, first)[0][first]
            if head > LOW:
                out[a, : len(tail)] = np.where(tail > LOW // 2, tail + head, LOW)
        return out

    def trace(self, text: str, size: int, a: int, b: int) -> list[int]:
        """Identifiers of the pieces that begin in the chunk, from state ``a`` to state ``b``."""
        if a >= size:
            return []
        first, last = self.bounds(text, size)
        if first == size:
            return self.ids(text, self.best(text, a, size)[1], size + b, a)
        out = self.ids(text[:first], self.best(text[:first], a, first)[1], first, a)
        return out + self.run(text[first:last]) + self.ids(text[last:], self.best(text[last:], 0, size - last)[1], size - last + b)

    def encode(self, text: str | None) -> list[int]:
        return self.run(marked(text)) if text else []

    def decode(self, ids: list[int] | None) -> str | None:
        if ids is None:
            return None
        raw = b"".join(map(self.text.__getitem__, ids)).decode(errors="replace").replace(MARK, " ")
        return raw[1:]


def words_of(text: str) -> list[str]:
    """Runs of marks and what follows each: the places between them no piece crosses."""
    parts = text.split(MARK)
    if "" not in parts[1:]:
        return ([parts[0]] if parts[0] else []) + [MARK + p for p in parts[1:]]
    out, run = ([parts[0]] if parts[0] else []), ""
    for p in parts[1:]:
        run += MARK
        if p:
            out.append(run + p)
            run = ""
    return out + [run] if run else out


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; it is associative, and exact on whole numbers."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(1), LOW)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def states(matrices: list[np.ndarray], a: int, b: int) -> list[int]:
    """States at all cuts of a path from state ``a`` to state ``b``, the first and last included."""
    rows = [np.full(len(matrices[0]), LOW, np.int64)]
    rows[0][a] = 0
    for m in matrices:
        rows.append(np.maximum((rows[-1][:, None] + m).max(0), LOW))
    out = [b]
    for row, m in zip(reversed(rows[:-1]), reversed(matrices)):
        out.append(int((row + m[:, out[-1]]).argmax()))
    return out[::-1]


def long_encodings(docs: DataFrame, model: str, chunk: int, block: int) -> DataFrame:
    """(text, ids) of the distinct texts longer than ``chunk`` characters."""
    reach = vocabulary(model).reach
    texts = docs.where(F.length("text") > chunk).select("text").distinct()
    body = F.concat(F.lit(MARK), F.translate("text", " ", MARK))
    keyed = texts.select(F.sha2("text", 256).alias("doc"), body.alias("body"), F.length(body).alias("n"))
    at = F.col("at")
    chunks = keyed.select("doc", "body", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(chunk))).alias("at")).select(
        "doc",
        (at / chunk).cast("int").alias("k"),
        F.least(F.lit(chunk), F.col("n") - at).cast("int").alias("size"),
        F.substr("body", at + 1, F.lit(chunk + reach - 1)).alias("part"),
    )

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = vocabulary(model)
        for f in frames:
            f["m"] = [table.transfer(p, s).tobytes() for p, s in zip(f["part"], f["size"])]
            yield f

    ready = saved(chunks.mapInPandas(matrices, "doc string, k int, size int, part string, m binary"))
    shape = (reach, reach)
    small = ready.select("doc", "k", (F.col("k") / block).cast("int").alias("g"), "m")

    def of(m: bytes) -> np.ndarray:
        return np.frombuffer(m, np.int64).reshape(shape)

    def combine(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("k")
        return pd.DataFrame({"doc": f["doc"].iloc[:1], "g": f["g"].iloc[:1], "m": [reduce(product, map(of, f["m"])).tobytes()]})

    def outer(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("g")
        s = states([of(m) for m in f["m"]], 0, 0)
        return pd.DataFrame({"doc": f["doc"], "g": f["g"], "a": s[:-1], "b": s[1:]})

    def inner(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("k")
        s = states([of(m) for m in f["m"]], int(f["a"].iloc[0]), int(f["b"].iloc[0]))
        return pd.DataFrame({"doc": f["doc"], "k": f["k"], "a": s[:-1], "b": s[1:]})

    blocks = small.groupBy("doc", "g").applyInPandas(combine, "doc string, g int, m binary")
    ends = blocks.groupBy("doc").applyInPandas(outer, "doc string, g int, a int, b int")
    cuts = small.join(ends, ["doc", "g"]).groupBy("doc", "g").applyInPandas(inner, "doc string, k int, a int, b int")

    def traced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = vocabulary(model)
        for f in frames:
            ids = [table.trace(*x) for x in zip(f["part"], f["size"], f["a"], f["b"])]
            yield pd.DataFrame({"doc": f["doc"], "k": f["k"], "ids": ids})

    parts = ready.select("doc", "k", "size", "part").join(cuts, ["doc", "k"]).mapInPandas(traced, "doc string, k int, ids array<int>")
    whole = parts.groupBy("doc").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    return whole


def encoded(docs: DataFrame, model: str, name: str = "ids", check: str | None = None, back: str | None = None, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """``docs`` and ``name``, the identifiers of its texts; with ``check`` whether they decode to the text, with ``back``
    the text that they decode to."""
    small_batches(docs.sparkSession)
    doc, got = fresh(docs, "doc"), fresh(docs, "long_ids")
    long = saved(long_encodings(docs, model, chunk, block)).select(F.col("doc").alias(doc), F.col("ids").alias(got))
    rows = docs.withColumn(doc, F.when(F.length("text") > chunk, F.sha2("text", 256)))
    rows = rows.where(F.col(doc).isNull()).withColumn(got, F.lit(None).cast("array<int>")).unionByName(
        rows.where(F.col(doc).isNotNull()).join(long, doc).select(*rows.columns, got)
    ).drop(doc)
    at, kept = docs.columns.index("text"), [f for f in docs.schema.fields]
    fields = [*kept, T.StructField(name, T.ArrayType(T.IntegerType()))]
    if check:
        fields.append(T.StructField(check, T.BooleanType()))
    if back:
        fields.append(T.StructField(back, T.StringType()))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                texts = part.column(at).to_pylist()
                ids = [table.encode(t) if i is None else i for t, i in zip(texts, part.column(part.num_columns - 1).to_pylist())]
                columns = [*part.columns[:-1], pa.array(ids, pa.list_(pa.int32()))]
                decoded = [table.decode(i) for i in ids] if check or back else []
                if check:
                    columns.append(pa.array([d == (t or "").replace(MARK, " ") for t, d in zip(texts, decoded)], pa.bool_()))
                if back:
                    columns.append(pa.array(decoded, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return rows.mapInArrow(code, T.StructType(fields))


def decoded(rows: DataFrame, model: str, ids: str, name: str) -> DataFrame:
    """``rows`` and ``name``, the text that the identifiers in ``ids`` stand for."""
    at = rows.columns.index(ids)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                texts = [table.decode(i) for i in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, name])

    return rows.mapInArrow(code, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), "ids", "round_trip")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")

"""Operator 12, token-id files: flat unsigned integers, 64-bit document offsets, bases from prefix sums, memory-mapped.

A folder of token files holds, for part ``p`` (documents in ascending order, parts in ascending order):

* ``p.ids``: the ids of all its documents without gaps, little-endian, two bytes each where the vocabulary has at most
  65,536 ids and four bytes otherwise; each document ends with the end id.
* ``p.offsets``: n + 1 little-endian 64-bit integers, where each of its n documents begins in ``p.ids`` (in ids), and the end.
* ``p.docs``: n little-endian 64-bit document ids; the first ``n_null`` of them stand for null.
* ``manifest``: one row per part (part, n_docs, n_null, n_tokens, first_doc, base, width), a Parquet table. ``base`` and
  ``first_doc`` are sums over the parts before, so document d of part p begins at ``base + offsets[d]`` in the whole.

Rows are dealt by ranges of (doc_id, hash of the text, row), so that a repeated id or a null id spreads over parts, and a
task encodes and writes its rows as they stream by; it holds one block of texts at a time. A part is written under a name
of its attempt and then renamed: an attempt that is repeated, or runs twice, leaves the same file. The manifest has a row
per part, so summing it up is no work.

White space never becomes part of an id here, so a text is cut at blanks and line feeds and the library encodes each
distinct word of a block once (a bounded cache keeps words met first); ``separable`` reads from the tokenizer's own settings that
this gives what encoding the whole text gives, and whole texts are encoded otherwise. Special strings in a text become
their special ids, as is the library's default.

Null and empty texts have the end id alone. Null ids come first; rows of one id are ordered by the hash of their text; fully
equal rows differ in ``start`` alone. An empty table gives an empty manifest. Extra columns are left out.
"""

from __future__ import annotations

import json
import os
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from struct import pack
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import documents, saved, shared_dir

END = 1
#: Bytes of text encoded at a time; words whose ids a worker keeps (and those of one block more), and characters of such a word.
BLOCK, CACHE, WORD = 1 << 23, 500_000, 40
#: A plain letter and a sign after it always belong to different runs of characters: a blank may stand between them.
EDGE = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:#*$%&])", r"\1 \2"
MANIFEST = "part int, n_docs long, n_null long, n_tokens long, width int"


def folder_of(path: str):
    """The file system and the path on it of a folder that all executors share."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def separable(settings: dict) -> bool:
    """Do blanks and line feeds always part ids? True for the steps known to keep to single words."""
    steps = lambda part, inner: (settings.get(part) or {}).get(inner, [settings.get(part)])
    normal = all(s and (s["type"] in ("NFC", "Lowercase") or s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"}) for s in steps("normalizer", "normalizers"))
    normal = normal and any(s["type"] == "Lowercase" for s in steps("normalizer", "normalizers"))
    split, *rest = steps("pre_tokenizer", "pretokenizers")
    cut = bool(split) and split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
    words = cut and all(r"\s" not in a or a.startswith(r"[^\s") for a in split["pattern"].get("Regex", r"\s").split("|"))
    plain = all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in rest)
    added = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] or not t["content"].startswith("<|") for t in settings["added_tokens"])
    return normal and words and plain and added and settings.get("post_processor") is None


class Encoder:
    """Texts to little-endian ids of a fixed width by the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel units
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        with open(path, encoding="utf-8") as f:
            self.by_word = separable(json.load(f))
        self.known: dict[str, bytes] = {"": b""}

    def packed(self, ids: list[int]) -> bytes:
        return pack(f"<{len(ids)}{'HI'[self.width // 4]}", *ids)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [self.packed(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of distinct ``words`` without blanks, from what the worker knows or from the library."""
        known = self.known
        found = [known.get(w) for w in words]
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        made = dict(zip(new, self.whole(new), strict=True))
        if len(known) < CACHE:
            known.update((w, ids) for w, ids in made.items() if len(w) <= WORD)
        return [made[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def texts(self, texts: pa.Array, end: int) -> tuple[pa.Buffer | bytes, np.ndarray]:
        """All ids of ``texts``, each with ``end`` after it, and where each ends, in bytes."""
        tail = self.packed([end])
        if not self.by_word:
            made = [x + tail for x in self.whole(texts.to_pylist())]
            return b"".join(made), np.cumsum([len(x) for x in made], dtype=np.int64)
        texts = pc.replace_substring(pc.replace_substring_regex(texts, *EDGE), "\n", " ")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # special strings are told apart by case
            texts = pc.ascii_lower(texts)
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        ends = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        at = np.insert(coded.indices.to_numpy(), ends, len(coded.dictionary))
        ids = pa.array([*self.words(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), tail], pa.binary()).take(pa.array(at))
        return ids.buffers()[2], np.frombuffer(ids.buffers()[1], np.int32)[ends + np.arange(1, len(ends) + 1)].astype(np.int64)


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The tokenizer at ``path``, once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` without nulls, in runs of at most BLOCK bytes, one text at least."""
    texts = texts.fill_null("")
    ends, at = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
        yield texts.slice(at, to - at)
        at = to


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END) -> str:
    """Encode ``docs`` (doc_id, text) into token files; returns their folder, a new one in the shared folder by default.

    ``tokenizer`` is a path that every worker can open. The folder must be new or empty.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        task, (files, root), code = TaskContext.get(), folder_of(folder), encoder(tokenizer)
        part, mine = task.partitionId(), f".{task.taskAttemptId()}"
        at, n_docs, n_null = 0, 0, 0
        files.create_dir(root, recursive=True)
        names = [f"{root}/{part}.{kind}" for kind in ("ids", "offsets", "docs")]
        ids, offsets, keys = outs = [files.open_output_stream(name + mine) for name in names]
        offsets.write(np.zeros(1, "<i8").tobytes())
        while first is not None:
            column = first.column(0)
            keys.write(np.asarray(column.fill_null(0)).astype("<i8").tobytes())
            n_null, n_docs = n_null + column.null_count, n_docs + len(column)
            for run in blocks(first.column(1)):
                made, ends = code.texts(run, end)
                ids.write(made)
                offsets.write((at + ends // code.width).astype("<i8").tobytes())
                at += int(ends[-1]) // code.width
            first = next(batches, None)
        for out, name in zip(outs, names, strict=True):
            out.close()
            files.move(name + mine, name)
        row = [[part], [n_docs], [n_null], [at], [code.width]]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, [pa.int32(), *[pa.int64()] * 3, pa.int32()], strict=True)], ["part", "n_docs", "n_null", "n_tokens", "width"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "h", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = saved(dealt.mapInArrow(write, MANIFEST))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.select(
        "*", *(F.coalesce(F.sum(n).over(before), F.lit(0)).alias(name) for n, name in (("n_docs", "first_doc"), ("n_tokens", "base")))
    ).write.parquet(f"{folder}/manifest")
    return folder


def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A token file as an array: memory-mapped on a mounted file system, read otherwise."""
    files, root = folder_of(folder)
    if files.type_name == "local":
        return np.memmap(f"{root}/{name}", kind, "r") if os.path.getsize(f"{root}/{name}") else np.empty(0, kind)
    with files.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read(), kind)


class TokenFiles:
    """Random access by a document's place in the whole order: ``files[i]`` maps one part and returns one document's ids."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder
        self.parts = spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()  # a row per file
        self.firsts = [p.first_doc for p in self.parts]

    def __len__(self) -> int:
        return self.parts[-1].first_doc + self.parts[-1].n_docs if self.parts else 0

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < len(self):
            raise IndexError(i)
        p = self.parts[bisect_right(self.firsts, i) - 1]
        a, b = mapped(self.folder, f"{p.part}.offsets", "<i8")[i - p.first_doc :][:2]
        return mapped(self.folder, f"{p.part}.ids", f"<u{p.width}")[a:b]


def read_tokens(spark: SparkSession, folder: str, check: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids before it in the whole), n_tokens, and its ids, or with ``check`` their CRC-32."""
    made = "ids_crc32 long" if check else "ids array<long>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.to_pylist():
                name, n = p["part"], p["n_docs"]
                ids = mapped(folder, f"{name}.ids", f"<u{p['width']}")
                offsets, docs = mapped(folder, f"{name}.offsets", "<i8"), mapped(folder, f"{name}.docs", "<i8")
                at = 0
                while at < n:  # documents of at most BLOCK ids together, one at least
                    to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
                    lows, highs = offsets[at:to], offsets[at + 1 : to + 1]
                    wide = ids[lows[0] : highs[-1]].astype("<u4")
                    a, b = (lows - lows[0]).tolist(), (highs - lows[0]).tolist()
                    if check:
                        last = pa.array([crc32(wide[i:j]) for i, j in zip(a, b, strict=True)], pa.int64())
                    else:
                        last = pa.ListArray.from_arrays(pa.array([*a, b[-1]], pa.int32()), pa.array(wide.astype(np.int64)))
                    key = pa.array(np.array(docs[at:to]), pa.int64(), mask=np.arange(at, to) < p["n_null"])
                    columns = [key, pa.array(p["base"] + np.array(lows)), pa.array(np.array(highs - lows)), last]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", made.split()[0]])
                    at = to

    parts = spark.read.parquet(f"{folder}/manifest")
    n = max(parts.count(), 1)
    return parts.repartition(n).mapInArrow(read, f"doc_id long, start long, n_tokens long, {made}")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, folder, check=True)

"""Token-id files against the library on whole texts, byte by byte."""

from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from skyweave.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain(rows, path=PATH, end=token_files.END):
    """(doc_id, start, n_tokens, ids) by encoding whole texts one by one, in ascending order of ids, nulls first."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, at, len(ids), ids))
        at += len(ids)
    return out


TEXTS = [
    None, "", " \t\n ", "Plain words, it's 1234 o'clock\nNEW LINE", "<|endoftext|> a<|startoftext|>b <|endoftext|>",
    "étude ́x ΑΣ Σ em nb\x1cfs\x85nel\x0bvt", "İstanbul ǅ ﬁ 日本語 😀 \x00 z", "x" * 30_000, "ab " * 20_000, "\n\n a  b \n", "Geßung, HEHE!! wort### it's. don't!? x.y a,b Ö! é.́ £5,",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_library(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    rows = [(7 * i % len(TEXTS) - 3, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(4)
    folder = token_files.write_tokens(df, path, f"file://{tmp_path}/ids")
    want = plain(rows, path)
    got = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids) for r in got] == want
    checked = sorted(token_files.read_tokens(spark, folder, check=True).collect(), key=lambda r: r.start)
    assert [r.ids_crc32 for r in checked] == [crc32(np.array(ids, "<u4").tobytes()) for *_, ids in want]
    files = token_files.TokenFiles(spark, folder)
    assert len(files) == len(rows) and [files[i].tolist() for i in range(len(files))] == [ids for *_, ids in want]
    assert all(isinstance(files[i], np.memmap) and files[i].dtype.itemsize == 2 for i in range(len(files)))
    with pytest.raises(IndexError):
        files[len(files)]


def test_odd_rows(spark, odd, none):
    folder = token_files.write_tokens(odd, PATH)
    got = sorted(token_files.read_tokens(spark, folder).collect(), key=lambda r: r.start)
    want = plain([(r.doc_id, r.text) for r in odd.collect()])
    assert [r.doc_id for r in got] == [w[0] for w in want]
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(w[0]), w[3]) for w in want)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert token_files.read_tokens(spark, token_files.write_tokens(none, PATH), check=True).count() == 0


def test_cache_and_blocks_change_nothing(monkeypatch):
    want = [e for *_, e in plain([(i, t) for i, t in enumerate(TEXTS)])]
    for cache, block in ((0, 1), (3, 64), (1000, 1 << 20)):
        monkeypatch.setattr(token_files, "CACHE", cache)
        monkeypatch.setattr(token_files, "BLOCK", block)
        code = token_files.Encoder(PATH)
        assert code.by_word and not token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")).by_word
        got = []
        for run in token_files.blocks(pa.array(TEXTS)):
            made, ends = code.texts(run, token_files.END)
            ids, ends = np.frombuffer(made, "<u2").tolist(), [0, *(ends // 2).tolist()]
            assert len(ids) == ends[-1]
            got += [ids[a:b] for a, b in zip(ends, ends[1:])]
        assert got == want
        assert cache or len(code.known) == 1


def test_whole_table(spark):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    got = token_files.op12_token_files(spark, data).collect()
    want = [(d, s, n, crc32(np.array(ids, "<u4").tobytes())) for d, s, n, ids in plain(rows)]
    assert sorted(map(tuple, got)) == sorted(want)

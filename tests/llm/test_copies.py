"""SimHash groups and repeated bytes against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from skyweave.llm import anchors, repeated_bytes, simhash
from skyweave.llm.shared import components

from .conftest import prose


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, budget=4):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= budget:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


def test_fingerprint():
    for text in (None, "", "one", "Two words", "A b C d", prose(1, 50), "Ä Ö ü x " * 9):
        assert simhash.fingerprint(text) == slow_fingerprint(text)


@pytest.mark.parametrize("crowd", [8, 64, 4096])
def test_links_make_all_groups(spark, crowd):
    r = np.random.default_rng(crowd)
    centres = r.integers(0, 1 << 63, 12, dtype=np.uint64)
    values = set()
    for k in range(600):
        v = int(centres[k % 12])
        for b in r.integers(0, 64, int(r.integers(0, 6))):
            v ^= 1 << int(b)
        values.add(v)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, crowd)).collect()
    root = {n: r for n, r in found}
    want = groups(values)
    got = [root.get(s, s) for s in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_every_cut_covers_the_bits():
    for n in (1, 10**6, 10**9, 10**12):
        for blocks in simhash.block_choices(n):
            assert sum(w for _, w in blocks) <= 60
    assert len(simhash.block_choices(10)) == 5


def test_odd_rows(odd, none):
    got = simhash.simhash_groups(odd).collect()
    assert len(got) == odd.count()
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert by[2, f"{simhash.fingerprint(prose(1, 80)):016x}"] == 1
    assert by[None, "0" * 16] == by[4, "0" * 16] == by[6, "0" * 16] == 4
    assert simhash.simhash_groups(none).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 3, 4, 7, 8, 9]


def test_suffix_sort():
    data = np.frombuffer(bytes(np.random.default_rng(1).integers(97, 99, 700).astype(np.uint8)), np.uint8)
    at = np.arange(640)
    order = anchors.suffix_sort(anchors.Hashes(data), at, 50)
    found = [data[i : i + 50].tobytes() for i in order]
    assert found == sorted(found)


def test_suffix_sort_survives_collisions(monkeypatch):
    monkeypatch.setattr(anchors.Hashes, "of", lambda self, lo, hi: np.zeros(len(lo), np.uint64))
    data = np.frombuffer(b"abcabdabc" * 9, np.uint8)
    order = anchors.suffix_sort(anchors.Hashes(data), np.arange(60), 20)
    found = [data[i : i + 20].tobytes() for i in order]
    assert found == sorted(found)


def slow_removal(rows, width=50):
    key = lambda i: repeated_bytes.LAST if i is None else i
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for s in range(len(raw) - width + 1):
            w = raw[s : s + width]
            first[w] = min(first.get(w, key(i)), key(i))
    out = Counter()
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - width + 1):
            if first[raw[s : s + width]] < key(i):
                gone[s : s + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for j in range(len(raw)) if gone[j] and not (j and gone[j - 1]))
        out[i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("stretch", [500, 2_000_000])
def test_repeated_bytes(spark, odd, none, monkeypatch, stretch):
    monkeypatch.setattr(repeated_bytes, "STRETCH", stretch)
    parts = [prose(s, 12) for s in range(6)]
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    rows += [(100 + i, parts[i % 6] + "|" * (i % 3) + parts[i * 5 % 6] + parts[i * 7 % 5]) for i in range(40)]
    rows += [(200, "z" * 49), (201, "z" * 50), (202, "é" * 25), (203, "q" + "é" * 25)]
    got = repeated_bytes.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == slow_removal(rows)
    assert repeated_bytes.digests(odd).count() == odd.count() and repeated_bytes.digests(none).count() == 0


def test_suffix_sort_by_groups():
    r = np.random.default_rng(3)
    data = r.integers(97, 99, 900).astype(np.uint8)
    for n, groups_ in ((0, 1), (1, 1), (800, 1), (800, 6), (800, 500)):
        at, group = r.permutation(800)[:n], r.integers(0, groups_, n)
        order = anchors.suffix_sort(anchors.Hashes(data), at, 50, group)
        found = [(group[i], data[at[i] : at[i] + 50].tobytes()) for i in order]
        assert found == sorted(found)


def test_surroundings_that_share_half_a_hash_are_not_taken_for_copies(spark):
    import pyarrow as pa

    around = np.array([5 << 32 | 1, 5 << 32 | 2, 5 << 32 | 1], np.int64)
    table = pa.table({"h": np.full(3, 9, np.int64), "ord": np.arange(3), "row": np.arange(3), "place": np.full(3, 26, np.int32), "around": around})
    out = repeated_bytes.settle(table).to_pylist()
    assert [(r["row"], r["h"]) for r in out] == [(2, None), (0, 9), (1, 9)]


def test_many_surroundings_of_one_gram(spark):
    """One gram in all texts, no 50 bytes twice: nothing goes. The last text repeats the first."""
    r = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    gram = b"THE GRAM OF ALL TEXTS 01"
    rows = [(i, (letters[r.integers(0, 26, 26)].tobytes() + gram + letters[r.integers(0, 26, 26)].tobytes()).decode()) for i in range(20_000)]
    rows.append((20_000, rows[0][1]))
    out = repeated_bytes.digests(spark.createDataFrame(rows, "doc_id long, text string")).where("n_removed > 0").collect()
    assert [(r.doc_id, r.n_removed) for r in out] == [(20_000, 76)]

"""Near copies of the pipeline against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from skyweave.llm import similar, simhash

from .conftest import prose


def slow_sets(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    """The smallest id of each group, by all pairs."""
    sets = [(i, slow_sets(t)) for i, t in sorted(rows)]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, (i, a) in enumerate(sets):
        for j, b in sets[:at]:
            if a == b or 5 * len(a & b) >= 4 * len(a | b) > 0:
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return {find(i) for i in parent}


def changed(text, n, seed):
    r, words = random.Random(seed), text.split()
    for at in r.sample(range(len(words)), n):
        words[at] = f"new{at}"
    return " ".join(words)


@pytest.mark.parametrize("crowd", [3, 1000])
def test_near_copies_are_those_of_all_pairs(spark, data, monkeypatch, crowd):
    monkeypatch.setattr(similar, "CROWD", crowd)
    stock = prose(50, 30)
    rows = [(100 * s + k, changed(prose(s, 90), k % 5, k)) for s in range(4) for k in range(12)]
    rows += [(1000 + k, stock + " " + prose(200 + k, 8 + k)) for k in range(15)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "One  two"), (2005, "one three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, data).collect())
    assert kept == sorted(slow_kept(rows))
    if crowd == 1000:
        assert len(kept) < simhash.one_of_each(docs).count()  # four bits of a fingerprint miss changed words


def test_odd_rows(odd, none):
    kept = similar.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 3, 4, 7, 8, 9]
    assert similar.one_of_each(none).count() == 0


def test_fingerprints_propose_and_the_exact_join_finds_the_rest(spark, data, monkeypatch):
    """The stage runs the fingerprint join, takes its links on full sets alone, and decides no pair of them again."""
    rows = [(100 * s + k, changed(prose(s, 300), k, k)) for s in range(6) for k in range(4)]
    rows += [(1000 + k, prose(50, 60) + " " + prose(300 + k, 9)) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, calls, decide = [], [], similar.linked

    def joined(distinct, budget):
        calls.append(budget)
        return simhash_links(distinct, budget)

    def spied(pairs, rows):
        pairs = similar.saved(pairs)
        seen.append({(r.a, r.b) for r in pairs.collect()})
        found = decide(pairs, rows)
        seen.append({(r.a, r.b) for r in found.collect()})
        return found

    simhash_links = simhash.links
    monkeypatch.setattr(simhash, "links", joined)
    monkeypatch.setattr(similar, "linked", spied)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, data).collect()}
    assert kept == slow_kept(rows) and calls == [similar.BUDGET]
    proposed, sure, left, found, _, _ = seen
    assert sure and sure <= proposed and found and not found & sure and not left & sure
    key = {r.key: r.text for r in docs.select(similar.key_of(docs.text).alias("key"), "text").collect()}
    near = lambda a, b: 5 * len(slow_sets(key[a]) & slow_sets(key[b])) >= 4 * len(slow_sets(key[a]) | slow_sets(key[b]))
    assert all(near(*p) == (p in sure) for p in proposed) and all(near(*p) == (p in found) for p in left)


def test_sketches_differ_in_no_more_bits_than_sets():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 5, 30, 31, 33, 40, 300, 330, 2000)]
    sets += [np.unique(np.concatenate((s[: len(s) - len(s) // k], r.integers(0, 1 << 63, len(s) // (2 * k)).astype(np.uint64)))) for s in sets for k in (5, 8, 12)]
    drawn = [similar.sketch(s) for s in sets]
    assert all(len(d) == similar.width(len(s)) and 64 * len(d) >= 2 * len(s) for d, s in zip(drawn, sets))
    n = np.array([len(s) for s in sets])
    i, j = similar.open_pairs(n, np.arange(len(sets)), [d.tobytes() for d in drawn])
    got = {(min(p), max(p)) for p in zip(i.tolist(), j.tolist())}
    every = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    near = {p for p in every if similar.within(sets[p[0]], sets[p[1]])}
    assert near <= got and len(near) > 20 and len(got) < len(every) // 3
    same_root = similar.open_pairs(n, np.zeros(len(sets)), [d.tobytes() for d in drawn])
    assert not len(same_root[0])


def test_pairs_of_one_group_are_not_all_decided(spark, monkeypatch):
    """Copies of a text that are further than 0.8 from each other share first shingles; hardly a pair of them moves texts."""
    base = prose(7, 200)
    rows = [(k, changed(base, 12, k)) for k in range(50)] + [(50, changed(base, 1, 90)), (51, changed(base, 1, 91))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, decide = [], similar.linked

    def counted(pairs, rows):
        seen.append((pairs := similar.saved(pairs)).count())
        return decide(pairs, rows)

    monkeypatch.setattr(similar, "linked", counted)
    kept = {r.doc_id for r in similar.one_of_each(docs).collect()}
    assert kept == slow_kept(rows) and len(kept) > 40
    assert len(seen) == 3 and seen[2] < 100  # all pairs: 1,326
